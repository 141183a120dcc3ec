import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.driver_tables import bind  # noqa: E402
from ledgerline.plans.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=2, app="tests")
    # tiny inputs: compiling a stage takes longer than interpreting it
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    return bind(spark, SF)
