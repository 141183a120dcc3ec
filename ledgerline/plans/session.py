"""Session defaults for running the warehouse on its own."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even where the split costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers, so that its functions run wherever they start."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="ledgerline-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    bundle = os.path.join(folder, "ledgerline.zip")
    with zipfile.ZipFile(bundle, "w") as out:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(bundle)
    _SHIPPED.add(context.applicationId)


def local_session(cores: str | int = "*", partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session whose executors run in the driver's own process may go without:
    it gets a folder of its own, removed when the process ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and go on from the files: what reads it again does not compute it again."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
