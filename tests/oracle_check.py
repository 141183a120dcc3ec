"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, digits: int | None):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is not None and v != 0:
            v = float(f"{v:.{digits}g}")
        return ("n", v + 0.0)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", float(v)) if digits is not None else ("i", v)
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    return (type(v).__name__, str(v))


def rows_of(names, rows, digits):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i], digits) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql):
    """Returns (status, detail); status is EXACT, CLOSE (equal to 9 digits) or DIFF."""
    srows = [tuple(r) for r in spark_df.collect()]
    con.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {sql}")  # as a view, so that SQL which cannot stand in one shows
    cur = con.execute("SELECT * FROM checked")
    dnames = [d[0] for d in cur.description]
    drows = cur.fetchall()
    if sorted(spark_df.columns) != sorted(dnames):
        return "DIFF", f"columns {sorted(set(spark_df.columns) ^ set(dnames))}"
    if len(srows) != len(drows):
        return "DIFF", f"rows {len(srows)} != {len(drows)}"
    a, b = rows_of(spark_df.columns, srows, None), rows_of(dnames, drows, None)
    if a == b:
        return "EXACT", f"{len(a)} rows"
    a, b = rows_of(spark_df.columns, srows, 9), rows_of(dnames, drows, 9)
    if a == b:
        return "CLOSE", f"{len(a)} rows"
    names = sorted(dnames)
    bad = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return "DIFF", "; ".join(str([(n, p, q) for n, p, q in zip(names, x, y) if p != q]) for x, y in bad)


def main(sf_dir: str, only: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from ledgerline.plans.session import local_session

    spark = local_session(8)
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key, run in queries.items():
        if only and not any(key.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if key in sqls:
                status, detail = compare(df, con, sqls[key])
            else:
                status, detail = "ROWS", f"{len(df.collect())} rows"
        except Exception as e:  # noqa: BLE001
            status, detail = "ERROR", str(e)[:700]
        bad += status in ("DIFF", "ERROR")
        print(f"{status:6} {key:45} {time.time() - start:6.2f}s {detail if status not in ('EXACT',) else detail}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
