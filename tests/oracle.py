"""Run registered queries against their SQL twins in DuckDB.

    python tests/oracle.py [sf_dir] [name ...]
"""

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else f"{f:.9g}"
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


def sorted_rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in data]
    return [names[i] for i in order], sorted(rows, key=repr)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name):
    """'' when equal, else what differs."""
    from workload import ORACLES, QUERIES

    return compare_with(QUERIES, ORACLES, spark, con, sf_dir, name)


def compare_with(queries, oracles, spark, con, sf_dir, name):
    df = queries[name](spark, sf_dir)
    got = sorted_rows(df.columns, df.collect())
    res = con.execute(oracles[name])
    want = sorted_rows([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}: {got[1][:2]} / {want[1][:2]}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            return f"got {g}\nwant {w}"
    return "" if want[1] else "no rows at all"


if __name__ == "__main__":
    import tempfile

    from pyspark.sql import SparkSession

    import __spark_entry__

    QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", work + "/shared").config("spark.sql.warehouse.dir", work + "/warehouse")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            why = compare_with(QUERIES, ORACLES, spark, con, sf, name) if name in ORACLES else f"(rows only) {QUERIES[name](spark, sf).count()}"
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(why) and name in ORACLES
        print(f"{'ok  ' if not why else 'FAIL'} {name} {time.time() - start:.2f}s {why}", flush=True)
    print(f"{len(QUERIES)} queries, {bad} failed")
