import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakestrata.sources.sliced_table import SlicedTable


@pytest.fixture
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sliced")
    t = SlicedTable(spark, "sliced.t", ["k"], 8)
    t.drop()
    return t


def kv(spark, data):
    return spark.createDataFrame(data, "k bigint, v string")


def partitions(spark):
    return {tuple(int(x.split("=")[1]) for x in r["partition"].split("/")) for r in spark.sql("SHOW PARTITIONS sliced.t__slices").collect()}


def test_merge_rewrites_touched_slices_only(spark, table):
    assert table.read() is None
    table.overwrite(kv(spark, [(i, "a") for i in range(400)]))
    assert len(partitions(spark)) == 8
    touched = table.merge(kv(spark, [(3, "b"), (1000, "n")]))
    assert 1 <= len(touched) <= 2
    assert {s for s, n in partitions(spark) if n == 2} == touched
    want = sorted([(i, "b" if i == 3 else "a") for i in range(400)] + [(1000, "n")])
    assert sorted(rows(spark.table("sliced.t"))) == sorted(rows(table.read())) == want
    assert SlicedTable(spark, "sliced.t", ["k"]).slices == 8
    # what load 2 replaced stays for one more load
    assert all((s, 1) in partitions(spark) for s in touched)
    again = table.merge(kv(spark, [(3, "c")]))
    assert all((s, 1) not in partitions(spark) and (s, 2) in partitions(spark) for s in again)
    assert table.read().filter("k = 3").first()["v"] == "c"
    assert table.merge(kv(spark, [])) == set() and table.read().count() == 401


def test_update_rewrites_touched_slices_only(spark, table):
    table.overwrite(kv(spark, [(i, "a") for i in range(100)]))
    assert len(table.update(F.col("k") == 5, {"v": F.lit("x")})) == 1
    assert table.update(F.col("k") == 500, {"v": F.lit("x")}) == set()
    assert [tuple(r) for r in table.read().filter("v = 'x'").collect()] == [(5, "x")] and table.read().count() == 100
    with pytest.raises(ValueError, match="key"):
        table.update(F.col("k") == 5, {"K": F.lit(6)})


def test_full_write_leaves_no_older_rows(spark, table):
    table.overwrite(kv(spark, [(i, "a") for i in range(100)]))
    table.merge(kv(spark, [(1, "b")]))
    table.overwrite(kv(spark, [(7, "z")]))
    assert rows(spark.table("sliced.t")) == [(7, "z")]
    table.overwrite(kv(spark, [(7, "z")]).withColumn("more", F.lit(1)))
    assert spark.table("sliced.t").columns == ["k", "v", "more"]


def test_failed_load_is_not_seen(spark, table):
    table.overwrite(kv(spark, [(1, "a")]))
    with pytest.raises(Exception):
        table.merge(kv(spark, [(1, "b"), (1, "c")]))
    spark.sql("INSERT INTO sliced.t__slices SELECT 1, 'junk', key_slice, 2 FROM sliced.t__slices LIMIT 1")
    assert rows(spark.table("sliced.t")) == [(1, "a")]
    table.merge(kv(spark, [(2, "b")]))
    assert rows(spark.table("sliced.t")) == [(1, "a"), (2, "b")]


def test_reads_prune_to_the_slices(spark, table):
    table.overwrite(kv(spark, [(i, "a") for i in range(100)]))
    plan = table.read({2})._jdf.queryExecution().executedPlan().toString()
    assert "key_slice" in plan.split("PartitionFilters")[1].split("]")[0]


def test_merge_of_another_key_type_loses_no_rows(spark, table):
    table.overwrite(kv(spark, [(i, "a") for i in range(100)]))
    table.merge(spark.createDataFrame([(3, "b"), (4, "b"), (200, "b")], "k int, v string"))
    want = sorted([(i, "b" if i in (3, 4) else "a") for i in range(100)] + [(200, "b")])
    assert sorted(rows(spark.table("sliced.t"))) == want
    with pytest.raises(ValueError, match="key k is string"):
        table.merge(spark.createDataFrame([("5", "b")], "k string, v string"))
    assert sorted(rows(spark.table("sliced.t"))) == want


def test_merge_takes_keys_out_and_computes_its_rows_once(spark, table):
    table.overwrite(kv(spark, [(i, "a") for i in range(40)]), taken=3)
    assert table.taken() == 3
    seen = spark.sparkContext.accumulator(0)
    fresh = kv(spark, [(1, "b"), (41, "n")])

    def tally(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    once = fresh.mapInPandas(tally, fresh.schema)
    touched = table.merge(once, keys=fresh, gone=spark.range(2, 4).withColumnRenamed("id", "k"), taken=5)
    want = sorted([(i, "b" if i == 1 else "a") for i in range(40) if i not in (2, 3)] + [(41, "n")])
    assert sorted(rows(spark.table("sliced.t"))) == want and table.taken() == 5 and len(touched) <= 4 and seen.value == 2
    # slices that lose their last row are empty, not as they were
    table.merge(fresh.filter("false"), gone=spark.range(0, 50).withColumnRenamed("id", "k"))
    assert rows(spark.table("sliced.t")) == rows(table.read()) == [] and table.taken() == 5
    assert table.merge(fresh.filter("false"), keys=fresh.filter("false"), taken=6) == set() and table.taken() == 6


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("by_keys", [False, True])
def test_types_grow_through_merges(spark, buckets, by_keys):
    spark.sql("CREATE DATABASE IF NOT EXISTS sliced")
    t = SlicedTable(spark, f"sliced.grown_{buckets}_{by_keys}", ["k"], 4, buckets)
    kind = lambda df, types: df.select(*[F.col(c).cast(x).alias(c) for c, x in types.items()])
    rows_ = lambda *data: spark.createDataFrame(data, "k bigint, v bigint")
    big = 3_000_000_000
    t.overwrite(kind(rows_(*[(i, i) for i in range(12)]), {"k": "int", "v": "int"}))
    running = t.read()
    more = rows_((1, big), (big, 5))
    extra = {"keys": more.select("k"), "gone": kind(rows_((2, 0)).select("k"), {"k": "int"})} if by_keys else {}
    t.merge(more, taken=3, **extra)
    assert running.count() == 12 and t.taken() == 3
    wanted = {**{i: i for i in range(12)}, 1: big, big: 5}
    if by_keys:
        del wanted[2]
    assert dict(map(tuple, t.read().collect())) == dict(map(tuple, spark.table(t.name).collect())) == wanted
    assert [f.dataType.simpleString() for f in t.read().schema] == ["bigint", "bigint"]
    other = SlicedTable(spark, t.name, ["k"])
    assert len(other.merge(kind(rows_((3, 7)), {"k": "smallint", "v": "int"}))) == 1
    assert dict(map(tuple, t.read().collect())) == {**wanted, 3: 7}
    assert not spark.catalog.tableExists(f"{t.name}__slices")
    with pytest.raises(ValueError, match="v is date"):
        t.merge(spark.sql("SELECT 1L AS k, DATE'2024-01-01' AS v"))
    t.drop()
    assert not spark.catalog.tableExists(f"{t.name}__slices2")
