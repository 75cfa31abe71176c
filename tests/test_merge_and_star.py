from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import at, rows
from lakestrata.operators.history import snapshot_check
from lakestrata.operators.identity import assign_identity
from lakestrata.operators.incremental import incremental, merge_upsert, newer_than
from lakestrata.operators.star import Dim, star_join, summarize_by, top_n
from lakestrata.plans import lodging


def kv(spark, data):
    return spark.createDataFrame(data, "k bigint, v string")


def test_merge(spark):
    out = merge_upsert(kv(spark, [(2, "new"), (3, "new")]), kv(spark, [(1, "old"), (2, "old")]), ["k"])
    assert rows(out) == [(1, "old"), (2, "new"), (3, "new")]
    assert rows(merge_upsert(kv(spark, [(1, "a")]), None, ["k"])) == [(1, "a")]


def test_merge_with_repeated_keys(spark):
    twice = kv(spark, [(2, "a"), (2, "b")])
    with pytest.raises(Exception, match="repeated key"):
        merge_upsert(twice, kv(spark, [(1, "x")]), ["k"]).collect()
    assert rows(merge_upsert(twice, kv(spark, [(1, "x")]), ["k"], duplicates="latest", latest_by="v")) == [(1, "x"), (2, "b")]


def test_merge_follows_schema_changes(spark):
    target = spark.createDataFrame([(1, "x", "gone")], "k bigint, v string, w string")
    source = spark.createDataFrame([(2, "y", 5)], "k bigint, v string, n int")
    assert sorted(map(tuple, merge_upsert(source, target, ["k"], "sync_all_columns").collect()), key=str) == [(1, "x", None), (2, "y", 5)]
    assert merge_upsert(source, target, ["k"], "append_new_columns").columns == ["k", "v", "n", "w"]
    assert merge_upsert(source, target.drop("w"), ["k"], "ignore").columns == ["k", "v"]


def test_newer_than_ignores_late_rows_and_reads_all_on_first_run(spark):
    s = spark.sql("SELECT id, CAST('2024-01-01' AS TIMESTAMP) + make_dt_interval(CAST(id AS INT)) AS ts FROM range(5)")
    t = s.filter("id = 2")
    assert [r["id"] for r in newer_than(s, "ts", t, "ts").orderBy("id").collect()] == [3, 4]
    assert newer_than(s, "ts", None, "ts").count() == 5
    assert newer_than(s, "ts", t.filter("id < 0"), "ts").count() == 5


def test_incremental_reprocess_does_not_repeat_new_rows(spark):
    s = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "k bigint, ts bigint")
    t = s.filter("k < 3")
    out = incremental(lambda r: r.withColumn("seen", F.lit(1)), s, t.withColumn("seen", F.lit(0)), ["k"], "ts", "ts",
                      reprocess=spark.createDataFrame([(1,), (3,), (3,)], "k bigint"))
    assert rows(out) == [(1, 1, 1), (2, 2, 0), (3, 3, 1)]


def test_star_join_keeps_every_fact_row_once(spark):
    fact = spark.createDataFrame([(1, 1), (1, None), (2, 9), (None, 1)], "a bigint, b bigint")
    dim = spark.createDataFrame([(1, 1, "x"), (2, 2, "y"), (None, 1, "n"), (None, 1, "n")], "ka bigint, kb bigint, name string")
    for salt in (1, 3):
        out = star_join(fact, [Dim(dim, {"a": "ka", "b": "kb"}, {"name": "label"}, salt=salt)])
        assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 1, "x"), (1, None, None), (2, 9, None), (None, 1, None)], key=str)


def test_repeated_dimension_key(spark):
    fact = spark.createDataFrame([(1,)], "a bigint")
    dim = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k bigint, name string, at int")
    with pytest.raises(Exception, match="repeated key"):
        star_join(fact, [Dim(dim, {"a": "k"}, {"name": "label"})]).collect()
    out = star_join(fact, [Dim(dim, {"a": "k"}, {"name": "label"}, "latest", latest_by="at")])
    assert rows(out) == [(1, "y")]
    assert star_join(fact, [Dim(dim, {"a": "k"}, {"name": "label"}, "trusted")]).count() == 2


def test_coordinates_that_match_nowhere(spark, ctx):
    bronze = lodging.bronze_listings(fixtures.landing_listings(spark), ctx)
    silver = snapshot_check(lodging.silver_source(bronze, lodging.LISTING_TYPES, ctx), None, ["id"], list(lodging.LISTING_TYPES), ctx)
    # shares a latitude with one listing but never both coordinates
    far = fixtures.geography(spark).withColumn("longitude", F.lit(Decimal("-0.9")).cast("decimal(11,8)") + F.col("geography_id").cast("int") / 1000)
    far = far.withColumn("longitude", F.col("longitude").cast("decimal(11,8)"))
    fact = lodging.gold_listing_fact(silver, lodging.gold_listing_dim(silver, ctx), far, fixtures.geospatial(spark), ctx)
    assert fact.filter("GEOGRAPHY_ID is null").count() == 10 and fact.filter("WARD_ID is null").count() == 4
    r = {x["value"]: x for x in summarize_by(fact.withColumnsRenamed({"VALUE_CATEGORY": "value", "PRICE": "price"}), "value", "price").collect()}
    assert (r["High Value"]["row_count"], r["Medium Value"]["min_price"], r["Standard"]["max_price"]) == (5, 120, 90)
    assert r["Standard"]["avg_price"] == 75.0


def test_host_must_match_too(spark, ctx):
    bronze = lodging.bronze_listings(fixtures.landing_listings(spark), ctx)
    silver = snapshot_check(lodging.silver_source(bronze, lodging.LISTING_TYPES, ctx), None, ["id"], list(lodging.LISTING_TYPES), ctx)
    dim = lodging.gold_listing_dim(silver, ctx).withColumn("HOST_ID", F.when(F.col("ID") == 71, 1).otherwise(F.col("HOST_ID")))
    fact = lodging.gold_listing_fact(silver, dim, fixtures.geography(spark), fixtures.geospatial(spark), ctx)
    r = fact.filter("LISTING_ID = 71").first()
    assert (r["LISTING_SK"], r["LISTINGS"], r["HOST_ID"], r["HOST_NAME"], r["PRICE"]) == (None, None, None, None, 410)


def test_hot_key_is_split_at_run_time(spark):
    """A key holding a third of the fact rows: AQE cuts its partition, and the guard does not stand in the way."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 60000, 1, 12).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        dim = spark.range(0, 60000, 1, 4).select("id", F.col("id").cast("string").alias("name"))
        out = star_join(fact, [Dim(dim, {"k": "id"}, {"name": "label"})])
        assert out.agg(F.count("label")).first()[0] == 60000
        got = out.write.format("noop").mode("overwrite")
        got.save()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_identity(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("n"))
    out = assign_identity(df, ["n"], start=10).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(10, 1010)) and [r["n"] for r in out] == list(range(1000))


def test_identity_with_one_value_everywhere(spark):
    df = spark.range(0, 500, 1, 5).select(F.lit("same").alias("n"))
    out = assign_identity(df, ["n"])
    assert sorted(r["id"] for r in out.collect()) == list(range(1, 501))
    assert out.select(F.input_file_name()).distinct().count() > 1  # ties spread over partitions
    assert assign_identity(df.filter("n = ''"), ["n"]).count() == 0


def test_top_n(spark):
    assert [r["id"] for r in top_n(spark.range(100), 3, F.desc("id")).collect()] == [99, 98, 97]


def test_rows_without_keys_are_spread_and_kept(spark):
    from pyspark.sql import functions as F

    from lakestrata.operators.star import Dim, star_join

    fact = spark.range(4000).select(F.col("id").alias("n"), F.when(F.col("id") % 4 == 0, F.col("id") % 100).alias("x"), (F.col("id") % 7).alias("y"), (F.col("id") % 3).alias("h"))
    dim = spark.range(100).select(F.col("id").alias("X"), F.explode(F.array(*[F.lit(i) for i in range(7)])).alias("Y"), (F.col("id") % 3).alias("H"), F.col("id").alias("found"))
    arms = [Dim(dim, {"x": "X", "y": "Y"}, {"found": "one"}, spread_nulls=True), Dim(dim, {"x": "X", "y": "Y"}, {"found": "two"}, also={"h": "H"}, spread_nulls=True)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = star_join(fact, arms)
        assert got.columns == ["n", "x", "y", "h", "one", "two"]
        want = [(r.n, r.x, r.y, r.h, r.x, r.x if r.x is not None and r.x % 3 == r.h else None) for r in fact.collect()]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = [r["count"] for r in star_join(fact, arms).groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 2000, sizes  # three quarters of the rows have no key; there are four partitions
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
