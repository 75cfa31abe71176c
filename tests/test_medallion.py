import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import at, rows
from lakestrata import Layers
from lakestrata.plans import lodging
from lakestrata.plans.medallion import Medallion
from lakestrata.sources import tables


def build(spark, env, mode="table", buckets=None):
    m = Medallion(spark, Layers(env), mode, buckets=buckets)
    m.create()
    tables.overwrite(fixtures.landing_listings(spark), m.name("LANDING", "Listings"))
    tables.overwrite(fixtures.landing_reviews(spark), m.name("LANDING", "Reviews"))
    tables.overwrite(fixtures.landing_drivers(spark, fixtures.DOCUMENTS), m.name("LANDING", "Drivers"))
    tables.overwrite(fixtures.geography(spark), m.name("GOLD", "Dim_Geography"))
    tables.overwrite(fixtures.geospatial(spark), m.name("GOLD", "Dim_Geography_Geospatial"))
    return m


def rename_listing(m, id_, name):
    tables.update_table(m.spark, m.name("LANDING", "Listings"), F.col("id").cast("bigint") == id_, {"name": F.lit(name)})


def test_full_build_then_change(spark):
    m = build(spark, "DEV")
    m.run(at(10))
    fact = m.read("GOLD", "Fact_Listings")
    bands = {r["VALUE_CATEGORY"]: r["count"] for r in fact.groupBy("VALUE_CATEGORY").count().collect()}
    assert bands == {"High Value": 5, "Medium Value": 2, "Standard": 3}
    assert fact.filter("GEOGRAPHY_ID is not null and WARD_ID is not null").count() == 6
    assert fact.filter("LISTING_SK is null").count() == 0
    assert m.check().filter("not passed").count() == 0

    m.run(at(11))  # nothing changed
    assert m.read("SILVER", "Listings").count() == 10
    assert m.read("SILVER", "Listings").filter("SYSRUNID = 'run-10'").count() == 10

    rename_listing(m, 80, "Renamed Room")
    m.run(at(12))
    h = m.read("SILVER", "Listings").filter("id = 80").orderBy(F.col("valid_to").asc_nulls_last()).collect()
    assert [r["name"] for r in h] == ["Lodging No. 3", "Renamed Room"]
    assert h[0]["valid_to"] == h[1]["valid_from"] and h[1]["valid_to"] is None
    assert m.read("SILVER", "Listings").count() == 11
    assert m.spark.table(m.name("SILVER", "Listings") + "__current").count() == 10
    assert m.read("GOLD", "Dim_Listing_Details").filter("ID = 80").first()["NAME"] == "Renamed Room"
    assert m.read("GOLD", "Fact_Listings").filter("LISTING_ID = 80").first()["LISTINGS"] == "Renamed Room"
    m.reset()
    assert not tables.exists(spark, m.name("GOLD", "Fact_Listings"))
    assert m.read("LANDING", "Listings").count() == 10


def test_incremental_gold_equals_rebuild(spark):
    out = {}
    for env, mode in (("TEST", "incremental"), ("PREPROD", "table")):
        m = build(spark, env, mode, buckets=4 if mode == "incremental" else None)
        m.run(at(10))
        rename_listing(m, 71, "New Name")
        m.run(at(12))
        drop = ("SYSLOADDATE", "SYSRUNID")
        out[mode] = [rows(m.read("GOLD", t).drop(*drop)) for t in ("Dim_Listing_Details", "Fact_Listings")]
        if mode == "incremental":
            assert m.read("GOLD", "Fact_Listings").filter("SYSRUNID = 'run-12'").count() == 1
        m.reset()
    assert out["incremental"] == out["table"]


def test_incremental_gold_takes_late_equal_null_times_and_deletes(spark):
    """Gold follows silver's loads, whatever their times; closed keys leave it."""
    out = {}
    for env, mode in (("TEST", "incremental"), ("PREPROD", "table")):
        m = build(spark, env, mode)
        m.hard_deletes = "invalidate"
        m.run(at(10))
        name = m.name("LANDING", "Listings")
        rename_listing(m, 71, "Same Time")
        m.run(at(11))
        # silver's own times go back: a mark by time would miss these rows
        tables.update_table(spark, name, F.col("id").cast("bigint") == 80, {"name": F.lit("Late")})
        gone = spark.table(name).filter("id = 71").count()
        tables.overwrite(spark.table(name).filter("id <> 71"), name)
        m.run(at(12))
        m.run(at(13))
        drop = ("SYSLOADDATE", "SYSRUNID")
        out[mode] = [rows(m.read("GOLD", t).drop(*drop)) for t in ("Dim_Listing_Details", "Fact_Listings")]
        assert gone == 1 and m.read("GOLD", "Fact_Listings").filter("LISTING_ID = 71").count() == 0
        if mode == "incremental":
            assert m.read("GOLD", "Fact_Listings").filter("SYSRUNID = 'run-12'").count() == 1
            assert m.read("GOLD", "Fact_Listings").filter("SYSRUNID = 'run-13'").count() == 0
        m.reset()
    assert out["incremental"] == out["table"]


@pytest.mark.parametrize("mode", ["table", "incremental"])
def test_listing_dimension_joins_silver_where_both_lie(spark, mode):
    """Neither side of the dimension join is shuffled, and both place joins share one shuffle of the fact rows."""
    m = build(spark, "TEST", mode, buckets=4)
    m.run(at(10))
    rename_listing(m, 71, "Changed")
    m.run(at(11))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim, geo, ward = (m.read("GOLD", t) for t in ("Dim_Listing_Details", "Dim_Geography", "Dim_Geography_Geospatial"))
        fact = lodging.gold_listing_fact(m.silver("Listings").current(), dim, geo, ward, at(12))
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert not any("id#" in x.lower() for x in dealt), plan
    assert sum("__n0" in x for x in dealt) == 1 and plan.count("SortMergeJoin") == 3, plan
    assert fact.count() == 10 and fact.filter("LISTING_SK IS NULL").count() == 0
    m.reset()
