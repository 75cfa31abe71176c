"""The plans that must hold at scale: what is pushed, what is shuffled, what never appears."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.incremental import merge_upsert, newer_than
from workload import QUERIES

WRITES = {"append_rows", "overwrite_from_itself", "truncate_and_reload", "update_one_row", "ctas_with_limit", "create_like_then_insert",
          "clone_is_independent", "masks_follow_copies", "stored_history", "arriving_files_landed", "identity_numbers", "persistent_view", "governed_sql", "stored_build_rebuilt", "stored_build_incremental",
          "stored_build_seven_steps", "gold_increments_by_load", "checks_on_touched_slices", "registry_lands_what_changed", "tags_through_layers"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cross_join_and_no_single_task_window(spark, sf, name, no_broadcast):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        assert "RoundRobin" not in line
        if "- Window [" in line:
            feed = next(x for x in lines[i:] if "Exchange" in x)
            assert "hashpartitioning" in feed, line


@pytest.mark.parametrize("name", [n for n in sorted(set(QUERIES) - WRITES) if not n.endswith("_python")])
def test_everything_stays_in_the_jvm(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "EvalPython" not in text and "MapInPandas" not in text


@pytest.mark.parametrize("name,shuffles", [
    ("bronze_listings", 0), ("bronze_reviews", 0), ("mask_partial_by_category", 0), ("row_access_by_category", 0), ("value_band", 0),
    ("reconcile_as_sets", 1), ("reconcile_as_multisets", 1), ("unique_check", 1), ("accepted_values_check", 1), ("relationships_check", 2),
    ("snapshot_first_load", 1), ("snapshot_second_load", 2), ("snapshot_by_timestamp", 2),
])
def test_shuffles(spark, sf, name, shuffles, no_broadcast):
    assert plan(QUERIES[name](spark, sf)).count("Exchange hashpartitioning") == shuffles


def test_unread_columns_stay_on_disk(spark, sf):
    text = plan(QUERIES["coordinate_joins"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_current_rows_filter_reaches_the_files(spark, tmp_path_factory):
    from lakestrata.operators.history import current_rows

    where = str(tmp_path_factory.mktemp("cur") / "h")
    spark.sql("SELECT 1 AS k, CAST(NULL AS TIMESTAMP) AS valid_to").write.parquet(where)
    assert "PushedFilters: [IsNull(valid_to)]" in plan(current_rows(spark.read.parquet(where)))


def test_high_water_mark_reaches_the_files(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = plan(newer_than(orders, "o_orderdate", orders.filter("o_orderkey < 100"), "o_orderdate"))
    assert "GreaterThan(o_orderdate,ScalarSubquery" in text


def test_merge_leaves_the_target_in_place_for_a_small_increment(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = plan(merge_upsert(orders.filter("o_orderkey < 10"), orders, ["o_orderkey"]))
    anti = text[text.index("LeftAnti"):]
    target = anti[: anti.index("BroadcastExchange")]
    assert "Exchange" not in target


def test_repeated_rows_meet_before_the_shuffle(spark, sf):
    for name in ("reconcile_as_sets", "unique_check", "accepted_values_check", "relationships_check", "value_category_summary"):
        assert "partial_" in plan(QUERIES[name](spark, sf))
    assert "WindowGroupLimit" in plan(QUERIES["merge_keeping_latest"](spark, sf))


def test_stored_history_reads_only_open_rows(spark, sf):
    QUERIES["stored_history"](spark, sf)
    from workload.registration import Tables

    name = Tables(spark, sf).work_database() + ".order_history"
    text = plan(spark.table(name + "__current").select(F.max("o_orderkey")))
    assert "PartitionFilters: [isnotnull(" in text and "(row_state" in text
