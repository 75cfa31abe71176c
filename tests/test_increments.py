"""Numbers, checks, comparisons and landings that cost what has changed."""

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from lakestrata.operators.quality import leaf_sums, not_null, reconcile, reconcile_by_checksums, relationships, rule, unequal_leaves, unique
from lakestrata.sources import registry, tables
from lakestrata.sources.identity_table import IdentityTable
from lakestrata.sources.slice_checks import CheckState, SliceCheck, aligned, on_slices
from lakestrata.sources.sliced_table import SlicedTable


@pytest.fixture
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS steps")
    return "steps"


# comparison -----------------------------------------------------------------------------------------------------------

def bag(spark, n, **changes):
    data = [(i, None if i % 5 == 0 else f"v{i}", float(i)) for i in range(n)]
    return spark.createDataFrame(data + list(changes.get("more", [])), "k bigint, v string, x double").filter(~F.col("k").isin(changes.get("less", [-1])))


@pytest.mark.parametrize("mode", ["set", "multiset"])
@pytest.mark.parametrize("key", [None, ["k"]])
def test_checksums_give_the_rows_of_the_comparison(spark, mode, key):
    a = bag(spark, 500)
    for more, less in (([], [-1]), ([(7, None, 7.0), (3, "v3", 3.0), (3, "v3", 3.0)], [4, 5]), ([(1000, None, None)], [-1])):
        b = bag(spark, 500, more=more, less=less).repartition(3)
        for leaves in (1, 16, 1 << 16):
            assert rows(reconcile_by_checksums(a, b, mode, leaves, key)) == rows(reconcile(a, b, mode)), (more, leaves)
    with pytest.raises(ValueError, match="same columns"):
        reconcile_by_checksums(a, a.drop("v"))


def test_equal_tables_cost_the_sums_alone(spark, tmp_path):
    bag(spark, 2000).write.parquet(f"{tmp_path}/a")
    bag(spark, 2000).repartition(5).write.parquet(f"{tmp_path}/b")
    a, b = (spark.read.parquet(f"{tmp_path}/{n}") for n in "ab")
    out = reconcile_by_checksums(a, b, leaves=64)
    assert out.collect() == []
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "EmptyRelation" in final or "LocalTableScan <empty>" in final, final
    # sums kept beside the tables tell without reading them which leaves differ
    kept = [spark.createDataFrame(leaf_sums(d, leaves=64).collect(), leaf_sums(d, leaves=64).schema) for d in (a, b)]
    assert unequal_leaves(*kept).count() == 0
    c = b.filter("k <> 77")
    changed = spark.createDataFrame(leaf_sums(c, leaves=64).collect(), kept[0].schema)
    assert unequal_leaves(kept[0], changed).count() == 1
    assert [r["k"] for r in reconcile_by_checksums(a, c, leaves=64, kept=(kept[0], changed)).collect()] == [77]


# identity -------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("buckets", [None, 4])
def test_numbers_are_gapless_and_kept(spark, db, buckets):
    t = IdentityTable(spark, f"{db}.numbers", ["k"], start=10, buckets=buckets)
    t.drop()
    frame = lambda *ks: spark.createDataFrame([(k, f"p{k}") for k in ks], "k string, p string")
    assert t.take(frame("b", "a", "c", "a", None)) == 3
    first = dict(map(tuple, t.lookup().collect()))
    assert first == {"a": 10, "b": 11, "c": 12}
    # a load that never ended leaves nothing behind
    spark.sql(f"INSERT INTO {db}.numbers__parts SELECT 'zz', 13, 2")
    assert t.take(frame("c", "a")) == 0 and dict(map(tuple, t.lookup().collect())) == first
    assert t.take(frame("d", "b", "0")) == 2
    got = dict(map(tuple, spark.table(f"{db}.numbers").collect()))
    assert got == {**first, "0": 13, "d": 14}
    assert sorted(map(tuple, t.numbered(frame("d", "d", None, "a")).collect()), key=repr) == sorted([(14, "d", "pd"), (14, "d", "pd"), (None, None, "pNone"), (10, "a", "pa")], key=repr)
    assert t.take(frame()) == 0


# checks ---------------------------------------------------------------------------------------------------------------

def test_touched_slices_are_checked_again_and_no_others(spark, db):
    child, parent = (SlicedTable(spark, f"{db}.{n}", ["k"], 8) for n in ("child", "parent"))
    seen = []

    def counted(check):
        inner = on_slices(child, check)

        def run(only):
            seen.append(only)
            return inner(only)

        return run

    checks = [SliceCheck("v_not_null", counted(lambda d: not_null(d, "v"))), SliceCheck("k_unique", on_slices(child, lambda d: unique(d, ["k"]))),
              SliceCheck("x_positive", on_slices(child, lambda d: rule(d, F.col("x") >= 0))), SliceCheck("in_parent", aligned(child, parent, lambda c, p: relationships(c, ["k"], p, ["k"])))]
    state = CheckState(spark, f"{db}.child_checks", checks)
    for t in (child, parent, state.table):
        t.drop()
    child.overwrite(bag(spark, 200))
    parent.overwrite(spark.range(199).withColumnRenamed("id", "k"))

    def full():
        d, p = child.read(), parent.read()
        return {"v_not_null": not_null(d, "v").count(), "k_unique": unique(d, ["k"]).count(), "x_positive": rule(d, F.col("x") >= 0).count(), "in_parent": relationships(d, ["k"], p, ["k"]).count()}

    def told(df):
        assert all(r["passed"] == (r["failures"] == 0) for r in df.collect())
        return {r["check_name"]: r["failures"] for r in df.collect()}

    assert told(state.run()) == full() and full()["in_parent"] == 1
    touched = child.merge(spark.createDataFrame([(3, None, -1.0), (900, "n", 1.0)], "k bigint, v string, x double"))
    assert told(state.run(touched)) == full() and len(touched) <= 2 and seen[-1] == touched
    assert told(state.run(parent.merge(spark.createDataFrame([(900,)], "k bigint")))) == full()
    n = len(seen)
    assert told(state.run(set())) == full() and len(seen) == n
    child.merge(bag(spark, 0), gone=bag(spark, 500).select("k"))
    assert told(state.run()) == full()
    other = SlicedTable(spark, f"{db}.other", ["k"], 4)
    with pytest.raises(ValueError, match="same slices"):
        aligned(child, other, lambda c, p: c)


# landing --------------------------------------------------------------------------------------------------------------

@pytest.fixture
def source(spark, db, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS land__s")
    for t in ("a", "b", "c"):
        tables.drop(spark, f"land__s.{t}")
    tables.drop(spark, f"{db}.landed")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text('k,v\n1,"x\ny"\n')
    (tmp_path / "b.json").write_text('{"k":1}\n{"k":2}\n')
    tasks = [(1, 1, "BLOB_CSV", {"file": "a"}, "a"), (1, 2, "BLOB_JSON", {"file": "b.json"}, "b")]
    record = registry.LandingRecord(spark, f"{db}.landed")

    def run(day, mode="overwrite", more=()):
        jobs, frame = registry.registry(spark, [(1, "SRC", "s")], [*tasks, *more])
        return registry.run_tasks(spark, registry.resolve_tasks(jobs, frame, "land"), str(tmp_path), at(day), mode, record=record)

    return tmp_path, run


def runs(spark, table="land__s.a"):
    return sorted((r["k"], r["v"], r["SYSRUNID"]) for r in spark.table(table).collect())


def test_unchanged_sources_are_not_landed_again(spark, source):
    path, run = source
    assert run(1) == ["land__S.a", "land__S.b"] and run(2) == []
    (path / "a" / "1.csv").write_text('k,v\n1,"x\ny"\n')  # written again, the same
    assert run(3) == [] and runs(spark) == [("1", "x\ny", "run-1")]
    (path / "a" / "1.csv").write_text('k,v\n1,"x\nz"\n')
    assert run(4) == ["land__S.a"] and runs(spark) == [("1", "x\nz", "run-4")]
    (path / "a" / "2.csv").write_text("k,v\n2,n\n")
    assert run(5) == ["land__S.a"] and runs(spark) == [("1", "x\nz", "run-5"), ("2", "n", "run-5")]
    (path / "a" / "1.csv").unlink()
    assert run(6) == ["land__S.a"] and runs(spark) == [("2", "n", "run-6")] and run(7) == []


def test_appending_takes_new_files_alone(spark, source):
    path, run = source
    run(1, "append")
    (path / "a" / "2.csv").write_text("k,v\n2,n\n")
    assert run(2, "append") == ["land__S.a"] and run(3, "append") == []
    assert runs(spark) == [("1", "x\ny", "run-1"), ("2", "n", "run-2")] and spark.table("land__s.b").count() == 2


def test_a_failed_task_runs_again_alone(spark, source):
    path, run = source
    bad = (1, 3, "BLOB_CSV", {"file": "c.csv"}, "c")
    with pytest.raises(registry.LandingFailed, match="task 3"):
        run(1, more=[bad])
    assert runs(spark) == [("1", "x\ny", "run-1")]
    (path / "c.csv").write_text("k,v\n9,late\n")
    assert run(2, more=[bad]) == ["land__S.c"]
    assert runs(spark) == [("1", "x\ny", "run-1")] and runs(spark, "land__s.c") == [("9", "late", "run-2")]


def test_latest_per_key_settles_ties(spark):
    from lakestrata.operators.guards import latest_per_key

    data = [(1, f"v{i}", 5) for i in range(40)] + [(2, None, None), (2, "a", None)]
    df = spark.createDataFrame(data, "k int, v string, at int")
    pick = lambda d: rows(latest_per_key(d, ["k"], [F.col("at").desc_nulls_last()]))
    assert pick(df) == pick(df.orderBy(F.desc("v")).repartition(3)) == pick(df.coalesce(1)) and len(pick(df)) == 2
