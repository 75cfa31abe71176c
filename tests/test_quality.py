import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from lakestrata.operators.quality import (
    Check,
    accepted_values,
    CheckFailed,
    require,
    assert_same_rows,
    compare_row_count,
    count_report,
    not_null,
    of_type,
    reconcile,
    relationships,
    rule,
    run_checks,
    scan,
    unique,
)

A = [(1, "x"), (2, None), (2, None), (3, "z")]


def t(spark, data):
    return spark.createDataFrame(data, "k bigint, v string")


def test_equal_tables_in_another_order_and_column_order(spark):
    a = t(spark, A)
    b = t(spark, A[::-1]).select("v", "k")
    for fp in (False, True):
        assert reconcile(a, b, fingerprint=fp).count() == 0 and reconcile(a, b, "set", fingerprint=fp).count() == 0
    assert_same_rows(a, b)


@pytest.mark.parametrize("fp", [False, True])
def test_differences(spark, fp):
    a = t(spark, A)
    changed = reconcile(a, t(spark, [(1, "y"), *A[1:]]), fingerprint=fp)
    assert rows(changed) == [(1, "x", "source", 1), (1, "y", "target", 1)]
    assert rows(reconcile(a, t(spark, A[1:]), fingerprint=fp)) == [(1, "x", "source", 1)]
    more = t(spark, [*A, (3, "z"), (3, "z")])
    assert rows(reconcile(a, more, fingerprint=fp)) == [(3, "z", "target", 2)]
    assert reconcile(a, more, "set", fingerprint=fp).count() == 0
    swapped = reconcile(spark.createDataFrame([("a", None)], "p string, q string"), spark.createDataFrame([(None, "a")], "p string, q string"), fingerprint=fp)
    assert swapped.count() == 2  # NULLs hash by position
    with pytest.raises(AssertionError, match="rows differ"):
        assert_same_rows(a, more)


def test_documents_compare_by_content(spark):
    def docs(*texts):
        return spark.createDataFrame([(x,) for x in texts], "j string").select(F.parse_json("j").alias("payload"))

    a = docs('{"a":1,"b":{"x":1,"y":2}}', '{"a":2}')
    assert reconcile(a, docs('{"a":2}', '{"b":{"y":2,"x":1},"a":1}')).count() == 0
    assert rows(reconcile(a, docs('{"a":2}', '{"a":3}'), "set").select("payload", "only_in")) == [
        ('{"a":1,"b":{"x":1,"y":2}}', "source"), ('{"a":3}', "target")]


def test_empty_tables_and_wrong_columns(spark):
    e = t(spark, [])
    assert reconcile(e, e).count() == 0 and compare_row_count(e, e).count() == 0
    require("counts", compare_row_count(e, e))
    with pytest.raises(ValueError):
        reconcile(e, spark.range(1))
    with pytest.raises(ValueError):
        reconcile(e, e, "bag")


_rows = st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["a", None])), max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_rows, _rows)
def test_reconcile_is_empty_exactly_for_equal_bags_or_sets(spark, a, b):
    x, y = t(spark, a), t(spark, b)
    assert (reconcile(x, y).count() == 0) == (sorted(a, key=repr) == sorted(b, key=repr))
    assert (reconcile(x, y, "set").count() == 0) == (set(a) == set(b))


def test_row_counts(spark):
    a, b = spark.range(5), spark.range(3)
    assert tuple(compare_row_count(a, b).first()) == (5, 3, 2)
    with pytest.raises(CheckFailed, match="counts: .*'source_count': 5, 'target_count': 3, 'difference': 2"):
        require("counts", compare_row_count(a, b))
    plan = compare_row_count(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_column_checks(spark):
    a = t(spark, A)
    assert not_null(a, "v").count() == 2 and not_null(a, "k").count() == 0
    assert of_type(a, "k", "number").count() == 0 and tuple(of_type(a, "v", "number").first()) == ("v", "number", "string", 4)
    assert rows(unique(a, ["k"])) == [(2, 2)] and rows(unique(a, ["k", "v"])) == [(2, None, 2)]
    assert rows(accepted_values(a, "v", ["x"])) == [("z", 1)]
    assert rows(rule(a, F.col("v") < "y")) == [(2, None), (2, None), (3, "z")]


def test_accepted_values_scenario(spark):
    df = spark.createDataFrame([("High Value",), ("Standard",), ("Standard",)], "c string")
    assert rows(accepted_values(df, "c", ["High Value", "Medium Value"])) == [("Standard", 2)]
    assert accepted_values(df, "c", ["High Value", "Medium Value", "Standard"]).count() == 0


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(2,), (None,)], "pk bigint")
    assert rows(relationships(child, ["fk"], parent, ["pk"])) == [(1, 2)]


def test_suite(spark):
    a = t(spark, A)
    suite = [Check("nulls", lambda: not_null(a, "v"), frozenset({"P1"})), Check("keys", lambda: not_null(a, "k"), frozenset({"recon"})),
             Check("broken", lambda: 1 / 0, frozenset({"never"}))]
    assert rows(run_checks(suite, {"p1", "recon"})) == [("keys", 0, True), ("nulls", 2, False)]
    with pytest.raises(ValueError):
        run_checks(suite, {"none"})


def test_report_and_scan(spark):
    assert rows(count_report({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
    spark.range(4).createOrReplaceTempView("four")
    assert scan(spark, "four").count() == 4
    with pytest.raises(Exception):
        scan(spark, "four; DROP TABLE four").count()


@pytest.mark.parametrize("mode", ["set", "multiset"])
def test_long_texts_are_compared_by_digest(spark, mode):
    long = "long text " * 50
    kinds = "k int, t string, b binary, x double"
    a = spark.createDataFrame([(1, long, b"1", 0.0), (1, long, b"1", 0.0), (2, "short", None, None), (3, None, b"", 1.0), (4, long + "a", b"1", 2.0)], kinds)
    b = spark.createDataFrame([(1, long, b"1", -0.0), (2, "short", None, None), (3, "", b"", 1.0), (4, long + "b", b"1", 2.0)], kinds)
    found = reconcile(a, b, mode, texts="digest")
    assert found.columns == reconcile(a, b, mode).columns
    assert rows(found) == rows(reconcile(a, b, mode)) and len(rows(found)) == (4 if mode == "set" else 5)
    assert not rows(reconcile(a, a, mode, texts="digest"))
    # types that differ are compared in their common type, as whole
    wide = a.withColumn("k", F.col("k").cast("bigint"))
    assert not rows(reconcile(a, wide, mode, texts="digest"))
    with pytest.raises(ValueError, match="texts"):
        reconcile(a, b, mode, texts="some")
