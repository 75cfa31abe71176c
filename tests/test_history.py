from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import at, rows
from lakestrata.operators.history import HistoryColumns, current_rows, snapshot_check, snapshot_timestamp
from lakestrata.sources.history_table import HistoryTable


def src(spark, data):
    return spark.createDataFrame(data, "k bigint, v string, w bigint")


def shown(df):
    return sorted(((r["k"], r["v"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None) for r in df.collect()), key=repr)


def load(spark, data, target, day, **kw):
    return snapshot_check(src(spark, data), target, ["k"], ["v", "w"], at(day), **kw)


def test_null_to_value_and_back_is_a_change(spark):
    a = load(spark, [(1, None, 1)], None, 1)
    b = load(spark, [(1, "x", 1)], a, 2)
    c = load(spark, [(1, None, 1)], b, 3)
    assert shown(c) == [(1, "x", 2, 3), (1, None, 1, 2), (1, None, 3, None)]


def test_equal_rows_keep_their_old_row_untouched(spark):
    a = load(spark, [(1, "x", None)], None, 1)
    assert rows(load(spark, [(1, "x", None)], a, 2)) == rows(a)


def test_deleted_key_returns(spark):
    kw = {"hard_deletes": "new_record"}
    a = load(spark, [(1, "x", 1), (2, "y", 1)], None, 1, **kw)
    b = load(spark, [(2, "y", 1)], a, 2, **kw)
    assert [tuple(r) for r in b.filter("k = 1").orderBy("valid_from").select("is_deleted").collect()] == [(False,), (True,)]
    c = load(spark, [(2, "y", 1)], b, 3, **kw)
    assert rows(c) == rows(b)  # a key marked once stays as it is
    d = load(spark, [(1, "x", 1), (2, "y", 1)], c, 4, **kw)
    assert [r["is_deleted"] for r in d.filter("k = 1").orderBy("valid_from").collect()] == [False, True, False]
    assert current_rows(d).count() == 2


def test_closed_key_opens_again(spark):
    a = load(spark, [(1, "x", 1)], None, 1)
    b = load(spark, [], a, 2, hard_deletes="invalidate")
    c = load(spark, [(1, "x", 1)], b, 3, hard_deletes="invalidate")
    assert shown(c) == [(1, "x", 1, 2), (1, "x", 3, None)]


@pytest.mark.parametrize("target", [False, True])
@pytest.mark.parametrize("bad", [[(1, "a", 1), (1, "b", 1)], [(None, "a", 1)]])
def test_repeated_and_null_keys_fail(spark, bad, target):
    old = load(spark, [(5, "x", 1)], None, 1) if target else None
    with pytest.raises(Exception, match="repeated key|NULL key"):
        load(spark, bad, old, 2).collect()


def test_new_and_vanished_source_columns(spark):
    a = snapshot_check(spark.createDataFrame([(1, "x")], "k bigint, old string"), None, ["k"], ["old"], at(1))
    b = snapshot_check(spark.createDataFrame([(1, "n"), (2, None)], "k bigint, new string"), a, ["k"], ["new"], at(2))
    assert b.columns[:3] == ["k", "new", "old"]
    assert sorted(((r["k"], r["new"], r["old"], r["valid_to"] is None) for r in b.collect()), key=repr) == sorted(
        [(1, None, "x", False), (1, "n", None, True), (2, None, None, True)], key=repr)


def test_vanished_columns_keep_their_values(spark):
    """Kept, newly closed and long closed versions alike, in a frame and in a stored history."""
    loads = [([(1, "a", "p"), (2, "a", "q")], "k bigint, v string, b string"), ([(1, "b", "r"), (2, "a", "q")], "k bigint, v string, b string"),
             ([(1, "b"), (2, "c"), (3, "n")], "k bigint, v string")]
    t, plain = fresh_table(spark, "vanishing", buckets=4), None
    for day, (data, schema) in enumerate(loads, 1):
        df = spark.createDataFrame(data, schema)
        checked = [c for c in df.columns if c != "k"]
        t.load_by_check(df, checked, at(day))
        plain = snapshot_check(df, plain, ["k"], checked, at(day))
    want = [(1, "a", "p", False), (1, "b", "r", True), (2, "a", "q", False), (2, "c", None, True), (3, "n", None, True)]
    for got in (plain, spark.table("hist.vanishing")):
        assert sorted((r["k"], r["v"], r["b"], r["valid_to"] is None) for r in got.collect()) == want


@pytest.mark.parametrize("deletes", ["ignore", "invalidate"])
def test_a_version_ends_after_its_start(spark, deletes):
    a = load(spark, [(1, "x", 1)], None, 1, hard_deletes=deletes)
    assert load(spark, [(1, "x", 1)], a, 1, hard_deletes=deletes).count() == 1
    with pytest.raises(Exception, match="not past its start"):
        load(spark, [(1, "y", 1)], a, 1, hard_deletes=deletes).collect()
    if deletes == "invalidate":
        with pytest.raises(Exception, match="not past its start"):
            load(spark, [], a, 1, hard_deletes=deletes).collect()


def test_version_ids_tell_keys_with_bars_apart(spark):
    from lakestrata.functions.keys import version_id

    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\\\|b", "c"), ("a\\\\", "b|c")], "x string, y string")
    assert df.select(version_id(["x", "y"], F.lit("t")).alias("id")).distinct().count() == 4


def test_bucketed_loads_shuffle_once_and_write_a_file_a_bucket(spark, tmp_path):
    spark.range(4000).selectExpr("id AS k", "cast(id % 5 AS string) AS v", "1L AS w").repartition(12).write.parquet(str(tmp_path / "src"))
    t = fresh_table(spark, "onefile", buckets=8)
    where = None
    for day in (1, 2):
        df = spark.read.parquet(str(tmp_path / "src")).withColumn("v", F.when(F.col("k") % 9 == 0, F.lit(str(day))).otherwise(F.col("v")))
        t.load_by_check(df, ["v", "w"], at(day))
        where = spark.sql("DESCRIBE FORMATTED hist.onefile__parts").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
        files = list(Path(where).glob(f"load_seq={day}/*/*/*.parquet"))
        assert len(files) <= 2 * 8, len(files)
    from lakestrata.operators.history import check_changes

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        moved = check_changes(t._dealt(spark.read.parquet(str(tmp_path / "src"))), t.current(), ["k"], ["v", "w"], at(3))
        text = moved._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert text.count("Exchange hashpartitioning") == 1, text


def test_timestamp_strategy(spark):
    def s(data):
        return spark.createDataFrame(data, "k bigint, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))

    a = snapshot_timestamp(s([(1, "a", "2024-01-05"), (2, "a", "2024-01-05"), (3, "a", "2024-01-05")]), None, ["k"], "ts", at(1))
    b = snapshot_timestamp(s([(1, "b", "2024-01-05"), (2, "b", "2024-01-06"), (3, "b", "2024-01-04"), (4, "n", None)]), a, ["k"], "ts", at(2))
    got = sorted((r["k"], r["v"], r["valid_from"].day if r["valid_from"] else None, r["valid_to"].day if r["valid_to"] else None) for r in b.collect())
    assert got == [(1, "a", 5, None), (2, "a", 5, 6), (2, "b", 6, None), (3, "a", 5, None), (4, "n", None, None)]


def test_other_bookkeeping_names(spark):
    n = HistoryColumns("START_AT", "END_AT", "CHANGED_AT", "ROW_ID")
    a = load(spark, [(1, "x", 1)], None, 1, names=n)
    b = load(spark, [(1, "y", 1)], a, 2, names=n)
    assert b.columns == ["k", "v", "w", "START_AT", "END_AT", "CHANGED_AT", "ROW_ID"] and current_rows(b, n).count() == 1


_state = st.dictionaries(st.integers(1, 6), st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_state, min_size=2, max_size=3), st.sampled_from(["ignore", "invalidate"]))
def test_history_invariants(spark, deliveries, deletes):
    target, expected = None, {}
    for day, state in enumerate(deliveries, 1):
        data = [(k, v, w) for k, (v, w) in state.items()]
        target = load(spark, data, target, day, hard_deletes=deletes)
        expected = {**({} if deletes == "invalidate" else expected), **state}
        target = spark.createDataFrame(target.collect(), target.schema)
    got = target.collect()
    open_rows = [r for r in got if r["valid_to"] is None]
    assert {r["k"]: (r["v"], r["w"]) for r in open_rows} == expected and len(open_rows) == len(expected)
    for k in {r["k"] for r in got}:
        spans = sorted((r["valid_from"], r["valid_to"]) for r in got if r["k"] == k and r["valid_to"]) + [
            (r["valid_from"], None) for r in open_rows if r["k"] == k]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert len({r["scd_id"] for r in got}) == len(got)


def fresh_table(spark, name, **kw):
    spark.sql("CREATE DATABASE IF NOT EXISTS hist")
    return HistoryTable(spark, f"hist.{name}", ["k"], **kw)


def test_stored_history_equals_the_operator(spark):
    t, plain = fresh_table(spark, "equal", buckets=4, slices=1), None
    for day, data in enumerate([[(1, "a", 1), (2, "a", 1)], [(1, "b", 1), (3, "a", 1)], [(1, "b", 1)], [(2, "z", None), (1, "b", 1)]], 1):
        t.load_by_check(src(spark, data), ["v", "w"], at(day))
        plain = load(spark, data, plain, day)
        assert shown(spark.table("hist.equal")) == shown(t.read()) == shown(plain)
        assert shown(spark.table("hist.equal__current")) == shown(current_rows(plain))
    # only the last two open sets are kept, on disk too; every closed set is
    where = spark.sql("DESCRIBE FORMATTED hist.equal__parts").filter("col_name = 'Location'").first()["data_type"]
    kept = sorted(str(p.relative_to(where.removeprefix("file:"))) for p in Path(where.removeprefix("file:")).glob("load_seq=*/*/key_slice=0"))
    assert [k for k in kept if "open" in k] == ["load_seq=3/row_state=open/key_slice=0", "load_seq=4/row_state=open/key_slice=0"]
    assert "load_seq=2/row_state=closed/key_slice=0" in kept


def parts_of(spark, name):
    found = [dict(x.split("=") for x in r["partition"].split("/")) for r in spark.sql(f"SHOW PARTITIONS hist.{name}__parts").collect()]
    return {(int(p["load_seq"]), p["row_state"], int(p["key_slice"])) for p in found}


@pytest.mark.parametrize("deletes", ["ignore", "invalidate", "new_record"])
@pytest.mark.parametrize("buckets", [None, 4])
def test_only_changed_slices_are_written(spark, deletes, buckets):
    t, plain = fresh_table(spark, f"slices_{deletes}_{buckets}", hard_deletes=deletes, buckets=buckets, slices=8), None
    data = {i: (i, f"v{i}", None if i % 7 == 0 else i) for i in range(60)}
    deliveries = [dict(data), dict(data), {**data, 5: (5, "new", 1), 100: (100, "n", 2)}, {k: v for k, v in data.items() if k != 8}, dict(data), dict(data)]
    wrote = []
    for day, rows_ in enumerate(deliveries, 1):
        given = src(spark, list(rows_.values()))
        n = t.load_number()
        touched = t.load_by_check(given, ["v", "w"], at(day))
        plain = load(spark, list(rows_.values()), plain, day, hard_deletes=deletes)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        assert shown(spark.table(t.name)) == shown(t.read()) == shown(plain)
        assert shown(spark.table(t.current_name)) == shown(current_rows(plain))
        assert t.load_number() == (n + 1 if touched else n)
        assert {s for seq, _, s in parts_of(spark, t.name.split(".")[1]) if seq > n} <= touched
        wrote.append(len(touched))
    assert wrote[0] == t.slices and wrote[1] == wrote[5] == 0 and all(1 <= w <= 3 for w in wrote[2:5])


def test_checksums_tell_values_nulls_and_columns_apart(spark):
    t = fresh_table(spark, "digests", slices=1)
    one = t.load_by_check(src(spark, [(1, "a", None), (2, None, 2)]), ["v", "w"], at(1))
    assert one and not t.load_by_check(src(spark, [(2, None, 2), (1, "a", None)]).repartition(3), ["v", "w"], at(2))
    assert t.load_by_check(src(spark, [(1, None, None), (2, "a", 2)]), ["v", "w"], at(3))
    assert t.load_by_check(src(spark, [(1, None, None), (2, "a", 2)]), ["v"], at(4))  # other columns are compared
    with pytest.raises(Exception, match="repeated key"):
        t.load_by_check(src(spark, [(1, None, None), (2, "a", 2), (2, "a", 2)]), ["v"], at(5))


def test_closed_parts_are_merged(spark):
    t = fresh_table(spark, "merged", slices=2)
    for day in range(1, 16):
        t.load_by_check(src(spark, [(i, str(day), i) for i in range(6)]), ["v"], at(day))
        assert len(shown(spark.table("hist.merged"))) == 6 * day
    closed = [p for p in parts_of(spark, "merged") if p[1] == "closed"]
    assert len(closed) <= 2 * 9 and t.read().filter("valid_to IS NOT NULL").count() == 6 * 14
    assert t.gone_since(3).count() == 0 and t.opened_since(14).count() == 6 and t.opened_since(15).count() == 0


def test_what_loads_opened_and_closed(spark):
    t = fresh_table(spark, "changes", slices=4, hard_deletes="invalidate")
    t.load_by_check(src(spark, [(i, "a", i) for i in range(20)]), ["v"], at(1))
    t.load_by_check(src(spark, [(i, "b" if i == 3 else "a", i) for i in range(20) if i != 7]), ["v"], at(2))
    t.load_by_check(src(spark, [(i, "a", i) for i in range(21) if i not in (8, 9)]), ["v"], at(3))
    keys = lambda df: sorted(r["k"] for r in df.select("k").collect())
    assert keys(t.opened_since(0)) == [i for i in range(21) if i not in (8, 9)]
    assert keys(t.opened_since(1)) == [3, 7, 20] and keys(t.gone_since(1)) == [8, 9]
    assert keys(t.opened_since(2)) == [3, 7, 20] and keys(t.gone_since(2)) == [8, 9]
    assert keys(t.opened_since(3)) == [] == keys(t.gone_since(3))


def test_null_times_neither_freeze_a_key_nor_pass_unseen(spark):
    def s(*data):
        return spark.createDataFrame(data, "k bigint, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))

    a = snapshot_timestamp(s((1, "a", None), (2, "a", "2021-01-01"), (3, "a", None)), None, ["k"], "ts", at(1))
    b = snapshot_timestamp(s((1, "b", "2021-01-01"), (2, "a", "2021-01-01"), (3, "a", None)), a, ["k"], "ts", at(2))
    assert sorted((r["k"], r["v"], r["valid_to"] is None) for r in b.collect()) == [(1, "a", False), (1, "b", True), (2, "a", True), (3, "a", True)]
    for row in ((2, "c", None), (3, "c", None)):
        with pytest.raises(Exception, match="ts is NULL"):
            snapshot_timestamp(s(row), a, ["k"], "ts", at(2)).collect()


def test_failed_load_leaves_the_published_state(spark):
    t = fresh_table(spark, "failing")
    t.load_by_check(src(spark, [(1, "a", 1)]), ["v", "w"], at(1))
    with pytest.raises(Exception):
        t.load_by_check(src(spark, [(1, "b", 1), (1, "c", 1)]), ["v", "w"], at(2))
    # rows of a load whose views never moved
    spark.sql("INSERT INTO hist.failing__parts SELECT 9, 'junk', 0, now(), NULL, now(), 'x', 2, NULL, 2, 'open', 0")
    assert shown(spark.table("hist.failing")) == [(1, "a", 1, None)]
    t.load_by_check(src(spark, [(1, "b", 1)]), ["v", "w"], at(3))
    assert shown(spark.table("hist.failing")) == [(1, "a", 1, 3), (1, "b", 3, None)]


def test_stored_history_takes_new_columns(spark):
    t = fresh_table(spark, "wider")
    t.load_by_check(spark.createDataFrame([(1, "a")], "k bigint, v string"), ["v"], at(1))
    t.load_by_check(spark.createDataFrame([(1, "a", "n")], "k bigint, v string, extra string"), ["v", "extra"], at(2))
    got = sorted((r["extra"] is None, r["valid_to"] is None) for r in spark.table("hist.wider").collect())
    assert got == [(False, True), (True, False)]


def test_stored_history_by_timestamp(spark):
    t = fresh_table(spark, "stamped", hard_deletes="invalidate")
    one = spark.sql("SELECT 1L k, TIMESTAMP'2024-01-01' ts UNION ALL SELECT 2L, TIMESTAMP'2024-01-01'")
    t.load_by_timestamp(one, "ts", at(1))
    t.load_by_timestamp(spark.sql("SELECT 1L k, TIMESTAMP'2024-01-02' ts"), "ts", at(2))
    assert spark.table("hist.stamped").count() == 3 and t.current().count() == 1


def test_bucketed_open_rows_are_not_shuffled_again(spark):
    t = fresh_table(spark, "buckets", buckets=4)
    t.load_by_check(src(spark, [(i, "a", i) for i in range(100)]), ["v", "w"], at(1))
    from lakestrata.operators.history import check_changes

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = check_changes(src(spark, [(1, "b", 1)]), t.current(), ["k"], ["v", "w"], at(2))
        plan = moved._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_documents_travel_through_the_history(spark):
    def docs(v, text):
        return spark.createDataFrame([(1, v, text)], "k bigint, v string, j string").select("k", "v", F.parse_json("j").alias("payload"))

    t = fresh_table(spark, "documents")
    t.load_by_check(docs("a", '{"x":1}'), ["v"], at(1))
    t.load_by_check(docs("b", '{"x":2}'), ["v"], at(2))
    got = spark.table("hist.documents").orderBy("valid_from").select(F.to_json("payload"), F.col("valid_to").isNull()).collect()
    assert [tuple(r) for r in got] == [('{"x":1}', False), ('{"x":2}', True)]


def typed_src(spark, data, kinds):
    return spark.createDataFrame(data, "k bigint, v bigint, w string").select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()])


@pytest.mark.parametrize("buckets", [None, 4])
def test_types_grow_through_loads(spark, buckets):
    t = fresh_table(spark, f"growing_{buckets}", buckets=buckets, slices=4)
    int_, long_ = {"k": "int", "v": "int", "w": "decimal(5,2)"}, {"k": "bigint", "v": "bigint", "w": "decimal(12,4)"}
    big = 3_000_000_000
    base = [(i, i, "1.50") for i in range(20)]
    t.load_by_check(typed_src(spark, base, int_), ["v", "w"], at(1))
    t.load_by_check(typed_src(spark, [(0, 100, "1.50"), *base[1:]], int_), ["v", "w"], at(2))
    running = spark.table(t.name)  # planned before the types grow
    assert t.load_by_check(typed_src(spark, [(0, 100, "1.50"), (1, big, "1.5001"), *base[2:], (big, 1, "2")], long_), ["v", "w"], at(3)) == set(range(4))
    assert running.count() == 21
    assert [f.dataType.simpleString() for f in spark.table(t.name).schema][:3] == ["bigint", "bigint", "decimal(12,4)"]
    seen = lambda df: sorted((r["k"], r["v"], float(r["w"]), r["valid_from"].day, r["valid_to"].day if r["valid_to"] else 0) for r in df.collect())
    wanted = sorted([(0, 0, 1.5, 1, 2), (0, 100, 1.5, 2, 0), (1, 1, 1.5, 1, 3), (1, big, 1.5001, 3, 0), (big, 1, 2.0, 3, 0), *[(i, i, 1.5, 1, 0) for i in range(2, 20)]])
    assert seen(spark.table(t.name)) == seen(t.read()) == wanted
    assert seen(t.current()) == seen(spark.table(t.current_name)) == [r for r in wanted if r[4] == 0]
    # rows that only moved are no change
    assert sorted(r["k"] for r in t.opened_since(2).collect()) == [1, big] and not t.gone_since(2).count()
    # a narrower delivery is cast up, and equal values make no load
    same = [r for r in [(0, 100, "1.50"), *base[2:]]]
    assert t.load_by_check(typed_src(spark, same, int_), ["v", "w"], at(4))
    n = t.load_number()
    assert not t.load_by_check(typed_src(spark, same, int_), ["v", "w"], at(5)) and t.load_number() == n
    assert seen(spark.table(t.name)) == wanted
    # narrowing, or another kind of type, is refused
    with pytest.raises(ValueError, match="v is string"):
        t.load_by_check(typed_src(spark, base, {**long_, "v": "string"}), ["v", "w"], at(6))
    # closed parts of both tables are merged in time, and the older table goes
    for day in range(7, 7 + 12):
        t.load_by_check(typed_src(spark, [(i, day, "1.50") for i in range(20)], long_), ["v", "w"], at(day))
    assert t.tables() == [f"{t.name}__parts2"] and not spark.catalog.tableExists(f"{t.name}__parts")
    assert set(wanted[:1]) <= set(seen(spark.table(t.name))) and spark.table(t.name).count() == 22 + 20 * 12
    t.drop()
    assert not spark.catalog.tableExists(f"{t.name}__parts2")


def test_a_load_that_died_while_types_grew_leaves_nothing(spark):
    t = fresh_table(spark, "grown_failing", slices=2)
    t.load_by_check(typed_src(spark, [(1, 1, "1")], {"k": "int", "v": "int"}), ["v"], at(1))
    with pytest.raises(Exception, match="repeated key"):
        t.load_by_check(typed_src(spark, [(1, 2, "1"), (1, 3, "1")], {"k": "int", "v": "bigint"}), ["v"], at(2))
    assert spark.catalog.tableExists(f"{t.name}__parts2") and t.read().schema["v"].dataType.simpleString() == "int"
    t.load_by_check(typed_src(spark, [(1, 2, "1")], {"k": "int", "v": "decimal(20,1)"}), ["v"], at(3))
    assert [(int(r["v"]), r["valid_to"] is None) for r in spark.table(t.name).orderBy("valid_from").collect()] == [(1, False), (2, True)]
    assert t.read().schema["v"].dataType.simpleString() == "decimal(20,1)"


def test_first_load_takes_more_buckets_for_more_rows(spark, monkeypatch):
    from lakestrata.sources import history_table

    monkeypatch.setattr(history_table, "BUCKET_BYTES", 4000)
    t, data = fresh_table(spark, "buckets", buckets=2), [(k, "v" * 30, 1) for k in range(300)]
    t.drop()
    t = fresh_table(spark, "buckets", buckets=2)
    t.load_by_check(src(spark, data), ["v", "w"], at(1))
    assert t.buckets >= 300 * 38 // 4000 and t.buckets % 2 == 0 and t.slices == 2
    again, changed = fresh_table(spark, "buckets", buckets=2), [(k, "w" if k % 3 == 0 else v, w) for k, v, w in data]
    assert again.buckets == t.buckets
    again.load_by_check(src(spark, changed), ["v", "w"], at(2))
    plain = load(spark, changed, load(spark, data, None, 1), 2)
    assert shown(again.read()) == shown(plain)
    stored = spark.sql("DESCRIBE FORMATTED hist.buckets__parts").filter("col_name = 'Num Buckets'").first()["data_type"]
    assert int(stored) == t.buckets
