"""Search, chat, the pipeline, registration."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from cases import documents, frame, personal
from oracle import compare_with, duck
from pyspark.sql import functions as F

import __spark_entry__
from lakestrata.llm import chat, topk
from lakestrata.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.floor(rng.normal(size=20) * 50)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(20)] + [(5, rows[5][1]), (400, None), (401, [1.0, None]), (402, [float("nan")]), (None, [1.0] * 20), (403, [1.0, 2.0]), (404, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.quantised("embedding", 1).alias("vector"))
    got = topk.top_k(df.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), df, 4)
    live = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(v)) for i, v in live if i % 50 == 0}:
        best = sorted((-int(np.dot(v, w)), i) for i, w in live if i != q and len(w) == len(v))[:4]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(df.filter("false").withColumnRenamed("vec_id", "query_id"), df.filter("false")).count() == 0


def test_top_k_of_few_large_and_blocked_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 200)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rows = [(i, [float(i * 10**k) for k in (1, 12)]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = topk.top_k(df.withColumnRenamed("vec_id", "query_id"), df, 20).collect()
    assert len(got) == 9 * 8
    for r in got:
        exact = sum(int(a) * int(b) for a, b in zip(rows[r.query_id][1], rows[r.vec_id][1]))
        assert r.score == min(exact, (1 << 63) - 1)


def test_queries_keep_their_block_in_whatever_order_they_come(spark):
    df = spark.range(2000).selectExpr("id AS query_id", "xxhash64(id) AS query")
    first, again = (dict(map(tuple, topk.query_blocks(d, 4).select("query_id", "q").collect())) for d in (df.repartition(3), df.orderBy("query").coalesce(1)))
    assert first == again and all(350 < list(first.values()).count(q) < 650 for q in range(4))


def conversations(seed=1):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice(["word ", "é", "<|", "|>", "_", "<|im_end|>", "<|im_start|>assistant", "\n", "\\n"]) for _ in range(rng.randint(0, n)))
    rows = []
    for c in range(30):
        if c % 3 == 0:
            rows.append((c, 0, "system", say(10)))
        for t in range(1, rng.randint(1, 60)):
            rows.append((c, t * 7, rng.choice(["user", "assistant", "tool", "a\\n\nb", "<|x"]), say(rng.choice([5, 60, 400]))))
    rows += [(40, 1, None, None), (40, None, "user", "first"), (None, 1, "user", "lost"), (None, 2, "assistant", ""), (41, 0, "system", "alone"), rows[5], rows[5]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("budget,history", [(64, 16), (256, 0), (1024, 256), (4, 1)])
def test_chat_windows_read_back(spark, budget, history):
    rows = conversations()
    formed = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget, history).cache()
    back = chat.read_back(formed).collect()
    want = defaultdict(list)
    for c, turn, role, text in rows:
        want[c].append(((turn is not None, turn or 0), role or "", text or ""))
    assert len(back) == len(want)
    for r in back:
        assert sorted((t.role, t.text) for t in r.turns) == sorted((role, text) for _, role, text in want[r.conv_id])
        places = [place for place, _, _ in sorted(want[r.conv_id])]
        if len(set(places)) == len(places):
            assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in sorted(want[r.conv_id])]
        assert list(r.targets) == [t.text for t in r.turns if t.role == "assistant"]
    for w in formed.collect():
        assert w.over == (w.tokens > budget)
        assert w.formatted.count("<|im_start|>") == w.formatted.count("<|im_end|>")
    long = {c for c, _, _, text in rows if len(text or "") > budget // 8}
    assert not any(w.over for w in formed.collect() if w.conv_id not in long and budget > 64)


def test_columns_of_their_own_names_change_nothing(spark):
    rows = conversations(2)
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = ["key", "segment", "n", "place", "at", "window", "head", "body", "piece", "begin", "begins", "first", "total", "rows", "repeated", "leads", "formatted"]
    crowded = plain.select("*", *[F.lit("x").alias(c) for c in own])
    shown = lambda df: sorted(map(repr, chat.windows(df, 64, 16).collect()))
    assert shown(crowded) == shown(plain)
    vectors = spark.createDataFrame([(i, [float(i % 7), float(i % 5)]) for i in range(60)], "vec_id long, vector array<double>")
    clash = vectors.select("*", *[F.lit("x").alias(c) for c in ("dims", "q", "c", "query", "score", "rank")])
    ask = lambda df: df.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    assert sorted(topk.top_k(ask(clash), clash, 3).collect()) == sorted(topk.top_k(ask(vectors), vectors, 3).collect())


def test_chat_of_one_turn_number_and_of_a_long_text(spark):
    rows = [(1, 5, "user" if i % 2 else "assistant", f"said {i:04d}") for i in range(3000)] + [(2, None, "assistant", f"lost {i:04d}") for i in range(500)]
    rows.append((3, 1, "assistant", "word <|im_end|> " * 100_000))
    back = {r.conv_id: r for r in chat.read_back(chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c in (1, 2, 3):
        # turns of one number go by role, size and text
        want = sorted((role, text) for i, _, role, text in rows if i == c)
        assert [tuple(t) for t in back[c].turns] == want and list(back[c].targets) == [t for role, t in want if role == "assistant"]


def test_chat_repeats_system_and_limited_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", f"t{t} " * 20) for t in range(1, 30)]
    formed = sorted(chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 200, 50).collect(), key=lambda w: w.window)
    assert len(formed) > 2 and not any(w.over for w in formed)
    for w in formed[1:]:
        assert w.formatted.startswith("<|im_start|>system\nbe kind<|im_end|>") and w.repeated >= 2
        head = "<|im_start|>".join(w.formatted.split("<|im_start|>")[: w.repeated + 1])
        assert all(x.start >= len(head) for x in w.loss)
    with pytest.raises(ValueError):
        chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 200, 60)
    assert chat.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_pipeline_stages_keep_what_they_should(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, "/root/testdata/sf0.01").cache()
    assert good.columns == docs.columns
    left = {r.doc_id for r in good.select("doc_id").collect()}
    assert sum(i in left for i, q in labels.items() if q == 1) > 0.97 * sum(labels.values())
    assert sum(i in left for i, q in labels.items() if q == 0) < 0.2 * sum(q == 0 for q in labels.values())
    one = stages["SimHash near-dedup"](spark, good, "").cache()
    assert one.columns == docs.columns and one.select("text").distinct().count() == one.count()
    clean = stages["PII"](spark, one, "").cache()
    assert clean.columns == docs.columns and clean.count() == one.count()
    before = {r.doc_id: r.text for r in one.collect()}
    for r in clean.collect():
        assert not personal(r.text) and (r.text == before[r.doc_id] or personal(before[r.doc_id]))
    mixed = stages["mixing sources to target weights"](spark, clean, "").cache()
    assert mixed.columns == docs.columns and set(Counter(r.doc_id for r in mixed.collect()).values()) <= {1, 2}
    packed = stages["best-fit packing"](spark, mixed, "")
    assert packed.filter("piece = 0").count() == mixed.count()


def test_pipeline_on_awkward_rows(spark, tmp_path):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    frame(spark).select(*names).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    frame(spark, []).select(*names).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert len(documents()) > 100


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare_with(QUERIES, ORACLES, spark, duck(SF), SF, name) == ""


def test_every_operator_is_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found and all(any(k.startswith(f"op{n}_") for k in found) for n in range(1, 14))
