"""Quality classifier on learned subword embeddings.

Features of a text are hashed: bytes n-grams of three and four within words (with the spaces around them), whole words, and
pairs of neighbouring words (a pair's hash is the XOR of the words', so all immediate repeats share one feature). Each hash
bucket has a learned vector; a document is the mean of its features' vectors, and a softmax layer on that gives the class.
Vectors and layer are trained together by minibatch gradient descent in numpy.

Training takes a bounded sample: at most ``SAMPLE`` labelled rows outside the held-out third, chosen by a hash of doc_id. Their
features are counted on the executors, at most ``2 ** BITS`` numbers a row, and only those reach the driver. Everything is
scored: whole texts, no shuffle. With two classes the logit is linear in the mean, so the trained network is folded into one
number per bucket (a fixed 512 KB), which gives the same score as averaging the vectors.

Edge cases. Null and empty texts have no features; their score is that of the bias, the share of label 1. Labels that are null,
or that contradict each other for one doc_id, teach nothing. Without usable labels every score is 0.5, hence predicted 1.
Repeated rows score alike. A null doc_id counts as the text '' in the split. Texts above ``LONG`` bytes are read in parts cut
at white space (any byte up to 32), whose features add up to the text's; a single longer word is one part. An empty table gives an empty result; other columns pass through,
and those with the added names are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from lakestrata.llm.common import arrow_batches

BITS = 17
DIM = 8
SAMPLE = 3000
EPOCHS = 8
BATCH = 32
RATE = 0.5
#: How much more a word or a pair of words counts in the mean than an n-gram of bytes.
WORD_WEIGHT = 4.0
SEED = 7
#: Bytes of a part of a text.
LONG = 1 << 22
#: Bytes of text looked at in one go.
_SLICE = 1 << 19

_BLANK = re.compile(rb"[\x00-\x20]")
_BLANKS = bytes(32 if b <= 32 else b for b in range(256))

ADDED = ("held_out", "score", "predicted")

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, for each the number of its text, and its weight in the text's mean."""
    raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), lengths)  # each text with the space before it
    b = np.where(raw <= 32, np.uint8(32), raw)
    space = b == 32
    out, of = [], []
    wide = b.astype(np.uint32)
    gram = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    ok = np.flatnonzero(~space[1:-1])
    out.append(_bucket(gram[ok].astype(np.uint64) * _P))
    of.append(ok)
    ok4 = np.flatnonzero(~(space[1:-2] | space[2:-1]))
    four = gram[ok4] | wide[ok4 + 3] << np.uint32(24)
    out.append(_bucket((four.astype(np.uint64) + np.uint64(1 << 40)) * _P))
    of.append(ok4)
    edge = np.flatnonzero(np.diff(space.astype(np.int8)))  # words are between a -1 and a +1
    start, end = edge[0::2] + 1, edge[1::2] + 1
    if len(start):
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(wide.astype(np.uint64) * _powers(_P, len(b)), out=sums[1:])
        word = (sums[end] - sums[start]) * _powers(_P_INV, len(b))[start]
        out.append(_bucket(word + np.uint64(3)))
        of.append(start)
        same = owner[start[1:]] == owner[start[:-1]]
        out.append(_bucket((word[1:] ^ word[:-1])[same] + np.uint64(5)))
        of.append(start[1:][same])
    weight = np.repeat([1.0, 1.0, WORD_WEIGHT, WORD_WEIGHT][: len(out)], [len(x) for x in out])
    return np.concatenate(out), owner[np.concatenate(of)], weight


def _parts(text: bytes) -> Iterator[tuple[bytes, int]]:
    """Parts of a text and how often each counts: features of the parts add up to those of the text.

    Parts end between words. Each but the first begins with the last word of the part before, for the pair of words at the cut,
    and that word alone is taken off again.
    """
    a, last = 0, b""
    while a < len(text):
        b = len(text)
        if b - a > LONG:
            blank = np.flatnonzero(np.frombuffer(text[a + 1 : a + LONG], np.uint8) <= 32)
            if len(blank):
                b = a + 1 + int(blank[-1])
            elif (found := _BLANK.search(text, a + LONG)) is not None:  # one word longer than a part
                b = found.start()
        part = text[a:b]
        if last:
            yield last, -1
        yield last + part, 1
        words = part.translate(_BLANKS).rsplit(None, 1)
        last = words[-1] + b" " if words else last
        a = b


def _sliced(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Parts of texts, some _SLICE bytes at a time, with the number of each part's text and how often it counts."""
    of, held, times, size = [], [], [], 0
    for i, text in enumerate(texts):
        for part, n in _parts(text):
            if held and size + len(part) > _SLICE:
                yield of, held, times
                of, held, times, size = [], [], [], 0
            of.append(i)
            held.append(part)
            times.append(n)
            size += len(part) + 1
    if held:
        yield of, held, times


@dataclass
class Model:
    """The network folded into a number per bucket, and the bias: logit = mean of the numbers + bias."""

    table: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for of, parts, times in _sliced(texts):
            bucket, owner, weight = features(parts)
            n = len(parts)
            np.add.at(total, of, times * np.bincount(owner, self.table[bucket] * weight, n))
            np.add.at(count, of, times * np.bincount(owner, weight, n))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -50, 50)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = SEED) -> Model:
    """Train on (buckets, counts, label) of each row."""
    size = 1 << BITS
    if not rows:
        return Model(np.zeros(size, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    y = np.array([r[2] for r in rows])
    prior = (y.sum() + 1) / (len(y) + 2)
    e = rng.uniform(-1, 1, (size, DIM)) / DIM
    w = rng.uniform(-1, 1, (2, DIM)) / DIM
    b = np.log([1 - prior, prior])
    speed = np.full(size, 1e-8)  # squared gradients so far, for steps that suit rare and common features alike
    steps, step = EPOCHS * -(-len(rows) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = [rows[i] for i in order[at : at + BATCH]]
            chosen = [r for r in chosen if len(r[0])]
            if not chosen:
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            ids = np.concatenate([r[0] for r in chosen])
            share = np.concatenate([r[1] / r[1].sum() for r in chosen])
            starts = np.cumsum([0, *(len(r[0]) for r in chosen[:-1])])
            of = np.repeat(np.arange(len(chosen)), [len(r[0]) for r in chosen])
            h = np.add.reduceat(e[ids] * share[:, None], starts)
            z = h @ w.T + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), [r[2] for r in chosen]] -= 1
            dh = p @ w
            w -= rate * p.T @ h / len(chosen)
            used, inv = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(inv, share * dh[of, k], len(used)) for k in range(DIM)], axis=1)
            speed[used] += (grad**2).sum(axis=1)
            e[used] -= rate * grad / np.sqrt(speed[used])[:, None]
    return Model((e @ (w[1] - w[0])).astype(np.float32), float(b[1] - b[0]))


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def _counted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for text in batch:
            total = np.zeros(1 << BITS)
            for _, parts, times in _sliced([text or b""]):
                bucket, owner, weight = features(parts)
                total += np.bincount(bucket, weight * np.array(times)[owner], 1 << BITS)
            used = np.flatnonzero(total)
            rows.append((used.astype(np.int32), total[used].astype(np.float32)))
        yield pd.DataFrame({"buckets": [r[0] for r in rows], "counts": [r[1] for r in rows]})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows whose crc32(doc_id) mod 3 is not 1."""
    arrow_batches(docs.sparkSession)
    clean = (
        labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null").filter(remainder(F.col("doc_id")) != 1)
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("hi")).filter("y = hi").select("doc_id", "y")
    )
    chosen = clean.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    counted = F.pandas_udf(_counted, StructType([StructField("buckets", ArrayType(IntegerType())), StructField("counts", ArrayType(FloatType()))]))
    # ``sample`` bounds the broadcast side and what is collected
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    rows = found.select("doc_id", "y", counted(F.col("text").cast("binary")).alias("f")).select("doc_id", "y", "f.*").toArrow()
    buckets, counts = (rows[c].combine_chunks() for c in ("buckets", "counts"))
    data = [(buckets[i].values.to_numpy(), counts[i].values.to_numpy(), rows["y"][i].as_py()) for i in np.argsort(rows["doc_id"].to_numpy(), kind="stable")]
    return fit(data)


def _score(spark, model: Model) -> Column:
    arrow_batches(spark)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores([t or b"" for t in texts]), dtype="float64")

    return F.pandas_udf(run, DoubleType())(F.col("text").cast("binary"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with held_out, score and predicted of each row."""
    rest = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    with_score = rest.withColumn("held_out", remainder(F.col("doc_id")) == 1).withColumn("score", _score(docs.sparkSession, model))
    return with_score.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with the columns they have."""
    return docs.filter(_score(docs.sparkSession, train(docs, labels)) >= 0.5)
