"""Document fingerprints by MinHash.

A text's shingles are its runs of five words (fewer words: the whole sequence). Words and shingles are hashed by polynomials
over numpy arrays, and ``PERMUTATIONS`` universal hash functions (multiply, add, shift) give each shingle as many numbers; a
fingerprint holds the least of each, 16 bits of it. The share of equal numbers estimates the Jaccard likeness of two texts.

``compared`` sets each document beside the next one by doc_id and beside its own edited text. Documents are dealt by ranges of
doc_id, one shuffle of the texts; the first document of each range is also sent to the range before, so no range waits for
another. Range bounds are quantiles, their number is that of the shuffle partitions. Texts are read in order, batch by batch,
and the shingles that a text and its edited text share are hashed once.

``near_groups`` and ``keep_one`` (the stage of the pipeline) group texts of a Jaccard likeness of ``LIKE`` or more over five-word
shingles. Texts of equal words are one class. Candidates are classes that share a band of the fingerprints (of two texts just
at 0.8 one pair in 20 million shares none) or a SimHash group; every link is verified on the shingles. Holders of a bucket are
compared with its least and greatest one; classes of a bucket that are then still apart meet over their rarest shingles, as many
as two like sets cannot do without, so no bucket's pairs are listed.

Edge cases. Null texts are empty. A text without words has a fingerprint of its own kind (all ones), like only to its equals.
Repeated doc_ids are in order of their texts; null doc_ids come last; after the last document comes the first, and a single
document is its own next. Words are compared with A-Z in lower case. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakestrata.llm import simhash
from lakestrata.llm.common import Work, arrow_batches, pick
from lakestrata.llm.components import components
from lakestrata.llm.simhash import fingerprint

WORDS = 5
PERMUTATIONS = 128
BANDS = 32
LIKE = 0.8
SEED = 5
#: Bytes of text, and shingles, in one numpy step.
_SLICE = 1 << 19
_STEP = 1 << 14

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = np.uint64(0xD1342543DE82EF95)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


class Hasher:
    """The hash functions, and powers that are looked up again and again."""

    def __init__(self, permutations: int = PERMUTATIONS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            for name, base in (("powers", _P), ("inverse", _P_INV)):
                x = np.full(n * 2, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def shingles(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """32-bit hashes of all shingles of the texts, in order, and the number of each one's text."""
        raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.flatnonzero(np.diff(space.astype(np.int8)))
        start, end = edge[0::2] + 1, edge[1::2] + 1
        if not len(start):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._grow(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)], out=sums[1:])
        word = _mix((sums[end] - sums[start]) * self.inverse[start])
        offsets = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        owner = np.searchsorted(offsets, start, side="left")
        n = len(word)
        total = word.copy()
        for j in range(1, WORDS):
            total *= _Q
            m = max(0, n - j)
            whole = np.zeros(n, bool)
            whole[:m] = owner[n - m :] == owner[:m]
            total[:m] += np.where(whole[:m], word[n - m :], np.uint64(0))
        first = np.ones(n, bool)
        first[1:] = owner[1:] != owner[:-1]
        keep = whole | first
        return _mix(total[keep]) >> np.uint64(32), owner[keep]

    def signatures(self, texts: list[bytes]) -> np.ndarray:
        """Least hash of each function, a row per text; all ones where there is no word."""
        out = np.full((len(texts), len(self.a)), (1 << 32) - 1, np.uint64)
        of, parts, size = [], [], 0

        def flush() -> None:
            hashes, owner = self.shingles(parts)
            for at in range(0, len(hashes), _STEP):
                h, o = hashes[at : at + _STEP], owner[at : at + _STEP]
                begins = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                rows = np.array(of)[o[begins]]
                low = np.empty((len(begins), len(self.a)), np.uint64)
                for p, (a, b) in enumerate(zip(self.a, self.b)):
                    low[:, p] = np.minimum.reduceat((h * a + b) >> np.uint64(32), begins)
                np.minimum.at(out, rows, low) if len(set(rows.tolist())) < len(rows) else out.__setitem__(rows, np.minimum(out[rows], low))

        for i, text in enumerate(texts):
            for part in _parts(text):
                if parts and size + len(part) > _SLICE:
                    flush()
                    of, parts, size = [], [], 0
                of.append(i)
                parts.append(part)
                size += len(part) + 1
        if parts:
            flush()
        return out


def _parts(text: bytes, limit: int = _SLICE) -> Iterator[bytes]:
    """The text, or parts of it that together have the same shingles: each begins with the last four words of the one before."""
    while len(text) > limit:
        head = text[:limit]
        if not text[limit : limit + 1].isspace() and not head[-1:].isspace():  # a word is cut: leave it to the next part
            head = head.rsplit(None, 1)[0] if len(head.split(None, 1)) == 2 else b""
        last = head.rsplit(None, WORDS - 1)
        if len(last) < WORDS:  # hardly any words: one long piece
            break
        yield head
        rest = text[len(head) :]
        if not rest.strip():
            return
        text = b" ".join(last[1:]) + (rest if rest[:1].isspace() else b" " + rest)
    yield text


def normal(text: str | None) -> bytes:
    return (text or "").encode().lower()


def edited(text: str, following: str) -> str:
    """``text`` whose last floor(n/2) code points give way to the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _split(text: bytes, other: bytes, shared: int) -> tuple[bytes, bytes, bytes] | None:
    """(head, rest of text, rest of other): head and rest have the shingles of each, where both begin with ``shared`` equal bytes."""
    words = text[:shared].rsplit(None, WORDS)
    if len(words) <= WORDS or not words[0]:
        return None
    tail = text[: shared][len(words[0]) :]
    end = len(words[0]) + len(tail.rstrip()) - len(words[-1])
    return text[:end], text[len(words[0]) :], other[len(words[0]) :]


def _short(signature: np.ndarray) -> np.ndarray:
    return (signature & np.uint64(0xFFFF)).astype("<u2")


def _text_of(short: np.ndarray) -> str:
    return base64.b64encode(short.tobytes()).decode()


def _rows(rows: list[tuple], hasher: Hasher) -> list[tuple]:
    """Results of all rows (bucket, halo, doc_id, text) but the last, each beside the one after it."""
    texts, of = [], []  # segments, and (text row, edited row) that each belongs to
    n = len(rows)
    digests, counts = [], []
    for i, (_, halo, _, text) in enumerate(rows):
        t = normal(text)
        if i == n - 1 or halo:
            texts.append(t)
            of.append((i, -1))
            digests.append(None)
            counts.append(0)
            continue
        e = edited(text, rows[i + 1][3])
        digests.append(hashlib.sha256(e.encode()).hexdigest())
        counts.append(len(text))
        other = normal(e)
        shared = len(text[: len(text) - len(text) // 2].encode())
        cut = _split(t, other, shared)
        if cut is None:
            texts += [t, other]
            of += [(i, -1), (-1, i)]
        else:
            texts += cut
            of += [(i, i), (i, -1), (-1, i)]
    low = hasher.signatures(texts)
    plain = np.full((n, low.shape[1]), (1 << 32) - 1, np.uint64)
    changed = plain.copy()
    for (i, j), row in zip(of, low):
        if i >= 0:
            np.minimum(plain[i], row, out=plain[i])
        if j >= 0:
            np.minimum(changed[j], row, out=changed[j])
    plain, changed = _short(plain), _short(changed)
    return [
        (rows[i][2], counts[i], digests[i], _text_of(plain[i]), _text_of(changed[i]), float((plain[i] == changed[i]).mean()), float((plain[i] == plain[i + 1]).mean()))
        for i in range(n - 1) if not rows[i][1]
    ]


_NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, held, kind = Hasher(), [], None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(_NAMES))

    for batch in batches:
        kind = batch.schema.field("doc_id").type
        cols = [batch.column(c).to_pylist() for c in ("bucket", "halo", "doc_id")]
        for row in zip(*cols, batch.column("text")):
            row = (*row[:3], row[3].as_py() or "")
            if held and held[-1][1] and row[1] and held[-1][0] == row[0]:
                continue  # a range's next document is the first that is sent
            held.append(row)
        done = _rows(held, hasher)
        held = held[-1:]
        if done:
            yield out(done)


def _ordered(docs: DataFrame) -> DataFrame:
    """Rows (bucket, halo, doc_id, text) dealt by range and in order; the first row of the next range follows as a halo."""
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, F.lit(10 * n)).alias("q")).first()["q"] if shares else None
    bounds = np.unique(np.array(bounds or [], dtype=np.int64))
    last = len(bounds)

    def number(ids: pd.Series) -> np.ndarray:
        known = ids.notna().to_numpy()
        return np.where(known, np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), side="right"), last)

    def numbers(ids: pd.Series) -> pd.Series:
        return pd.Series(number(ids))

    bucket = F.pandas_udf(numbers, LongType())
    # a row per range: at most as many as there are shuffle partitions
    least = {r.bucket: r.least for r in docs.select("doc_id", bucket("doc_id").alias("bucket")).groupBy("bucket").agg(F.min("doc_id").alias("least")).collect()}
    filled = sorted(least)
    before = {b: filled[i - 1] for i, b in enumerate(filled)}

    def places(ids: pd.Series) -> pd.DataFrame:
        own = number(ids)
        heads = [before[b] if (pd.isna(i) and least[b] is None) or i == least[b] else None for i, b in zip(ids, own)]
        return pd.DataFrame({"bucket": own, "sent": pd.array(heads, dtype="Int64")})

    place = F.pandas_udf(places, StructType([StructField("bucket", LongType()), StructField("sent", LongType())]))
    at = docs.select("doc_id", "text").withColumn("at", place("doc_id"))
    both = F.array_compact(F.array(F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("halo")),
                                   F.when(F.col("at.sent").isNotNull(), F.struct(F.col("at.sent").alias("bucket"), F.lit(True).alias("halo")))))
    dealt = at.select("doc_id", "text", F.explode(both).alias("x")).select("x.bucket", "x.halo", "doc_id", "text")
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "halo", F.col("doc_id").asc_nulls_last(), "text")


def compared(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    arrow_batches(docs.sparkSession)
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_chars", LongType()), *(StructField(c, StringType()) for c in _NAMES[2:5]),
                         StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])
    return _ordered(docs).mapInArrow(_compare, schema)


def _digest(text: bytes) -> bytes:
    """What texts of equal words have in common: 128 bits."""
    return hashlib.sha256(b" ".join(text.split())).digest()[:16]


def _described(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    hasher, wide = Hasher(), PERMUTATIONS // BANDS
    for batch in texts:
        rows = [normal(t) for t in batch]
        bands = []
        for row in hasher.signatures(rows):
            bands.append([int.from_bytes(hashlib.blake2b(bytes([b]) + row[b * wide : (b + 1) * wide].tobytes(), digest_size=8).digest(), "big", signed=True) for b in range(BANDS)])
        yield pd.DataFrame({"words": [_digest(t) for t in rows], "blank": [not t.strip() for t in rows], "fp": [fingerprint(t) for t in rows], "bands": bands})


def _digests(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([_digest(normal(t)) for t in batch], dtype=object)


def _sets(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    hasher = Hasher()
    for batch in texts:
        out = []
        for text in batch:
            found = [hasher.shingles([p])[0] for p in _parts(normal(text))]
            out.append(np.unique(np.concatenate(found).astype(np.uint32).view(np.int32)))
        yield pd.Series(out, dtype=object)


def _across(apart: DataFrame, like: float) -> DataFrame:
    """Pairs (a, b) of different roots among ``apart`` (head, root, shingles) that may be as like as ``like``.

    Two sets that like each other have a shingle in common among the rarest of each, all but ceil(like * size) - 1 of them, so
    only those are joined: what thousands of texts share is not among them while the texts have enough of their own.
    """
    size = F.size("shingles").alias("size")
    each = apart.select("head", "root", size, F.explode("shingles").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("head").orderBy("often", "s"))
    rare = each.join(often, "s").withColumn("place", place).filter(F.col("place") <= F.col("size") - F.ceil(F.col("size") * like - 1e-9) + 1)
    rare = rare.filter("often > 1").select("s", "head", "root", "size")
    pairs = rare.select("s", F.col("head").alias("a"), F.col("root").alias("ra"), F.col("size").alias("x")).join(
        rare.select("s", F.col("head").alias("b"), F.col("root").alias("rb"), F.col("size").alias("y")), "s")
    return pairs.filter((F.col("ra") < F.col("rb")) & (F.least("x", "y") >= like * F.greatest("x", "y") - 1e-9)).select("a", "b").distinct()


def _rooted(docs: DataFrame, like: float) -> DataFrame:
    """doc_id, words (a digest) and root (the least digest that links lead to) of every row."""
    arrow_batches(docs.sparkSession)
    work = Work(docs.sparkSession, "minhash")
    kinds = [("words", BinaryType()), ("blank", BooleanType()), ("fp", LongType()), ("bands", ArrayType(LongType()))]
    of = F.pandas_udf(_described, StructType([StructField(*k) for k in kinds]))
    rows = work.store(docs.select("doc_id", of("text").alias("d")).select("doc_id", "d.*"))
    classes = work.store(rows.filter("NOT blank").groupBy(F.col("words").alias("head")).agg(F.first("fp").alias("fp"), F.first("bands").alias("bands")))
    balls = simhash.linked_fingerprints(classes.select("fp").distinct(), work)

    def held(buckets: DataFrame) -> DataFrame:
        w = Window.partitionBy("bucket")
        return buckets.withColumns({"low": F.min("head").over(w), "high": F.max("head").over(w)}).filter("low <> high")

    buckets = classes.select("head", F.explode("bands").alias("bucket")).unionByName(
        classes.groupBy("fp").agg(F.collect_set("head").alias("heads")).join(balls, F.col("fp") == F.col("node"), "left")
        .select(F.explode("heads").alias("head"), F.xxhash64(F.lit("ball"), F.coalesce("root", "fp")).alias("bucket")))
    shared = work.store(held(buckets))
    stars = work.store(shared.select(F.col("low").alias("a"), F.col("head").alias("b")).unionByName(
        shared.select(F.col("head").alias("a"), F.col("high").alias("b"))).filter("a <> b").distinct())
    ends = stars.select(F.explode(F.array("a", "b")).alias("head")).distinct()
    texts = docs.select(F.pandas_udf(_digests, BinaryType())("text").alias("head"), "text").groupBy("head").agg(F.first("text").alias("text"))
    sets = work.store(texts.join(ends, "head", "left_semi").select("head", F.pandas_udf(_sets, ArrayType(IntegerType()))("text").alias("shingles")))

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("head").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("head").alias("b"), F.col("shingles").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return both.filter(common >= like * (F.size("x") + F.size("y") - common) - 1e-9).select("a", "b")

    first = components(verified(stars), work)
    rooted = shared.select("head", "bucket").join(first, F.col("head") == F.col("node"), "left").select("bucket", "head", F.coalesce("root", "head").alias("root"))
    w = Window.partitionBy("bucket")
    apart = rooted.withColumns({"lo": F.min("root").over(w), "hi": F.max("root").over(w)}).filter("lo <> hi").select("head", "root").distinct()
    more = verified(work.store(_across(work.store(apart.join(sets, "head")), like)))
    roots = components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more), work)
    return rows.select("doc_id", "words").join(roots, F.col("words") == F.col("node"), "left").select("doc_id", "words", F.coalesce("root", "words").alias("root"))


def near_groups(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """doc_id and class_id (least doc_id reachable over pairs of Jaccard likeness ``like`` or more) of every row."""
    work = Work(docs.sparkSession, "minhash")
    rows = work.store(_rooted(docs, like))
    return rows.join(rows.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("doc_id", "class_id")


def keep_one(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """Rows of ``docs`` with one row of each group left: that with the least doc_id (nulls last), then the least by all its columns."""
    work = Work(docs.sparkSession, "minhash")
    key = [F.col("doc_id").isNull().alias("__lost"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id")]
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "words")).alias("x")
    kept = work.store(_rooted(docs, like).groupBy("root").agg(least).select("x.doc_id", F.col("x.words").alias("__words")).select(*key, "__words"))
    names = ["__words", "__lost", "__id"]
    mine = docs.select("*", F.pandas_udf(_digests, BinaryType())("text").alias("__words"), *key).join(kept, names, "left_semi")
    return mine.groupBy(*names).agg(F.min(F.struct(*pick(docs, *docs.columns))).alias("row")).select("row.*")
