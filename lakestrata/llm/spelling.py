"""Spelling variant groups: words one edit apart, by dynamic programming down a sorted list.

Words and counts. Words are runs of ASCII letters and U+00C0 to U+00FF, with A-Z lower-cased. A run whose hash with its doc_id is
a multiple of 199 loses one letter first (the contract's noise). Words of at least ``shortest`` letters and ``least`` occurrences
are kept; counts are collapsed per worker, then summed by Spark.

Blocks. Let s be the shorter length of two words one edit apart and p their first difference (at most s - 1). If p lies in the
block [a, b) of the places below s, the words share their first a letters and their last s - b. So each word goes, once as the
shorter (s = its length) and once as the longer (s = its length - 1), to the group of the head and tail that each block leaves; at first
the blocks are the two halves. A group of more than ``hot`` words is dealt anew with its block cut in half, until groups are
small or blocks are single places; those differ in one place only, so the alphabet bounds them. Each pair is counted in the one
block that holds p.

Within a group the words, without head and tail, are a sorted list with the lengths of adjacent common prefixes. Each word of
length s is compared with the list from top to bottom: a word of the list keeps the rows of the edit matrix for what it shares with
the word before, and computes the others, in a band as wide as one edit allows. Once a row exceeds one edit, everything that shares the
prefix up to it is skipped by bisection. Both words of a pair are credited when it is found: words of length s among themselves,
and longer words through the shorter. A group gives one row per word, never its pairs.

Forms. A word's form is its near word of most occurrences, if these are at least ``ratio`` times its own. Counts grow by that
factor along a chain of forms, so the roots are found by a few doubling joins.

Edge cases. Null texts have no words; a null doc_id is hashed as the text "null". Repeated rows count again. Ties for a form go to
the smallest word. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import Work, arrow_batches

SHORTEST = 6
LEAST = 5
RATIO = 5
#: A run loses a letter if this divides its hash.
NOISE = 199
#: Words of a group that is not dealt anew.
HOT = 4096
#: Words that a worker counts before it hands them on.
MEMORY = 400_000
_OUT = 1 << 16

_LAST = chr(0x10FFFF)
#: Row of the banded matrix: edits with one letter less, and with equally many letters, of the shorter word; 2 stands for more than one.
_FIRST_ROW = (2, 0)


def corrupted(doc_id, run: str) -> str:
    """The run as it is counted in a document."""
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(shortest: int):
    find = re.compile("[A-Za-zÀ-ÿ]{%d,}" % shortest).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words, n = list(counts), list(counts.values())
            for a in range(0, len(words), _OUT):
                yield pa.RecordBatch.from_arrays([pa.array(words[a : a + _OUT], pa.string()), pa.array(n[a : a + _OUT], pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                lowered = (text.as_py() or b"").lower().decode()  # on bytes: only A-Z
                for word, n in Counter(find(lowered)).items():
                    counts[corrupted(doc_id, word)] += n
            if len(counts) > MEMORY:
                yield from out()
                counts.clear()
        yield from out()

    return run


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n: words of at least ``shortest`` letters and ``least`` occurrences over all of ``docs`` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(_counted(shortest), "word string, n long")
    return counts.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _next_row(row: tuple[int, int], letter: str, word: str, at: int) -> tuple[int, int]:
    """The banded row below ``row``, after ``letter`` at place ``at`` of the list's word."""
    less, equal = row
    one = min(less + (letter != word[at - 1]) if at else 2, equal + 1, 2)
    two = min(equal + (letter != word[at]), 2) if at < len(word) else 2
    return one, two


def near(words: list[str], shared: list[int], word: str, within: int) -> Iterator[int]:
    """Places in the sorted list ``words`` of those one edit from ``word`` whose first difference is before ``within``.

    ``shared`` holds the lengths of adjacent common prefixes. The list's words are as long as ``word`` or one letter longer.
    """
    rows, i, depth = [_FIRST_ROW], 0, 0
    size = len(word)
    while i < len(words):
        other = words[i]
        while depth < len(other):
            row = _next_row(rows[depth], other[depth], word, depth)
            depth += 1
            del rows[depth:]
            if row[0] > 1 and row[1] > 1:
                break
            rows.append(row)
        else:
            less, equal = rows[depth]
            if (equal if len(other) == size else less) == 1 and _first_difference(word, other) < within:
                yield i
            i += 1
            if i < len(words):
                depth = min(depth, shared[i])
            continue
        # nothing that begins with these letters is near
        j = bisect_left(words, other[:depth] + _LAST, i + 1)
        if j < len(words):
            depth = shared[j] if j == i + 1 else _first_difference(other, words[j])
        i = j


def _first_difference(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return len(a)


def _best(one: tuple[int, str] | None, n: int, word: str) -> tuple[int, str]:
    return (n, word) if one is None or (-n, word) < (-one[0], one[1]) else one


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (s, a, b, head, tail, word, n) in the order of their groups; one row (word, n_near, form_n, form) per word with near words."""
    out: list[tuple] = []
    group: list[tuple[str, int]] = []
    key = None

    def closed() -> None:
        s, a, b, _, tail = key
        if len(group) < 2:
            return
        middle = sorted((w[a : len(w) - len(tail)], w, n) for w, n in group)
        words = [m for m, _, _ in middle]
        shared = [0, *map(_first_difference, words, words[1:])]
        count, best = [0] * len(words), [None] * len(words)
        within = b - a + (b == s)  # a letter put at the very end differs behind the last place
        for i, (m, word, n) in enumerate(middle):
            if len(m) > b - a:
                continue
            for j in near(words, shared, m, within):
                _, other, k = middle[j]
                count[i], best[i] = count[i] + 1, _best(best[i], k, other)
                if len(other) > len(word):
                    count[j], best[j] = count[j] + 1, _best(best[j], n, word)
        out.extend((word, c, *x) for (_, word, _), c, x in zip(middle, count, best) if c)

    def batch() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "form_n", "form"])

    for rows in batches:
        names = ("s", "a", "b", "head", "tail", "word", "n")
        for s, a, b, head, tail, word, n in zip(*(rows.column(c).to_pylist() for c in names)):
            if key != (s, a, b, head, tail):
                if key:
                    closed()
                key, group = (s, a, b, head, tail), []
            group.append((word, n))
        if len(out) > _OUT:
            yield batch()
            out = []
    if key:
        closed()
    yield batch()


_KEY = ["s", "a", "b", "head", "tail"]


def _keyed(blocks: DataFrame) -> DataFrame:
    """Rows (word, n, s, a, b) with the group that the block leaves."""
    head = F.expr("substring(word, 1, a)")
    tail = F.expr("substring(word, char_length(word) - (s - b) + 1, s - b)")
    return blocks.select("s", "a", "b", head.alias("head"), tail.alias("tail"), "word", "n")


def _halves(a: str, b: str):
    """The two halves of the block [a, b)."""
    middle = f"({a} + {b}) div 2"
    return F.expr(f"explode(array(struct(int({a}) AS a, int({middle}) AS b), struct(int({middle}) AS a, int({b}) AS b)))")


def near_words(words: DataFrame, work: Work, hot: int = HOT) -> DataFrame:
    """word, n_near, form_n, form: near words' number and the most frequent, of every word of ``words`` (word, n) that has any."""
    sizes = words.select("word", "n", F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("s")).filter("s > 0")
    keyed = work.store(_keyed(sizes.select("word", "n", "s", _halves("0", "s").alias("x")).select("word", "n", "s", "x.a", "x.b")))
    levels = []
    while True:
        large = work.store(keyed.groupBy(*_KEY).count().filter((F.col("count") > hot) & (F.col("b") - F.col("a") > 1)).drop("count"))
        if large.isEmpty():
            levels.append(keyed)
            break
        levels.append(keyed.join(large, _KEY, "left_anti"))
        cut = keyed.join(large, _KEY, "left_semi").select("word", "n", "s", _halves("a", "b").alias("x"))
        keyed = work.store(_keyed(cut.select("word", "n", "s", "x.a", "x.b")))
    grouped = levels[0]
    for level in levels[1:]:
        grouped = grouped.unionByName(level)
    found = grouped.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(_groups, "word string, n_near long, form_n long, form string")
    first = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("x"))
    return best.select("word", "n_near", (-F.col("x.n")).alias("form_n"), "x.form")


def roots(forms: DataFrame, work: Work) -> DataFrame:
    """word, root: the end of the chain of forms of every word in ``forms`` (word, form)."""
    chain = work.store(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = work.store(chain.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        chain = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return chain


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text)."""
    work = Work(docs.sparkSession, "spelling")
    words = work.store(vocabulary(docs, shortest, least))
    joined = words.join(near_words(words, work, hot), "word", "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    table = work.store(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")))
    ends = roots(table.filter("form IS NOT NULL").select("word", "form"), work)
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
