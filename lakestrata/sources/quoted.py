"""Delimited files with line breaks inside quotes, parsed by many tasks.

Spark reads such a file in one task, since a range of bytes does not show whether its first line starts a record or goes on
inside a quoted field. Here the lines are read by range, and two facts are settled first:

1. Per range, what it does to the quote state: where it ends if it begins outside, and if it begins inside, quotes. Lines without
   a quote change nothing and are not looked at. That is one row per range; their composition in file order gives each
   range's true entry state. The driver holds those rows, as it holds the list of ranges itself.
2. With it each range cuts its lines into records apart. A record that runs over a range's end leaves a tail there and a head in
   each range after it, up to the one where it ends; these few pieces are put together by file and place.

Whole records are then parsed by ``from_csv``, with the options of the reader, so rows are those of the one-task reader. Quotes
count as a parser reads them: they open a field only at its start, are doubled inside, and may stand unescaped in a plain field.
Nothing but pieces is shuffled. Line ends are LF or CRLF, and the text is UTF-8. A quoted field that is never closed runs to the
end of its file, without the file's last line end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTE = '"'
#: Lines taken out of a batch at a time, and the characters of records in one output batch: what a task holds of the files.
_ROWS = 512
_CHARS = 1 << 20
_KEY = "file string, block long"


def inside_after(line: str, inside: bool, sep: str) -> bool:
    """Whether a line that begins inside (or outside) a quoted field ends inside one."""
    at = 0
    while True:
        if inside:
            at = line.find(_QUOTE, at)
            if at < 0:
                return True
            if line.startswith(_QUOTE, at + 1):
                at += 2
                continue
            inside = False
            at += 1
        elif line.startswith(_QUOTE, at):
            inside = True
            at += 1
            continue
        # the rest of a plain field, or what stands behind a closing quote
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, block (the first byte of the range) and value of each line; in file order within a range."""
    text = spark.read.option("lineSep", "\n").text(path)
    first = F.col("_metadata.file_block_start")
    value = F.when(first == 0, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    return text.select(F.col("_metadata.file_path").alias("file"), first.alias("block"), value.alias("value"))


def _effects(sep: str):
    """Per range: the state at its end for an entry outside and inside quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends = None, (False, True)
        done: list[tuple] = []
        for batch in batches:
            files, blocks, values = batch.column("file"), batch.column("block").to_pylist(), batch.column("value")
            # rows where the range changes, and rows with a quote; all others have no effect
            turns = [i for i in range(batch.num_rows) if i == 0 or blocks[i] != blocks[i - 1] or (blocks[i] == 0 and files[i] != files[i - 1])]
            quoted = values.is_valid().to_numpy(zero_copy_only=False).nonzero()[0].tolist()
            for i in sorted({*turns, *quoted}):
                here = (files[i].as_py(), blocks[i])
                if here != key:
                    if key is not None:
                        done.append((*key, *ends))
                    key, ends = here, (False, True)
                line = values[i].as_py()
                if line is not None:
                    ends = (inside_after(line, ends[0], sep),) * 2 if ends[0] == ends[1] else tuple(inside_after(line, e, sep) for e in ends)
        if key is not None:
            done.append((*key, *ends))
        yield _batch(done, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()), ("file", "block", "from_outside", "from_inside"))

    return run


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _batch(rows: list[tuple], kinds: tuple, names: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


def _cut(sep: str, pieces: bool):
    """Whole records of each range, or (``pieces``) only its head and tail."""
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
    names = ("file", "block", "starts", "header", "after_cr", "record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, inside, head, top, cr = None, [], False, False, False, False
        out: list[tuple] = []
        chars = 0

        def left() -> None:
            """What the range's end cuts off."""
            if held and pieces:
                out.append((*key, not head, top, cr, "\n".join(held)))

        for batch in _some(batches):
            files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_pylist()
            names_of, codes = files.dictionary.to_pylist(), files.indices.to_pylist()
            for code, block, entry, line in zip(codes, blocks, batch.column("inside").to_pylist(), batch.column("value").to_pylist()):
                here = (names_of[code], block)
                if here != key:
                    left()
                    key, held, inside, head, top, cr = here, [], entry, entry, block == 0, False
                held.append(line)
                if inside or _QUOTE in line:
                    inside = inside_after(line, inside, sep)
                if not inside:
                    if head == pieces:
                        if len(held) > 1:
                            line = "\n".join(held)
                        out.append((*key, not head, top, cr, line))
                        chars += len(line)
                    cr, head, top, held = line.endswith("\r"), False, False, []
                    if chars >= _CHARS or len(out) >= 8 * _ROWS:
                        yield _batch(out, kinds, names)
                        out, chars = [], 0
        left()
        yield _batch(out, kinds, names)

    return run


_RECORD = f"{_KEY}, starts boolean, header boolean, after_cr boolean, record string"


def records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """header (whether it is the first of its file) and record (its text, without the line end) of every record of the files."""
    lines = _lines(spark, path)
    quoted = lines.select("file", "block", F.when(F.contains("value", F.lit(_QUOTE)), F.col("value")).alias("value"))
    effects = quoted.mapInArrow(_effects(sep), f"{_KEY}, from_outside boolean, from_inside boolean")
    # one row per range of the files
    entries, state, file = [], False, None
    for r in sorted(effects.collect(), key=lambda r: (r["file"], r["block"])):
        state = state if r["file"] == file else False
        file, after = r["file"], r["from_inside"] if state else r["from_outside"]
        entries.append((r["file"], r["block"], state, state or after))
        state = after
    # bounded: one short row per range
    known = spark.createDataFrame(entries, f"{_KEY}, inside boolean, cut boolean")
    whole = lines.join(F.broadcast(known.drop("cut")), ["file", "block"]).select("file", "block", "inside", "value").mapInArrow(_cut(sep, False), _RECORD)
    out = whole.select("header", "after_cr", "record")
    if any(cut for *_, cut in entries):
        some = lines.join(F.broadcast(known.filter("cut").drop("cut")), ["file", "block"]).select("file", "block", "inside", "value")
        pieces = some.mapInArrow(_cut(sep, True), _RECORD)
        number = F.sum(F.col("starts").cast("long")).over(Window.partitionBy("file").orderBy("block", "starts"))
        ordered = F.array_sort(F.collect_list(F.struct("block", "starts", "header", "after_cr", "record")))
        joined = pieces.withColumn("number", number).groupBy("file", "number").agg(ordered.alias("p"))
        out = out.unionByName(joined.select(F.col("p")[0]["header"].alias("header"), F.col("p")[0]["after_cr"].alias("after_cr"),
                                            F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    # line breaks inside quotes read as LF where records end in CRLF; a file's last record may lack its line end
    ends = F.endswith("record", F.lit("\r"))
    plain = F.when(ends, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    record = F.when(ends | F.col("after_cr"), F.replace(plain, F.lit("\r\n"), F.lit("\n"))).otherwise(plain)
    return out.select("header", record.alias("record")).filter("record <> ''")


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def _named(record: Column, names: list[str], options: dict) -> Column:
    """Whether a header record names the columns in their order."""
    fields = [f"c{i}" for i in range(len(names))]
    read = F.from_csv(record, _ddl(fields), options)
    return F.array(*[F.lower(read[f]) for f in fields]) == F.array(*[F.lit(n.lower()) for n in names])


def read_quoted(spark: SparkSession, path: str | list[str], schema: T.StructType, options: dict, header: bool = True) -> DataFrame:
    """Rows of the files as text columns; ``options`` are those of Spark's own reader. A header must name the columns in their order."""
    given = {k: str(options[k]) for k in ("sep", "escape", "mode") if k in options}
    rows = records(spark, path, options.get("sep", ","))
    if header:
        wrong = F.concat(F.lit("the header does not name the columns in their order: "), "record")
        loose = {**given, "mode": "PERMISSIVE"}
        rows = rows.filter(F.when(F.col("header"), F.assert_true(_named(F.col("record"), schema.fieldNames(), loose), wrong).isNotNull()).otherwise(True))
    return rows.select(F.from_csv("record", _ddl(schema.fieldNames()), given).alias("row")).select("row.*")
