"""Metadata-driven ingestion: jobs, their tasks, and running them."""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.settings import RunContext
from lakestrata.sources import files, tables

JOBS = "job_id bigint, source_name string, sink_schema string"
TASKS = "job_id bigint, task_id bigint, task_switch string, source_config string, sink_table string"

# The switches a task may carry.
CSV_SWITCHES = ("BLOB_CSV", "ADLS_CSV")
JSON_SWITCHES = ("BLOB_JSON", "ADLS_JSON")


def registry(spark: SparkSession, jobs: list[tuple], tasks: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """Job and task tables; a task's configuration is kept as a VARIANT document."""
    j = tables.values(spark, jobs, JOBS)
    t = tables.values(spark, [(a, b, c, json.dumps(d) if isinstance(d, dict) else d, e) for a, b, c, d, e in tasks], TASKS)
    return j, t.withColumn("source_config", F.parse_json("source_config"))


def resolve_tasks(jobs: DataFrame, tasks: DataFrame, sink_database: str, job_id: int | None = None) -> DataFrame:
    """Tasks with their job, cleaned sink names and the sink database, in task order."""
    joined = jobs.join(tasks, "job_id").select(
        "job_id",
        "task_id",
        "task_switch",
        "source_name",
        "source_config",
        F.lit(sink_database).alias("sink_database"),
        F.upper(F.trim("sink_schema")).alias("sink_schema"),
        F.trim("sink_table").alias("sink_table"),
    )
    if job_id is not None:
        joined = joined.filter(F.col("job_id") == job_id)
    return joined.orderBy("task_id")


def run_task(spark: SparkSession, task, root: str, ctx: RunContext, mode: str = "overwrite",
             columns: list[str] | None = None, only: list[str] | None = None) -> str:
    """Land one resolved task (or ``only`` some of its files) and return the table it went to."""
    config = json.loads(task["source_config"])
    path = only or files.source_path(root, config)
    if task["task_switch"] in CSV_SWITCHES:
        df = files.land_csv(spark, path, config, ctx, task["source_name"], columns)
    elif task["task_switch"] in JSON_SWITCHES:
        df = files.ingest_json(spark, path, bool(config.get("multi_line", False)))
    else:
        raise ValueError(f"task {task['task_id']}: unknown switch {task['task_switch']!r}")
    sink = sink_of(task)
    (tables.overwrite if mode == "overwrite" else tables.append)(df, sink)
    return sink


def sink_of(task) -> str:
    return f"{task['sink_database']}__{task['sink_schema']}.{task['sink_table']}"


class LandingFailed(RuntimeError):
    """Some tasks failed; the others have landed and are recorded."""


@dataclass(frozen=True)
class _File:
    path: str
    listed: str  # length and time, as the store lists them


class LandingRecord:
    """Which files each sink holds, so that a later run lands only what is new or has changed.

    A file whose length and time are those recorded is taken as unchanged
    without being read. Otherwise its content is summed up (a checksum over
    its lines that does not depend on their order), and a file that was only
    rewritten or touched is still unchanged. The record is a small table; a
    task is recorded when it has landed, so after a failure only tasks that
    did not land run again. If the program ends between landing and
    recording, an appending task lands its files twice.
    """

    SCHEMA = "sink string, file string, listed string, content string, run_id string, number bigint"

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self._lock = Lock()

    def known(self, sink: str) -> dict[str, tuple[str, str]]:
        """Listing and content checksum of each file that a sink holds: one row per file of one source."""
        if not tables.exists(self.spark, self.name):
            return {}
        latest = F.max(F.struct("number", "listed", "content")).alias("x")
        rows = self.spark.table(self.name).filter(F.col("sink") == sink).groupBy("file").agg(latest).select("file", "x.*").collect()
        return {r["file"]: (r["listed"], r["content"]) for r in rows if r["content"] is not None}

    def found(self, path: str) -> list[_File]:
        """Files under a path, as the store lists them."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        store = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        listing, out = store.listFiles(where, True), []
        while listing.hasNext():
            f = listing.next()
            name = f.getPath().getName()
            if not name.startswith(("_", ".")):
                out.append(_File(f.getPath().toString(), f"{f.getLen()}:{f.getModificationTime()}"))
        return sorted(out, key=lambda f: f.path)

    def contents(self, paths: list[str]) -> dict[str, str]:
        """A checksum of each file's lines: one row per file."""
        lines = self.spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.xxhash64("value").alias("a"), F.xxhash64(F.lit(1), "value").alias("b"))
        halves = [F.sum(part) for h in ("a", "b") for part in (F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
        sums = lines.groupBy("file").agg(F.concat_ws(":", F.count(F.lit(1)), *halves).alias("content"))
        named = {_plain(r["file"]): r["content"] for r in sums.collect()}
        return {p: named.get(_plain(p), "0") for p in paths}

    def changes(self, sink: str, path: str) -> tuple[list[str], list[tuple[str, str, str]], bool]:
        """Files to land, record rows of all files (file, listing, content), and whether a recorded file has gone."""
        known, found = self.known(sink), self.found(path)
        unsure = [f.path for f in found if known.get(f.path, ("", ""))[0] != f.listed]
        content = self.contents(unsure) if unsure else {}
        changed = [p for p in unsure if known.get(p, ("", ""))[1] != content[p]]
        rows = [(f.path, f.listed, content.get(f.path) or known[f.path][1]) for f in found]
        return changed, rows, bool(set(known) - {f.path for f in found})

    def keep(self, sink: str, rows: list[tuple[str, str, str]], run_id: str) -> None:
        with self._lock:
            old = self.spark.table(self.name).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] if tables.exists(self.spark, self.name) else 0
            gone = [(f, "", None) for f in set(self.known(sink)) - {r[0] for r in rows}]
            tables.append(self.spark.createDataFrame([(sink, *r, run_id, old + 1) for r in [*rows, *gone]], self.SCHEMA), self.name)


def _plain(path: str) -> str:
    """A path as listings and readers both write it."""
    return re.sub("^file:/+", "/", unquote(path))


def run_tasks(spark: SparkSession, resolved: DataFrame, root: str, ctx: RunContext, mode: str = "overwrite",
              columns: dict[str, list[str]] | None = None, parallel: int = 4, record: LandingRecord | None = None) -> list[str]:
    """Land every task, ``parallel`` at a time, so that a job of many small files fills the cluster; returns the sinks written.

    Only the registry rows come to the driver; each read and write is a Spark
    job of its own.  With a ``record``, tasks without new or changed files are
    skipped; a sink that is overwritten is landed whole if any file differs,
    one that is appended to gets the new and changed files.  A task that fails
    does not keep the others from landing; the error then names it.
    """
    ctx = ctx.pinned()
    todo = resolved.withColumn("source_config", F.to_json("source_config")).collect()

    def land(task) -> str | None:
        named = (columns or {}).get(task["sink_table"])
        if record is None:
            return run_task(spark, task, root, ctx, mode, named)
        sink = sink_of(task)
        changed, rows, gone = record.changes(sink, files.source_path(root, json.loads(task["source_config"])))
        if changed or gone and mode == "overwrite":
            run_task(spark, task, root, ctx, mode, named, changed if mode == "append" else None)
        elif {(f, listed) for f, listed, _ in rows} == {(f, listed) for f, (listed, _) in record.known(sink).items()}:
            return None
        record.keep(sink, rows, ctx.run_id)
        return sink if changed or gone else None

    def tried(task) -> tuple[str | None, Exception | None]:
        try:
            return land(task), None
        except Exception as e:  # noqa: BLE001  told below, once all tasks have run
            return None, e

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        done = list(pool.map(tried, todo))
    failed = [(t["task_id"], e) for t, (_, e) in zip(todo, done) if e]
    if len(failed) == 1 and record is None:
        raise failed[0][1]
    if failed:
        raise LandingFailed("; ".join(f"task {n}: {str(e).splitlines()[0][:300]}" for n, e in failed)) from failed[0][1]
    return [sink for sink, _ in done if sink]
