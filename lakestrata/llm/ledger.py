"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

Every version of every path is content-addressed (SHA-256 of its text). The ledger holds, for each blob and rule version, what
the rule found; only pairs that it does not hold yet are scanned. Findings are joined back to all paths by content address.

Copies cost nothing: the least row of each address is chosen by an aggregate over addresses alone, combined before its
shuffle, and only the chosen rows' texts are scanned, where they lie once a join by row key has marked them.

A rule is a Java regular expression and, if what is required of a match is more than the expression says, a condition on the
match. Positions come from splitting the text at the matches: the lengths of the parts between and of the matches add up to
starts and ends, in code points. Texts without a match, told by one search, are not split.

Edge cases. Null texts are empty blobs. Repeated rows are versions with equal content. Null paths are paths of their own. An
empty table gives empty findings and adds nothing to the ledger. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import Work


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    condition: Callable[[Column], Column] | None = None
    base: bool = True


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

#: In the order in which spans that start together are listed. A run that is too short can't hold a match that is long enough,
#: so the least length stands in the pattern of access and hex; a short assignment may swallow another, so it is dropped after.
RULES = (
    Rule("assign", 1, _ASSIGN, lambda m: F.length(F.regexp_extract(m, _ASSIGN, 2)) >= 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----", base=False),
)

#: Matches of a block of a text with many.
BLOCK = 256

LEDGER = "sha256 string, kind string, version int, spans array<struct<start:int,end:int>>"


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def matches(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of the rule's matches in ``text``."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    # positions by a running sum; each step looks at one match and what lies before it. An array is copied where it grows, so
    # matches are placed within blocks first, and the blocks then one behind the other
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["before"])
        end = start + F.length(x["text"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["text"].alias("text")))).alias("out"))

    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("before"), found.alias("text"))
    def blocks(p: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(p) - 1, F.lit(0)) / BLOCK).cast("int"))
        return F.transform(numbers, lambda i: F.aggregate(F.slice(p, i * BLOCK + 1, F.lit(BLOCK)), zero, step))

    def behind(state: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda m: F.struct((m["start"] + state["at"]).alias("start"), (m["end"] + state["at"]).alias("end"), m["text"].alias("text")))
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], moved).alias("out"))

    # the pairs are bound to a name, or they would be made anew for each block
    placed = F.transform(F.array(pairs), lambda p: F.aggregate(F.filter(blocks(p), lambda b: F.size(b["out"]) > 0), zero, behind, lambda s: s["out"]))[0]
    if rule.condition is not None:
        placed = F.filter(placed, lambda m: rule.condition(m["text"]))
    spans = F.transform(placed, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def scan(blobs: DataFrame, rules=RULES, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger rows of all pairs of a blob (sha256, text) and a rule that ``ledger`` does not hold yet.

    Each blob's pending rules are told by one anti-join of narrow pairs, before any text is searched.
    """
    if ledger is None:
        pending = blobs.withColumn("pending", F.array(*[F.lit(r.kind) for r in rules]))
    else:
        done = ledger.groupBy("sha256").agg(F.collect_set(F.struct("kind", "version")).alias("done"))  # a rule's versions bound it
        of = [F.when(~F.coalesce(F.array_contains("done", F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))), F.lit(False)), F.lit(r.kind)) for r in rules]
        pending = blobs.join(done, "sha256", "left").withColumn("pending", F.array_compact(F.array(*of))).filter(F.size("pending") > 0)
    text = F.coalesce("text", F.lit(""))
    rows = F.array(*[
        F.when(F.array_contains("pending", r.kind), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), matches(text, r).alias("spans")))
        for r in rules
    ])
    return pending.select("sha256", F.explode(F.array_compact(rows)).alias("f")).select("sha256", "f.kind", "f.version", "f.spans")


def unseen(versions: DataFrame, rules=RULES, ledger: DataFrame | None = None) -> DataFrame:
    """One row (sha256, text) for each content address of ``versions`` (path, text) that a rule has yet to look at."""
    # the row key has no nulls, so that join and aggregate below share one shuffle of the texts
    key = F.coalesce(F.concat(F.lit("="), F.col("path").cast("string")), F.lit("null"))
    addressed = versions.select(key.alias("key"), "text", address(F.col("text")).alias("sha256"))
    first = addressed.groupBy("sha256").agg(F.min("key").alias("key"))
    if ledger is not None:
        wanted = [(r.kind, r.version) for r in rules]
        known = ledger.filter(" OR ".join(f"(kind = '{k}' AND version = {v})" for k, v in wanted)).groupBy("sha256").agg(
            F.count_distinct("kind").alias("n")).filter(F.col("n") == len(wanted))
        first = first.join(known, "sha256", "left_anti")
    marked = addressed.join(first, ["sha256", "key"])
    # a path may hold one content in several rows; one of them is enough
    return marked.groupBy("sha256", "key").agg(F.first("text").alias("text")).select("sha256", "text")


def findings(versions: DataFrame, rules=RULES, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The findings of every row of ``versions`` (path, text): path, sha256, found (kind, version, spans by rule); and the ledger as it is now.

    Blobs without findings have ledger rows too, with no spans, so they are not scanned again.
    """
    work = Work(versions.sparkSession, "ledger")
    new = work.store(scan(unseen(versions, rules, ledger), rules, ledger))
    now = new if ledger is None else ledger.unionByName(new)
    current = " OR ".join(f"(kind = '{r.kind}' AND version = {r.version})" for r in rules)
    hits = now.filter(current).filter(F.size("spans") > 0).groupBy("sha256").agg(F.collect_list(F.struct("kind", "version", "spans")).alias("found"))
    paths = versions.select("path", address(F.col("text")).alias("sha256"))
    return paths.join(hits, "sha256", "left").select("path", "sha256", F.coalesce("found", F.array().cast(hits.schema["found"].dataType)).alias("found")), now


def listed(found: Column, kinds: list[str]) -> Column:
    """kind:start:end of all spans of the kinds, by start, then by the kinds' order, comma-joined."""
    at = F.array(*[F.lit(k) for k in kinds])
    spans = F.flatten(F.transform(F.filter(found, lambda x: F.array_contains(at, x["kind"])), lambda x: F.transform(
        x["spans"], lambda s: F.struct(s["start"].alias("start"), F.array_position(at, x["kind"]).alias("rank"), s["end"].alias("end")))))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(at, s["rank"].cast("int")), s["start"].cast("string"), s["end"].cast("string"))))


def count(found: Column, kind: str) -> Column:
    return F.aggregate(F.filter(found, lambda x: x["kind"] == kind), F.lit(0).cast("long"), lambda n, x: n + F.size(x["spans"]))
