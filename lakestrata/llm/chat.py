"""Chat formatting into budgeted windows, with DataFrame functions only.

Turns of a conversation are laid end to end by their token counts. A prefix sum says where each begins; windows are strides of
that line, so every turn is new in exactly one window and is never cut. Each later window opens with the system turn and with
the last turns of the window before that fit into ``history`` tokens. Assistant texts are targets where they are new; repeated
ones are masked.

The stride is budget - system - history - longest turn, and a quarter of the budget at least; so windows keep to the budget
unless a turn or system text is longer than the rest allows, which ``over`` shows. A token is a run of ASCII letters and
digits or any other sign but white space; a turn's marks count as four.

Template: ``<|im_start|>role``, a line end, the text, ``<|im_end|>``, a line end. ``<|`` inside a text or role is written
``<|_``, so no text can hold a mark, and removing that ``_`` restores it. Line ends and backslashes in roles are escaped as well.

Prefix sums take two levels: within segments of ``SEGMENT`` turn numbers, and over segment totals, so that a conversation with
a third of all turns is spread over many tasks. Windows are put together by (conversation, window), which the budget bounds.

Edge cases. Null texts and roles are empty. Turns are in order of turn (nulls first), role, tokens, text; repeated rows are
repeated turns. A null conv_id is a conversation of its own. A conversation is led by its first turn only if that turn's role
is ``system``. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import Work

BUDGET = 1024
HISTORY = 256
SEGMENT = 256
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"
MARKS = 4

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<|_"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<|_"), F.lit("<|"))


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # escaped backslashes are set aside as a line end, which a written role can't hold
    aside = F.replace(unescape(role), F.lit("\\\\"), F.lit("\n"))
    parts = F.transform(F.split(aside, "\n", -1), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def tokens(text: Column) -> Column:
    return (F.regexp_count(text, F.lit(TOKEN)) + MARKS).cast("long")


def _numbered(conversations: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with their place, the tokens before them, their window, and what their conversation needs."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")).alias("key"), "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-(1 << 62))).alias("segment"),
    ).withColumn("n", tokens(F.col("text")))
    first = F.min(F.struct("turn", "role", "n")).alias("first")
    totals = turns.groupBy("key", "segment").agg(F.sum("n").alias("total"), F.count("*").alias("rows"), F.max("n").alias("longest"), first)
    over = Window.partitionBy("key").orderBy("segment")
    before, whole = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lead = F.first("first").over(whole)
    system = F.when(lead["role"] == "system", lead["n"]).otherwise(0)
    segments = totals.select(
        "key", "segment", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("tokens_before"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        system.alias("system"), F.max("longest").over(whole).alias("longest"))
    inside = Window.partitionBy("key", "segment").orderBy(F.col("turn").asc_nulls_first(), "role", "n", "text")
    placed = turns.join(segments, ["key", "segment"]).withColumns({
        "place": F.col("rows_before") + F.row_number().over(inside),
        "at": F.col("tokens_before") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"),
    })
    stride = F.greatest(F.lit(budget) - F.col("system") - history - F.col("longest"), F.lit(max(1, budget // 4)))
    leads = (F.col("place") == 1) & (F.col("system") > 0)
    at = F.when(leads, 0).otherwise(F.col("at") - F.col("system"))
    return placed.select("key", "conv_id", "place", "role", "text", "n", leads.alias("leads"), at.alias("at"), F.floor(at / stride).alias("window"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, formatted, loss (start and length of each target in ``formatted``, in code points
    from 0), tokens, repeated (turns at the start that earlier windows hold), over.
    """
    if not 0 <= history <= budget // 4:
        raise ValueError("history may take a quarter of the budget at most")
    # read five times below
    turns = Work(conversations.sparkSession, "chat").store(_numbered(conversations, budget, history))
    begun = turns.groupBy("key", "window").agg(F.min(F.when(~F.col("leads"), F.col("at"))).alias("begins"))
    cols = ["key", "conv_id", "window", "place", "role", "text", "n", "repeated"]
    new = turns.withColumn("repeated", F.lit(False)).select(*cols)
    # a stride is at least as long as the history, so what is repeated comes from the window just before
    past = turns.filter("NOT leads").withColumn("window", F.col("window") + 1).join(begun, ["key", "window"])
    past = past.filter(F.col("begins") - F.col("at") <= history).withColumn("repeated", F.lit(True)).select(*cols)
    system = turns.filter("leads").drop("window").join(begun.filter("window > 0").select("key", "window"), "key")
    system = system.withColumn("repeated", F.lit(True)).select(*cols)
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = new.unionByName(past).unionByName(system).withColumns({"head": head, "body": body}).withColumn(
        "piece", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("key", "window").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("begin", F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0)))
    target = F.when((F.col("role") == "assistant") & ~F.col("repeated"), F.struct(
        (F.col("begin") + F.length("head")).cast("int").alias("start"), F.length("body").alias("length")))
    rows = F.array_sort(F.collect_list(F.struct("place", "piece")))
    out = pieces.groupBy("key", "window").agg(
        F.first("conv_id").alias("conv_id"), F.array_join(F.transform(rows, lambda x: x["piece"]), "").alias("formatted"),
        F.array_sort(F.collect_list(target)).alias("loss"), F.sum("n").alias("tokens"), F.sum(F.col("repeated").cast("int")).cast("int").alias("repeated"))
    return out.select("key", "conv_id", "window", "formatted", "loss", "tokens", "repeated", (F.col("tokens") > budget).alias("over"))


def new_turns(formatted: Column, repeated: Column) -> Column:
    """Array of (role, text) of the turns that a window adds, read from its text."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>", -1), repeated + 2, F.lit(1 << 30))
    tail = len(END) + 1

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = part.substr(F.length(role) + 2, F.length(part) - F.length(role) - 1 - tail)
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def targets(formatted: Column, loss: Column) -> Column:
    """Array of the texts under the loss mask."""
    return F.transform(loss, lambda x: unescape(formatted.substr(x["start"] + 1, x["length"])))


def read_back(formed: DataFrame) -> DataFrame:
    """Per conversation: conv_id, turns and targets as the windows hold them, and their characters."""
    w = formed.select("key", "conv_id", "window", new_turns(F.col("formatted"), F.col("repeated")).alias("turns"),
                      targets(F.col("formatted"), F.col("loss")).alias("targets"), F.length("formatted").cast("long").alias("chars"))
    rows = F.array_sort(F.collect_list(F.struct("window", "turns", "targets")))
    return w.groupBy("key").agg(F.first("conv_id").alias("conv_id"), rows.alias("r"), F.sum("chars").alias("formatted_chars")).select(
        "conv_id", F.flatten(F.transform("r", lambda x: x["turns"])).alias("turns"), F.flatten(F.transform("r", lambda x: x["targets"])).alias("targets"), "formatted_chars")
