"""Catalog tables: append, replace, update, copy, view, identity."""

from functools import reduce

from pyspark.sql import functions as F

from lakestrata.operators.governance import MASKED, Bindings, constant_mask
from lakestrata.operators.identity import assign_identity
from lakestrata.operators.quality import relationships, rule, scan
from lakestrata.sources import tables
from lakestrata.sources.governed import GovernedCatalog
from lakestrata.sources.history_table import HistoryTable
from lakestrata.sources.identity_table import IdentityTable
from lakestrata.sources.slice_checks import CheckState, SliceCheck, aligned, on_slices
from lakestrata.sources.sliced_table import SlicedTable
from workload import derived
from workload.registration import query, run_at, stamp


def _new_history(table):
    table.drop()
    return table


def _fresh(t, name):
    full = f"{t.work_database()}.{name}"
    tables.drop(t.spark, full)
    return full


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0")
def append_rows(t):
    name, cols = _fresh(t, "appended"), ["o_orderkey", "o_orderstatus"]
    tables.append(t.orders.filter("o_orderkey % 2 = 0").select(*cols), name)
    tables.append(t.orders.filter("o_orderkey % 3 = 0").select(*reversed(cols)), name)  # matched by name
    return t.spark.table(name)


@query("SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_nationkey <> 3")
def overwrite_from_itself(t):
    """The replacing plan reads the table it replaces."""
    name = _fresh(t, "overwritten")
    tables.overwrite(t.customer.select("c_custkey", "c_acctbal", "c_nationkey"), name)
    tables.overwrite(t.spark.table(name).filter("c_nationkey <> 3").select("c_custkey", (F.col("c_acctbal") * 2).alias("c_acctbal")), name)
    return t.spark.table(name)


@query("SELECT p_partkey, p_name FROM part WHERE p_size > 25")
def truncate_and_reload(t):
    name = _fresh(t, "reloaded")
    tables.overwrite(t.part.select("p_partkey", "p_name"), name)
    tables.truncate(t.spark, name)
    tables.replace_rows(t.part.filter("p_size > 25").select("p_name", "p_partkey"), name)
    return t.spark.table(name)


@query("SELECT n_nationkey, CASE WHEN n_nationkey = 7 THEN 'RENAMED' ELSE n_name END AS n_name, n_regionkey FROM nation")
def update_one_row(t):
    name = _fresh(t, "updated")
    tables.overwrite(t.nation, name)
    tables.update_table(t.spark, name, F.col("n_nationkey").cast("string").cast("bigint") == 7, {"n_name": F.lit("RENAMED")})
    return t.spark.table(name)


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'HIGH' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def update_where_condition(t):
    return tables.update_where(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), F.col("o_totalprice") > 400000,
                               {"o_orderpriority": F.lit("HIGH")}).drop("o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def ctas_with_limit(t):
    name = _fresh(t, "top_orders")
    tables.ctas(t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5), name)
    return t.spark.table(name)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0")
def create_like_then_insert(t):
    src, name = _fresh(t, "like_source"), _fresh(t, "like_copy")
    tables.overwrite(t.supplier, src)
    tables.create_like(t.spark, src, name)
    tables.append(t.spark.table(src).filter("s_acctbal > 0"), name)
    return t.spark.table(name)


@query("SELECT p_partkey, p_brand, 'clone' AS origin FROM part UNION ALL SELECT p_partkey, 'none', 'source' FROM part")
def clone_is_independent(t):
    src, name = _fresh(t, "clone_source"), _fresh(t, "clone_copy")
    tables.overwrite(t.part.select("p_partkey", "p_brand"), src)
    tables.clone(t.spark, src, name)
    tables.update_table(t.spark, src, F.lit(True), {"p_brand": F.lit("none")})
    return t.spark.table(name).withColumn("origin", F.lit("clone")).unionByName(t.spark.table(src).withColumn("origin", F.lit("source")))


_COPIES = " UNION ALL ".join(f"SELECT '{k}' AS kind, c_custkey, {v} AS c_name FROM customer" for k, v in
                             (("base", "'*** MASKED ***'"), ("view", "'*** MASKED ***'"), ("secure_view", "'*** MASKED ***'"),
                              ("ctas", "'*** MASKED ***'"), ("like", "'*** MASKED ***'"), ("clone", "'*** MASKED ***'"),
                              ("materialized", "c_name")))


@query(_COPIES)
def masks_follow_copies(t):
    """One tagged table and everything derived from it, as a role without access sees them."""
    cat = GovernedCatalog(t.spark, Bindings().create_tag("PII", propagate=True).tag_mask("PII", constant_mask("pii", MASKED)))
    n = {k: _fresh(t, f"tagged_{k}") for k in ("base", "view", "secure_view", "ctas", "like", "clone", "materialized")}
    tables.overwrite(t.customer.select("c_custkey", "c_name"), n["base"])
    cat.bindings.tag(n["base"], "c_name", "PII", "name")
    cat.create_view(n["view"], n["base"])
    cat.create_secure_view(n["secure_view"], n["base"])
    cat.ctas(n["ctas"], n["base"])
    cat.create_like(n["like"], n["base"])
    tables.append(t.spark.table(n["base"]), n["like"])
    cat.clone(n["clone"], n["base"])
    cat.create_materialized_view(n["materialized"], n["base"], role="ACCOUNTADMIN")
    out = [cat.read(name, "SYSADMIN").select(F.lit(k).alias("kind"), "c_custkey", "c_name") for k, name in n.items()]
    df = out[0]
    for o in out[1:]:
        df = df.unionByName(o)
    return df


_SPELLINGS = ("database", "catalog", "upper", "quoted", "version")


@query(" UNION ALL ".join(f"SELECT '{k}' AS spelling, c_custkey, '*** MASKED ***' AS c_name FROM customer" for k in _SPELLINGS))
def masks_under_every_spelling(t):
    """A mask bound to one spelling of a table holds for all, its stored version included."""
    name = _fresh(t, "spelled")
    tables.overwrite(t.customer.select("c_custkey", "c_name"), name)
    cat = GovernedCatalog(t.spark, Bindings().set_mask(name, "c_name", constant_mask("pii", MASKED)))
    quoted = ".".join(f"`{p}`" for p in name.split("."))
    spelled = (name, f"spark_catalog.{name}", name.upper(), quoted, tables.physical(t.spark, name))
    out = [cat.read(n, "QA_READONLY").select(F.lit(k).alias("spelling"), "c_custkey", "c_name") for k, n in zip(_SPELLINGS, spelled)]
    return reduce(lambda a, b: a.unionByName(b), out)


@query("SELECT c_custkey, c_name || '!' AS greeting, '*** MASKED ***' AS shown, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def tags_follow_a_query(t):
    """Tags go along a stored join by the columns' expression ids: what comes from a tagged column is masked, what does not is clear."""
    people, places, copy = _fresh(t, "tagged_people"), _fresh(t, "tagged_places"), _fresh(t, "tagged_join")
    tables.overwrite(t.customer.select("c_custkey", "c_name", "c_nationkey"), people)
    tables.overwrite(t.nation, places)
    masks = Bindings().create_tag("pii", propagate=True).tag_mask("pii", constant_mask("pii", MASKED, allow=("SYSADMIN",)))
    cat = GovernedCatalog(t.spark, masks.tag(people, "c_name", "pii", "name"))
    cat.ctas_query(copy, t.spark.sql(f"""WITH p AS (SELECT c_custkey, concat(c_name, '!') AS greeting, c_nationkey AS n_nationkey FROM {people})
      SELECT c_custkey, greeting, n_name FROM p JOIN {places} USING (n_nationkey)"""))
    hidden = cat.read(copy, "QA_READONLY").select("c_custkey", F.col("greeting").alias("shown"), "n_name")
    return cat.read(copy, "SYSADMIN").select("c_custkey", "greeting").join(hidden, "c_custkey")


@query("SELECT c_custkey, upper(c_name) AS shouted FROM customer WHERE c_acctbal > 0")
def persistent_view(t):
    src, view = _fresh(t, "view_source"), f"{t.work_database()}.shouting"
    tables.overwrite(t.customer, src)
    tables.create_view(t.spark, f"SELECT c_custkey, upper(c_name) AS shouted FROM {src} WHERE c_acctbal > 0", view)
    return scan(t.spark, view)


@query("SELECT region_label, n_name FROM (VALUES (0, 'south'), (3, 'north')) v(r, region_label) JOIN nation ON n_regionkey = r")
def inline_rows_joined(t):
    v = tables.values(t.spark, [(0, "south"), (3, "north")], "r int, region_label string")
    return v.join(t.nation, F.col("r") == F.col("n_regionkey")).select("region_label", "n_name")


@query("SELECT 99 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders")
def identity_numbers(t):
    return assign_identity(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], start=100).select("id", "o_orderkey")


@query(f"""WITH {derived.LATER_ORDERS_SQL}
  SELECT o_orderkey, o_orderstatus, '2025-01-10 08:00:00' AS valid_from,
    CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 7 = 0 THEN '2025-02-10 08:00:00' END AS valid_to FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus, '2025-02-10 08:00:00', NULL FROM later_orders
    WHERE o_orderkey >= 1000000000000 OR o_orderkey % 7 = 0""")
def stored_history(t):
    """Three loads into a bucketed history table; the third brings nothing new."""
    name = f"{t.work_database()}.order_history"
    h = _new_history(HistoryTable(t.spark, name, ["o_orderkey"], buckets=8))
    cols = ["o_orderkey", "o_orderstatus"]
    h.load_by_check(t.orders.select(*cols), ["o_orderstatus"], run_at(1))
    for month in (2, 3):
        h.load_by_check(derived.later_orders(t).select(*cols), ["o_orderstatus"], run_at(month))
    return t.spark.table(name).select(*cols, stamp("valid_from"), stamp("valid_to"))


@query(f"""WITH {derived.LATER_ORDERS_SQL}, m AS (SELECT o_orderkey, o_orderstatus FROM later_orders
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 13 = 0)
  SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 1 THEN 'U' ELSE o_orderstatus END AS o_orderstatus FROM m""")
def merge_and_update_slices(t):
    """A merge, then an update, each rewriting only the key slices that it touches."""
    cols = ["o_orderkey", "o_orderstatus"]
    table = SlicedTable(t.spark, f"{t.work_database()}.sliced_orders", ["o_orderkey"], 16)
    table.drop()
    table.overwrite(t.orders.select(*cols))
    table.merge(derived.later_orders(t).select(*cols))
    table.update(F.col("o_orderkey") % 1000 == 1, {"o_orderstatus": F.lit("U")})
    return t.spark.table(table.name)


def _loads_sql(deletes):
    """Four loads: all; every 7th changed and every 5th gone; the changed ones back as they were; all again."""
    t = [f"'2025-0{m}-10 08:00:00'" for m in (1, 2, 3, 4)]
    row = lambda status, at, to, where, deleted="FALSE": f"SELECT o_orderkey, {status} AS o_orderstatus, {at} AS valid_from, {to} AS valid_to, {deleted} AS is_deleted FROM orders WHERE {where}"
    five, seven, both = "o_orderkey % 5 = 0", "o_orderkey % 7 = 0", "o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0"
    out = [row("o_orderstatus", t[0], t[1], both), row("'X'", t[1], t[2], both), row("o_orderstatus", t[2], "NULL", both), row("o_orderstatus", t[0], "NULL", f"NOT ({five}) AND NOT ({seven})")]
    if deletes == "ignore":
        out.append(row("o_orderstatus", t[0], "NULL", five))
    else:
        out += [row("o_orderstatus", t[0], t[1], five), row("o_orderstatus", t[3], "NULL", five)]
    if deletes == "new_record":
        out.append(row("o_orderstatus", t[1], t[3], five, "TRUE"))
    return " UNION ALL ".join(out)


def _four_loads(t, deletes):
    name = f"{t.work_database()}.four_loads_{deletes}"
    h = _new_history(HistoryTable(t.spark, name, ["o_orderkey"], hard_deletes=deletes, buckets=8))
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    fewer = rows.filter("o_orderkey % 5 <> 0")
    changed = fewer.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    for month, delivery in enumerate((rows, changed, fewer, rows), 1):
        h.load_by_check(delivery, ["o_orderstatus"], run_at(month))
    out = t.spark.table(name)
    deleted = F.col("is_deleted") if "is_deleted" in out.columns else F.lit(False)
    return out.select("o_orderkey", "o_orderstatus", stamp("valid_from"), stamp("valid_to"), deleted.alias("is_deleted"))


@query(_loads_sql("ignore"))
def stored_history_four_loads(t):
    """A key changes and changes back; absent keys stay open."""
    return _four_loads(t, "ignore")


@query(_loads_sql("invalidate"))
def stored_history_four_loads_closing(t):
    """Absent keys are closed and open again when they return."""
    return _four_loads(t, "invalidate")


@query(_loads_sql("new_record"))
def stored_history_four_loads_marking(t):
    """Absent keys get a marked version until they return."""
    return _four_loads(t, "new_record")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority, TRUE AS is_open FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, FALSE FROM orders WHERE o_orderkey % 7 = 0""")
def stored_history_column_vanishes(t):
    """The second delivery lacks a column, in a stored history."""
    name, cols = f"{t.work_database()}.vanishing", ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    h = _new_history(HistoryTable(t.spark, name, ["o_orderkey"], buckets=8))
    h.load_by_check(t.orders.select(*cols), cols[1:], run_at(1))
    later = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    h.load_by_check(later, ["o_orderstatus"], run_at(2))
    return t.spark.table(name).select(*cols, F.col("valid_to").isNull().alias("is_open"))


_GROWN = "o_orderkey % 7 = 0"


@query(f"""WITH v AS (SELECT o_orderkey, o_custkey, o_totalprice::DECIMAL(12,2) AS price, {_GROWN} AS grown FROM orders)
  SELECT o_orderkey + 0 AS o_orderkey, o_custkey AS customer, price::DECIMAL(16,4) AS price, NOT grown AS is_open, 'history' AS layer FROM v
  UNION ALL SELECT o_orderkey, o_custkey + 3000000000, (price + 0.0625)::DECIMAL(16,4), TRUE, 'history' FROM v WHERE grown
  UNION ALL SELECT o_orderkey, o_custkey + CASE WHEN grown THEN 3000000000 ELSE 0 END, (price + CASE WHEN grown THEN 0.0625 ELSE 0 END)::DECIMAL(16,4), TRUE, 'gold' FROM v""")
def types_grow_through_loads(t):
    """The second delivery has bigint for int and a decimal of more digits; the third comes in the old types again and changes nothing.

    Gold, merged from what each load opened, grows with it.
    """
    db, grown = t.work_database(), F.expr(_GROWN)
    h = _new_history(HistoryTable(t.spark, f"{db}.growing", ["o_orderkey"], buckets=8, slices=8))
    gold = SlicedTable(t.spark, f"{db}.growing_gold", ["o_orderkey"], 8)
    gold.drop()
    price = F.col("o_totalprice").cast("decimal(12,2)")
    narrow = t.orders.select("o_orderkey", F.col("o_custkey").cast("int").alias("customer"), price.alias("price"))
    wide = t.orders.select(
        "o_orderkey", (F.col("o_custkey").cast("bigint") + F.when(grown, F.lit(3_000_000_000)).otherwise(F.lit(0))).alias("customer"),
        (price + F.when(grown, F.lit("0.0625").cast("decimal(16,4)")).otherwise(F.lit(0).cast("decimal(16,4)"))).cast("decimal(16,4)").alias("price"))
    for month, delivery in enumerate((narrow, wide, narrow.filter(~grown)), 1):
        h.load_by_check(delivery, ["customer", "price"], run_at(month))
        changed = h.opened_since(month - 1).select("o_orderkey", "customer", "price")
        if gold.published():
            gold.merge(tables.stage(changed, f"{db}.growing_increment"))
        else:
            gold.overwrite(changed)
    shown = t.spark.table(h.name).select("o_orderkey", "customer", "price", F.col("valid_to").isNull().alias("is_open"), F.lit("history").alias("layer"))
    return shown.unionByName(gold.read().select("*", F.lit(True).alias("is_open"), F.lit("gold").alias("layer")))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS changed_on,
    CASE WHEN o_orderkey % 10 = 0 THEN 3 WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS taken_with
  FROM orders WHERE o_orderkey % 10 <> 5""")
def gold_increments_by_load(t):
    """Three deliveries into a history, and gold merged from what each opened or closed.

    Times play no part: changed rows keep their time, some have none, every
    fifth key goes with the second delivery, and half of these come back.
    """
    db, slices = t.work_database(), 16
    h = _new_history(HistoryTable(t.spark, f"{db}.increments", ["o_orderkey"], hard_deletes="invalidate", buckets=16, slices=slices))
    gold = SlicedTable(t.spark, f"{db}.increments_gold", ["o_orderkey"], slices)
    gold.drop()
    first = t.orders.select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("changed_on"))
    changed = first.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    for month, delivery in enumerate((first, changed.filter("o_orderkey % 5 <> 0"), changed.filter("o_orderkey % 10 <> 5"), changed.filter("o_orderkey % 10 <> 5")), 1):
        h.load_by_check(delivery, ["o_orderstatus", "changed_on"], run_at(month))
        as_gold = lambda df, month=month: df.select("o_orderkey", "o_orderstatus", "changed_on", F.lit(month).alias("taken_with"))
        taken, load = gold.taken(), h.load_number()
        if taken is None:
            gold.overwrite(as_gold(h.current()), load)
        elif taken < load:
            gold.merge(as_gold(h.opened_since(taken)), keys=h.opened_since(taken), gone=h.gone_since(taken), taken=load)
    return t.spark.table(gold.name)


@query("""SELECT role, c_custkey, name_length, masked FROM (
    SELECT 'SYSADMIN' AS role, c_custkey, length(c_name) AS name_length, FALSE AS masked, c_mktsegment FROM customer
    UNION ALL SELECT 'QA_READONLY', c_custkey, 14, TRUE, c_mktsegment FROM customer) WHERE c_mktsegment = 'BUILDING'""")
def governed_sql(t):
    """SQL text over a protected table, once per role."""
    name = _fresh(t, "queried")
    tables.overwrite(t.customer, name)
    cat = GovernedCatalog(t.spark, Bindings().set_mask(name, "c_name", constant_mask("pii", MASKED, allow=("SYSADMIN",))))
    text = ("SELECT c_custkey, length(c_name) AS name_length, c_name = '*** MASKED ***' AS masked FROM {people} WHERE c_mktsegment = 'BUILDING'")
    a, b = (cat.query(r, text, people=name).withColumn("role", F.lit(r)) for r in ("SYSADMIN", "QA_READONLY"))
    return a.unionByName(b).select("role", "c_custkey", F.col("name_length").cast("bigint").alias("name_length"), "masked")


@query("""WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders WHERE o_orderkey % 3 <> 0),
    b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders WHERE o_orderkey % 3 = 0)
  SELECT 99 + n AS id, o_orderkey FROM a WHERE o_orderkey % 5 <> 0
  UNION ALL SELECT 99 + n + (SELECT count(*) FROM a), o_orderkey FROM b WHERE o_orderkey % 5 <> 0""")
def identity_kept_across_loads(t):
    """The second delivery numbers only new keys, on from the highest; old ones keep their number, and gone ones do not free theirs."""
    table = IdentityTable(t.spark, f"{t.work_database()}.order_numbers", ["o_orderkey"], start=100, buckets=8)
    table.drop()
    rows = t.orders.select("o_orderkey", "o_orderdate")
    table.take(rows.filter("o_orderkey % 3 <> 0"), ["o_orderdate"])
    second = rows.filter("o_orderkey % 5 <> 0")
    table.take(rows.unionByName(second), ["o_orderdate"])
    table.take(second, ["o_orderdate"])
    return table.numbered(second).select("id", "o_orderkey")


@query("""SELECT 'known_status' AS check_name, count(*) FILTER (o_orderkey % 1000 = 1) AS failures, count(*) FILTER (o_orderkey % 1000 = 1) = 0 AS passed FROM orders
  UNION ALL SELECT 'has_lines', count(*) FILTER (o_orderkey % 500 = 2), count(*) FILTER (o_orderkey % 500 = 2) = 0 FROM orders
  UNION ALL SELECT 'positive_price', count(*) FILTER (o_totalprice <= 0), count(*) FILTER (o_totalprice <= 0) = 0 FROM orders""")
def checks_on_touched_slices(t):
    """Checks kept per key slice: after two loads that break rules, only what these wrote is checked again."""
    db = t.work_database()
    orders, lines = (SlicedTable(t.spark, f"{db}.{n}", ["o_orderkey"], 32) for n in ("checked_orders", "checked_lines"))
    checks = [
        SliceCheck("known_status", on_slices(orders, lambda d: rule(d, F.col("o_orderstatus").isin("F", "O", "P")))),
        SliceCheck("positive_price", on_slices(orders, lambda d: rule(d, F.col("o_totalprice") > 0))),
        SliceCheck("has_lines", aligned(orders, lines, lambda d, p: relationships(d, ["o_orderkey"], p, ["o_orderkey"]))),
    ]
    state = CheckState(t.spark, f"{db}.checked_state", checks)
    for table in (orders, lines, state.table):
        table.drop()
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.overwrite(rows)
    lines.overwrite(rows.select("o_orderkey"))
    state.run()
    state.run(orders.update(F.col("o_orderkey") % 1000 == 1, {"o_orderstatus": F.lit("?")}))
    return state.run(lines.merge(rows.select("o_orderkey").filter("false"), gone=rows.filter("o_orderkey % 500 = 2").select("o_orderkey")))
