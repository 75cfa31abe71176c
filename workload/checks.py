"""Data checks and reconciliation."""

from pyspark.sql import functions as F

from lakestrata.operators.quality import (
    Check,
    accepted_values,
    compare_row_count,
    count_report,
    not_null,
    of_type,
    leaf_sums,
    reconcile,
    reconcile_by_checksums,
    relationships,
    row_counts,
    rule,
    run_checks,
    unequal_leaves,
    unique,
)
from lakestrata.operators.shaping import flatten_variant
from lakestrata.plans import lodging
from workload import derived
from workload.registration import ORACLES, query, run_at

_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_COLS = _LINE.split(", ")
_DAY = "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM"


def _dated(df):
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(f"WITH {derived.ALTERED_LINES_SQL} SELECT (SELECT count(*) FROM lineitem) AS source_count, count(*) AS target_count, "
       "abs((SELECT count(*) FROM lineitem) - count(*)) AS difference FROM altered_lines")
def row_count_check(t):
    return compare_row_count(t.lineitem, derived.altered_lines(t))


@query("SELECT count(*) AS source_count, count(*) AS target_count, CAST(0 AS BIGINT) AS difference FROM documents")
def row_count_both_sides(t):
    """Landing and bronze hold as many rows."""
    landing = derived.landing_reviews(t)
    return row_counts(landing, lodging.bronze_reviews(landing, run_at(1)))


@query(f"""WITH {derived.ALTERED_LINES_SQL}, a AS (SELECT {_LINE} FROM lineitem), b AS (SELECT {_LINE} FROM altered_lines)
  SELECT *, 'source' AS only_in, CAST(1 AS BIGINT) AS copies FROM ({_DAY} (SELECT * FROM a EXCEPT SELECT * FROM b))
  UNION ALL SELECT *, 'target', 1 FROM ({_DAY} (SELECT * FROM b EXCEPT SELECT * FROM a))""")
def reconcile_as_sets(t):
    """Symmetric difference: a duplicated row does not show."""
    return _dated(reconcile(t.lineitem.select(*_COLS), derived.altered_lines(t).select(*_COLS), "set"))


@query(f"""WITH {derived.ALTERED_LINES_SQL}, a AS (SELECT {_LINE}, count(*) AS n FROM lineitem GROUP BY ALL),
    b AS (SELECT {_LINE}, count(*) AS n FROM altered_lines GROUP BY ALL)
  {_DAY} (SELECT {_LINE}, CASE WHEN COALESCE(a.n, 0) > COALESCE(b.n, 0) THEN 'source' ELSE 'target' END AS only_in,
    abs(COALESCE(a.n, 0) - COALESCE(b.n, 0)) AS copies
  FROM a FULL JOIN b USING ({_LINE}) WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0))""")
def reconcile_as_multisets(t):
    return _dated(reconcile(t.lineitem.select(*_COLS), derived.altered_lines(t).select(*_COLS)))


@query(ORACLES["reconcile_as_multisets"])
def reconcile_by_fingerprint(t):
    """The same answer by comparing row hashes first."""
    return _dated(reconcile(t.lineitem.select(*_COLS), derived.altered_lines(t).select(*_COLS), fingerprint=True))


@query(ORACLES["reconcile_as_multisets"])
def reconcile_by_leaf_sums(t):
    """The same answer, of which only the rows in unequal leaves are shuffled."""
    return _dated(reconcile_by_checksums(t.lineitem.select(*_COLS), derived.altered_lines(t).select(*_COLS), key=["l_orderkey", "l_linenumber"]))


@query("SELECT count(*) AS leaves_off FROM (SELECT 1 FROM lineitem WHERE FALSE)")
def leaf_sums_add_up(t):
    """Sums of two halves of a table added up are those of the whole."""
    cols = [*_COLS]
    halves = [leaf_sums(t.lineitem.select(*cols).filter(f"l_orderkey % 2 = {i}"), leaves=4096) for i in (0, 1)]
    both = halves[0].union(halves[1])
    whole = both.groupBy("leaf").agg(*[F.sum(c).alias(c) for c in both.columns if c != "leaf"])
    return unequal_leaves(whole, leaf_sums(t.lineitem.select(*cols), leaves=4096)).agg(F.count(F.lit(1)).alias("leaves_off"))


_REV = "listing_id, id, date, reviewer_id, reviewer_name, comments, comments2, comments3, comments4"


@query(f"""WITH {derived.REVIEWS_SQL}, a AS (SELECT * EXCLUDE (SOURCESYSTEM) FROM bronze_reviews),
    b AS (SELECT * REPLACE (CASE WHEN id % 50 = 0 THEN NULL ELSE reviewer_name END AS reviewer_name) FROM a)
  SELECT id, only_in FROM (
    SELECT id, 'source' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT id, 'target' FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""")
def reconcile_reviews(t):
    """Landing re-projected against a bronze that lost some reviewer names, on whole texts."""
    landing = derived.landing_reviews(t)
    cols = _REV.split(", ")
    bronze = lodging.bronze_reviews(landing, run_at(1)).withColumn(
        "reviewer_name", F.when(F.col("id") % 50 != 0, F.col("reviewer_name")))
    return reconcile(lodging.landed_reviews(landing).select(*cols), bronze.select(*cols), "set").select("id", "only_in")


@query(f"""WITH {derived.DRIVERS_SQL}, a AS (SELECT driverId, code, dob, forename, surname, nationality, number FROM drivers),
    b AS (SELECT * REPLACE (CASE WHEN driverId % 30 = 0 THEN number + 1 ELSE number END AS number) FROM a)
  SELECT driverId, number, 'source' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL SELECT driverId, number, 'target' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def reconcile_drivers(t):
    """Documents re-flattened against a bronze with some numbers changed; row order plays no part."""
    landing = derived.landing_drivers(t).select("payload")
    a = flatten_variant(landing, lodging.DRIVER_FIELDS)
    hit = F.col("driverId") % 30 == 0
    b = lodging.bronze_drivers(landing, run_at(1)).withColumn("number", F.when(hit, F.col("number") + 1).otherwise(F.col("number")))
    return reconcile(a, b.select(*a.columns)).select("driverId", "number", "only_in")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS s FROM orders) WHERE s IS NULL")
def not_null_check(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return not_null(df, "status").select("o_orderkey")


@query("""SELECT 'o_orderstatus' AS column_name, 'number' AS expected, 'string' AS actual, count(*) AS row_count FROM orders""")
def column_type_check(t):
    """One column fits, one does not."""
    return of_type(t.orders, "o_orderkey", "number").unionByName(of_type(t.orders, "o_orderstatus", "number"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_check(t):
    return unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT o_orderpriority, count(*) AS row_count FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
  GROUP BY o_orderpriority""")
def accepted_values_check(t):
    return accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("""SELECT l_orderkey, count(*) AS row_count FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 3 <> 0)
  GROUP BY l_orderkey""")
def relationships_check(t):
    return relationships(t.lineitem, ["l_orderkey"], t.orders.filter("o_custkey % 3 <> 0"), ["o_orderkey"])


@query("SELECT event_id, value FROM events WHERE NOT (value > 10)")
def business_rule_check(t):
    return rule(t.events, F.col("value") > 10).select("event_id", "value")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
                          for n in "region nation customer supplier part orders lineitem events documents embeddings pages "
                                   "benchmark labels conversations".split()))
def count_report_all_tables(t):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
             "pages", "benchmark", "labels", "conversations"]
    return count_report({n: getattr(t, n) for n in names})


@query("""SELECT 'priority' AS check_name, count(*) AS failures, FALSE AS passed FROM orders WHERE o_orderpriority <> '1-URGENT'
  UNION ALL SELECT 'order_key', count(*), TRUE FROM orders WHERE o_orderkey IS NULL
  UNION ALL SELECT 'price', count(*), TRUE FROM orders WHERE NOT (o_totalprice > 0)""")
def tagged_check_run(t):
    """Only checks carrying a wanted tag run."""
    o = t.orders
    suite = [
        Check("priority", lambda: rule(o, F.col("o_orderpriority") == "1-URGENT"), frozenset({"P1"})),
        Check("order_key", lambda: not_null(o, "o_orderkey"), frozenset({"P1", "dq"})),
        Check("price", lambda: rule(o, F.col("o_totalprice") > 0), frozenset({"dq"})),
        Check("left_out", lambda: unique(o, ["o_custkey"]), frozenset({"slow"})),
    ]
    return run_checks(suite, {"p1", "DQ"})
