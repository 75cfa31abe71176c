"""Row history, incremental merges, gold dimension and fact."""

from functools import reduce

from pyspark.sql import functions as F

from lakestrata.functions.casting import typed
from lakestrata.operators.audit import with_audit
from lakestrata.operators.governance import MASKED, constant_mask
from lakestrata.operators.history import current_rows, history, snapshot_check, snapshot_timestamp
from lakestrata.operators.incremental import high_water_mark, incremental, merge_upsert, newer_than
from lakestrata.operators.quality import count_report
from lakestrata.operators.star import build_dim
from lakestrata.plans import lodging
from lakestrata.plans.medallion import Medallion
from lakestrata.settings import Layers, work_folder
from lakestrata.sources import tables
from lakestrata.sources.binding_store import load_bindings, save_bindings
from lakestrata.sources.governed import GovernedCatalog
from workload import derived
from workload.registration import AUDITED, audited_sql, day, query, run_at, stamp

KEY = ["o_orderkey"]
CHECKED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
T1, T2, T3 = "2025-01-10 08:00:00", "2025-02-10 08:00:00", "2025-03-10 08:00:00"


def _shown(df, *extra):
    return df.select("o_orderkey", "o_orderstatus", "o_orderpriority", stamp("valid_from"), stamp("valid_to"),
                     stamp("updated_at"), "scd_id", *extra)


def _version(at: str, to: str = "NULL", cols: str = "o_orderkey, o_orderstatus, o_orderpriority") -> str:
    return (f"{cols}, '{at}' AS valid_from, CAST({to} AS VARCHAR) AS valid_to, '{at}' AS updated_at, "
            f"md5(o_orderkey || '|{at}') AS scd_id")


def _first(t):
    return snapshot_check(t.orders, None, KEY, CHECKED, run_at(1))


def _second(t, **kw):
    return snapshot_check(derived.later_orders(t), _first(t), KEY, CHECKED, run_at(2), **kw)


_CHANGED = "(o_orderkey % 7 = 0 OR o_orderkey % 11 = 0)"

# the four outcomes of the second delivery, written out one by one
_SECOND_SQL = f"""SELECT {_version(T1)} FROM orders WHERE o_orderkey % 13 <> 0 AND NOT {_CHANGED}
  UNION ALL SELECT {_version(T1, f"'{T2}'")} FROM orders WHERE o_orderkey % 13 <> 0 AND {_CHANGED}
  UNION ALL SELECT {_version(T2)} FROM later_orders WHERE o_orderkey < 1000000000000 AND {_CHANGED}
  UNION ALL SELECT {_version(T2)} FROM later_orders WHERE o_orderkey >= 1000000000000"""


@query(f"SELECT {_version(T1)} FROM orders")
def snapshot_first_load(t):
    return _shown(_first(t))


@query(f"WITH {derived.LATER_ORDERS_SQL} {_SECOND_SQL} UNION ALL SELECT {_version(T1)} FROM orders WHERE o_orderkey % 13 = 0")
def snapshot_second_load(t):
    """Rows that vanished from the source stay open."""
    return _shown(_second(t))


@query(f"""WITH {derived.LATER_ORDERS_SQL} {_SECOND_SQL}
  UNION ALL SELECT {_version(T1, f"'{T2}'")} FROM orders WHERE o_orderkey % 13 = 0""")
def snapshot_closing_deleted(t):
    return _shown(_second(t, hard_deletes="invalidate"))


@query(f"""WITH {derived.LATER_ORDERS_SQL}, v AS ({_SECOND_SQL}
    UNION ALL SELECT {_version(T1, f"'{T2}'")} FROM orders WHERE o_orderkey % 13 = 0)
  SELECT *, FALSE AS is_deleted FROM v
  UNION ALL SELECT {_version(T2)}, TRUE FROM orders WHERE o_orderkey % 13 = 0""")
def snapshot_marking_deleted(t):
    first = snapshot_check(t.orders, None, KEY, CHECKED, run_at(1), hard_deletes="new_record")
    second = snapshot_check(derived.later_orders(t), first, KEY, CHECKED, run_at(2), hard_deletes="new_record")
    return _shown(second, "is_deleted")


@query(f"WITH {derived.LATER_ORDERS_SQL} {_SECOND_SQL} UNION ALL SELECT {_version(T1)} FROM orders WHERE o_orderkey % 13 = 0")
def snapshot_repeated_load(t):
    """Loading the same delivery a second time adds nothing."""
    return _shown(snapshot_check(derived.later_orders(t), _second(t), KEY, CHECKED, run_at(3)))


@query(f"""WITH {derived.LATER_ORDERS_SQL}, gone AS (SELECT *, o_orderkey % 7 = 0 AS changed FROM orders)
  SELECT o_orderkey, o_orderstatus, o_orderpriority, '{T1}' AS valid_from, CASE WHEN changed THEN '{T2}' END AS valid_to FROM gone
  UNION ALL SELECT o_orderkey, 'X', NULL, '{T2}', NULL FROM gone WHERE changed""")
def snapshot_column_vanishes(t):
    """The second delivery lacks a column: versions that hold it keep it, whether kept or closed now."""
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    first = snapshot_check(t.orders.select(*cols), None, KEY, cols[1:], run_at(1))
    later = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    out = snapshot_check(later, first, KEY, ["o_orderstatus"], run_at(2))
    return out.select(*cols, stamp("valid_from"), stamp("valid_to"))


@query(f"""WITH {derived.REVIEWS_SQL}, v AS (
  SELECT id, reviewer_name, comments, id % 4 = 0 AS changed FROM bronze_reviews)
  SELECT id, reviewer_name, md5(comments) AS text_md5, '{T1}' AS valid_from, CASE WHEN changed THEN '{T2}' END AS valid_to FROM v
  UNION ALL SELECT id, NULL, md5(comments), '{T2}', NULL FROM v WHERE changed""")
def snapshot_reviews(t):
    """Six checked columns, one of them turning NULL; fresh audit columns alone change nothing."""
    bronze = lodging.bronze_reviews(derived.landing_reviews(t), run_at(1))
    checked = list(lodging.REVIEW_TYPES)
    first = snapshot_check(lodging.silver_source(bronze, lodging.REVIEW_TYPES, run_at(1)), None, ["id"], checked, run_at(1))
    edited = bronze.withColumn("reviewer_name", F.when(F.col("id") % 4 != 0, F.col("reviewer_name")))
    out = snapshot_check(lodging.silver_source(edited, lodging.REVIEW_TYPES, run_at(2)), first, ["id"], checked, run_at(2))
    return out.select("id", "reviewer_name", F.md5("comments").alias("text_md5"), stamp("valid_from"), stamp("valid_to"))


_AT = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
_LATER = "strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S')"


@query(f"""SELECT o_orderkey, o_orderstatus, {_AT} AS valid_from, CASE WHEN o_orderkey % 7 = 0 THEN {_LATER} END AS valid_to,
    {_AT} AS updated_at, md5(o_orderkey || '|' || {_AT}) AS scd_id FROM orders
  UNION ALL SELECT o_orderkey, 'X', {_LATER}, NULL, {_LATER}, md5(o_orderkey || '|' || {_LATER}) FROM orders WHERE o_orderkey % 7 = 0""")
def snapshot_by_timestamp(t):
    """Later source times open a version; equal and earlier ones do not, whatever else changed."""
    k = F.col("o_orderkey")
    shift = F.when(k % 7 == 0, F.expr("INTERVAL 2 DAY")).when(k % 11 == 0, F.expr("INTERVAL -2 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    first = snapshot_timestamp(t.orders, None, KEY, "o_orderdate", run_at(1))
    later = t.orders.withColumns({"o_orderdate": F.col("o_orderdate") + shift, "o_orderstatus": F.lit("X")})
    out = snapshot_timestamp(later, first, KEY, "o_orderdate", run_at(2))
    return out.select("o_orderkey", "o_orderstatus", stamp("valid_from"), stamp("valid_to"), stamp("updated_at"), "scd_id")


@query(f"""WITH {derived.LATER_ORDERS_SQL} SELECT o_orderkey, o_orderstatus, o_orderpriority FROM later_orders
  UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 13 = 0""")
def current_versions(t):
    return current_rows(_second(t)).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(f"""WITH {derived.LATER_ORDERS_SQL}, v AS ({_SECOND_SQL} UNION ALL SELECT {_version(T1)} FROM orders WHERE o_orderkey % 13 = 0)
  SELECT o_orderkey, o_orderstatus, valid_from, valid_to FROM v WHERE o_orderkey = 77
  ORDER BY o_orderkey, valid_to NULLS LAST""")
def version_history(t):
    """Versions of one key, the open one last."""
    h = history(_second(t), F.col("o_orderkey") == 77, F.col("o_orderkey").asc(), F.col("valid_to").asc_nulls_last())
    return h.select("o_orderkey", "o_orderstatus", stamp("valid_from"), stamp("valid_to"))


@query("SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS mark FROM orders")
def high_water_mark_value(t):
    return high_water_mark(t.orders, "o_orderdate").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("mark"))


@query("SELECT COALESCE(strftime(max(o_orderdate), '%Y-%m-%d'), '1970-01-01') AS mark FROM orders WHERE o_orderkey < 0")
def high_water_mark_of_empty_target(t):
    return high_water_mark(t.orders.filter("o_orderkey < 0"), "o_orderdate").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("mark"))


_SPLIT = "TIMESTAMP '1999-01-01 00:00:00'"


@query(f"""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < {_SPLIT})""")
def newer_than_target(t):
    target = t.orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return newer_than(t.orders, "o_orderdate", target, "o_orderdate").select("o_orderkey", "o_totalprice")


@query(f"""WITH {derived.LATER_ORDERS_SQL} SELECT o_orderkey, o_orderstatus FROM later_orders
  UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 13 = 0""")
def merge_by_key(t):
    cols = ["o_orderkey", "o_orderstatus"]
    return merge_upsert(derived.later_orders(t).select(*cols), t.orders.select(*cols), KEY)


@query("""WITH o AS (SELECT user_id, min(event_id) AS event_id, 'old' AS event_type FROM events GROUP BY user_id),
  n AS (SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
    FROM events WHERE event_type <> 'purchase' AND user_id % 3 <> 0) WHERE rn = 1)
  SELECT * FROM n UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n)""")
def merge_keeping_latest(t):
    """An increment with repeated keys onto a row for every user: its newest row of each key wins, other users keep theirs."""
    cols = ["user_id", "event_id", "event_type"]
    old = t.events.groupBy("user_id").agg(F.min("event_id").alias("event_id")).withColumn("event_type", F.lit("old"))
    new = t.events.filter("event_type <> 'purchase' AND user_id % 3 <> 0").select(*cols)
    return merge_upsert(new, old, ["user_id"], duplicates="latest", latest_by="event_id")


_BUILT = """SELECT o_orderkey AS ID, sha1(CAST(o_orderkey AS VARCHAR)) AS SK, o_orderstatus AS STATUS,
  strftime(o_orderdate, '%Y-%m-%d') AS MODIFIED FROM orders"""


def _build(rows):
    from lakestrata.functions.keys import surrogate_key

    return rows.select(F.col("o_orderkey").alias("ID"), surrogate_key("o_orderkey").alias("SK"), F.col("o_orderstatus").alias("STATUS"),
                       F.col("o_orderdate").alias("MODIFIED"))


def _day(df):
    return df.withColumn("MODIFIED", F.date_format("MODIFIED", "yyyy-MM-dd"))


@query(_BUILT)
def incremental_dimension(t):
    """Rows up to a date, then the rest by high-water mark: the same as one build."""
    old = _build(t.orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    return _day(incremental(_build, t.orders, old, ["ID"], "o_orderdate", "MODIFIED"))


@query(_BUILT)
def incremental_full_refresh(t):
    """Every stored row is stale, and some are of keys that are gone; none is left."""
    old = _build(t.orders).withColumns({"STATUS": F.lit("stale"), "ID": F.when(F.col("ID") % 5 == 0, -F.col("ID")).otherwise(F.col("ID"))})
    return _day(incremental(_build, t.orders, old, ["ID"], "o_orderdate", "MODIFIED", full_refresh=True))


@query("""SELECT o_orderkey AS ID, sha1(CAST(o_orderkey AS VARCHAR)) AS SK,
  CASE WHEN o_orderkey % 3 = 0 OR o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')
    THEN 'new' ELSE o_orderstatus END AS STATUS,
  strftime(o_orderdate, '%Y-%m-%d') AS MODIFIED FROM orders""")
def incremental_with_named_keys(t):
    """Rows named for another build are rebuilt although the mark has passed them."""
    old = _build(t.orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    named = t.orders.filter("o_orderkey % 3 = 0").select("o_orderkey")
    out = incremental(lambda r: _build(r).withColumn("STATUS", F.lit("new")), t.orders, old, ["ID"], "o_orderdate", "MODIFIED", reprocess=named)
    return _day(out)


def _silver(t):
    """Two loads of the listings: every 9th gets a new name and price."""
    bronze = lodging.bronze_listings(derived.landing_listings(t), run_at(1))
    checked = list(lodging.LISTING_TYPES)
    first = snapshot_check(lodging.silver_source(bronze, lodging.LISTING_TYPES, run_at(1)), None, ["id"], checked, run_at(1))
    hit = F.col("id") % 9 == 0
    edited = bronze.withColumns({"name": F.when(hit, F.concat("name", F.lit(" (new)"))).otherwise(F.col("name")),
                                 "price": F.when(hit, F.col("price") + 100).otherwise(F.col("price"))})
    return snapshot_check(lodging.silver_source(edited, lodging.LISTING_TYPES, run_at(2)), first, ["id"], checked, run_at(2))


_CURRENT = f"""current_listings AS (
  SELECT * REPLACE (CASE WHEN id % 9 = 0 THEN name || ' (new)' ELSE name END AS name,
                    CASE WHEN id % 9 = 0 THEN price + 100 ELSE price END AS price),
    CASE WHEN id % 9 = 0 THEN '{T2}' ELSE '{T1}' END AS modified FROM bronze_listings)"""


@query(f"""WITH {derived.LISTINGS_SQL} SELECT id, name, price, '{T1}' AS valid_from, CASE WHEN id % 9 = 0 THEN '{T2}' END AS valid_to
    FROM bronze_listings
  UNION ALL SELECT id, name || ' (new)', price + 100, '{T2}', NULL FROM bronze_listings WHERE id % 9 = 0""")
def snapshot_listings(t):
    """Eighteen checked columns."""
    return _silver(t).select("id", "name", "price", stamp("valid_from"), stamp("valid_to"))


@query(f"""WITH {derived.LISTINGS_SQL}, {_CURRENT} SELECT SOURCESYSTEM, sha1(CAST(id AS VARCHAR)) AS SK, id AS ID, name AS NAME,
  host_id AS HOST_ID, host_name AS HOST_NAME, room_type AS ROOM_TYPE, modified AS LAST_MODIFIED_AT, {audited_sql(2)} FROM current_listings""")
def gold_listing_dim(t):
    df = lodging.gold_listing_dim(_silver(t), run_at(2))
    return df.select(stamp("SYSLOADDATE"), *AUDITED, "SOURCESYSTEM", "SK", "ID", "NAME", "HOST_ID", "HOST_NAME", "ROOM_TYPE", stamp("LAST_MODIFIED_AT"))


_FACT_COLS = ["VALUE_CATEGORY", "SOURCESYSTEM", "LISTING_SK", "LISTING_ID", "LISTINGS", "HOST_ID", "HOST_NAME", "GEOGRAPHY_ID",
              "BOROUGH_ID", "WARD_ID", "PRICE", "MINIMUM_NIGHTS", "NUMBER_OF_REVIEWS", "HOST_LISTING_COUNT", "AVAILABILITY",
              "LAST_REVIEW_DATE_KEY"]
_FACT = f"""WITH {derived.LISTINGS_SQL}, {derived.PLACES_SQL}, {_CURRENT}
  SELECT CASE WHEN b.price > 200 THEN 'High Value' WHEN b.price > 100 THEN 'Medium Value' ELSE 'Standard' END AS VALUE_CATEGORY,
    b.SOURCESYSTEM, sha1(CAST(d.id AS VARCHAR)) AS LISTING_SK, b.id AS LISTING_ID, d.name AS LISTINGS, d.host_id AS HOST_ID,
    d.host_name AS HOST_NAME, g.geography_id AS GEOGRAPHY_ID, g.borough_id AS BOROUGH_ID, s.ward_id AS WARD_ID, b.price AS PRICE,
    b.minimum_nights AS MINIMUM_NIGHTS, b.number_of_reviews AS NUMBER_OF_REVIEWS,
    b.calculated_host_listings_count AS HOST_LISTING_COUNT, b.availability_365 AS AVAILABILITY,
    strftime(b.last_review, '%Y%m%d') AS LAST_REVIEW_DATE_KEY, CAST(b.reviews_per_month AS DOUBLE) AS REVIEWS_PER_MONTH,
    b.modified AS LAST_MODIFIED_AT
  FROM current_listings b LEFT JOIN current_listings d ON b.id = d.id AND b.host_id = d.host_id
  LEFT JOIN geography g ON b.latitude = g.latitude AND b.longitude = g.longitude
  LEFT JOIN geospatial s ON b.latitude = s.latitude AND b.longitude = s.longitude"""


def gold_fact_frame(t):
    # dimension and fact both read the history, so it is stored once instead of being built twice
    silver = tables.stage(_silver(t), f"{t.work_database()}.silver_listings")
    return lodging.gold_listing_fact(silver, lodging.gold_listing_dim(silver, run_at(2)), derived.geography(t), derived.geospatial(t), run_at(2))


@query(_FACT.replace("SELECT CASE", f"SELECT {audited_sql(2)}, CASE"))
def gold_listing_fact(t):
    """Landing to fact: cast, two history loads, three dimensions, bands, keys, audit columns."""
    return gold_fact_frame(t).select(stamp("SYSLOADDATE"), *AUDITED, *_FACT_COLS, F.col("REVIEWS_PER_MONTH").cast("double").alias("REVIEWS_PER_MONTH"), stamp("LAST_MODIFIED_AT"))


def _stored_build(t, mode):
    """Both deliveries through stored landing, bronze, silver and gold tables."""
    run = t.spark.sparkContext.applicationId.replace("-", "_").upper()
    m = Medallion(t.spark, Layers("DEV"), mode, buckets=8, schema=f"LODGING_{mode.upper()}_{run}")
    m.reset(("LANDING", "BRONZE", "SILVER", "GOLD", "PLATINUM"))
    m.create(work_folder(t.spark, "layers"))
    landing, hit = derived.landing_listings(t), F.col("id").cast("bigint") % 9 == 0
    tables.overwrite(with_audit(landing, run_at(1)), m.name("LANDING", "Listings"))
    tables.overwrite(derived.geography(t), m.name("GOLD", "Dim_Geography"))
    tables.overwrite(derived.geospatial(t), m.name("GOLD", "Dim_Geography_Geospatial"))
    steps = {"bronze_listings", "silver_listings", "gold_dim", "gold_fact"}
    m.run(run_at(1), steps)
    dearer = (typed("price", "bigint") + 100).cast("string")
    tables.update_table(t.spark, m.name("LANDING", "Listings"), hit, {"name": F.concat("name", F.lit(" (new)")), "price": dearer})
    m.run(run_at(2), steps)
    return m.read("GOLD", "Fact_Listings").select(
        *_FACT_COLS, F.col("REVIEWS_PER_MONTH").cast("double").alias("REVIEWS_PER_MONTH"), stamp("LAST_MODIFIED_AT"))


@query(_FACT)
def stored_build_rebuilt(t):
    return _stored_build(t, "table")


@query(_FACT)
def stored_build_incremental(t):
    return _stored_build(t, "incremental")


_CHECKS = ("reviews_listing_id_not_null", "reviews_listing_id_is_number", "reviews_row_count", "reviews_content", "drivers_row_count", "drivers_content",
           "fact_listing_unique", "dim_listing_unique", "fact_listing_in_dim")
_SEVEN = (("BRONZE", "Listings"), ("BRONZE", "Reviews"), ("BRONZE", "Drivers"), ("SILVER", "Listings"), ("SILVER", "Reviews"), ("GOLD", "Dim_Listing_Details"), ("GOLD", "Fact_Listings"))


@query(f"""WITH {derived.LISTINGS_SQL}, {derived.REVIEWS_SQL}, {derived.DRIVERS_SQL}
  SELECT 'check' AS kind, unnest([{', '.join(f"'{c}'" for c in _CHECKS)}]) AS name, CAST(0 AS BIGINT) AS n
  UNION ALL SELECT 'rows', unnest(['BRONZE.Listings', 'GOLD.Dim_Listing_Details', 'GOLD.Fact_Listings']), count(*) FROM bronze_listings
  UNION ALL SELECT 'rows', 'SILVER.Listings', count(*) + count(*) FILTER (id % 9 = 0) FROM bronze_listings
  UNION ALL SELECT 'rows', unnest(['BRONZE.Reviews', 'SILVER.Reviews']), count(*) FROM bronze_reviews
  UNION ALL SELECT 'rows', 'BRONZE.Drivers', count(*) FROM drivers""")
def stored_build_seven_steps(t):
    """All seven steps over two deliveries, then the check report and the rows of every table built."""
    run = t.spark.sparkContext.applicationId.replace("-", "_").upper()
    m = Medallion(t.spark, Layers("DEV"), "incremental", buckets=8, schema=f"LODGING_SEVEN_{run}")
    m.reset(("LANDING", "BRONZE", "SILVER", "GOLD", "PLATINUM"))
    m.create(work_folder(t.spark, "layers"))
    tables.overwrite(with_audit(derived.landing_listings(t), run_at(1)), m.name("LANDING", "Listings"))
    tables.overwrite(with_audit(derived.landing_reviews(t), run_at(1)), m.name("LANDING", "Reviews"))
    tables.overwrite(derived.landing_drivers(t).select("payload"), m.name("LANDING", "Drivers"))
    tables.overwrite(derived.geography(t), m.name("GOLD", "Dim_Geography"))
    tables.overwrite(derived.geospatial(t), m.name("GOLD", "Dim_Geography_Geospatial"))
    m.run(run_at(1))
    tables.update_table(t.spark, m.name("LANDING", "Listings"), F.col("id").cast("bigint") % 9 == 0, {"name": F.lit("new")})
    m.run(run_at(2))
    checks = m.check().select(F.lit("check").alias("kind"), F.col("check_name").alias("name"), F.col("failures").alias("n"))
    counts = count_report({f"{layer}.{table}": m.read(layer, table) for layer, table in _SEVEN})
    return checks.unionByName(counts.select(F.lit("rows").alias("kind"), F.col("table_name").alias("name"), F.col("row_count").alias("n")))


_LAYER_NAMES = [("LANDING", "Listings", "id", "name"), ("BRONZE", "Listings", "id", "name"), ("SILVER", "Listings", "id", "name"),
                ("GOLD", "Dim_Listing_Details", "ID", "NAME"), ("GOLD", "Fact_Listings", "LISTING_ID", "LISTINGS")]


@query(f"""WITH {derived.LISTINGS_SQL}, l AS (SELECT unnest(['LANDING.Listings', 'BRONZE.Listings', 'SILVER.Listings', 'GOLD.Dim_Listing_Details', 'GOLD.Fact_Listings']) AS layer),
  r AS (SELECT unnest(['SYSADMIN', 'QA_READONLY']) AS role)
  SELECT layer, role, id, CASE WHEN role = 'SYSADMIN' THEN name ELSE '*** MASKED ***' END AS name FROM bronze_listings, l, r""")
def tags_through_layers(t):
    """One tag on a landing column masks what comes from it in every layer, also for who reads the bindings from their table."""
    run = t.spark.sparkContext.applicationId.replace("-", "_").upper()
    mask = constant_mask("pii_text", MASKED, allow=("SYSADMIN",))
    m = Medallion(t.spark, Layers("TEST"), schema=f"LODGING_TAGS_{run}")
    m.reset(("LANDING", "BRONZE", "SILVER", "GOLD", "PLATINUM"))
    m.create(work_folder(t.spark, "layers"))
    m.bindings.create_tag("pii", propagate=True).tag_mask("pii", mask).tag(m.name("LANDING", "Listings"), "name", "pii", "name")
    tables.overwrite(with_audit(derived.landing_listings(t), run_at(1)), m.name("LANDING", "Listings"))
    tables.overwrite(derived.geography(t), m.name("GOLD", "Dim_Geography"))
    tables.overwrite(derived.geospatial(t), m.name("GOLD", "Dim_Geography_Geospatial"))
    m.run(run_at(1), {"bronze_listings", "silver_listings", "gold_dim", "gold_fact"})
    stored = m.name("GOLD", "Bindings")
    save_bindings(t.spark, m.bindings, stored)
    catalog = GovernedCatalog(t.spark, load_bindings(t.spark, stored, masks=[mask]))
    out = [
        catalog.read(m.name(layer, table), role).select(
            F.lit(f"{layer}.{table}").alias("layer"), F.lit(role).alias("role"), F.col(key).cast("bigint").alias("id"), F.col(name).alias("name"))
        for layer, table, key, name in _LAYER_NAMES for role in ("SYSADMIN", "QA_READONLY")
    ]
    return reduce(lambda a, b: a.unionByName(b), out)


@query("""SELECT c_custkey AS ID, c_name AS NAME, sha1(concat_ws('||', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR))) AS SK,
  c_mktsegment FROM customer""")
def dimension_with_two_part_key(t):
    snap = snapshot_check(t.customer, None, ["c_custkey"], ["c_name"], run_at(1))
    df = build_dim(snap, ["c_custkey", "c_nationkey"], {"c_custkey": "ID", "c_name": "NAME"}, run_at(1), carry=("c_mktsegment",))
    return df.select("ID", "NAME", "SK", "c_mktsegment")


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS valid_from,
    CASE WHEN o_orderkey % 11 = 0 THEN '2025-01-01' END AS valid_to FROM orders
  UNION ALL SELECT o_orderkey, 'X', '2025-01-01', NULL FROM orders WHERE o_orderkey % 11 = 0""")
def snapshot_timestamp_null_times(t):
    """A stored version without a time gives way to one that has a time; a row that has lost its time changes nothing."""
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    first = t.orders.select("o_orderkey", "o_orderstatus", F.when(k % 11 != 0, at).alias("changed_at"))
    dated = F.when(k % 11 == 0, F.lit("2025-01-01").cast("timestamp")).when(k % 13 != 0, at)
    second = t.orders.select("o_orderkey", F.when(k % 11 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), dated.alias("changed_at"))
    held = snapshot_timestamp(first, None, ["o_orderkey"], "changed_at", run_at(1))
    out = snapshot_timestamp(second, held, ["o_orderkey"], "changed_at", run_at(2))
    return out.select("o_orderkey", "o_orderstatus", day("valid_from"), day("valid_to"))
