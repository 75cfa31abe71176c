"""Audit columns, casts, renames, filters and scalar functions."""

from pyspark.sql import functions as F

from lakestrata.functions.casting import typed
from lakestrata.functions.keys import band, date_key, surrogate_key
from lakestrata.functions.text import equals_ignoring_case, in_ignoring_case, star_after_each
from lakestrata.functions.variant import field, set_field, subtree
from lakestrata.operators.audit import with_audit
from lakestrata.operators.shaping import (
    alias_copies,
    as_text,
    cast_columns,
    flatten_variant,
    rename,
    split_bad_rows,
    sync_columns,
)
from lakestrata.plans import lodging
from workload import derived
from workload.registration import AUDITED, audited_sql, day, query, run_at, stamp


@query("""SELECT '2025-01-10 08:00:00' AS SYSLOADDATE, 'run-1' AS SYSRUNID, 'spark' AS SYSPROCESSINGTOOL,
  'workload' AS SYSDATAPROCESSORNAME, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def audit_columns(t):
    df = with_audit(t.customer, run_at(1))
    return df.select(stamp("SYSLOADDATE"), *df.columns[1:])


@query("""SELECT 'run-2' AS SYSRUNID, o_orderstatus AS SOURCESYSTEM, o_orderkey FROM orders""")
def audit_carry_through(t):
    """A second layer refreshes the audit columns and keeps the source system."""
    first = with_audit(t.orders.select(F.col("o_orderstatus").alias("SOURCESYSTEM"), "o_orderkey"), run_at(1))
    return with_audit(first, run_at(2)).select("SYSRUNID", "SOURCESYSTEM", "o_orderkey")


_LISTING_OUT = """SELECT SOURCESYSTEM, id, name, host_id, host_name, neighbourhood_group, neighbourhood,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, room_type, price, minimum_nights,
  number_of_reviews, strftime(last_review, '%Y-%m-%d') AS last_review, CAST(reviews_per_month AS DOUBLE) AS reviews_per_month,
  calculated_host_listings_count, availability_365, number_of_reviews_ltm, license FROM bronze_listings"""


@query(f"WITH {derived.LISTINGS_SQL} {_LISTING_OUT}".replace("license FROM", f"license, {audited_sql(1)} FROM"))
def bronze_listings(t):
    """Typed projection of all listing columns, behind the audit columns."""
    df = lodging.bronze_listings(derived.landing_listings(t), run_at(1))
    doubles = {c: F.col(c).cast("double").alias(c) for c in ("latitude", "longitude", "reviews_per_month")}
    keep = ["SOURCESYSTEM", *lodging.LISTING_TYPES]
    return df.select(stamp("SYSLOADDATE"), *AUDITED, *[doubles.get(c, day(c) if c == "last_review" else F.col(c)) for c in keep])


@query(f"""WITH {derived.REVIEWS_SQL} SELECT SOURCESYSTEM, listing_id, id, strftime(date, '%Y-%m-%d') AS date, reviewer_id,
  reviewer_name, comments, comments2, comments3, comments4, {audited_sql(1)} FROM bronze_reviews""")
def bronze_reviews(t):
    df = lodging.bronze_reviews(derived.landing_reviews(t), run_at(1))
    keep = ["SOURCESYSTEM", *lodging.REVIEW_TYPES, *lodging.COMMENT_COPIES]
    return df.select(stamp("SYSLOADDATE"), *AUDITED, *[day(c) if c == "date" else F.col(c) for c in keep])


@query(f"""WITH {derived.DRIVERS_SQL} SELECT SOURCESYSTEM, code, dob, driverId, driverRef, forename, surname, nationality,
  number, url, {audited_sql(1)} FROM drivers""")
def bronze_drivers(t):
    """Documents flattened to typed columns, nested ones included."""
    df = lodging.bronze_drivers(derived.landing_drivers(t), run_at(1))
    return df.select(stamp("SYSLOADDATE"), *AUDITED, *[day(c) if c == "dob" else F.col(c) for c in lodging.DRIVER_FIELDS])


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  o_orderpriority FROM orders""")
def cast_round_trip(t):
    """Order columns as landed text and back to their types."""
    spec = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "timestamp_ntz"}
    df = cast_columns(as_text(t.orders), spec)
    return df.select(*[day(c) if c == "o_orderdate" else F.col(c) for c in df.columns])


@query("""SELECT event_id, CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,0)) AS BIGINT) AS whole_value FROM events""")
def cast_rounds_half_up(t):
    return t.events.select("event_id", typed(F.col("value").cast("string"), "bigint").alias("whole_value"))


@query("""SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS BIGINT)
  AS landed FROM orders""")
def cast_bad_value_to_null(t):
    k = F.col("o_orderkey")
    landed = t.orders.select(k, F.when(k % 3 == 0, F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string")).alias("landed"))
    return cast_columns(landed, {"landed": "bigint"}, on_error="null")


@query("""SELECT o_orderkey, o_orderpriority AS landed, 'bad' AS outcome FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, CAST(o_custkey AS VARCHAR), 'good' FROM orders WHERE o_orderkey % 3 <> 0""")
def cast_quarantine(t):
    k = F.col("o_orderkey")
    landed = t.orders.select(k, F.when(k % 3 == 0, F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string")).alias("landed"))
    good, bad = split_bad_rows(landed, {"landed": "bigint"})
    return as_text(good, keep=("o_orderkey",)).withColumn("outcome", F.lit("good")).unionByName(bad.withColumn("outcome", F.lit("bad")))


@query("SELECT doc_id, text AS comments, text AS comments2, text AS comments3 FROM documents")
def column_copies(t):
    return alias_copies(t.documents.select("doc_id", F.col("text").alias("comments")), "comments", ["comments2", "comments3"])


@query("SELECT p_partkey AS ID, p_name AS NAME, p_retailprice AS PRICE FROM part")
def rename_subset(t):
    return rename(t.part, {"p_partkey": "ID", "p_name": "NAME", "p_retailprice": "PRICE"})


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) = 7")
def equality_filter_after_cast(t):
    df = as_text(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), keep=("o_orderkey",))
    return df.filter(typed("o_custkey", "bigint") == 7).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE lower(o_orderpriority) IN ('1-urgent', '5-low')")
def in_list_ignoring_case(t):
    return t.orders.filter(in_ignoring_case(F.col("o_orderpriority"), ["1-Urgent", "5-LOW"])).select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'")
def equals_ignoring_case_filter(t):
    return t.customer.filter(equals_ignoring_case(F.col("c_mktsegment"), "Building")).select("c_custkey", "c_mktsegment")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_extendedprice > 60000 THEN 'High Value'
  WHEN l_extendedprice > 20000 THEN 'Medium Value' ELSE 'Standard' END AS value_category FROM lineitem""")
def value_band(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice",
                             band("l_extendedprice", [(60000, "High Value"), (20000, "Medium Value")], "Standard").alias("value_category"))


@query("""SELECT l_orderkey, l_partkey, sha1(concat_ws('||', CAST(l_orderkey AS VARCHAR),
  COALESCE(CAST(CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END AS VARCHAR), ''))) AS sk FROM lineitem""")
def surrogate_keys(t):
    part = F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey"))
    return t.lineitem.select("l_orderkey", "l_partkey", surrogate_key("l_orderkey", part).alias("sk"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 9 <> 0 THEN strftime(l_shipdate, '%Y%m%d') END AS ship_key FROM lineitem""")
def date_keys(t):
    d = F.when(F.col("l_orderkey") % 9 != 0, F.col("l_shipdate"))
    return t.lineitem.select("l_orderkey", "l_linenumber", date_key(d).alias("ship_key"))


@query("""SELECT doc_id, regexp_replace(text, '(.{1}).', '\\1*', 'g') AS every_second,
  regexp_replace(text, '(.{4}).', '\\1*', 'g') AS every_fifth FROM documents""")
def starred_text(t):
    c = F.col("text")
    return t.documents.select("doc_id", star_after_each(c, 1).alias("every_second"), star_after_each(c, 4).alias("every_fifth"))


@query("""SELECT upper(trim('  ' || r_name || ' ')) AS name, lower(r_name) AS lower_name, COALESCE(NULLIF(r_name, 'ASIA'), '-') AS filled
  FROM region""")
def text_clean_up(t):
    r = F.col("r_name")
    return t.region.select(F.upper(F.trim(F.concat(F.lit("  "), r, F.lit(" ")))).alias("name"), F.lower(r).alias("lower_name"),
                           F.coalesce(F.nullif(r, F.lit("ASIA")), F.lit("-")).alias("filled"))


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(t):
    df = t.events.select("event_id", "event_type", F.parse_json("props").alias("payload"))
    return flatten_variant(df, {"k": ("k", "bigint")})


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS good,
  TRY_CAST(json_extract_string(props, '$.missing') AS BIGINT) AS absent, CAST(NULL AS DATE) IS NULL AS bad_is_null FROM events""")
def json_flatten_lenient(t):
    df = t.events.select("event_id", F.parse_json("props").alias("payload"))
    out = flatten_variant(df, {"good": ("k", "bigint"), "absent": ("missing", "bigint"), "bad": ("k", "date")}, on_error="null")
    return out.select("event_id", "good", "absent", F.col("bad").isNull().alias("bad_is_null"))


@query(f"WITH {derived.DRIVERS_SQL} SELECT c_custkey, nationality, forename, surname FROM drivers")
def variant_nested_path(t):
    return derived.landing_drivers(t).select(
        "c_custkey", field("payload", "nationality").alias("nationality"), field("payload", "name.forename").alias("forename"), field("payload", "name.surname").alias("surname"))


@query(f"""WITH {derived.DRIVERS_SQL} SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0
  THEN '{{"forename":"' || forename || '","surname":"' || surname || '"}}' END AS name_document FROM drivers""")
def variant_subtree(t):
    return derived.landing_drivers(t).select("c_custkey", F.to_json(subtree("payload", "name")).alias("name_document"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind, '*' AS k_masked FROM events""")
def variant_set_field(t):
    p = F.parse_json("props")
    added = set_field(p, ["kind"], F.col("event_type"))
    replaced = set_field(p, ["k"], F.lit("*"))
    return t.events.select("event_id", field(added, "k", "bigint").alias("k"), field(added, "kind").alias("kind"),
                           field(replaced, "k").alias("k_masked"))


@query(f"""WITH {derived.DRIVERS_SQL} SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN '#' END AS forename, surname, url FROM drivers""")
def variant_set_nested_field(t):
    """Without a name object there is nothing to set the forename on."""
    p = set_field("payload", ["name", "forename"], F.lit("#"))
    return derived.landing_drivers(t).select(
        "c_custkey", field(p, "name.forename").alias("forename"), field(p, "name.surname").alias("surname"), field(p, "url").alias("url"))


@query("""SELECT p_partkey, p_name, p_retailprice, CAST(NULL AS VARCHAR) AS p_origin FROM part""")
def schema_sync(t):
    """The existing rows fitted to a delivery that lost three columns and gained one."""
    incoming = t.part.select("p_partkey", "p_name", "p_retailprice", F.lit("x").alias("p_origin"))
    return sync_columns(t.part, incoming.schema)
