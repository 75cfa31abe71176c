"""Joins to dimensions, facts, summaries, ordering."""

from pyspark.sql import functions as F

from lakestrata.functions.keys import band, date_key, surrogate_key
from lakestrata.operators.quality import compare_row_count
from lakestrata.operators.star import Dim, star_join, summarize_by, top_n
from lakestrata.plans import lodging
from workload import derived
from workload.registration import query, run_at


@query("""SELECT o_orderkey, o_custkey, r_regionkey, r_name FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def inner_join_using(t):
    hosts = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    return (
        t.orders.join(hosts, "o_custkey").join(t.nation, "n_nationkey")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("o_orderkey", "o_custkey", "r_regionkey", "r_name")
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, d.o_custkey AS custkey, d.o_orderstatus AS status
  FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_custkey % 4 <> 0) d
    ON l_orderkey = d.o_orderkey AND l_linenumber = d.o_orderkey % 7 + 1""")
def left_join_two_keys(t):
    """Both keys must match; other rows keep NULL dimension columns."""
    dim = t.orders.filter(F.col("o_custkey") % 4 != 0).select("*", (F.col("o_orderkey") % 7 + 1).cast("int").alias("line"))
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return star_join(fact, [Dim(dim, {"l_orderkey": "o_orderkey", "l_linenumber": "line"}, {"o_custkey": "custkey", "o_orderstatus": "status"})])


_COORD = """WITH {l}, {p} SELECT b.id, g.geography_id, g.borough_id, s.ward_id FROM bronze_listings b
  LEFT JOIN geography g ON b.latitude = g.latitude AND b.longitude = g.longitude
  LEFT JOIN geospatial s ON b.latitude = s.latitude AND b.longitude = s.longitude""".format(
    l=derived.LISTINGS_SQL, p=derived.PLACES_SQL)


@query(_COORD)
def coordinate_joins(t):
    """Exact decimal equality on both coordinates, against two dimensions of another precision."""
    fact = lodging.bronze_listings(derived.landing_listings(t), run_at(1)).select("id", "latitude", "longitude")
    here = {"latitude": "latitude", "longitude": "longitude"}
    out = star_join(fact, [
        Dim(derived.geography(t), here, {"geography_id": "geography_id", "borough_id": "borough_id"}),
        Dim(derived.geospatial(t), here, {"ward_id": "ward_id"}),
    ])
    return out.select("id", "geography_id", "borough_id", "ward_id")


_STAR = """SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_extendedprice > 60000 THEN 'High Value'
    WHEN l_extendedprice > 20000 THEN 'Medium Value' ELSE 'Standard' END AS value_category,
  sha1(CAST(o.o_orderkey AS VARCHAR)) AS order_sk, o.o_orderstatus AS order_status, p.p_brand AS brand, s.s_name AS supplier,
  strftime(l_shipdate, '%Y%m%d') AS ship_date_key
  FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 10 <> 0) o ON l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l_partkey = p.p_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 6 <> 0) s ON l_suppkey = s.s_suppkey"""


def _order_fact(t, salt=1):
    orders = t.orders.filter(F.col("o_orderkey") % 10 != 0).select("o_orderkey", "o_orderstatus", surrogate_key("o_orderkey").alias("sk"))
    suppliers = t.supplier.filter(F.col("s_suppkey") % 6 != 0)
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    joined = star_join(fact, [
        Dim(orders, {"l_orderkey": "o_orderkey"}, {"sk": "order_sk", "o_orderstatus": "order_status"}, salt=salt),
        Dim(t.part, {"l_partkey": "p_partkey"}, {"p_brand": "brand"}),
        Dim(suppliers, {"l_suppkey": "s_suppkey"}, {"s_name": "supplier"}),
    ])
    bands = [(60000, "High Value"), (20000, "Medium Value")]
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", band("l_extendedprice", bands, "Standard").alias("value_category"),
                         "order_sk", "order_status", "brand", "supplier", date_key("l_shipdate").alias("ship_date_key"))


@query(_STAR)
def star_fact(t):
    return _order_fact(t)


@query(_STAR)
def star_fact_salted(t):
    """The same fact with the order key spread over four tasks each."""
    return _order_fact(t, salt=4)


@query("""SELECT value_category, count(*) AS row_count, round(avg(l_extendedprice), 4) AS avg_price,
  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
  FROM (SELECT l_extendedprice, CASE WHEN l_extendedprice > 60000 THEN 'High Value'
    WHEN l_extendedprice > 20000 THEN 'Medium Value' ELSE 'Standard' END AS value_category FROM lineitem)
  GROUP BY value_category ORDER BY value_category""")
def value_category_summary(t):
    bands = [(60000, "High Value"), (20000, "Medium Value")]
    df = t.lineitem.select(F.col("l_extendedprice").alias("price"), band("l_extendedprice", bands, "Standard").alias("value_category"))
    out = summarize_by(df, "value_category", "price")
    return out.withColumn("avg_price", F.round("avg_price", 4))


@query("""SELECT count(*) AS source_count, (SELECT count(*) FROM lineitem) AS target_count,
  abs(count(*) - (SELECT count(*) FROM lineitem)) AS difference FROM orders""")
def count_theta_join(t):
    """Both counts side by side, only where they differ."""
    return compare_row_count(t.orders, t.lineitem)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def ordered_sample(t):
    return top_n(t.orders.select("o_orderkey", "o_totalprice"), 5, F.col("o_totalprice").desc(), F.col("o_orderkey").asc())


@query("""SELECT o_orderpriority, o_orderkey, o_orderstatus FROM orders ORDER BY 1, 2""")
def order_by_position(t):
    return t.orders.select("o_orderpriority", "o_orderkey", "o_orderstatus").orderBy(1, 2)


@query("""SELECT o_orderkey AS k, 'orders' AS origin FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer""")
def union_all_rows(t):
    return t.orders.select(F.col("o_orderkey").alias("k"), F.lit("orders").alias("origin")).unionByName(
        t.customer.select(F.col("c_custkey").alias("k"), F.lit("customer").alias("origin")))
