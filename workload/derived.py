"""Landing-shaped inputs derived from the driver tables, in Spark and as SQL.

Orders stand in for listings, documents for reviews, customers for driver
documents, parts and suppliers for the two places dimensions.  Every row of
the base table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workload.registration import Tables


def latitude(k: Column) -> Column:
    return F.concat(F.lit("51."), F.lpad((k % 1000000).cast("string"), 6, "0"))


def longitude(k: Column) -> Column:
    return F.concat(F.lit("-0."), F.lpad(F.floor(k / 1000000).cast("bigint").cast("string"), 6, "0"))


def landing_listings(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    place = F.col("o_custkey") * 2
    return t.orders.select(
        F.lit("ORDERS").alias("SOURCESYSTEM"),
        k.cast("string").alias("id"),
        F.concat(F.lit("Listing "), k.cast("string")).alias("name"),
        F.col("o_custkey").cast("string").alias("host_id"),
        F.concat(F.lit("Host "), F.col("o_custkey").cast("string")).alias("host_name"),
        F.col("o_orderpriority").alias("neighbourhood_group"),
        F.col("o_orderstatus").alias("neighbourhood"),
        latitude(place).alias("latitude"),
        longitude(place).alias("longitude"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Entire home/apt")
        .when(F.col("o_orderpriority") == "2-HIGH", "Private room")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Shared room")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Hotel room").alias("room_type"),
        F.concat(F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit("."), (k % 10).cast("string")).alias("price"),
        (k % 7 + 1).cast("string").alias("minimum_nights"),
        (k % 200).cast("string").alias("number_of_reviews"),
        F.when(k % 13 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_review"),
        F.concat((k % 10).cast("string"), F.lit("."), F.lpad((k % 1000).cast("string"), 3, "0")).alias("reviews_per_month"),
        (k % 5).cast("string").alias("calculated_host_listings_count"),
        (k % 366).cast("string").alias("availability_365"),
        (k % 60).cast("string").alias("number_of_reviews_ltm"),
        F.when(k % 3 != 0, F.concat(F.lit("LIC"), k.cast("string"))).alias("license"),
    )


LISTINGS_SQL = """
landing_listings AS (
  SELECT 'ORDERS' AS SOURCESYSTEM, CAST(o_orderkey AS VARCHAR) AS id, 'Listing ' || o_orderkey AS name,
    CAST(o_custkey AS VARCHAR) AS host_id, 'Host ' || o_custkey AS host_name,
    o_orderpriority AS neighbourhood_group, o_orderstatus AS neighbourhood,
    '51.' || lpad(CAST((o_custkey * 2) % 1000000 AS VARCHAR), 6, '0') AS latitude,
    '-0.' || lpad(CAST((o_custkey * 2) // 1000000 AS VARCHAR), 6, '0') AS longitude,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Entire home/apt' WHEN '2-HIGH' THEN 'Private room'
      WHEN '3-MEDIUM' THEN 'Shared room' WHEN '4-NOT SPECIFIED' THEN 'Hotel room' END AS room_type,
    CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || '.' || (o_orderkey % 10) AS price,
    CAST(o_orderkey % 7 + 1 AS VARCHAR) AS minimum_nights, CAST(o_orderkey % 200 AS VARCHAR) AS number_of_reviews,
    CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS last_review,
    CAST(o_orderkey % 10 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS reviews_per_month,
    CAST(o_orderkey % 5 AS VARCHAR) AS calculated_host_listings_count, CAST(o_orderkey % 366 AS VARCHAR) AS availability_365,
    CAST(o_orderkey % 60 AS VARCHAR) AS number_of_reviews_ltm,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'LIC' || o_orderkey END AS license
  FROM orders),
bronze_listings AS (
  SELECT SOURCESYSTEM, CAST(id AS BIGINT) AS id, name, CAST(host_id AS BIGINT) AS host_id, host_name,
    neighbourhood_group, neighbourhood, CAST(latitude AS DECIMAL(17,15)) AS latitude,
    CAST(longitude AS DECIMAL(24,21)) AS longitude, room_type,
    CAST(CAST(price AS DECIMAL(38,0)) AS BIGINT) AS price, CAST(minimum_nights AS BIGINT) AS minimum_nights,
    CAST(number_of_reviews AS BIGINT) AS number_of_reviews, CAST(last_review AS DATE) AS last_review,
    CAST(reviews_per_month AS DECIMAL(5,2)) AS reviews_per_month,
    CAST(calculated_host_listings_count AS BIGINT) AS calculated_host_listings_count,
    CAST(availability_365 AS BIGINT) AS availability_365,
    CAST(number_of_reviews_ltm AS BIGINT) AS number_of_reviews_ltm, license
  FROM landing_listings)"""


def landing_reviews(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    return t.documents.select(
        F.col("source").alias("SOURCESYSTEM"),
        F.floor(k / 3).cast("bigint").cast("string").alias("listing_id"),
        k.cast("string").alias("id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 365).cast("int")), "yyyy-MM-dd").alias("date"),
        F.col("n_chars").cast("string").alias("reviewer_id"),
        F.col("lang").alias("reviewer_name"),
        F.col("text").alias("comments"),
    )


REVIEWS_SQL = """
landing_reviews AS (
  SELECT source AS SOURCESYSTEM, CAST(doc_id // 3 AS VARCHAR) AS listing_id, CAST(doc_id AS VARCHAR) AS id,
    strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') AS date,
    CAST(n_chars AS VARCHAR) AS reviewer_id, lang AS reviewer_name, text AS comments
  FROM documents),
bronze_reviews AS (
  SELECT SOURCESYSTEM, CAST(listing_id AS BIGINT) AS listing_id, CAST(id AS BIGINT) AS id, CAST(date AS DATE) AS date,
    CAST(reviewer_id AS BIGINT) AS reviewer_id, reviewer_name, comments,
    comments AS comments2, comments AS comments3, comments AS comments4
  FROM landing_reviews)"""


def nationality() -> Column:
    """'British' for nation 0, absent for nation 1, else the nation's name."""
    return F.when(F.col("n_nationkey") == 0, "British").when(F.col("n_nationkey") != 1, F.col("n_name"))


def landing_drivers(t: Tables) -> DataFrame:
    """One VARIANT document per customer; every seventh has no name object."""
    k = F.col("c_custkey")
    doc = F.to_json(
        F.struct(
            F.lit("CUSTOMERS").alias("SOURCESYSTEM"),
            F.upper(F.substring("c_mktsegment", 1, 3)).alias("code"),
            F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (k % 18000).cast("int")), "yyyy-MM-dd").alias("dob"),
            k.alias("driverId"),
            F.lower("c_name").alias("driverRef"),
            F.when(k % 7 != 0, F.struct(F.substring("c_name", 1, 8).alias("forename"), F.substring("c_name", 10, 9).alias("surname"))).alias("name"),
            nationality().alias("nationality"),
            F.when(k % 2 == 0, k % 100).alias("number"),
            F.concat(F.lit("https://example.org/"), k.cast("string")).alias("url"),
        )
    )
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "c_mktsegment", F.parse_json(doc).alias("payload"))


DRIVERS_SQL = """
drivers AS (
  SELECT c_custkey, c_mktsegment, 'CUSTOMERS' AS SOURCESYSTEM, upper(substr(c_mktsegment, 1, 3)) AS code,
    strftime(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER), '%Y-%m-%d') AS dob,
    c_custkey AS driverId, lower(c_name) AS driverRef,
    CASE WHEN c_custkey % 7 <> 0 THEN substr(c_name, 1, 8) END AS forename,
    CASE WHEN c_custkey % 7 <> 0 THEN substr(c_name, 10, 9) END AS surname,
    CASE WHEN n_nationkey = 0 THEN 'British' WHEN n_nationkey <> 1 THEN n_name END AS nationality,
    CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 100 END AS number,
    'https://example.org/' || c_custkey AS url
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def geography(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        (k + 1).alias("geography_id"),
        F.col("p_size").cast("bigint").alias("borough_id"),
        latitude(k).cast("decimal(10,8)").alias("latitude"),
        longitude(k).cast("decimal(11,8)").alias("longitude"),
    )


def geospatial(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(
        (k + 2001).alias("ward_id"),
        latitude(k).cast("decimal(10,8)").alias("latitude"),
        longitude(k).cast("decimal(11,8)").alias("longitude"),
    )


PLACES_SQL = """
geography AS (
  SELECT p_partkey + 1 AS geography_id, CAST(p_size AS BIGINT) AS borough_id,
    CAST('51.' || lpad(CAST(p_partkey % 1000000 AS VARCHAR), 6, '0') AS DECIMAL(10,8)) AS latitude,
    CAST('-0.' || lpad(CAST(p_partkey // 1000000 AS VARCHAR), 6, '0') AS DECIMAL(11,8)) AS longitude
  FROM part),
geospatial AS (
  SELECT s_suppkey + 2001 AS ward_id,
    CAST('51.' || lpad(CAST(s_suppkey % 1000000 AS VARCHAR), 6, '0') AS DECIMAL(10,8)) AS latitude,
    CAST('-0.' || lpad(CAST(s_suppkey // 1000000 AS VARCHAR), 6, '0') AS DECIMAL(11,8)) AS longitude
  FROM supplier)"""


# Two later deliveries of the same data: rows changed, rows gone, rows new.


def later_orders(t: Tables) -> DataFrame:
    """Next delivery: every 7th key changes status, every 11th goes NULL on priority, every 13th is gone,
    and each 5th comes again under a new key."""
    k = F.col("o_orderkey")
    base = t.orders.filter(k % 13 != 0).withColumns({
        "o_orderstatus": F.when(k % 7 == 0, "X").otherwise(F.col("o_orderstatus")),
        "o_orderpriority": F.when(k % 11 != 0, F.col("o_orderpriority")),
    })
    fresh = t.orders.filter(k % 5 == 0).withColumn("o_orderkey", k + 1000000000000)
    return base.unionByName(fresh)


LATER_ORDERS_SQL = """
later_orders AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 13 <> 0
  UNION ALL
  SELECT o_orderkey + 1000000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 5 = 0)"""


def altered_lines(t: Tables) -> DataFrame:
    """A faulty copy of the order lines: some values differ, some rows are missing, some occur twice."""
    k = F.col("l_orderkey")
    base = t.lineitem.filter(k % 101 != 0).withColumn(
        "l_returnflag", F.when(k % 97 == 0, "Z").otherwise(F.col("l_returnflag"))
    )
    return base.unionByName(t.lineitem.filter(k % 89 == 0))


ALTERED_LINES_SQL = """
altered_lines AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 THEN 'Z' ELSE l_returnflag END AS l_returnflag)
  FROM lineitem WHERE l_orderkey % 101 <> 0
  UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 89 = 0)"""
