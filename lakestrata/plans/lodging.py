"""The lodging data set: listings, reviews and drivers through all layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.keys import band, date_key
from lakestrata.operators.audit import AUDIT_COLUMNS, SOURCE_SYSTEM, with_audit
from lakestrata.operators.history import DEFAULT, HistoryColumns
from lakestrata.operators.shaping import alias_copies, cast_columns, flatten_variant
from lakestrata.operators.star import Dim, build_dim, build_fact
from lakestrata.settings import RunContext

SCHEMA = "LODGING"

# Business columns of a listing and their bronze types.
LISTING_TYPES = {
    "id": "bigint",
    "name": "string",
    "host_id": "bigint",
    "host_name": "string",
    "neighbourhood_group": "string",
    "neighbourhood": "string",
    "latitude": "decimal(17,15)",
    "longitude": "decimal(24,21)",
    "room_type": "string",
    "price": "bigint",
    "minimum_nights": "bigint",
    "number_of_reviews": "bigint",
    "last_review": "date",
    "reviews_per_month": "decimal(5,2)",
    "calculated_host_listings_count": "bigint",
    "availability_365": "bigint",
    "number_of_reviews_ltm": "bigint",
    "license": "string",
}

# Business columns of a review and their bronze types.
REVIEW_TYPES = {
    "listing_id": "bigint",
    "id": "bigint",
    "date": "date",
    "reviewer_id": "bigint",
    "reviewer_name": "string",
    "comments": "string",
}
COMMENT_COPIES = ["comments2", "comments3", "comments4"]

# Driver columns, where each sits in the document, and its type.
DRIVER_FIELDS = {
    "SOURCESYSTEM": ("SOURCESYSTEM", "string"),
    "code": ("code", "string"),
    "dob": ("dob", "date"),
    "driverId": ("driverId", "bigint"),
    "driverRef": ("driverRef", "string"),
    "forename": ("name.forename", "string"),
    "surname": ("name.surname", "string"),
    "nationality": ("nationality", "string"),
    "number": ("number", "bigint"),
    "url": ("url", "string"),
}

# Price bands; the floor itself belongs to the band below.
PRICE_BANDS = [(200, "High Value"), (100, "Medium Value")]
LOWEST_BAND = "Standard"

# Reference dimensions, kept outside the build.
GEOGRAPHY = T.StructType([
    T.StructField("geography_id", T.DecimalType(38, 0)),
    T.StructField("borough_id", T.DecimalType(38, 0)),
    T.StructField("latitude", T.DecimalType(10, 8)),
    T.StructField("longitude", T.DecimalType(11, 8)),
    T.StructField("geo_point", T.BinaryType()),
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("neighbourhood_group", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("zipcode", T.StringType()),
])
GEOSPATIAL = T.StructType([
    T.StructField("geospatial_id", T.DecimalType(38, 0)),
    T.StructField("geography_id", T.DecimalType(38, 0)),
    T.StructField("ward_id", T.DecimalType(38, 0)),
    T.StructField("location_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("latitude", T.DecimalType(10, 8)),
    T.StructField("longitude", T.DecimalType(11, 8)),
    T.StructField("geo_point", T.BinaryType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("zipcode", T.StringType()),
])


def landing_schema(columns: list[str]) -> T.StructType:
    """Audit columns, source system, then text."""
    audit = [T.StructField(AUDIT_COLUMNS[0], T.TimestampType(), False)]
    audit += [T.StructField(c, T.StringType(), False) for c in (*AUDIT_COLUMNS[1:], SOURCE_SYSTEM)]
    return T.StructType(audit + [T.StructField(c, T.StringType()) for c in columns])


def _typed(landing: DataFrame, types: dict[str, str]) -> DataFrame:
    return cast_columns(landing.select(SOURCE_SYSTEM, *types), {c: t for c, t in types.items() if t != "string"})


def bronze_listings(landing: DataFrame, ctx: RunContext) -> DataFrame:
    return with_audit(_typed(landing, LISTING_TYPES), ctx)


def landed_reviews(landing: DataFrame) -> DataFrame:
    """Review business columns as bronze holds them; the reconciliation uses the same projection."""
    return alias_copies(_typed(landing, REVIEW_TYPES), "comments", COMMENT_COPIES)


def bronze_reviews(landing: DataFrame, ctx: RunContext) -> DataFrame:
    return with_audit(landed_reviews(landing), ctx)


def bronze_drivers(landing: DataFrame, ctx: RunContext) -> DataFrame:
    return with_audit(flatten_variant(landing.select("payload"), DRIVER_FIELDS), ctx)


def silver_source(bronze: DataFrame, types: dict[str, str], ctx: RunContext) -> DataFrame:
    """Rows offered to the history: fresh audit columns, business columns."""
    return with_audit(bronze.select(SOURCE_SYSTEM, *types), ctx)


# Columns of the listing dimension, by silver column.
DIM_COLUMNS = {"id": "ID", "name": "NAME", "host_id": "HOST_ID", "host_name": "HOST_NAME", "room_type": "ROOM_TYPE"}


def gold_listing_dim(silver: DataFrame, ctx: RunContext, names: HistoryColumns = DEFAULT) -> DataFrame:
    return build_dim(silver, ["id"], DIM_COLUMNS, ctx, names=names, carry=(SOURCE_SYSTEM,))


def gold_listing_fact(silver: DataFrame, listing_dim: DataFrame, geography: DataFrame, geospatial: DataFrame,
                      ctx: RunContext, names: HistoryColumns = DEFAULT, duplicates: str = "raise") -> DataFrame:
    """Current listings with their keys; a listing without a match keeps NULL keys.

    The listing dimension holds one open version per id, which the history
    load has enforced; the places come from outside and are checked here.
    Silver and the dimension are stored in buckets of the id, so they are
    joined without a shuffle; the host must agree beside it.
    """
    here = {"latitude": "latitude", "longitude": "longitude"}
    dims = [
        Dim(listing_dim, {"id": "ID"},
            {"SK": "LISTING_SK", "NAME": "LISTINGS", "HOST_ID": "DIM_HOST_ID", "HOST_NAME": "DIM_HOST_NAME"}, "trusted", also={"host_id": "HOST_ID"}),
        Dim(geography, here, {"geography_id": "GEOGRAPHY_ID", "borough_id": "BOROUGH_ID"}, duplicates, spread_nulls=True),
        Dim(geospatial, here, {"ward_id": "WARD_ID"}, duplicates, spread_nulls=True),
    ]
    # Names of the fact's columns.
    outputs = {
        "VALUE_CATEGORY": band("price", PRICE_BANDS, LOWEST_BAND),
        SOURCE_SYSTEM: F.col(SOURCE_SYSTEM),
        "LISTING_SK": F.col("LISTING_SK"),
        "LISTING_ID": F.col("id"),
        "LISTINGS": F.col("LISTINGS"),
        "HOST_ID": F.col("DIM_HOST_ID"),
        "HOST_NAME": F.col("DIM_HOST_NAME"),
        "GEOGRAPHY_ID": F.col("GEOGRAPHY_ID"),
        "BOROUGH_ID": F.col("BOROUGH_ID"),
        "WARD_ID": F.col("WARD_ID"),
        "PRICE": F.col("price"),
        "MINIMUM_NIGHTS": F.col("minimum_nights"),
        "NUMBER_OF_REVIEWS": F.col("number_of_reviews"),
        "HOST_LISTING_COUNT": F.col("calculated_host_listings_count"),
        "AVAILABILITY": F.col("availability_365"),
        "LAST_REVIEW_DATE_KEY": date_key("last_review"),
        "REVIEWS_PER_MONTH": F.col("reviews_per_month"),
        "LAST_MODIFIED_AT": F.col(names.updated_at),
    }
    return build_fact(silver, dims, outputs, ctx, names)
