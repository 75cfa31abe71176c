from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from conftest import rows
from lakestrata.functions.casting import typed
from lakestrata.functions.keys import band, date_key, surrogate_key
from lakestrata.functions.text import star_after_each
from lakestrata.functions.variant import field, set_field
from lakestrata.functions.widening import common_type
from lakestrata.operators.audit import AUDIT_COLUMNS, with_audit
from lakestrata.operators.shaping import cast_columns, flatten_variant, split_bad_rows, sync_columns
from lakestrata.plans import lodging
import fixtures


def one(spark, col, **lits):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in lits.items()], F.lit(0).alias("z")).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("text,want", [
    ("12.7", 13), ("12.5", 13), ("-12.5", -13), ("12.4", 12), (" 7 ", 7), ("1000023182097063235", 1000023182097063235), (None, None),
])
def test_bigint_rounds_half_up(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(typed("x", "bigint")).first()[0] == want


@pytest.mark.parametrize("text,kind", [("R001", "bigint"), ("", "date"), ("123.4", "decimal(17,15)"), ("99999999999999999999", "bigint")])
def test_bad_value_fails_or_turns_null(spark, text, kind):
    df = spark.createDataFrame([(text,)], "x string")
    with pytest.raises(Exception):
        df.select(typed("x", kind)).collect()
    assert df.select(typed("x", kind, on_error="null")).first()[0] is None


def test_text_ids_break_the_review_load(spark, ctx):
    bad = fixtures.landing_reviews(spark).withColumn("id", F.concat(F.lit("R"), F.col("id")))
    with pytest.raises(Exception):
        lodging.bronze_reviews(bad, ctx).collect()


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-01"), ("2", "never"), (None, None)], "a string, b string")
    good, bad = split_bad_rows(df, {"a": "bigint", "b": "date"})
    assert rows(good.filter("a is not null")) == [(1, date(2024, 1, 1))]
    assert good.count() == 2 and rows(bad) == [("2", "never"), ("x", "2024-01-01")]


def test_cast_keeps_column_metadata(spark):
    df = spark.createDataFrame([("1",)], "a string").withMetadata("a", {"tags": {"PII": "x"}})
    assert cast_columns(df, {"a": "bigint"}).schema["a"].metadata == {"tags": {"PII": "x"}}


def test_surrogate_key(spark):
    assert spark.range(1).select(surrogate_key(F.lit(1001))).first()[0] == "dd01903921ea24941c26a48f2cec24e0bb0e8cc7"
    assert spark.range(1).select(surrogate_key(F.lit(None).cast("string"))).first()[0] == "da39a3ee5e6b4b0d3255bfef95601890afd80709"


def test_bands_at_their_edges(spark):
    df = spark.createDataFrame([(100,), (101,), (200,), (201,), (None,)], "p bigint")
    got = [r[0] for r in df.select(band("p", lodging.PRICE_BANDS, lodging.LOWEST_BAND)).collect()]
    assert got == ["Standard", "Medium Value", "Medium Value", "High Value", "Standard"]


def test_date_key(spark):
    assert spark.range(1).select(date_key(F.lit(date(2024, 2, 9)))).first()[0] == "20240209"


@pytest.mark.parametrize("n,want", [(1, "C*l* *a*b*u*"), (4, "Calm*Harb*ur")])
def test_star_after_each(spark, n, want):
    assert spark.range(1).select(star_after_each(F.lit("Calm Harbour"), n)).first()[0] == want


def test_star_after_each_treats_only_line_feed_as_line_end(spark):
    got = spark.range(1).select(star_after_each(F.lit("a\rb c\nd"), 1)).first()[0]
    assert got == "a*b*c\nd"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\n"), max_size=40))
def test_mask_stars_every_second_character(spark, text):
    got = spark.createDataFrame([(text,)], "x string").select(star_after_each(F.col("x"), 1)).first()[0]
    assert got == "".join("*" if i % 2 else c for i, c in enumerate(text))


def doc(spark, text):
    return spark.createDataFrame([(text,)], "j string").select(F.parse_json("j").alias("payload"))


def test_fields_of_a_document(spark):
    d = doc(spark, '{"a":12.7,"b":"x","n":{"f":"y"},"l":[1]}')
    r = d.select(field("payload", "a", "bigint"), field("payload", "b"), field("payload", "n.f"), field("payload", "zz")).first()
    assert tuple(r) == (13, "x", "y", None)
    with pytest.raises(Exception):
        d.select(field("payload", "b", "bigint")).collect()
    assert d.select(field("payload", "b", "bigint", on_error="null")).first()[0] is None


@pytest.mark.parametrize("text,path,want", [
    ('{"n":1,"name":{"f":"A","s":"B"}}', ["name", "f"], '{"n":1,"name":{"f":"#","s":"B"}}'),
    ('{"n":1,"name":{"s":"B"}}', ["name", "f"], '{"n":1,"name":{"f":"#","s":"B"}}'),
    ('{"n":1}', ["name", "f"], '{"n":1}'),
    ('{"n":1,"name":"text"}', ["name", "f"], '{"n":1,"name":"text"}'),
    ('{"n":1,"name":null}', ["name", "f"], '{"n":1,"name":null}'),
    ('{"n":1}', ["n"], '{"n":"#"}'),
    ('{"n":1}', ["new"], '{"n":1,"new":"#"}'),
    ("[1,2]", ["n"], "[1,2]"),
    ('{"a":{"b":{"c":1,"d":null}}}', ["a", "b", "c"], '{"a":{"b":{"c":"#","d":null}}}'),
    (None, ["n"], None),
])
def test_set_field(spark, text, path, want):
    assert doc(spark, text).select(F.to_json(set_field("payload", path, F.lit("#")))).first()[0] == want


def test_documents_with_other_keys_flatten_to_nulls(spark):
    df = flatten_variant(fixtures.landing_drivers(spark), lodging.DRIVER_FIELDS)
    assert df.count() == 2 and all(v is None for r in df.collect() for v in r)


def test_documents_flatten_to_types(spark):
    df = flatten_variant(fixtures.landing_drivers(spark, fixtures.DOCUMENTS), lodging.DRIVER_FIELDS).orderBy("driverId")
    first, second, third = df.collect()
    assert (first["dob"], first["forename"], first["number"]) == (date(1985, 1, 7), "Lewis", 44)
    assert second["driverId"] == 3  # 2.5 rounds up
    assert third["nationality"] is None and third["dob"] is None


def test_audit_columns_lead_and_replace(spark, ctx):
    df = with_audit(with_audit(spark.range(1), ctx), ctx)
    assert df.columns == [*AUDIT_COLUMNS, "id"] and df.first()["SYSRUNID"] == "run-1"


def test_bronze_listing_types(spark, ctx):
    df = lodging.bronze_listings(fixtures.landing_listings(spark), ctx)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert all(kinds[c] == t for c, t in lodging.LISTING_TYPES.items())
    r = df.filter("id = 71").first()
    assert r["latitude"] == Decimal("48.10205") and r["price"] == 410 and r["reviews_per_month"] == Decimal("1.00")


def test_schema_modes(spark):
    df = spark.createDataFrame([(1, "x")], "a int, gone string")
    wanted = spark.createDataFrame([], "a bigint, fresh date").schema
    assert sync_columns(df, wanted).columns == ["a", "fresh"] and sync_columns(df, wanted).schema["a"].dataType.simpleString() == "bigint"
    assert sync_columns(df, wanted, "append_new_columns").columns == ["a", "fresh", "gone"]
    assert sync_columns(df, wanted, "ignore").columns == ["a", "gone"]
    with pytest.raises(ValueError):
        sync_columns(df, wanted, "fail")


@pytest.mark.parametrize("a,b,both", [
    ("int", "bigint", "bigint"), ("smallint", "smallint", "smallint"), ("int", "double", "double"), ("bigint", "double", None), ("float", "double", "double"),
    ("decimal(10,2)", "decimal(12,2)", "decimal(12,2)"), ("decimal(10,2)", "decimal(10,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(10,2)", None),
    ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(10,2)", "decimal(21,2)"), ("void", "date", "date"), ("string", "int", None),
    ("date", "timestamp", None), ("array<int>", "array<int>", "array<int>"), ("array<int>", "array<bigint>", None)])
def test_common_types(spark, a, b, both):
    x, y = (spark.createDataFrame([], f"c {t}").schema["c"].dataType if t != "void" else NullType() for t in (a, b))
    for found in (common_type(x, y), common_type(y, x)):
        assert (found and found.simpleString()) == both
