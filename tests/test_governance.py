import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import rows
from lakestrata.functions.variant import field
from lakestrata.operators.governance import (
    COLUMN_MASK,
    MASKED,
    TABLE_MASK,
    Bindings,
    category_policy,
    constant_mask,
    distinct_visible,
    field_mask,
    governed,
    partial_name_mask,
    payload_mask,
    payload_policy,
    person_mask,
    person_mask_both_names,
    python_mask,
    python_policy,
)
from lakestrata.sources import tables
from lakestrata.sources.governed import GovernedCatalog, RestrictedError

ROLES = ["ACCOUNTADMIN", "SYSADMIN", "BI_READONLY", "QA_READONLY", "BI"]


def listings(spark):
    return fixtures.landing_listings(spark).select("id", "name", "room_type")


def names(df):
    return [tuple(r) for r in df.select(field("payload", "name.forename"), field("payload", "name.surname")).collect()]


@pytest.mark.parametrize("role,first,room", [
    ("ACCOUNTADMIN", "Lodging No. 0", "Lodging No. 3"),
    ("SYSADMIN", "Lodging No. 0", "Lodging No. 3"),
    ("BI_READONLY", "Lodg*ng N*. 0", "L*d*i*g*N*.*3"),
    ("QA_READONLY", MASKED, MASKED),
    ("BI", MASKED, MASKED),
])
def test_partial_mask(spark, role, first, room):
    b = Bindings().set_mask("t", "name", partial_name_mask(), ("room_type",))
    got = {r["id"]: r["name"] for r in governed(listings(spark), "t", b, role).collect()}
    assert (got["71"], got["80"]) == (first, room)


@pytest.mark.parametrize("role,want", [
    ("ACCOUNTADMIN", 10), ("SYSADMIN", 10), ("BI_READONLY", 1), ("QA_READONLY", 0), ("BI", 0), ("READONLY", 0),
])
def test_row_policy(spark, role, want):
    b = Bindings().add_row_policy("t", category_policy(), ("room_type",))
    assert governed(listings(spark), "t", b, role).count() == want


def test_row_policy_hides_null(spark):
    b = Bindings().add_row_policy("t", category_policy(), ("room_type",))
    df = spark.createDataFrame([(None,), ("Hotel Room",), ("hotel room",)], "room_type string")
    assert governed(df, "t", b, "BI_READONLY").count() == 2
    assert rows(distinct_visible(governed(df, "t", b, "BI_READONLY"), "room_type")) == [("Hotel Room",), ("hotel room",)]


PERSONS = {
    "ACCOUNTADMIN": [("Lewis", "H"), ("Fernando", "A"), ("No", "Nation")],
    "SYSADMIN": [("Lewis", "H"), ("Fernando", "A"), ("No", "Nation")],
}


@pytest.mark.parametrize("role", ROLES)
def test_person_masks(spark, role):
    docs = fixtures.landing_drivers(spark, fixtures.DOCUMENTS)
    sql = names(governed(docs, "d", Bindings().set_mask("d", "payload", person_mask()), role))
    both = names(governed(docs, "d", Bindings().set_mask("d", "payload", person_mask_both_names()), role))
    if role in PERSONS:
        assert sql == both == PERSONS[role]
    elif role == "BI_READONLY":
        f, s, m = "*** FORENAME-MASKED ***", "*** SURNAME-MASKED ***", "** MASKED **"
        assert sql == [(f, "H"), ("Fernando", s), ("No", s)]
        assert both == [(m, "H"), ("Fernando", m), ("No", m)]
    else:
        assert sql == [(None, None)] * 3
        assert both == [("** MASKED **", "** MASKED **")] * 3


def test_field_and_payload_masks(spark):
    docs = fixtures.landing_drivers(spark, fixtures.DOCUMENTS)
    assert names(governed(docs, "d", Bindings().set_mask("d", "payload", field_mask()), "SYSADMIN"))[0] == ("*** FIELD MASK ***", "H")
    whole = governed(docs, "d", Bindings().set_mask("d", "payload", payload_mask()), "SYSADMIN")
    assert whole.select(F.to_json("payload")).first()[0] == '"*** PAYLOAD MASK ***"'
    other = fixtures.landing_drivers(spark)  # documents without a name
    assert names(governed(other, "d", Bindings().set_mask("d", "payload", field_mask()), "SYSADMIN")) == [(None, None)] * 2


def test_python_rules_equal_native_ones(spark):
    docs = fixtures.landing_drivers(spark, fixtures.DOCUMENTS)

    def visible(role, d):
        return role == "BI_READONLY" and (d.get("nationality") or "").lower() == "british"

    def blank(role, d):
        return {**d, "name": {**d["name"], "forename": role}}

    for role in ROLES:
        native = governed(docs, "d", Bindings().add_row_policy("d", payload_policy(), ("payload",)), role)
        python = governed(docs, "d", Bindings().add_row_policy("d", python_policy("p", visible, ("ACCOUNTADMIN", "SYSADMIN")), ("payload",)), role)
        assert names(native) == names(python)
    b = Bindings().set_mask("d", "payload", python_mask("m", blank, ("name.forename",), allow=("ACCOUNTADMIN",)))
    assert names(governed(docs, "d", b, "QA"))[0] == ("QA", "H") and names(governed(docs, "d", b, "ACCOUNTADMIN"))[0] == ("Lewis", "H")


def test_masked_column_cannot_be_probed(spark):
    b = Bindings().set_mask("t", "name", constant_mask("c", MASKED))
    seen = governed(spark.read.parquet("/root/testdata/sf0.001/customer.parquet").withColumnRenamed("c_name", "name"), "t", b, "QA_READONLY")
    hit = seen.filter(F.col("name") == "Customer#000000001")
    assert hit.count() == 0
    assert "LocalTableScan <empty>" in hit._jdf.queryExecution().executedPlan().toString()


def test_policies_run_inside_the_scan(spark):
    b = Bindings().add_row_policy("t", category_policy(("BUILDING",)), ("c_mktsegment",)).set_mask("t", "c_name", partial_name_mask(), ("c_mktsegment",))
    df = governed(spark.read.parquet("/root/testdata/sf0.001/customer.parquet"), "t", b, "BI_READONLY").select("c_name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ReadSchema: struct<c_name:string,c_mktsegment:string>" in plan


def test_tags(spark):
    b = Bindings().tag("t", None, "PII", "x").tag_mask("PII", constant_mask("table", TABLE_MASK))
    b.tag("t", "room_type", "SOFT", "x").tag_mask("SOFT", constant_mask("column", COLUMN_MASK))
    df = listings(spark).withColumn("n", F.lit(1))
    r = governed(df, "T", b, "SYSADMIN").first()
    assert (r["name"], r["room_type"], r["n"]) == (TABLE_MASK, COLUMN_MASK, 1)  # column tag before table tag, numbers stay
    assert governed(df, "t", b.untag("t", None, "PII"), "SYSADMIN").filter(F.col("name") == TABLE_MASK).count() == 0
    b.drop_tag("SOFT")
    assert rows(governed(df, "t", b, "SYSADMIN")) == rows(df)


def test_table_tag_does_not_mask_documents_with_text(spark):
    b = Bindings().tag("d", None, "PII", "x").tag_mask("PII", constant_mask("table", TABLE_MASK))
    docs = fixtures.landing_drivers(spark, fixtures.DOCUMENTS)
    assert names(governed(docs, "d", b, "QA"))[0] == ("Lewis", "H")


def test_copies_of_a_tagged_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gov")
    tables.overwrite(listings(spark), "gov.base")
    for propagate in (True, False):
        cat = GovernedCatalog(spark, Bindings().create_tag("PII", propagate).tag_mask("PII", constant_mask("c", MASKED)).tag("gov.base", "name", "PII", "name"))
        cat.create_view("gov.v", "gov.base")
        cat.create_view("gov.vv", "gov.v", lambda d: d.select("id", F.upper("name").alias("shout")))
        cat.ctas("gov.ctas", "gov.base", {"id": "id", "title": "name"})
        cat.create_like("gov.likeness", "gov.base")
        assert spark.table("gov.likeness").count() == 0
        tables.append(spark.table("gov.base"), "gov.likeness")
        cat.clone("gov.twin", "gov.base")

        def masked(table, col):
            return {r[0] for r in cat.read(table, "SYSADMIN").select(col).collect()} == {MASKED}

        assert masked("gov.base", "name") and masked("gov.v", "name") and masked("gov.vv", "shout")
        assert masked("gov.likeness", "name") and masked("gov.twin", "name")
        assert masked("gov.ctas", "title") is propagate
        assert cat.read("gov.twin", "ACCOUNTADMIN").filter(F.col("name") == MASKED).count() == 0
        with pytest.raises(RestrictedError):
            cat.create_materialized_view("gov.mv", "gov.base")


def test_role_sql_reads_parameters_only(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gov")
    tables.overwrite(spark.createDataFrame([(1, "clear")], "k int, name string"), "gov.people")
    cat = GovernedCatalog(spark, Bindings().set_mask("gov.people", "name", constant_mask("c", MASKED)))
    for text in ("SELECT name FROM {t}", "WITH x AS (SELECT * FROM {t}), y AS (SELECT * FROM x) SELECT name FROM y", "SELECT name FROM (SELECT 'FROM gov.people' AS note, name FROM {t})"):
        assert cat.query("QA", text, t="gov.people").first()["name"] == MASKED
    for text in ("SELECT name FROM gov.people", "SELECT a.name FROM {t} a, gov.people b", "SELECT (SELECT max(name) FROM gov.people) AS name FROM {t}", "SELECT name FROM {t} WHERE name IN (SELECT name FROM gov.people)"):
        with pytest.raises(RestrictedError, match="gov.people"):
            cat.query("QA", text, t="gov.people")


def test_bindings_are_read_back_from_their_table(spark):
    from lakestrata.sources.binding_store import load_bindings, save_bindings

    spark.sql("CREATE DATABASE IF NOT EXISTS gov")
    mask, policy = partial_name_mask(), category_policy()
    b = Bindings().create_tag("pii", propagate=True).tag_mask("pii", constant_mask("pii", MASKED)).set_mask("t", "name", mask, ("room_type",))
    b.add_row_policy("t", policy, ("room_type",)).tag("t", None, "owner", "us").tag("t", "name", "pii", "x")
    save_bindings(spark, b, "gov.bindings")
    masks = [mask, b.tag_masks["pii"]]
    again = load_bindings(spark, "gov.bindings", masks, [policy])
    assert (again.tables, again.tag_masks, again.propagating) == (b.tables, b.tag_masks, b.propagating)
    with pytest.raises(ValueError, match="was not given"):
        load_bindings(spark, "gov.bindings", masks)
    save_bindings(spark, Bindings(), "gov.bindings")
    assert load_bindings(spark, "gov.bindings").tables == {}


def test_plain_views_over_protected_tables_are_refused(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gov")
    tables.overwrite(spark.createDataFrame([(1, "clear")], "k int, name string"), "gov.persons")
    tables.overwrite(spark.createDataFrame([(1, "open")], "k int, name string"), "gov.places")
    tables.create_view(spark, "SELECT name FROM gov.persons", "gov.persons_view")
    tables.create_view(spark, "WITH x AS (SELECT * FROM gov.persons_view) SELECT name FROM x", "gov.second_view")
    tables.create_view(spark, "SELECT name FROM gov.places", "gov.places_view")
    cat = GovernedCatalog(spark, Bindings().set_mask("gov.persons", "name", constant_mask("c", MASKED)))
    assert cat.read("gov.persons", "QA").first()["name"] == MASKED and cat.read("gov.places_view", "QA").first()["name"] == "open"
    for view in ("gov.persons_view", "gov.second_view"):
        with pytest.raises(RestrictedError, match="gov.persons"):
            cat.read(view, "QA")


def test_all_roles_in_one_scan_equal_each_role(spark):
    from lakestrata.operators.governance import by_role

    df = listings(spark)
    b = Bindings().set_mask("t", "name", partial_name_mask(), ("room_type",)).set_mask("t", "room_type", constant_mask("c", MASKED, allow=("SYSADMIN",)))
    b.add_row_policy("t", category_policy(("shared room", "private room")), ("room_type",))
    got = by_role(df, "t", b, ROLES)
    want = [(*r, role) for role in ROLES for r in map(tuple, governed(df, "t", b, role).collect())]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = by_role(orders, "o", Bindings().set_mask("o", "o_orderstatus", constant_mask("c", MASKED)), ROLES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


@pytest.fixture
def masked_people(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gov")
    tables.overwrite(spark.createDataFrame([(1, "clear", 5)], "k int, name string, v int"), "default.pp")
    return GovernedCatalog(spark, Bindings().set_mask("pp", "name", constant_mask("c", MASKED)))


def test_every_spelling_of_a_table_has_its_masks(spark, masked_people):
    cat = masked_people
    for name in ("pp", "PP", "default.pp", "`Default`.`pp`", "spark_catalog.default.pp", "pp__v1", "default.pp__v1"):
        assert cat.read(name, "QA").first()["name"] == MASKED, name
    spark.sql("USE gov")
    try:
        assert cat.read("default.pp", "QA").first()["name"] == MASKED
        cat.bindings.unset_mask("spark_catalog.default.PP", "NAME")
        assert cat.read("default.pp", "QA").first()["name"] == "clear"
    finally:
        spark.sql("USE default")


def test_no_query_goes_round_a_mask(spark, masked_people):
    cat = masked_people
    for text in ("with pp as (select * from pp) select name from pp", "select name from identifier('pp')", "with x as (select * from default.pp), pp as (select * from x) select * from pp",
                 "select name from {t} where exists (select 1 from pp)", "table pp", "create table gov.copy as select * from {t}", "insert into gov.x select * from {t}",
                 "with a as (select * from b), b as (select 1) select * from a"):
        with pytest.raises(RestrictedError):
            cat.query("QA", text, t="pp")
    for text in ("with pp as (select * from {t}) select name from pp", "with a as (select * from {t}), b as (select * from a) select name from b"):
        assert cat.query("QA", text, t="pp").first()["name"] == MASKED
    tables.create_view(spark, spark.table("pp"), "session_people")
    tables.create_view(spark, "SELECT upper(name) AS name FROM default.pp WHERE k IN (SELECT k FROM default.pp)", "gov.loud_people")
    spark.table("pp").filter("k > 0").createOrReplaceTempView("some_people")
    spark.sql("SELECT 1 AS one WHERE EXISTS (SELECT name FROM default.pp)").createOrReplaceTempView("whether_people")
    for view in ("session_people", "SESSION_PEOPLE", "gov.loud_people", "some_people", "whether_people"):
        with pytest.raises(RestrictedError, match="default.pp"):
            cat.read(view, "QA")


def test_lineage_follows_expression_ids(spark):
    from lakestrata.operators.lineage import lineage, relations

    spark.sql("CREATE DATABASE IF NOT EXISTS gov")
    tables.overwrite(spark.createDataFrame([(1, "a", 3)], "k int, name string, v int"), "gov.left")
    tables.overwrite(spark.createDataFrame([(1, "a", 3)], "k int, other string, v int"), "gov.right")
    cat = GovernedCatalog(spark)
    left, right = "spark_catalog.gov.left", "spark_catalog.gov.right"
    df = spark.sql("""WITH c AS (SELECT k, upper(name) AS n, v FROM gov.left) SELECT c.k + 1 AS a, c.n, r.other, (SELECT max(v) FROM gov.right) AS most
      FROM c JOIN gov.right r ON c.k = r.k UNION ALL SELECT v, name, name, k FROM gov.left""")
    assert cat.lineage(df) == {"a": {(left, "k"), (left, "v")}, "n": {(left, "name")}, "other": {(right, "other"), (left, "name")}, "most": {(right, "v"), (left, "k")}}
    p = spark.table("gov.left")
    made = p.groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).withColumn("e", F.explode(F.array("s", "k")))
    assert cat.lineage(made) == {"k": {(left, "k")}, "s": {(left, "v")}, "n": set(), "e": {(left, "k"), (left, "v")}}
    assert cat.lineage(p.select("k", "name").mapInPandas(lambda x: x, "z int"))["z"] == {(left, "k"), (left, "name")}
    assert cat.lineage(p.alias("x").join(p.alias("y"), "k").select("x.name", F.col("y.v").alias("w"))) == {"name": {(left, "name")}, "w": {(left, "v")}}
    assert ("spark_catalog", "gov", "left") in relations(spark.sql("SELECT 1 WHERE EXISTS (SELECT 1 FROM gov.left)"))
    assert lineage(spark.range(3)) == {"id": set()}


def test_tags_follow_a_stored_query(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gov")
    tables.overwrite(spark.createDataFrame([(1, "a", 3)], "k int, name string, v int"), "gov.tagged")
    b = Bindings().create_tag("pii", propagate=True).create_tag("local").tag_mask("pii", constant_mask("c", MASKED))
    cat = GovernedCatalog(spark, b.tag("GOV.Tagged", "name", "pii", "x").tag("gov.tagged", "k", "local", "y"))
    cat.ctas_query("gov.derived", spark.sql("SELECT k, concat(name, '!') AS greeting, length(name) AS size FROM gov.tagged"))
    assert b.of("gov.derived").tags == {("greeting", "pii"): "x", ("size", "pii"): "x"}
    assert cat.read("spark_catalog.gov.derived", "QA").first()["greeting"] == MASKED
