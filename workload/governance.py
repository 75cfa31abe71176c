"""Masks, row policies and tags, seen by role."""

from pyspark.sql import functions as F

from lakestrata.functions.variant import field, subtree
from lakestrata.operators.governance import (
    COLUMN_MASK,
    MASKED,
    TABLE_MASK,
    Bindings,
    by_role,
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
    propagate_tags,
    python_mask,
    python_policy,
    tags_from_schema,
    tags_in_schema,
)
from workload import derived
from workload.registration import query

ADMIN, SYS, BI, QA = "ACCOUNTADMIN", "SYSADMIN", "BI_READONLY", "QA_READONLY"
ROLES = [ADMIN, SYS, BI, QA]
_ROLES_SQL = "(VALUES ('ACCOUNTADMIN'), ('SYSADMIN'), ('BI_READONLY'), ('QA_READONLY')) r(role)"


@query(f"""SELECT role, c_custkey, CASE WHEN role = 'ACCOUNTADMIN' THEN c_name ELSE '*** COLUMN MASK ***' END AS c_name
  FROM customer, {_ROLES_SQL}""")
def mask_constant(t):
    b = Bindings().set_mask("customer", "c_name", constant_mask("pii", COLUMN_MASK))
    return by_role(t.customer.select("c_custkey", "c_name"), "customer", b, ROLES)


@query(f"""WITH {derived.LISTINGS_SQL} SELECT role, id, room_type, CASE WHEN role IN ('ACCOUNTADMIN', 'SYSADMIN') THEN name
    WHEN role = 'BI_READONLY' THEN CASE WHEN lower(room_type) = 'private room' THEN regexp_replace(name, '(.{{1}}).', '\\1*', 'g')
      ELSE regexp_replace(name, '(.{{4}}).', '\\1*', 'g') END
    ELSE '*** MASKED ***' END AS name FROM landing_listings, {_ROLES_SQL}""")
def mask_partial_by_category(t):
    b = Bindings().set_mask("listings", "name", partial_name_mask(), using=("room_type",))
    return by_role(derived.landing_listings(t).select("id", "room_type", "name"), "listings", b, ROLES)


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN regexp_replace(text, '(.{1}).', '\\1*', 'g')
  ELSE regexp_replace(text, '(.{4}).', '\\1*', 'g') END AS text FROM documents""")
def mask_partial_whole_text(t):
    b = Bindings().set_mask("documents", "text", partial_name_mask("EN"), using=("lang",))
    return governed(t.documents.select("doc_id", "lang", "text"), "documents", b, BI).select("doc_id", "text")


def _names(df):
    return df.select("role", "c_custkey", field("payload", "nationality").alias("nationality"), field("payload", "name.forename").alias("forename"),
                     field("payload", "name.surname").alias("surname"), field("payload", "driverRef").alias("ref"))


def _drivers(t):
    return derived.landing_drivers(t).select("c_custkey", "payload")


_WITH_NAME = "c_custkey % 7 <> 0"


@query(f"""WITH {derived.DRIVERS_SQL} SELECT role, c_custkey, nationality, CASE WHEN role = 'ACCOUNTADMIN' THEN forename
  WHEN {_WITH_NAME} THEN '*** FIELD MASK ***' END AS forename, surname, driverRef AS ref FROM drivers, {_ROLES_SQL}""")
def mask_variant_field(t):
    b = Bindings().set_mask("drivers", "payload", field_mask())
    return _names(by_role(_drivers(t), "drivers", b, ROLES))


_FULL = "role IN ('ACCOUNTADMIN', 'SYSADMIN')"
_BRITISH = "lower(COALESCE(nationality, '')) = 'british'"


@query(f"""WITH {derived.DRIVERS_SQL} SELECT role, c_custkey, nationality,
    CASE WHEN {_FULL} THEN forename WHEN role <> 'BI_READONLY' THEN NULL
      WHEN {_BRITISH} AND {_WITH_NAME} THEN '*** FORENAME-MASKED ***' ELSE forename END AS forename,
    CASE WHEN {_FULL} THEN surname WHEN role <> 'BI_READONLY' THEN NULL
      WHEN NOT {_BRITISH} AND {_WITH_NAME} THEN '*** SURNAME-MASKED ***' ELSE surname END AS surname,
    driverRef AS ref FROM drivers, {_ROLES_SQL}""")
def mask_variant_by_nationality(t):
    b = Bindings().set_mask("drivers", "payload", person_mask())
    return _names(by_role(_drivers(t), "drivers", b, ROLES))


_BOTH = f"""WITH {derived.DRIVERS_SQL} SELECT role, c_custkey, nationality,
    CASE WHEN {_FULL} OR NOT ({_WITH_NAME}) THEN forename WHEN role <> 'BI_READONLY' OR {_BRITISH} THEN '** MASKED **' ELSE forename END AS forename,
    CASE WHEN {_FULL} OR NOT ({_WITH_NAME}) THEN surname WHEN role <> 'BI_READONLY' OR NOT {_BRITISH} THEN '** MASKED **' ELSE surname END AS surname,
    driverRef AS ref FROM drivers, {_ROLES_SQL}"""


@query(_BOTH)
def mask_variant_both_names(t):
    b = Bindings().set_mask("drivers", "payload", person_mask_both_names())
    return _names(by_role(_drivers(t), "drivers", b, ROLES))


@query(_BOTH)
def mask_variant_python(t):
    """The same rule as a Python function over Arrow batches."""

    def rule(role, doc):
        name = doc.get("name")
        if name is None:
            return doc
        british = (doc.get("nationality") or "").lower() == "british"
        if role != "BI_READONLY" or british:
            name["forename"] = "** MASKED **"
        if role != "BI_READONLY" or not british:
            name["surname"] = "** MASKED **"
        return doc

    b = Bindings().set_mask("drivers", "payload", python_mask("person_py", rule, ("name.forename", "name.surname"), allow=(ADMIN, SYS)))
    return _names(by_role(_drivers(t), "drivers", b, ROLES))


@query(f"""SELECT role, o_orderkey, CASE WHEN {_FULL} THEN o_clerk ELSE 'hidden' END AS clerk, '12345678901234567.' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS amount,
  strftime(o_orderdate, '%Y-%m-%d') AS ordered FROM (SELECT *, 'Clerk ' || o_custkey AS o_clerk FROM orders), {_ROLES_SQL}""")
def mask_untouched_fields_python(t):
    """Fields that the function does not set keep their type: decimals of 23 digits, dates."""

    def rule(role, doc):
        doc["clerk"] = "hidden"
        return doc

    digits = F.concat(F.lit("12345678901234567."), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0")).cast("decimal(23,6)")
    document = F.struct(F.concat(F.lit("Clerk "), "o_custkey").alias("clerk"), digits.alias("amount"), F.to_date("o_orderdate").alias("ordered"))
    df = t.orders.select("o_orderkey", F.to_variant_object(document).alias("payload"))
    out = by_role(df, "orders", Bindings().set_mask("orders", "payload", python_mask("clerk_py", rule, ("clerk",), allow=(ADMIN, SYS))), ROLES)
    amount, ordered = F.variant_get("payload", "$.amount", "decimal(23,6)"), F.variant_get("payload", "$.ordered", "date")
    return out.select("role", "o_orderkey", field("payload", "clerk").alias("clerk"), amount.cast("string").alias("amount"), F.date_format(ordered, "yyyy-MM-dd").alias("ordered"))


@query(f"""SELECT role, event_id, CASE WHEN role = 'ACCOUNTADMIN' THEN '{{"k":' || json_extract_string(props, '$.k') || '}}'
  ELSE '"*** PAYLOAD MASK ***"' END AS payload FROM events, {_ROLES_SQL}""")
def mask_whole_payload(t):
    b = Bindings().set_mask("events", "payload", payload_mask())
    df = t.events.select("event_id", F.parse_json("props").alias("payload"))
    return by_role(df, "events", b, ROLES).select("role", "event_id", F.to_json("payload").alias("payload"))


@query(f"""WITH {derived.DRIVERS_SQL} SELECT c_custkey, CASE WHEN {_WITH_NAME} THEN '"*** MASKED ***"' ELSE '"*** MASKED ***"' END AS name
  FROM drivers""")
def mask_variant_subtree(t):
    """The replaced name object is one string for roles without access."""
    b = Bindings().set_mask("drivers", "payload", person_mask())
    return governed(_drivers(t), "drivers", b, QA).select("c_custkey", F.to_json(subtree("payload", "name")).alias("name"))


@query(f"""WITH {derived.LISTINGS_SQL} SELECT role, id, room_type FROM landing_listings, {_ROLES_SQL}
  WHERE {_FULL} OR (role = 'BI_READONLY' AND lower(room_type) IN ('hotel room', 'shared room'))""")
def row_access_by_category(t):
    b = Bindings().add_row_policy("listings", category_policy(), on=("room_type",))
    return by_role(derived.landing_listings(t).select("id", "room_type"), "listings", b, ROLES)


@query(f"""WITH {derived.LISTINGS_SQL} SELECT DISTINCT role, room_type FROM landing_listings, {_ROLES_SQL}
  WHERE {_FULL} OR (role = 'BI_READONLY' AND lower(room_type) IN ('hotel room', 'shared room'))""")
def row_access_distinct_values(t):
    b = Bindings().add_row_policy("listings", category_policy(), on=("room_type",))
    return distinct_visible(by_role(derived.landing_listings(t), "listings", b, ROLES), "role", "room_type")


_ROW_PAYLOAD = f"""WITH {derived.DRIVERS_SQL} SELECT role, c_custkey, nationality FROM drivers, {_ROLES_SQL}
  WHERE {_FULL} OR (role = 'BI_READONLY' AND lower(nationality) = 'british')"""


@query(_ROW_PAYLOAD)
def row_access_by_document(t):
    b = Bindings().add_row_policy("drivers", payload_policy(), on=("payload",))
    return by_role(_drivers(t), "drivers", b, ROLES).select("role", "c_custkey", field("payload", "nationality").alias("nationality"))


@query(_ROW_PAYLOAD)
def row_access_python(t):
    def rule(role, doc):
        return role == "BI_READONLY" and (doc.get("nationality") or "").lower() == "british"

    b = Bindings().add_row_policy("drivers", python_policy("british_py", rule, allow=(ADMIN, SYS)), on=("payload",))
    return by_role(_drivers(t), "drivers", b, ROLES).select("role", "c_custkey", field("payload", "nationality").alias("nationality"))


@query(f"""WITH {derived.DRIVERS_SQL} SELECT DISTINCT role, nationality FROM drivers, {_ROLES_SQL}
  WHERE {_FULL} OR (role = 'BI_READONLY' AND lower(nationality) = 'british')""")
def row_access_distinct_documents(t):
    b = Bindings().add_row_policy("drivers", payload_policy(), on=("payload",))
    return distinct_visible(by_role(_drivers(t), "drivers", b, ROLES), "role", field("payload", "nationality").alias("nationality"))


@query(f"""WITH {derived.LISTINGS_SQL} SELECT id, CASE WHEN lower(room_type) = 'private room' THEN regexp_replace(name, '(.{{1}}).', '\\1*', 'g')
  ELSE regexp_replace(name, '(.{{4}}).', '\\1*', 'g') END AS name FROM landing_listings WHERE lower(room_type) IN ('hotel room', 'shared room')""")
def row_policy_below_mask(t):
    """A row policy and a mask together: the policy sees clear values."""
    b = Bindings().add_row_policy("listings", category_policy(), on=("room_type",)).set_mask("listings", "name", partial_name_mask(), ("room_type",))
    b.set_mask("listings", "room_type", constant_mask("hide", MASKED))
    return governed(derived.landing_listings(t), "listings", b, BI).select("id", "name")


@query("""SELECT id, name FROM (SELECT o_orderkey AS id, '*** MASKED ***' AS name FROM orders) WHERE name LIKE 'Listing%' OR id % 2 = 0""")
def filter_sees_masked_values(t):
    b = Bindings().set_mask("orders", "name", constant_mask("pii", MASKED))
    df = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("Listing "), F.col("o_orderkey").cast("string")).alias("name"))
    return governed(df, "orders", b, QA).filter(F.col("name").like("Listing%") | (F.col("id") % 2 == 0))


@query(f"""SELECT role, c_custkey, CASE WHEN role = 'ACCOUNTADMIN' THEN c_name ELSE '*** COLUMN MASK ***' END AS c_name, c_mktsegment
  FROM customer, {_ROLES_SQL}""")
def tag_masks_column(t):
    b = Bindings().tag("customer", "c_name", "PII", "sensitive").tag_mask("PII", constant_mask("pii", COLUMN_MASK))
    return by_role(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "customer", b, ROLES)


@query("""SELECT doc_id, n_chars, '*** TABLE MASK ***' AS text, '*** COLUMN MASK ***' AS lang, '*** TABLE MASK ***' AS source FROM documents""")
def tag_masks_table(t):
    """A table tag reaches every text column; a mask set on a column itself goes first."""
    b = Bindings().tag("documents", None, "PII", "sensitive").tag_mask("PII", constant_mask("pii", TABLE_MASK))
    b.set_mask("documents", "lang", constant_mask("direct", COLUMN_MASK))
    return governed(t.documents, "documents", b, SYS)


@query("""SELECT c_custkey, c_name, '*** MASKED ***' AS c_mktsegment FROM customer""")
def unset_mask_and_tag(t):
    b = Bindings().set_mask("customer", "c_name", constant_mask("pii", MASKED)).unset_mask("customer", "c_name").unset_mask("customer", "c_name")
    b.set_mask("customer", "c_mktsegment", constant_mask("pii", MASKED))
    b.add_row_policy("customer", category_policy(), on=("c_mktsegment",)).drop_all_row_policies("customer")
    return governed(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "customer", b, QA)


@query("""SELECT 'propagating' AS tag, c_custkey, '*** MASKED ***' AS customer_name FROM customer
  UNION ALL SELECT 'local', c_custkey, c_name FROM customer""")
def tag_propagation(t):
    """A renamed copy is masked where the tag moves with the data, and clear where it does not."""
    out = []
    for label, moves in (("propagating", True), ("local", False)):
        b = Bindings().create_tag("PII", propagate=moves).tag("customer", "c_name", "PII", "name").tag_mask("PII", constant_mask("pii", MASKED))
        copy = t.customer.select("c_custkey", F.col("c_name").alias("customer_name"))
        propagate_tags(b, "customer", "copy", {"c_custkey": "c_custkey", "customer_name": "c_name"})
        out.append(governed(copy, "copy", b, SYS).select(F.lit(label).alias("tag"), "c_custkey", "customer_name"))
    return out[0].unionByName(out[1])


@query("""SELECT o_orderkey, '*** MASKED ***' AS c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def tag_in_column_metadata(t):
    """Tags written into the schema come through a join and mask its result."""
    b = Bindings().tag("customer", "c_name", "PII", "name").tag_mask("PII", constant_mask("pii", MASKED))
    people = tags_in_schema(t.customer, b, "customer")
    joined = t.orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    return governed(joined, "joined", tags_from_schema(joined, b, "joined"), SYS)
