"""Registry, file landing and the JSON landing."""

from pyspark.sql import functions as F

from lakestrata.functions.variant import field
from lakestrata.operators.shaping import cast_columns, flatten_variant
from lakestrata.settings import Layers
from lakestrata.sources import files, registry, tables
from workload.registration import query, run_at

_TASKS = """SELECT CAST(r_regionkey AS BIGINT) AS job_id, CAST(n_nationkey AS BIGINT) AS task_id, CASE WHEN n_nationkey % 2 = 0 THEN 'BLOB_CSV' ELSE 'ADLS_CSV' END AS task_switch,
  r_name AS source_name, lower(n_name) || '.csv' AS file, 'DEV_LANDING' AS sink_database, upper(r_name) AS sink_schema, n_name AS sink_table
  FROM region JOIN nation ON n_regionkey = r_regionkey"""


def _registry(t):
    jobs = t.region.select(F.col("r_regionkey").cast("bigint").alias("job_id"), F.col("r_name").alias("source_name"),
                           F.concat(F.lit("  "), F.lower("r_name"), F.lit(" ")).alias("sink_schema"))
    config = F.to_json(F.struct(F.lit("sources").alias("container"), F.concat(F.lower("n_name"), F.lit(".csv")).alias("file"),
                                F.lit(",").alias("delimiter"), F.lit(True).alias("header")))
    tasks = t.nation.select(F.col("n_regionkey").cast("bigint").alias("job_id"), F.col("n_nationkey").cast("bigint").alias("task_id"),
                            F.when(F.col("n_nationkey") % 2 == 0, "BLOB_CSV").otherwise("ADLS_CSV").alias("task_switch"),
                            F.parse_json(config).alias("source_config"), F.concat(F.lit(" "), "n_name", F.lit("  ")).alias("sink_table"))
    return jobs, tasks


def _shown(df):
    return df.select("job_id", "task_id", "task_switch", "source_name", field("source_config", "file").alias("file"),
                     "sink_database", "sink_schema", "sink_table")


@query(_TASKS)
def registry_tasks(t):
    return _shown(registry.resolve_tasks(*_registry(t), "DEV_LANDING"))


@query(_TASKS + " WHERE r_regionkey = 1 ORDER BY task_id")
def registry_tasks_of_one_job(t):
    return _shown(registry.resolve_tasks(*_registry(t), "DEV_LANDING", job_id=1))


def _write_csv(t, df, name, **options):
    path = t.work_path(name)
    df.write.mode("overwrite").options(header=True, escape='"', quoteAll=True, **options).csv(f"{path}/sources/demo/{name}")
    return path


_DOCS = "SELECT '2025-01-10' AS load_day, 'run-1' AS SYSRUNID, 'DOCS' AS SOURCESYSTEM, CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents"


@query(_DOCS)
def csv_landing(t):
    """Whole texts with quotes and line breaks through a delimited file."""
    return _landed_documents(t, "docs.csv")


@query(_DOCS)
def csv_landing_by_range(t):
    """The same, each byte range of the files parsed by a task of its own."""
    return _landed_documents(t, "ranged.csv", split=True)


def _landed_documents(t, name, **config):
    root = _write_csv(t, t.documents.select("doc_id", "text", "lang"), name)
    task = {"container": "sources", "folder": "demo", "file": name, "delimiter": ",", "header": True, **config}
    df = files.ingest_csv(t.spark, root, task, run_at(1), "DOCS", ["doc_id", "text", "lang"])
    return df.select(F.date_format("SYSLOADDATE", "yyyy-MM-dd").alias("load_day"), "SYSRUNID", "SOURCESYSTEM", "doc_id", "text", "lang")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
       "l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem)")
def gzip_landing(t):
    """Compressed, pipe-separated, one record per line, then typed."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))
    root = _write_csv(t, lines, "lines.csv.gz", sep="|", compression="gzip")
    task = {"container": "sources", "folder": "demo", "file": "lines.csv.gz", "delimiter": "|", "compression_type": "gzip", "multi_line": False}
    df = files.ingest_csv(t.spark, root, task, run_at(1), "LINES", lines.columns)
    return cast_columns(df.select(*lines.columns), {"l_orderkey": "bigint", "l_linenumber": "bigint", "l_extendedprice": "double"})


@query("""SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_landing(t):
    """One document per line into a VARIANT column, nested field included."""
    path = t.work_path("events.json")
    doc = F.to_json(F.struct("event_id", "event_type", F.from_json("props", "k bigint").alias("props")))
    t.events.select(doc.alias("value")).write.mode("overwrite").text(path)
    spec = {"event_id": ("event_id", "bigint"), "event_type": ("event_type", "string"), "k": ("props.k", "bigint")}
    return flatten_variant(files.ingest_json(t.spark, path), spec)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_text_landing(t):
    """Text column parsed into documents."""
    docs = files.parse_documents(t.events.select("event_id", "props"), "props")
    return docs.select("event_id", field("payload", "k", "bigint").alias("k"))


_LANDED = {"Customers": "SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS v FROM customer", "Parts": "SELECT CAST(p_partkey AS VARCHAR), p_name FROM part",
           "Events": "SELECT CAST(event_id AS VARCHAR), event_type FROM events"}


@query(" UNION ALL ".join(f"SELECT '{sink}' AS sink, k, v, '{run}' AS run FROM ({sql}) AS x(k, v)" for sink, sql, run in (
    ("Customers", _LANDED["Customers"], "run-1"), ("Parts", "SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 10 = 0 THEN 'renamed' ELSE p_name END FROM part", "run-3"),
    ("Events", _LANDED["Events"], "none"))))
def registry_lands_what_changed(t):
    """Registry to landed tables, three runs: all three sources; nothing new; one source delivered again with other rows.

    A plain, a gzip and a JSON source. The run that wrote a row shows which sources were landed again.
    """
    run = t.spark.sparkContext.applicationId.replace("-", "_").upper()
    root, layers, schema = t.work_path("registry"), Layers("DEV"), f"REG_{run}"
    part = t.part.select("p_partkey", "p_name")

    def deliver(df, name, **options):
        df.write.mode("overwrite").options(header=True, escape='"', quoteAll=True, **options).csv(f"{root}/sources/{name}")

    deliver(t.customer.select("c_custkey", "c_name"), "customers.csv")
    deliver(part, "parts.csv.gz", compression="gzip", sep="|")
    t.events.select(F.to_json(F.struct("event_id", "event_type")).alias("value")).write.mode("overwrite").text(f"{root}/sources/events.json")
    jobs = [(1, "SHOP", f" {schema.lower()} ")]
    tasks = [(1, 1, "BLOB_CSV", {"container": "sources", "file": "customers.csv"}, "Customers"),
             (1, 2, "ADLS_CSV", {"container": "sources", "file": "parts.csv.gz", "delimiter": "|", "compression_type": "gzip"}, " Parts "),
             (1, 3, "BLOB_JSON", {"container": "sources", "file": "events.json"}, "Events")]
    tables.drop_layers(t.spark, layers, [schema], ["LANDING"])
    tables.create_layers(t.spark, layers, [schema], t.work_path("layers"))
    resolved = registry.resolve_tasks(*registry.registry(t.spark, jobs, tasks), layers.database("LANDING"))
    record = registry.LandingRecord(t.spark, layers.table("LANDING", schema, "Landed_Files"))
    for month in (1, 2, 3):
        if month == 3:
            deliver(part.withColumn("p_name", F.when(F.col("p_partkey") % 10 == 0, "renamed").otherwise(F.col("p_name"))), "parts.csv.gz", compression="gzip", sep="|")
        registry.run_tasks(t.spark, resolved, root, run_at(month), record=record)
    at = lambda name: t.spark.table(layers.table("LANDING", schema, name))
    shop = at("Customers").select(F.lit("Customers").alias("sink"), F.col("c_custkey").alias("k"), F.col("c_name").alias("v"), F.col("SYSRUNID").alias("run"))
    parts = at("Parts").select(F.lit("Parts"), "p_partkey", "p_name", "SYSRUNID")
    events = at("Events").select(F.lit("Events"), field("payload", "event_id"), field("payload", "event_type"), F.lit("none"))
    return shop.union(parts).union(events)
