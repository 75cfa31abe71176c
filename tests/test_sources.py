import gzip
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import rows
from lakestrata import Layers, RunContext
from lakestrata.operators.history import current_rows
from lakestrata.plans import lodging
from lakestrata.settings import scratch_root
from lakestrata.sources import files, registry, tables
from lakestrata.sources.governed import GovernedCatalog
from lakestrata.sources.history_table import HistoryTable
from lakestrata.streaming.arrivals import arriving_csv, history_of_arrivals, land_arrivals

CSV = 'id,name,comments\n1,"Ann, B","said ""hi""\nand left"\n2,,plain\n'


@pytest.fixture
def folder():
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def test_names():
    d = Layers("dev", {"LANDING": "adl", "BRONZE": "adl"})
    assert (d.database("landing"), d.database("silver"), d.database("gold", "crm")) == ("DEV_LANDING_ADL", "DEV_SILVER", "DEV_GOLD_CRM")
    assert d.table("gold", "lodging", "Fact") == "DEV_GOLD__LODGING.Fact"
    assert Layers.from_database("PREPROD_BRONZE_ADL").env == "PREPROD"
    assert Layers.schema_from_path("hub/bronze/lodging/listings", "public") == "LODGING"
    assert Layers.schema_from_path("hub/bronze", "public") == "PUBLIC"
    for bad in (lambda: Layers("qa"), lambda: d.database("copper")):
        with pytest.raises(ValueError):
            bad()


def test_all_environments(spark):
    for env in ("DEV", "TEST", "PREPROD", "PROD"):
        assert len(tables.create_layers(spark, Layers(env), ["X"])) == 5
    assert spark.catalog.databaseExists("PROD_PLATINUM__X")
    tables.drop_layers(spark, Layers("PROD"), ["X"], ["PLATINUM", "GOLD"])
    assert not spark.catalog.databaseExists("PROD_PLATINUM__X") and spark.catalog.databaseExists("PROD_BRONZE__X")


def test_registry_lands_plain_and_gzip_files(spark, folder, ctx):
    where = folder / "sources" / "demo"
    where.mkdir(parents=True)
    (where / "plain.csv").write_text(CSV)
    (where / "packed.csv.gz").write_bytes(gzip.compress(CSV.replace(",", "|").replace('"Ann| B"', '"Ann, B"').encode()))
    (where / "docs.json").write_text("\n".join(fixtures.DOCUMENTS))
    base = {"container": "sources", "folder": "demo", "header": True}
    jobs, tasks = registry.registry(
        spark, [(1, "Demo", "  lodging "), (2, "Other", "OTHER")],
        [(1, 2, "ADLS_CSV", {**base, "file": "packed.csv.gz", "delimiter": "|", "compression_type": "gzip"}, " Packed "),
         (1, 1, "BLOB_CSV", {**base, "file": "plain.csv", "delimiter": ","}, "Plain"),
         (1, 3, "BLOB_JSON", {**base, "file": "docs.json"}, "Docs"),
         (2, 1, "NOPE", {**base, "file": "x"}, "X"),
         (9, 1, "BLOB_CSV", {**base, "file": "x"}, "Orphan")])
    layers = Layers("DEV")
    tables.create_layers(spark, layers, ["LODGING"])
    resolved = registry.resolve_tasks(jobs, tasks, layers.database("LANDING"), job_id=1)
    assert [r["sink_table"] for r in resolved.collect()] == ["Plain", "Packed", "Docs"]
    assert registry.resolve_tasks(jobs, tasks, "DB").count() == 4
    sinks = registry.run_tasks(spark, resolved, str(folder), ctx)
    assert sinks[0] == "DEV_LANDING__LODGING.Plain"
    want = [("1", "Ann, B", 'said "hi"\nand left'), ("2", None, "plain")]
    for s in sinks[:2]:
        df = spark.table(s)
        assert df.columns[:5] == ["SYSLOADDATE", "SYSRUNID", "SYSPROCESSINGTOOL", "SYSDATAPROCESSORNAME", "SOURCESYSTEM"]
        assert rows(df.select("id", "name", "comments")) == want and df.first()["SOURCESYSTEM"] == "Demo"
    assert spark.table(sinks[2]).dtypes == [("payload", "variant")]
    registry.run_tasks(spark, resolved.filter("task_id = 1"), str(folder), ctx, mode="append")
    assert spark.table(sinks[0]).count() == 4
    with pytest.raises(ValueError, match="unknown switch"):
        registry.run_tasks(spark, registry.resolve_tasks(jobs, tasks, "DB", 2), str(folder), ctx)


def test_wrong_column_count_fails_the_landing(spark, folder):
    (folder / "bad.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(folder / "bad.csv"), ["a", "b"], {}).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_swapped_header_fails_the_landing(spark, folder, multi_line):
    (folder / "swapped.csv").write_text("b,a\n1,2\n")
    config = {"multi_line": multi_line}
    with pytest.raises(Exception):
        files.read_csv(spark, str(folder / "swapped.csv"), ["a", "b"], config).collect()
    assert rows(files.read_csv(spark, str(folder / "swapped.csv"), ["b", "a"], config)) == [("1", "2")]
    assert rows(files.read_csv(spark, str(folder / "swapped.csv"), ["b", "a"], config).select("a")) == [("2",)]


def test_parse_documents(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, "{oops")], "id int, j string")
    with pytest.raises(Exception):
        files.parse_documents(df, "j").collect()
    assert files.parse_documents(df, "j", "null").filter("payload is null").count() == 1


@pytest.fixture(scope="module")
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    return "store"


def test_table_life(spark, db):
    n = f"{db}.life"
    assert tables.version(spark, n) == 0
    tables.append(spark.range(3), n)
    tables.append(spark.range(3, 5), n)
    assert tables.version(spark, n) == 1 and spark.table(n).count() == 5
    before = spark.table(n)
    tables.overwrite(spark.table(n).filter("id > 1"), n)
    assert rows(spark.table(n)) == [(2,), (3,), (4,)]
    assert before.count() == 5  # the version before is still there for running readers
    for _ in range(3):
        tables.overwrite(spark.table(n), n)
    kept = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db} LIKE 'life__v*'").collect()]
    assert sorted(kept) == ["life__v4", "life__v5"]
    with pytest.raises(ValueError):
        tables.replace_rows(spark.range(1).withColumnRenamed("id", "other"), n)
    tables.replace_rows(spark.range(9, 10), n)
    assert rows(spark.table(n)) == [(9,)]
    tables.truncate(spark, n)
    assert spark.table(n).count() == 0
    tables.drop(spark, n, f"{db}.never_there")
    assert not tables.exists(spark, n) and not spark.sql(f"SHOW TABLES IN {db} LIKE 'life__v*'").count()


def test_failed_overwrite_keeps_the_old_rows(spark, db):
    n = f"{db}.safe"
    tables.overwrite(spark.range(3), n)
    with pytest.raises(Exception):
        tables.overwrite(spark.table(n).select((F.col("id") / F.lit(0)).alias("id")), n)
    assert rows(spark.table(n)) == [(0,), (1,), (2,)]
    tables.overwrite(spark.range(1), n)
    assert spark.table(n).count() == 1


def test_partitioning_carries_over_and_hot_partitions_are_split(spark, db):
    n = f"{db}.parted"
    df = spark.range(0, 9000, 1, 6).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("p"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4000")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1000")
        tables.overwrite(df, n, ("p",))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert spark.table(n).filter("p = 'hot'").select(F.input_file_name()).distinct().count() > 1
    tables.update_table(spark, n, F.col("id") == 1, {"id": F.lit(-1)})
    tables.clone(spark, n, f"{db}.parted_twin")
    for t in (n, f"{db}.parted_twin"):
        assert tables.partition_columns(spark, t) == ("p",) and spark.table(t).count() == 9000
        plan = spark.table(t).filter("p = 'hot'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(p" in plan
    tables.overwrite(spark.range(3), n)
    assert tables.partition_columns(spark, n) == ()


def test_update_where_types_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    out = tables.update_where(df, F.col("k") > 0, {"K": F.col("k") + 1, "v": F.lit("set")})
    assert rows(out) == [(2, "set"), (None, "b")] and out.schema == df.schema
    with pytest.raises(ValueError):
        tables.update_where(df, F.lit(True), {"zz": F.lit(1)})


def test_landing_table_from_schema(spark, db):
    n = f"{db}.landing"
    tables.create_table(spark, n, lodging.landing_schema(list(lodging.LISTING_TYPES)))
    tables.append(fixtures.landing_listings(spark), n)
    assert spark.table(n).count() == 10 and len(spark.table(n).columns) == 23


def test_tags_in_stored_schema_survive(spark, db):
    df = spark.range(1).withMetadata("id", {"tags": {"PII": "x"}})
    tables.overwrite(df, f"{db}.meta")
    tables.create_like(spark, f"{db}.meta", f"{db}.meta_like")
    assert spark.table(f"{db}.meta").schema["id"].metadata["tags"] == {"PII": "x"}
    assert spark.table(f"{db}.meta_like").schema["id"].metadata["tags"] == {"PII": "x"}


def test_scratch_root_follows_the_cluster_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_arriving_files_land_once(spark, folder, ctx):
    inbox = folder / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text("id,v\n1,x\n")

    def land():
        land_arrivals(arriving_csv(spark, str(inbox), ["id", "v"], {}), str(folder / "rows"), str(folder / "progress"), ctx, "FEED")
        return rows(spark.read.parquet(str(folder / "rows")).select("id", "v", "SOURCESYSTEM"))

    assert land() == [("1", "x", "FEED")]
    (inbox / "b.csv").write_text("id,v\n2,y\n")
    assert land() == land() == [("1", "x", "FEED"), ("2", "y", "FEED")]


def test_arriving_files_build_history(spark, folder, db):
    inbox = folder / "inbox"
    inbox.mkdir()
    table = HistoryTable(spark, f"{db}.arrived", ["id"])

    def load(day):
        from conftest import at

        history_of_arrivals(arriving_csv(spark, str(inbox), ["id", "v"], {}), table, ["v"], str(folder / "progress"), at(day))

    (inbox / "a.csv").write_text("id,v\n1,x\n2,x\n")
    load(1)
    (inbox / "b.csv").write_text("id,v\n2,y\n3,x\n")
    load(2)
    load(3)
    got = spark.table(f"{db}.arrived")
    assert rows(current_rows(got).select("id", "v")) == [("1", "x"), ("2", "y"), ("3", "x")] and got.count() == 4


def test_run_context_is_pinned_once():
    ctx = RunContext()
    pinned = ctx.pinned()
    assert pinned.ts is not None and pinned.pinned() is pinned and pinned.run_id == ctx.run_id


def test_scratch_root_refuses_a_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from lakestrata.settings import scratch_root

    def session(master, folder=None, warehouse="file:/home/spark-warehouse"):
        conf = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": warehouse}
        hadoop = SimpleNamespace(get=lambda key, default: default)
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, _jsc=SimpleNamespace(hadoopConfiguration=lambda: hadoop))
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key) or default), sparkContext=context)

    assert scratch_root(session("local[4]")) == "file:/home/spark-warehouse"
    assert scratch_root(session("yarn", "hdfs://host/shared/")) == "hdfs://host/shared"
    assert scratch_root(session("yarn", warehouse="hdfs://host/warehouse")) == "hdfs://host/warehouse"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("spark://host:7077"))


def test_work_folders_go_with_the_program(spark):
    from lakestrata import settings

    held = list(settings._FOLDERS)
    where = settings.work_folder(spark, "test")
    spark.range(3).write.parquet(where)
    settings._FOLDERS[:] = [(spark, where)]
    settings._remove_folders()
    settings._FOLDERS[:] = held
    assert not Path(where.removeprefix("file:")).exists()


def test_drop_finds_every_version(spark, db):
    for _ in range(7):
        tables.overwrite(spark.range(2).toDF("k"), f"{db}.many", keep=9)
    tables.drop(spark, f"{db}.many")
    assert spark.sql(f"SHOW TABLES IN {db} LIKE 'many*'").count() == 0


def test_copies_are_stored_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS copied")
    n, like = "copied.r", "copied.like_r"
    tables.drop(spark, n, like)
    df = spark.createDataFrame([(1, "x", "x", 2), (2, None, None, 3)], "k int, c string, c2 string, z int")
    tables.overwrite(df, n, copies={"c2": "c"})
    assert spark.table(n).columns == df.columns and rows(spark.table(n)) == rows(df)
    assert spark.table(tables.physical(spark, n)).columns == ["k", "c", "z"]
    # each name keeps its own lineage
    assert {c: {x for _, x in found} for c, found in GovernedCatalog(spark).lineage(spark.table(n)).items()} == {c: {c} for c in df.columns}
    tables.create_like(spark, n, like)
    assert spark.table(like).schema.fieldNames() == df.columns and spark.table(like).count() == 0
    other = spark.createDataFrame([(3, "x", "other", 2)], df.schema)
    tables.append(other, n)
    assert rows(spark.table(n)) == rows(df.union(other))
    tables.drop(spark, n, like)
