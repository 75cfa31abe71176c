"""Names, run identity and the session settings that the operators rely on."""

from __future__ import annotations

import atexit
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The environments and layers a deployment may name.
ENVIRONMENTS = ("DEV", "TEST", "PREPROD", "PROD")
LAYERS = ("LANDING", "BRONZE", "SILVER", "GOLD", "PLATINUM")


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that decide *results*; tuning stays with the cluster.

    ANSI makes a bad cast fail instead of turning into NULL, and UTC keeps
    timestamp text independent of the machine the driver runs on.
    """
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for work tables that cut a plan in two.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset the
    session's warehouse directory, which executors must reach anyway, serves.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = (conf or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    local = root.startswith("file:") or "://" not in root and spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")
    if not conf and local and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {root} is local to each machine")
    return root


_FOLDERS: list[tuple[SparkSession, str]] = []


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one for tables that frames read later; it is removed when the program ends.

    Frames read their tables lazily, so nothing earlier is safe.  All folders
    of an application share a parent, which can be removed if it was killed.
    """
    where = f"{scratch_root(spark)}/lakestrata_{spark.sparkContext.applicationId}/{name}_{uuid.uuid4().hex[:12]}"
    if not _FOLDERS:
        atexit.register(_remove_folders)
    _FOLDERS.append((spark, where))
    return where


def remove_folder(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _remove_folders() -> None:
    while _FOLDERS:
        spark, where = _FOLDERS.pop()
        try:
            remove_folder(spark, where)
        except Exception:  # noqa: BLE001  the session's JVM may be gone
            return


@dataclass(frozen=True)
class Layers:
    """Database names per layer: ``<ENV>_<LAYER>[_<SOURCE>]``."""

    env: str
    # Only the layers fed straight by the ingestion tool carry its suffix.
    suffixes: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.env.upper() not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {self.env!r}; expected one of {ENVIRONMENTS}")

    def database(self, layer: str, source: str | None = None) -> str:
        layer = layer.upper()
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        suffix = source or self.suffixes.get(layer)
        return "_".join([self.env.upper(), layer, *([suffix.upper()] if suffix else [])])

    def schema(self, layer: str, schema: str) -> str:
        """Spark's session catalog has two name parts, so the source schema joins the database."""
        return f"{self.database(layer)}__{schema.upper()}"

    def table(self, layer: str, schema: str, name: str) -> str:
        return f"{self.schema(layer, schema)}.{name}"

    @staticmethod
    def schema_from_path(path: str, default: str) -> str:
        """Schema of a model file: its third path part (``<project>/<layer folder>/<schema>/...``), else the default."""
        parts = [p for p in path.split("/") if p]
        return (parts[2] if len(parts) >= 3 else default).upper()

    @classmethod
    def from_database(cls, database: str, **kw) -> "Layers":
        """``DEV_BRONZE`` -> the DEV layers, so a test can follow its environment."""
        return cls(database.split("_")[0], **kw)


@dataclass(frozen=True)
class RunContext:
    """Who wrote a row and when; injected so that a re-run can be repeated exactly."""

    ts: datetime | None = None
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    tool: str = "spark"
    project: str = "lakestrata"

    def timestamp(self) -> Column:
        if self.ts is None:
            return F.current_timestamp()
        ts = self.ts if self.ts.tzinfo else self.ts.replace(tzinfo=timezone.utc)
        return F.lit(ts)

    def pinned(self) -> "RunContext":
        """Same run with the clock read once, for runs of more than one job."""
        if self.ts is not None:
            return self
        return RunContext(datetime.now(timezone.utc), self.run_id, self.tool, self.project)
