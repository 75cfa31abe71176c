"""Landing to gold in catalog tables, and the checks that follow a build."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.governance import Bindings, propagate_by_lineage
from lakestrata.operators.history import DEFAULT, HistoryColumns
from lakestrata.operators.quality import (
    Check,
    compare_row_count,
    not_null,
    of_type,
    reconcile,
    relationships,
    run_checks,
    unique,
)
from lakestrata.operators.shaping import flatten_variant
from lakestrata.plans import lodging
from lakestrata.settings import Layers, RunContext, configure
from lakestrata.sources import tables
from lakestrata.sources.governed import GovernedCatalog
from lakestrata.sources.history_table import HistoryTable
from lakestrata.sources.sliced_table import SlicedTable

STEPS = ("bronze_listings", "bronze_reviews", "bronze_drivers", "silver_listings", "silver_reviews", "gold_dim", "gold_fact")
REBUILT = ("BRONZE", "SILVER", "PLATINUM")


@dataclass
class Medallion:
    """One environment's build of the lodging data set.

    ``gold_mode`` is ``table`` (rebuild) or ``incremental`` (merge what each
    silver load opened or closed since the load that gold last took: late,
    equal and NULL times make no difference, and keys without an open version
    leave gold); both end in the same rows as long as the reference
    dimensions stay as they are.  ``hard_deletes`` says what becomes of keys
    that a delivery lacks.
    """

    spark: SparkSession
    layers: Layers
    gold_mode: str = "table"
    names: HistoryColumns = DEFAULT
    buckets: int | None = None  # at least; a history takes more for more rows, and gold as many as its history
    slices: int = 16  # of histories and incremental gold tables; some hundred MB each at most
    hard_deletes: str = "ignore"
    bindings: Bindings = field(default_factory=Bindings)
    schema: str = lodging.SCHEMA

    def __post_init__(self):
        configure(self.spark)
        self._catalog = GovernedCatalog(self.spark, self.bindings)
        if self.gold_mode not in ("table", "incremental"):
            raise ValueError(f"gold_mode must be 'table' or 'incremental', not {self.gold_mode!r}")

    def name(self, layer: str, table: str) -> str:
        return self.layers.table(layer, self.schema, table)

    def create(self, location: str | None = None) -> None:
        tables.create_layers(self.spark, self.layers, [self.schema], location)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def silver(self, table: str) -> HistoryTable:
        return HistoryTable(self.spark, self.name("SILVER", table), ["id"], self.names, self.hard_deletes, self.buckets, self.slices)

    def catalog(self) -> GovernedCatalog:
        return self._catalog

    def run(self, ctx: RunContext, select: set[str] | None = None, full_refresh: bool = False,
            reprocess: DataFrame | None = None) -> list[str]:
        """Run the selected steps (all by default) in layer order."""
        unknown = (select or set()) - set(STEPS)
        if unknown:
            raise ValueError(f"unknown steps {sorted(unknown)}; there are {STEPS}")
        ctx = ctx.pinned()
        done = []
        for step in STEPS:
            if select is None or step in select:
                if step == "gold_dim":
                    self.gold_dim(ctx, full_refresh)
                elif step == "gold_fact":
                    self.gold_fact(ctx, full_refresh, reprocess)
                else:
                    getattr(self, step)(ctx)
                done.append(step)
        return done

    def _carry_tags(self, rows: DataFrame, layer: str, table: str) -> DataFrame:
        """Propagating tags follow the columns of what a step is about to write, as its analysed plan tells."""
        if self.bindings.propagating:
            propagate_by_lineage(self.bindings, self.name(layer, table), self._catalog.lineage(rows))
        return rows

    def _bronze(self, table: str, rows: DataFrame, copies: dict[str, str] | None = None) -> None:
        tables.materialize_table(self._carry_tags(rows, "BRONZE", table), self.name("BRONZE", table), copies=copies)

    def bronze_listings(self, ctx: RunContext) -> None:
        self._bronze("Listings", lodging.bronze_listings(self.read("LANDING", "Listings"), ctx))

    def bronze_reviews(self, ctx: RunContext) -> None:
        self._bronze("Reviews", lodging.bronze_reviews(self.read("LANDING", "Reviews"), ctx), dict.fromkeys(lodging.COMMENT_COPIES, "comments"))

    def bronze_drivers(self, ctx: RunContext) -> None:
        self._bronze("Drivers", lodging.bronze_drivers(self.read("LANDING", "Drivers"), ctx))

    def _silver(self, table: str, types: dict[str, str], ctx: RunContext) -> None:
        source = lodging.silver_source(self.read("BRONZE", table), types, ctx)
        self._carry_tags(source, "SILVER", table)
        self.silver(table).load_by_check(source, list(types), ctx)

    def silver_listings(self, ctx: RunContext) -> None:
        self._silver("Listings", lodging.LISTING_TYPES, ctx)

    def silver_reviews(self, ctx: RunContext) -> None:
        self._silver("Reviews", lodging.REVIEW_TYPES, ctx)

    def _gold(self, table: str, key: str, build, full_refresh: bool, reprocess: DataFrame | None = None) -> None:
        """Rebuild a gold table, or merge what silver's loads have changed into the slices that it touches."""
        silver, name = self.silver("Listings"), self.name("GOLD", table)
        if self.gold_mode == "table":
            tables.overwrite(self._carry_tags(build(silver.current()), "GOLD", table), name, buckets=(silver.buckets, key) if silver.buckets else None)
            return
        gold, load = SlicedTable(self.spark, name, [key], silver.slices, silver.buckets), silver.load_number()
        taken = gold.taken()
        if full_refresh or taken is None or taken > load:
            gold.overwrite(self._carry_tags(build(silver.current()), "GOLD", table), load)
            return
        if taken == load and reprocess is None:
            return
        fresh, gone = silver.changes_since(taken)
        if reprocess is not None:
            again = silver.current().join(reprocess.distinct(), reprocess.columns, "left_semi")
            fresh = fresh.unionByName(again.join(fresh.select("id"), "id", "left_anti"))
        as_gold = lambda rows: rows.select(F.col("id").alias(key))
        gold.merge(self._carry_tags(build(fresh), "GOLD", table), "trusted", keys=as_gold(fresh), gone=as_gold(gone), taken=load)

    def gold_dim(self, ctx: RunContext, full_refresh: bool = False) -> None:
        self._gold("Dim_Listing_Details", "ID", lambda rows: lodging.gold_listing_dim(rows, ctx, self.names), full_refresh)

    def gold_fact(self, ctx: RunContext, full_refresh: bool = False, reprocess: DataFrame | None = None) -> None:
        dim, geo, ward = (self.read("GOLD", t) for t in ("Dim_Listing_Details", "Dim_Geography", "Dim_Geography_Geospatial"))
        self._gold("Fact_Listings", "LISTING_ID",
                   lambda rows: lodging.gold_listing_fact(rows, dim, geo, ward, ctx, self.names), full_refresh, reprocess)

    # --- checks --------------------------------------------------------------

    def checks(self) -> list[Check]:
        land, bronze = (lambda t: self.read("LANDING", t)), (lambda t: self.read("BRONZE", t))
        reviews = [*lodging.REVIEW_TYPES, *lodging.COMMENT_COPIES]
        p1, recon, dq = "P1", "recon", "dq"  # Fixed values: tags of the checks
        return [
            Check("reviews_listing_id_not_null", lambda: not_null(bronze("Reviews"), "listing_id"), frozenset({dq, p1})),
            Check("reviews_listing_id_is_number", lambda: of_type(bronze("Reviews"), "listing_id", "number"), frozenset({dq, p1})),
            Check("reviews_row_count", lambda: compare_row_count(land("Reviews"), bronze("Reviews")), frozenset({dq, p1})),
            Check("reviews_content",
                  lambda: reconcile(lodging.landed_reviews(land("Reviews")).select(*reviews), bronze("Reviews").select(*reviews), "set", texts="digest"),
                  frozenset({p1, recon})),
            Check("drivers_row_count", lambda: compare_row_count(land("Drivers"), bronze("Drivers")), frozenset({p1, recon})),
            Check("drivers_content",
                  lambda: reconcile(flatten_variant(land("Drivers"), lodging.DRIVER_FIELDS), bronze("Drivers").select(*lodging.DRIVER_FIELDS)),
                  frozenset({p1, recon})),
            Check("fact_listing_unique", lambda: unique(self.read("GOLD", "Fact_Listings"), ["LISTING_ID"]), frozenset({dq})),
            Check("dim_listing_unique", lambda: unique(self.read("GOLD", "Dim_Listing_Details"), ["ID"]), frozenset({dq})),
            Check("fact_listing_in_dim",
                  lambda: relationships(self.read("GOLD", "Fact_Listings"), ["LISTING_SK"], self.read("GOLD", "Dim_Listing_Details"), ["SK"]),
                  frozenset({dq})),
        ]

    def check(self, tags: set[str] | None = None) -> DataFrame:
        return run_checks(self.checks(), tags)

    def reset(self, layers: tuple[str, ...] = REBUILT) -> None:
        """Drop what a build makes; landing and the reference dimensions stay."""
        tables.drop_layers(self.spark, self.layers, [self.schema], list(layers))
        gold = [self.name("GOLD", t) for t in ("Dim_Listing_Details", "Fact_Listings")]
        for g in gold:
            SlicedTable(self.spark, g, []).drop()
        tables.drop(self.spark, *gold)
