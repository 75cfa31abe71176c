"""Audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.settings import RunContext

# Audit column names, in the order they lead every table.
AUDIT_COLUMNS = ("SYSLOADDATE", "SYSRUNID", "SYSPROCESSINGTOOL", "SYSDATAPROCESSORNAME")
SOURCE_SYSTEM = "SOURCESYSTEM"


def audit_columns(ctx: RunContext) -> list:
    values = (ctx.timestamp(), F.lit(ctx.run_id), F.lit(ctx.tool), F.lit(ctx.project))
    return [v.alias(n) for n, v in zip(AUDIT_COLUMNS, values)]


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)


def with_audit(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Lead with fresh audit columns; any that came with the rows are replaced.

    ``SOURCESYSTEM`` is not one of them: it names where a row first came from
    and travels with it through the layers.
    """
    rest = without_audit(df)
    return rest.select(*audit_columns(ctx), *rest.columns)
