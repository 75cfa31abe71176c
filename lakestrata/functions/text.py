"""Text masks and comparisons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def star_after_each(col: Column, n: int) -> Column:
    """Keep ``n`` characters, star the next one, and so on through the whole text.

    ``(?d)`` leaves only a line feed outside ``.``, so a carriage return or a
    Unicode line separator inside a value is masked like any other character.
    """
    return F.regexp_replace(col, f"(?d)(.{{{n}}}).", "$1*")


def equals_ignoring_case(col: Column, value: str) -> Column:
    return F.lower(col) == F.lit(value.lower())


def in_ignoring_case(col: Column, values: list[str]) -> Column:
    return F.lower(col).isin([v.lower() for v in values])
