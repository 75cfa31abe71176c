"""Surrogate keys, date keys and banding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str, sep: str = "||") -> Column:
    """SHA-1 over the key parts as text, NULL parts read as empty."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha1(F.concat_ws(sep, *parts))


def version_id(keys: list[Column | str], updated_at: Column | str) -> Column:
    """Row id of one version of one key; bars inside the parts are escaped, so that no two keys read alike."""
    plain = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in [*keys, updated_at]]
    parts = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for p in plain]
    return F.md5(F.concat_ws("|", *parts))


def date_key(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyyMMdd")


def band(col: Column | str, bands: list[tuple[float, str]], default: str) -> Column:
    """First band whose floor is strictly below the value; NULL falls to ``default``."""
    if not bands:
        return F.lit(default)
    c = _col(col)
    (floor, label), *rest = bands
    start = F.when(c > F.lit(floor), F.lit(label))
    return reduce(lambda acc, b: acc.when(c > F.lit(b[0]), F.lit(b[1])), rest, start).otherwise(F.lit(default))
