"""Typed casts from landed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# "bigint" goes through a wide decimal so that '12.7' rounds half up to 13,
# as a warehouse INT cast does, and 19-digit ids survive.
_VIA_DECIMAL = "decimal(38,0)"


def _integral(kind: str) -> bool:
    return kind.lower() in ("bigint", "long")


def typed(col: Column | str, kind: str, on_error: str = "fail") -> Column:
    """Cast to ``kind``; a bad value fails the job, or becomes NULL with ``on_error="null"``."""
    c = F.col(col) if isinstance(col, str) else col
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    cast = (lambda x, t: x.try_cast(t)) if on_error == "null" else (lambda x, t: x.cast(t))
    if _integral(kind):
        return cast(cast(c, _VIA_DECIMAL), "bigint")
    return cast(c, kind)


def is_bad(col: Column | str, kind: str) -> Column:
    """True where a landed value is present but does not fit ``kind``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & typed(c, kind, on_error="null").isNull()
