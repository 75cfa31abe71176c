"""Types that hold every value of another one."""

from __future__ import annotations

from pyspark.sql.types import ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType

#: Whole numbers by size, and the most decimal digits that each may have.
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_MAX_DIGITS = 38


def same(a: DataType, b: DataType) -> bool:
    """Equal but for whether parts may be NULL."""
    return a.simpleString() == b.simpleString()


def fits(a: DataType, b: DataType) -> bool:
    """Whether every value of type ``a`` is one of type ``b``."""
    if same(a, b) or isinstance(a, NullType):
        return True
    if type(a) in _WHOLE:
        if type(b) in _WHOLE:
            return _WHOLE[type(a)] <= _WHOLE[type(b)]
        if isinstance(b, DecimalType):
            return _WHOLE[type(a)] <= b.precision - b.scale
        return isinstance(b, DoubleType) and not isinstance(a, LongType)
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        return a.scale <= b.scale and a.precision - a.scale <= b.precision - b.scale
    return isinstance(a, FloatType) and isinstance(b, DoubleType)


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that both fit, or None."""
    for x, y in ((a, b), (b, a)):
        if fits(x, y):
            return y
    x, y = (DecimalType(_WHOLE[type(t)], 0) if type(t) in _WHOLE else t for t in (a, b))
    if isinstance(x, DecimalType) and isinstance(y, DecimalType):
        scale, whole = max(x.scale, y.scale), max(x.precision - x.scale, y.precision - y.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= _MAX_DIGITS else None
    return None
