"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_even(value: Column | str, digits: int = 0) -> Column:
    """Round halves to even on the scaled double, as array libraries do.

    ``F.bround`` goes through the decimal text of the double and so differs on
    values such as 1.015; the scaled form also stays inside code generation.
    Adding 0.0 turns -0.0 into 0.0.
    """
    scale = float(10 ** digits)
    return F.rint(as_col(value).cast("double") * scale) / scale + F.lit(0.0)


#: Decimal numbers and infinity; type suffixes and hexadecimal forms are not numbers.
NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$|^\s*[+-]?inf(inity)?\s*$"


def to_number(value: Column | str) -> Column:
    """Text to double; bad text and NaN become null."""
    text = as_col(value).cast("string")
    return F.when(text.rlike(NUMBER), as_col(value).try_cast("double"))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields null for a zero or missing denominator."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def binned(value: Column | str, bins: Sequence[tuple[float | None, str]],
           low: float | None = None) -> Column:
    """Label of the first bin whose inclusive upper edge is reached.

    Values below ``low`` and missing values get null.
    """
    value = as_col(value)
    label = None
    for edge, name in bins:
        hit = value.isNotNull() if edge is None else value <= F.lit(edge)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label if low is None else F.when(value >= F.lit(low), label)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in kilometres."""
    p1, l1, p2, l2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    chord = (F.pow(F.sin((p2 - p1) / 2), 2)
             + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2))
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(chord))


def share(condition: Column) -> Column:
    """Aggregate: fraction of rows where the condition holds."""
    return F.avg(condition.cast("int"))


def plain_zeros(df: DataFrame) -> DataFrame:
    """-0.0 made 0.0 in all numbers, as grouping does."""
    return df.withColumns({name: (F.col(name) + F.lit(0.0)).cast(kind)
                           for name, kind in df.dtypes if kind in ("double", "float")})
