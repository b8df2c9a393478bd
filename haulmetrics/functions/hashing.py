"""Hash-derived values: the same on every run, machine and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulmetrics.functions.numeric import as_col


def md5_head(value: Column, digits: int = 8) -> Column:
    """First hex digits of the md5 as a whole number."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("bigint")


def stable_fraction(key: Column | str) -> Column:
    """Key mapped to one of 10,000 evenly spaced fractions in [0, 1)."""
    return (md5_head(as_col(key).cast("string")) % 10_000) / F.lit(10_000.0)


def uniform(key: Column | str, name: str, seed: int = 42) -> Column:
    """Repeatable draw in [0, 1) for one row and one purpose."""
    return md5_head(F.concat_ws("|", as_col(key), F.lit(name), F.lit(str(seed)))) / F.lit(2.0 ** 32)


def uniform_int(key, name: str, low: int, high: int, seed: int = 42) -> Column:
    """Draw from low .. high - 1."""
    return (F.floor(uniform(key, name, seed) * (high - low)) + low).cast("int")


def uniform_real(key, name: str, low: float, high: float, seed: int = 42) -> Column:
    return uniform(key, name, seed) * (high - low) + low


def choice(key, name: str, options: Sequence, seed: int = 42) -> Column:
    index = uniform_int(key, name, 0, len(options), seed) + 1
    return F.element_at(F.array(*[F.lit(option) for option in options]), index)
