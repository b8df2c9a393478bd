"""Date and time column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.functions.numeric import as_col

# Tried in order after the ISO forms; month-first as in US exports.
EXTRA_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy", "M/d/yyyy H:mm:ss", "yyyy/M/d", "yyyy/M/d H:mm",
                 "yyyy/M/d H:mm:ss", "yyyyMMdd", "d-M-yyyy", "d-M-yyyy H:mm:ss", "d.M.yyyy")


MONTH = "(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"


def dated_text(value: Column | str) -> Column:
    """The text with month names in title case; null for a time without a date."""
    text = as_col(value).cast("string")
    text = F.when(~text.rlike(r"^\s*T?[0-9]{1,2}(:|\s*$)"), text)
    return F.when(text.rlike(MONTH), F.initcap(F.trim(text))).otherwise(text)


def parse_timestamp(value: Column | str, formats: Sequence[str] = EXTRA_FORMATS) -> Column:
    """Text to timestamp; text in none of the formats becomes null.

    A time without a date is no timestamp: it would take the day of the run.
    """
    text = dated_text(value)
    return F.coalesce(F.try_to_timestamp(text),
                      *[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])


# What a column may be written in; sections in brackets may be absent. Forms that read the
# same text differently compete by the share of the column that they fit.
_TIME = "[ H:mm[:ss]]"
CANDIDATES = tuple(day + _TIME for day in (
    "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy", "M.d.yyyy",
    "d-MMM-yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")) + ("yyyyMMdd",)
ISO = "ISO"


def _readings(value: Column | str, candidates: Sequence[str]) -> list[Column]:
    """The text read by the ISO forms, then by each candidate."""
    text = dated_text(value)
    return [F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in candidates]]


def _masked(df: DataFrame, column: str, candidates: Sequence[str]) -> DataFrame:
    """Number of known values by mask: bit i says that reading i parses the value, the bits
    above, that it reads it as the first of those that do, too."""
    readings = F.array(*_readings(column, candidates))
    n = len(candidates) + 1
    first = F.get(F.filter("r", lambda t: t.isNotNull()), F.lit(0))
    mask = sum((F.when(F.col("r")[i].isNotNull(), F.lit(1 << i)).otherwise(0)
                + F.when(F.col("r")[i] == first, F.lit(1 << (n + i))).otherwise(0)
                for i in range(n)), F.lit(0).cast("bigint"))
    # parsed once: the array is behind a projection that holds several uses of it
    return (df.where(F.col(column).isNotNull()).select(readings.alias("r"))
            .select(mask.alias("mask")).groupBy("mask").agg(F.count("*").alias("n")))


def date_formats(df: DataFrame, column: str,
                 candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """How the known values of a text column are written: a row for each form that reads any.

    ``parsed`` values are read by the form, ``share`` is their part of all known ones, and
    ``fits_all`` says that it reads every one (an AND over the rows' masks). Forms are tried
    by descending share, ISO first, in the order of the candidates where equal: ``place``;
    ``chosen`` values take their time from this form. ``ambiguous`` marks forms of equal
    share that read a common value as different times, so that only their order decides.
    """
    n = len(candidates) + 1
    masks = _masked(df, column, candidates).collect()  # a few combinations of forms
    return df.sparkSession.createDataFrame(
        _report([(r["mask"], r["n"]) for r in masks], [ISO, *candidates], n),
        "format string, parsed bigint, share double, fits_all boolean, place int, "
        "chosen bigint, ambiguous boolean")


def _report(masks: list[tuple[int, int]], names: list[str], n: int) -> list[tuple]:
    total = sum(count for _, count in masks)
    every = reduce(and_, [mask for mask, _ in masks], (1 << n) - 1)
    parsed = [sum(c for mask, c in masks if mask >> i & 1) for i in range(n)]
    order = sorted((i for i in range(n) if parsed[i]), key=lambda i: (i > 0, -parsed[i], i))
    chosen = [0] * n
    for mask, count in masks:
        if taker := [i for i in order if mask >> i & 1]:
            chosen[taker[0]] += count

    def differ(i: int, j: int) -> bool:
        """Whether a value is read by both forms, as different times."""
        return any(mask >> i & 1 and mask >> j & 1 and (mask >> (n + i) & 1) != (mask >> (n + j) & 1)
                   for mask, _ in masks)

    return [(names[i], parsed[i], parsed[i] / total, bool(every >> i & 1), place, chosen[i],
             i > 0 and any(j != i and j > 0 and parsed[j] == parsed[i] and differ(i, j)
                           for j in order))
            for place, i in enumerate(order, 1)]


def infer_formats(df: DataFrame, column: str,
                  candidates: Sequence[str] = CANDIDATES) -> list[str]:
    """The forms of a column in the order to try them, for ``parse_timestamp``."""
    rows = date_formats(df, column, candidates).orderBy("place").collect()
    return [r["format"] for r in rows if r["format"] != ISO]


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Elapsed days rounded down, so two hours backwards is -1."""
    seconds = (F.unix_micros(as_col(end).cast("timestamp"))
               - F.unix_micros(as_col(start).cast("timestamp")))
    return F.floor(seconds / F.lit(86_400_000_000))


def month_text(value: Column | str) -> Column:
    return F.date_format(as_col(value), "yyyy-MM")


def day(value: Column | str) -> Column:
    return F.to_date(as_col(value))
