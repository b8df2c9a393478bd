"""Join per-group statistics back onto rows, whatever the size or skew of the groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
HOT_KEYS = BROADCAST_ROWS
#: A narrow table may have more rows: as many as take this many bytes at ``_row_bytes`` each.
BROADCAST_BYTES = 128 << 20


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Left join on ``keys``, keeping one copy of each key column."""
    renamed = right.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    tests = [left[k].eqNullSafe(renamed[f"__k_{k}"]) if null_safe
             else left[k] == renamed[f"__k_{k}"] for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, tests), "left")
    return joined.drop(*[f"__k_{k}" for k in keys])


def _row_bytes(stats: DataFrame) -> int | None:
    """About what a broadcast row takes; None where a column may be of any length."""
    sizes = {"string": 40, "decimal": 24}
    found = 48  # hash table and row header
    for _, kind in stats.dtypes:
        if kind.startswith(("array", "map", "struct", "binary")):
            return None
        found += sizes.get(kind.partition("(")[0], 8)
    return found


def _broadcast_limit(stats: DataFrame, rows: int, size: int) -> int:
    width = _row_bytes(stats)
    return max(rows, size // width) if width else rows


def fits(table: DataFrame, size: int = BROADCAST_BYTES) -> bool:
    """Whether a staged table may be broadcast, by the bytes that its rows and texts take."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in table.dtypes
             if kind in ("string", "binary")]
    if any(kind.startswith(("array", "map", "struct")) for _, kind in table.dtypes):
        return False
    row = F.lit(48 + 8 * len(table.columns))
    found = table.agg(F.sum(reduce(lambda a, b: a + b, texts, row))).first()[0]
    return (found or 0) <= size


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], *, weight: str,
           null_safe: bool = False, broadcast_rows: int = BROADCAST_ROWS,
           hot_keys: int = HOT_KEYS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left-join ``stats`` (one row per key) to ``df``.

    ``stats`` should be a staged table: its row count is read first. Up to
    ``broadcast_rows`` rows, or more of a narrow table of up to ``broadcast_bytes``,
    it is broadcast and ``df`` is not shuffled. Beyond that the keys holding more than 1/``hot_keys`` of all rows (by ``weight``,
    so at most ``hot_keys`` of them) are still broadcast, and their rows stay
    where they are, as do rows without a key. Only the others travel by key;
    their groups are small, so no task gets a large one. ``df`` is then read
    once for either part and should come from a stored table.
    """
    keys = list(keys)
    values = [c for c in stats.columns if c not in keys and c != weight]
    limit = broadcast_rows
    if broadcast_rows:
        limit = _broadcast_limit(stats.drop(weight), broadcast_rows, broadcast_bytes)
    if stats.count() <= limit:
        return _on(df, F.broadcast(stats.drop(weight)), keys, null_safe)

    total = stats.agg(F.sum(weight)).scalar()
    is_hot = F.coalesce(F.col(weight) * F.lit(hot_keys) > total, F.lit(False))
    hot = (stats.where(is_hot).drop(weight)
           .withColumnsRenamed({c: f"__hot_{c}" for c in values})
           .withColumn("__hot", F.lit(True)))
    rows = _on(df, F.broadcast(hot), keys, null_safe)

    settled = F.col("__hot").isNotNull()
    if not null_safe:
        settled = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], settled)
    near = rows.where(settled).select(
        *df.columns, *[F.col(f"__hot_{c}").alias(c) for c in values])
    # one small row per key: hashing them spares sorting the rows of ``df``
    cold = stats.where(~is_hot).drop(weight).hint("shuffle_hash")
    far = _on(rows.where(~settled).select(*df.columns), cold, keys, null_safe)
    return near.unionByName(far.select(*df.columns, *values))
