"""Exact dedup: binary-fuse filters of an immutable snapshot screen incoming digests.

A snapshot is a set of rows that no longer changes. Its distinct digests are dealt into
buckets, and each bucket gets a static 3-wise binary-fuse filter of one byte per slot,
about 10 bits a digest. An incoming batch is folded to its distinct digests, and each
bucket of them is probed against the filter of that bucket. Only positives (all true
ones, and one in 256 of the others) are joined with the exact buckets of the snapshot.
Duplicates inside the new batch are grouped separately.

Digests found twice are then checked byte by byte: the rows that hold them are grouped
by digest and text, copies being folded before the shuffle. Texts with one digest but
different bytes stay apart. Rows get their class by an equi-join of narrow staged
tables, which adaptive execution splits where one text has many copies.

Null texts count as empty and so equal each other. Of equal texts the row with the
largest key stays; rows that repeat the key as well stay with it. A null key is less than
any other. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.session import stage

#: Distinct digests that one filter holds on average.
BUCKET_KEYS = 1024
#: Filters of the digests to check are broadcast up to this size; beyond it all rows
#: are grouped by digest and text, with the same result.
MAX_BROADCAST_BYTES = 64 << 20


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    h = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass(frozen=True)
class FuseFilter:
    """A static set of 64-bit keys: no false negatives, 1/256 false positives."""

    seed: int
    segment: int
    segments: int
    slots: bytes

    @staticmethod
    def _probe(keys, seed, segment, segments):
        """Three slots in consecutive segments, and the fingerprint, of each key."""
        h = _mix(keys, seed)
        mask = np.uint64(segment - 1)
        first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        places = np.stack([first, second, third]).astype(np.int64)
        return places, ((h ^ (h >> np.uint64(40))) & np.uint64(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
        segment = min(segment, 1 << 18)
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, -(-int(n * factor) // segment) - 2)
        for seed in range(1, 1000):
            places, prints = cls._probe(keys, seed, segment, segments)
            order = cls._peel(places, (segments + 2) * segment)
            if order is not None:
                break
            segments += seed % 4 == 0  # small sets now and then need more room
        else:
            raise RuntimeError("no seed peels these keys")
        slots = np.zeros((segments + 2) * segment, np.uint8)
        for chosen, own in reversed(order):
            a, b, c = slots[places[:, chosen]]  # the own slot is still zero
            slots[own] = prints[chosen] ^ a ^ b ^ c
        return cls(seed, segment, segments, slots.tobytes())

    @staticmethod
    def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, slots that only they touch), or None if a core remains."""
        n = places.shape[1]
        index = np.arange(n)
        count = np.bincount(places.ravel(), minlength=size)
        total = np.zeros(size, np.int64)  # sum of the keys at a slot: the key, if it is alone
        for row in places:
            np.add.at(total, row, index)
        order, left, alone = [], n, np.flatnonzero(count == 1)
        while len(alone):
            chosen, at = np.unique(total[alone], return_index=True)
            order.append((chosen, alone[at]))
            left -= len(chosen)
            touched = places[:, chosen]
            for row in touched:
                np.subtract.at(count, row, 1)
                np.subtract.at(total, row, chosen)
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        return order if not left else None

    def contains(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._probe(keys.astype(np.uint64), self.seed, self.segment,
                                     self.segments)
        a, b, c = np.frombuffer(self.slots, np.uint8)[places]
        return prints == a ^ b ^ c


FILTER = "__bucket long, seed int, segment int, segments int, slots binary"


def _probe_key() -> Column:
    return F.xxhash64("__digest")


def _bucketed(digests: DataFrame, buckets: int) -> DataFrame:
    return digests.withColumns({"__bucket": F.pmod(F.hash("__digest"), F.lit(buckets)).cast("long"),
                                "__probe": _probe_key()})


def build_filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the distinct ``__digest`` values."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(pdf["__probe"].to_numpy())
        return pd.DataFrame([{"__bucket": pdf["__bucket"].iloc[0], **made.__dict__}])

    return (_bucketed(digests.select("__digest"), buckets).groupBy("__bucket")
            .applyInPandas(build, FILTER))


def screen(digests: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The distinct ``__digest`` values that the filters may hold."""
    def probe(keys: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(keys) or not len(found):
            return keys[["__digest"]].iloc[:0]
        row = found.iloc[0]
        made = FuseFilter(int(row.seed), int(row.segment), int(row.segments), row.slots)
        return keys.loc[made.contains(keys["__probe"].to_numpy()), ["__digest"]]

    left = _bucketed(digests.select("__digest"), buckets).groupBy("__bucket")
    return left.cogroup(filters.groupBy("__bucket")).applyInPandas(probe, "__digest binary")


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("__digest").agg(F.count("*").alias("__n"))


def repeated_digests(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Digests held by two rows or more of both tables together (narrow, staged)."""
    old, new = stage(_groups(snapshot), "snapshot_digests"), stage(_groups(batch), "batch_digests")
    buckets = 1 + old.count() // BUCKET_KEYS
    filters = stage(build_filters(old, buckets), "fuse_filters")
    positives = screen(new, filters, buckets)
    both = positives.join(old, "__digest", "left_semi")
    several = [t.where("__n > 1").select("__digest") for t in (old, new)]
    return stage(reduce(DataFrame.union, [*several, both]).distinct(), "repeated_digests")


def _holding(texts: DataFrame, digests: DataFrame, limit: int) -> DataFrame:
    """Rows whose digest may be in ``digests``: all that are, and a few others."""
    n = digests.count()
    buckets = 1 + n // BUCKET_KEYS
    if not n or 2 * n + 200 * buckets > limit:
        return texts.where(F.lit(n > 0))
    made = {r["__bucket"]: FuseFilter(r.seed, r.segment, r.segments, bytes(r.slots))
            for r in build_filters(digests, buckets).collect()}
    held = texts.sparkSession.sparkContext.broadcast(made)

    @F.pandas_udf("boolean")
    def may_hold(bucket: pd.Series, probe: pd.Series) -> pd.Series:
        out = np.zeros(len(bucket), bool)
        for value, at in bucket.groupby(bucket).indices.items():
            if value in held.value:
                out[at] = held.value[value].contains(probe.to_numpy()[at])
        return pd.Series(out)

    return (_bucketed(texts, buckets).where(may_hold("__bucket", "__probe"))
            .drop("__bucket", "__probe"))


def dedup(docs: DataFrame, is_snapshot: Column, *, key: str = "doc_id", text: str = "text",
          digest_bytes: int = 32, broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    ``is_snapshot`` tells the rows of the snapshot from those of the new batch. Digests
    are the first ``digest_bytes`` bytes of SHA-256.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    sha = F.unhex(F.sha2(value, 256))
    full = docs.select(F.col(key).alias("__key"), value.alias("__text"), sha.alias("__sha"),
                       F.substring(sha, 1, digest_bytes).alias("__digest"))
    rows = stage(docs.select(F.col(key).alias("__key"), sha.alias("__sha"),
                             F.coalesce(is_snapshot, F.lit(False)).alias("__old"))
                 .withColumn("__digest", F.substring("__sha", 1, digest_bytes)), "digests")
    repeated = repeated_digests(rows.where("__old"), rows.where("NOT __old"))

    # byte check: classes of equal bytes among the rows that share a digest
    texts = _holding(full.select("__key", "__text", "__digest"), repeated, broadcast_bytes)
    classes = (texts.groupBy("__digest", "__text")
               .agg(F.max("__key").alias("__keep"), F.count("*").alias("__size")))
    per_digest = stage(classes.groupBy("__digest")
                       .agg(F.max("__keep").alias("__keep"), F.max("__size").alias("__size"),
                            F.count("*").alias("__texts"))
                       .where("__size > 1"), "classes")
    found = rows.drop("__old").join(per_digest, "__digest", "left")
    if not per_digest.where("__texts > 1").isEmpty():
        # different texts under one digest: their rows get the class by the bytes
        clashing = per_digest.where("__texts > 1").select("__digest")
        exact = stage(classes.join(clashing, "__digest", "left_semi"), "clashing_classes")
        apart = (full.join(clashing, "__digest", "left_semi")
                 .join(exact, ["__digest", "__text"])
                 .select("__digest", "__key", "__sha", "__keep", "__size",
                         F.lit(1).cast("bigint").alias("__texts")))
        found = found.where("coalesce(__texts, 1) = 1").unionByName(apart)
    keep = F.when(F.col("__size") > 1, F.col("__keep")).otherwise(F.col("__key"))
    return found.select(
        F.col("__key").alias(key), keep.alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("__key").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"))
