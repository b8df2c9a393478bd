"""Ranked lexical search: best-first document intervals bounded by range maxima.

The index is made of segments of about ``SEGMENT_BYTES`` of text: documents in order of
their key, their lengths, and for every term its postings (document, occurrences). Segments
are rows of a staged table; no posting is shuffled.

A posting's impact is what its term adds to the score of its document. In a segment a
sparse table over the impacts of the searched terms tells the largest one of any range of a
posting list. An interval of documents is bounded by the sum of those maxima over the terms
of an item. The intervals with the highest bounds are taken first, some at a time: each is
split at the document of its largest impact, which is scored, and what is left on both
sides gets bounds of its own. Intervals below the item's k-th score so far, also that of the
task's earlier segments, are done with; of those that tie with it, the ones with later keys.

Document counts of terms are taken over all segments. Items are searched in blocks of
bounded bytes, dealt by hash; each is broadcast in turn and its results are stored before
the next. A task hands on its k best documents of each item, of which the k best are ranked.

Terms are runs of ASCII digits and letters (A-Z lower-cased) and of all codes beyond ASCII.
Null and empty texts have no terms and are not counted; items without terms and documents
without any of an item's terms have no row. Repeated rows are documents, or items, of their
own. Equal scores go by ascending key, null keys last. Memory follows a segment, and a
document is indexed whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.llm.chunks import Numbers, gather
from haulmetrics.llm.common import map_batches
from haulmetrics.session import new_path, stage

#: Terms, after A-Z are lower-cased, on UTF-8 bytes.
TERM = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_SHARE = 1_000_000_000, 1_000, 8, 90
TOP = 10
SEGMENT_BYTES = 16 << 20
#: Bytes of the distinct terms of the items of a block, on average.
BLOCK_BYTES = 8 << 20
#: Intervals split at once, from the first step to the last.
FIRST_SPLITS, MOST_SPLITS = 8, 256


def terms(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode().lower())


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


COLUMNS = ("lengths", "terms", "sizes", "rows", "tfs")


def _segment(keys: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    order = pc.array_sort_indices(keys, order="ascending", null_placement="at_end").to_pylist()
    numbers, lengths, ids, tfs = Numbers(), [], [], []
    for row in order:
        found = list(map(numbers.__getitem__, TERM.findall(texts[row])))
        lengths.append(len(found))
        names, times = np.unique(np.array(found, np.int32), return_counts=True)
        ids.append(names)
        tfs.append(times)
    rows = np.repeat(np.arange(len(order), dtype=np.int32), list(map(len, ids)))
    ids = np.concatenate(ids)
    by_term = np.argsort(ids, kind="stable")
    made = {"lengths": _pack(np.array(lengths, np.int64)),
            "terms": zstandard.compress(b"\n".join(numbers), 1),  # no term has a line break
            "sizes": _pack(np.bincount(ids, minlength=len(numbers)).astype(np.int32)),
            "rows": _pack(rows[by_term]), "tfs": _pack(np.concatenate(tfs)[by_term].astype(np.int32))}
    ordered = keys.take(pa.array(order, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), ordered),
         pa.array([sum(n > 0 for n in lengths)], pa.int64()), pa.array([sum(lengths)], pa.int64()),
         *[pa.array([made[c]], pa.binary()) for c in COLUMNS]],
        ["__keys", "__docs", "__terms", *COLUMNS])


def build_index(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per segment, staged: keys, counts, and the packed postings."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        for batch in batches:
            at = 0
            for i, value in enumerate(batch["__text"]):
                texts.append((value.as_py() or "").encode().lower())
                size += len(texts[-1])
                if size >= segment_bytes:
                    keys.append(batch["__key"].slice(at, i + 1 - at))
                    yield _segment(pa.concat_arrays(keys), texts)
                    keys, texts, size, at = [], [], 0, i + 1
            keys.append(batch["__key"].slice(at))
        if texts:
            yield _segment(pa.concat_arrays(keys), texts)

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    schema = f"__keys array<{kind}>, __docs long, __terms long, " + ", ".join(
        f"{c} binary" for c in COLUMNS)
    return stage(rows.mapInArrow(run, schema), "ranked_index").withMetadata(
        "__keys", {"name": key})


def impacts(weight: np.ndarray, tf: np.ndarray, length: np.ndarray, docs: int,
            total: int) -> np.ndarray:
    """What postings add to the scores of their documents."""
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * docs) // total
    return weight * ((SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * norm))


class Segment:
    """Postings of the searched terms with their impacts and the table of range maxima."""

    def __init__(self, row: dict, wanted: dict[bytes, int], weights: np.ndarray, docs: int,
                 total: int):
        self.keys = row["__keys"]
        names = zstandard.decompress(row["terms"]).split(b"\n")
        hits = [(i, at) for i, name in enumerate(names) if (at := wanted.get(name)) is not None]
        #: Number of the list of a searched term, -1 if it is not in the segment.
        self.list_of = np.full(len(wanted), -1, np.int64)
        self.list_of[[at for _, at in hits]] = np.arange(len(hits))
        own, term = np.array(hits, np.int64).reshape(-1, 2).T
        sizes = _unpack(row["sizes"], np.int32).astype(np.int64)
        at = gather(own, np.cumsum(sizes) - sizes, sizes)
        self.sizes = sizes[own]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.rows = _unpack(row["rows"], np.int32)[at]
        self.impact = impacts(np.repeat(weights[term], self.sizes),
                              _unpack(row["tfs"], np.int32)[at].astype(np.int64),
                              _unpack(row["lengths"], np.int64)[self.rows], docs, total)
        longest = int(self.sizes.max(initial=1))
        self.log = np.zeros(longest + 1, np.int64)
        for n in range(2, longest + 1):
            self.log[n] = self.log[n >> 1] + 1
        # a range never crosses lists, so one table serves all of them
        table = [np.arange(len(self.rows), dtype=np.int32)]
        for level in range(int(self.log[-1])):
            left, right = table[-1], np.roll(table[-1], -(1 << level))
            table.append(np.where(self.impact[left] >= self.impact[right], left, right))
        self.table = np.stack(table)

    def search(self, item: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """The k best (-score, key is null, key) of ``best`` and this segment for one item,
        given by the numbers of its terms."""
        lists = self.list_of[item]
        lists = lists[lists >= 0]
        size = len(self.keys)
        if not len(lists):
            return best
        # place of the first posting of every list at or after every document
        first = np.zeros((size + 1, len(lists)), np.int32)
        at = gather(lists, self.starts, self.sizes)
        first[self.rows[at] + 1, np.repeat(np.arange(len(lists)), self.sizes[lists])] = 1
        np.cumsum(first, axis=0, out=first)
        first += self.starts[lists].astype(np.int32)
        low, high = np.array([0]), np.array([size])
        bound, peak = self._bounds(first, low, high)
        floor, last = self._limit(best, k)
        splits = FIRST_SPLITS
        while True:
            keep = (bound > floor) | ((bound == floor) & (low < last))
            low, high, bound, peak = low[keep], high[keep], bound[keep], peak[keep]
            if not len(low):
                return best
            if len(low) > splits:
                order = np.argpartition(-bound, splits)
                now, later = order[:splits], order[splits:]
            else:
                now, later = np.arange(len(low)), np.zeros(0, np.int64)
            best = self._scored(first, peak[now], best, k, floor)
            floor, last = self._limit(best, k)
            new_low = np.concatenate([low[now], peak[now] + 1])
            new_high = np.concatenate([peak[now], high[now]])
            some = new_low < new_high
            new_low, new_high = new_low[some], new_high[some]
            new_bound, new_peak = self._bounds(first, new_low, new_high)
            low, high = np.concatenate([low[later], new_low]), np.concatenate([high[later], new_high])
            bound = np.concatenate([bound[later], new_bound])
            peak = np.concatenate([peak[later], new_peak])
            splits = min(2 * splits, MOST_SPLITS)

    def _limit(self, best: list[tuple], k: int) -> tuple[int, int]:
        """The score to reach, and from which document on it must be passed."""
        if len(best) < k:
            return 1, len(self.keys)
        score, *key = best[-1]
        return -score, bisect_right(self.keys, tuple(key), key=lambda v: (v is None, _value(v)))

    def _bounds(self, first, low, high) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the maxima of all lists in each interval, and the document of the largest."""
        begin, end = first[low], first[high]
        length = end - begin
        level = self.log[length]
        final = len(self.rows) - 1
        left = self.table[level, np.minimum(begin, final)]
        right = self.table[level, np.maximum(end - (1 << level), 0)]
        a, b = self.impact[left], self.impact[right]
        most = np.where(length > 0, np.maximum(a, b), 0)
        top = most.argmax(axis=1)
        every = np.arange(len(top))
        where = np.where(a >= b, left, right)[every, top]
        # an interval without postings is bounded by 0 and never split
        return most.sum(axis=1), self.rows[where].astype(np.int64)

    def _scored(self, first, docs, best: list[tuple], k: int, floor: int) -> list[tuple]:
        begin = first[docs]
        held = first[docs + 1] > begin
        score = np.where(held, self.impact[np.minimum(begin, len(self.rows) - 1)], 0).sum(axis=1)
        good = np.flatnonzero(score >= floor)
        if not len(good):
            return best
        keys = [self.keys[d] for d in docs[good].tolist()]
        found = [(-s, v is None, _value(v)) for s, v in zip(score[good].tolist(), keys)]
        return sorted(best + found)[:k]


def _value(key):
    """Null keys are alike."""
    return 0 if key is None else key


def item_terms(items: DataFrame, *, key: str = "item_id", text: str = "text") -> DataFrame:
    """``__item`` (a number of the row), ``__name``, the distinct terms joined by blanks."""
    kind = items.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [b" ".join(sorted(set(terms(v.as_py())))) for v in batch["__text"]]
        return pa.RecordBatch.from_arrays([batch["__name"], pa.array(found, pa.binary())],
                                          ["__name", "__found"])

    rows = items.select(F.col(key).alias("__name"), F.col(text).alias("__text"))
    return stage(map_batches(rows, f"__name {kind}, __found binary", run)
                 .where(F.length("__found") > 0)
                 .withColumn("__item", F.monotonically_increasing_id()), "item_terms")


def _document_counts(index: DataFrame, wanted: dict[bytes, int]) -> np.ndarray:
    """How many documents hold each wanted term."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(len(shared.value), np.int64)
        for names, sizes in zip(batch["terms"], batch["sizes"]):
            of = [(at, i) for i, name in enumerate(zstandard.decompress(names.as_py()).split(b"\n"))
                  if (at := shared.value.get(name)) is not None]
            if of:
                at, i = np.array(of).T
                total[at] += _unpack(sizes.as_py(), np.int32)[i]
        held = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["__at", "__df"])

    counted = (map_batches(index.select("terms", "sizes"), "__at long, __df long", run)
               .groupBy("__at").agg(F.sum("__df").alias("__df")).toArrow())
    out = np.zeros(len(wanted), np.int64)
    out[counted["__at"].to_numpy()] = counted["__df"].to_numpy()
    shared.unpersist()
    return out


def search(index: DataFrame, items: DataFrame, *, key: str = "item_id", text: str = "text",
           top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` best documents of each item: item key, rank, document key, score."""
    spark = index.sparkSession
    field = index.schema["__keys"]
    kind = field.dataType.elementType.simpleString()
    totals = index.agg(F.coalesce(F.sum("__docs"), F.lit(0)),
                       F.coalesce(F.sum("__terms"), F.lit(0))).first()
    docs, total = int(totals[0]), max(1, int(totals[1]))
    asked = item_terms(items, key=key, text=text)
    size = asked.agg(F.coalesce(F.sum(F.length("__found") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // block_bytes))
    path = new_path(spark, "ranked")
    schema = f"__item long, __key {kind}, score long"

    for block in range(blocks):
        # a block is bounded by its bytes, so it may pass through the driver
        some = (asked.where(F.pmod(F.xxhash64("__item"), F.lit(blocks)) == block)
                .select("__item", "__found").toArrow())
        wanted = Numbers()
        lists = [np.array([wanted[t] for t in v.as_py().split(b" ")]) for v in some["__found"]]
        wanted = dict(wanted)
        df = _document_counts(index, wanted)
        weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1)))
                            for n in df.tolist()], np.int64)
        weighty = [of[weights[of] > 0] for of in lists]
        shared = spark.sparkContext.broadcast(
            (dict(zip(some["__item"].to_pylist(), weighty)), wanted, weights))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked_for, names, weight = shared.value
            best: dict[int, list[tuple]] = {item: [] for item in asked_for}
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch[c][i].as_py() for c in ("__keys", *COLUMNS)}
                    segment = Segment(row, names, weight, docs, total)
                    for item, of in asked_for.items():
                        best[item] = segment.search(of, best[item], top)
            found = [(item, None if none else value, -score)
                     for item, rows in best.items() for score, none, value in rows]
            if found:
                columns = [pa.array([r[0] for r in found], pa.int64()),
                           pa.array([r[1] for r in found], batch["__keys"].type.value_type),
                           pa.array([r[2] for r in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["__item", "__key", "score"])

        index.select("__keys", *COLUMNS).mapInArrow(run, schema).write.mode("append").parquet(path)
        shared.unpersist()

    order = Window.partitionBy("__item").orderBy(F.desc("score"), F.asc_nulls_last("__key"))
    ranked = (spark.read.schema(schema).parquet(path)
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return ranked.join(asked.select("__item", "__name"), "__item").select(
        F.col("__name").alias(key), "rank", F.col("__key").alias(field.metadata["name"]), "score")
