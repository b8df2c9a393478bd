"""Benchmark decontamination: a distributed positional inverted index.

The index is made of segments, each the documents of one Arrow batch: the segment's
terms, and for every term its postings, the places where it stands. Places number the
words of a segment through, with a gap between documents, so one number tells document
and position. Segments are rows of a staged table; no posting is shuffled.

Searching takes phrases in blocks of a bounded size, each broadcast in turn. In a segment
a phrase starts from its rarest term there: every posting list is moved back by the
term's offset in the phrase, and the lists are intersected from the rarest to the most
frequent, so a phrase whose rarest term is absent costs a look-up. With ``slop`` a term
may stand up to that many places off (proximity match).

Words are runs of digits, ASCII letters (lower-cased) and all codes beyond ASCII. Null and
empty texts have no words and match nothing. A phrase inside one document only; repeated
rows match each for itself. A document is indexed whole, and memory follows the longest
batch, not the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.llm.common import map_batches
from haulmetrics.session import stage

#: Fixed value: words, after A-Z are lower-cased, on UTF-8 bytes.
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
WINDOW = 10
SEGMENT_BYTES = 4 << 20
BLOCK_PHRASES = 50_000
GAP = 64


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def windows(text: str | None, width: int = WINDOW) -> list[bytes]:
    """Distinct windows of an item; one shorter window if it has fewer words."""
    found = words(text)
    if not found:
        return []
    n = max(1, len(found) - width + 1)
    return sorted({b" ".join(found[i:i + width]) for i in range(n)})


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _segment(texts: list[bytes]) -> dict[str, bytes]:
    """Starts and word counts of the documents, terms, and places by term."""
    numbers: dict[bytes, int] = {}
    ids, counts = [], []
    for text in texts:
        found = WORD.findall(text)
        counts.append(len(found))
        ids.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int32,
                               len(found)))
    counts = np.array(counts, np.int64)
    starts = np.concatenate([[0], np.cumsum(counts + GAP)[:-1]])
    ids = np.concatenate(ids)
    place = np.arange(len(ids)) + np.repeat(np.arange(len(texts)) * GAP, counts)
    order = np.argsort(ids, kind="stable")
    lengths = np.bincount(ids, minlength=len(numbers)).astype(np.int32)
    return {"starts": _pack(starts), "counts": _pack(counts),
            "lengths": _pack(lengths), "terms": zstandard.compress(b"\n".join(numbers), 1),
            "places": _pack(place[order].astype(np.int32))}


class Segment:
    def __init__(self, row: dict):
        self.starts, self.counts = _unpack(row["starts"], np.int64), _unpack(row["counts"], np.int64)
        self.places = _unpack(row["places"], np.int32)
        ends = np.cumsum(_unpack(row["lengths"], np.int32)).tolist()
        terms = zstandard.decompress(row["terms"]).split(b"\n")  # no term has a line break
        self.postings = dict(zip(terms, zip([0, *ends[:-1]], ends)))

    def size(self, term: bytes) -> int:
        a, b = self.postings[term]
        return b - a

    def occurrences(self, phrase: list[bytes], slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places where the phrase begins, as its rarest term says, and their documents.

        Terms of other documents are further off than ``slop`` allows.
        """
        none = np.zeros(0, np.int32)
        if slop and len(phrase) + slop > GAP:
            raise ValueError(f"phrase and slop beyond {GAP} words")
        if any(term not in self.postings for term in phrase):
            return none, none
        order = sorted(range(len(phrase)), key=lambda i: self.size(phrase[i]))
        found = None
        for i in order:
            a, b = self.postings[phrase[i]]
            moved = self.places[a:b] - i
            if found is None:
                found = moved
                continue
            at = np.minimum(np.searchsorted(moved, found - slop), len(moved) - 1)
            found = found[np.abs(moved[at] - found) <= slop]
            if not len(found):
                return none, none
        return found, np.searchsorted(self.starts, found + order[0], side="right") - 1


def build_index(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per segment, staged."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, size, texts = 0, 0, []
            for i, value in enumerate(batch["__text"]):
                texts.append((value.as_py() or "").encode("utf-8", "surrogatepass").lower())
                size += len(texts[-1])
                if size >= SEGMENT_BYTES or i + 1 == batch.num_rows:
                    made = _segment(texts)
                    keys = batch["__key"].slice(at, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), keys),
                         *[pa.array([v], pa.binary()) for v in made.values()]],
                        ["__keys", *made])
                    at, size, texts = i + 1, 0, []

    schema = f"__keys array<{kind}>, starts binary, counts binary, lengths binary, "\
             "terms binary, places binary"
    return stage(rows.mapInArrow(run, schema)
                 .withColumn("__segment", F.monotonically_increasing_id()), "phrase_index")


def phrase_blocks(phrases: DataFrame, block: int = BLOCK_PHRASES) -> Iterator[list[tuple]]:
    """(number, phrase) rows in blocks of a bounded size."""
    some = []
    for row in phrases.toLocalIterator():
        some.append((row["phrase_id"], bytes(row["phrase"])))
        if len(some) == block:
            yield some
            some = []
    if some:
        yield some


def search(index: DataFrame, phrases: DataFrame, *, slop: int = 0,
           block: int = BLOCK_PHRASES) -> DataFrame:
    """Matches of distinct phrases (``phrase_id`` long, ``phrase`` binary, terms joined by
    blanks): segment, row in it, first word, number of words, phrase_id."""
    spark = index.sparkSession
    schema = "__segment long, __row int, first long, width int, phrase_id long"

    def one(some: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast([(n, p.split(b" ")) for n, p in some])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    segment, out = Segment(row), []
                    for number, phrase in shared.value:
                        found, of = segment.occurrences(phrase, slop)
                        out += [(row["__segment"], int(d), int(p - segment.starts[d]),
                                 len(phrase), number) for d, p in zip(of, found)]
                    columns = list(zip(*out)) or [[]] * 5
                    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)],
                        ["__segment", "__row", "first", "width", "phrase_id"])

        return index.drop("__keys").mapInArrow(run, schema)

    found = [one(some) for some in phrase_blocks(phrases, block)]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)


def item_phrases(items: DataFrame, *, key: str = "item_id", text: str = "text",
                 width: int = WINDOW) -> DataFrame:
    """Key of the item, ``phrase_id`` and ``phrase`` for every window of every item."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [windows(v.as_py(), width) for v in batch["__text"]]
        counts = np.array([len(f) for f in found])
        return pa.RecordBatch.from_arrays(
            [batch["item"].take(pa.array(np.repeat(np.arange(len(found)), counts))),
             pa.array([p for f in found for p in f], pa.binary())], ["item", "phrase"])

    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("__text"))
    return stage(map_batches(rows, "item string, phrase binary", run)
                 .withColumn("phrase_id", F.xxhash64("phrase")), "item_phrases")


def document_rows(index: DataFrame) -> DataFrame:
    """Segment, row, key and number of words of every indexed document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [_unpack(v.as_py(), np.int64) for v in batch["counts"]]
        sizes = np.array([len(c) for c in counts])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch["__segment"].to_numpy(), sizes)),
             pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])),
             batch["__keys"].flatten(), pa.array(np.concatenate(counts))],
            ["__segment", "__row", "__key", "n_words"])

    kind = index.schema["__keys"].dataType.elementType.simpleString()
    return map_batches(index.select("__segment", "__keys", "counts"),
                       f"__segment long, __row int, __key {kind}, n_words long", run)


def contamination(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", width: int = WINDOW,
                  slop: int = 0) -> DataFrame:
    """One row per document: key, n_words, n_hit, items (sorted ids as text).

    A word is hit if it stands inside an occurrence of a window of an item.
    """
    index = build_index(docs, key=key, text=text)
    phrases = item_phrases(items, key=item, text=item_text, width=width)
    distinct = phrases.groupBy("phrase_id", "phrase").agg(F.lit(1).alias("one")).drop("one")
    matches = stage(search(index, distinct, slop=slop), "phrase_matches")

    # words covered: occurrences in order, each from where those before it end
    at = ["__segment", "__row"]
    before = (Window.partitionBy(*at).orderBy("first", "width")
              .rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("first") + F.col("width")
    hit = (matches.select(*at, F.greatest("first", F.lit(0)).alias("first"), "width").distinct()
           .withColumn("upto", F.coalesce(F.max(end).over(before), F.lit(0)))
           .groupBy(*at).agg(F.sum(F.greatest(F.lit(0), end - F.greatest("first", "upto")))
                             .alias("n_hit")))
    owners = phrases.select("phrase_id", "item").distinct()
    named = (matches.select(*at, "phrase_id").distinct().join(owners, "phrase_id")
             .groupBy(*at).agg(F.array_sort(F.collect_set("item")).alias("items")))
    return (document_rows(index).join(hit.join(named, at, "left"), at, "left")
            .select(F.col("__key").alias(key), "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
