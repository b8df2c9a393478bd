"""SimHash near-duplicates: fingerprints in a distributed vantage-point tree.

A fingerprint has one bit for each of 64 positions, set if over half the hashes of the
text's word shingles have it. Documents whose fingerprints differ in at most
``distance`` bits are linked, and components of links are groups of near-duplicates.

Fingerprints are folded to distinct ones first. A vantage-point tree is fitted on a
bounded sample of them (the ``SAMPLE`` that hash lowest): each node has a vantage point
and the median Hamming distance to it as its radius. Every distinct fingerprint is
indexed in the leaf it falls in. As a query it visits each leaf it can have partners in:
by the triangle inequality a child is pruned if the distance to the vantage point misses
the child's side of the radius by more than ``distance``. Leaves are numbered, and a
query only visits leaves from its own on, since a partner in an earlier leaf visits this
one. The points and the queries of a leaf are cut into blocks of about ``LEAF``, and each
pair of blocks is a group of its own, so that no task grows with a dense leaf.

A group searches its points through a vantage-point tree of their own, compares what is
left in slices and gives back a spanning forest of the links, never all pairs. The
forests are joined to components by passing minima along the links, each round a staged
table.

Null texts count as empty; texts without words have fingerprint zero and link like any
other. Rows that repeat are rows of one group. The group's name is its smallest key; null
keys only name a group of nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.common import map_batches
from haulmetrics.session import stage

SEED = 42
SHINGLE = 3
DISTANCE = 2
SAMPLE = 65_536
LEAF = 65_536
LOCAL_LEAF = 1_024
SLICE = 1 << 22
CHUNK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of the lower-cased words' shingles; repeats count."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        some = words[start:min(n, start + CHUNK) + shingle - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(w) + 1 for w in some])
        begins = np.concatenate([[0], ends[:-1]])
        k = max(1, len(some) - shingle + 1)
        stops = ends[-k:] - 1
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in
                           zip(begins[:k].tolist(), stops.tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    over = np.packbits(counts * 2 > n, bitorder="little")
    return int(over.view("<u8")[0])


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``__key`` and ``__fp`` (the 64 bits as a signed long) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(v.as_py(), shingle) for v in batch["__text"]], np.uint64)
        return pa.RecordBatch.from_arrays([batch["__key"], pa.array(found.view(np.int64))],
                                          ["__key", "__fp"])

    return map_batches(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")),
                       f"__key {kind}, __fp long", run)


class VantageTree:
    """Vantage points and radii of the inner nodes; leaves are numbered left to right."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.nodes: list[tuple[np.uint64, int, int, int]] = []  # point, radius, near, far
        self.leaves = 0
        self.root = self._grow(np.unique(sample), leaves, np.random.default_rng(SEED))

    def _grow(self, points: np.ndarray, leaves: int, draw) -> int:
        """Node number, or -1 - leaf number."""
        if leaves > 1 and len(points) >= 4:
            vantage = points[draw.integers(len(points))]
            away = np.bitwise_count(points ^ vantage)
            radius = int(np.median(away))
            if (away > radius).sum() == 0:
                radius = int(away.max()) - 1
            near = away <= radius
            if near.any() and not near.all():
                at = len(self.nodes)
                self.nodes.append((vantage, radius, 0, 0))
                left = self._grow(points[near], (leaves + 1) // 2, draw)
                right = self._grow(points[~near], leaves // 2, draw)
                self.nodes[at] = (vantage, radius, left, right)
                return at
        self.leaves += 1
        return -self.leaves

    def visits(self, points: np.ndarray, slack: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, positions of points that reach it); ``slack`` 0 gives the own leaf."""
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if node < 0:
                yield -1 - node, at
                continue
            vantage, radius, near, far = self.nodes[node]
            away = np.bitwise_count(points[at] ^ vantage).astype(np.int64)
            stack.append((near, at[away - slack <= radius]))
            stack.append((far, at[away + slack > radius]))


def _forest(points: np.ndarray, queries: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between queries and points, as (value, smaller value).

    A vantage-point tree of the points prunes; in its leaves all pairs are compared.
    """
    values = np.unique(np.concatenate([points, queries]))
    parent = np.arange(len(values))
    tree = VantageTree(points, -(-len(points) // LOCAL_LEAF)) if len(points) else None
    own = dict(tree.visits(points, 0)) if tree else {}
    for number, reach in tree.visits(queries, distance) if tree else ():
        if number in own:
            near, far = points[own[number]], queries[reach]
            step = max(1, SLICE // len(near))
            for start in range(0, len(far), step):
                _link(parent, values, near, far[start:start + step], distance)
    top = _roots(parent, np.arange(len(values)))
    linked = np.flatnonzero(top != np.arange(len(values)))
    return list(zip(values[linked].view(np.int64).tolist(),
                    values[top[linked]].view(np.int64).tolist()))


def _link(parent: np.ndarray, values: np.ndarray, points: np.ndarray, queries: np.ndarray,
          distance: int) -> None:
    """Join the trees of ``parent`` along the links of two small sets."""
    rows, cols = np.nonzero(np.bitwise_count(queries[:, None] ^ points[None, :]) <= distance)
    a, b = np.searchsorted(values, queries[rows]), np.searchsorted(values, points[cols])
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    up = parent[at]
    while True:
        higher = parent[up]
        if (higher == up).all():
            return up
        up = higher


def links(distinct: DataFrame, *, distance: int = DISTANCE, sample: int = SAMPLE,
          leaf: int = LEAF) -> DataFrame:
    """A forest of links (``__a``, ``__b``) that connects what ``__fp`` values within
    ``distance`` bits connect."""
    total = distinct.count()
    drawn = distinct.orderBy(F.xxhash64("__fp"), "__fp").limit(sample).toArrow()
    points = drawn["__fp"].to_numpy().astype(np.int64).view(np.uint64)
    tree = VantageTree(points, min(-(-total // (leaf // 2)), max(1, sample // 8)))
    shared = distinct.sparkSession.sparkContext.broadcast(tree)  # sample / 8 nodes at most

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _joined(batches):
            home = np.zeros(len(values), np.int32)
            for number, at in shared.value.visits(values, 0):
                home[at] = number
            for number, at in shared.value.visits(values, distance):
                at = at[home[at] <= number]
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values[at].view(np.int64)),
                         pa.array(np.full(len(at), number, np.int32)),
                         pa.array(home[at] == number)], ["__fp", "__leaf", "__point"])

    visits = stage(distinct.select("__fp").mapInArrow(visit, "__fp long, __leaf int, "
                                                             "__point boolean"), "visits")
    sizes = visits.groupBy("__leaf").agg(F.count("*").alias("__queries"),
                                         F.count_if("__point").alias("__points"))
    blocks = {r[0]: (-(-r[1] // leaf), -(-r[2] // leaf)) for r in sizes.collect()}
    held = distinct.sparkSession.sparkContext.broadcast(blocks)  # two numbers a leaf

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query to all blocks of points and each point to all blocks of queries."""
        for batch in batches:
            values, number = batch["__fp"].to_numpy(), batch["__leaf"].to_numpy()
            point = batch["__point"].to_numpy(zero_copy_only=False)
            for leaf_ in np.unique(number):
                queries, points = held.value[int(leaf_)]
                own = number == leaf_
                query_block = _block(values[own], queries)
                point_block = _block(values[own], max(points, 1))
                for block in range(points):
                    yield _dealt(values[own], leaf_, query_block, block, False)
                chosen = point[own]
                for block in range(queries):
                    yield _dealt(values[own][chosen], leaf_, block, point_block[chosen], True)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf["__fp"].to_numpy().view(np.uint64)
        own = pdf["__point"].to_numpy()
        found = _forest(values[own], values[~own], distance)
        return pd.DataFrame(found, columns=["__a", "__b"], dtype="int64")

    return (visits.mapInArrow(deal, "__fp long, __leaf int, __qblock int, __pblock int, "
                                    "__point boolean")
            .groupBy("__leaf", "__qblock", "__pblock")
            .applyInPandas(compare, "__a long, __b long"))


def _joined(batches: Iterator[pa.RecordBatch], rows: int = 1 << 18) -> Iterator[np.ndarray]:
    """Fingerprints of several batches at once, so that a tree is walked less often."""
    some, n = [], 0
    for batch in batches:
        some.append(batch["__fp"].to_numpy())
        n += batch.num_rows
        if n >= rows:
            yield np.concatenate(some).view(np.uint64)
            some, n = [], 0
    if n:
        yield np.concatenate(some).view(np.uint64)


def _dealt(values, leaf, query_block, point_block, point: bool) -> pa.RecordBatch:
    n = len(values)
    columns = [np.full(n, leaf, np.int32), np.broadcast_to(query_block, n).astype(np.int32),
               np.broadcast_to(point_block, n).astype(np.int32), np.full(n, point)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in [values, *columns]],
                                      ["__fp", "__leaf", "__qblock", "__pblock", "__point"])


def _block(values: np.ndarray, blocks: int) -> np.ndarray:
    mixed = (values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.uint64(blocks)).astype(np.int32)


def components(edges: DataFrame) -> DataFrame:
    """``__fp`` and ``__root``, the smallest value its links reach, of all linked values.

    Each round gives a value the smallest of its neighbours and links those neighbours
    to it; then values follow their parent's parent. Both shorten all paths.
    """
    edges = stage(edges.select(F.greatest("__a", "__b").alias("__a"),
                               F.least("__a", "__b").alias("__b")).distinct(), "links")
    while True:
        # a value with several smaller neighbours links them to the smallest one
        small = edges.groupBy("__a").agg(F.min("__b").alias("__m"), F.count("*").alias("__n"))
        small = stage(small, "minima")
        if small.where("__n > 1").isEmpty():
            break
        several = edges.join(small.where("__n > 1"), "__a").where("__b <> __m")
        edges = stage(small.select("__a", F.col("__m").alias("__b"))
                      .unionByName(several.select(F.col("__b").alias("__a"),
                                                  F.col("__m").alias("__b"))).distinct(), "links")
    tree = small.select("__a", F.col("__m").alias("__b"))
    while True:
        # one parent each by now: jump to the parent's parent
        upper = tree.select(F.col("__a").alias("__b"), F.col("__b").alias("__c"))
        jumped = stage(tree.join(upper, "__b", "left")
                       .select("__a", F.coalesce("__c", "__b").alias("__b"),
                               F.col("__c").isNotNull().alias("__moved")), "parents")
        tree = jumped.drop("__moved")
        if jumped.where("__moved").isEmpty():
            break
    return (tree.select(F.col("__a").alias("__fp"), F.col("__b").alias("__root"))
            .unionByName(tree.select(F.col("__b").alias("__fp"),
                                     F.col("__b").alias("__root")).distinct()))


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE, sample: int = SAMPLE,
                    leaf: int = LEAF) -> DataFrame:
    """One row per row: key, fingerprint (16 hex digits), component_id."""
    rows = stage(fingerprints(docs, key=key, text=text, shingle=shingle), "fingerprints")
    distinct = stage(rows.groupBy("__fp").agg(F.min("__key").alias("__least")), "distinct")
    found = stage(components(links(distinct, distance=distance, sample=sample, leaf=leaf)),
                  "components")
    named = distinct.join(found, "__fp", "left")
    named = named.withColumn("__root", F.coalesce("__root", "__fp"))
    least = named.groupBy("__root").agg(F.min("__least").alias("__component"))
    named = stage(named.select("__fp", "__root").join(least, "__root")
                  .select("__fp", "__component"), "named")
    return rows.join(named, "__fp").select(
        F.col("__key").alias(key), F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"),
        F.col("__component").alias("component_id"))
