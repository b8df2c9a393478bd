"""Cross-tokenizer alignment: groups of tokens of two vocabularies that cover the same bytes.

A is a byte-level vocabulary of the tokenizers library and encodes a blank and the text; B
is a sentencepiece model, which adds that blank itself. The ends of the tokens of each, in
bytes, are keys of a dictionary from end to index; where both have an end is the
intersection of the two key sets, and its sorted members slice both id lists into groups.
Links are all pairs of an A and a B token of one group, expanded group by group.

Tokens of both never go on after a blank (B's pieces are checked), so a chunk up to the
next single blank is a run of whole groups: the distinct chunks of a batch are aligned once
and gathered for their texts. The linked id pairs of a document are kept sorted, with how
often each is linked. How many documents hold a pair is counted over all rows, in
tasks first. The ``hot`` most frequent pairs are broadcast, which bounds them; a
document's other pairs, each rare, are joined to their counts by shuffle.

Null and empty texts, and texts whose tokens do not give back their bytes (B reads U+2581
as a blank), have no tokens: zeros, and an empty text of groups. Repeated rows count each
as a document. A text is read whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.chunks import Numbers, cut, gather
from haulmetrics.llm.common import map_batches, map_joined
from haulmetrics.session import stage

#: Text aligned at once; the larger, the more often its chunks repeat.
BATCH_BYTES = 6 << 20
#: Chunks and their pairs that a worker remembers before it starts anew.
MEMORY = 200_000
MEMORY_PAIRS = 3_000_000
#: Chunks sliced by one intersection, chunks encoded as one text, and links of a group
#: that are listed without counting first.
SLICE = 32_768
BLOCK = 256
SMALL = 1_024
#: Pairs whose counts are broadcast, 16 bytes each.
HOT_PAIRS = 2_000_000
#: Distinct pairs a task gathers before it hands their counts on.
PENDING = 1 << 21
BLANK = "▁"
LOW = (1 << 32) - 1


def byte_table() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable bytes of Latin-1 stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def align(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Groups of two lists of cumulative ends: how many tokens of each list stand before a
    group's end, and the ends."""
    index_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    ends = sorted(index_a.keys() & index_b.keys())
    return (np.array(list(map(index_a.__getitem__, ends)), np.int64),
            np.array(list(map(index_b.__getitem__, ends)), np.int64), ends)


def expand(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray,
           n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs (A id << 32 | B id) group by group, how often each is linked, and the
    number of pairs of each group.

    In a group of more than ``SMALL`` links repeated tokens are counted first, so its pairs
    grow with the distinct tokens.
    """
    start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    small = n_a * n_b <= SMALL
    sizes = np.where(small, n_a * n_b, 0)
    group = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pairs = (ids_a[start_a[group] + at // n_b[group]] << 32) | ids_b[start_b[group] + at % n_b[group]]
    times = np.ones(len(pairs), np.int64)
    if small.all():
        return pairs, times, sizes
    parts, counts, owners = [pairs], [times], [group]
    for g in np.flatnonzero(~small).tolist():
        a, times_a = np.unique(ids_a[start_a[g]:start_a[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(ids_b[start_b[g]:start_b[g] + n_b[g]], return_counts=True)
        parts.append(((a << 32)[:, None] | b).ravel())
        counts.append(np.outer(times_a, times_b).ravel())
        owners.append(np.full(len(parts[-1]), g))
        sizes[g] = len(parts[-1])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(parts)[order], np.concatenate(counts)[order], sizes


class Aligner:
    """Both tokenizers, and the chunks aligned lately."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        table = byte_table()
        self.bytes_a = {i: bytes(table[c] for c in entry) if all(c in table for c in entry)
                        else entry.encode() for entry, i in self.a.get_vocab(True).items()}
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if BLANK in piece.lstrip(BLANK):
                raise ValueError("a piece goes on after a blank")
            self.bytes_b.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i)
                                else piece.replace(BLANK, " ").encode())
        self.lengths_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.lengths_a[list(self.bytes_a)] = list(map(len, self.bytes_a.values()))
        self.lengths_b = np.array(list(map(len, self.bytes_b)), np.int64)
        # ids as text with what follows them: a comma inside, a bar after A, a semicolon after B
        self.text_a = [f"{i}{end}" for end in ",|" for i in range(len(self.lengths_a))]
        self.text_b = [f"{i}{end}" for end in ",;" for i in range(len(self.bytes_b))]
        self.forget()

    def forget(self) -> None:
        """Empty the columns of aligned chunks."""
        self.rows: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.texts: list[str] = []

    def _encode(self, blocks: list[list[str]]) -> list[tuple[list[str], list[int], list[int]]]:
        """Chunks, A ids and B ids of blocks whose tokens give back their bytes; blocks that
        do not are tried chunk by chunk, and such a chunk has no ids."""
        out, texts = [], [" ".join(block) for block in blocks]
        encoded = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        for block, text, found, b in zip(blocks, texts, encoded,
                                         self.b.encode(texts, num_threads=1)):
            a, wanted = found.ids, b" " + text.encode()
            if (b"".join(map(self.bytes_a.__getitem__, a)) == wanted
                    and b"".join(map(self.bytes_b.__getitem__, b)) == wanted):
                out.append((block, a, b))
            elif len(block) == 1:
                out.append((block, [], []))
            else:
                out += self._encode([[chunk] for chunk in block])
        return out

    def _align(self, chunks: list[str]) -> None:
        """Add the columns of new chunks."""
        # white space at an end would join the blank between chunks
        plain = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        kept = set(plain)
        blocks = [plain[i:i + BLOCK] for i in range(0, len(plain), BLOCK)]
        done = self._encode(blocks + [[c] for c in chunks if c not in kept])
        ids_a = np.fromiter(chain.from_iterable(a for _, a, _ in done), np.int64)
        ids_b = np.fromiter(chain.from_iterable(b for _, _, b in done), np.int64)
        names = [c for block, _, _ in done for c in block]
        good = np.array([bool(a) for block, a, _ in done for _ in block], bool)
        length = np.where(good, [len(c.encode()) + 1 for c in names], 0)

        stop_a, stop_b, ends = align(np.cumsum(self.lengths_a[ids_a]).tolist(),
                                     np.cumsum(self.lengths_b[ids_b]).tolist())
        n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        # a chunk ends with a group, so groups, tokens and links of chunks are differences
        upto = np.searchsorted(ends, np.cumsum(length), side="right")
        before = np.concatenate([[0], upto[:-1]])
        links = n_a * n_b
        totals = np.concatenate([[[0] * 4], np.cumsum(
            np.stack([n_a, n_b, np.ones_like(n_a), links], axis=1), axis=0)])
        pairs, times, sizes = expand(ids_a, ids_b, n_a, n_b)
        held = np.concatenate([[0], np.cumsum(sizes)])

        self.rows.update(zip(names, range(len(self.rows), len(self.rows) + len(names))))
        self.good = np.concatenate([self.good, good])
        self.counts = np.concatenate([self.counts, totals[upto] - totals[before]])
        self.sizes = np.concatenate([self.sizes, held[upto] - held[before]])
        self.pairs, self.times = (np.concatenate([self.pairs, pairs]),
                                  np.concatenate([self.times, times]))
        self.texts += self._texts(ids_a, ids_b, stop_a, stop_b, totals[before, :2].sum(axis=1),
                                  totals[upto, :2].sum(axis=1))

    def _texts(self, ids_a, ids_b, stop_a, stop_b, begin, end) -> list[str]:
        """Groups as text: of every group its A ids, then its B ids."""
        place = np.empty(len(ids_a) + len(ids_b), np.int64)
        n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[stop_a - 1], last_b[stop_b - 1] = 1, 1
        place[np.arange(len(ids_a)) + np.repeat(stop_b - n_b, n_a)] = (
            ids_a + last_a * len(self.lengths_a))
        place[np.arange(len(ids_b)) + np.repeat(stop_a, n_b)] = (
            ids_b + last_b * len(self.bytes_b) + len(self.text_a))
        words = list(map((self.text_a + self.text_b).__getitem__, place.tolist()))
        return ["".join(words[a:b])[:-1] for a, b in zip(begin.tolist(), end.tolist())]

    def rows_of(self, chunks: list[str]) -> np.ndarray:
        """Rows of the columns, one for each chunk."""
        if len(self.rows) > MEMORY or len(self.pairs) > MEMORY_PAIRS:
            self.forget()
        missed = [c for c in chunks if c not in self.rows]
        for at in range(0, len(missed), SLICE):
            self._align(missed[at:at + SLICE])
        return np.fromiter(map(self.rows.__getitem__, chunks), np.int64, len(chunks))


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(*paths: str) -> Aligner:
    if paths not in _aligners:
        _aligners.clear()
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def _batch(aligner: Aligner, texts: list[str | None]) -> tuple[list, list, list, list]:
    """For every text its four counts, its groups, and its sorted pairs with their times."""
    numbers = Numbers()
    codes = [np.array(list(map(numbers.__getitem__, cut(text or ""))), np.int64) for text in texts]
    rows = aligner.rows_of(list(numbers))
    sizes, groups = aligner.sizes, aligner.texts
    starts = np.cumsum(sizes) - sizes
    out = ([], [], [], [])
    for of in codes:
        of = rows[of]
        if not len(of) or not aligner.good[of].all():
            row = (0, 0, 0, 0), "", aligner.pairs[:0], aligner.times[:0]
        else:
            distinct, repeats = np.unique(of, return_counts=True)
            at = gather(distinct, starts, sizes)
            names, place = np.unique(aligner.pairs[at], return_inverse=True)
            total = np.bincount(place, aligner.times[at] * np.repeat(repeats, sizes[distinct]),
                                len(names)).astype(np.int64)
            row = (aligner.counts[of].sum(axis=0).tolist(),
                   ";".join([groups[i] for i in of.tolist()]), names, total)
        for column, value in zip(out, row):
            column.append(value)
    return out


def _pack(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pairs as differences, then the times."""
    return zstandard.compress(np.diff(pairs, prepend=0).tobytes() + times.astype("<u4").tobytes(), 1)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    n = len(raw) // 12
    return (np.cumsum(np.frombuffer(raw, np.int64, n)),
            np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64))


def _unpack_all(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of all rows, and how many each row has."""
    rows = [_unpack(v.as_py()) for v in column]
    return (np.concatenate([p for p, _ in rows]), np.concatenate([t for _, t in rows]),
            np.array([len(p) for p, _ in rows], np.int64))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def groups(docs: DataFrame, path_a: str, path_b: str, *, key: str = "doc_id",
           text: str = "text", digest: bool = False) -> DataFrame:
    """One row per row: key, n_a, n_b, n_groups, n_links, groups, __pairs.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, or its SHA-256 with ``digest``. ``__pairs`` are the
    document's distinct linked pairs, packed.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, texts, pairs, times = _batch(_aligner(path_a, path_b), batch["__text"].to_pylist())
        if digest:
            texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
        columns = [pa.array(c, pa.int64()) for c in zip(*counts)]
        return pa.RecordBatch.from_arrays(
            [batch["__key"], *columns, pa.array(texts, pa.string()),
             pa.array(map(_pack, pairs, times), pa.binary())],
            ["__key", *COUNTS, "groups", "__pairs"])

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return map_joined(rows, f"__key {kind}, n_a long, n_b long, n_groups long, n_links long, "
                            "groups string, __pairs binary", run, BATCH_BYTES)


def pair_counts(found: DataFrame) -> DataFrame:
    """``__pair`` and ``__n``, the number of documents that hold it linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            some = _unpack_all(batch["__pairs"])[0]
            names, place = np.unique(np.concatenate([pairs, some]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, np.ones(len(some), np.int64)]),
                                 len(names)).astype(np.int64)
            pairs = names
            if len(pairs) >= PENDING:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)],
                                                 ["__pair", "__n"])
                pairs, counts = pairs[:0], counts[:0]
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["__pair", "__n"])

    return (found.select("__pairs").mapInArrow(run, "__pair long, __n long")
            .groupBy("__pair").agg(F.sum("__n").alias("__n")))


def link_counts(docs: DataFrame, path_a: str, path_b: str, *, key: str = "doc_id",
                text: str = "text", digest: bool = False, hot: int = HOT_PAIRS) -> DataFrame:
    """One row per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A pair's count is the number of documents that hold it linked; ``n_best`` are the links
    whose count is the highest of their A id, ``count_sum`` is the sum over all links.
    """
    spark = docs.sparkSession
    found = stage(groups(docs, path_a, path_b, key=key, text=text, digest=digest)
                  .withColumn("__row", F.monotonically_increasing_id()), "token_groups")
    counted = stage(pair_counts(found), "pair_counts")
    best = counted.groupBy(F.shiftright("__pair", 32).alias("__a")).agg(F.max("__n").alias("__best"))
    top = best.toArrow()  # a row for each entry of A at most
    best_of = np.zeros(max(top["__a"].to_numpy().tolist(), default=-1) + 1, np.int64)
    best_of[top["__a"].to_numpy()] = top["__best"].to_numpy()
    every = counted.count() <= hot
    known = (counted if every else counted.orderBy(F.desc("__n"), "__pair").limit(hot)).toArrow()
    names, counts = (known[c].to_numpy().astype(np.int64) for c in ("__pair", "__n"))
    order = np.argsort(names)
    shared = spark.sparkContext.broadcast((best_of, names[order], counts[order]))

    def weigh(column: pa.Array) -> tuple[np.ndarray, ...]:
        """Row, pair, times and count (-1: not broadcast) of all pairs of a batch."""
        _, hot_pairs, hot_counts = shared.value
        pairs, times, sizes = _unpack_all(column)
        count = np.full(len(pairs), -1, np.int64)
        if len(hot_pairs):
            at = np.minimum(np.searchsorted(hot_pairs, pairs), len(hot_pairs) - 1)
            count = np.where(hot_pairs[at] == pairs, hot_counts[at], -1)
        return np.repeat(np.arange(len(sizes)), sizes), pairs, times, count

    def sums(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, pairs, times, count = weigh(batch["__pairs"])
        n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        is_best = (count >= 0) & (shared.value[0][pairs >> 32] == count)
        np.add.at(n_best, row[is_best], times[is_best])
        np.add.at(total, row, np.where(count >= 0, times * count, 0))
        return pa.RecordBatch.from_arrays(
            [*[batch[c] for c in names_out], pa.array(n_best), pa.array(total)],
            [*names_out, "n_best", "count_sum"])

    names_out = ["__key", "__row", *COUNTS, "groups"]
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"__key {kind}, __row long, " + "".join(f"{c} long, " for c in COUNTS)
              + "groups string, n_best long, count_sum long")
    summed = map_batches(found.select(*names_out, "__pairs"), schema, sums)
    if not every:
        def rare(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, pairs, times, count = weigh(batch["__pairs"])
            cold = count < 0
            return pa.RecordBatch.from_arrays(
                [batch["__row"].take(pa.array(row[cold])), pa.array(pairs[cold]),
                 pa.array(times[cold]), pa.array(shared.value[0][pairs[cold] >> 32])],
                ["__row", "__pair", "__times", "__best"])

        more = (map_batches(found.select("__row", "__pairs"),
                            "__row long, __pair long, __times long, __best long", rare)
                .join(counted, "__pair")
                .groupBy("__row")
                .agg(F.sum(F.when(F.col("__n") == F.col("__best"), F.col("__times")).otherwise(0))
                     .alias("__more_best"),
                     F.sum(F.col("__times") * F.col("__n")).alias("__more_sum")))
        summed = summed.join(more, "__row", "left").withColumns(
            {"n_best": F.col("n_best") + F.coalesce("__more_best", F.lit(0)),
             "count_sum": F.col("count_sum") + F.coalesce("__more_sum", F.lit(0))})
    return summed.select(F.col("__key").alias(key), *COUNTS, "n_best", "count_sum", "groups")
