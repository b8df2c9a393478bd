"""Token shards: documents as token ids, compressed by Re-Pair grammars.

Documents are dealt out by ranges of their key, sorted, encoded and written as shards of
about ``SHARD_IDS`` ids in ascending order; a document is never cut. A shard is a row of
a Parquet table with

* ``keys`` and ``ends``: the documents and where their ids end, counted in the shard,
* ``left`` and ``right``: the rules, each a pair of symbols that a nonterminal stands for,
* ``lengths``: how many ids each rule expands to,
* ``sequence``: the symbols of the shard.

Symbols below ``terminals`` are ids. Re-Pair replaces frequent pairs by nonterminals
again and again. A round takes the most frequent pairs whose left symbols are not right
symbols of another, so that no two occurrences overlap, or all pairs of one symbol with
itself; rounds end when no pair is frequent or a round of the first sort saves less than
one symbol in ``LEAST_GAIN``. With the expansion lengths any range of ids is decoded without the rest.

Words are encoded once and kept in a bounded cache of the worker. That is exact, because
the vocabulary's rules never look across white space; texts that hold a special token's
string are encoded whole.

Null texts count as empty and are the end id alone. Null keys come first. Rows that repeat
a key are ordered by a hash of the text. An empty table gives no shards.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmetrics.session import new_path

END_ID = 2
SHARD_IDS = 1 << 20
LEAST_COUNT = 16
LEAST_GAIN = 100
PAIRS_PER_ROUND = 4096
CACHE_WORDS = 300_000
SEPARATOR = "\x1e"
WORDS_AT_ONCE = 64
#: Letters up to U+00FF, each its own normal form, and ASCII signs behind them but no
#: apostrophe, which may start a piece that holds letters.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-^`{-~]*)")


class WordEncoder:
    """Ids of texts as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.mark = self._ids(SEPARATOR)
        # the vocabulary's spelling of the bytes of letters beyond ASCII
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {ord(c): spell.pre_tokenize_str(c)[0][0]
                         for c in map(chr, range(0xC0, 0x100)) if c.isalpha()}

    def _ids(self, text: str) -> np.ndarray:
        # a batch of one is encoded without offsets, which is faster
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4")

    def encode(self, text: str) -> bytes:
        lower = text.lower()
        if any(s in text or s.lower() in lower for s in self.special):
            return self._ids(text).tobytes()
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        found = list(map(self.cache.get, words))
        if None in found:
            if len(self.cache) > CACHE_WORDS:  # the words in use come back from the older ones
                self.older, self.cache = self.cache, {}
                found = [None] * len(words)
            self._add({w for w, ids in zip(words, found) if ids is None})
            found = map(self.cache.__getitem__, words)
        return b"".join(found)

    def _add(self, words: set[str]) -> None:
        cache, older, rest = self.cache, self.older, []
        for word in words:
            ids = older.get(word)
            if ids is not None:
                cache[word] = ids
            elif m := PLAIN.fullmatch(word):
                cache[word] = self._letters(m[1].lower()) + self._tail(m[2])
            elif SEPARATOR in word or len(self.mark) != 1 or not word:
                cache[word] = self._ids(word).tobytes()
            else:
                rest.append(word)
        for start in range(0, len(rest), WORDS_AT_ONCE):
            part = rest[start:start + WORDS_AT_ONCE]
            ids = self._ids(f" {SEPARATOR} ".join(part))
            cuts = [-1, *np.flatnonzero(ids == self.mark[0]).tolist(), len(ids)]
            for word, a, b in zip(part, cuts, cuts[1:]):
                cache[word] = ids[a + 1:b].tobytes()

    def _letters(self, core: str) -> bytes:
        """A run of lower-case letters is one piece, which the model takes as it is."""
        ids = self.cache.get(core)
        if ids is None:
            ids = self.older.get(core)
        if ids is None:
            piece = core if core.isascii() else core.translate(self.spelling)
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()
        self.cache[core] = ids
        return ids

    def _tail(self, tail: str) -> bytes:
        if not tail:
            return b""
        ids = self.cache.get(tail)
        if ids is None:
            ids = self.cache[tail] = self._ids(tail).tobytes()
        return ids


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class Grammar:
    """Re-Pair: rules, expansion lengths and the remaining sequence."""

    def __init__(self, terminals: int, left, right, lengths, sequence):
        self.terminals = terminals
        self.left, self.right, self.lengths, self.sequence = left, right, lengths, sequence

    @classmethod
    def build(cls, ids: np.ndarray, least_count: int = LEAST_COUNT,
              least_gain: int = LEAST_GAIN) -> Grammar:
        # dense numbers for the ids that occur, so that a pair mostly fits 32 bits
        present = np.zeros(int(ids.max(initial=0)) + 1, bool)
        present[ids] = True
        alphabet = np.flatnonzero(present)
        seq = (np.cumsum(present, dtype=np.uint32) - 1)[ids]
        left, right, symbols = [], [], len(alphabet)
        while len(seq) > 1:
            kind = np.uint32 if symbols < 1 << 16 else np.uint64
            seq = seq.astype(kind, copy=False)
            keys = seq[:-1] * kind(symbols)
            keys += seq[1:]
            pairs, counts = _frequent(keys, least_count)
            if not len(pairs):
                break
            often = np.argsort(-counts, kind="stable")[:PAIRS_PER_ROUND]
            a, b = np.divmod(pairs[often], kind(symbols))
            chosen = cls._disjoint(a, b)
            wanted = np.sort(pairs[often][chosen])
            a, b = np.divmod(wanted, kind(symbols))
            is_left, is_right = np.full(symbols, False), np.full(symbols, False)
            is_left[a], is_right[b] = True, True
            at = np.flatnonzero(is_left[seq[:-1]] & is_right[seq[1:]])
            rule = np.minimum(np.searchsorted(wanted, keys[at]), len(wanted) - 1)
            hit = wanted[rule] == keys[at]
            at, rule = at[hit], rule[hit]
            repeated = a[0] == b[0]
            if repeated:  # runs of one symbol: every other place
                fresh = np.concatenate([[True], np.diff(at) > 1])
                first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                even = (np.arange(len(at)) - first) % 2 == 0
                at, rule = at[even], rule[even]
            seq[at] = symbols + rule
            keep = np.ones(len(seq), bool)
            keep[at + 1] = False
            enough = len(at) * least_gain >= len(seq)
            seq = seq[keep]
            left.append(a.astype(np.int64))
            right.append(b.astype(np.int64))
            symbols += len(wanted)
            if not enough and not repeated:
                break
        none = np.zeros(0, np.int64)
        terminals = len(present)
        name = np.concatenate([alphabet, terminals + np.arange(symbols - len(alphabet))])
        left, right = (name[np.concatenate([none, *x])] for x in (left, right))
        lengths = [1] * terminals
        for x, y in zip(left.tolist(), right.tolist()):
            lengths.append(lengths[x] + lengths[y])
        return cls(terminals, left, right, np.array(lengths[terminals:], np.int64), name[seq])

    @staticmethod
    def _disjoint(a: np.ndarray, b: np.ndarray) -> list[int]:
        """Positions of pairs, most frequent first, of which no two can overlap."""
        if a[0] == b[0]:
            return np.flatnonzero(a == b).tolist()
        lefts, rights, chosen = set(), set(), []
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            if x != y and x not in rights and y not in lefts:
                lefts.add(x)
                rights.add(y)
                chosen.append(i)
        return chosen

    def _dictionary(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each symbol expands to: ids, where a symbol's begin, and how many."""
        lengths = np.concatenate([np.ones(self.terminals, np.int64), self.lengths])
        ids = np.arange(self.terminals, self.terminals + len(self.left))
        while (rule := ids >= self.terminals).any():
            width = np.where(rule, 2, 1)
            place = np.cumsum(width) - width
            wider = np.empty(int(width.sum()), np.int64)
            wider[place[~rule]] = ids[~rule]
            which = ids[rule] - self.terminals
            wider[place[rule]], wider[place[rule] + 1] = self.left[which], self.right[which]
            ids = wider
        ids = np.concatenate([np.arange(self.terminals), ids])
        return ids, np.cumsum(lengths) - lengths, lengths

    def expand(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` to ``stop``; other symbols are not expanded."""
        ids, begins, lengths = self._dictionary()
        ends = np.cumsum(lengths[self.sequence])
        total = int(ends[-1]) if len(ends) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return np.zeros(0, np.int64)
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(ends, stop, side="left"))
        symbols, ends = self.sequence[first:last + 1], ends[first:last + 1]
        width = lengths[symbols]
        offset = int(ends[0] - width[0])
        at = np.repeat(begins[symbols] - (ends - width - offset), width)
        at += np.arange(len(at))
        return ids[at][start - offset:stop - offset]


def _frequent(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that occur ``least`` times or more, in order, and how often."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(starts, len(keys)))
    often = counts >= least
    return keys[starts[often]], counts[often]


def _pack(values: np.ndarray) -> bytes:
    top = int(values.max(initial=0))
    kind = next(k for k in ("<u2", "<u4", "<u8") if top <= np.iinfo(k).max)
    return kind[2:].encode() + zstandard.compress(values.astype(kind).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data[1:]), f"<u{data[:1].decode()}").astype(np.int64)


NUMBERS = ["left", "right", "lengths", "sequence", "ends"]


def write_shards(docs: DataFrame, path: str, vocabulary: str, *, key: str = "doc_id",
                 text: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode all documents and write the shards under ``path``."""
    kind = docs.schema[key].dataType.simpleString()
    rows = (docs.select(F.col(key).alias("__key"), F.coalesce(text, F.lit("")).alias("__text"))
            .withColumn("__draw", F.xxhash64("__text"))
            .repartitionByRange("__key", "__draw").sortWithinPartitions("__key", "__draw"))
    key_type = rows.limit(0).toArrow().schema.field("__key").type

    def shard(number: int, keys: list, ids: list[bytes]) -> pa.RecordBatch:
        flat = np.frombuffer(b"".join(ids), "<u4")
        grammar = Grammar.build(flat)
        ends = np.cumsum([len(i) // 4 for i in ids])
        made = [grammar.left, grammar.right, grammar.lengths, grammar.sequence, ends]
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([number], pa.int32()),
             pa.array([keys], pa.list_(key_type)), pa.array([len(flat)], pa.int64()),
             pa.array([grammar.terminals], pa.int32()),
             *[pa.array([_pack(v)], pa.binary()) for v in made]],
            ["part", "number", "keys", "n_ids", "terminals", *NUMBERS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes()
        number, size, keys, ids = 0, 0, [], []
        for batch in batches:
            for k, value in zip(batch["__key"].to_pylist(), batch["__text"]):
                keys.append(k)
                ids.append(encode(value.as_py()) + end)
                size += len(ids[-1]) // 4
                if size >= shard_ids:
                    yield shard(number, keys, ids)
                    number, size, keys, ids = number + 1, 0, [], []
        if keys:
            yield shard(number, keys, ids)

    schema = (f"part int, number int, keys array<{kind}>, n_ids long, terminals int, "
              + ", ".join(f"{n} binary" for n in NUMBERS))
    rows.mapInArrow(run, schema).write.parquet(path)


def with_base(shards: DataFrame) -> DataFrame:
    """Add ``base``, the ids of all shards before; counted by part first, so that the
    window without a key holds one row per writing task."""
    sizes = shards.select("part", "number", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("__n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__part"))
    inside = (Window.partitionBy("part").orderBy("number")
              .rowsBetween(Window.unboundedPreceding, -1))
    bases = (sizes.withColumn("__in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
             .join(parts, "part")
             .select("part", "number", (F.col("__part") + F.col("__in")).alias("base")))
    return shards.join(bases, ["part", "number"])


def read_documents(spark: SparkSession, path: str, *, key: str = "doc_id",
                   ids: bool = False) -> DataFrame:
    """Key, start, n_tokens, ids_crc32 and, where asked for, the ids of every document."""
    shards = with_base(spark.read.parquet(path))
    kind = shards.schema["keys"].dataType.elementType.simpleString()
    names = ["__key", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch[n][i].as_py() for n in ["base", "terminals", *NUMBERS]}
                packed = [_unpack(row[n]) for n in NUMBERS]
                flat = Grammar(row["terminals"], *packed[:4]).expand().astype("<u4")
                ends = packed[4]
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [batch["keys"].slice(i, 1).flatten(), pa.array(starts + row["base"]),
                           pa.array(ends - starts), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.array([flat[a:b] for a, b in zip(starts, ends)],
                                            pa.list_(pa.uint32())).cast(pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"__key {kind}, start long, n_tokens long, ids_crc32 long"
    return (shards.select("base", "terminals", "keys", *NUMBERS)
            .mapInArrow(run, schema + (", ids array<bigint>" if ids else ""))
            .withColumnRenamed("__key", key))


def round_trip(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text",
               shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards of ``docs`` to the shared folder and read the documents back."""
    path = new_path(docs.sparkSession, "token_shards")
    write_shards(docs, path, vocabulary, key=key, text=text, shard_ids=shard_ids)
    return read_documents(docs.sparkSession, path, key=key)
