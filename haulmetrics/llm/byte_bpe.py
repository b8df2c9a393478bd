"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, others by merges from a heap.

A text is split into pre-tokens by the vocabulary's pattern. Tier one looks every distinct
pre-token of a batch up in a minimal perfect hash over the vocabulary (a displacement for
each bucket of keys, as many slots as entries) and compares the bytes of the slot. What is
no entry goes to tier two: its bytes are linked nodes, a heap holds the pairs that are an
entry when joined, and the lowest rank, leftmost first, is merged until none is left. Both
give the ids of the reference rule: an entry is itself, else the lowest rank first.

The hash is built once on the driver and broadcast, its size being that of the vocabulary.
Pre-tokens are found in the distinct blank-separated chunks of a batch; a pattern whose
matches may go on after a blank needs ``chunked=False``.

Null texts count as empty and have no ids. Each row is encoded for itself, so repeated rows
repeat. A text is encoded whole: tier two takes time in n log n and about 100 bytes a byte
of the longest pre-token. Decoding gives the bytes; ids outside the vocabulary are an error.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.chunks import Numbers, Recent, distinct_chunks, gather
from haulmetrics.llm.common import map_batches, map_joined

MASK = (1 << 64) - 1
#: Text encoded at once; the larger, the more often its chunks repeat.
BATCH_BYTES = 16 << 20
#: Remembered pre-tokens of tier two in each of two generations, and the longest of them.
MEMORY = 250_000
MEMORY_BYTES = 64
#: Remembered pairs of neighbours.
PAIRS = 1_000_000
#: Longer words have their nodes in arrays instead of lists.
SHORT = 4_096
PLACE, LOW = (1 << 40) - 1, (1 << 32) - 1
#: Constants of the splitmix64 finaliser.
MIX_A, MIX_B, STEP = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def _mix(value: int) -> int:
    value = ((value ^ (value >> 30)) * MIX_A) & MASK
    value = ((value ^ (value >> 27)) * MIX_B) & MASK
    return value ^ (value >> 31)


def _mix_all(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX_A)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX_B)
    return values ^ (values >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct keys: each has a slot of its own below their number.

    Buckets of several keys get the first displacement that sends all of them to free
    slots, the fullest buckets first; a bucket of one key names its slot (as ``-1 - slot``).
    Any other key has a slot too, so the caller compares keys.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        for self.seed in range(64):
            hashes = [xxhash.xxh3_64_intdigest(key, self.seed) for key in keys]
            if len(set(hashes)) == len(keys):
                break
        else:
            raise ValueError("keys are not distinct")
        buckets: dict[int, list[int]] = {}
        for value in hashes:
            buckets.setdefault(value % self.size, []).append(value)
        self.shift = np.zeros(max(self.size, 1), np.int64)
        used = bytearray(self.size)
        single = []
        for bucket, members in sorted(buckets.items(), key=lambda b: (-len(b[1]), b[0])):
            if len(members) == 1:
                single.append(bucket)
                continue
            shift = 0
            while True:
                shift += 1
                slots = {_mix((m + shift * STEP) & MASK) % self.size for m in members}
                if len(slots) == len(members) and not any(used[s] for s in slots):
                    break
            self.shift[bucket] = shift
            for slot in slots:
                used[slot] = 1
        free = [slot for slot in range(self.size) if not used[slot]]
        for bucket, slot in zip(single, free):
            self.shift[bucket] = -1 - slot

    def slots(self, keys: list[bytes]) -> np.ndarray:
        if not self.size:
            return np.zeros(len(keys), np.int64)
        digest, seed = xxhash.xxh3_64_intdigest, self.seed
        hashes = np.array([digest(key, seed) for key in keys], np.uint64)
        shift = self.shift[(hashes % np.uint64(self.size)).astype(np.int64)]
        moved = _mix_all(hashes + shift.astype(np.uint64) * np.uint64(STEP))
        return np.where(shift < 0, -1 - shift, (moved % np.uint64(self.size)).astype(np.int64))

    def slot(self, key: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(key, self.seed)
        shift = int(self.shift[value % self.size])
        return -1 - shift if shift < 0 else _mix((value + shift * STEP) & MASK) % self.size


class Vocabulary:
    """Entries by id, and their ids through the perfect hash."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, chunked: bool = True):
        self.pattern, self.chunked = pattern, chunked
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for entry, rank in ranks.items():
            self.tokens[rank] = entry
        self.hash = PerfectHash(list(ranks))
        self.ids = np.zeros(max(len(ranks), 1), np.int64)
        self.ids[self.hash.slots(list(ranks))] = list(ranks.values())

    def ids_of(self, keys: list[bytes]) -> list[int]:
        """Tier one: the id of each key that is an entry, else -1."""
        found = self.ids[self.hash.slots(keys)].tolist() if self.hash.size else [-1] * len(keys)
        tokens = self.tokens
        return [i if i >= 0 and tokens[i] == key else -1 for i, key in zip(found, keys)]

    def id_of(self, key: bytes) -> int:
        if not self.hash.size:
            return -1
        found = int(self.ids[self.hash.slot(key)])
        return found if self.tokens[found] == key else -1


def load(path: str, pattern: str | None = None) -> Vocabulary:
    """A rank file: a line for each entry, in base64, and its rank."""
    import public_tokenizers
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, lines)}
    return Vocabulary(ranks, pattern or public_tokenizers.PATTERN)


class Encoder:
    """Encodes batches of texts with one vocabulary; remembers what it merged lately."""

    def __init__(self, vocabulary: Vocabulary):
        import regex
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.single = vocabulary.ids_of([bytes([b]) for b in range(256)])
        self.lacking = min(self.single) < 0
        self.after, self.before = list(range(1, SHORT + 1)), list(range(-1, SHORT - 1))
        #: Ids of all pairs of bytes, and those of pairs of entries met so far.
        self.two = np.array(vocabulary.ids_of([bytes([a, b]) for a in range(256)
                                               for b in range(256)]), np.int64)
        self.pairs: dict[int, int] = {}
        self.merged = Recent(MEMORY)

    def _pair(self, key: int) -> int:
        """Id of two neighbours joined, or -1; ``key`` holds both ids."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        tokens = self.vocabulary.tokens
        found = self.pairs[key] = self.vocabulary.id_of(tokens[key >> 32] + tokens[key & LOW])
        return found

    def merge(self, word: bytes, valid: list[int] | None = None) -> tuple[int, ...]:
        """Tier two: nodes of linked bytes, merged by rank from a heap.

        An entry of the heap is the rank of a pair and the place of its left node; it
        counts only while it is the node's ``valid`` one (-1: none).
        """
        if valid is None:
            valid = self._first_pairs([word])[0]
        n = len(word)
        if n <= SHORT:
            ids = list(map(self.single.__getitem__, word))
            after, before = self.after[:n], self.before[:n]
        else:
            ids = array("q", map(self.single.__getitem__, word))
            after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        if self.lacking and min(ids, default=0) < 0:
            raise ValueError("the vocabulary lacks a byte")
        heap = [entry for entry in valid if entry >= 0]
        heapify(heap)
        pairs = self.pairs
        while heap:
            top = heappop(heap)
            at = top & PLACE
            if valid[at] != top:
                continue
            rank, right = top >> 40, after[at]
            ids[at], ids[right], valid[at], valid[right] = rank, -1, -1, -1
            right = after[at] = after[right]
            if right < n:
                before[right] = at
                key = rank << 32 | ids[right]
                found = pairs.get(key)
                if found is None:
                    found = self._pair(key)
                if found >= 0:
                    valid[at] = entry = found << 40 | at
                    heappush(heap, entry)
            left = before[at]
            if left >= 0:
                key = ids[left] << 32 | rank
                found = pairs.get(key)
                if found is None:
                    found = self._pair(key)
                valid[left] = -1
                if found >= 0:
                    valid[left] = entry = found << 40 | left
                    heappush(heap, entry)
        return tuple([i for i in ids if i >= 0])

    def _first_pairs(self, words: list[bytes]) -> list[list[int]]:
        """For every word and byte the entry of the byte and its neighbour, or -1."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        ranks = np.full(len(data), -1, np.int64)
        ranks[:-1] = self.two[data[:-1] << 8 | data[1:]]
        ranks[ends - 1] = -1  # the last byte of a word has no neighbour
        place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
        entries = np.where(ranks >= 0, ranks << 40 | place, -1).tolist()
        stops = ends.tolist()
        return [entries[a:b] for a, b in zip([0, *stops], stops)]

    def _words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct pre-tokens."""
        keys = [word.encode() for word in words]
        get, put = self.merged.get, self.merged.put
        out = [(whole,) if whole >= 0 else get(key)
               for key, whole in zip(keys, self.vocabulary.ids_of(keys))]
        missed = [i for i, found in enumerate(out) if found is None]
        if missed:
            for i, pairs in zip(missed, self._first_pairs([keys[i] for i in missed])):
                found = out[i] = self.merge(keys[i], pairs)
                if len(keys[i]) <= MEMORY_BYTES:
                    put(keys[i], found)
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if self.vocabulary.chunked:
            rest, heads, codes = distinct_chunks(texts)
            found = chain((" " + chunk for chunk in rest), heads)
        else:
            found = [text or "" for text in texts]
            codes = [np.array([i]) for i in range(len(texts))]
        numbers, words, ends = Numbers(), [], []
        for chunk in found:
            words += map(numbers.__getitem__, self.find(chunk))
            ends.append(len(words))
        word_ids = self._words(list(numbers))
        # ids of words, then of chunks, then of texts
        sizes = np.fromiter(map(len, word_ids), np.int64, len(word_ids))
        ids = np.fromiter(chain.from_iterable(word_ids), np.int32, int(sizes.sum()))
        words = np.array(words, np.int64)
        chunk_ids = ids[gather(words, np.cumsum(sizes) - sizes, sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes[words])])[[0, *ends]]
        lengths = np.diff(upto)
        counts = np.array([lengths[c].sum() for c in codes], np.int64)
        every = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        return chunk_ids[gather(every, upto[:-1], lengths)], counts


def decode_ids(tokens: list[bytes | None], ids: list[int]) -> bytes:
    if ids and (min(ids) < 0 or max(ids) >= len(tokens)):
        raise ValueError("an id is outside the vocabulary")
    return b"".join(map(tokens.__getitem__, ids))


_latest: list[Encoder] = []


def _encoder(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary, with what it remembers."""
    if not _latest or _latest[0].vocabulary is not shared.value:
        _latest[:] = [Encoder(shared.value)]
    return _latest[0]


def encode(docs: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per row: key, ids."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the vocabulary's size

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = _encoder(shared).encode(batch["__text"].to_pylist())
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch["__key"], pa.ListArray.from_arrays(ends, pa.array(ids))], ["__key", "ids"])

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return (map_joined(rows, f"__key {kind}, ids array<int>", run, BATCH_BYTES)
            .withColumnRenamed("__key", key))


def decode(encoded: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id",
           ids: str = "ids") -> DataFrame:
    """One row per row: key, bytes. Null ids give null."""
    kind = encoded.schema[key].dataType.simpleString()
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [None if row is None else decode_ids(shared.value, row)
                 for row in batch["__ids"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["__key"], pa.array(found, pa.binary())],
                                          ["__key", "bytes"])

    rows = encoded.select(F.col(key).alias("__key"), F.col(ids).alias("__ids"))
    return map_batches(rows, f"__key {kind}, bytes binary", run).withColumnRenamed("__key", key)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Encode and decode in one pass: key, n_tokens, ids_sha256, decoded_sha256."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def sha256(data) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = _encoder(shared).encode(batch["__text"].to_pylist())
        ends = np.cumsum(counts)
        each = [ids[end - n:end] for end, n in zip(ends.tolist(), counts.tolist())]
        return pa.RecordBatch.from_arrays(
            [batch["__key"], pa.array(counts),
             pa.array([sha256(np.ascontiguousarray(i, "<u4")) for i in each], pa.string()),
             pa.array([sha256(decode_ids(shared.value.tokens, i.tolist())) for i in each],
                      pa.string())],
            ["__key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    schema = f"__key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_joined(rows, schema, run, BATCH_BYTES).withColumnRenamed("__key", key)
