"""Byte-level BPE against the tiktoken library, and the perfect hash by itself."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from haulmetrics.llm import byte_bpe
from tests.llm.conftest import rows_of

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def strings(n):
    draw = random.Random(4)
    signs = "ab  \n\t'sé½² \u0085\x1c 　👍12.,　中́the in"
    return ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(n)]


ODD = [None, "", " ", "  ", "   a", "a   ", "'s 't 'LL", "<|endoftext|>", "\x00", "\n\n x", "a" * 5000]


@pytest.mark.parametrize("size", [0, 1, 2, 3, 1000])
def test_perfect_hash(size):
    keys = [b"key%d" % i for i in range(size)]
    made = byte_bpe.PerfectHash(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(size))
    assert [made.slot(k) for k in keys] == made.slots(keys).tolist()


def test_perfect_hash_needs_distinct_keys():
    with pytest.raises(ValueError):
        byte_bpe.PerfectHash([b"a", b"a"])


def test_every_entry_is_itself(vocabulary):
    entries = [(i, t) for i, t in enumerate(vocabulary.tokens) if t is not None]
    assert len(entries) == vocabulary.hash.size == 50_256
    assert vocabulary.ids_of([t for _, t in entries]) == [i for i, _ in entries]
    assert vocabulary.ids_of([b"no such entry", b""]) == [-1, -1]


def test_encoder_equals_library(vocabulary, library):
    texts = strings(3000) + ODD
    for whole in (vocabulary, byte_bpe.Vocabulary(
            {t: i for i, t in enumerate(vocabulary.tokens)}, vocabulary.pattern, chunked=False)):
        ids, counts = byte_bpe.Encoder(whole).encode(texts)
        ends = np.cumsum(counts)
        for text, end, n in zip(texts, ends, counts):
            assert ids[end - n:end].tolist() == library.encode_ordinary(text or ""), repr(text)


def test_forgetting_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMORY", 3)
    monkeypatch.setattr(byte_bpe, "PAIRS", 5)
    encoder = byte_bpe.Encoder(vocabulary)
    for _ in range(2):
        ids, _ = encoder.encode(strings(200))
        assert ids.tolist() == [i for t in strings(200) for i in library.encode_ordinary(t)]


def test_long_word(vocabulary, library):
    """A word of a megabyte: the heap keeps it near linear."""
    word = "abc" * 300_000
    ids, counts = byte_bpe.Encoder(vocabulary).encode([word])
    assert byte_bpe.decode_ids(vocabulary.tokens, ids.tolist()) == word.encode()
    short, _ = byte_bpe.Encoder(vocabulary).encode([word[:3000]])
    assert short.tolist() == library.encode_ordinary(word[:3000])


def test_lacking_byte(vocabulary):
    small = byte_bpe.Vocabulary({b"a": 0, b"b": 1, b"ab": 2}, vocabulary.pattern)
    assert byte_bpe.Encoder(small).encode(["abab", "ba"])[0].tolist() == [2, 2, 1, 0]
    with pytest.raises(ValueError):
        byte_bpe.Encoder(small).encode(["abc"])


def test_round_trip(make_docs, vocabulary, library):
    texts = strings(60) + ODD
    rows = list(enumerate(texts)) + [(None, "no key"), (3, "same key"), (3, "same key")]
    docs = make_docs(rows)
    got = rows_of(byte_bpe.round_trip(docs, vocabulary))
    assert got == sorted([(k, *expected(library, t)) for k, t in rows], key=str)
    encoded = byte_bpe.encode(docs, vocabulary)
    assert encoded.columns == ["doc_id", "ids"]
    decoded = byte_bpe.decode(encoded, vocabulary)
    assert sorted((str(k), bytes(b)) for k, b in decoded.collect()) == \
        sorted((str(k), (t or "").encode()) for k, t in rows)


def test_empty_table(make_docs, vocabulary):
    assert byte_bpe.round_trip(make_docs([(1, "a")]).limit(0), vocabulary).collect() == []


def test_unknown_id(vocabulary):
    with pytest.raises(ValueError):
        byte_bpe.decode_ids(vocabulary.tokens, [50_256])


def test_given_documents(prepared, sf_dir, library):
    from haulmetrics.llm.queries import QUERIES
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_byte_bpe"](prepared, sf_dir).collect()}
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == {k: expected(library, t) for k, t in docs}
