import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from haulmetrics.llm import token_shards
from haulmetrics.session import new_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [None, "", " ", "Hello, world.", "it's they'll 's x's", "a.b,c.. .", "naïve café ́x",
         "İSTANBUL ΣΑΣ ßtraße", "tab\tnew\nline\rcr\x0bvt\x0cff\x1cfs\x1dgs nb ls　id",
         "<|endoftext|> plain <|startoftext|>x", "x<|ENDOFTEXT|>y", "\x1e sep \x1e\x1e a\x1eb",
         "😀👍🏽 мир 你好 １２３", "123 a1b2 1.5,2", "w." * 3000, "퟿ \x00 \x7f", "A" * 5000,
         "the " * 20_000]


@pytest.mark.parametrize("text", TEXTS)
def test_encoding_is_the_librarys(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    made = token_shards.WordEncoder(VOCABULARY)
    for _ in range(2):  # with an empty and with a filled cache
        assert (np.frombuffer(made.encode(text or ""), "<u4").tolist()
                == tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("ids", [
    [], [5], [5, 5], [1] * 1000, [1, 2] * 500, [1, 2, 3] * 300 + [2, 1] * 50,
    [7, 7, 8] * 200 + [7] * 33, list(range(500))])
def test_grammar_round_trip(ids):
    made = token_shards.Grammar.build(np.array(ids, np.int64), 4)
    assert made.expand().tolist() == ids
    lengths = made.lengths.tolist()
    for i, (a, b) in enumerate(zip(made.left, made.right)):
        size = [1 if s < made.terminals else lengths[s - made.terminals] for s in (a, b)]
        assert lengths[i] == sum(size)
    draw = random.Random(1)
    for _ in range(20):
        a, b = sorted(draw.choices(range(len(ids) + 2), k=2))
        assert made.expand(a, b).tolist() == ids[a:b]
    if len(set(ids)) < 9 and len(ids) > 500:
        assert len(made.sequence) < len(ids) / 4


def test_grammar_of_random_ids():
    draw = np.random.default_rng(0)
    ids = np.minimum(draw.geometric(0.1, 50_000), 60)
    made = token_shards.Grammar.build(ids)
    assert (made.expand() == ids).all() and len(made.sequence) < 40_000


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_round_trip(make_docs, prepared, shard_ids):
    rows = [(k, t) for k, t in zip([5, 3, 9, 1, 1000, -4, 77, 8, 2, 6, 11, 12, 13, 14, 15, 16, 17, 18],
                                   TEXTS)] + [(3, "again"), (3, "again"), (None, "no key")]
    path = new_path(prepared, "shards")
    token_shards.write_shards(make_docs(rows), path, VOCABULARY, shard_ids=shard_ids)
    got = sorted(token_shards.read_documents(prepared, path, ids=True).collect(),
                 key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = {}
    for key, text in rows:
        made = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        ids.setdefault(key, []).append(made)
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert sorted(keys, key=str) == sorted([k for k, _ in rows], key=str)
    start = 0
    for r in got:
        assert r.ids in ids[r.doc_id]
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += len(r.ids)
    if shard_ids == 50:
        assert prepared.read.parquet(path).count() > 5


def test_empty_table(make_docs):
    assert token_shards.round_trip(make_docs([]), VOCABULARY).collect() == []
