"""Alignment of two tokenizers against whole-text encoding and all pairs by brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from haulmetrics.llm import token_alignment
from tests.llm.conftest import rows_of

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def brute_groups(library, text):
    """Groups of (A ids, B ids), from the tokens of the whole text."""
    if not text:
        return []
    a, b = library
    table = token_alignment.byte_table()
    wanted = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i)
               else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
        return []
    owner_a = [i for i, t in enumerate(bytes_a) for _ in t]
    owner_b = [i for i, t in enumerate(bytes_b) for _ in t]
    groups, start_a, start_b = [], 0, 0
    for at in range(len(wanted)):
        last = at + 1 == len(wanted)
        if last or (owner_a[at] != owner_a[at + 1] and owner_b[at] != owner_b[at + 1]):
            groups.append((ids_a[start_a:owner_a[at] + 1], ids_b[start_b:owner_b[at] + 1]))
            start_a, start_b = owner_a[at] + 1, owner_b[at] + 1
    return groups


def brute(library, rows):
    every = [brute_groups(library, text) for _, text in rows]
    links = [[(x, y) for a, b in groups for x in a for y in b] for groups in every]
    count = Counter(pair for found in links for pair in set(found))
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (key, _), groups, found in zip(rows, every, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                    len(found), sum(count[p] == best[p[0]] for p in found),
                    sum(count[p] for p in found), text))
    return sorted(out, key=str)


def digested(rows):
    return sorted([(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "")
                   for r in rows], key=str)


def strings(n):
    draw = random.Random(6)
    signs = ["a", "b", " ", " ", "  ", "\n", "\t", "é", "½", "the", " in", "ing", "👍", "中", "12",
             ".", ",", "́", "====", " ", "'s"]
    return ["".join(draw.choices(signs, k=draw.randint(0, 30))) for _ in range(n)]


ODD = [None, "", " ", "   ", "a▁b", "<s>x</s><|endoftext|>", "<0x41>", "\x00x", "\r\n", "ﬁ½Ａ",
       " a", "a ", "=" * 700, "ab" * 2000]


def test_align():
    a, b, ends = token_alignment.align([2, 3, 7], [1, 3, 5, 7])
    assert (a.tolist(), b.tolist(), ends) == ([2, 3], [2, 4], [3, 7])
    assert [len(x) for x in token_alignment.align([], [])] == [0, 0, 0]


@pytest.mark.parametrize("small", [0, 3, 1000])
def test_expand(monkeypatch, small):
    monkeypatch.setattr(token_alignment, "SMALL", small)
    groups = [([5, 5, 6], [7, 8, 7]), ([1], [2]), ([5] * 50 + [6], [7] * 40), ([3], [4, 4])]
    a, b = (np.array([i for g in groups for i in g[side]]) for side in (0, 1))
    pairs, times, sizes = token_alignment.expand(
        a, b, np.array([len(g[0]) for g in groups]), np.array([len(g[1]) for g in groups]))
    ends = np.cumsum(sizes)
    for (x, y), end, n in zip(groups, ends, sizes):
        got = Counter()
        for pair, t in zip(pairs[end - n:end].tolist(), times[end - n:end].tolist()):
            got[pair] += t
        assert got == Counter(i << 32 | j for i in x for j in y)


@pytest.mark.parametrize("hot", [0, 5, 1000, token_alignment.HOT_PAIRS])
def test_counts(make_docs, library, hot):
    texts = strings(80) + ODD
    rows = list(enumerate(texts)) + [(None, "no key"), (3, "same key"), (3, "same key"), (4, "same key")]
    docs = make_docs(rows)
    expected = brute(library, rows)
    assert rows_of(token_alignment.link_counts(docs, *PATHS, hot=hot)) == expected
    assert rows_of(token_alignment.link_counts(docs, *PATHS, hot=hot, digest=True)) == \
        digested(expected)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_alignment, "MEMORY", 2)
    monkeypatch.setattr(token_alignment, "SLICE", 7)
    monkeypatch.setattr(token_alignment, "BLOCK", 3)
    rows = list(enumerate(strings(40)))
    aligner = token_alignment.Aligner(*PATHS)
    for _ in range(2):
        found = token_alignment._batch(aligner, [t for _, t in rows])
        assert found[1] == [b[-1] for b in sorted(brute(library, rows))]
        known = token_alignment._batch(aligner, [t for _, t in rows[:3]])
        assert known[1] == found[1][:3]


def test_empty_table(make_docs):
    none = make_docs([(1, "a")]).limit(0)
    assert token_alignment.link_counts(none, *PATHS).collect() == []
    assert token_alignment.link_counts(make_docs([(1, None), (2, "")]), *PATHS).select(
        "n_a", "n_links", "groups").distinct().collect() == [(0, 0, "")]


def test_given_documents(prepared, sf_dir, library):
    from haulmetrics.llm.queries import QUERIES
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = QUERIES["op12_token_alignment"](prepared, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    assert rows_of(got) == digested(brute(library, rows))
