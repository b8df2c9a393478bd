import random

import numpy as np
import pytest
import xxhash

from haulmetrics.llm import simhash

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_fingerprint(text, shingle=3):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    n = max(1, len(words) - shingle + 1)
    shingles = [" ".join(words[i:i + shingle]) for i in range(n)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(values, distance):
    """Smallest position that the links of each value reach."""
    root = list(range(len(values)))
    for _ in values:
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= distance:
                    root[i] = min(root[i], root[j])
    return root


TEXTS = [None, "", " \n\t ", "one", "One", "one two", "a b c", "A B C", "a b c d", "É b c", "é b c",
         "x y z", "same " * 5000, "w " * 40_000 + "end", "\x1f a \x0b b"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 1000)
    assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(text, 5) == brute_fingerprint(text, 5)


def flipped(value, bits, draw):
    for b in draw.sample(range(64), bits):
        value ^= 1 << b
    return value


@pytest.mark.parametrize("case", [
    {"leaf": 8, "sample": 400}, {"leaf": 4096, "sample": 65536}, {"leaf": 16, "sample": 20},
    {"leaf": 32, "sample": 400, "distance": 4}])
def test_links_of_chains_and_dense_groups(prepared, case):
    draw = random.Random(5)
    values = [draw.getrandbits(64) for _ in range(150)] + [0, 2 ** 64 - 1]
    chain = [draw.getrandbits(64)]
    for _ in range(60):
        chain.append(flipped(chain[-1], 2, draw))
    center = draw.getrandbits(64)
    values += chain + [flipped(center, draw.randint(0, 2), draw) for _ in range(120)]
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    distinct = prepared.createDataFrame([(v,) for v in signed], "__fp long").repartition(3)
    links = simhash.links(distinct, **case)
    assert links.count() <= 40 * len(values)
    found = {r["__fp"]: r["__root"] for r in simhash.components(links).collect()}
    root = brute_components(values, case.get("distance", 2))
    groups = {}
    for v, r in zip(signed, root):
        groups.setdefault(r, set()).add(found.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_rows(make_docs):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(i + 10, t) for i, t in enumerate(TEXTS)] + [
        (3, long), (7, long.upper()), (7, long), (2, long + " tail"), (None, long), (None, "alone here")]
    found = simhash.near_duplicates(make_docs(rows)).collect()
    assert len(found) == len(rows)
    prints = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(prints, 2)
    least = {}
    for (key, _), r in zip(rows, root):
        least.setdefault(r, []).append(key)
    expected = [(key, f"{p:016x}", min((k for k in least[r] if k is not None), default=None))
                for (key, _), p, r in zip(rows, prints, root)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
