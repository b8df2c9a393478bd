import random
import re
from fractions import Fraction

import pytest

from haulmetrics.llm import source_mix


def highest_quotients(weights, seats, limits):
    got = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if got[i] < limits[i] and weights[i]]
        if not open_:
            break
        best = max(open_, key=lambda i: (Fraction(weights[i]) / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


@pytest.mark.parametrize("case", range(40))
def test_apportionment(case):
    draw = random.Random(case)
    weights = [draw.choice([0, 1, 3, 7, 50, 400]) for _ in range(draw.randint(1, 9))]
    limits = [draw.choice([0, 2, 30, 1000]) for _ in weights]
    seats = draw.randint(0, 120)
    if not sum(weights):
        weights[0] = 1
    assert (source_mix.sainte_lague(weights, seats, limits)
            == highest_quotients(weights, seats, limits))


def test_targets():
    got = source_mix.capped_targets([100, 10, 0, 1000], [3, 1, 2, 3], 1.5, 2.0)
    assert got[1:3] == [20, 0] and got[0] == 200 and abs(sum(got) - 1665) < 1e-9
    assert source_mix.capped_targets([], [], 1.5, 2.0) == []
    assert source_mix.capped_targets([0, 0], [3, 1], 1.5, 2.0) == [0, 0]


def brute_sizes(rows):
    sizes = {}
    for key, text, _, source in rows:
        sizes.setdefault(source, []).append((key, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    return sizes


@pytest.mark.parametrize("shard_words", [1 << 19, 300])
def test_mix(make_docs, shard_words, monkeypatch):
    monkeypatch.setattr(source_mix, "GROUP_SHARDS", 4)
    draw = random.Random(3)
    rows = [(i, " ".join(["wörd x"] * draw.randint(0, 90)), "en",
             draw.choice(["hot", "hot", "hot", "a", "ä", "B", None])) for i in range(400)]
    rows += [(9000, None, "en", "a"), (9001, "", "en", None), (9002, " \t\n", "en", "empty"),
             (9003, "one two", "en", "tiny"), (5, "x y z", "en", "hot"), (5, "x y z", "en", "hot"),
             (9004, "w " * 20_000, "en", "B"), (None, "no key here", "en", "a")]
    weigh = source_mix.cycled([3, 1, 2])
    found = source_mix.mix(make_docs(rows), weigh, shard_words=shard_words)
    again = source_mix.mix(make_docs(rows, 7), weigh, shard_words=shard_words)
    got = found.collect()
    assert sorted(got, key=str) == sorted(again.collect(), key=str)
    sizes = brute_sizes(rows)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    words = [sum(n for _, n in sizes[s]) for s in names]
    targets = source_mix.capped_targets(words, weigh(names), 1.5, 2.0)
    assert len(got) == len(rows)
    for name, size, target in zip(names, words, targets):
        own = [r for r in got if r.source == name]
        assert (sorted(((r.doc_id, r["size"]) for r in own), key=str)
                == sorted(sizes[name], key=str))
        assert all(r.source_size == size and abs(r.target - target) < 1e-6 for r in own)
        assert all(0 <= r.taken <= 2 * r["size"] for r in own)
        shards = 1 + size // shard_words
        assert abs(sum(r.taken for r in own) - target) <= 2 * source_mix.BLOCK_WORDS * (shards + 1)


def test_empty_table(make_docs):
    assert source_mix.mix(make_docs([]), source_mix.cycled([1])).collect() == []


@pytest.mark.parametrize("n", [7, 150])
def test_sources_beyond_the_drivers_bound(make_docs, monkeypatch, n):
    monkeypatch.setattr(source_mix, "MAX_SOURCES", 5)
    monkeypatch.setattr(source_mix, "GROUP_SOURCES", 16)
    draw = random.Random(n)
    sources = [None, "", "z", "ä", "🙂", *[f"s{i}" for i in range(n)]]
    rows = [(i, " ".join(["w"] * draw.randint(0, 60)), "en",
             draw.choice(["s1", draw.choice(sources)])) for i in range(900)]
    weigh = source_mix.cycled([3, 1, 2])
    got = source_mix.mix(make_docs(rows), weigh).collect()
    assert sorted(got, key=str) == sorted(source_mix.mix(make_docs(rows, 7), weigh).collect(),
                                          key=str)
    sizes = brute_sizes(rows)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    words = [sum(k for _, k in sizes[s]) for s in names]
    targets = source_mix.capped_targets(words, weigh(names), 1.5, 2.0)
    assert len(got) == len(rows)
    assert (sorted(((r.source, r.doc_id, r["size"]) for r in got), key=str)
            == sorted(((s, *r) for s in sizes for r in sizes[s]), key=str))
    for name, size, target in zip(names, words, targets):
        own = [r for r in got if r.source == name]
        assert all(r.source_size == size and abs(r.target - target) < 1e-6 for r in own)
        assert all(0 <= r.taken <= 2 * r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 4 * source_mix.BLOCK_WORDS


def test_no_shard_above_its_bound(make_docs, monkeypatch):
    """Rows without words, rows without keys and equal rows are many shards, too."""
    monkeypatch.setattr(source_mix, "SHARD_ROWS", 100)
    monkeypatch.setattr(source_mix, "COPIES", 8)
    staged = {}
    real = source_mix.stage

    def keep(df, name):
        staged[name] = real(df, name)
        return staged[name]

    monkeypatch.setattr(source_mix, "stage", keep)
    rows = ([(i, None, "en", "wordless") for i in range(1000)]
            + [(None, f"text {i}", "en", "keyless") for i in range(1000)]
            + [(None, "one and the same", "en", "equal")] * 1000)
    got = source_mix.mix(make_docs(rows), source_mix.cycled([3, 1, 2])).collect()
    assert len(got) == len(rows)
    sizes = staged["dealt"].groupBy("__source", "__shard").sum("__n").collect()
    assert len(sizes) > 20 and max(r[2] for r in sizes) <= 250
    for name in ("keyless", "equal", "wordless"):
        own = [r for r in got if r.source == name]
        assert {r.source_size for r in own} == {sum(r["size"] for r in own)} and len(own) == 1000
        assert abs(sum(r.taken for r in own) - own[0].target) <= 32 * 12
        assert all(0 <= r.taken <= 2 * r["size"] for r in own)
