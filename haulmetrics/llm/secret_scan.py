"""Secret scan: patterns, and random strings found by their token efficiency.

Prose takes three to five characters per token of a byte-level BPE vocabulary, random
strings about one and a half. Runs of key characters that hold letters are therefore
encoded, and those with few characters per token are reported as ``dense``,
unless they overlap a pattern's span, are a known digest, have the shape of a digest or
UUID (without a key word in front they identify content, not secrets; the ``hex``
pattern has them anyway), or are an identifier whose words have many characters per token.

Null texts count as empty. Each row is scanned for itself, so repeated rows repeat.
Offsets are code points, ends exclusive. Whole texts are scanned, one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.common import map_batches

#: The patterns and least lengths that the scan is asked to apply.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
#: Runs of hex digits; the look-behind only saves tries inside shorter runs.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "dense")

KEYWORDS = ("passw", "secret", "token", "api")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}"
                    r"|[0-9a-f]{128}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})")
#: Words in snake, kebab, camel or path form, each with at most four digits behind it. All
#: repeats are possessive, so a run is read once.
IDENTIFIER = re.compile(r"(?:[+/_=-]*+(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[A-Za-z](?=[+/_=-]|$))"
                        r"[0-9]{0,4}+(?![0-9]))++[+/_=-]*+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Random base64 has about 1.4 characters a token, words of any language over 2.
MAX_CHARS_PER_TOKEN = 1.85


@cache
def encoding(path: str):
    """The tiktoken vocabulary at ``path``, loaded once in each worker."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, in order of start and kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def _is_dense(texts: list[str], vocabulary: str, max_ratio: float) -> bool:
    """Whether the texts together have fewer than ``max_ratio`` characters a token."""
    encode = encoding(vocabulary).encode_ordinary
    return sum(map(len, texts)) < max_ratio * sum(len(encode(t)) for t in texts)


def dense_spans(text: str, taken: list[tuple[int, int, str]], vocabulary: str,
                known: frozenset[str], max_ratio: float) -> list[tuple[int, int, str]]:
    """Spans of random strings that overlap none of ``taken``, which is in order of start."""
    found, at, upto = [], 0, 0
    for m in CANDIDATE.finditer(text):
        run = m.group()
        # runs and spans are both in order, so each span is passed once
        while at < len(taken) and taken[at][0] < m.end():
            upto = max(upto, taken[at][1])
            at += 1
        if (upto > m.start() or not re.search("[A-Za-z]", run)
                or run in known or DIGEST.fullmatch(run)
                or not _is_dense([run], vocabulary, max_ratio)):
            continue
        if not IDENTIFIER.fullmatch(run) or _is_dense(WORD.findall(run), vocabulary, max_ratio):
            found.append((m.start(), m.end(), "dense"))
    return found


def _joined(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text",
         known_digests: Iterable[str] = (),
         max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per document: its key and spans, an array of (start, end, kind)."""
    kind = docs.schema[key].dataType.simpleString()
    known = frozenset(known_digests)
    struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                 ("kind", pa.string())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = []
        for value in batch["__text"]:
            value = value.as_py() or ""
            base = pattern_spans(value)
            spans.append(sorted(base + dense_spans(value, base, vocabulary, known,
                                                   max_chars_per_token), key=_order))
        rows = [[{"start": a, "end": b, "kind": k} for a, b, k in s] for s in spans]
        return pa.RecordBatch.from_arrays([batch["__key"], pa.array(rows, struct)],
                                          ["__key", "spans"])

    return (map_batches(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")),
                        f"__key {kind}, spans array<struct<start:bigint,end:bigint,kind:string>>",
                        run).withColumnRenamed("__key", key))


def digest_columns(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per pattern, a digest of the pattern spans, and all spans as text."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "dense")
    return found.select(key, *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
