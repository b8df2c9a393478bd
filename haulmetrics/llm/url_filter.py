"""URL filter: a trie over reversed host labels and path segments.

A rule is (verdict, host, path). It fits its host and all subdomains of it if the
path of the url starts with the rule's path. Of the rules that fit, the one with the
longest host wins, then the one with the longest path; block wins where an allow and
a block entry are the same. Urls that no rule fits get the default verdict.

Null urls and urls without ``://`` have an empty host and path, and so the default
verdict. Repeated rows are judged each for itself; other columns are ignored.

The trie is broadcast, as rule lists are configuration that the caller holds in memory;
its size is checked. Lists beyond ``MAX_BROADCAST_BYTES`` are a table, and
``judge_by_join`` takes that: distinct urls are joined by host suffix, nothing is
broadcast by this module.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.common import map_batches

MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_VERDICT = "allow"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


class UrlTrie:
    """Host labels from the last to the first, then path segments.

    The last piece of a rule's path may be part of a segment (``/en/1`` fits
    ``/en/17``), so it is kept at the node of the segments before it.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        size = 0
        for rule in rules:
            size += len(rule.host.encode()) + len(rule.path.encode()) + 16
            if size > MAX_BROADCAST_BYTES:
                raise ValueError("rules beyond the broadcast bound: use judge_by_join")
            self._add(rule)

    def _add(self, rule: Rule) -> None:
        node = self.root
        for label in reversed(rule.host.split(".")):
            node = node.setdefault("labels", {}).setdefault(label, {})
        node = node.setdefault("paths", {})
        *whole, part = rule.path.split("/")
        for segment in whole:
            node = node.setdefault("segments", {}).setdefault(segment, {})
        ends = node.setdefault("ends", {})
        if part not in ends or rule.verdict == "block":
            ends[part] = rule
        node["lengths"] = sorted({*map(len, ends)}, reverse=True)

    @staticmethod
    def _longest_path(node: dict, segments: list[str]) -> Rule | None:
        best = None
        for at, segment in enumerate(segments):
            # only the lengths that the node's entries have
            for stop in node.get("lengths", ()):
                found = node["ends"].get(segment[:stop]) if stop <= len(segment) else None
                if found:
                    best = found
                    break
            if at + 1 == len(segments):
                break
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best

    def match(self, host: str, path: str) -> Rule | None:
        """The rule that decides, or None."""
        node, segments, best = self.root, path.split("/"), None
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "paths" in node:
                best = self._longest_path(node["paths"], segments) or best
        return best


def url_parts(url: Column | str) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path of a url; empty where there is none."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]], *, key: str = "page_id",
          url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: key, host, path, rule (or null) and verdict."""
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(Rule(*r) for r in rules))
    host, path = url_parts(url)
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    kind = parts.schema[key].dataType.simpleString()

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [trie.value.match(h, p) for h, p in zip(batch["host"].to_pylist(),
                                                        batch["path"].to_pylist())]
        return pa.RecordBatch.from_arrays(
            [batch[key], batch["host"], batch["path"],
             pa.array([r and r.name for r in found], pa.string()),
             pa.array([r.verdict if r else default for r in found], pa.string())],
            [key, "host", "path", "rule", "verdict"])

    return map_batches(parts, f"`{key}` {kind}, host string, path string, rule string, "
                              "verdict string", decide)


def judge_by_join(pages: DataFrame, rules: DataFrame, *, key: str = "page_id",
                  url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """The same as ``judge`` for a rule table (verdict, host, path) of any size."""
    host, path = url_parts(url)
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, -i, i), "."))
    entries = rules.select(F.col("host").alias("__suffix"), F.col("path").alias("__path"),
                           F.col("verdict").alias("__verdict"))
    rank = F.struct(F.length("__suffix"), F.length("__path"), F.col("__verdict"))
    best = (parts.select("host", "path").distinct()
            .withColumn("__suffix", F.explode(suffixes))
            .join(entries, "__suffix")
            .where(F.startswith("path", F.col("__path")))
            .groupBy("host", "path")
            .agg(F.max_by(F.concat("__suffix", "__path"), rank).alias("rule"),
                 F.max_by("__verdict", rank).alias("__found")))
    return (parts.join(best, ["host", "path"], "left")
            .select(key, "host", "path", "rule",
                    F.coalesce("__found", F.lit(default)).alias("verdict")))
