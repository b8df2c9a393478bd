"""Registered queries of the text operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.llm import (byte_bpe, exact_dedup, language_id, line_quality, phrase_index,
                             ranked_search, secret_scan, simhash, source_mix, token_alignment,
                             token_shards, url_filter, warc)
from haulmetrics.llm.common import crc32_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: The rules that the query is asked to apply.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


ORACLES["op6_url_filter"] = r"""
WITH rules(v, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rest AS (SELECT page_id, row_number() OVER () AS rn,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (SELECT page_id, rn,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
found AS (SELECT parts.*, h || p AS rule, v,
    row_number() OVER (PARTITION BY rn ORDER BY length(h) DESC, length(p) DESC) AS k
  FROM parts LEFT JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM found WHERE k = 1
"""


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by key, are the snapshot; the others arrive."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents"), crc32_mod("doc_id", 2) == 0)


ORACLES["op8_exact_dedup"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
    count(*) OVER (PARTITION BY text) AS group_size, sha256(text) AS text_sha256 FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return secret_scan.digest_columns(found)


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, sf_dir, "documents"), source_mix.cycled([3, 1, 2]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(True))
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model, keep={"held_out": held_out})


@query
def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False))
    model = line_quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return line_quality.score(docs, model, keep={"doc_id": F.col("doc_id"),
                                                 "held_out": held_out}).withColumn(
        "predicted", (F.col("score") >= line_quality.THRESHOLD).cast("int"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLES["op7_warc"] = """
WITH t AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
    min(page_id) OVER (PARTITION BY html) AS first FROM t)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM g
"""


@query
def op4_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.round_trip(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary)


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.link_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(ranked_search.build_index(table(spark, sf_dir, "documents")),
                                table(spark, sf_dir, "benchmark"))


ORACLES["op13_ranked_search"] = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT item_id, row_number() OVER () AS q, unnest(list_distinct(regexp_extract_all(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
total AS (SELECT count(*) AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, floor(1000 * ln((2 * (SELECT n FROM total) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf GROUP BY term),
scored AS (SELECT q, item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90
      + (90 * len(terms) * (SELECT n FROM total)) // (SELECT l FROM total)))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN df USING (term) JOIN d USING (r) GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS k
  FROM scored WHERE score > 0)
SELECT item_id, k::INTEGER AS rank, doc_id, score FROM ranked WHERE k <= 10
"""
