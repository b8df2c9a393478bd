"""WARC archives: written with Spark, read back by verified record boundaries.

Writing: a record is a header block and a payload, and Spark's text writer ends each
with the two line breaks that end a WARC record, so archives are gzip files on any file
system that Spark writes to. Of records with equal payloads of ``min_bytes`` or more, the
one with the smallest key is the response and the others are revisits that name it;
smaller payloads are always responses. Rows that repeat the smallest key as well are all
responses.

Reading, boundary-chain verification: the version line is the delimiter of the text
reader, so each piece is a candidate record, be it a real one or magic inside a payload.
Tasks emit for every candidate its length and the offset of its successor, which is where
its Content-Length says that it ends. In each file pointers then jump from the file's
start, twice as far each round, and only candidates reached are records; the pieces of
a payload that holds the magic are put together again. What is behind a broken record
cannot be reached and is left out.

Only these few numbers of a candidate are grouped by file, so a task holds a file's
candidates, some 40 bytes each. A record without magic inside is hashed by the task that
reads it; bytes are only shuffled for the others, or where payloads are asked for.

Null payloads count as empty. Null keys and urls are left out of the header and read back
as null. Line breaks in a url are percent-encoded in the header. An empty table gives an
archive without records.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.session import new_path, stage

MAGIC = "WARC/1.1\r\n"
BREAK = "\r\n"
END = "\r\n\r\n"
MIN_BYTES = 100
ROWS_PER_FILE = 50_000
KEY_URN = "urn:page:"


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))


def with_revisits(pages: DataFrame, *, key: str, payload: str,
                  min_bytes: int = MIN_BYTES) -> DataFrame:
    """Key, payload, digest, size and the key of the response that a page revisits."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumns({"__body": body, "__digest": F.sha2(body, 256),
                              "__size": F.octet_length(body).cast("bigint")})
    first = stage(rows.where(F.col("__size") >= min_bytes).groupBy("__digest")
                  .agg(F.min(key).alias("__first"), F.count("*").alias("__n"))
                  .where("__n > 1").drop("__n"), "first_captures")
    joined = rows.join(first, "__digest", "left")
    return joined.withColumn("__refers", F.when(~F.col(key).eqNullSafe(F.col("__first")),
                                                F.col("__first")))


def write_archives(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url",
                   payload: str = "html", min_bytes: int = MIN_BYTES) -> None:
    """Write one record per row as gzip WARC files under ``path``."""
    rows = with_revisits(pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"),
                                      F.col(payload).alias("__payload")),
                         key="__key", payload="__payload", min_bytes=min_bytes)
    revisit = F.col("__refers").isNotNull()
    uri = F.replace(F.replace("__url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    urn = {c: F.concat(F.lit(KEY_URN), F.col(c).cast("string")) for c in ("__key", "__refers")}
    record = F.concat(
        F.lit(MAGIC), _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", urn["__key"]), _header("WARC-Target-URI", uri),
        _header("WARC-Refers-To", urn["__refers"]),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "__digest")),
        _header("WARC-Payload-Length", F.col("__size").cast("string")),
        _header("Content-Length", F.when(revisit, "0").otherwise(F.col("__size").cast("string"))),
        F.lit(BREAK), F.when(revisit, "").otherwise(F.col("__body")))
    (rows.select(record.alias("value")).write
     .option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", ROWS_PER_FILE).text(path))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece between two version lines, in its place in the file."""
    pieces = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")
    # the header block ends at the first empty line; offsets are octets
    head = F.substring_index("value", END, 1)
    return pieces.withColumns({
        "length": F.octet_length("value").cast("bigint"),
        "head": head,
        "body_at": F.octet_length(head).cast("bigint") + len(END),
        "content": F.expr(r"try_cast(regexp_extract(concat('\r\n', head), "
                          r"'(?i)\r\nContent-Length:[ \t]*([0-9]+)', 1) AS bigint)")})


def _reach(pdf: pd.DataFrame) -> pd.DataFrame:
    """Mark the pieces of one file with the record they belong to, or null."""
    pdf = pdf.sort_values(["block", "seq"], ignore_index=True)
    n, magic = len(pdf), len(MAGIC)
    # the first piece stands before the first version line; the others follow one each
    ends = np.cumsum(pdf["length"].to_numpy() + magic) - magic
    starts = ends - pdf["length"].to_numpy() - magic
    content, body_at = pdf["content"].to_numpy(), pdf["body_at"].to_numpy()
    valid = ~np.isnan(content.astype(float)) & (np.arange(n) > 0)
    goal = np.where(valid, starts + magic + body_at
                    + np.nan_to_num(content.astype(float)).astype(np.int64) + len(END), -1)
    at = np.minimum(np.searchsorted(starts, goal), n - 1)
    done = n  # the end of the file; itself its successor
    lost = n + 1
    jump = np.full(n + 2, lost)
    jump[done] = done
    exact = valid & (starts[at] == goal) & (goal > starts)
    jump[:n][exact] = at[exact]
    jump[:n][valid & (goal == ends[-1])] = done
    reached = np.zeros(n + 2, bool)
    if n > 1 and starts[1] == 0:
        reached[1] = True
    # after round k the first 2^k records are marked, and pointers jump 2^k records
    while True:
        more = reached.copy()
        more[jump[reached]] = True
        jump = jump[jump]
        if (more == reached).all():
            break
        reached = more
    sound = reached[:n] & (goal >= 0) & (exact | (goal == ends[-1]))
    record = np.where(sound, np.arange(n), -1)
    record = np.maximum.accumulate(record)
    goal_of = np.where(record >= 0, goal[np.maximum(record, 0)], -1)
    inside = (record >= 0) & (starts < goal_of)
    pieces = np.bincount(record[inside], minlength=n) if inside.any() else np.zeros(n, int)
    return pd.DataFrame({
        "file": pdf["file"], "block": pdf["block"], "seq": pdf["seq"],
        "record": np.where(inside, record, -1), "is_head": sound,
        "pieces": np.where(inside, pieces[np.maximum(record, 0)], 0)})


def read_archives(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """One row per verified record: headers, payload_bytes, payload_digest and, where
    asked for, the payload (this shuffles it)."""
    pieces = candidates(spark, path)
    own = F.expr("cast(value AS binary)")
    whole = F.col("length") == F.col("body_at") + F.col("content") + len(END)
    payload = F.substring(own, F.col("body_at") + F.lit(1), F.col("content"))
    held = stage(pieces.select(
        "file", "block", "seq", "length", "body_at", "content",
        F.when(F.col("content").isNotNull(), F.col("head")).alias("head"),
        F.when(whole, F.sha2(payload, 256)).alias("digest"), own.alias("bytes")), "warc_pieces")
    marks = held.select("file", "block", "seq", "length", "body_at", "content") \
        .groupBy("file").applyInPandas(
            _reach, "file string, block long, seq long, record long, is_head boolean, pieces long")
    marks = stage(marks.where("record >= 0"), "warc_boundaries")
    # seq numbers the pieces of all files; bytes of single pieces are read only if asked for
    needed = ["seq", "head", "digest", "content"] + ["body_at", "bytes"] * payloads
    single = (held.select(*needed).join(marks.where("is_head AND pieces = 1").select("seq"), "seq")
              .select("head", "digest", "content", *[
                  F.substring("bytes", F.col("body_at") + F.lit(1), F.col("content"))
                  .alias("payload")] * payloads))
    several = held.drop("block").join(
        marks.where("pieces > 1").select("seq", "record", "is_head"), "seq")
    parts = F.sort_array(F.collect_list(F.struct("seq", "bytes")))
    joint = F.aggregate(F.slice(F.col("parts"), F.lit(2), F.size("parts") - 1),
                        F.col("parts")[0]["bytes"],
                        lambda acc, x: F.concat(acc, F.lit(MAGIC.encode()), x["bytes"]))
    several = (several.groupBy("file", "record")
               .agg(parts.alias("parts"),
                    *[F.max(F.when(F.col("is_head"), F.col(c))).alias(c)
                      for c in ("head", "content", "body_at")])
               .select("head", "content",
                       F.substring(joint, F.col("body_at") + F.lit(1),
                                   F.col("content")).alias("payload")))
    records = single.unionByName(several.select(
        "head", F.sha2("payload", 256).alias("digest"), "content", *["payload"] * payloads))
    return _parsed(records, payloads)


def _parsed(records: DataFrame, payloads: bool) -> DataFrame:
    def field(name: str) -> Column:
        text = F.concat(F.lit(BREAK), "head", F.lit(BREAK))
        pattern = rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)\r\n"
        return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1))

    kind, size = field("WARC-Type"), field("WARC-Payload-Length").cast("bigint")
    stated = F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "")
    revisit = kind == "revisit"
    named = [kind.alias("record_type"), field("WARC-Record-ID").alias("record_id"),
             field("WARC-Target-URI").alias("target_uri"),
             field("WARC-Refers-To").alias("refers_to_id"),
             F.when(revisit, size).otherwise(F.col("content")).alias("payload_bytes"),
             F.when(revisit, stated).otherwise(F.col("digest")).alias("payload_digest")]
    return records.select(*named, *([F.col("payload")] if payloads else []))


def page_key(urn: str, kind: str = "bigint") -> Column:
    """The key in a record id, in the type it had; null if it is of no such type."""
    return F.expr(f"try_cast(substr({urn}, {len(KEY_URN) + 1}) AS {kind})")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and report each record."""
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(pages, path)
    found = read_archives(spark, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    return found.select(page_key("record_id", kind).alias("page_id"), "payload_bytes",
                        "payload_digest", "record_type",
                        page_key("refers_to_id", kind).alias("refers_to"))
