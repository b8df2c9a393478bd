"""Language ID: multinomial logistic regression on TF-IDF of character n-grams.

A text is lower-cased and its n-grams of one to three code points are hashed into
``DIM`` features. A feature's weight is its share of the text's n-grams times its inverse
document frequency. Document frequencies are counted over all training rows. The model
is fitted on the driver with follow-the-regularised-leader (per-coordinate rates, L1 and
L2 penalties, so that most weights are exactly zero) on a bounded sample of training
rows. Every language has the same quota of keys, those that hash lowest, and all its keys
if it has fewer, so that ``SAMPLE_ROWS`` hold them all; one key at least, so each language
is learned. The languages' shares of all training rows are put back into the bias. Every
fifth row of a language sets the temperature that calibrates the scores.

Texts that are null or hold no letter get ``und`` with score 0. Without training rows
every text does. Whole texts are read in windows of ``WINDOW`` code points, so memory
does not grow with a text. Rows are predicted one by one: repeated rows get the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.llm.common import map_batches
from haulmetrics.session import stage

DIM_BITS = 15
DIM = 1 << DIM_BITS
ORDERS = (1, 2, 3)
WINDOW = 1 << 18
SAMPLE_ROWS = 3000
BUCKET_BITS = 10
#: Brings the norm of a text's features near 1.
SCALE = 10.0
#: Passes over the sample are repeated up to about this many steps.
STEPS = 9000
UNDETERMINED = "und"


def ngram_ids(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams of a text, in pieces."""
    step = WINDOW
    for start in range(0, len(text), step):
        piece = text[start:start + step + max(ORDERS) - 1].lower()
        own = len(text[start:start + step].lower())  # a few letters change length
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        mixed = code * np.uint32(0x9E3779B1)
        for n in ORDERS:
            if n > 1:
                mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                mixed = mixed + code[n - 1:] * np.uint32(0x9E3779B1)
            part = mixed[:own]
            yield ((part ^ (part >> np.uint32(13))) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - DIM_BITS)


def term_counts(text: str) -> np.ndarray:
    counts = np.zeros(DIM, np.int64)
    for ids in ngram_ids(text):
        counts += np.bincount(ids, minlength=DIM)
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # feature x language, times the feature's idf
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for ids in ngram_ids(text):
            total += self.weights.take(ids, axis=0).sum(axis=0, dtype=np.float64)
            n += len(ids)
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not any(map(str.isalpha, text)) or not self.languages:
            return UNDETERMINED, 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold each feature, and all rows, counted over the whole table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(DIM + 1, np.int64), 0
        for batch in batches:
            for value in batch["__text"]:
                seen = np.zeros(DIM, bool)
                for ids in ngram_ids(value.as_py() or ""):
                    seen[ids] = True
                df[:DIM] += seen
                rows += 1
        df[DIM] = rows
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["id", "n"])

    total = np.zeros(DIM + 1, np.int64)
    for row in (texts.mapInArrow(count, "id long, n long").groupBy("id")
                .agg(F.sum("n").alias("n")).collect()):  # DIM + 1 rows at most
        total[row["id"]] = row["n"]
    return total[:DIM], int(total[DIM])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int, *, alpha: float,
         beta: float, l1: float, l2: float, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (last row: bias) fitted by follow-the-regularised-leader."""
    z = np.zeros((DIM + 1, languages))
    n = np.zeros((DIM + 1, languages))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0,
                        -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            ids, x, y = rows[r]
            zi, ni = z[ids], n[ids]
            w = weights(zi, ni)
            p = softmax(x @ w)
            p[y] -= 1
            g = np.outer(x, p)
            squared = g * g
            z[ids] = zi + g - (np.sqrt(ni + squared) - np.sqrt(ni)) / alpha * w
            n[ids] = ni + squared
    return weights(z, n)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least negative log-likelihood, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        norm = top[:, 0] + np.log(np.exp(scaled - top).sum(axis=1))
        return float((norm - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def quota(sizes: list[int], total: int) -> int:
    """The most that each group may give so that together they give at most ``total``."""
    left = total
    for i, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - i)
        if size > share:
            return max(1, share)
        left -= size
    return max(sizes, default=1)


def sample_keys(train: DataFrame, sample_rows: int) -> tuple[DataFrame, dict[str, int]]:
    """Distinct keys and labels of the sample, and the rows of each label.

    Where a label's quota ends is found from counts of hash buckets, so that no task sorts
    a whole language.
    """
    keys = stage(train.groupBy("__key", "__label").agg(F.count("*").alias("__rows")).withColumn(
        "__draw", F.xxhash64(F.col("__key").cast("string"))), "language_keys")
    keys = keys.withColumn("__bucket", F.shiftright("__draw", 64 - BUCKET_BITS))
    sizes = keys.groupBy("__label").agg(F.count("*").alias("n"), F.sum("__rows").alias("rows")).collect()
    most = quota([r["n"] for r in sizes], sample_rows)
    counts = keys.groupBy("__label", "__bucket").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__label").orderBy("__bucket")) - F.col("__n")
    reached = counts.withColumn("__before", before).where(F.col("__before") < most)
    place = F.row_number().over(Window.partitionBy("__label").orderBy("__draw", "__key"))
    picked = (keys.join(F.broadcast(reached.select("__label", "__bucket")), ["__label", "__bucket"])
              .withColumn("__place", place).where(F.col("__place") <= most))
    return (stage(picked.select("__key", "__label"), "language_sample"),
            {r["__label"]: r["rows"] for r in sizes})


def fit(train: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang",
        sample_rows: int = SAMPLE_ROWS, alpha: float = 0.3, beta: float = 1.0,
        l1: float = 0.02, l2: float = 1e-3, steps: int = STEPS) -> LanguageModel:
    """Fit on rows with a text and a label; ``sample_rows`` bounds what the driver reads,
    unless there are more languages."""
    train = train.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("__key"), F.col(text).alias("__text"), F.col(label).alias("__label"))
    df, rows = document_frequencies(train.select("__text"))
    if not rows:
        return LanguageModel([], np.zeros((DIM, 0), np.float32), np.zeros(0))
    idf = SCALE * (np.log((1 + rows) / (1 + df)) + 1)
    picked, shares = sample_keys(train.select("__key", "__label"), sample_rows)
    chosen = train.join(F.broadcast(picked),
                        ["__key", "__label"])

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, values = [], []
        for value in batch["__text"]:
            counts = term_counts(value.as_py())
            held = np.flatnonzero(counts)
            ids.append(held.astype(np.int32))
            values.append((counts[held] / max(counts.sum(), 1)).astype(np.float32))
        return pa.RecordBatch.from_arrays(
            [batch["__key"].cast(pa.string()), batch["__label"],
             pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
            ["key", "label", "ids", "values"])

    # one text per key stands for rows that repeat it, so the sample keeps its bound
    sampled = (map_batches(chosen.select("__key", "__label", "__text"),
                           "key string, label string, ids array<int>, values array<float>",
                           features)
               .groupBy("key", "label").agg(F.min(F.struct("ids", "values")).alias("x")).toArrow())
    keys, marks = sampled["key"].to_pylist(), sampled["label"].to_pylist()
    x = sampled["x"].combine_chunks()
    ids, values = x.field("ids"), x.field("values")
    languages = sorted(set(marks))
    data = []
    for i in sorted(range(len(keys)), key=lambda i: (keys[i] or "", marks[i])):
        own = ids[i].values.to_numpy()
        data.append((np.append(own.astype(np.int64), DIM),
                     np.append(values[i].values.to_numpy() * idf[own], 1.0),
                     languages.index(marks[i])))
    seen = np.zeros(len(languages), np.int64)
    own, held = [], []
    for row in data:
        seen[row[2]] += 1
        (own if seen[row[2]] % 5 else held).append(row)
    w = ftrl(own or data, len(languages), alpha=alpha, beta=beta, l1=l1, l2=l2,
             epochs=-(-steps // max(1, len(own or data))))
    logits = np.array([x @ w[ids] for ids, x, _ in held])
    temperature = calibrate(logits, np.array([y for _, _, y in held]))
    prior = np.log([shares[name] / rows for name in languages]) - np.log(seen / seen.sum())
    return LanguageModel(languages, (w[:DIM] * idf[:, None]).astype(np.float32),
                         w[DIM] + temperature * prior, temperature)


def predict(docs: DataFrame, model: LanguageModel, *, key: str = "doc_id", text: str = "text",
            keep: dict[str, Column] | None = None) -> DataFrame:
    """Key, the columns of ``keep``, lang_pred and score of every row."""
    keep = keep or {}
    rows = docs.select(F.col(key).alias("__key"), *[c.alias(n) for n, c in keep.items()],
                       F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages floats

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.predict(value.as_py()) for value in batch["__text"]]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64())],
            [*batch.schema.names[:-1], "lang_pred", "score"])

    schema = "".join(f"`{n}` {t}, " for n, t in rows.dtypes[:-1])
    return (map_batches(rows, schema + "lang_pred string, score double", run)
            .withColumnRenamed("__key", key))
