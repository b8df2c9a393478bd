"""Quality classifier: a linear-chain CRF labels every line of a text good or bad.

Each line has a few shape features (shares of letters, capitals, digits and symbols,
word counts and lengths, repeated words) and the same of the lines before and after it.
The chain has two labels and a weight for each pair of neighbouring labels. Forward and
backward passes give each line's probability of being good; their mean, weighted by the
length of the lines, is the document's score.

Only documents are labelled, so in training a document's lines carry its label. The
model is fitted on the driver on a bounded sample of labelled rows: the ``SAMPLE_ROWS``
labels whose keys hash lowest, documents of at most ``SAMPLE_LINES`` lines.

Null and empty texts are one empty line and get that line's probability. Without labels
every document scores 0.5. Rows are scored one by one; whole texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.common import map_batches
from haulmetrics.session import stage

SAMPLE_ROWS = 4000
SAMPLE_LINES = 2000
THRESHOLD = 0.7

LETTER, UPPER, DIGIT, BLANK, END, SYMBOL = range(6)
SHAPES = 13


def _classes() -> np.ndarray:
    """Class of each ASCII code; everything beyond is a letter."""
    out = np.full(129, SYMBOL, np.int8)
    out[[*range(ord("a"), ord("z") + 1), 128]] = LETTER
    out[ord("A"):ord("Z") + 1] = UPPER
    out[ord("0"):ord("9") + 1] = DIGIT
    out[[9, 11, 12, 13, 32]] = BLANK
    out[[ord(c) for c in ".,;:?'\"()-"]] = END
    return out


CLASSES = _classes()


def line_shapes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shape features and length of every line."""
    lines = text.split("\n")
    lengths = np.array([len(line) for line in lines], np.int64)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = CLASSES[np.minimum(code, 128)]
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    sums = np.zeros((6, len(lines)))
    for k in range(6):
        upto = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])
        sums[k] = upto[starts + lengths] - upto[starts]
    words, unique, repeats, ending = [], [], [], []
    for line in lines:
        split = line.split()
        words.append(len(split))
        unique.append(len(set(split)))
        repeats.append(sum(map(eq, split, split[1:])))
        ending.append(line[-1:] in ".?!\"" and bool(line))
    words, unique, repeats = (np.array(x, float) for x in (words, unique, repeats))
    n, w = np.maximum(lengths, 1), np.maximum(words, 1)
    shapes = np.column_stack([
        sums[LETTER] / n, sums[UPPER] / n, sums[DIGIT] / n, sums[SYMBOL] / n, sums[END] / n,
        np.log1p(lengths), np.log1p(words), np.minimum((n - sums[BLANK]) / w, 40) / 10,
        unique / w, np.log1p(unique) / np.log1p(w), repeats / w, np.array(ending, float),
        lengths == 0])
    return shapes.astype(np.float32), lengths


def with_neighbours(shapes: np.ndarray) -> np.ndarray:
    """Features of a document's lines: own, squared, those before and those behind."""
    before, behind = np.zeros_like(shapes), np.zeros_like(shapes)
    before[1:], behind[:-1] = shapes[:-1], shapes[1:]
    edges = np.zeros((len(shapes), 3), np.float32)
    edges[:, 0], edges[0, 1], edges[-1, 2] = 1, 1, 1
    return np.hstack([shapes, shapes ** 2, before, behind, edges])


@dataclass
class LineModel:
    weights: np.ndarray | None  # log-odds of good per feature
    scale: np.ndarray
    stay: float = 0.0  # weight of two neighbours with one label

    def marginals(self, shapes: np.ndarray) -> list[float]:
        """Probability of being good, of each line: forward and backward passes."""
        odds = (with_neighbours(shapes * self.scale) @ self.weights).tolist()
        same = math.exp(self.stay)
        change = 1.0
        forward, g, b = [], 0.5, 0.5
        for i, odd in enumerate(odds):
            p = 1 / (1 + math.exp(-max(-40.0, min(40.0, odd))))
            if i:
                g, b = g * same + b * change, b * same + g * change
            g, b = g * p, b * (1 - p)
            g, b = g / (g + b), b / (g + b)
            forward.append((g, b, p))
        out, up, down = [0.0] * len(odds), 0.5, 0.5
        for i in range(len(odds) - 1, -1, -1):
            g, b, p = forward[i]
            out[i] = g * up / (g * up + b * down)
            x, y = up * p, down * (1 - p)
            up, down = x * same + y * change, y * same + x * change
            up, down = up / (up + down), down / (up + down)
        return out

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.5
        shapes, lengths = line_shapes(text or "")
        good = self.marginals(shapes)
        total = int(lengths.sum())
        if not total:
            return float(np.mean(good))
        return min(1.0, max(0.0, sum(map(float.__mul__, good, lengths.astype(float).tolist()))
                            / total))


def train_chain(chains: list[np.ndarray], labels: np.ndarray, *, rounds: int = 300,
                rate: float = 0.05, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Likeliest weights of chains (features of their lines) whose lines share a label.

    Chains are padded to one array a time step, so a pass is vectorised over them.
    """
    longest = max(map(len, chains))
    order = np.argsort([-len(c) for c in chains], kind="stable")
    sizes = np.array([len(chains[i]) for i in order])
    y = labels[order].astype(float)
    width = chains[0].shape[1]
    flat = np.concatenate([chains[i] for i in order])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    active = [int((sizes > t).sum()) for t in range(longest)]  # chains that reach line t
    at = [first[:active[t]] + t for t in range(longest)]
    weight = np.repeat(1 / sizes, sizes)  # a document counts the same whatever its length
    target = np.repeat(y, sizes)
    w, stay = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(flat @ w, -40, 40)))
        same = math.exp(stay)
        g = np.empty(len(flat))
        for t in range(longest):
            prior = 0.5 if t == 0 else (
                g[at[t] - 1] * same + (1 - g[at[t] - 1])) / (same + 1)
            now = p[at[t]]
            g[at[t]] = prior * now / (prior * now + (1 - prior) * (1 - now))
        up = np.full(len(flat), 0.5)
        agree = np.zeros(len(flat))  # probability that line t + 1 has the label of line t
        for t in range(longest - 2, -1, -1):
            here, next_ = at[t][:active[t + 1]], at[t + 1]
            x, z = up[next_] * p[next_], (1 - up[next_]) * (1 - p[next_])
            gg, bb = g[here] * same * x, (1 - g[here]) * same * z
            agree[here] = (gg + bb) / (gg + bb + g[here] * z + (1 - g[here]) * x)
            a, b = x * same + z, z * same + x
            up[here] = a / (a + b)
        marginal = g * up / (g * up + (1 - g) * (1 - up))
        slope = flat.T @ ((target - marginal) * weight) / len(sizes) - l2 * w
        inner = np.ones(len(flat), bool)
        inner[first + sizes - 1] = False
        slope = np.append(slope, ((1 - agree[inner]) * weight[inner]).sum() / len(sizes)
                          - l2 * stay)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
        move = rate * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, stay = w + move[:-1], stay + float(move[-1])
    return w, stay


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
        label: str = "quality", sample_rows: int = SAMPLE_ROWS,
        sample_lines: int = SAMPLE_LINES) -> LineModel:
    """Fit on labelled documents; ``sample_rows`` and ``sample_lines`` bound the sample."""
    marks = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("__key")).agg(F.max(label).alias("__label"))
             .orderBy(F.xxhash64(F.col("__key").cast("string")), "__key").limit(sample_rows))
    marks = stage(marks, "quality_sample")
    rows = (docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
            .where(F.length("__text") - F.length(F.replace("__text", F.lit("\n"))) < sample_lines)
            .join(F.broadcast(marks), "__key"))  # sample_rows rows at most

    def shape(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [line_shapes(value.as_py())[0].ravel() for value in batch["__text"]]
        return pa.RecordBatch.from_arrays(
            [batch["__key"].cast(pa.string()), batch["__label"].cast(pa.int32()),
             pa.array(found, pa.list_(pa.float32()))], ["key", "label", "shapes"])

    found = (map_batches(rows.select("__key", "__label", "__text"),
                         "key string, label int, shapes array<float>", shape)
             .groupBy("key", "label").agg(F.min("shapes").alias("shapes")).toArrow())
    if not found.num_rows or len(set(found["label"].to_pylist())) < 2:
        return LineModel(None, np.ones(SHAPES, np.float32))
    order = np.argsort(np.array(found["key"].to_pylist()))
    shapes = [found["shapes"][int(i)].values.to_numpy().reshape(-1, SHAPES) for i in order]
    marks = np.array(found["label"].to_pylist())[order]
    scale = (1 / np.maximum(np.concatenate(shapes).std(axis=0), 0.02)).astype(np.float32)
    weights, stay = train_chain([with_neighbours(s * scale) for s in shapes], marks)
    return LineModel(weights, scale, stay)


def score(docs: DataFrame, model: LineModel, *, text: str = "text",
          keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` and the score of every row."""
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.score(value.as_py()) for value in batch["__text"]]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found, pa.float64())],
            [*batch.schema.names[:-1], "score"])

    schema = "".join(f"`{n}` {t}, " for n, t in rows.dtypes[:-1])
    return map_batches(rows, schema + "score double", run)


def keep_good(docs: DataFrame, model: LineModel, *, text: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [shared.value.score(v.as_py()) >= threshold for v in batch[text]]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
