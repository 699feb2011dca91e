"""Quality scores from Naive Bayes support vectors.

Indicators of n-grams are scaled by the log ratio of their frequencies in the two classes, and a linear model with
hinge loss is fitted to the scaled indicators by dual coordinate descent. The model is fitted in one task on a
bounded number of labelled documents and has a fixed size; all documents are scored side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from postmill.llm.common import bounded_batches, fresh, remainder

#: Indicators: hashed byte trigrams, then shares of repeated neighbours and of distinct words in steps of a tenth.
HASH_BITS = 18
_SHARES = 11
SIZE = (1 << HASH_BITS) + 2 * _SHARES
#: Labelled documents that the model is fitted on, at most; those with the smallest hashes of doc_id are taken.
TRAIN_ROWS = 8_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
_CHUNK = 1 << 20


@dataclass
class Model:
    ratio: np.ndarray  # log-count ratio of every indicator
    weight: np.ndarray  # of the scaled indicators
    bias: float
    slope: float  # the sigmoid that turns margins into probabilities
    offset: float


class _Scaled(Sequence):
    """Scaled rows, each made when it is asked for: all of them would take twice the memory of the indicators."""

    def __init__(self, ratio: np.ndarray, rows: list[np.ndarray]):
        self._ratio, self._rows = ratio, rows

    def __len__(self) -> int:
        return len(self._rows)

    def __getitem__(self, i: int) -> np.ndarray:
        return self._ratio[self._rows[i]]


def indicators(text: bytes | None) -> np.ndarray:
    """Ascending numbers of the n-grams that occur in a whole text."""
    text = text or b""
    seen = np.zeros(SIZE, bool)
    data = np.frombuffer(text, np.uint8)
    for low in range(0, max(0, len(data) - 2), _CHUNK):
        part = data[low:low + _CHUNK + 2].astype(np.uint32)
        code = (part[:-2] << np.uint32(16)) | (part[1:-1] << np.uint32(8)) | part[2:]
        seen[(code * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)] = True
    words = text.split()
    if len(words) > 1:
        repeats = sum(map(eq, words, words[1:])) / (len(words) - 1)
        seen[(1 << HASH_BITS) + int(10 * repeats)] = True
        seen[(1 << HASH_BITS) + _SHARES + int(10 * len(set(words)) / len(words))] = True
    return np.flatnonzero(seen)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit on indicator lists and labels 0 or 1; a fifth of the rows is kept back for the sigmoid."""
    kept_back = np.arange(len(rows)) % 5 == 4
    if len(set(labels[~kept_back].tolist())) < 2:
        kept_back[:] = False
    counts = np.full((2, SIZE), SMOOTHING)
    for x, y, out in zip(rows, labels.tolist(), kept_back):
        if not out:
            counts[y, x] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    ratio = np.log(shares[1] / shares[0])
    scaled = _Scaled(ratio, rows)
    lengths = [max(float(np.sqrt(v @ v)), 1e-12) for v in scaled]
    weight, bias = _descend(rows, scaled, lengths, np.where(labels == 1, 1.0, -1.0), np.flatnonzero(~kept_back))
    margin = np.array([weight[x] @ v / n + bias for x, v, n in zip(rows, scaled, lengths)])
    use = kept_back if kept_back.any() else ~kept_back
    slope, offset = _sigmoid(margin[use], labels[use])
    return Model(ratio, weight, bias, slope, offset)


def _descend(rows, scaled, lengths, signs, train) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for hinge loss with box constraint COST; the bias is one more feature of value 1."""
    weight, bias = np.zeros(SIZE), 0.0
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        largest = 0.0
        for i in order.permutation(train).tolist():
            x, v, y = rows[i], scaled[i] / lengths[i], signs[i]
            slack = y * (weight[x] @ v + bias) - 1
            new = min(max(alpha[i] - slack / 2, 0.0), COST)  # a row has length 1, and 1 for the bias
            if step := (new - alpha[i]) * y:
                weight[x] += step * v
                bias += step
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weight, bias


def _sigmoid(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the margins, by Newton steps on smoothed targets."""
    good, bad = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, offset = 1.0, float(np.log((good + 1) / (bad + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = np.array([(target - p) @ margin - 1e-3 * slope, (target - p).sum()])
        w = p * (1 - p)
        h = np.array([[w @ margin**2 + 1e-3, w @ margin], [w @ margin, w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS,
          divisor: int = 4, left_out: int = 2) -> Model | None:
    """The model from labelled documents outside the held-out remainder; None if there are none."""
    known = labels.select("doc_id", "quality").where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), divisor) != left_out)
    ).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most train_rows ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            cells = [indicators(t).astype("<i4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality").cast(pa.int32()), pa.array(cells, pa.binary())],
                names=["doc_id", "quality", "cells"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("cells", "ascending")]).slice(0, train_rows)
        rows = [np.frombuffer(c.as_buffer(), "<i4") for c in table.column("cells")]  # views, no copies
        m = fit(rows, table.column("quality").to_numpy())
        return pa.table({
            "ratio": pa.array([m.ratio.astype("<f4").tobytes()], pa.binary()),
            "weight": pa.array([m.weight.astype("<f4").tobytes()], pa.binary()),
            "bias": [m.bias], "slope": [m.slope], "margin": [m.offset],
        })

    kind = docs.schema["doc_id"].dataType.simpleString()
    row = (joined.mapInArrow(encode, f"doc_id {kind}, quality int, cells binary")
           .groupBy(F.lit("all")).applyInArrow(train, "ratio binary, weight binary, bias double, slope double, margin double")
           .first())
    if row is None:
        return None
    return Model(np.frombuffer(row.ratio, "<f4"), np.frombuffer(row.weight, "<f4"), row.bias, row.slope, row.margin)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, train_rows: int = TRAIN_ROWS,
          divisor: int = 4, left_out: int = 2, columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per input row; predicted is 1 from ``threshold`` on.

    With ``columns`` other columns of the input are passed through in place of doc_id; they must not be called
    like the three new ones.

    Labels are learnt only from documents whose crc32(doc_id) modulo ``divisor`` is not ``left_out``, from at most
    ``train_rows`` labelled ids; labels other than 0 and 1 and null ids are not used, and an id with
    both labels counts as 0. Only the text enters a score: null and empty texts are scored on the bias alone, equal
    texts alike. Without usable labels every score is 0.5. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    model = learn(docs, labels, train_rows, divisor, left_out)
    held_out = remainder(F.col("doc_id"), divisor) == left_out
    if model is None:
        return docs.select(*columns, held_out.alias("held_out"), F.lit(0.5).alias("score"),
                           F.lit(int(0.5 >= threshold)).alias("predicted"))
    body = fresh(docs, "scored_text")
    source = docs.select(*columns, held_out.alias("held_out"), F.col("text").alias(body))
    tables = docs.sparkSession.sparkContext.broadcast(
        ((model.ratio * model.weight).astype("f4"), (model.ratio.astype("f8") ** 2).astype("f4")))  # fixed size
    bias, slope, offset = model.bias, model.slope, model.offset

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pull, square = tables.value
        for batch in batches:
            margins = []
            for text in batch.column(body).cast(pa.binary()).to_pylist():
                x = indicators(text)
                margins.append(float(pull[x].sum(dtype="f8") / np.sqrt(max(square[x].sum(dtype="f8"), 1e-12))) + bias)
            scores = 1 / (1 + np.exp(-np.clip(slope * np.array(margins) + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= threshold).astype(np.int32))], names=names)

    kept_fields = [f for f in source.schema.fields if f.name != body]
    schema = T.StructType([*kept_fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    names = schema.names
    return source.mapInArrow(run, schema)
