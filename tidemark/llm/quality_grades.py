"""Operator 10, quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade >= k | text) = sigmoid(w . x - t_k) with one weight vector w, shared by all grades, and ordered thresholds
t_1 < t_2 < ...; the thresholds are t_1 and positive steps, so they cannot cross. x holds hashed-text features, each
the square root of its share of the text's words: the lower-cased word, the word's shape (classes of its first and
last character, share of capitals, length), its last two bytes, and whether it repeats the word before it.

Results: `expected_grade` = sum of the tail probabilities, `p_1` ... `p_K` the tails, `selected` = P(grade >= 1) >= cut.

Ratings: `labels` grades a document 0 (poor), 1 (good but toxic), 2 (good and clean); of several ratings the lowest
counts; a null rating is left out. Learned from rows whose crc32(doc_id) mod 5 is not 0, about `sample` of them, drawn
by hash. A text without words has x = 0. With no ratings, or a single grade, every text gets that grade's rates.
Scoring reads whole texts; repeated rows each get a row, and of rows that share a doc_id one is learned from. An empty
table gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_words import _LOWER, GOLDEN, NON_SPACE, U64, buffers, mix, slices, words
from tidemark.llm.linear import Rows, adam, bounded, crc_mod, one_per_id, sigmoid
from tidemark.llm.workers import trimmed

BITS = 16
SAMPLE = 5000
SPLIT = 5
RIDGE = 1e-5
CUT = 0.5
GRADES = 3               # 0, 1, 2

_CLASS = np.full(256, 3, np.int64)                  # 0 capital, 1 small, 2 digit, 3 other ASCII, 4 non-ASCII
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[0x80:] = 0, 1, 2, 4


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of the texts of a column, in order of both."""
    data, offsets = buffers(column)
    h, doc, start, end = words(data, offsets, NON_SPACE)
    if not len(h):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0)
    kind = _CLASS[data]
    capitals = np.concatenate([[0], np.cumsum(kind == 0)])
    size = end - start
    capital_share = 3 * (capitals[end] - capitals[start]) // size
    shape = ((kind[start] * 5 + kind[end - 1]) * 4 + capital_share) * 16 + np.minimum(size, 15)
    last = data[end - 1].astype(np.int64) * 256 + np.where(size > 1, _LOWER[data[end - 2]], 0)
    again = np.zeros(len(h), np.int64)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    n = np.bincount(doc, minlength=len(column))
    slots = [(h >> U64(64 - BITS)).astype(np.int64)]
    for k, code in enumerate((shape, last, again)):
        slots.append((mix((code.astype(U64) * U64(8) + U64(k + 1)) * GOLDEN) >> U64(64 - BITS)).astype(np.int64))
    pair, count = np.unique(np.concatenate([(doc << BITS) | s for s in slots]), return_counts=True)
    row = pair >> BITS
    return row, pair & ((1 << BITS) - 1), np.sqrt(count / n[row])


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, column: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: texts x (grades - 1)."""
        row, slot, value = features(column)
        z = np.bincount(row, weights=value * self.weights[slot], minlength=len(column))
        return sigmoid(z[:, None] - self.thresholds[None, :])


def ratings(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, grade (0 to 2) from the quality and toxic marks."""
    grade = (F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1)
             .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2))
    rows = labels.select(F.col(id_col).alias("doc_id"), grade.alias("grade"))
    return rows.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy("doc_id").agg(
        F.min("grade").alias("grade"))


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            row, slot, value = features(part.column("text"))
            borders = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("grade"), pa.ListArray.from_arrays(borders, pa.array(slot.astype(np.int32))),
                 pa.ListArray.from_arrays(borders, pa.array(value.astype(np.float32)))],
                names=["grade", "index", "value"])


def fit(docs: DataFrame, rated: DataFrame, grades: int = GRADES, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> Model:
    """`rated`: doc_id, grade (0 to grades - 1), a row per document."""
    drawn = bounded(rated.where(crc_mod("doc_id", SPLIT) != 0), "doc_id", sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # about `sample` ids, small enough to send to every task, and one text of each, however many rows an id has
    got = (one_per_id(texts.join(F.broadcast(drawn), "doc_id")).select("grade", "text")
           .mapInArrow(trimmed(_sample_rows), "grade int, index array<int>, value array<float>").toArrow())
    y = got.column("grade").to_numpy().astype(np.int64)
    size, n = 1 << BITS, max(len(y), 1)
    tails = np.array([((y >= k).sum() + 0.5) / (n + 1) for k in range(1, grades)])
    thresholds = np.log((1 - tails) / tails)
    if len(np.unique(y)) < 2:
        return Model(np.zeros(size), thresholds)
    x = Rows([(i.values.to_numpy(), v.values.to_numpy()) for i, v in zip(got.column("index"), got.column("value"))])
    share = np.bincount(y, minlength=grades)
    weight = (1 / np.maximum(share, 1))[y] / (share > 0).sum()               # every grade weighs the same
    start = np.zeros(size + grades - 1)
    start[size] = thresholds[0]
    start[size + 1:] = np.log(np.maximum(np.diff(thresholds), 0.1))

    def cut_points(v):
        return v[size] + np.concatenate([[0], np.cumsum(np.exp(v[size + 1:]))])

    def gradient(v):
        z, t = x.dot(v[:size]), cut_points(v)
        high = np.concatenate([np.ones((len(y), 1)), sigmoid(z[:, None] - t), np.zeros((len(y), 1))], axis=1)
        up, down = high[np.arange(len(y)), y], high[np.arange(len(y)), y + 1]
        p = np.maximum(up - down, 1e-9)
        d_up, d_down = up * (1 - up) / p, down * (1 - down) / p              # of -log p by the two cut points
        g_z = -weight * (d_up - d_down)
        g_t = np.zeros(grades + 1)
        np.add.at(g_t, y, weight * d_up)
        np.add.at(g_t, y + 1, -weight * d_down)
        g_t = g_t[1:grades]
        steps = np.exp(v[size + 1:]) * np.cumsum(g_t[::-1])[::-1][1:]
        return np.concatenate([x.back(g_z, size) + RIDGE * v[:size], [g_t.sum()], steps])

    v = adam(start, gradient, 120, 0.2)
    return Model(v[:size], cut_points(v))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            cut: float = CUT) -> DataFrame:
    """doc_id, held_out, expected_grade, p_1 ... p_K, selected for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)             # 2**BITS weights
    names = [f"p_{k + 1}" for k in range(len(model.thresholds))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p = shared.value.tails(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(p.sum(axis=1)),
                     *(pa.array(np.ascontiguousarray(c)) for c in p.T)],
                    names=["doc_id", "held_out", "expected_grade", *names])

    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(id_col, SPLIT) == 0).alias("held_out"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(trimmed(run), f"doc_id {id_type}, held_out boolean, expected_grade double, "
                                  + ", ".join(f"{x} double" for x in names))
    return scored.withColumn("selected", F.col("p_1") >= cut)
