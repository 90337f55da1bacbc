"""Operator 8, toxicity: a counterfactual-regularised linear classifier.

Features are presences: the words of a text (ASCII letters and digits and non-ASCII characters, lower-cased), and the
beginnings of 4 to 6 bytes of longer words, hashed. Of the features in the sample those are kept whose presence goes
with a label (either way, by a chi-squared score); a logistic regression with an L2 penalty is fitted on them. For
every learned text that mentions an identity group, a copy with the group's terms swapped for those of another group
is made, and the squared change of the score between the two is added to the loss: a group's name by itself must not
move the score, so neutral mentions stay unmarked.

Learning: labelled documents whose crc32(doc_id) mod 3 is not 1, at most about `sample` of them. A document with
several labels counts as toxic if any says so; null labels are left out. A text of a third kind of label or without
labels at all scores the share of toxic rows (0 if there are none). Scoring reads whole texts; null and empty texts
get the score of no features; repeated rows each get a row, and of rows that share a doc_id one is learned from. An
empty table gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_words import _LOWER, ALPHANUMERIC, GOLDEN, U64, buffers, mix, slices, words
from tidemark.llm.linear import Rows, adam, bounded, crc_mod, one_per_id, sigmoid
from tidemark.llm.workers import trimmed

BITS = 20
SAMPLE = 10000           # labelled rows learned from
SPLIT, HELD = 3, 1       # rows whose crc32 mod SPLIT is HELD are held out
BEGINNINGS = (4, 5, 6)   # bytes
KEPT = 6000              # features kept
LEAST = 5                # sampled rows that must hold a kept feature
PENALTY = 3.0            # of a change between a text and its counterfactual
RIDGE = 5e-5
POSITIVE = 3.0           # weight of a toxic row
CUT = 0.7

# fixed values: terms for identity groups; the n-th term of a row is swapped for the n-th of the next row of its block
IDENTITY_TERMS = (
    (("woman", "women", "girl", "girls", "she", "her"), ("man", "men", "boy", "boys", "he", "his")),
    (("muslim", "muslims"), ("christian", "christians"), ("jewish", "jews"), ("hindu", "hindus"),
     ("buddhist", "buddhists")),
    (("black", "blacks"), ("white", "whites"), ("asian", "asians"), ("latino", "latinos")),
    (("gay", "homosexual"), ("straight", "heterosexual"), ("lesbian", "bisexual")),
    (("immigrant", "immigrants"), ("native", "natives"), ("refugee", "refugees")),
    (("disabled", "blind"), ("healthy", "sighted")),
    (("frau", "frauen"), ("mann", "männer")), (("femme", "femmes"), ("homme", "hommes")),
    (("mujer", "mujeres"), ("hombre", "hombres")),
)
SWAP = {a: b for block in IDENTITY_TERMS for k, row in enumerate(block)
        for a, b in zip(row, block[(k + 1) % len(block)])}
TERM = re.compile(r"(?<![^\W_])(?:" + "|".join(sorted(SWAP, key=len, reverse=True)) + r")(?![^\W_])", re.IGNORECASE)


def swapped(text: str) -> str | None:
    """The text with identity terms exchanged; None if it has none."""
    out, n = TERM.subn(lambda m: SWAP[m.group().lower()], text)
    return out if n else None


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every word and beginning, repeats included."""
    data, offsets = buffers(column)
    h, doc, start, end = words(data, offsets, ALPHANUMERIC)
    docs, slots = [doc], [h]
    size = end - start
    for n in BEGINNINGS:
        own = np.flatnonzero(size > n)
        code = np.zeros(len(own), U64)
        for k in range(n):
            code = (code << U64(8)) | _LOWER[data[start[own] + k]].astype(U64)
        docs.append(doc[own])
        slots.append(mix(code * GOLDEN + U64(n)))
    return np.concatenate(docs), (np.concatenate(slots) >> U64(64 - BITS)).astype(np.int64)


def presence(column: pa.Array, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature), in order; only features of which `kept` is true, if given."""
    doc, slot = features(column)
    if kept is not None:
        own = kept[slot]
        doc, slot = doc[own], slot[own]
    pair = np.unique((doc << BITS) | slot)
    return pair >> BITS, pair & ((1 << BITS) - 1)


@dataclass
class Model:
    slots: np.ndarray        # kept features, ascending
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        kept = np.zeros(1 << BITS, bool)
        kept[self.slots] = True
        doc, slot = presence(column, kept)
        w = self.weights[np.searchsorted(self.slots, slot)]
        return sigmoid(np.bincount(doc, weights=w, minlength=len(column)) + self.bias)


def _lists(doc: np.ndarray, slot: np.ndarray, n: int) -> pa.Array:
    borders = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(slot.astype(np.int32)))


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            n = part.num_rows
            other = pa.array([swapped(t) for t in part.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), _lists(*presence(part.column("text")), n), other.is_valid(),
                 _lists(*presence(other), n)], names=["label", "own", "swapped", "other"])


def labelled(labels: DataFrame, column: str, id_col: str = "doc_id") -> DataFrame:
    """One row per labelled document: doc_id, label (the largest of its labels)."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(column).isNotNull())
    return rows.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(column)).cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> Model:
    known = labelled(labels, label_col, id_col).where(F.col("label").isin(0, 1) & (crc_mod("doc_id", SPLIT) != HELD))
    drawn = bounded(known, "doc_id", sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # about `sample` ids, small enough to send to every task, and one text of each, however many rows an id has
    rows = one_per_id(texts.join(F.broadcast(drawn), "doc_id")).select("text", "label")
    got = rows.mapInArrow(trimmed(_sample_rows), "label int, own array<int>, swapped boolean, other array<int>").toArrow()
    y = got.column("label").to_numpy().astype(np.float64)
    rate = float(y.mean()) if len(y) else 0.0
    if rate in (0.0, 1.0):
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((rate + 1e-6) / (1 - rate + 1e-6))))
    own = [x.values.to_numpy() for x in got.column("own")]
    pairs = np.flatnonzero(got.column("swapped").to_numpy())
    other = [got.column("other")[int(i)].values.to_numpy() for i in pairs]

    n = np.bincount(np.concatenate(own), minlength=1 << BITS).astype(np.float64)
    toxic = np.bincount(np.concatenate([x for x, t in zip(own, y) if t]), minlength=1 << BITS)
    chi = (toxic - n * rate) ** 2 / np.maximum(n * rate * (1 - rate), 1e-9)
    chi[n < LEAST] = 0
    slots = np.sort(np.argsort(-chi, kind="stable")[: min(KEPT, int((chi > 4).sum()))])
    place = np.full(1 << BITS, -1)
    place[slots] = np.arange(len(slots))

    def rows_of(lists):
        return Rows([(p[p >= 0], None) for p in (place[x] for x in lists)])

    x, size = rows_of(own), len(slots)
    a, b = rows_of([own[i] for i in pairs]), rows_of(other)

    weight = np.where(y > 0, POSITIVE, 1.0)
    weight /= weight.sum()

    def gradient(v):
        w = v[:-1]
        error = weight * (sigmoid(x.dot(w) + v[-1]) - y)
        g = x.back(error, size) + RIDGE * w
        if len(pairs):
            change = PENALTY * (a.dot(w) - b.dot(w)) / len(pairs)
            g += a.back(change, size) - b.back(change, size)
        return np.append(g, error.sum())

    start = np.zeros(size + 1)
    start[-1] = np.log(rate / (1 - rate))
    v = adam(start, gradient, 400, 0.05)
    return Model(slots, v[:-1], float(v[-1]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)           # KEPT weights at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(shared.value.score(part.column("text")))],
                    names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(id_col, SPLIT) == HELD).alias("held_out"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(trimmed(run), f"doc_id {id_type}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
