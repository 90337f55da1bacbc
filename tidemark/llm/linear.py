"""Shared parts of the trained linear models: bounded samples, sparse rows, an Adam optimiser.

Models are fitted on the driver on a bounded sample of labelled rows (the bound is a parameter of each operator); the
sample arrives as hashed features, not as texts. Scoring runs over all rows in Arrow functions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_mod(id_col: str, n: int) -> Column:
    """crc32(id as text) mod n; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def bounded(rows: DataFrame, key: str, limit: int, salt: str = "sample") -> DataFrame:
    """All rows if there are at most `limit`, else those whose keyed hash falls under limit / count: about `limit`
    rows (never more than 1.2 times, but for repeated keys), the same at every run."""
    n = rows.count()
    if n <= limit:
        return rows
    part = F.pmod(F.xxhash64(F.lit(salt), F.col(key).cast("string")), F.lit(1 << 30))
    return rows.where(part < int(limit / n * (1 << 30)))


def one_per_id(rows: DataFrame) -> DataFrame:
    """One row of every doc_id, the one whose text has the smallest hash: reduced in every task before it is moved, so an
    id that holds a third of all rows costs a row a task."""
    rest = [c for c in rows.columns if c != "doc_id"]
    first = F.min(F.struct(F.xxhash64("text").alias("h"), *rest)).alias("row")
    return rows.groupBy("doc_id").agg(first).select("doc_id", *[f"row.{c}" for c in rest])


class Rows:
    """Sparse rows: feature indexes, values and row borders."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray | None]]):
        self.index = np.concatenate([r[0] for r in rows]).astype(np.int64) if rows else np.zeros(0, np.int64)
        self.value = (np.concatenate([np.ones(len(i), np.float32) if v is None else v for i, v in rows])
                      .astype(np.float32) if rows else np.zeros(0, np.float32))
        self.lens = np.array([len(r[0]) for r in rows], np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.lens)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.index], minlength=len(self.lens))

    def back(self, per_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, weights=self.value * per_row[self.row], minlength=size)


def adam(start: np.ndarray, gradient: Callable[[np.ndarray], np.ndarray], steps: int, rate: float) -> np.ndarray:
    """Adam (Kingma and Ba 2015) with the rate falling linearly to a tenth."""
    x, m, v = start.astype(np.float64), np.zeros_like(start, np.float64), np.zeros_like(start, np.float64)
    for t in range(1, steps + 1):
        g = gradient(x)
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        x -= rate * (1 - 0.9 * t / steps) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
