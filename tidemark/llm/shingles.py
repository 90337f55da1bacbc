"""Sets of word shingles, shared by the operators that compare documents by Jaccard similarity.

A document's set holds the 64-bit hashes of its distinct runs of `size` words (a shorter text: its whole sequence as
one). Documents of equal sets are one class, named by a 128-bit digest of the set; `vid` numbers classes. Bitmaps of
fixed size only keep rows that cannot match from being worked on; joins decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_words import GOLDEN, NON_SPACE, U64, buffers, mix, ngrams, slices, words
from tidemark.llm.workers import trimmed
from tidemark.session import materialize

BITMAP = 1 << 26         # bits
SALTS = mix(np.array([1, 2], U64))


def ceil_div(a, b: int):
    """For numpy integers and for columns."""
    if isinstance(a, Column):
        return F.floor((a + (b - 1)) / F.lit(float(b))).cast("long")      # exact: a is far below 2**53
    return -(-a // b)


def needed(n: Column, m: Column, percent: int) -> Column:
    """The least overlap of sets of n and m with 100 * overlap >= percent * union."""
    return ceil_div(percent * (n + m), 100 + percent)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle) of a text column: distinct, ordered by both."""
    data, offsets = buffers(column)
    h, doc, _, _ = words(data, offsets, NON_SPACE)
    g, at = ngrams(h, doc, size)
    docs, shingles = [doc[at]], [g]
    count = np.bincount(doc, minlength=len(column))
    first = np.cumsum(count) - count
    for n in range(1, size):                         # short texts: all their words are one shingle
        own = np.flatnonzero(count == n)
        if len(own):
            short, _ = ngrams(h[(first[own][:, None] + np.arange(n)).ravel()], np.repeat(own, n), n)
            docs.append(own)
            shingles.append(short)
    doc, g = np.concatenate(docs), np.concatenate(shingles).view(np.int64)
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], g[new]


def sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple]:
    """(slice, sizes, first digest, second digest, first place of each set, shingles)."""
    for part in slices(batch, "text"):
        doc, g = shingle_sets(part.column("text"), size)
        n = np.bincount(doc, minlength=part.num_rows).astype(np.int64)
        first = np.cumsum(n) - n
        d = []
        for salt in (0, 1):
            total = np.concatenate([[U64(0)], np.cumsum(mix(g.view(U64) ^ SALTS[salt]), dtype=U64)])
            d.append(mix(total[first + n] - total[first] + n.astype(U64) * GOLDEN).view(np.int64))
        yield part, n, d[0], d[1], first, g


def lists(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> pa.Array:
    own = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    borders = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(values[own]))


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.xxhash64(F.col(id_col)).alias("home"))


# ---- bitmaps ---------------------------------------------------------------------------------------------------

def bits(spark, size: int, values: DataFrame):
    """A broadcast bitmap of hashes (column h), `size` bits: built by tasks in pieces of 4 KB, at most size / 8 bytes
    in all."""
    slot = F.shiftrightunsigned(F.col("h"), 64 - (size.bit_length() - 1))
    pieces = (values.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("piece")).collect())
    bitmap = np.zeros(size // 8 + 4096, np.uint8)
    for r in pieces:            # bucket 1 holds slots 1 to 32768, bucket 0 slot 0 alone
        at = (r["bucket"] - 1) * 4096
        piece = np.frombuffer(bytes(r["piece"]), np.uint8)
        if at >= 0:
            bitmap[at: at + len(piece)] |= piece
    return spark.sparkContext.broadcast(bitmap)


def has(bitmap: np.ndarray, size: int, h: np.ndarray) -> np.ndarray:
    slot = (h.view(U64) >> U64(64 - (size.bit_length() - 1))).astype(np.int64) - 1
    return (slot < 0) | ((bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)


def bitmap_size(count: int) -> int:
    """A power of two of bits, 32 per value, at most BITMAP."""
    return min(BITMAP, 1 << max(16, (32 * count).bit_length()))


# ---- whole sets --------------------------------------------------------------------------------------------------

def whole_sets(rows: DataFrame, classes: DataFrame, vids: DataFrame, size: int) -> DataFrame:
    """vid, n, shingles of the classes in `vids`, from one document of each (its `home`). Other texts are passed over
    before they are cut into words."""
    spark = rows.sparkSession
    wanted = materialize(classes.select("vid", "d1", "d2", "home").join(vids, "vid"), "wanted")
    n_bits = bitmap_size(wanted.count())
    bitmap = bits(spark, n_bits, wanted.select(F.col("home").alias("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = batch.column("home").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(has(bitmap.value, n_bits, home)))
            for part, n, d1, d2, first, g in sets(batch, size):
                hit = np.flatnonzero(n > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d1[hit]), pa.array(d2[hit]), part.column("home").take(pa.array(hit)),
                     lists(g, first[hit], n[hit])], names=["d1", "d2", "home", "shingles"])

    found = rows.select("home", "text").mapInArrow(trimmed(run), "d1 bigint, d2 bigint, home bigint, shingles array<bigint>")
    found = found.join(wanted, ["d1", "d2", "home"])
    return materialize(found.dropDuplicates(["vid"]).select("vid", F.size("shingles").cast("bigint").alias("n"), "shingles"),
                       "whole_sets")


def verified(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    one = whole.select(F.col("vid").alias("a"), F.col("shingles").alias("x"))
    two = whole.select(F.col("vid").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    overlap = F.size(F.array_intersect("x", "y"))
    return both.where(overlap >= needed(F.size("x"), F.size("y"), percent)).select("a", "b")


def with_components(members: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, d1, d2, label of every member row, from the components `labels` (v, label) of
    linked classes."""
    least = members.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("class_id"))
    named = (least.join(classes.select("d1", "d2", "vid"), ["d1", "d2"])
             .join(labels.withColumnRenamed("v", "vid"), "vid", "left")
             .select("d1", "d2", "class_id", F.coalesce("label", "vid").alias("label")))
    named = materialize(named, "class_labels")
    components_ = named.groupBy("label").agg(F.min("class_id").alias("component_id"))
    per_class = materialize(named.join(components_, "label").select("d1", "d2", "component_id", "label"),
                            "class_components")
    with_set = members.where("n > 0").join(per_class, ["d1", "d2"])
    without = members.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn(
        "label", F.lit(None).cast("bigint"))
    cols = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "d1", "d2", "label"]
    return with_set.select(*cols).unionByName(without.select(*cols))
