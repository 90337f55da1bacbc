"""Operator 1, benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words of ASCII letters and digits and non-ASCII characters. Of every run of
`w` consecutive k-word hashes the smallest (rightmost of equals) is a fingerprint, in documents and benchmark items
alike, so any span of `k + w - 1` words that both hold yields the same fingerprint at the same place of the span:
with k + w - 1 = SPAN no shared span of SPAN words can be missed. The fingerprints of all documents are joined with
those of the items, and each joined pair is extended word by word in both directions; a run of SPAN equal words or
more makes its words hit. An item of fewer words than SPAN is matched whole, with k and w chosen for its length.

Results of the odd cases: a null or word-less text has no words and no hits; a word-less item never occurs; a null
item_id is named "null"; repeated items count once, repeated documents each get their own row; columns other than
the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_words import ALPHANUMERIC, buffers, ngrams, slices, words
from tidemark.llm.workers import trimmed
from tidemark.session import materialize

SPAN = 10                                                   # words of a window
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def scheme(span: int) -> tuple[int, int]:
    """(k, w) with k + w - 1 = span."""
    k = (span + 1) // 2
    return k, span - k + 1


def winnow(h: np.ndarray, doc: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, index of its first word) of every document of a batch slice, each place once."""
    k, w = scheme(span)
    g, at = ngrams(h, doc, k)
    m = len(g) - w + 1
    if m <= 0:
        return g[:0], at[:0]
    best, where = g[:m].copy(), np.arange(m)
    for j in range(1, w):
        later = g[j: j + m]
        take = later <= best
        best[take] = later[take]
        where[take] = np.flatnonzero(take) + j
    chosen = np.unique(where[doc[at[:m]] == doc[at[w - 1:]]])
    return g[chosen], at[chosen]


def _fingerprints(spans: list[int]):
    """Rows (key, doc_id, span, place, print): one of span 0 for each document with its number of words as place,
    then its fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = buffers(part.column("text"))
                h, doc, _, _ = words(data, offsets, ALPHANUMERIC)
                rows = np.arange(part.num_rows)
                first = np.searchsorted(doc, rows)
                cols = [(rows, np.zeros(len(rows), np.int32), np.bincount(doc, minlength=len(rows)),
                         np.zeros(len(rows), np.int64))]
                for span in spans:
                    g, at = winnow(h, doc, span)
                    cols.append((doc[at], np.full(len(g), span, np.int32), at - first[doc[at]], g.view(np.int64)))
                row, span_, place, print_ = (np.concatenate(c) for c in zip(*cols))
                row = pa.array(row.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(row), part.column("doc_id").take(row), pa.array(span_),
                     pa.array(place.astype(np.int64)), pa.array(print_)],
                    names=["key", "doc_id", "span", "place", "print"])
    return run


PRINT_SCHEMA = "key bigint, {} {}, span int, place bigint, print bigint"


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    df = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return df.withColumn("key", F.xxhash64("doc_id", "text"))


def _item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item string, words array<string>: distinct items with a word."""
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                      "abcdefghijklmnopqrstuvwxyz")
    return (items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                         F.regexp_extract_all(low, F.lit(WORD.pattern), F.lit(0)).alias("words"))
            .where(F.size("words") > 0).distinct())


def _item_prints(items: DataFrame) -> DataFrame:
    """item, span, print, words around the fingerprint (every window with it lies in them) and its place there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("item", "span", "print", "context", "place")}
            for item, ws in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
                span = min(SPAN, len(ws))
                raw = " ".join(ws).encode()
                h, doc, _, _ = words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64), ALPHANUMERIC)
                for g, at in zip(*winnow(h, doc, span)):
                    low = max(0, int(at) - span + 1)
                    out["item"].append(item)
                    out["span"].append(span)
                    out["print"].append(int(g.view(np.int64)))
                    out["context"].append(ws[low: int(at) + span])
                    out["place"].append(int(at) - low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item"], pa.string()), pa.array(out["span"], pa.int32()),
                 pa.array(out["print"], pa.int64()), pa.array(out["context"], pa.list_(pa.string())),
                 pa.array(out["place"], pa.int32())], names=list(out))
    return items.mapInArrow(trimmed(run), "item string, span int, print bigint, context array<string>, place int")


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, hits) to (key, n_hit, items): every hit is extended to the longest equal run around it."""
    for batch in batches:
        keys, n_hit, found = [], [], []
        for key, text, hits in zip(batch.column("key").to_pylist(), batch.column("text"), batch.column("hits")):
            ws = WORD.findall(text.as_py().translate(UPPER_TO_LOWER))
            covered, items = set(), set()
            for hit in hits.as_py():
                context, at, span = hit["context"], hit["at"], hit["span"]
                lo = hi = hit["place"]
                shift = at - lo
                while lo > 0 and lo + shift > 0 and ws[lo + shift - 1] == context[lo - 1]:
                    lo -= 1
                while hi < len(context) and hi + shift < len(ws) and ws[hi + shift] == context[hi]:
                    hi += 1
                if hi - lo >= span:
                    covered.update(range(lo + shift, hi + shift))
                    items.update(hit["items"])
            keys.append(key)
            n_hit.append(len(covered))
            found.append(sorted(items))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.string()))],
            names=["key", "n_hit", "items"])


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, key (hash of id and text), n_words, n_hit, items (sorted ids, as strings, of the
    items of which a window occurs in it).

    Jobs: one pass that writes the fingerprints which items share (fingerprints travel to the join, texts don't),
    then the documents with such a fingerprint are read again to extend them. The items' fingerprints are written
    first, so Spark sees their size and broadcasts them only below its threshold.
    """
    spark = docs.sparkSession
    item_words = _item_words(items, item_col, item_text_col)
    # equal contexts of several items (a boilerplate question) meet a document once, with the list of their items
    prints = materialize(
        _item_prints(item_words).groupBy("span", "print", "context", "place")
        .agg(F.sort_array(F.collect_set("item")).alias("items")), "item_prints")
    known = materialize(prints.select("span", "print").distinct(), "item_print_keys")
    spans = sorted(r["span"] for r in known.select("span").distinct().collect())    # SPAN values at most
    keyed = _keyed(docs, id_col, text_col)
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    made = keyed.mapInArrow(trimmed(_fingerprints(spans)), PRINT_SCHEMA.format("doc_id", id_type))
    marked = materialize(
        made.join(known.withColumn("shared", F.lit(True)), ["span", "print"], "left")
        .where((F.col("span") == 0) | F.col("shared")).drop("shared"), "shared_prints")
    per_doc = marked.where("span = 0").select("key", "doc_id", F.col("place").alias("n_words"))
    shared = marked.where("span > 0").select("key", "span", "print", F.col("place").alias("at")).distinct()
    hit_docs = materialize(shared.select("key").distinct(), "hit_documents")
    hits = (shared.join(prints, ["span", "print"])
            .groupBy("key").agg(F.collect_list(F.struct("at", "span", "context", "place", "items")).alias("hits")))
    texts = keyed.join(hit_docs, "key", "left_semi").select("key", "text").join(hits, "key")
    # rows of one id and text share a key and a result: one of them is enough
    result = (texts.mapInArrow(trimmed(_extend), "key bigint, n_hit bigint, items array<string>")
              .groupBy("key").agg(F.max("n_hit").alias("n_hit"), F.max("items").alias("items")))
    return (per_doc.join(result, "key", "left")
            .select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """The documents without a hit, all their columns kept. A document of which a word is hit goes."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    bad = materialize(find(docs, items, **columns).where("n_hit > 0").select("key").distinct(), "contaminated")
    key = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    name = "_contaminated_key"
    while name in docs.columns:
        name += "_"
    return docs.join(bad.withColumnRenamed("key", name), key == F.col(name), "left_anti")
