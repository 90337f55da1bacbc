"""Operator 6, token ids as binary output: Elias-Fano document boundaries over one concatenated id array.

Layout. The corpus is one array of ids in ascending doc_id order, cut into shards (ranges of doc_id) and these into
segments of about SEGMENT ids, whole documents each. A segment is a row of the written table:
  shard int, segment int       place in the corpus
  n_docs, n_tokens bigint
  width int                    bytes per id: 2 if the vocabulary fits, else 4
  ids binary                   little-endian ids, every document followed by the end id
  ends binary                  Elias-Fano of the documents' end offsets inside the segment
  n_null int, first_doc bigint, docs binary   documents without an id (they come first), the smallest doc_id, and
                               Elias-Fano of doc_id - first_doc
The container is Parquet with binary columns, since Spark can commit, retry and read it on any store; `start` of a
document is its segment's start (a prefix sum over segment sizes) plus `select` on `ends`.

Odd cases: a null text is empty (its document is the end id alone); rows of one doc_id stand in the order of their
text's hash, then text; repeated rows are written each; columns other than the id and the text are not read; an empty
table gives no segment and no rows. A segment holds whole documents, so a single text of over 2 GB of ids (2**30 at two
bytes) does not fit into its binary column and fails the job.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import elias_fano
from tidemark.llm.pieces import by_bytes, encoder
from tidemark.llm.workers import trimmed
from tidemark.session import scratch_path

SEGMENT = 1 << 21        # ids after which a segment is closed
SCHEMA = ("shard int, segment int, n_docs bigint, n_tokens bigint, width int, ids binary, ends binary, n_null int, "
          "first_doc bigint, docs binary")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _segment(shard: int, number: int, ids: list[np.ndarray], counts: np.ndarray, docs: pa.Array, width: int) -> list:
    n_null = docs.null_count
    known = docs.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    first = int(known[0]) if len(known) else 0
    gaps = known.view(np.uint64) - np.int64(first).view(np.uint64)     # modulo 2**64, so exact
    whole = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    return [shard, number, len(counts), len(whole), width, whole.astype(f"<u{width}").tobytes(),
            elias_fano.encode(np.cumsum(counts).astype(np.uint64)), n_null, first, elias_fano.encode(gaps)]


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          segment: int = SEGMENT) -> None:
    """Encode every text and write the table at `path`. One shuffle, by ranges of doc_id."""
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()),
                        ("n_tokens", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()),
                        ("ends", pa.binary()), ("n_null", pa.int32()), ("first_doc", pa.int64()),
                        ("docs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer)
        width = 2 if max(coder.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4
        ids, counts, names, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            row = _segment(shard, number, ids, np.concatenate(counts), pa.concat_arrays(names), width)
            return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, schema)], schema=schema)

        for part in by_bytes(batches, "text"):
            i, c = _with_end(*coder.encode(part.column("text")), end_id)
            ids.append(i)
            counts.append(c)
            names.append(part.column("doc_id"))
            size += len(i)
            if size >= segment:
                yield close()
                number += 1
                ids, counts, names, size = [], [], [], 0
        if counts:
            yield close()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    ordered.select("doc_id", "text").mapInArrow(trimmed(run), SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the written files alone."""
    table = spark.read.schema(SCHEMA).parquet(path)
    sizes = table.groupBy("shard").agg(F.sum("n_tokens").alias("n"))       # a row per shard
    shard_start = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)),
                             F.lit(0))
    shards = sizes.select("shard", shard_start.alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = (table.select("shard", "segment", "n_tokens")
              .withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
              .join(shards, "shard")
              .select("shard", "segment", (F.col("shard_start") + F.col("before")).alias("segment_start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(n)[i].as_py() for n in NAMES}
                ends = elias_fano.Reader(r["ends"]).all().astype(np.int64)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
                gaps = elias_fano.Reader(r["docs"]).all()
                known = (gaps + np.int64(r["first_doc"]).view(np.uint64)).view(np.int64)
                n = r["n_docs"]
                names = pa.concat_arrays([pa.nulls(r["n_null"], pa.int64()), pa.array(known, pa.int64())])
                crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)), np.int64, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r["shard"], np.int32)), pa.array(np.full(n, r["segment"], np.int32)), names,
                     pa.array(begins), pa.array(ends - begins), pa.array(crc)],
                    names=["shard", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"])

    rows = table.mapInArrow(trimmed(run), "shard int, segment int, doc_id bigint, offset bigint, n_tokens bigint, "
                                 "ids_crc32 bigint")
    return (rows.join(starts, ["shard", "segment"])
            .select("doc_id", (F.col("segment_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, **columns: str) -> DataFrame:
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token_files")
    write(docs, path, tokenizer, end_id, **columns)
    return read(spark, path)
