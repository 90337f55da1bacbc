"""Operator 2, token counts: batch encoding in Arrow functions that return lengths only.

Slices of batches hold equal bytes, and texts are split at safe boundaries (see `pieces.py`), so neither a long text
nor a run of long rows decides a task's memory. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows each get
their own row; columns other than the id and the text are not read. A text without a safe boundary is one piece, encoded
whole: its encoding takes some hundred times its bytes. An empty table gives no rows. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import by_bytes, encoder
from tidemark.llm.workers import trimmed

LIMIT = 2048             # tokens over which a document is marked


def count(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. `tokenizer`: path of a `tokenizers` JSON file that every executor has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(tokenizer, lengths_only=True)
        for part in by_bytes(batches, "text"):
            n = pa.array(counter.count(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), n],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(trimmed(run), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
