"""The corpus pipeline: its stages one by one on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_ngram_join import brute as groups
from tests.llm.test_tokens import expected_files


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    for (name, stage), check in zip(corpus_pipeline.STAGES[:4], (None, groups, leaks, None)):
        out = stage(spark, spark.createDataFrame(docs.collect(), docs.schema), SF_SMALL)
        assert out.columns == docs.columns
        after = sorted((r.doc_id, r.text) for r in out.collect())
        if name == "near_duplicates":
            assert {i for i, _ in after} == {c for _, _, c in check(rows)} and len(after) < len(rows)
        elif name == "decontaminate":
            assert {i for i, _ in after} == {r[0] for r in check(rows, items) if not r[-1]}
        elif name == "mix_sources":
            assert set(after) == set(rows)
        else:
            assert set(after) <= set(rows) and len(after) > 0.95 * len(rows)
        docs, rows = spark.createDataFrame(out.collect(), docs.schema), after
    got = corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(r[1:] for r in expected_files(rows, 2))


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = out.orderBy("start").collect()
    assert rows[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))


def test_empty_table_and_clashing_columns(spark, make_docs, tmp_path):
    import corpus_pipeline

    sf_dir = str(tmp_path)
    extra = "doc_id long, text string, lang string, source string, n_chars long, vid long, label string, n_tokens string"
    make_docs([], extra).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([("q", "one two three four five six seven eight nine ten")], "item_id string, text string").write.parquet(
        f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir)
        assert got.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == docs.columns, name
