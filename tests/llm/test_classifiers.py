"""Trained operators: held-out accuracy, contract columns, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tidemark.llm import language_id, quality_grades, toxicity
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ODD = [(1, None, "en"), (2, "", "en"), (3, "123 ... !!", "en"), (None, "the house is here and there", "en"),
       (4, "the house " * 20000, None), (5, "ё привет", None), (5, "ё привет", None), (6, "ß", "de")]


def test_language_held_out(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark, make_docs):
    learned = language_id.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    docs = make_docs(ODD).withColumnRenamed("n_chars", "held_out")
    got = sorted(((str(r.doc_id), r.lang_pred, r.score) for r in language_id.predict(docs, learned).collect()), key=str)
    lang = [(i, x) for i, x, _ in got]
    assert lang[0][1] == lang[1][1] == lang[2][1] == language_id.UNDETERMINED
    assert all(x in learned.languages for _, x in lang[3:])
    kept = language_id.keep(docs, learned, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 3
    assert language_id.predict(docs, None).where("lang_pred = 'und'").count() == len(ODD)
    assert language_id.fit(docs.limit(0)) is None
    one = language_id.fit(make_docs([(7, "only one language here", "en"), (8, "and more of it", "en"), (9, "words", "en")]))
    assert one.languages == ["en"]
    assert {r.lang_pred for r in language_id.predict(make_docs([(1, "anything")]), one).collect()} == {"en"}


def test_language_three_in_a_family(make_docs):
    seeds = {"fr": "le chat est dans la maison avec les enfants", "es": "el gato en la casa con los hijos",
             "it": "il gatto nella casa con gli bambini", "en": "the cat is in the house with the children",
             "fi": "kissa on talossa lasten kanssa"}
    rows, n = [], 0
    for lang, text in seeds.items():
        for k in range(60):
            n += 1
            ws = text.split()
            rows.append((n, " ".join(ws[(k * 7 + j) % len(ws)] for j in range(6)), lang))
    model = language_id.fit(make_docs(rows))
    assert sorted(map(len, model.families)) == [1, 1, 3]
    got = language_id.predict(make_docs(rows), model).collect()
    want = {r[0]: r[2] for r in rows}
    assert np.mean([r.lang_pred == want[r.doc_id] for r in got]) > 0.97


NOISE = ["kissa on talossa lasten kanssa ja he juovat maitoa koska on kylmä päivä",
         "wszystkie dzieci bawią się w ogrodzie, ponieważ dzisiaj jest ładna pogoda",
         "все дети играют в саду, потому что сегодня хорошая погода", "今天天气很好,孩子们都在花园里玩",
         "T2ZnZXIgd2FsayB0aGUgZG9nIHRvIHRoZSBwYXJrLCBoZSBpcyBoYXBweSB0aGVyZSBhbmQgcGxheXM=",
         "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08",
         "qzxv kjwq pvbx wqjz xkcd vvzq jjxw zpqk bqxj wvkz", "x" * 400]


def test_pipeline_keeps_learned_languages_only(spark, make_docs):
    learned = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    noise = make_docs([(-1 - i, t) for i, t in enumerate(NOISE)])
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, learned.union(noise), SF).collect()}
    assert not any(i < 0 for i in kept)
    rows = learned.select("doc_id", "text").collect()
    assert len(kept) >= 0.999 * len(rows)
    short = [r.doc_id for r in rows if len(r.text or "") < 40 and any(c.isalpha() for c in r.text or "")]
    assert len(short) > 5 and kept.issuperset(short)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op8_toxicity"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p for y, p in held if y == 1]) >= 0.7          # a few hundred labels only at this size
    assert np.mean([p for y, p in held if y == 0]) <= 0.03


def test_counterfactual_penalty(spark, make_docs, monkeypatch):
    """Groups named mostly in toxic texts: with the penalty a neutral mention scores as it does for any group."""
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        group = "immigrants" if toxic or i % 30 == 1 else "natives" if i % 3 == 1 else "people"
        rows.append((i, f"the {group} {'are vermin scum' if toxic else 'live here'} in town {i % 17}", "en"))
        labels.append((i, 1, int(toxic)))
    docs, marks = make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    gap = {}
    for penalty in (0.0, 3.0):
        monkeypatch.setattr(toxicity, "PENALTY", penalty)
        model = toxicity.fit(docs, marks)
        score = model.score(pa.array(["the immigrants like town", "the natives like town", "they are vermin scum"]))
        gap[penalty] = abs(score[0] - score[1])
        assert score[2] > 0.7
    assert gap[3.0] < 0.25 * gap[0.0]
    assert toxicity.swapped("She saw the Immigrants") == "he saw the natives"
    assert toxicity.swapped("nothing here") is None


def test_toxicity_odd_rows(spark, make_docs):
    docs = make_docs(ODD).withColumnRenamed("n_chars", "score")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.predict(docs, toxicity.fit(docs, none)).collect()} == {0}
    marks = spark.createDataFrame([(2, 1), (2, 0), (4, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    got = toxicity.predict(docs, toxicity.fit(docs, marks)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.predict(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_grades_held_out(spark):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in QUERIES["op10_quality_grades"](spark, SF).collect()]
    assert all(0 <= r.p_2 <= r.p_1 <= 1 and r.expected_grade == pytest.approx(r.p_1 + r.p_2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    good = [r.selected for r in held if labels[r.doc_id].quality == 1]
    poor = [r.selected for r in held if labels[r.doc_id].quality == 0]
    assert np.mean(good) >= 0.9 and np.mean(poor) <= 0.4


def test_grades_odd_rows(spark, make_docs):
    docs = make_docs(ODD).withColumnRenamed("n_chars", "p_1")
    rated = quality_grades.ratings(spark.createDataFrame(
        [(2, 1, 0), (2, 0, 0), (4, 1, 1), (6, 1, 0), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int"))
    assert {r.doc_id: r.grade for r in rated.collect()} == {2: 0, 4: 1, 6: 2}
    got = quality_grades.predict(docs, quality_grades.fit(docs, rated)).collect()
    assert len(got) == len(ODD) and all(r.p_2 <= r.p_1 for r in got)
    model = quality_grades.fit(docs, rated.limit(0))
    assert quality_grades.predict(docs, model).count() == len(ODD)


def test_a_repeated_id_gives_one_sample_row(spark):
    from tidemark.llm.linear import one_per_id

    rows = spark.range(6000, numPartitions=4).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 7 ELSE id END AS doc_id", "CASE WHEN id % 3 = 1 THEN 'same' ELSE concat('t', id) END AS text",
        "1 AS label")
    got = one_per_id(rows)
    assert got.columns == rows.columns and got.count() == 2001
    assert "partial_min" in got._jdf.queryExecution().executedPlan().toString()


def test_empty_tables_and_no_language(spark, make_docs):
    from tidemark.llm import language_id, quality_grades, toxicity

    docs = make_docs([(i, "words of some kind here" if i else "123 --", None) for i in range(8)])
    assert language_id.fit(docs) is None
    assert sorted(r.doc_id for r in language_id.keep(docs, None).collect()) == list(range(1, 8))
    none = docs.limit(0)
    clash = none.withColumn("score", none.text).withColumn("label", none.doc_id).withColumn("grade", none.doc_id)
    rated = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert language_id.keep(clash, None).columns == clash.columns
    assert language_id.predict(clash, None).count() == 0
    assert toxicity.predict(clash, toxicity.fit(clash, rated)).count() == 0
    assert quality_grades.predict(clash, quality_grades.fit(clash, quality_grades.ratings(rated))).count() == 0
