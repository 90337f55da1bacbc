"""Quality rules: measures against Python, the binomial tail against exact fractions, admitted cutoffs."""

from __future__ import annotations

import random
import re
from fractions import Fraction
from math import comb, exp, lgamma, log, log1p

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as q

WORD = re.compile(q.WORD)


def brute(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i: i + 5]) for i in range(len(w) - 4)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            len(lines))


def test_measures(make_docs):
    r = random.Random(3)
    texts = [" ".join(r.choice(["a", "b", "Ñ", "#x", "中|"]) for _ in range(r.randint(0, 60))) for _ in range(60)]
    texts += [None, "", " \n\t\n", "a b c d e", "a b c d e a b c d e", "x " * 5, "x " * 6, "l\nl\n \nl\r\nl", "a b " * 4000,
              "q" * 50000, "a\x0bb\x0cc d"]
    docs = make_docs([(i, t, "en") for i, t in enumerate(texts)]).withColumnRenamed("n_chars", "words")
    got = {x[0]: tuple(x)[3:] for x in q.measures(docs).collect()}
    for i, t in enumerate(texts):
        n = brute(t)
        assert got[i] == (n[0], n[1], n[2], n[3], n[4], n[5]), (i, t)


def test_binomial_tail(spark):
    cases = [(0, 5, 0.1), (3, 50, 0.07), (50, 50, 0.3), (2, 3000, 0.002), (60, 9000, 0.01), (25, 40, 0.5)]
    for k, n, p in cases:
        x = Fraction(p)
        want = float(sum(comb(n, j) * x**j * (1 - x) ** (n - j) for j in range(k + 1))) if k < n * p else 1.0
        assert tail(spark, k, n, p) == pytest.approx(min(want, 1.0), rel=1e-9)


def tail(spark, k, n, p):
    long = lambda x: F.lit(x).cast("bigint")
    return spark.range(1).select(q.binomial_tail(long(k), long(n), F.lit(p))).first()[0]


def test_binomial_tail_of_large_strata(spark):
    for k, n, p in ((19_000, 10_000_000, 0.002), (119_500, 10_000_000, 0.012)):
        top = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p)
        term, total = 1.0, 1.0
        for i in range(1, k + 1):                # every term, none left out
            term *= (k - i + 1) / (n - k + i) * ((1 - p) / p)
            total += term
        assert tail(spark, k, n, p) == pytest.approx(exp(top) * total, rel=1e-6)


def test_production_parameters_admit_a_cutoff_of_symbols(spark, make_docs):
    good = "some quite ordinary words in a line of a text here"
    junk = "### $$$ ### $$$ ### $$$ words *** &&& ||| <<< >>>"
    rows = [(i, junk if i % 9 == 0 else f"{good} {i}", "abcd"[i % 4]) for i in range(2400)]
    labels = spark.createDataFrame([(i, int(i % 9 > 0), 0) for i in range(2400)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in q.judge(make_docs(rows), labels).where("kept").collect()}
    assert kept == {i for i in range(2400) if i % 9}
    assert abs(sum(q.WEIGHTS.values()) - 1) < 1e-12 and set(q.WEIGHTS) == set(q.RULES)


def test_a_repeated_holdout_is_one_trial(spark, make_docs):
    good, junk = "some quite ordinary words in a line of a text here", "### $$$ ### $$$ ### $$$ words *** &&& ||| <<< >>>"
    docs = make_docs([(1, good, "en")] * 4000 + [(2, junk, "en")])
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert q.judge(docs, labels).where("kept").count() == 4001


def labelled(make_docs, spark, bad_share):
    good, junk = "some quite ordinary words in a line of a text here", "### $$$ ### $$$ ### $$$ words *** &&& ||| <<< >>>"
    rows, labels = [], []
    for lang, n in (("en", 4000), ("de", 3000), ("tiny", 40)):
        for _ in range(n):
            i = len(rows)
            rows.append((i, junk if i % bad_share == 0 else f"{good} {i}", lang))
            labels.append((i, 1 if (i % bad_share or i % (bad_share * 400) == 0) else 0, 0))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cutoffs_are_admitted_only_with_enough_evidence(spark, make_docs):
    docs, labels = labelled(make_docs, spark, 10)
    got = {r.doc_id: r for r in q.judge(docs, labels, risk=0.05).collect()}
    assert all(r.kept or r.rejected_by for r in got.values() if not r.base_failed)
    langs = {r.doc_id: r.lang for r in docs.collect()}
    junk = [i for i in got if i % 10 == 0]
    assert all(not got[i].kept for i in junk if langs[i] != "tiny")
    assert all(got[i].kept for i in got if langs[i] == "tiny")            # forty holdouts prove nothing
    for lang in ("en", "de"):                                            # the rest within the risk of each stratum
        good = [got[i].kept for i in got if i % 10 and langs[i] == lang]
        assert sum(good) >= 0.95 * len(good)


def test_false_rejections_stay_within_the_risk(spark, make_docs):
    docs, labels = labelled(make_docs, spark, 10)
    # every junk text labelled good: a tenth of good documents would go, so no cutoff may be admitted
    labels = labels.withColumn("quality", F.lit(1))
    assert q.judge(docs, labels, risk=0.05).where("NOT kept AND NOT base_failed").count() == 0


def test_odd_labels(spark, make_docs):
    docs = make_docs([(1, "a b c", None), (None, "w " * 12, "en"), (2, None, "en"), (2, None, "en"),
                      (3, "one two three four five six seven eight nine ten", None)])
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (3, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = q.judge(docs, labels).collect()
    assert sorted((str(r.doc_id), r.base_failed, r.kept) for r in got) == [
        ("1", True, False), ("2", True, False), ("2", True, False), ("3", False, True), ("None", True, False)]
    assert q.judge(docs, labels.limit(0)).count() == 5
    assert q.judge(docs.limit(0), labels).count() == 0


def test_main_path_is_sql_only(spark, make_docs):
    docs, labels = make_docs([(1, "a b", "en")]), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for df in (q.measures(docs), q.judge(docs, labels)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|MapIn", plan)
