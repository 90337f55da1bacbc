"""Temperature mixing: exponents, quotas and blocks."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def corpus(make_docs, odd=True):
    rows = []
    for source, docs, length in (("big", 400, 30), ("mid", 60, 25), ("small", 20, 20)):
        rows += [(len(rows) + i, "w " * (length + i % 7), "en", source) for i in range(docs)]
    if odd:
        rows += [(9000, "a b c d", "en", None), (9001, None, "en", None), (9002, "", "en", "empty"), (None, "x y", "en", "small"),
                 (5, rows[5][1], "en", "big")]
    return rows, make_docs(rows)


def tokens_by_source(rows):
    out = defaultdict(int)
    for r in rows:
        out[r[3]] += len((r[1] or "").split())
    return out


def test_every_document_once_at_least_and_limit_kept(make_docs):
    rows, docs = corpus(make_docs)
    docs = docs.withColumn("copy", docs.doc_id).withColumn("block", docs.doc_id)
    got = mixing.schedule(docs, max_repetition=3.0).collect()
    per = Counter((r.doc_id, r.source) for r in got)
    have = Counter((r[0], r[3]) for r in rows)
    assert set(per) == set(have)
    assert all(have[k] <= n <= 3 * have[k] for k, n in per.items())
    totals, mixed = tokens_by_source(rows), defaultdict(int)
    for r in got:
        mixed[r.source] += r.n_tokens
    assert mixed["big"] == totals["big"]
    assert 2.9 * totals[None] <= mixed[None] <= 3 * totals[None] + 4       # the rarest source sets the exponent
    assert mixed["empty"] == 0


@pytest.mark.parametrize("target", [0.9, 1.05])
def test_entropy(make_docs, target):
    rows, docs = corpus(make_docs, odd=False)
    light = docs.select("source", mixing.tokens(F.col("text")).alias("n_tokens"))
    plan = mixing.plan(light, min_entropy=target, budget=20_000)
    t = tokens_by_source(rows)

    def entropy(a):
        w = [x ** a for x in t.values()]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    assert entropy(plan.exponent) >= target - 1e-9
    assert plan.exponent == 1 or entropy(plan.exponent + 2 / mixing.GRID) < target
    weights = {r.source: r.weight for r in plan.sources.collect()}
    w = {k: x ** plan.exponent for k, x in t.items()}
    assert all(weights[k] == pytest.approx(w[k] / sum(w.values())) for k in t)
    got = mixing.schedule(docs, min_entropy=target, budget=20_000).collect()
    mixed = defaultdict(int)
    for r in got:
        mixed[r.source] += r.n_tokens
    for k in t:
        assert mixed[k] == pytest.approx(weights[k] * 20_000, abs=40)      # to the document that reaches the quota


def test_blocks_hold_the_weights(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 3000)
    monkeypatch.setattr(mixing, "BUCKET", 500)
    _, docs = corpus(make_docs, odd=False)
    got = mixing.schedule(docs, max_repetition=2.0).collect()
    total, per = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r in got:
        total[r.source] += r.n_tokens
        per[r.block][r.source] += r.n_tokens
    assert len(per) == -(-sum(total.values()) // 3000)
    for block in per.values():
        for k, x in total.items():
            assert abs(block[k] - x / len(per)) <= 40
    seen = Counter((r.block, r.position) for r in got)
    assert max(seen.values()) == 1
    # another bucket size gives the same order
    monkeypatch.setattr(mixing, "BUCKET", 1 << 20)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.schedule(docs, max_repetition=2.0).collect()), key=str)


def test_apply_gives_the_schedule_s_documents(make_docs):
    _, docs = corpus(make_docs)
    docs = docs.withColumn("_row", docs.doc_id)
    want = Counter(r.doc_id for r in mixing.schedule(docs, max_repetition=2.5).collect())
    out = mixing.apply(docs, max_repetition=2.5)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == want


def test_small_budget_and_empty(make_docs):
    _, docs = corpus(make_docs, odd=False)
    got = mixing.schedule(docs, max_repetition=1.0, budget=3000).collect()
    assert 3000 <= sum(r.n_tokens for r in got) <= 3000 + 3 * 40
    assert max(Counter(r.doc_id for r in got).values()) == 1
    assert mixing.schedule(docs.limit(0), max_repetition=2.0).count() == 0
    assert mixing.apply(docs.limit(0), max_repetition=2.0).count() == 0
    with pytest.raises(ValueError):
        mixing.schedule(docs)
