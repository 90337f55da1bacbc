"""N-gram Jaccard join against brute force, with the dense path forced and not."""

from __future__ import annotations

import random
import re

import pytest

from tidemark.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sets_of(rows):
    out = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out.append(frozenset(zip(*[w[k:] for k in range(4)])) if len(w) >= 4 else frozenset([tuple(w)] if w else []))
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            o = len(x & sets[j])
            if x and sets[j] and 100 * o >= 85 * (len(x) + len(sets[j]) - o):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))),
                  key=str)


def corpus(seed, size=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 6)))
    passage = [word() for _ in range(30)]
    rows, n = [], 0

    def add(ws):
        nonlocal n
        n += 1
        rows.append((n * 3, " ".join(ws)))

    base = [word() for _ in range(100)]
    for _ in range(size):                     # near copies with few and many edits, some edits shared
        ws = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 2, 3, 4, 8])):
            ws[r.randrange(0, 100, r.choice([1, 10]))] = word()
        add(ws)
    for _ in range(size // 2):                # a passage in texts that differ otherwise, some mostly the passage
        add(passage + [word() for _ in range(r.choice([3, 8, 60]))])
    for _ in range(size // 3):
        add([word() for _ in range(r.randint(1, 60))])
    for _ in range(size // 3):                # copies, with case and white space changed
        i = r.randrange(len(rows))
        rows.append((1000 + len(rows), "\n ".join(rows[i][1].split()).upper()))
    for i in range(6):                        # short texts, equal and not
        rows.append((2000 + i, ["a", "a b", "a b c", "a b c", "a b c d", "A  b"][i]))
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 2), (2, 8), (3, 32)])
def test_equals_brute_force(spark, make_docs, monkeypatch, seed, hot):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rows = corpus(seed)
    got = ngram_join.join(make_docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


ODD = [(1, None), (2, ""), (3, " \n"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "A B\tc d e f"),
       (None, "x y z w"), (None, "X y z w"), (None, None), (7, "only"), (7, "another text of words"), (9, "word " * 4000),
       (10, "word " * 3999)]


def test_odd_rows(spark, make_docs):
    docs = make_docs(ODD)
    docs = docs.withColumn("n", docs.doc_id).withColumn("vid", docs.text).withColumn("s", docs.doc_id)
    got = ngram_join.join(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(ODD)
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_keep_one(spark, make_docs):
    docs = make_docs(ODD)
    docs = docs.withColumn("component_id", docs.doc_id).withColumn("_id", docs.doc_id)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [r for r in got if r[0] is not None] == sorted(
        [(1, None), (2, ""), (3, " \n"), (4, "a b c d e f"), (7, "only"), (7, "another text of words"),
         (9, "word " * 4000)], key=str)
    assert sorted(str(t).lower() for i, t in got if i is None) == ["none", "x y z w"]


def test_keep_one_plain_ids(spark, make_docs):
    rows = corpus(4, 30)
    want = {c for _, _, c in brute(rows)}
    assert {r.doc_id for r in ngram_join.keep_one(make_docs(rows)).collect()} == want
