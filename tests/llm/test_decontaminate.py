"""Winnowing against a plain search for every window."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import decontaminate
from tidemark.llm.arrow_words import ALPHANUMERIC, words

ITEM = "item_id long, text string"


def word_list(text):
    return decontaminate.WORD.findall((text or "").translate(decontaminate.UPPER_TO_LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = word_list(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i: i + n]), set()).add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = word_list(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i: i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "of", "a", "Été", "x1", "q", "zz", "mm", "İ", "中文"])
    items = [(i, " ".join(word() for _ in range(r.choice([1, 2, 3, 5, 9, 10, 11, 25])))) for i in range(12)]
    items += [(None, "null id item of eleven words here and some more words"), (50, None), (51, "!!"), (3, items[3][1])]
    docs = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(r.randint(0, 25)))]
        if i % 2:
            source = r.choice([t for _, t in items if t]).upper()
            ws = source.split()
            parts.append(" , ".join(ws[r.randint(0, len(ws) // 2):]))
        parts.append(" ".join(word() for _ in range(r.randint(0, 10))))
        docs.append((i, "; ".join(parts)))
    return docs + [(100, None), (101, ""), (None, items[7][1]), (5, docs[5][1]), (102, "word " * 30000 + items[7][1])], items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, make_docs, seed):
    docs, items = corpus(seed)
    frame = make_docs(docs).withColumnRenamed("source", "key").withColumnRenamed("n_chars", "print")
    got = decontaminate.digest(decontaminate.find(frame, spark.createDataFrame(items, ITEM)))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark, make_docs):
    docs = make_docs([(1, "a b c")])
    none = spark.createDataFrame([], ITEM)
    assert [tuple(r)[:3] for r in decontaminate.digest(decontaminate.find(docs, none)).collect()] == [(1, 3, 0)]
    assert decontaminate.find(docs.limit(0), spark.createDataFrame([(1, "a b")], ITEM)).count() == 0


def test_remove(spark, make_docs):
    docs, items = corpus(3)
    frame = make_docs(docs).withColumnRenamed("n_chars", "_contaminated_key")
    kept = decontaminate.remove(frame, spark.createDataFrame(items, ITEM))
    want = sorted((d for d, *_, bad in brute(docs, items) if not bad), key=str)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want


def test_every_long_shared_span_shares_a_fingerprint():
    r = random.Random(5)
    for span in (1, 2, 5, 9, 10):
        shared = [r.choice("abcdefgh") for _ in range(span)]
        prints = []
        for _ in range(2):
            text = " ".join([r.choice("abcdefgh") for _ in range(30)] + shared + [r.choice("abcdefgh") for _ in range(30)])
            raw = np.frombuffer(text.encode(), np.uint8)
            h, doc, _, _ = words(raw, np.array([0, len(raw)]), ALPHANUMERIC)
            g, at = decontaminate.winnow(h, doc, span)
            k, _ = decontaminate.scheme(span)
            prints.append({int(x) for x, i in zip(g, at) if 30 <= i <= 30 + span - k})
        assert prints[0] & prints[1]


def test_words_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    from tidemark.llm import arrow_words

    r = random.Random(7)
    texts = ["".join(r.choice("ab c\nÉ中") for _ in range(r.randint(0, 400))) for _ in range(30)] + ["", "x" * 500]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    whole = words(raw, offsets, arrow_words.NON_SPACE)
    monkeypatch.setattr(arrow_words, "CHUNK", 37)
    for a, b in zip(whole, words(raw, offsets, arrow_words.NON_SPACE)):
        assert a.tolist() == b.tolist()
