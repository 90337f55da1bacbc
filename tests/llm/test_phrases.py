"""Phrase collocations against brute force, with leaves cut through phrases and containers burst and spilled."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, top=2000):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            counts.update(tuple(ws[i:i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        cands = {g: a for g, a in counts.items() if len(g) > 1 and a >= 30}
        inside = Counter()
        for g, a in cands.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    inside[g[i:i + m]] = max(inside[g[i:i + m]], a)
        for g, a in cands.items():
            score, _, l, r = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]])
                                 for k in range(1, len(g)))
            if 100 * inside[g] < 80 * a:
                found.append((-score, -a, " ".join(g).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def made(seed, n=300):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Über", "naïve", "日本", "it's", "A-B"]
    fixed = [[r.choice(vocabulary) for _ in range(k)] for k in (2, 3, 4, 5, 7)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(r.randint(0, 25)):
            ws += r.choice(fixed) if r.random() < 0.4 else [r.choice(vocabulary)]
            if r.random() < 0.2:
                ws.append(r.choice([".", ",", "\n", "!?", "\t", " : "]))
        rows.append((i, " ".join(ws), r.choice(["en", "en", "de", None])))
    rows += [(1000 + i, "hot pair " + r.choice(vocabulary) + " " + r.choice(vocabulary), "en") for i in range(n)]
    return rows


SCHEMA = "doc_id long, text string, lang string"


def got(df, **kw):
    return sorted(map(tuple, phrases.mine(df, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_equals_brute_force(spark, monkeypatch, seed, small):
    if small:        # containers that merge and spill all the time; few rows of either kind in a hot lookup
        monkeypatch.setattr(phrases, "HOT_SHARE", 3)
    rows = made(seed)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_first_of_each_language(spark):
    rows = made(3)
    assert got(spark.createDataFrame(rows, SCHEMA), top=7) == brute(rows, 7)


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (2, " .,;:!?\n\t", "en"), (3, "a b " * 20000, None), (3, "a b " * 20000, None),
            (4, "x", "de"), (5, "c d", "fr")] + [(6, "c d", "fr")] * 29 + [(7, "word" * 100000 + " b", "en")]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumn("word", df.text).withColumn("leaf", df.doc_id).withColumn("n", df.doc_id).withColumn("w1", df.doc_id)
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []


def test_trie_spills_and_bursts_without_losing_a_count(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 50)
    r = np.random.default_rng(4)
    words = np.unique(r.integers(1, 1 << 63, 12).astype(np.uint64))
    want, trie, runs = Counter(), None, []
    cuts = sorted((int(k), *(int(x) for x in r.choice(words, 4))) for k in (7, 7, 7, 9))
    trie = phrases.Trie(cuts)
    for lang in (7, 9, 7, 9, 7):
        ids = r.integers(1, len(words) + 1, 200).astype(np.uint32)
        columns = phrases._columns(ids, r.random(200) < 0.8)
        names = np.concatenate([[np.uint64(0)], words])
        want.update((lang, *(int(names[c[i]]) for c in columns)) for i in range(200))
        trie.insert(lang, phrases.Block(words, *phrases._counted(columns, None, len(words))))
        runs += list(trie.spilled(100))
        assert trie.size <= 100
    runs += list(trie.spilled(0))
    assert trie.size == 0 and not trie.held
    have = Counter()
    for lang, leaf, blob in runs:
        block = phrases.Block.unpacked(blob)
        names = np.concatenate([[np.uint64(0)], block.names])
        windows = [tuple(int(names[c[i]]) for c in block.ids) for i in range(len(block))]
        assert windows == sorted(set(windows))
        for w, n in zip(windows, block.count):
            assert leaf == sum(c <= (lang, *w) for c in cuts)
            have[(lang, *w)] += int(n)
    assert have == want


def test_containers_and_names_do_not_grow_with_the_leaves():
    r = np.random.default_rng(5)
    words = np.unique(r.integers(1, 1 << 63, 500).astype(np.uint64))
    cuts = sorted((int(k), *(int(x) for x in r.choice(words, 4))) for k in r.choice([7, 8, 9], 1000))
    trie, want = phrases.Trie(cuts), Counter()
    for lang in (7, 9, 7):
        columns = phrases._columns(r.integers(1, len(words) + 1, 5000).astype(np.uint32), r.random(5000) < 0.8)
        names = np.concatenate([[np.uint64(0)], words])
        want.update((lang, *(int(names[c[i]]) for c in columns)) for i in range(5000))
        trie.insert(lang, phrases.Block(words, *phrases._counted(columns, None, len(words))))
    assert len(trie.held) <= 2 * (phrases.NODES + 1)
    have = Counter()
    for lang, leaf, blob in trie.spilled(0):
        block = phrases.Block.unpacked(blob)
        assert set(block.names) == {block.names[i - 1] for w in block.ids for i in w if i}
        names = np.concatenate([[np.uint64(0)], block.names])
        for i, n in enumerate(block.count):
            w = tuple(int(names[c[i]]) for c in block.ids)
            assert leaf == sum(c <= (lang, *w) for c in cuts)
            have[(lang, *w)] += int(n)
    assert have == want
