"""Near-duplicates by odd sketches against brute force, with buckets cut finer and not, and the sketch's bounds."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.test_ngram_join import LOWER, ODD, WORD, corpus
from tidemark.llm import odd_sketch
from tidemark.llm.arrow_words import mix


def brute(rows, words=2, percent=80):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append(frozenset(zip(*[w[k:] for k in range(words)])) if len(w) >= words else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            o = len(x & sets[j])
            if x and sets[j] and 100 * o >= percent * (len(x) + len(sets[j]) - o):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    out = [(rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]
    return sorted(((*r, r[0] == r[2]) for r in out), key=str)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("seed,large", [(1, 64), (2, 2)])
def test_equals_brute_force(spark, make_docs, monkeypatch, seed, large):
    monkeypatch.setattr(odd_sketch, "LARGE", large)
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    rows = corpus(seed)
    got = odd_sketch.join(make_docs(rows)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_odd_rows(spark, make_docs):
    docs = make_docs(ODD)
    docs = docs.withColumn("n", docs.doc_id).withColumn("vid", docs.text).withColumn("band", docs.doc_id)
    got = odd_sketch.join(docs).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(ODD)
    assert odd_sketch.join(docs.limit(0)).count() == 0


def test_template_group_does_not_link(spark, make_docs):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    template = [word() for _ in range(60)]
    rows = [(i, " ".join(template + [word() for _ in range(18)])) for i in range(80)]      # about 0.61 alike
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 80, 8)]
    got = odd_sketch.join(make_docs(rows)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_blocks_find_the_pairs_that_pass():
    r = np.random.default_rng(2)
    label, n = r.integers(0, 4, 300), r.integers(80, 110, 300)
    base = r.integers(0, 1 << 62, 16).astype(np.uint64)
    sketch = np.tile(base, (300, 1))
    for row in sketch:
        for bit in r.choice(1024, r.integers(0, 90), replace=False):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    own = r.integers(0, 3, 300)
    near = lambda i, j: (label[i] != label[j] and 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j])
                         and int(np.bitwise_count(sketch[i] ^ sketch[j]).sum()) <= odd_sketch.MOST)
    got = set()
    for first in range(3):
        for second in range(first, 3):
            mine = np.flatnonzero((own == first) | (own == second))
            a, b = odd_sketch._near_within(own[mine], first, second, label[mine], n[mine], sketch[mine])
            pairs = {tuple(sorted((int(mine[i]), int(mine[j])))) for i, j in zip(a, b)}
            assert not pairs & got
            got |= pairs
    assert got == {(i, j) for i in range(300) for j in range(i + 1, 300) if near(i, j)} and got


def test_sketch_counts_bound_and_follow_the_similarity():
    r = np.random.default_rng(1)
    for share, least, most in ((0.95, 0, 60), (0.8, 10, odd_sketch.MOST), (0.3, odd_sketch.MOST, 2 * 128)):
        n = 2000
        both = int(round(2 * n * share / (1 + share)))
        common = mix(r.integers(0, 1 << 62, both).astype(np.uint64))
        x, y = (np.concatenate([common, mix(r.integers(0, 1 << 62, n - both).astype(np.uint64))]) for _ in range(2))
        low = odd_sketch.minima(np.concatenate([x, y]).view(np.int64), np.array([0, n]))
        a, b = odd_sketch.odd_sketches(low).view(np.uint8)
        differ = int(np.unpackbits(a ^ b).sum())
        samples = int((low[:, 0] != low[:, 1]).sum())
        assert differ <= 2 * samples and abs(samples / 128 - (1 - share)) < 0.17
        assert least <= differ <= most


def test_parities_drop_pairs_that_cannot_link_and_keep_those_that_do():
    r = np.random.default_rng(3)
    for n, both in ((300, 267), (300, 268), (1200, 1067), (300, 225), (900, 690)):
        common = mix(r.integers(0, 1 << 62, both).astype(np.uint64))
        x, y = (np.concatenate([common, mix(r.integers(0, 1 << 62, n - both).astype(np.uint64))]) for _ in range(2))
        parity = odd_sketch.parities(np.concatenate([x, y]).view(np.int64), np.array([0, n])).view(np.uint64)
        allowed = odd_sketch._allowed(np.array([n, n]), parity, np.array([0]), np.array([1]))
        assert allowed.tolist() == [100 * both >= 80 * (2 * n - both)]


def test_pivot_pairs_of_a_large_group_are_few_a_class(spark):
    r = random.Random(6)
    cells = [(vid, band, r.randrange(3)) for vid in r.sample(range(10 ** 6), 200) for band in range(32)]
    cells = spark.createDataFrame([(vid, 10 * band + part) for vid, band, part in cells], "vid long, band long")
    pairs = odd_sketch._pivot_pairs(cells).collect()
    assert 200 <= len(pairs) <= odd_sketch.PIVOTS * 200
    assert len({v for p in pairs for v in p}) == 200


def family(n, own, seed):
    """n texts of `own` words after 267 that all share."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(267)]
    return [" ".join(shared + [word() for _ in range(own)]) for _ in range(n)]


def test_forest_joins_what_all_edges_join():
    r = np.random.default_rng(7)
    for vertices, edges in ((1, 0), (40, 15), (40, 60), (60, 900)):
        x, y = r.integers(0, vertices, (2, edges)) * 7
        cost = r.integers(0, 20, edges)
        least = {}

        def find(v):
            while least.get(v, v) != v:
                v = least[v]
            return v

        total = 0
        for e in np.argsort(cost, kind="stable"):
            if find(x[e]) != find(y[e]):
                least[find(x[e])] = find(y[e])
                total += cost[e]
        kept = odd_sketch._forest(x, y, cost)
        trees = {v: find(v) for v in {*x.tolist(), *y.tolist()}}
        assert len(kept) == len(set(kept.tolist())) == len(trees) - len(set(trees.values())) and cost[kept].sum() == total


@pytest.mark.parametrize("own", [34, 33])
def test_near_copies_of_a_large_bucket_are_few_rows(spark, make_docs, monkeypatch, own):
    """300 shingles each, 34 of their own: 79.6 percent alike, and most pass the sketches; 33 of 299: 80.1, and all link."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    monkeypatch.setattr(odd_sketch, "BLOCK_SET", 5000)
    rows = list(enumerate(family(48, own, 8)))
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 48, 6)] + [(200, " ".join(rows[0][1].split()[:-17] + rows[1][1].split()[-17:]))]
    made = {}

    def counted(rows, blocks, met, whole=odd_sketch._by_blocks):
        out = whole(rows.cache(), blocks, met).cache()
        made[met] = (out.count(), rows.withColumn("blocks", blocks).selectExpr("coalesce(sum(blocks), 0)").first()[0])
        return out

    monkeypatch.setattr(odd_sketch, "_by_blocks", counted)
    got = odd_sketch.join(make_docs(rows)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert all(out <= 2 * dealt for out, dealt in made.values())
    assert own == 33 or {"forest", "ends", "links"} <= made.keys()


def test_block_rows_of_one_bucket_do_not_grow_with_its_square(spark):
    base = [(1 << 40) * k for k in range(16)]
    rows = [(1, vid, vid, 100, base, base) for vid in range(200)]
    rows = spark.createDataFrame(rows, "band long, vid long, label long, n long, sketch array<long>, parity array<long>")
    for met, most in (("forest", 200 * 5), ("ends", 200)):
        pairs = odd_sketch._by_blocks(rows, odd_sketch.F.lit(4).cast("bigint"), met).collect()
        assert 199 <= len(pairs) <= most
    linked = odd_sketch._by_blocks(rows.selectExpr("*", "array(vid % 2, 5L, 7L, 9L, 11L) shingles"), odd_sketch.F.lit(4).cast("bigint"), "links")
    assert 198 <= linked.count() <= 200 * 4 and linked.where("(a - b) % 2 != 0").count() == 0
