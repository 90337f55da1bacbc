"""Conversation prefix trie against brute force, with the list ranked by rounds and in one task."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = told.get(base, [])[:h] + own[h:]
    members = {}
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in below)
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])),
                   leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(full[c]) == len(node)).encode()).hexdigest())
                  for node, m in members.items())


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie.build(df, **kw).select(*NAMES).collect()
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == sorted(brute(rows), key=lambda r: r[:2])


def made(seed, n):
    r, rows = random.Random(seed), []
    for c in range(n):
        if c % 7 == 5:
            continue
        for t in range(r.randint(1, 12)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "b", "höhe " * 3, ""])))
    return rows


@pytest.mark.parametrize("seed,rest", [(1, 60), (2, 1 << 14)])
def test_equals_brute_force(spark, seed, rest):
    check(spark, made(seed, 40), rest=rest)


def test_hot_conversation_first_turn_and_copies(spark):
    rows = [(10, t, "user", f"turn {t}") for t in range(300)]                       # a third of all rows
    rows += [(c, 0, "system", "same opening") for c in range(20, 170)]              # one first turn, copies
    rows += [(c, 1, "user", f"own {c}") for c in range(20, 170, 2)]
    rows += [(c, t, "user", "x") for c in range(300, 340) for t in range(6)]
    check(spark, rows, rest=200)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (3, None, "user", "no turn"), (3, 0, None, None), (3, 0, "user", "b"), (3, 0, "user", "a"),
            (3, 0, "user", "a"), (-7, 1, "user", "negative"), (-5, 1, "user", "negative"), (-7, 2, "user", "z"),
            (4, 0, "a", "bc"), (4, 1, "ab", "c"), (2**62, 0, "u", "long " * 5000), (9, 0, "user", "x")]
    rows += [(100 + c, t, "user", str(t)) for c in range(3) for t in range(10)]
    check(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert prefix_trie.build(df.limit(0)).count() == 0
    more = df.withColumn("depth", df.turn).withColumn("pos", df.turn).withColumn("n", df.text)
    assert prefix_trie.build(more).count() == len(brute(rows))
