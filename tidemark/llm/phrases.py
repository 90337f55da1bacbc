"""Operator 13, phrase collocations, counted in the manner of a HAT-trie.

Per language, texts are lower-cased (A-Z), split into pieces and words, and every phrase of one to four words is counted.
Instead of a row for every phrase, each word position gives one *window*, the (up to) four words that begin there inside
its piece: the count of a phrase is that of the windows below its node in the trie of windows.

1. Trie. A shallow trie over word ids (64-bit hashes, in their order) splits all windows into prefix partitions of about
   equal weight: its leaves are cut at quantiles of windows from a bounded sample of texts. A frequent first word, or word
   pair, is burst over several leaves by its next words. The cuts only decide the balance, never a count.
2. Containers. A task keeps counted windows in hybrid containers, each of a language and a run of neighbouring leaves (about
   NODES runs, however many leaves): sorted blocks, in which equal windows are one entry. A container of over BURST entries,
   and over twice its first block, merges its blocks, so repeated windows collapse. When a task holds over LIMIT entries, its
   largest containers are spilled whole, each as one sorted run a leaf, until half is left.
3. Merge. The runs (compressed columns of word ids and counts) go to the task of their leaf in one exchange and are merged
   there; counts of prefixes of one to four words follow from the sorted windows. A prefix that a cut passes through is
   counted on both sides, so every leaf also returns the prefixes of its first and last window, whatever their count,
   and a small aggregation adds these up. All others are final in their leaf, and those below LEAST end there.
4. Scores. Every candidate is cut after each word and looks up both parts; candidates inside a longer one of nearly
   their count are dropped by a maximum per contained phrase. Parts that over 1 / HOT_SHARE of all lookups ask for
   are at most HOT_SHARE and are broadcast; the rest is an ordinary join. Decimal arithmetic, exact beyond 64 bits.
5. The first TOP of each language: of each of SALTS shares of a language the first TOP, then of these.

Odd cases: a null text is empty, a null lang `und`; rows of equal text count each; a null or repeated doc_id does not
matter; columns other than text and lang are not read; a language without candidates, and an empty table, give no rows.
Long texts are cut into words in slices of a few MB (one row at least), so memory follows a text's length, not the
corpus. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow_words import _LOWER, U64, buffers, slices, words
from tidemark.llm.workers import trimmed
from tidemark.session import materialize

LEAST = 30               # occurrences of a candidate
LONGEST = 4              # words
INSIDE = 80              # percent of its count at which a longer candidate drops a phrase
TOP = 2000
SALTS = 64
HOT_SHARE = 200
SAMPLED = 2000           # texts, about, from which the trie's leaves are cut
PER_LEAF = 64            # sampled windows per leaf
NODES = 32               # runs of leaves, about, that have a container of a task
BURST = 1 << 18          # entries of a container
LIMIT = 1 << 21          # entries that a task holds

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
IDS = [f"w{i + 1}" for i in range(LONGEST)]


# ---- windows -------------------------------------------------------------------------------------------------------

def _cut(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Word ids, their texts' rows, spans, and the data of a slice; whether the next word is in the same piece."""
    data, offsets = buffers(part.column("text"))
    h, doc, s, e = words(data, offsets, _WORD)
    h = np.where(h == 0, U64(1), h)
    breaks = np.cumsum(_BREAK[data], dtype=np.int32)[s] if len(s) else np.zeros(0, np.int32)
    same = np.zeros(len(h), bool)
    same[:-1] = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])
    return h, doc, s, e, data, same


def _columns(ids: np.ndarray, same: np.ndarray) -> list[np.ndarray]:
    """The windows' four columns; 0 where the piece has ended."""
    out, inside, n = [ids], same.copy(), len(ids)
    for j in range(1, LONGEST):
        w, m = np.zeros(n, ids.dtype), max(0, n - j)
        w[:m] = np.where(inside[:m], ids[j:], 0)
        out.append(w)
        inside[:m] &= same[j:]
        inside[m:] = False
    return out


def _counted(ids: list[np.ndarray], weight: np.ndarray | None, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows of small ids (under `size`) in order, with their counts."""
    bits = max(1, int(size).bit_length())
    if LONGEST * bits <= 64:
        key = ids[0].astype(U64)
        for w in ids[1:]:
            key = (key << U64(bits)) | w.astype(U64)
        order = np.argsort(key)
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
    else:
        low, high = ((ids[i].astype(U64) << U64(32)) | ids[i + 1].astype(U64) for i in (2, 0))
        order = np.lexsort((low, high))
        low, high = low[order], high[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(order))) if weight is None else (
        np.add.reduceat(weight[order], at, dtype=np.int64) if len(at) else np.zeros(0, np.int64))
    return [w[order[at]] for w in ids], count.astype(np.int64)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting: for 64-bit hashes `np.unique` builds a table, which takes far longer."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _narrow(count: np.ndarray) -> np.ndarray:
    return count.astype(np.uint32 if count.max(initial=0) < 1 << 32 else np.int64)


class Block:
    """Counted windows in order: columns of ids into a sorted list of word ids (0: none, i: the i-th), and counts."""

    def __init__(self, names: np.ndarray, ids: list[np.ndarray], count: np.ndarray):
        self.names, self.ids, self.count = names, ids, count

    def __len__(self) -> int:
        return len(self.count)

    def part(self, low: int, high: int) -> Block:
        return Block(self.names, [w[low:high] for w in self.ids], self.count[low:high])

    def tight(self) -> Block:
        """The same with the names that occur alone."""
        used = np.zeros(len(self.names) + 1, bool)
        for w in self.ids:
            used[w] = True
        used[0] = False
        place = np.cumsum(used, dtype=np.uint32)
        return Block(self.names[used[1:]], [place[w] for w in self.ids], self.count)

    def apart(self) -> Block:
        """A copy that does not keep the whole of which this is a part in memory."""
        return Block(self.names, [w.copy() for w in self.ids], _narrow(self.count))

    def dealt(self, lang: int, cuts: list[tuple]) -> Iterator[tuple[int, Block]]:
        """Its parts between the cuts that are this language's, with the number of cuts (of all) before each."""
        first = sum(c[0] < lang for c in cuts)
        edges = [0, *(self.place(c[1:]) for c in cuts if c[0] == lang), len(self)]
        for i, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
            if high > low:
                yield first + i, self.part(low, high)

    def place(self, window: tuple) -> int:
        """How many windows stand before this one."""
        low, high = 0, len(self)
        for w, own in zip(window, self.ids):           # narrow the run of equal prefixes, word by word
            at = int(np.searchsorted(self.names, U64(w))) + 1 if w else 0
            known = at == 0 or (at <= len(self.names) and int(self.names[at - 1]) == w)
            first = low + int(np.searchsorted(own[low:high], at, "left"))
            if not known:
                return first
            low, high = first, low + int(np.searchsorted(own[low:high], at, "right"))
        return low

    def packed(self) -> bytes:
        own = self.tight()
        kind = np.uint16 if len(own.names) < 1 << 16 else np.uint32
        head = np.array([len(own.names), len(own), np.dtype(kind).itemsize], np.int64)
        raw = b"".join([head.tobytes(), own.names.tobytes(), *(w.astype(kind).tobytes() for w in own.ids),
                        own.count.astype(np.int64).tobytes()])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @staticmethod
    def unpacked(blob: bytes) -> Block:
        raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
        v, n, width = np.frombuffer(raw, np.int64, 3)
        at = 24 + 8 * int(v)
        names = np.frombuffer(raw, U64, int(v), 24)
        kind = np.uint16 if width == 2 else np.uint32
        ids = [np.frombuffer(raw, kind, int(n), at + i * int(n * width)) for i in range(LONGEST)]
        return Block(names, ids, np.frombuffer(raw, np.int64, int(n), at + LONGEST * int(n * width)))


def merged(blocks: list[Block]) -> Block:
    if len(blocks) == 1:
        return blocks[0]
    blocks = [b.tight() for b in blocks]
    names = _distinct(np.concatenate([b.names for b in blocks]))
    columns = []
    maps = [np.concatenate([[0], np.searchsorted(names, b.names) + 1]).astype(np.uint32) for b in blocks]
    for i in range(LONGEST):
        columns.append(np.concatenate([m[b.ids[i]] for m, b in zip(maps, blocks)]))
    ids, count = _counted(columns, np.concatenate([b.count for b in blocks]), len(names))
    return Block(names, ids, count)


def merged_runs(runs: list[bytes]) -> Block:
    """`merged` of packed blocks, of which one is unpacked at a time."""
    names = _distinct(np.concatenate([Block.unpacked(r).names for r in runs]))
    columns, counts = [[] for _ in range(LONGEST)], []
    while runs:
        block = Block.unpacked(runs.pop())
        place = np.concatenate([[0], np.searchsorted(names, block.names) + 1]).astype(np.uint32)
        for column, own in zip(columns, block.ids):
            column.append(place[own])
        counts.append(_narrow(block.count))
    for i in range(LONGEST):
        columns[i] = np.concatenate(columns[i])
    ids, count = _counted(columns, np.concatenate(counts), len(names))
    return Block(names, ids, count)


class Trie:
    """Containers of counted windows by (language, node); a node is a run of neighbouring leaves."""

    def __init__(self, cuts: list[tuple]):
        self.cuts, self.held, self.size = cuts, {}, 0
        self.step = max(1, -(-len(cuts) // NODES))
        self.nodes = cuts[::self.step]                  # where nodes end

    def insert(self, lang: int, block: Block) -> None:
        for node, part in block.dealt(lang, self.nodes):
            held = self.held.setdefault((lang, node), [])
            held.append(part.apart())
            self.size += len(part)
            total = sum(map(len, held))
            if len(held) > 1 and total > max(BURST, 2 * len(held[0])):
                held[:] = [merged(held)]
                self.size += len(held[0]) - total

    def spilled(self, left: int) -> Iterator[tuple[int, int, bytes]]:
        """Sorted runs of the leaves of the largest containers, until at most `left` entries are held."""
        for lang, node in sorted(self.held, key=lambda k: -sum(map(len, self.held[k]))):
            if self.size <= left:
                return
            blocks = self.held.pop((lang, node))
            self.size -= sum(map(len, blocks))
            first = max(0, (node - 1) * self.step + 1)
            for leaf, part in merged(blocks).dealt(lang, self.cuts[first: node * self.step]):
                yield lang, first + leaf, part.packed()


RUNS = "word_id bigint, word string, lang_id bigint, leaf int, run binary"
KNOWN = 1 << 22          # word ids whose spelling a task remembers having given


def _spellings(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Array:
    n = e - s
    own = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s, n)
    edges = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(edges), pa.py_buffer(_LOWER[data[own]])]).cast(pa.string())


def _runs(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Spellings (word_id, word; about once a task) and sorted runs (lang_id, leaf, run) in one pass over the texts."""
    names = [c.split()[0] for c in RUNS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary()]

    def frame(length: int, /, **known) -> pa.RecordBatch:
        of = lambda v, t: v if isinstance(v, pa.Array) else pa.array(v, t)
        return pa.RecordBatch.from_arrays(
            [of(known[c], t) if c in known else pa.nulls(length, t) for c, t in zip(names, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, spelled = Trie(cuts), np.zeros(0, U64)
        for batch in batches:
            for part in slices(batch, "text"):
                lang_of = part.column("lang_id").to_numpy(zero_copy_only=False)
                h, doc, s, e, data, same = _cut(part)
                for lang in np.unique(lang_of):
                    mine = np.flatnonzero(lang_of[doc] == lang)
                    if not len(mine):
                        continue
                    found, first, inverse = np.unique(h[mine], return_index=True, return_inverse=True)
                    place = np.searchsorted(spelled, found)
                    new = np.ones(len(found), bool)
                    new[place < len(spelled)] = spelled[place[place < len(spelled)]] != found[place < len(spelled)]
                    yield frame(int(new.sum()), word_id=found[new].view(np.int64),
                                word=_spellings(data, s[mine[first[new]]], e[mine[first[new]]]))
                    spelled = np.insert(spelled, place[new], found[new]) if len(spelled) < KNOWN else found
                    windows = _columns((inverse + 1).astype(np.uint32), same[mine])
                    ids, count = _counted(windows, None, len(found))
                    trie.insert(int(lang), Block(found, ids, count))
                if trie.size > LIMIT:
                    yield from told(trie, LIMIT // 2)
        yield from told(trie, 0)

    def told(trie: Trie, left: int) -> Iterator[pa.RecordBatch]:
        for lang, leaf, blob in trie.spilled(left):
            yield frame(1, lang_id=[lang], leaf=[leaf], run=[blob])

    return rows.select("text", "lang_id").mapInArrow(trimmed(run), RUNS)


def _leaf_cuts(rows: DataFrame, leaves: int) -> list[tuple]:
    """At most leaves - 1 windows (language, four words), in order: quantiles of PER_LEAF * leaves windows, about, from
    SAMPLED texts, about. Both are bounds of our own, whatever the corpus."""
    every = max(1, rows.count() // SAMPLED)
    some = rows.where(F.pmod(F.xxhash64("text", "mark"), F.lit(every)) == 0)
    total = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    step = max(1, total // 6 // (PER_LEAF * leaves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, doc, _, _, _, same = _cut(part)
                columns = _columns(h, same)
                at = np.arange(int(h[0] % U64(step)), len(h), step) if len(h) else np.zeros(0, np.int64)
                lang = part.column("lang_id").take(pa.array(doc[at]))
                yield pa.RecordBatch.from_arrays([lang, *(pa.array(c[at].view(np.int64)) for c in columns)],
                                                 names=["lang_id", *IDS])

    found = some.select("text", "lang_id").mapInArrow(trimmed(run), "lang_id bigint, " + ", ".join(f"{w} bigint" for w in IDS)).collect()
    mask = (1 << 64) - 1
    found = sorted((r[0], *(x & mask for x in r[1:])) for r in found)
    picked = [found[i * len(found) // leaves] for i in range(1, leaves)] if found else []
    return sorted(set(picked))


def _phrase_counts(runs: DataFrame, leaves: int) -> DataFrame:
    """lang_id, w1..w4 (0: none) and f of the phrases of one to LONGEST words with f >= LEAST, and of the empty phrase,
    whose f is the number of words."""
    out = ["lang_id", *IDS, "f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}               # packed, until their language's turn
        for batch in batches:
            for lang, blob in zip(batch.column("lang_id").to_pylist(), batch.column("run")):
                held.setdefault(lang, []).append(blob.as_py())
        for lang in sorted(held):
            block = merged_runs(held.pop(lang))
            yield frame(lang, np.zeros((LONGEST, 1), np.int64), block.count.sum(keepdims=True))
            new = np.zeros(len(block), bool)
            new[0] = True
            for d in range(LONGEST):
                new[1:] |= block.ids[d][1:] != block.ids[d][:-1]
                at = np.flatnonzero(new)
                f = np.add.reduceat(block.count, at)
                keep = f >= LEAST
                keep[[0, -1]] = True                           # a cut may pass through the first and the last
                keep &= block.ids[d][at] > 0
                at, f = at[keep], f[keep]
                names = np.concatenate([[U64(0)], block.names])
                yield frame(lang, [names[block.ids[i][at]].view(np.int64) if i <= d else np.zeros(len(at), np.int64)
                                   for i in range(LONGEST)], f)

    def frame(lang: int, columns, f: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(f), lang)), *map(pa.array, columns), pa.array(f)], names=out)

    parts = runs.where("leaf is not null").select("leaf", "lang_id", "run").repartitionById(leaves, F.col("leaf"))
    found = parts.select("lang_id", "run").mapInArrow(trimmed(run), ", ".join(f"{c} bigint" for c in out))
    return found.groupBy("lang_id", *IDS).agg(F.sum("f").alias("f")).where((F.col("f") >= LEAST) | (F.col("w1") == 0))


# ---- scores --------------------------------------------------------------------------------------------------------

def _lookup(asked: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """asked JOIN known on keys (known has a row per key): keys asked for by over 1 / HOT_SHARE of the rows, of which
    there are HOT_SHARE at most, by broadcast."""
    total = asked.count()
    hot = materialize(asked.groupBy(*keys).agg(F.count("*").alias("k")).where(F.col("k") * HOT_SHARE > total).select(*keys),
                      "hot_keys")
    few = F.broadcast(materialize(known.join(F.broadcast(hot), keys), "hot_rows"))
    return asked.join(few, keys).unionByName(asked.join(F.broadcast(hot), keys, "left_anti").join(known, keys))


def _sub(low: int, high: int) -> list:
    """The columns of the phrase made of words low + 1 .. high."""
    return [(F.col(f"w{low + i + 1}") if low + i < high else F.lit(0).cast("bigint")) for i in range(LONGEST)]


def _part(low: int, high: int, **more):
    return F.struct(*[c.alias(f"x{i + 1}") for i, c in enumerate(_sub(low, high))], *[F.lit(v).alias(k) for k, v in more.items()])


def _scored(phrases: DataFrame, singles: DataFrame) -> DataFrame:
    """lang_id, w1..w4, len, a, l, r, score of every candidate, by its lowest cut."""
    keys = ["lang_id", *IDS]
    of = {n: F.array(*[_part(lo, hi, k=k, side=side) for k in range(1, n) for side, lo, hi in ((0, 0, k), (1, k, n))])
          for n in range(2, LONGEST + 1)}
    parts = F.coalesce(*[F.when(F.col("len") == n, of[n]) for n in of])
    asked = phrases.select("lang_id", *[F.col(w).alias(f"c{w}") for w in IDS], "len", F.col("f").alias("a"), F.explode(parts).alias("p"))
    asked = asked.select("lang_id", *[f"c{w}" for w in IDS], "len", "a", "p.k", "p.side",
                         *[F.col(f"p.x{i + 1}").alias(w) for i, w in enumerate(IDS)])
    known = phrases.unionByName(singles).select(*keys, F.col("f").alias("part_f"))
    met = _lookup(materialize(asked, "cuts"), known, keys)
    f = lambda k, side: F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("part_f")))
    wide = met.groupBy("lang_id", *[F.col(f"c{w}").alias(w) for w in IDS], "len", "a").agg(
        *[f(k, side).alias(f"{name}{k}") for k in range(1, LONGEST) for side, name in ((0, "l"), (1, "r"))])
    score = lambda k: F.expr(f"CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) DIV "  # noqa: E731
                             f"(CAST(l{k} AS DECIMAL(19, 0)) + CAST(r{k} AS DECIMAL(19, 0)))")
    cuts = F.array_compact(F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(
        score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)]))
    return wide.withColumn("cut", F.array_min(cuts)).select("lang_id", *IDS, "len", "a", "cut.l", "cut.r", "cut.score")


def _without_inner(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """The candidates that lie in no longer one with at least INSIDE percent of their count."""
    keys = ["lang_id", *IDS]
    inner = {n: F.array(*[_part(lo, lo + m) for m in range(2, n) for lo in range(n - m + 1)]) for n in range(3, LONGEST + 1)}
    inside = F.coalesce(*[F.when(F.col("len") == n, inner[n]) for n in inner])
    longer = phrases.where("len > 2").select("lang_id", "f", F.explode(inside).alias("p")).groupBy(
        "lang_id", *[F.col(f"p.x{i + 1}").alias(w) for i, w in enumerate(IDS)]).agg(F.max("f").alias("longer"))
    met = scored.join(longer, keys, "left")
    return met.where(F.col("longer").isNull() | (100 * F.col("longer") < INSIDE * F.col("a"))).drop("longer")


def _named(kept: DataFrame, spellings: DataFrame) -> DataFrame:
    """The candidates with their phrase as text."""
    keys = ["lang_id", *IDS]
    word = F.posexplode(F.filter(F.array(*IDS), lambda w: w != 0)).alias("pos", "word_id")
    asked = materialize(kept.select(*keys, word), "phrase_words")
    few = spellings.join(asked.select("word_id").distinct(), "word_id").dropDuplicates(["word_id"])
    spelled = _lookup(asked, materialize(few, "spelled"), ["word_id"])
    at = lambda i: F.max(F.when(F.col("pos") == i, F.col("word")))
    phrase = spelled.groupBy(*keys).agg(F.concat_ws(" ", *[at(i) for i in range(LONGEST)]).alias("phrase"))
    return kept.join(phrase, keys)


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` collocations of each language."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    rows = rows.withColumns({"lang_id": F.xxhash64("lang"), "mark": F.monotonically_increasing_id()})
    leaves = 3 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))     # small enough to merge in memory
    runs = materialize(_runs(rows, _leaf_cuts(rows, leaves)), "runs")
    size = sum((F.when(F.col(w) != 0, 1).otherwise(0) for w in IDS), F.lit(0))
    counts = materialize(_phrase_counts(runs, leaves).withColumn("len", size), "counts")
    phrases, singles = counts.where("len > 1"), counts.where("len = 1")
    langs = rows.groupBy("lang", "lang_id").agg(F.count("*").alias("texts")).select("lang", "lang_id")
    total = counts.where("len = 0").select("lang_id", F.col("f").alias("total")).join(langs, "lang_id")
    kept = materialize(_without_inner(_scored(phrases, singles), phrases), "kept")
    share = F.pmod(F.xxhash64(*IDS), F.lit(SALTS))
    best = [F.desc("score"), F.desc("a")]
    high = kept.withColumn("share", share).withColumn("rank", F.rank().over(Window.partitionBy("lang_id", "share").orderBy(*best)))
    named = _named(materialize(high.where(F.col("rank") <= top).drop("rank"), "high"),
                   runs.where("word_id is not null").select("word_id", "word"))
    order = [*best, "phrase"]
    first = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang_id", "share").orderBy(*order))).where(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang_id").orderBy(*order))).where(F.col("rank") <= top)
    return last.join(total, "lang_id").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                                              F.col("total").alias("n"), "score")
