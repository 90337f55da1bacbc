"""Operator 12, MinHash near-duplicates with odd sketches.

A document's set holds its distinct two-word shingles; two documents link when 100 * overlap >= 80 * union. Documents
of equal sets are one class (128-bit digest), so exact copies never meet each other.

1. One pass over the texts: SAMPLES minima of keyed hashes of each set; BANDS bands of BAND minima each, hashed; and the
   odd sketch, BITS parity bits: every sample (its number and minimum) flips the bit that its hash names. Two sketches
   differ in at most two bits for every sample in which the sets differ, so the population count of their exclusive-or
   is a lower bound on twice the number of differing samples, and a sharp one: few samples collide in a bit. Likewise the
   set's own parity, where every shingle flips a bit: it differs in at most as many bits as shingles are in one set only,
   and two linked sets have at most a ninth of n + m of those, so this second bound loses no link.
2. Bands. Classes of one band value are a bucket. At a similarity of 0.8 a pair shares a band with probability
   1 - (1 - 0.8**4)**32, all but 5e-8; more similar pairs are surer.
3. Pivots. A bucket's pivots are its smallest and largest class number (numbers are random); every class is paired with
   the PIVOTS of its buckets' pivots that it shares most bands with, so a large group of near copies costs a few pairs a
   class. Candidates pass the odd sketch if the count is
   at most MOST bits: a pair at 0.8 exceeds that (56 of 128 samples differing, 25.6 expected) once in 1e8, and if the parities allow it. What passes is
   checked on the whole sets; links give components.
4. Rest. In a bucket that still holds several components, classes of different components are compared: in buckets of up
   to LARGE classes as pairs of the classes outside the largest component with all others, in larger ones (near copies,
   texts that share a template) by blocks. A large bucket is dealt into blocks of about BLOCK classes, every two blocks
   meet in a task, and their sketches are compared as a matrix. First, of the pairs that pass, a spanning forest of the
   components in the two blocks becomes rows (of 64 classes after the other, the nearest pairs first; what the forest has
   joined is not compared again), with all classes of the components it joins; what of these pairs links is one component
   from then on. Then those classes alone, in the buckets where they still differ, are met by
   blocks again: who still passes with another component's, and, now with their whole sets, who links. Every pair that
   passes is decided there, unless its components are one by then; a forest of the links becomes rows. The comparisons of a bucket grow with the square of its size (a few nanoseconds
   each, some microseconds if they pass but do not link), its rows by its size times its blocks. Pairs that pass are
   never rows.
5. Every link is confirmed on the whole sets; components of all links by contraction (`components.py`).

Spark scale: shuffles carry band rows (16 bytes, 32 a class), sketches and parities (128 bytes each) of classes in
candidate pairs or mixed large buckets, and whole sets of classes that pass the sketch. No pair of classes already in one
component is ever made, but for the pivots.

Odd cases: null and word-less texts have an empty set, link with nothing and are their own component; a text of one word
has that word as its one shingle; rows of equal sets are in one component; repeated rows each get a row; rows without a
doc_id take part, a component of such rows alone has a null component_id and is `kept`; columns other than the id and
the text are not read; an empty table gives no rows. A long text is hashed in slices of a few MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import shingles
from tidemark.llm.arrow_words import GOLDEN, U64, mix
from tidemark.llm.components import components
from tidemark.llm.workers import trimmed
from tidemark.session import materialize

WORDS, PERCENT = 2, 80
SAMPLES, BAND = 128, 4
BANDS = SAMPLES // BAND
BITS = 1024              # of an odd sketch
MOST = 110               # differing bits of a candidate, at most
PIVOTS = 4               # of a class
LARGE = 8                # classes of a bucket over which it is compared by blocks
BLOCK = 2048             # classes of a block
BLOCK_SET = 1 << 18      # shingles of a block, about, where whole sets meet
ROWS = 2048              # sets whose sketches are built together

_SEEDS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=U64) * GOLDEN)
_FLIP = (_SEEDS[:SAMPLES] >> U64(32)).astype(np.uint32)
_TIMES = (_SEEDS[SAMPLES:] >> U64(32)).astype(np.uint32) | np.uint32(1)


def minima(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(sample, set) minima of sets of 64-bit hashes that begin at `first`; none is empty."""
    short = (g.view(U64) >> U64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat((short ^ a) * b, first) for a, b in zip(_FLIP, _TIMES)])


def band_hashes(least: np.ndarray) -> np.ndarray:
    """(set, band) hashes of the bands' minima; the band's number is part of it."""
    h = np.repeat((np.arange(BANDS, dtype=U64) + U64(1))[:, None] * GOLDEN, least.shape[1], axis=1)
    for j in range(BAND):
        h = mix(h ^ least[j::BAND].astype(U64)) + U64(j)
    return np.ascontiguousarray(h.T).view(np.int64)


def odd_sketches(least: np.ndarray) -> np.ndarray:
    """(set, word of 64 bits): the parity of the samples that fall on each bit."""
    n = least.shape[1]
    number = (np.arange(SAMPLES, dtype=U64)[:, None] << U64(32))
    place = (mix(least.astype(U64) | number) >> U64(64 - (BITS.bit_length() - 1))).astype(np.int64)
    flips = np.bincount((place + np.arange(n) * BITS).ravel(), minlength=n * BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, BITS), axis=1).view(np.int64)


def parities(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(set, word of 64 bits): the parity of the shingles that fall on each bit; sets as in `minima`."""
    own = np.repeat(np.arange(len(first)), np.diff(first, append=len(g)))
    place = (mix(g.view(U64) ^ _SEEDS[0]) >> U64(64 - (BITS.bit_length() - 1))).astype(np.int64)
    flips = np.bincount(place + own * BITS, minlength=len(first) * BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(-1, BITS), axis=1).view(np.int64)


def _signatures(rows: DataFrame) -> DataFrame:
    """doc_id, n, d1, d2, home, bands, sketch and parity of every row (the last three null for an empty set)."""
    def listed(values: np.ndarray) -> pa.Array:
        n, width = values.shape
        return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(values.ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n, d1, d2, first, g in shingles.sets(batch, WORDS):
                for at in range(0, part.num_rows, ROWS):
                    yield signed(part, n, d1, d2, first, g, slice(at, min(at + ROWS, part.num_rows)))

    def signed(part, n, d1, d2, first, g, own) -> pa.RecordBatch:
        some = n[own] > 0
        bands, sketch = np.zeros((0, BANDS), np.int64), np.zeros((0, BITS // 64), np.int64)
        parity = sketch
        if some.any():
            low = first[own][some][0]
            high = (first[own] + n[own])[some][-1]
            least = minima(g[low:high], first[own][some] - low)
            bands, sketch = band_hashes(least), odd_sketches(least)
            parity = parities(g[low:high], first[own][some] - low)
        place = pa.array(np.where(some, np.cumsum(some) - 1, 0), mask=~some)
        slice_ = part.slice(own.start, own.stop - own.start)
        return pa.RecordBatch.from_arrays(
            [slice_.column("doc_id"), *(pa.array(x[own]) for x in (n, d1, d2)), slice_.column("home"),
             *(listed(x).take(place) for x in (bands, sketch, parity))],
            names=["doc_id", "n", "d1", "d2", "home", "bands", "sketch", "parity"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "home").mapInArrow(
        trimmed(run), f"doc_id {id_type}, n bigint, d1 bigint, d2 bigint, home bigint, bands array<bigint>, "
                      "sketch array<bigint>, parity array<bigint>")


# ---- candidates ----------------------------------------------------------------------------------------------------

def _near_in_size(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def by_sketch(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) near in size whose sketches differ in MOST bits at most and whose parities allow a link."""
    one = classes.select(F.col("vid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"), F.col("parity").alias("p"))
    two = classes.select(F.col("vid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"), F.col("parity").alias("q"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").where(_near_in_size(F.col("na"), F.col("nb")))
    allowed = (100 + PERCENT) * differing("p", "q") <= (100 - PERCENT) * (F.col("na") + F.col("nb"))
    return both.where((differing("x", "y") <= MOST) & allowed).select("a", "b")


def differing(x: str, y: str) -> Column:
    """The population count of the exclusive-or of two sketches."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, k: total + k)


def _pivot_pairs(cells: DataFrame) -> DataFrame:
    """Every class with the smallest and largest of its buckets: the PIVOTS of them with which it shares most."""
    ends = cells.groupBy("band").agg(F.min("vid").alias("low"), F.max("vid").alias("high")).where("low < high")
    met = cells.join(ends, "band").select("vid", F.explode(F.array("low", "high")).alias("pivot")).where("vid != pivot")
    counted = met.repartition("vid").groupBy("vid", "pivot").agg(F.count("*").alias("shared"))
    first = Window.partitionBy("vid").orderBy(F.desc("shared"), "pivot")
    chosen = counted.withColumn("place", F.row_number().over(first)).where(F.col("place") <= PIVOTS)
    return chosen.select(*_ordered("vid", "pivot")).distinct()


def _several(rows: DataFrame, key: str) -> DataFrame:
    """The rows of buckets with several components, with the bucket's size and its largest component."""
    sizes = rows.groupBy(key, "label").agg(F.count("*").alias("k"))
    mixed = sizes.groupBy(key).agg(F.max_by("label", "k").alias("largest"), F.sum("k").alias("size"),
                                   F.count("*").alias("labels")).where("labels > 1").drop("labels")
    return rows.join(mixed, key)


def _cross_pairs(rows: DataFrame, key: str) -> DataFrame:
    """Pairs of a bucket in different components: all rows against those outside the largest component."""
    others = rows.where("label != largest").select(key, F.col("vid").alias("other"), F.col("label").alias("other_label"))
    once = (F.col("label") == F.col("largest")) | (F.col("vid") > F.col("other"))
    met = rows.join(others, key).where((F.col("label") != F.col("other_label")) & once)
    return met.select(*_ordered("vid", "other")).distinct()


def _near_within(own: np.ndarray, first: int, second: int, label, n, sketch,
                 part: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of two blocks (or of one) in different components, near in size and by their sketches; `part`:
    of these rows of the first block."""
    left, right = np.flatnonzero(own == first)[part], np.flatnonzero(own == second)
    found = [(np.zeros(0, np.int64),) * 2]
    for at in range(0, len(left), 64):
        x = left[at: at + 64]
        most = np.maximum(n[x][:, None], n[right])
        fits = (label[x][:, None] != label[right]) & (100 * np.minimum(n[x][:, None], n[right]) >= PERCENT * most)
        if first == second:
            fits &= x[:, None] < right
        i, j = np.nonzero(fits)
        for to in range(0, len(i), 1 << 16):
            a, b = x[i[to: to + (1 << 16)]], right[j[to: to + (1 << 16)]]
            near = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64) <= MOST
            found.append((a[near], b[near]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _parity_bits(parity: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits the parities of pairs differ in."""
    parts = [np.zeros(0, np.int64)]
    for at in range(0, len(a), 1 << 16):
        x, y = a[at: at + (1 << 16)], b[at: at + (1 << 16)]
        parts.append(np.bitwise_count(parity[x] ^ parity[y]).sum(axis=1, dtype=np.int64))
    return np.concatenate(parts)


def _allowed(n: np.ndarray, parity: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the parities of pairs allow a link."""
    return (100 + PERCENT) * _parity_bits(parity, a, b) <= (100 - PERCENT) * (n[a] + n[b])


def _forest(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Places of the edges (x, y) that make a least spanning forest: in rounds, the first edge of every tree so far."""
    order = np.argsort(cost, kind="stable")
    names, ends = np.unique(np.concatenate([x[order], y[order]]), return_inverse=True)
    left, right = ends[: len(x)], ends[len(x):]
    rank, chosen = np.arange(len(x)), [np.zeros(0, np.int64)]
    while len(apart := np.flatnonzero(left != right)):
        left, right, rank = left[apart], right[apart], rank[apart]
        first = np.full(len(names), len(left))
        for own in (left, right):
            mine = np.full(len(names), len(left))
            mine[own[::-1]] = np.arange(len(own))[::-1]          # the last value given stays: the first edge
            first = np.minimum(first, mine)
        trees = np.flatnonzero(first < len(left))
        picked = first[trees]
        chosen.append(np.unique(rank[picked]))
        to = np.arange(len(names))
        to[trees] = left[picked] + right[picked] - trees
        both = (to[to] == np.arange(len(names))) & (np.arange(len(names)) < to)     # two trees that pick one edge
        to[both] = np.flatnonzero(both)
        while (to != to[to]).any():
            to = to[to]
        left, right = to[left], to[right]
    return order[np.concatenate(chosen)]


def _linked(a: np.ndarray, b: np.ndarray, label: np.ndarray, sets: list[np.ndarray], root: dict[int, int]) -> list[int]:
    """Places of the pairs (a, b) that link by their whole, sorted sets, but those whose components are one by then, as
    `root` tells, which is kept up."""
    def find(v: int) -> int:
        while (up := root.get(v, v)) != v:
            root[v] = v = root.get(up, up)
        return v

    found = []
    for at, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        one, two = find(int(label[i])), find(int(label[j]))
        if one != two:
            x, y = sets[i], sets[j]
            place = np.searchsorted(y, x)
            overlap = int((y[np.minimum(place, len(y) - 1)] == x).sum())
            if (100 + PERCENT) * overlap >= PERCENT * (len(x) + len(y)):
                root[one] = two
                found.append(at)
    return found


def _joined(tree: np.ndarray, a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The trees (under `count`) of rows, when those of a and b have become one."""
    to = np.arange(count)
    for x, y in zip(tree[a].tolist(), tree[b].tolist()):
        while to[x] != x:
            x = to[x]
        while to[y] != y:
            y = to[y]
        to[x] = y
    while (to != to[to]).any():
        to = to[to]
    return to[tree]


def _by_blocks(rows: DataFrame, blocks: Column, met: str) -> DataFrame:
    """Buckets (rows: band, vid, label, n, sketch, parity; shingles) in blocks, every two of which meet in a task. Of the
    pairs that pass, `met` is the `ends` (band, a), a `forest` of the components (a, b) and the ends, or the `links` (a, b)."""
    columns = ["vid", "label", "n", "own", "sketch", "parity"] + ["shingles"] * (met == "links")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("vid", "band"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    rows = rows.select("band", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []                                     # the rows of the last block pair, which may go on
        for batch in batches:
            if batch.num_rows:
                keys = np.stack([batch.column(c).to_numpy() for c in ("band", "first", "second")])
                cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
                for low, high in zip(cuts[:-1], cuts[1:]):
                    if held and any(held[0].column(i)[0].as_py() != keys[i, low] for i in range(3)):
                        yield compared(pa.Table.from_batches(held))
                        held = []
                    held.append(batch.slice(low, high - low))
        if held:
            yield compared(pa.Table.from_batches(held))

    def compared(table: pa.Table) -> pa.RecordBatch:
        band, first, second = (table.column(c)[0].as_py() for c in ("band", "first", "second"))
        vid, label, n, own = (table.column(c).to_numpy() for c in columns[:4])
        sketch, parity = (table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
                          .reshape(-1, BITS // 64).view(U64) for c in ("sketch", "parity"))
        sets, root, ends, kept = [], {}, np.zeros(len(vid), bool), (np.zeros(0, np.int64),) * 2
        names, at_first, now = np.unique(label, return_index=True, return_inverse=True)     # now: trees of the forest
        if met == "links":
            lists = table.column("shingles").combine_chunks()
            edges, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            sets = [values[low:high] for low, high in zip(edges[:-1], edges[1:])]
        for at in range(0, int((own == first).sum()), 64):
            a, b = _near_within(own, first, second, now, n, sketch, slice(at, at + 64))
            allowed = _allowed(n, parity, a, b)
            a, b = a[allowed], b[allowed]
            far = _parity_bits(parity, a, b) / (n[a] + n[b])
            ends[a] = ends[b] = True
            if met != "ends" and len(a):
                near = np.argsort(far, kind="stable")
                picked = near[_linked(a[near], b[near], label, sets, root)] if sets else _forest(now[a], now[b], far)
                kept = tuple(np.concatenate([x, y[picked]]) for x, y in zip(kept, (a, b)))
                now = _joined(now, a[picked], b[picked], len(names))
        if met == "forest":
            ends = np.bincount(now[at_first], minlength=len(names))[now] > 1
        a, b = (vid[x] for x in kept)
        own_ends = vid[ends] if met != "links" else vid[:0]
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([none(len(a)), pa.array(np.full(len(own_ends), band, np.int64))]),
             pa.array(np.concatenate([np.minimum(a, b), own_ends])),
             pa.concat_arrays([pa.array(np.maximum(a, b)), none(len(own_ends))])], names=["band", "a", "b"])

    paired = rows.repartition("band", "first", "second").sortWithinPartitions("band", "first", "second")
    return paired.mapInArrow(trimmed(run), "band bigint, a bigint, b bigint").distinct()


def _ends(met: DataFrame) -> DataFrame:
    return met.where("band IS NOT NULL").select("band", F.col("a").alias("vid"))


def _sketched(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of mixed buckets with what is compared of them."""
    return mixed.select("band", "vid", "label", "size").join(classes.select("vid", "n", "sketch", "parity"), "vid")


def _nearest(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """Of large buckets: a forest of the pairs of different components that pass, and the classes of what it joins."""
    large = mixed.where(F.col("size") > LARGE)
    return materialize(_by_blocks(_sketched(large, classes), shingles.ceil_div(F.col("size"), BLOCK), "forest"), "nearest")


def _rest_pairs(mixed: DataFrame, nearest: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs of different components: all those of small buckets, the nearest of large ones."""
    small = _cross_pairs(mixed.where(F.col("size") <= LARGE), "band")
    large = nearest.where("band IS NULL").select("a", "b")
    return small.unionByName(large).distinct().join(tried, ["a", "b"], "left_anti")


def _last_links(ends: DataFrame, rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Links of all pairs of different components among `ends` (band, vid), confirmed where two blocks meet."""
    named = ends.join(labels, "vid", "left").withColumn("label", F.coalesce("label", "vid"))
    sketched = _sketched(materialize(_several(named, "band"), "last_buckets"), classes)
    still = materialize(_by_blocks(sketched, shingles.ceil_div(F.col("size"), BLOCK), "ends"), "last_ends")
    if still.isEmpty():
        return still.select("a", "b")
    still = _ends(still)
    whole = shingles.whole_sets(rows, classes, still.select("vid").distinct(), WORDS).select("vid", "shingles")
    own = sketched.drop("size").join(still, ["band", "vid"])
    sizes = own.groupBy("band").agg(F.count("*").alias("size"), F.sum("n").alias("shingled"))
    blocks = F.greatest(shingles.ceil_div(F.col("size"), BLOCK), shingles.ceil_div(F.col("shingled"), BLOCK_SET))
    return materialize(_by_blocks(own.join(sizes, "band").join(whole, "vid"), blocks, "links").select("a", "b"), "last_links")


def _confirmed(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    likely = materialize(by_sketch(pairs, classes), "likely_pairs")
    ends = likely.select(F.explode(F.array("a", "b")).alias("vid")).distinct()
    return materialize(shingles.verified(likely, shingles.whole_sets(rows, classes, ends, WORDS), PERCENT), "links")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row; d1, d2 (digest of the set) and label (of the component,
    null for an empty set)."""
    rows = shingles.rows_of(docs, id_col, text_col)
    members = materialize(_signatures(rows), "members")
    classes = members.where("n > 0").drop("doc_id").dropDuplicates(["d1", "d2"])
    classes = materialize(classes.withColumn("vid", F.xxhash64(F.monotonically_increasing_id())), "classes")
    cells = materialize(classes.select("vid", F.explode("bands").alias("band")), "cells")
    tried = materialize(_pivot_pairs(cells), "pivot_pairs")
    links = _confirmed(tried, rows, classes)
    labels = components(links).withColumnRenamed("v", "vid")
    named = classes.join(labels, "vid", "left").select("vid", F.coalesce("label", "vid").alias("label"), F.explode("bands").alias("band"))
    mixed = materialize(_several(named, "band"), "mixed_buckets")
    nearest = _nearest(mixed, classes)
    rest = materialize(_rest_pairs(mixed, nearest, tried), "rest_pairs")
    if not rest.isEmpty():
        links = links.unionByName(_confirmed(rest, rows, classes))
        labels = components(links).withColumnRenamed("v", "vid")
    ends = _ends(nearest)
    last = _last_links(ends, rows, classes, labels) if not ends.isEmpty() else ends.selectExpr("vid a", "vid b")
    if not last.isEmpty():
        links = links.unionByName(last)
        labels = components(links).withColumnRenamed("v", "vid")
    found = shingles.with_components(members, classes, labels.withColumnRenamed("vid", "v"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
