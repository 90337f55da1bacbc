"""Operator 7, n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself.

A document's set holds its distinct word shingles (64-bit hashes). Documents with equal sets are one *class* (a
128-bit digest of the set), so groups of exact copies never meet each other. Two classes of n and m shingles link when
100 * overlap >= 85 * union, that is when the overlap reaches a(n, m) = ceil(85 * (n + m) / 185).

Bounds that follow from the sizes. Put the shingles of all documents into one common order. If a pair reaches a(n, m),
its first common shingle stands among the first n - a(n, m) + 1 of the one and m - a(n, m) + 1 of the other. As
a(n, m) >= 0.85 * max(n, m), only the first p(n) = n - ceil(0.85 n) + 1 shingles of a document, its prefix, can matter,
and with c common shingles in both prefixes the overlap is at most c + max(n - p(n), m - p(m)).

The blocks of the product:
1. Order: shingles by hash, but *hot* ones last: those that more than HOT classes hold among their smallest hashes
   (a quarter more than a prefix, the "low" part; all low parts of all documents are counted). Classes whose low part
   has enough other shingles have their whole prefix there; a shingle of it is shared by HOT classes at most, so the
   columns are short, and their products are accumulated pair by pair and cut by the bounds.
2. The rest, *dense* classes, are made of hot shingles (large groups of near copies, texts that are mostly a shared
   passage). Their prefixes are recomputed from their whole sets in an order of their own, rarest first by exact
   counts among dense classes. In a column of it every class is first compared with the class that holds most shared
   shingles (the middle of a group of near copies); what links is one component, and only pairs of *different*
   components are then emitted. So a large group costs pairs in proportion to its size, and none is left out.
3. Dense against other classes: the prefixes of the others against the whole sets of the dense ones.

Every surviving pair is checked on the whole sets. Components are found by contraction (`components.py`).

Spark scale: shuffles carry low parts (about a fifth of the shingles), counts and pairs; whole sets are shuffled only
for classes in a surviving pair. Bitmaps of fixed size (BITMAP bits at most, whatever the corpus) only keep rows that
could match from being shuffled; a join decides.

Odd cases: null and word-less texts have an empty set, link with nothing and are their own component; a text of fewer
words than a shingle has its whole sequence as its one shingle; rows of equal text are in one component, so are rows
that share a doc_id only if their sets link; a component of rows without any doc_id has a null component_id; repeated
rows each get a row; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm import shingles
from tidemark.llm.arrow_words import U64
from tidemark.llm.components import components
from tidemark.llm.workers import trimmed
from tidemark.session import materialize

WORDS = 4                # words of a shingle
PERCENT = 85
HOT = 32                 # classes with a shingle in their low parts, over which it is hot


# ---- sets ------------------------------------------------------------------------------------------------------

def prefix_size(n):
    """p(n), for numpy integers and for columns."""
    return n - shingles.ceil_div(PERCENT * n, 100) + 1


def needed(n: Column, m: Column) -> Column:
    """a(n, m)."""
    return shingles.needed(n, m, PERCENT)


def low_size(n: np.ndarray) -> np.ndarray:
    p = prefix_size(n)
    return np.minimum(n, p + p // 4 + 8)


def _members(rows: DataFrame) -> DataFrame:
    """doc_id, n, d1, d2, home (a hash of the row's id) and low (its smallest shingles) of every row, in one pass over
    the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n, d1, d2, first, g in shingles.sets(batch, WORDS):
                low = np.where(n > 0, low_size(np.maximum(n, 1)), 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, (n, d1, d2)), part.column("home"), shingles.lists(g, first, low)],
                    names=["doc_id", "n", "d1", "d2", "home", "low"])
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "home").mapInArrow(
        trimmed(run), f"doc_id {id_type}, n bigint, d1 bigint, d2 bigint, home bigint, low array<bigint>")


def _low_rows(classes: DataFrame, among: DataFrame) -> DataFrame:
    """vid, n, low_n, pos, s for the low parts' shingles that are among `among` (column s)."""
    bits = shingles.bitmap_size(among.count())
    shared = shingles.bits(classes.sparkSession, bits, among.select(F.xxhash64("s").alias("h")))
    # the bitmap is of a hash of s, since low shingles are small numbers
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = pc.list_flatten(batch.column("low")).to_numpy(zero_copy_only=False)
            own = pc.list_parent_indices(batch.column("low")).to_numpy(zero_copy_only=False)
            lens = pc.list_value_length(batch.column("low")).to_numpy(zero_copy_only=False).astype(np.int64)
            pos = np.arange(len(s)) - np.repeat(np.cumsum(lens) - lens, lens)
            hit = np.flatnonzero(shingles.has(shared.value, bits, _xxhash64(s)))
            own = own[hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vid").take(pa.array(own)), batch.column("n").take(pa.array(own)), pa.array(lens[own]),
                 pa.array(pos[hit]), pa.array(s[hit])], names=["vid", "n", "low_n", "pos", "s"])

    rows = classes.select("vid", "n", "low").mapInArrow(trimmed(run), "vid bigint, n bigint, low_n bigint, pos bigint, s bigint")
    return rows.join(among, "s")


def _xxhash64(s: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of bigint values (the public XXH64 algorithm on 8 bytes, seed 42)."""
    p1, p2, p3, p4, p5 = map(U64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                                   0x27D4EB2F165667C5))
    rotl = lambda x, r: (x << U64(r)) | (x >> U64(64 - r))
    h = np.full(len(s), U64(42) + p5 + U64(8), U64)
    h ^= rotl(s.view(U64) * p2, 31) * p1
    h = rotl(h, 27) * p1 + p4
    h ^= h >> U64(33)
    h *= p2
    h ^= h >> U64(29)
    h *= p3
    h ^= h >> U64(32)
    return h


# ---- the product -------------------------------------------------------------------------------------------------

def _near_in_size(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _ranks(rows: DataFrame, hot_places: DataFrame) -> DataFrame:
    """Rows of shingles that are not hot with `rank`, their place among those of the class's low part."""
    before = F.coalesce(F.size(F.filter("hot_pos", lambda x: x < F.col("pos"))), F.lit(0))
    return (rows.join(hot_places, "vid", "left").withColumn("rank", F.col("pos") - F.when(
        F.col("hot_pos").isNull(), 0).otherwise(before)).drop("hot_pos"))


def _sparse_pairs(prefixes: DataFrame) -> DataFrame:
    """Products of the columns of non-dense classes: pairs (a, b) within the bounds. A column has HOT rows at most."""
    columns = (prefixes.groupBy("s").agg(F.collect_list(F.struct("vid", "n", "rank")).alias("of"))
               .where(F.size("of") > 1))
    pairs = columns.select(F.explode("of").alias("a"), "of").select("a", F.explode("of").alias("b"))
    pairs = pairs.where((F.col("a.vid") < F.col("b.vid")) & _near_in_size(F.col("a.n"), F.col("b.n")))
    least = needed(F.col("na"), F.col("nb"))
    early = (F.col("ra") <= F.col("na") - least) & (F.col("rb") <= F.col("nb") - least)
    summed = (pairs.select(F.col("a.vid").alias("a"), F.col("b.vid").alias("b"), F.col("a.n").alias("na"),
                           F.col("b.n").alias("nb"), F.col("a.rank").alias("ra"), F.col("b.rank").alias("rb"))
              .groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c"), F.max(early).alias("early")))
    most = F.col("c") + F.greatest(F.col("na") - prefix_size(F.col("na")), F.col("nb") - prefix_size(F.col("nb")))
    return summed.where(F.col("early") & (most >= least)).select("a", "b")


def _dense_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect the dense classes as all their links do: first through the middles of columns, twice
    (again among what is left outside a column's largest component), then all pairs of different components."""
    cells = sets.select("vid", "n", F.explode("shingles").alias("s"))
    counts = materialize(cells.groupBy("s").agg(F.count("*").alias("df")), "dense_counts")
    order = Window.partitionBy("vid").orderBy("df", "s")
    ranked = cells.join(counts, "s").withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.where((F.col("rank") < prefix_size(F.col("n"))) & (F.col("df") > 1))
    weight = F.count("*").over(Window.partitionBy("vid"))
    table = materialize(ranked.withColumn("weight", weight).select("s", "vid", "n", "rank", "weight"), "dense_prefixes")
    parts = materialize(table.select("vid").distinct().select("vid", F.col("vid").alias("label")), "dense_parts")
    links = None
    for rows in (lambda: table.join(parts, "vid"), lambda: _outside_largest(table.join(parts, "vid"))):
        new = materialize(shingles.verified(_middle_pairs(rows()), sets, PERCENT), "dense_links")
        links = new if links is None else materialize(links.unionByName(new), "dense_links")
        labels = components(links)
        parts = materialize(parts.select("vid").join(labels.withColumnRenamed("v", "vid"), "vid", "left")
                            .select("vid", F.coalesce("label", "vid").alias("label")), "dense_parts")
    return links.unionByName(shingles.verified(_cross_pairs(table.join(parts, "vid")), sets, PERCENT))


def _middle_pairs(rows: DataFrame) -> DataFrame:
    """Every class with one of the middles of its columns (the one that holds most shared shingles), within the
    bounds: one pair for a class."""
    first = lambda vid, weight: F.max_by(vid, F.col(weight) * (1 << 20) + F.pmod(F.xxhash64(vid), F.lit(1 << 20)))
    middle = rows.groupBy("s").agg(first("vid", "weight").alias("middle"), F.min("label").alias("low"),
                                   F.max("label").alias("high")).where("low != high").select("s", "middle")
    own = rows.select("s", F.col("vid").alias("middle"), F.col("n").alias("m"), F.col("rank").alias("middle_rank"),
                      F.col("weight").alias("middle_weight"), F.col("label").alias("middle_label"))
    middle = middle.join(own, ["s", "middle"])
    least = needed(F.col("n"), F.col("m"))
    pairs = rows.join(middle, "s").where(
        (F.col("label") != F.col("middle_label")) & _near_in_size(F.col("n"), F.col("m"))
        & (F.col("rank") <= F.col("n") - least) & (F.col("middle_rank") <= F.col("m") - least))
    return pairs.groupBy(F.col("vid").alias("a")).agg(first("middle", "middle_weight").alias("b"))


def _largest(rows: DataFrame) -> DataFrame:
    """s, largest: the component with most rows of every column that holds several."""
    sizes = rows.groupBy("s", "label").agg(F.count("*").alias("k"))
    return (sizes.groupBy("s").agg(F.max_by("label", "k").alias("largest"), F.count("*").alias("labels"))
            .where("labels > 1").drop("labels"))


def _outside_largest(rows: DataFrame) -> DataFrame:
    return rows.join(_largest(rows), "s").where("label != largest").drop("largest")


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of a column within the bounds and of different components. In every column the rows outside its
    largest component meet all rows, so a component never meets itself."""
    rows = materialize(rows.join(_largest(rows), "s"), "mixed_columns")
    names = {c: f"{c}_" for c in ("vid", "n", "rank", "label")}
    others = rows.where("label != largest").select("s", *[F.col(c).alias(x) for c, x in names.items()])
    least = needed(F.col("n"), F.col("n_"))
    twice = (F.col("label") == F.col("largest")) | (F.col("vid") > F.col("vid_"))     # a pair of others comes once
    pairs = rows.join(others, "s").where(
        (F.col("label") != F.col("label_")) & twice & _near_in_size(F.col("n"), F.col("n_"))
        & (F.col("rank") <= F.col("n") - least) & (F.col("rank_") <= F.col("n_") - least))
    return pairs.select(F.least("vid", "vid_").alias("a"), F.greatest("vid", "vid_").alias("b")).distinct()


def _mixed_pairs(dense_sets: DataFrame, classes: DataFrame, dense: DataFrame, hot_places: DataFrame,
                 hot: DataFrame) -> DataFrame:
    """Pairs (dense class, other class) within the bounds: prefixes of the others against whole sets."""
    cells = dense_sets.select(F.col("vid").alias("a"), F.col("n").alias("na"), F.explode("shingles").alias("s"))
    cold = materialize(cells.select("s").distinct().join(hot.select("s"), "s", "left_anti"), "dense_shingles")
    rows = _ranks(_low_rows(classes, cold).join(dense, "vid", "left_anti"), hot_places)
    rows = rows.where(F.col("rank") < prefix_size(F.col("n")))
    pairs = cells.join(rows, "s").where(_near_in_size(F.col("na"), F.col("n")))
    least = needed(F.col("na"), F.col("n"))
    summed = pairs.groupBy("a", F.col("vid").alias("b"), "na", "n").agg(
        F.count("*").alias("c"), F.max(F.col("rank") <= F.col("n") - least).alias("early"))
    most = F.col("c") + F.col("n") - prefix_size(F.col("n"))
    return summed.where(F.col("early") & (most >= least)).select("a", "b")


def _links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes that connect them as all links do."""
    low = classes.select(F.explode("low").alias("s"))
    counts = materialize(low.groupBy("s").agg(F.count("*").alias("df")).where("df > 1"), "shared_shingles")
    cells = materialize(_low_rows(classes, counts), "shared_cells")
    hot = materialize(counts.where(F.col("df") > HOT).select("s"), "hot_shingles")
    hot_cells = cells.where(F.col("df") > HOT)
    places = materialize(hot_cells.groupBy("vid", "n", "low_n").agg(F.collect_list("pos").alias("hot_pos")), "hot_places")
    dense = materialize(places.where(F.col("low_n") - F.size("hot_pos") < prefix_size(F.col("n"))).select("vid"), "dense")
    hot_places = places.select("vid", "hot_pos")
    prefixes = _ranks(cells.where(F.col("df") <= HOT).join(dense, "vid", "left_anti"), hot_places)
    prefixes = prefixes.where(F.col("rank") < prefix_size(F.col("n")))
    pairs = materialize(_sparse_pairs(prefixes), "sparse_pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("vid")).unionByName(dense).distinct()
    sets = shingles.whole_sets(rows, classes, ends, WORDS)
    links = shingles.verified(pairs, sets, PERCENT)
    if not dense.isEmpty():
        dense_sets = sets.join(dense, "vid", "left_semi")
        links = links.unionByName(_dense_links(dense_sets))
        mixed = materialize(_mixed_pairs(dense_sets, classes, dense, hot_places, hot), "mixed_pairs")
        missing = mixed.select(F.col("b").alias("vid")).distinct().join(sets.select("vid"), "vid", "left_anti")
        missing = materialize(missing, "missing")
        if not missing.isEmpty():
            sets = sets.unionByName(shingles.whole_sets(rows, classes, missing, WORDS))
        links = links.unionByName(shingles.verified(mixed, sets, PERCENT))
    return links


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row; d1, d2 (digest of the set) and label (of the component, null
    for an empty set), which tell components apart even if ids repeat or are null."""
    rows = shingles.rows_of(docs, id_col, text_col)
    members = materialize(_members(rows), "members")
    classes = members.where("n > 0").select("d1", "d2", "n", "home", "low").dropDuplicates(["d1", "d2"])
    classes = materialize(classes.withColumn("vid", F.monotonically_increasing_id()), "classes")
    return shingles.with_components(members, classes, components(_links(rows, classes)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns kept, without those linked to one of a smaller id: one of each component stays, and
    every document with an empty set. Ids that stand in several rows, or that are null, are looked at row by row: of
    repeated rows (same id and text) one stays, of a component's rows that all carry its smallest id one, and of a
    component without any id one."""
    found = materialize(join(docs, id_col, text_col), "components")
    name = "_id"
    while name in docs.columns:
        name += "_"
    odd = materialize(found.groupBy(F.col("doc_id").alias(name)).count().where(f"count > 1 or {name} is null")
                      .select(name), "repeated_ids")
    linked = (F.col("n_shingles") > 0) & ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = found.where(linked).select(F.col("doc_id").alias(name)).unionByName(odd).distinct()
    gone = materialize(gone, "gone")
    same = F.col(id_col).eqNullSafe(F.col(name))
    single = docs.join(gone, same, "left_anti")
    if odd.isEmpty():
        return single
    return single.unionByName(_one_by_one(docs.join(odd, same, "left_semi"), found, id_col, text_col))


def _one_by_one(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    row = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("i"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("t")).dropDuplicates(["i", "t"])
    row = materialize(row, "odd_rows")
    own = _members(row.select(F.struct("i", "t").alias("doc_id"), F.col("t").alias("text"),
                              F.lit(0).cast("bigint").alias("home")))
    component = found.where("n_shingles > 0").select("d1", "d2", "component_id", "label").distinct()
    own = own.select("doc_id.i", "doc_id.t", "n", "d1", "d2").join(component, ["d1", "d2"], "left")
    own = own.where((F.col("n") == 0) | F.col("i").eqNullSafe(F.col("component_id")))
    by_text = F.when(F.col("n") == 0, F.col("t"))
    stay = own.groupBy("i", "label", by_text.alias("k")).agg(F.min("t").alias("t")).select(
        F.col("i").alias("stay_i"), F.col("t").alias("stay_t"))
    kept = row.join(stay, F.col("i").eqNullSafe(F.col("stay_i")) & (F.col("t") == F.col("stay_t")), "left_semi")
    return kept.select("row.*")
