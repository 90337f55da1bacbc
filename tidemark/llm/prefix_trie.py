"""Operator 11, conversation prefix trie by the Euler-tour technique.

Every conversation c takes over the first h turns of conversation c - c % 5 (h = crc32 of c in decimal, modulo 9; all of
them if there are fewer, none if that conversation is absent) and keeps its own turns after its first h. The nodes of
the trie are the distinct sequences of first d rebuilt turns; a node is named by its smallest conversation and its
depth. For every node the operator gives its parent, members, children, the leaves below it, the tokens that sharing
prefixes saves in its subtree, and a digest of the conversations that end there.

Steps, each a Spark job over narrow rows (texts are read once, for the order of equal turns and the digests):
1. Turns are numbered by a running count within conversations (`operators.running`: a conversation as large as a third
   of the table is cut into ranges), texts become digests.
2. Rebuilt turns: the first turns of c - c % 5, joined on it (nine conversations at most take over from one), and the
   own rest, joined to the conversation's lengths in blocks of BLOCK turns.
3. The key of a prefix is the running exclusive-or of (position, turn) hashes, 128 bits; a turn's key without its own
   hash is the key of the parent. Nodes are a hash aggregation by key.
4. Siblings: nodes and children in one order (key of the parent, the parent first, then its children by conversation),
   cut into ranges: neighbours give siblings, the last parent seen gives the parent; a table of one row per range
   carries both over borders. A node with a third of all nodes as its children is cut like any other.
5. Euler tour: an enter and an exit arc for every node; an arc's successor follows from first child, next sibling and
   parent.
6. List ranking: in every round an independent set of arcs (those whose keyed hash is below both neighbours') is taken
   out, its predecessors take over its weights; a third of the arcs goes, so all rounds together cost as much as three.
   At most REST arcs are ranked in one task, then the rounds come back in reverse.
7. An arc carries (1, leaf, saving). Its prefix sums at the exit less those at the enter are the subtree's.

Digests of ends: each range joins the (sorted) conversations of a node to a chunk of text; the chunks of a node are
streamed through SHA-256 in order, so no row or task holds them all.

Odd cases: rows without conv_id are left out; a null role or text is empty; equal turns of a conversation stand in the
order of role, then text; repeated rows are turns each; a conversation whose rebuilt sequence is empty is a member of
the root only; an empty table has no nodes; columns other than the four are not read. c % 5 takes the sign of c.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.running import RANGE_ID, ranged, running_aggregate
from tidemark.llm.workers import trimmed
from tidemark.session import materialize

BLOCK = 4096             # turns that share one row of the lengths' table
REST = 1 << 14           # arcs ranked in one task
SHARED = 9               # h is below it
GROUP = 5


# ---- rebuilt conversations ---------------------------------------------------------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), t1, t2 (digest of role and text), bytes (of the text)."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    rows = rows.withColumn("one", F.lit(1).cast("bigint"))
    cut = {"conv_id": F.col("conv_id"), "turn": F.col("turn"), "role": F.substring("role", 1, 16),
           "text": F.substring("text", 1, 64)}
    numbered = running_aggregate(rows, ["conv_id", "turn", "role", "text"], {"pos": "one"}, within=["conv_id"], cut_by=cut)
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return (numbered.withColumn("digest", digest)
            .select("conv_id", "pos", F.xxhash64("digest").alias("t1"), F.xxhash64(F.lit(1), "digest").alias("t2"),
                    F.octet_length("text").cast("bigint").alias("bytes")))


def _lengths(told: DataFrame) -> DataFrame:
    """conv_id, base, h, n (own turns), k (turns taken over), len (rebuilt turns)."""
    n = told.groupBy("conv_id").agg(F.max("pos").alias("n"))
    c = F.col("conv_id")
    own = n.select("conv_id", (c - c % GROUP).alias("base"), (F.crc32(c.cast("string").cast("binary")) % SHARED).alias("h"), "n")
    base = n.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    k = F.least("h", F.coalesce("base_n", F.lit(0)))
    return (own.join(base, "base", "left").withColumn("k", k)
            .select("conv_id", "base", "h", "n", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")))


def rebuilt(told: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv_id, pos, t1, t2, bytes, last (whether the conversation ends here)."""
    first = told.where(F.col("pos") < SHARED).withColumnRenamed("conv_id", "base")
    taken = lengths.join(first, "base").where("pos <= k").select(
        "conv_id", "pos", "t1", "t2", "bytes", (F.col("pos") == F.col("len")).alias("last"))
    block = F.floor(F.col("pos") / F.lit(BLOCK)).cast("bigint")
    blocks = lengths.where("n > h").select(
        "conv_id", "h", "k", "len", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("n") / F.lit(BLOCK)).cast("bigint"))).alias("block"))
    place = F.col("pos") - F.col("h") + F.col("k")
    rest = told.withColumn("block", block).join(blocks, ["conv_id", "block"]).where("pos > h").select(
        "conv_id", place.alias("pos"), "t1", "t2", "bytes", (place == F.col("len")).alias("last"))
    return taken.unionByName(rest)


# ---- nodes -------------------------------------------------------------------------------------------------------

def _prefixes(turns_: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2 (key of the prefix), q1, q2 (of its parent), bytes, last."""
    x = turns_.withColumns({"x1": F.xxhash64("pos", "t1", "t2"), "x2": F.xxhash64(F.lit(2), "t2", "pos", "t1")})
    keyed = running_aggregate(x, ["conv_id", "pos"], {}, within=["conv_id"], xors={"p1": "x1", "p2": "x2"})
    return keyed.select("conv_id", F.col("pos").alias("depth"), "p1", "p2",
                        F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "bytes", "last")


def _digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 from rows depth, p1, p2, conv_id."""
    key = ["depth", "p1", "p2"]
    text = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ranged(ends, [*key, "conv_id"]).groupBy(RANGE_ID, *key).agg(text.alias("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in (*key, "chunk")]
            for *k, chunk in zip(*columns):
                if k != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = k, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(chunk.encode())
            yield _frame(done)
        if at is not None:
            yield _frame([(*at, digest.hexdigest())])

    def _frame(rows):
        cols = list(zip(*rows)) if rows else [()] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[*key, "ends_sha256"])

    ordered = chunks.repartition(*key).sortWithinPartitions(*key, RANGE_ID).select(*key, "chunk")
    return ordered.mapInArrow(trimmed(run), "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def _nodes(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """depth, p1, p2, q1, q2, conv_id, n_convs, saving, n_children, first_child, last_child; the root's key is 0, 0."""
    zero = F.lit(0).cast("bigint")
    found = prefixes.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("q1").alias("q1"), F.max("q2").alias("q2"),
        F.max("bytes").alias("bytes"))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("q1"), zero.alias("q2"),
        zero.alias("bytes"))
    nodes = materialize(found.unionByName(root).withColumn("saving", (F.col("n_convs") - 1) * F.col("bytes")).drop("bytes"),
                        "nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first_child"), F.max("conv_id").alias("last_child"))
    return nodes.join(children, ["depth", "p1", "p2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))


def _with_kin(nodes: DataFrame) -> DataFrame:
    """The nodes with parent, before and after (conversations that name parent and neighbour siblings)."""
    null = F.lit(None).cast("bigint")
    carried = [c for c in nodes.columns if c != "conv_id"]
    child = nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("k0"), F.col("q1").alias("k1"), F.col("q2").alias("k2"), F.lit(1).alias("tag"), "conv_id",
        *carried)
    parent = nodes.where("n_children > 0").select(
        F.col("depth").alias("k0"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(0).alias("tag"), "conv_id",
        *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in carried])
    order = ["k0", "k1", "k2", "tag", "conv_id"]
    rows = ranged(child.unionByName(parent), order)
    row = F.struct(*order)
    per = rows.groupBy(RANGE_ID).agg(
        F.min(row).alias("low"), F.max(row).alias("high"),
        F.max(F.when(F.col("tag") == 0, row)).alias("parent"))         # the last parent of the range
    places = Window.orderBy(RANGE_ID)                                   # a row per range
    edges = F.broadcast(per.select(
        F.col(RANGE_ID).alias("r"), F.lag("high").over(places).alias("edge_before"),
        F.lead("low").over(places).alias("edge_after"),
        F.last("parent", True).over(places.rowsBetween(Window.unboundedPreceding, -1)).alias("edge_parent")))
    local = Window.partitionBy(RANGE_ID).orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "row_before": F.lag(row).over(local), "row_after": F.lead(row).over(local),
        "row_parent": F.last(F.when(F.col("tag") == 0, F.col("conv_id")), True).over(upto)})
    rows = rows.join(edges, F.col(RANGE_ID) == F.col("r"), "left")
    same = lambda x: (x["k0"] == F.col("k0")) & (x["k1"] == F.col("k1")) & (x["k2"] == F.col("k2")) & (x["tag"] == 1)
    before, after = F.coalesce("row_before", "edge_before"), F.coalesce("row_after", "edge_after")
    kin = rows.where("tag = 1").select(
        "conv_id", *carried, F.coalesce("row_parent", F.col("edge_parent.conv_id")).alias("parent"),
        F.when(same(before), before["conv_id"]).alias("before"), F.when(same(after), after["conv_id"]).alias("after"))
    root = nodes.where("depth = 0").select("conv_id", *carried, null.alias("parent"), null.alias("before"), null.alias("after"))
    return kin.unionByName(root)


# ---- Euler tour and list ranking -----------------------------------------------------------------------------------

WEIGHTS = ("place", "leaves", "saved")


def _arc(conv: Column | str, depth: Column, kind: int) -> Column:
    conv = F.col(conv) if isinstance(conv, str) else conv
    return F.struct(conv.alias("c"), depth.alias("d"), F.lit(kind).alias("k"))


def euler_tour(nodes: DataFrame) -> DataFrame:
    """id, pred, next (structs: conversation, depth, 0 enter or 1 exit) and the arc's weights."""
    d, leaf, top = F.col("depth"), F.col("n_children") == 0, F.col("depth") == 0
    enter, out = _arc("conv_id", d, 0), _arc("conv_id", d, 1)
    none = F.lit(None).cast("struct<c:bigint,d:bigint,k:int>")
    arcs = F.array(
        F.struct(
            enter.alias("id"),
            F.when(top, none).when(F.col("before").isNull(), _arc("parent", d - 1, 0)).otherwise(_arc("before", d, 1)).alias("pred"),
            F.when(leaf, out).otherwise(_arc("first_child", d + 1, 0)).alias("next"),
            F.lit(1).cast("bigint").alias("place"), F.when(leaf, 1).otherwise(0).cast("bigint").alias("leaves"),
            F.col("saving").alias("saved")),
        F.struct(
            out.alias("id"),
            F.when(leaf, enter).otherwise(_arc("last_child", d + 1, 1)).alias("pred"),
            F.when(top, none).when(F.col("after").isNull(), _arc("parent", d - 1, 1)).otherwise(_arc("after", d, 0)).alias("next"),
            F.lit(1).cast("bigint").alias("place"), F.lit(0).cast("bigint").alias("leaves"),
            F.lit(0).cast("bigint").alias("saved")))
    return nodes.select(F.explode(arcs).alias("a")).select("a.*")


def _contract(arcs: DataFrame, number: int) -> DataFrame:
    """The arcs without an independent set; gone is the arc that one has taken over, with its own weights till then."""
    mark = lambda c: F.xxhash64(F.lit(number), F.col(c))
    goes = (F.col("pred").isNotNull() & F.col("next").isNotNull() & (mark("id") < mark("pred")) & (mark("id") < mark("next")))
    arcs = arcs.withColumn("goes", F.coalesce(goes, F.lit(False)))
    taken = arcs.where("goes")
    forward = taken.select(F.col("pred").alias("id"), F.col("id").alias("gone"), F.col("next").alias("new_next"),
                           *[F.col(w).alias(f"gone_{w}") for w in WEIGHTS])
    backward = taken.select(F.col("next").alias("id"), F.col("pred").alias("new_pred"))
    left = arcs.where("not goes").drop("goes").join(forward, "id", "left").join(backward, "id", "left")
    return left.select(
        "id", F.coalesce("new_pred", "pred").alias("pred"),
        F.when(F.col("gone").isNull(), F.col("next")).otherwise(F.col("new_next")).alias("next"),
        *[(F.col(w) + F.coalesce(f"gone_{w}", F.lit(0))).alias(w) for w in WEIGHTS],
        "gone", *[F.col(w).alias(f"own_{w}") for w in WEIGHTS])


def _ranked_whole(arcs: DataFrame) -> DataFrame:
    """id and the exclusive prefix sums of a list of at most REST arcs, in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        table = pa.Table.from_batches(read)
        ids = [tuple(x.values()) for x in table.column("id").to_pylist()]
        follow = [x and tuple(x.values()) for x in table.column("next").to_pylist()]
        at_of = {x: i for i, x in enumerate(ids)}
        at = next(i for i, x in enumerate(table.column("pred").to_pylist()) if x is None)
        order = []
        while True:
            order.append(at)
            if follow[at] is None:
                break
            at = at_of[follow[at]]
        order = np.array(order)
        out = [table.column("id").combine_chunks().take(pa.array(order))]
        for w in WEIGHTS:
            own = table.column(w).to_numpy()[order]
            out.append(pa.array(np.cumsum(own) - own))
        yield pa.RecordBatch.from_arrays(out, names=["id", *WEIGHTS])

    small = arcs.select("id", "pred", "next", *WEIGHTS).coalesce(1)
    return small.mapInArrow(trimmed(run), "id struct<c:bigint,d:bigint,k:int>, " + ", ".join(f"{w} bigint" for w in WEIGHTS))


def rank(arcs: DataFrame, rest: int = REST) -> DataFrame:
    """id and, for every weight, the sum over the arcs before it in the list."""
    rounds, arcs = [], materialize(arcs, "arcs")
    while arcs.count() > rest:
        rounds.append(materialize(_contract(arcs, len(rounds)), "arcs_left"))
        arcs = rounds[-1].select("id", "pred", "next", *WEIGHTS)
    known = materialize(_ranked_whole(arcs), "ranked")
    for left in reversed(rounds):
        back = left.where("gone is not null").join(known, "id").select(
            F.col("gone").alias("id"), *[(known[w] + F.col(f"own_{w}")).alias(w) for w in WEIGHTS])
        known = materialize(known.unionByName(back), "ranked")
    return known


def build(conversations: DataFrame, rest: int = REST) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    told = materialize(turns(conversations), "turns")
    lengths = materialize(_lengths(told), "lengths")
    prefixes = materialize(_prefixes(materialize(rebuilt(told, lengths), "rebuilt")), "prefixes")
    nodes = materialize(_with_kin(materialize(_nodes(prefixes, lengths), "named_nodes")), "kin")
    sums = rank(euler_tour(nodes), rest)
    at = lambda w, k: F.max(F.when(F.col("id.k") == k, F.col(w)))
    sums = sums.groupBy(F.col("id.c").alias("conv_id"), F.col("id.d").alias("depth")).agg(
        (at("leaves", 1) - at("leaves", 0)).alias("n_leaves"), (at("saved", 1) - at("saved", 0)).alias("saved_tokens"))
    zero = F.lit(0).cast("bigint")
    ends = prefixes.where("last").select("depth", "p1", "p2", "conv_id").unionByName(
        lengths.where("len = 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id"))
    nodes = nodes.join(sums, ["conv_id", "depth"]).join(materialize(_digests(ends), "ends"), ["depth", "p1", "p2"], "left")
    return nodes.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
