"""Operator 5, mixing sources to target weights by temperature.

Source i with T_i tokens (words) gets the weight T_i**a / sum_j T_j**a. The exponent a in [0, 1] is found by bisection
(several points per pass) on a grid of 1/GRID: the smallest a at which no source is repeated more than
`max_repetition` times, or the largest at which the weights' entropy reaches `min_entropy`. Without a `budget` the
mixture is the smallest in which every document stands at least once: the largest source once, the others more often.

The weights are realised as budgeted block permutations. A source's stream is its documents in the order of a keyed
hash, anew for every pass; a quota of q_i tokens is floor(q_i / T_i) whole passes and the beginning of another, up to
the document that reaches the quota. The stream is cut into as many equal token shares as the mixture has blocks, and
block b joins the b-th share of every source in an order of its own: every block holds the target weights.

Scale: running sums are taken inside buckets of a source's hash order (about BUCKET tokens each, so a source that
holds a third of all rows is spread over many tasks), then over the buckets' totals.

Odd cases: a null source is a source of its own; a text that is null or has no word has no tokens: it stands once per
whole pass and, if all its source has none, once. Rows that agree in id and text are interchangeable. An empty table
gives an empty mixture. A budget above max_repetition times the corpus is lowered to that. Columns other than id,
source and text are not read by `schedule`; `apply` keeps all columns of the documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
GRID = 1_000_000
POINTS = 15              # exponents tried per pass over the sources
BUCKET = 1 << 20         # tokens per bucket of a source's order
BLOCK = 1 << 20          # tokens per block of the mixture
SEED = "mix"


@dataclass
class Plan:
    """`sources`: source, n_docs, tokens, weight, repetition, passes (whole), rest (tokens of the last pass)."""
    sources: DataFrame
    exponent: float
    n_blocks: int


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def order_key(copy: Column, doc_id: Column, text_hash: Column) -> Column:
    """Place of a document in its source's order in a pass: 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(SEED), copy.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")),
                             text_hash))


def _light(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       tokens(F.col(text_col)).alias("n_tokens"), F.md5(text).alias("text_hash"))


def _search(good: "callable", rising: bool) -> int:
    """On the grid 0..GRID, the smallest point at which `good` holds if it turns true with a growing exponent
    (rising), else the largest. `good` answers for a list of exponents in one pass."""
    low, high = 0, GRID                      # rising: high is taken to be good; falling: low is
    while high - low > 1:
        step = max(1, (high - low) // (POINTS + 1))
        points = list(range(low + step, high, step))[:POINTS]
        for point, ok in zip(points, good([p / GRID for p in points])):
            if ok == rising:
                high = min(high, point)
            else:
                low = max(low, point)
    ends = good([low / GRID, high / GRID])
    return (low if ends[0] else high) if rising else (high if ends[1] else low)


def plan(rows: DataFrame, max_repetition: float | None = None, min_entropy: float | None = None,
         budget: int | None = None) -> Plan:
    """`rows`: source, n_tokens per document."""
    if (max_repetition is None) == (min_entropy is None):
        raise ValueError("give either max_repetition (at least 1) or min_entropy")
    if max_repetition is not None and max_repetition < 1:
        raise ValueError("max_repetition must be 1 or more")
    totals = materialize(rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens")),
                         "source_totals")
    full = totals.where("tokens > 0")
    top = full.agg(F.max("tokens"), F.min("tokens"), F.sum("tokens")).first()
    if top[0] is None:
        none = totals.select("*", F.lit(0.0).alias("weight"), F.lit(1.0).alias("repetition"),
                             F.lit(1).cast("bigint").alias("passes"), F.lit(0).cast("bigint").alias("rest"))
        return Plan(none, 1.0, 1)
    largest, smallest, total = (int(x) for x in top)
    if budget is not None and max_repetition is not None:
        budget = min(budget, int(max_repetition * total))
    share = F.col("tokens") / F.lit(float(total))

    def powers(exponents):
        """sum p**a and sum p**a ln p for each exponent; decimal sums, so their order doesn't matter."""
        exact = lambda c: F.sum(c.cast("decimal(30,20)")).cast("double")
        got = full.agg(*[exact(F.pow(share, F.lit(a))) for a in exponents],
                       *[exact(F.pow(share, F.lit(a)) * F.log(share)) for a in exponents]).first()
        n = len(exponents)
        return [(got[i], got[n + i]) for i in range(n)]

    def repeats(exponents):
        if budget is None:
            return [(largest / smallest) ** (1 - a) <= max_repetition for a in exponents]
        rare = smallest / total
        return [budget * rare ** a / z <= max_repetition * smallest for a, (z, _) in zip(exponents, powers(exponents))]

    def spread(exponents):
        return [math.log(z) - a * zl / z >= min_entropy for a, (z, zl) in zip(exponents, powers(exponents))]

    a = (_search(repeats, True) if max_repetition is not None else _search(spread, False)) / GRID
    z = powers([a])[0][0]
    weight = F.pow(share, F.lit(a)) / F.lit(z)
    if budget is None:
        repetition = F.pow(F.lit(float(largest)) / F.col("tokens"), F.lit(1 - a))
    else:
        repetition = weight * F.lit(float(budget)) / F.col("tokens")
    some = F.col("tokens") > 0
    sources = (totals.withColumn("weight", F.when(some, weight).otherwise(0.0))
               .withColumn("repetition", F.when(some, repetition).otherwise(1.0))
               .withColumn("passes", F.floor("repetition").cast("bigint"))
               .withColumn("rest", F.floor((F.col("repetition") - F.col("passes")) * F.col("tokens")).cast("bigint")))
    sources = materialize(sources, "mixture")
    mixed = sources.agg(F.sum(F.col("passes") * F.col("tokens") + F.col("rest"))).first()[0]
    return Plan(sources, a, max(1, -(-int(mixed) // BLOCK)))


def _streams(light: DataFrame, planned: Plan, only_last: bool = False) -> DataFrame:
    """Each document in each pass of its source that the quota touches (or in the unfinished last pass only), with the
    tokens before it in the pass."""
    per_source = planned.sources.select(F.col("source").alias("_s"), "tokens", "passes", "rest")
    rows = light.join(per_source, light["source"].eqNullSafe(F.col("_s"))).drop("_s")
    last = F.col("passes") + F.when(F.col("rest") > 0, 1).otherwise(0) - 1
    if only_last:
        rows = rows.where("rest > 0").withColumn("copy", F.col("passes"))
    else:
        rows = rows.where(last >= 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    rows = rows.withColumn("key", order_key(F.col("copy"), F.col("doc_id"), F.col("text_hash")))
    buckets = F.ceil(F.greatest(F.col("tokens"), F.lit(1)) / F.lit(BUCKET))
    rows = rows.withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
                                             * buckets / F.lit(1 << 32)).cast("bigint"))
    earlier = Window.unboundedPreceding, -1
    inside = Window.partitionBy("source", "copy", "bucket").orderBy("key", "n_tokens").rowsBetween(*earlier)
    across = Window.partitionBy("source", "copy").orderBy("bucket").rowsBetween(*earlier)
    sums = (rows.groupBy("source", "copy", "bucket").agg(F.sum("n_tokens").alias("sum"))
            .withColumn("before_bucket", F.coalesce(F.sum("sum").over(across), F.lit(0)))
            .select(F.col("source").alias("_s"), F.col("copy").alias("_c"), F.col("bucket").alias("_b"),
                    "before_bucket"))
    rows = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("copy") == F.col("_c"))
                     & (F.col("bucket") == F.col("_b")))
    rows = rows.withColumn("before", F.col("before") + F.col("before_bucket")).drop("_s", "_c", "_b", "before_bucket")
    return rows.where((F.col("copy") < F.col("passes")) | (F.col("before") < F.col("rest")))


def schedule(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             **target) -> DataFrame:
    """The mixture, a row per copy of a document: doc_id, source, n_tokens, copy, block, position (in its block)."""
    light = materialize(_light(docs, id_col, source_col, text_col), "document_tokens")
    planned = plan(light, **target)
    rows = _streams(light, planned)
    quota = (F.col("passes") * F.col("tokens") + F.col("rest")).cast("double")
    place = (F.col("copy") * F.col("tokens") + F.col("before")).cast("double")
    block = F.least(F.lit(planned.n_blocks - 1),
                    F.floor(F.coalesce(place / F.nullif(quota, F.lit(0.0)), F.lit(0.0)) * planned.n_blocks))
    rows = rows.withColumn("block", block.cast("bigint"))
    shuffled = Window.partitionBy("block").orderBy(F.md5(F.concat_ws(":", "block", "key")), "doc_id", "n_tokens")
    return rows.select("doc_id", "source", "n_tokens", "copy", "block",
                       F.row_number().over(shuffled).cast("bigint").alias("position"))


def apply(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
          **target) -> DataFrame:
    """The documents of the mixture, all columns kept, as many rows of each as it has copies. Texts aren't shuffled:
    the last pass of a source ends at a place in its order, and every row knows its own place."""
    light = materialize(_light(docs, id_col, source_col, text_col), "document_tokens")
    planned = plan(light, **target)
    ends = (_streams(light, planned, only_last=True).groupBy("source").agg(F.max("key").alias("end"))
            .select(F.col("source").alias("_s2"), "end"))
    per_source = planned.sources.select(F.col("source").alias("_s"), "passes")
    quota = materialize(per_source.join(ends, F.col("_s").eqNullSafe(F.col("_s2")), "left")
                        .select(F.struct("_s", "passes", "end").alias("_quota")), "quotas")
    row = docs.select(F.struct("*").alias("_row"))
    own = F.col("_row").getField(source_col)
    key = order_key(F.col("_quota.passes"), F.col("_row").getField(id_col),
                    F.md5(F.coalesce(F.col("_row").getField(text_col), F.lit(""))))
    copies = F.col("_quota.passes") + F.when(key <= F.col("_quota.end"), 1).otherwise(0)
    return (row.join(quota, own.eqNullSafe(F.col("_quota._s"))).where(copies > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies))).select("_row.*"))
