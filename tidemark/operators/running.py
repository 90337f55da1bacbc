"""Running aggregates over a whole table without a single-partition window, by one shuffle.

`SUM(x) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING)` written directly makes Spark move every row into one task
(`Exchange SinglePartition`). Here the rows are cut into ranges of the (unique) order key instead, in one way for
every size:

1. Sketch: the keys fall into `SAMPLES` buckets per range by a hash, and of each bucket the key with the smallest
   (second) hash stays: a hash aggregation with map-side combine, and a uniform sample of the unique keys of a fixed
   size. Its quantiles are the borders. The key is unique, so an instant that holds a third of all rows is cut too.
2. The range of a row is a binary search in the borders, a function of the row alone (the sketch depends on the set of
   keys only). One exchange puts every range into the task of its number; nothing is written in between, and a task
   that is run again finds the same ranges.
3. Each range computes its local running values with an ordinary window, which that exchange already satisfies.
4. Totals per range (or, within groups, per range and group that a border cuts: two a border at most) come from a
   narrow reading of the input with map-side combine, or from that exchange where peaks need the order; exclusive
   prefixes over them are broadcast back.

The borders only decide the balance, never the result. The input is read three times: its key columns, its key and
value columns, all columns that the caller asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_ID = "__ra_range"
BORDERS = "__ra_borders"
SAMPLES = 32             # sampled keys per range


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _borders(df: DataFrame, keys: Mapping[str, Column], n: int) -> Column:
    """An array of n - 1 keys (structs), in order: quantiles of a sample of n * SAMPLES keys, as a scalar subquery."""
    cols = [c.alias(k) for k, c in keys.items()]
    key = df.select(*cols)
    mark = F.xxhash64(F.lit(0x5EED), *key.columns)
    picked = key.groupBy(F.pmod(F.xxhash64(*key.columns), F.lit(n * SAMPLES)).alias("__ra_bucket")).agg(
        *[F.min_by(c, mark).alias(c) for c in key.columns])
    ordered = picked.agg(F.sort_array(F.collect_list(F.struct(*key.columns))).alias("ks"))
    if n == 1:
        return ordered.select(F.slice("ks", 1, 0)).scalar()
    at = lambda i: F.floor(i * F.size("ks") / F.lit(n)).cast("int")
    return ordered.select(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get("ks", at(i)))).scalar()


def with_range(df: DataFrame, keys: Sequence[str] | Mapping[str, Column], partitions: int | None = None) -> DataFrame:
    """`df` with RANGE_ID, the number of the row's range in the order of `keys` (as many ranges as there are shuffle
    partitions), and BORDERS. Nothing is moved. `keys` may be expressions: any that never decrease in the order that
    the caller keeps within a range. Nulls come first."""
    keys = keys if isinstance(keys, Mapping) else {k: F.col(k) for k in keys}
    n = _partitions(df, partitions)
    key = F.struct(*[c.alias(k) for k, c in keys.items()])
    steps = [1 << i for i in reversed(range(max(1, (n - 1).bit_length())))]
    found = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda low, step: F.when(F.get(F.col(BORDERS), low + step - 1) <= key, low + step).otherwise(low))
    return df.withColumn(BORDERS, _borders(df, keys, n)).withColumn(RANGE_ID, found)


def ranged(df: DataFrame, keys: Sequence[str] | Mapping[str, Column], partitions: int | None = None) -> DataFrame:
    """`df` with RANGE_ID, every range in the task of its number: one exchange, which also satisfies windows and
    groupings by RANGE_ID (and further columns)."""
    return with_range(df, keys, partitions).drop(BORDERS).repartitionById(_partitions(df, partitions), F.col(RANGE_ID))


def _kept(total: Column, kind: T.DataType) -> Column:
    """A decimal sum at the input's own scale, narrow enough that adding two of them cuts no fraction digit."""
    return total.cast(T.DecimalType(37, kind.scale)) if isinstance(kind, T.DecimalType) else total


def running_aggregate(
    df: DataFrame,
    order_by: Sequence[str],
    sums: Mapping[str, str],
    peaks: Mapping[str, str] | None = None,
    partitions: int | None = None,
    within: Sequence[str] = (),
    xors: Mapping[str, str] | None = None,
    cut_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running sums (and running maxima of those sums, and running exclusive-ors) ordered by `order_by`.

    `order_by` must be unique per row (add the row key as the last column) so the order is total and the
    result deterministic. `sums` maps output column -> value column; `peaks` maps output column -> a key of
    `sums` whose running maximum is wanted; `xors` maps output column -> an integer column. Values should be exact
    (integer or decimal) so that the order of additions cannot change a result.

    `within` names columns (the first of the order) at which the running values start anew; a group as large as a third
    of the table is still cut into ranges. `cut_by` gives narrower keys for the borders in place of the order's columns
    (never decreasing in that order, the columns of `within` first), where these are long texts.
    """
    peaks, xors, within = dict(peaks or {}), dict(xors or {}), list(within)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    order_by = within + [c for c in order_by if c not in within]
    order = [F.col(c) for c in order_by]
    n = _partitions(df, partitions)
    numbered = with_range(df, cut_by or order_by, n)
    staged = numbered.drop(BORDERS).repartitionById(n, F.col(RANGE_ID))
    local = Window.partitionBy(RANGE_ID, *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    staged = staged.withColumns(
        {f"__ra_l_{out}": _kept(F.sum(src).over(local), kinds[src]) for out, src in sums.items()}
        | {f"__ra_l_{out}": F.bit_xor(src).over(local) for out, src in xors.items()})
    for out, of in peaks.items():
        staged = staged.withColumn(f"__ra_lp_{out}", F.max(F.col(f"__ra_l_{of}")).over(local))

    # Totals per range, an exclusive prefix over them: one row per range, or two per border within groups.
    if within:
        cut = F.lit(False)
        for side in (F.get(F.col(BORDERS), F.col(RANGE_ID) - 1), F.get(F.col(BORDERS), F.col(RANGE_ID))):
            same = F.lit(True)
            for c in within:
                same = same & side[c].eqNullSafe(F.col(c))
            cut = cut | (side.isNotNull() & same)
        numbered = numbered.where(cut)
    totals = [_kept(F.sum(src), kinds[src]).alias(f"__ra_t_{out}") for out, src in sums.items()]
    totals += [F.bit_xor(src).alias(f"__ra_t_{out}") for out, src in xors.items()]
    if peaks:                # a peak needs the order, so the totals come from the exchange (Spark reuses it)
        per_range = staged.groupBy(RANGE_ID, *within).agg(
            *totals, *[F.max(f"__ra_l_{of}").alias(f"__ra_m_{out}") for out, of in peaks.items()])
    else:
        per_range = numbered.groupBy(RANGE_ID, *within).agg(*totals)
    before = (Window.partitionBy(*within) if within else Window).orderBy(RANGE_ID).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = {f"__ra_o_{out}": _kept(F.coalesce(F.sum(f"__ra_t_{out}").over(before), F.lit(0)), kinds[src])
               for out, src in sums.items()}
    offsets |= {f"__ra_o_{out}": F.coalesce(F.bit_xor(f"__ra_t_{out}").over(before), F.lit(0)) for out in xors}
    per_range = per_range.withColumns(offsets)
    for out, of in peaks.items():
        per_range = per_range.withColumn(
            f"__ra_pp_{out}", F.max(F.col(f"__ra_o_{of}") + F.col(f"__ra_m_{out}")).over(before))
    names = {RANGE_ID: "__ra_r"} | {c: f"__ra_w_{c}" for c in within}
    keep = [f"__ra_o_{o}" for o in (*sums, *xors)] + [f"__ra_pp_{o}" for o in peaks]
    small = F.broadcast(per_range.select(*[F.col(c).alias(x) for c, x in names.items()], *keep))
    on = F.lit(True)
    for c, x in names.items():
        on = on & F.col(c).eqNullSafe(F.col(x))
    out_df = staged.join(small, on, "left")
    out_df = out_df.withColumns(
        {out: F.coalesce(F.col(f"__ra_o_{out}"), F.lit(0)) + F.col(f"__ra_l_{out}") for out in sums}
        | {out: F.coalesce(F.col(f"__ra_o_{out}"), F.lit(0)).bitwiseXOR(F.col(f"__ra_l_{out}")) for out in xors}
        # greatest() skips NULL, so the first range (no earlier peak) takes its own local peak.
        | {out: F.greatest(F.col(f"__ra_pp_{out}"),
                           F.coalesce(F.col(f"__ra_o_{of}"), F.lit(0)) + F.col(f"__ra_lp_{out}"))
           for out, of in peaks.items()})
    return out_df.drop(*[c for c in out_df.columns if c.startswith("__ra_")])
