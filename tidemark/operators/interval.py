"""Left interval join of trades with the alerts within +-h of each trade's entry, aggregated per trade.

Written directly (`a.ts BETWEEN t.ts - h AND t.ts + h`, no equality key) Spark can only plan a nested loop.
Two exact rewrites, neither of which emits all (trade, alert) pairs:

* Counts by a sweep. Alerts and the two window bounds of each trade are put in one sorted sequence; the number
  of alerts in [t - h, t + h] is the running count at the upper bound minus the running count just before the
  lower bound. The running count is the range-partitioned running sum of `tidemark.operators.running`, so the
  work is linear in trades + alerts and a burst of alerts at one instant is split across tasks.
* Distinct descriptions by segments. Alerts are reduced to one segment per (description, bucket of width h). A trade in
  bucket b can only be reached by alerts of buckets b-1, b, b+1: by every alert of its own bucket, by those of b-1 if the
  last of them lies at most h before it, by those of b+1 if the first lies at most h after it. `with_descriptions` brings
  a bucket's descriptions together in one row, no longer than what a trade there can return, and equi-joins it once per
  result row; where each description nearby has alerts in the bucket itself, the text is the same for all its trades.
  `window_descriptions` gives them as rows, at most three per trade and active description. A hot bucket is split over
  salts in both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import sorted_distinct_join
from tidemark.operators.running import running_aggregate

_LO, _ALERT, _HI = 0, 1, 2
_LAST = (1 << 63) - 1    # after every time


HOT_SHARE = 200
SALTS = 64               # shares of a hot bucket's trades


def _micros(ts: str) -> F.Column:
    return F.unix_micros(F.col(ts))


def _bucket(pos: F.Column, width: int) -> F.Column:
    # floor(pos / width) on integers, also for times before 1970
    return ((pos - F.pmod(pos, F.lit(width))) / F.lit(width)).cast("long")


def window_counts(
    trades: DataFrame,
    alerts: DataFrame,
    *,
    trade_key: str,
    trade_ts: str,
    alert_key: str,
    alert_ts: str,
    alert_flag: F.Column,
    half_width_micros: int,
    partitions: int | None = None,
) -> DataFrame:
    """(trade_key, n_all, n_flag): alerts with non-null `alert_key` within +-h of each trade's time.

    Only trades with a non-null time are returned; the caller's left join turns the rest into zeros.
    """
    h = F.lit(half_width_micros)
    t = trades.where(F.col(trade_ts).isNotNull()).select(
        F.col(trade_key).alias("__tk"), _micros(trade_ts).alias("__pos")
    )
    # both window bounds of a trade from one scan
    bounds = F.explode(F.array(
        F.struct((F.col("__pos") - h).alias("pos"), F.lit(_LO).alias("kind")),
        F.struct((F.col("__pos") + h).alias("pos"), F.lit(_HI).alias("kind")),
    ))
    queries = t.select("__tk", bounds.alias("__q")).select(
        F.col("__q.pos").alias("pos"), F.col("__q.kind").alias("kind"), F.lit(None).cast("long").alias("__ak"),
        "__tk", F.lit(0).cast("long").alias("w"), F.lit(0).cast("long").alias("wf"),
    )
    events = (
        alerts.where(F.col(alert_ts).isNotNull() & F.col(alert_key).isNotNull())
        .select(
            _micros(alert_ts).alias("pos"),
            F.lit(_ALERT).alias("kind"),
            F.xxhash64(F.col(alert_key)).alias("__ak"),  # tie-break only: spreads equal instants over ranges
            F.lit(None).cast(t.schema["__tk"].dataType).alias("__tk"),
            F.lit(1).cast("long").alias("w"),
            F.when(alert_flag, 1).otherwise(0).cast("long").alias("wf"),
        )
    )
    swept = running_aggregate(
        queries.unionByName(events),
        order_by=["pos", "kind", "__ak", "__tk"],
        sums={"c": "w", "cf": "wf"},
        partitions=partitions,
    )
    sign = F.when(F.col("kind") == _HI, 1).otherwise(-1)
    return (
        swept.where(F.col("kind") != _ALERT)
        .groupBy(F.col("__tk").alias(trade_key))
        .agg(F.sum(sign * F.col("c")).alias("__n"), F.sum(sign * F.col("cf")).alias("__nf"))
    )


def window_descriptions(
    trades: DataFrame,
    alerts: DataFrame,
    *,
    trade_key: str,
    trade_ts: str,
    alert_key: str,
    alert_ts: str,
    alert_desc: str,
    half_width_micros: int,
) -> DataFrame:
    """(trade_key, desc): each description with at least one alert within +-h of the trade (may repeat)."""
    h = half_width_micros
    segs = _segments(alerts, alert_key, alert_ts, alert_desc, h).withColumn(
        "__b", F.explode(F.array(F.col("__b") - 1, F.col("__b"), F.col("__b") + 1)))
    t = trades.where(F.col(trade_ts).isNotNull()).select(
        F.col(trade_key).alias("__tk"), _micros(trade_ts).alias("__pos")
    ).withColumn("__b", _bucket(F.col("__pos"), h))
    hot = _hot(t)
    t = _salted(t, hot, "__tk")
    segs = _copied(segs, hot)
    return (
        t.join(segs, ["__b", "__salt"])
        .where((F.col("__pos") >= F.col("__lo") - h) & (F.col("__pos") <= F.col("__hi") + h))
        .select(F.col("__tk").alias(trade_key), F.col("__desc").alias("__desc"))
    )


def _segments(alerts: DataFrame, alert_key: str, alert_ts: str, alert_desc: str, h: int) -> DataFrame:
    """(__desc, __b, __lo, __hi): the first and last alert of every description and bucket."""
    return (
        alerts.where(F.col(alert_ts).isNotNull() & F.col(alert_key).isNotNull() & F.col(alert_desc).isNotNull())
        .select(F.col(alert_desc).alias("__desc"), _micros(alert_ts).alias("__pos"))
        .groupBy("__desc", _bucket(F.col("__pos"), h).alias("__b"))
        .agg(F.min("__pos").alias("__lo"), F.max("__pos").alias("__hi"))
    )


def _hot(t: DataFrame) -> DataFrame:
    """The buckets (`__b`) with over 1 / HOT_SHARE of the trades; there are HOT_SHARE such buckets at most. Their trades are
    split over SALTS shares, and what is joined to them, of which there is little, is copied to each."""
    sizes = t.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    total = sizes.agg(F.sum("__n")).scalar()
    return F.broadcast(sizes.where(F.col("__n") * HOT_SHARE > total).select("__b", F.lit(True).alias("__hot")))


def _salted(t: DataFrame, hot: DataFrame, *by: str) -> DataFrame:
    share = F.pmod(F.xxhash64(*by), F.lit(SALTS))
    return t.join(hot, "__b", "left").withColumn("__salt", F.when(F.col("__hot"), share).otherwise(0).cast("int")).drop("__hot")


def _copied(segs: DataFrame, hot: DataFrame) -> DataFrame:
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return segs.join(hot, "__b", "left").withColumn("__salt", F.explode(copies)).drop("__hot")


def with_descriptions(
    rows: DataFrame,
    trades: DataFrame,
    alerts: DataFrame,
    *,
    pos: str,
    trade_ts: str,
    alert_key: str,
    alert_ts: str,
    alert_desc: str,
    half_width_micros: int,
    out: str,
) -> DataFrame:
    """`rows` with `out`, the sorted distinct descriptions of the alerts within +-h of the time `pos` (microseconds; NULL
    has none), joined by '; ' (NULL without any). `trades` gives the sizes of the buckets. The buckets' descriptions are
    known long before `rows` are, so adaptive execution joins them by broadcast, under the threshold, and moves no row."""
    h = half_width_micros
    segs, b = _segments(alerts, alert_key, alert_ts, alert_desc, h), F.col("__b")
    no = F.lit(None).cast("long")
    reach = F.explode(F.array(
        F.struct((b - 1).alias("__b"), F.lit(False).alias("own"), (F.col("__lo") - h).alias("since"), no.alias("until")),
        F.struct(b.alias("__b"), F.lit(True).alias("own"), no.alias("since"), no.alias("until")),
        F.struct((b + 1).alias("__b"), F.lit(False).alias("own"), no.alias("since"), (F.col("__hi") + h).alias("until"))))
    each = segs.select("__desc", reach.alias("__r")).groupBy(F.col("__r.__b").alias("__b"), "__desc").agg(
        F.max("__r.own").alias("own"), F.coalesce(F.min("__r.since"), F.lit(_LAST)).alias("since"),
        F.coalesce(F.max("__r.until"), F.lit(-_LAST)).alias("until"))
    near = each.groupBy("__b").agg(
        F.collect_list(F.when(F.col("own"), F.col("__desc"))).alias("__own"),
        F.collect_list(F.when(~F.col("own"), F.struct("__desc", "since", "until"))).alias("__rest"))
    near = near.withColumn("__all", F.when(F.size("__rest") == 0, sorted_distinct_join(F.col("__own"))))
    hot = _hot(trades.where(F.col(trade_ts).isNotNull()).select(_bucket(_micros(trade_ts), h).alias("__b")))
    kept = [c for c in rows.columns if c != pos]
    reached = F.filter("__rest", lambda x: (F.col(pos) >= x["since"]) | (F.col(pos) <= x["until"]))
    some = sorted_distinct_join(F.concat(F.col("__own"), F.transform(reached, lambda x: x["__desc"])))
    t = _salted(rows.withColumn("__b", _bucket(F.col(pos), h)), hot, *rows.columns)
    return t.join(_copied(near, hot), ["__b", "__salt"], "left").select(
        *kept, F.when(F.col("__rest").isNotNull(), F.coalesce("__all", some)).alias(out))


def correlate(
    trades: DataFrame,
    alerts: DataFrame,
    *,
    trade_key: str,
    trade_ts: str,
    group_cols: Sequence[str | F.Column],
    alert_key: str,
    alert_ts: str,
    alert_level: str,
    alert_desc: str,
    half_width_minutes: int = 30,
    high_level: int = 10,
    count_col: str = "alerts_within_30min",
    high_col: str = "high_severity_alerts",
    desc_col: str = "alert_descriptions",
    partitions: int | None = None,
    key_in_group: bool = False,
) -> DataFrame:
    """GROUP BY `group_cols` of trades LEFT JOIN alerts ON alert_ts BETWEEN ts - h AND ts + h, with
    COUNT(alert_key), COUNT(alert_key) FILTER (level >= high_level) and
    STRING_AGG(DISTINCT desc, '; ' ORDER BY desc) (NULL when nothing matched).

    `trade_key` must identify a trade. The counts come out of an aggregation on the key, and only the trades move to meet
    them. With `key_in_group` each group is one trade. Otherwise `group_cols` must include `trade_ts`: trades of one group
    then share their window, so the group's counts are the sums of its members'. The descriptions are a function of the
    time alone and are joined to the finished rows, so no text is shuffled by trade.
    """
    h = half_width_minutes * 60 * 1_000_000
    counts = window_counts(
        trades, alerts, trade_key=trade_key, trade_ts=trade_ts, alert_key=alert_key, alert_ts=alert_ts,
        alert_flag=F.col(alert_level) >= high_level, half_width_micros=h, partitions=partitions,
    )
    group_exprs = [F.col(c) if isinstance(c, str) else c for c in group_cols]
    at = F.when(F.col(trade_key).isNotNull(), _micros(trade_ts))
    base = trades.select(F.col(trade_key).alias("__key"), at.alias("__at"), *group_exprs)
    names = [c for c in base.columns if c not in ("__key", "__at")]
    if not key_in_group and trade_ts not in names:
        raise ValueError(f"group_cols must include {trade_ts!r} (the window is a function of it)")
    found = base.join(counts.withColumnRenamed(trade_key, "__key"), "__key", "left").select(
        *names, "__at",
        F.coalesce(F.col("__n"), F.lit(0)).cast("long").alias(count_col),
        F.coalesce(F.col("__nf"), F.lit(0)).cast("long").alias(high_col),
    )
    if not key_in_group:
        found = found.groupBy(*names, "__at").agg(
            F.sum(count_col).cast("long").alias(count_col), F.sum(high_col).cast("long").alias(high_col))
    return with_descriptions(
        found, trades, alerts, pos="__at", trade_ts=trade_ts, alert_key=alert_key, alert_ts=alert_ts,
        alert_desc=alert_desc, half_width_micros=h, out=desc_col,
    ).select(*names, count_col, high_col, desc_col)
