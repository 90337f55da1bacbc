"""Operator 3, quality rules with risk-controlled thresholds.

Rules compare a ratio of a text (per thousand) with a cutoff: symbols to word characters, repeated to all lines,
words in repeated five-word windows to all words, and the mean word length, too long or too short. Which cutoffs may
be used is decided on labelled documents of good quality, the holdouts, by stratum (language): a cutoff that rejects k
of n of them is admitted if the exact binomial tail P(X <= k), X ~ Bin(n, a), is at most the error allowed, that is if
the exact (Clopper-Pearson) upper bound of the false rejection rate is at most a. `RISK` is shared out among the rules by
`WEIGHTS`, so all rules together reject at most that share of a stratum's good documents, and the allowed error `ERROR`
is shared among all strata and, by the same weights, rules (weighted Bonferroni). A holdout is a document, an id and its
text, however many rows repeat it: the bound needs independent trials. Along a rule the cutoffs, fixed beforehand, are tested from
the loosest to the strictest up to the first that fails (fixed-sequence testing, which needs no further correction);
the last one admitted is used. A stratum with too few holdouts gets no cutoff, and its documents only the base rules.

Everything is SQL functions: words, windows and lines are arrays of a row, no shuffle of texts. Repeated windows are
compared by 64-bit hashes within a text. A row's arrays take memory in proportion to its own text.

Odd cases: a null text has no words (n_words 0, base_failed); a null language is a stratum of its own; a document with
several labels is good if any label says so; null labels are left out; an empty labels table admits no cutoff;
repeated rows each get a row; columns other than id, text and language are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 5               # words
RISK = 0.02              # of rejecting a good document, in each stratum, all rules together
ERROR = 0.05             # probability that any admitted cutoff breaks its share of RISK
# The shares of both that each rule gets: they add up to 1, so the sums hold. Symbols come first: a text of signs is the
# commonest kind of junk, and one rule with a large share admits a cutoff where five with equal ones admit none.
WEIGHTS = {"symbols": 0.6, "dup_lines": 0.1, "repeat_words": 0.1, "long_words": 0.1, "short_words": 0.1}

# rule -> (numerator, denominator, cutoffs from loose to strict); a text fails over the cutoff, per thousand.
# A negative numerator turns a rule into "at least": -mean > -2000 is a mean under two characters.
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20)),
    "dup_lines": ("n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100, 50)),
    "repeat_words": ("n_repeat_words", "n_words", (180, 160, 140, 120, 100, 80, 60, 50, 40, 30, 20)),
    "long_words": ("word_chars", "n_words", (30000, 20000, 15000, 12000, 10000, 9000, 8500, 8000, 7500)),
    "short_words": ("-word_chars", "n_words", (-1000, -1500, -2000, -2500, -3000, -3500)),
}


def _exact_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("stratum"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "stratum", F.xxhash64("text").alias("text_hash"), F.regexp_count("text", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
                       F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
                       F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    rows = rows.select(
        "doc_id", "stratum", "text_hash", "n_symbols", "words", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"))
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    windows = F.when(F.col("n_words") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    rows = rows.withColumn("windows", windows).drop("words")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(repeats, placed)).drop("windows")
    same = lambda x, i, d: F.coalesce(x["h"] == F.get(F.col("placed"), i + d)["h"], F.lit(False))
    again = F.filter("placed", lambda x, i: same(x, i, -1) | same(x, i, 1))
    rows = rows.withColumn("again", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("placed")
    covered = F.transform("again", lambda p, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col("again"), i + 1) - p, F.lit(WINDOW))).cast("bigint"))
    rows = rows.withColumn("n_repeat_words", F.coalesce(_exact_sum(covered), F.lit(0).cast("bigint")))
    return rows.select("doc_id", "stratum", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def exceeds(rule: str, cutoff: Column) -> Column:
    """num / den > cutoff / 1000, in integers; false without words."""
    num, den, _ = RULES[rule]
    return (F.expr(f"1000 * ({num})") > cutoff * F.col(den)) & (F.col(den) > 0)


def _ln_factorial(n: Column) -> Column:
    """Exact below 20, else Stirling's series (error under 1e-13)."""
    x = F.greatest(n, F.lit(20)).cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 20, F.log(F.factorial(F.least(n, F.lit(19)).cast("int")))).otherwise(
        (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series)


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X ~ Bin(n, p), 0 <= k <= n: the top term, times a sum of ratios downwards until the terms vanish (ten
    standard deviations below the mean). 1 from the mean upwards, where the tail is a half at least."""
    top = F.exp(_ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k) + k * F.log(p) + (n - k) * F.log1p(-p))
    ratio = lambda i: (k - i + 1) / (n - k + i) * ((1 - p) / p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    step = lambda a, i: F.struct((a["term"] * ratio(i)).alias("term"), (a["sum"] + a["term"] * ratio(i)).alias("sum"))
    last = F.least(k, (64 + F.ceil(10 * F.sqrt(n * p))).cast("bigint"))
    steps = F.when((k > 0) & (k < n * p), F.sequence(F.lit(1).cast("bigint"), last))
    done = F.aggregate(F.coalesce(steps, F.array().cast("array<bigint>")), start, step)
    return F.when(k < n * p, F.least(F.lit(1.0), top * done["sum"])).otherwise(1.0)


def cutoffs(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
            risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum, rule, cutoff (the strictest admitted), n_holdout, n_rejected, for every stratum and rule with one."""
    good = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
            .agg(F.max(label_col).alias("good")).where("good = 1").select("doc_id"))
    # one trial per document: rows that repeat an id and its text are no further evidence
    holdouts = measured.where(~base_failed()).join(good, "doc_id").dropDuplicates(["doc_id", "text_hash"])
    tested = [(r, j, c) for r, (_, _, cs) in RULES.items() for j, c in enumerate(cs)]
    counts = holdouts.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.count_if(exceeds(r, F.lit(c))).alias(f"k{i}") for i, (r, _, c) in enumerate(tested)])
    counts = materialize(counts, "holdout_counts")               # a row per stratum
    strata = max(1, counts.count())
    cells = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(j).alias("j"), F.lit(c).alias("cutoff"),
                               F.col(f"k{i}").alias("k")) for i, (r, j, c) in enumerate(tested)])
    rows = counts.select("stratum", "n", F.explode(cells).alias("x")).select("stratum", "n", "x.*")
    weight = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])[F.col("rule")]
    rows = rows.withColumns({"p": risk * weight, "share": error * weight / F.lit(strata)})
    admitted = rows.withColumn("ok", binomial_tail(F.col("k"), F.col("n"), F.col("p")) <= F.col("share"))
    first_bad = F.coalesce(F.min(F.when(~F.col("ok"), F.col("j"))), F.lit(1 << 20)).alias("bad")
    limit = admitted.groupBy(F.col("stratum").alias("s"), F.col("rule").alias("r")).agg(first_bad)
    inside = admitted.join(limit, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r"))
                           & (F.col("j") < F.col("bad")))
    return inside.groupBy("stratum", "rule").agg(
        F.max_by("cutoff", "j").alias("cutoff"), F.max("n").alias("n_holdout"), F.max_by("k", "j").alias("n_rejected"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          **limits) -> DataFrame:
    """The measures of every document, base_failed, kept, and `rejected_by` (the rules over their cutoff)."""
    measured = materialize(measures(docs, id_col, text_col, lang_col), "measures")
    found = cutoffs(measured, labels, id_col, **limits)
    per_stratum = found.groupBy(F.col("stratum").alias("s")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    per_stratum = materialize(per_stratum, "cutoffs")
    rows = measured.join(per_stratum, F.col("stratum").eqNullSafe(F.col("s")), "left")
    over = F.array_compact(F.array(*[F.when(exceeds(r, F.col(f"cut_{r}")), F.lit(r)) for r in RULES]))
    rows = rows.withColumn("rejected_by", over).withColumn("base_failed", base_failed())
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "kept", F.array_join("rejected_by", ",").alias("rejected_by"))
