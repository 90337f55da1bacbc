"""Operator 4, secret scans over a trigram inverted index.

`build_index` writes postings (trigram, document key) of the lower-cased texts, for the trigrams that the rules ask
for (a rule set fixes them; the index is made anew for every call). Each rule's regex gives a Boolean trigram query
(`regex_trigrams.py`); postings are intersected by document, and only documents that satisfy a rule's query are read
again and matched with its regex. Rules without a mandatory trigram scan all texts.

Spans are (kind, start, end) in code points, end exclusive, leftmost and non-overlapping per kind; a match that fails
its kind's extra condition is dropped after it was taken. Kinds `assign`, `access` and `hex` are the base; the other
kinds only add spans.

Everything is SQL functions. Start places come from the lengths of the pieces between matches, summed by a window
within a document and kind. Documents are keyed by a hash of id and text.

Odd cases: a null text is empty and has no spans; repeated rows each get a row with the same spans; a null id is an id;
an empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.regex_trigrams import Clause, query
from tidemark.session import materialize

WORD_BITS = 62           # trigrams per bit set


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str           # as Java, RE2 and Python read it alike
    least: int = 0       # characters of `group` that a match needs
    group: int = 0


# fixed values: the three base kinds, then kinds of well-known key formats. Runs of [0-9a-f]+ and AKIA[A-Z0-9]+ end where
# the class ends, so dropping the short ones is the same as asking for the length in the regex; for `assign` it isn't (a
# dropped match has used up its characters), so its length is a condition afterwards.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", r"[a-z]{2,8}://[A-Za-z0-9._-]+:[A-Za-z0-9._%+-]{6,}@[A-Za-z0-9.-]+"),
)
BASE = ("assign", "access", "hex")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text"))


def vocabulary(rules=RULES) -> list[str]:
    """The trigrams that the rules' queries ask for."""
    return sorted({t for r in rules for clause in query(r.regex) for part in clause for t in part})


def build_index(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings trigram (number in `trigrams`), key: a row for every document that holds the trigram."""
    low = keyed.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return materialize(low.select("key", F.explode(held).alias("trigram")), "trigram_postings")


def _satisfied(clauses: list[Clause], number: dict[str, int]) -> Column:
    """The Boolean query on bit sets bits_0, bits_1, ... of the trigrams a document holds."""
    def all_of(part: frozenset[str]) -> Column:
        masks: dict[int, int] = {}
        for t in part:
            masks[number[t] // WORD_BITS] = masks.get(number[t] // WORD_BITS, 0) | 1 << number[t] % WORD_BITS
        out = F.lit(True)
        for word, mask in sorted(masks.items()):
            out = out & (F.col(f"bits_{word}").bitwiseAND(F.lit(mask)) == F.lit(mask))
        return out

    whole = F.lit(True)
    for clause in clauses:
        some = F.lit(False)
        for part in clause:
            some = some | all_of(part)
        whole = whole & some
    return whole


def candidates(postings: DataFrame, trigrams: list[str], rules) -> DataFrame:
    """key, kinds (of the rules whose query the document satisfies): the postings intersected."""
    number = {t: i for i, t in enumerate(trigrams)}
    words = range(-(-len(trigrams) // WORD_BITS))
    held = postings.groupBy("key").agg(*[
        F.coalesce(F.bit_or(F.when(F.floor(F.col("trigram") / WORD_BITS) == w, F.expr(
            f"shiftleft(1L, trigram % {WORD_BITS})"))), F.lit(0).cast("bigint")).alias(f"bits_{w}") for w in words])
    kinds = F.array_compact(F.array(*[F.when(_satisfied(query(r.regex), number), F.lit(r.kind)) for r in rules]))
    return held.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _matches(rows: DataFrame, rule: Rule) -> DataFrame:
    """key, kind, i, gap (code points before the i-th match, since the one before it), found: once for each key."""
    regex = F.lit(rule.regex)
    found = rows.select("key", F.regexp_extract_all("text", regex, F.lit(0)).alias("found"), "text")
    found = found.where(F.size("found") > 0)
    gaps = F.transform(F.split("text", rule.regex, -1), lambda x: F.length(x).cast("bigint"))
    own = found.select("key", "found", F.slice(gaps, 1, F.size("found")).alias("gaps")).dropDuplicates(["key"])
    return own.select("key", F.lit(rule.kind).alias("kind"), F.posexplode(F.arrays_zip("gaps", "found")).alias("i", "m")
                      ).select("key", "kind", "i", F.col("m.gaps").alias("gap"), F.col("m.found").alias("found"))


def spans(keyed: DataFrame, rules=RULES) -> DataFrame:
    """key, kind, start, end: a row for every span of every distinct document."""
    indexed = [r for r in rules if query(r.regex)]
    trigrams = vocabulary(indexed)
    parts = [_matches(keyed, r) for r in rules if not query(r.regex)]
    if indexed:
        found = materialize(candidates(build_index(keyed, trigrams), trigrams, indexed), "candidates")
        again = materialize(keyed.join(found, "key").select("key", "kinds", "text"), "candidate_texts")
        parts += [_matches(again.where(F.array_contains("kinds", r.kind)), r) for r in indexed]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    size = F.length("found").cast("bigint")
    until = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + size).over(until)).withColumn("start", F.col("end") - size)
    keep = F.lit(True)
    for r in rules:
        if r.least:
            part = F.regexp_extract("found", r.regex, r.group)
            keep = keep & ((F.col("kind") != r.kind) | (F.length(part) >= r.least))
    return rows.where(keep).select("key", "kind", "start", "end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """doc_id, spans (array of start, order, end, kind: by start, then kind as listed) for every row."""
    keyed = _keyed(docs, id_col, text_col)
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    own = spans(keyed, rules).select("key", F.struct("start", order[F.col("kind")].alias("order"), "end", "kind").alias("x"))
    per_key = own.groupBy("key").agg(F.sort_array(F.collect_list("x")).alias("spans"))
    none = F.array().cast("array<struct<start: bigint, order: int, end: bigint, kind: string>>")
    return keyed.select("doc_id", "key").join(per_key, "key", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    def joined(spans_: Column) -> Column:
        return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
