"""Operator 9, language identification by hierarchical discrimination.

A text is first given a language family, then one-versus-one linear support vector machines separate the closely
related languages within the family. Both levels use the same features: lower-cased byte trigrams inside and around
words, hashed, as shares of the text. The family level is a set of one-versus-rest machines (with two families or
more); a language without relatives among the learned ones is its own family. `score` is the product of the
probabilities (logistic of the margins) along the chosen path.

`score` compares the learned languages with each other only, so it says nothing of texts in none of them; `oddity`
does. Of each trigram of a text it takes the log of its probability in the learned texts (the languages weigh the same)
against one that is equal for all trigrams; the mean over the text, pulled to the usual mean of its language by PULL
trigrams so that a short text is not condemned for little, is compared with the means of the learned texts, each without
its own part in the probabilities: the distance under the median of the language, in units of the 95 % quantile of that
distance among all learned texts. Texts in unlearned languages, encoded data and letter noise are many units away.

Learning: rows with a language and a letter whose crc32(doc_id) mod 5 is not 0, about `sample` rows of each language at
most, drawn by hash.

Odd cases: next to learned texts that are all alike any other text is odd; a text that is null or has no letter gets
`und` and score 0; with no labelled rows every text does; with
one language learned it is predicted with score 1; rows whose language is null are not learned from; of rows that
share a doc_id one is learned from; an empty table gives no rows; columns other than id, text and language are not
read, whatever their names (`keep` hands them through).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_words import _LOWER, NON_SPACE, U64, buffers, mix, slices
from tidemark.llm.linear import Rows, adam, crc_mod, one_per_id, sigmoid
from tidemark.llm.workers import trimmed

BITS = 15
SAMPLE = 800             # labelled rows learned from, per language at most (by hash, about)
SPLIT = 5                # rows whose crc32 mod SPLIT is 0 are held out
PART = 1 << 20           # bytes of a long text counted at once
UNDETERMINED = "und"
UNSEEN = 0.01            # of a text's trigrams, expected to be any at all
PULL = 8                 # trigrams
LEAST_SPREAD = 0.1       # the unit, at least: a few learned texts may be all alike
LETTER = re.compile(r"[^\W\d_]")

# fixed values: families of closely related languages (ISO 639-1)
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky".split(),
    "indic": "hi ur bn mr gu pa ne".split(),
    "semitic": "ar he mt am".split(),
    "celtic": "ga cy gd br".split(),
    "iranian": "fa ku ps tg".split(),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

_SLOT = (mix((np.arange(1 << 16, dtype=U64) + U64(7)) * U64(0x9E3779B97F4A7C15)) >> U64(64 - BITS)).astype(np.uint32)


def trigrams(data: np.ndarray) -> np.ndarray:
    """Feature of the trigram that ends at each byte; white space of any kind and length is one space, and bytes of
    digits and ASCII punctuation count as space too."""
    b = _PLAIN[data]
    pair = np.empty(len(b), np.uint32)
    pair[:1] = b[:1].astype(np.uint32) | 0x2000
    pair[1:] = b[1:].astype(np.uint32) | (b[:-1].astype(np.uint32) << 8)
    slot = _SLOT[pair]
    slot[2:] ^= _SLOT[b[:-2]]
    slot[b == 0x20] = 0                  # trigrams that end in a space say nothing more than those before
    return slot


_PLAIN = _LOWER.copy()
_PLAIN[~NON_SPACE] = 0x20
_PLAIN[[c for c in range(0x80) if not chr(c).isalpha()]] = 0x20


def profile(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(features, square roots of their shares, number of trigrams) of a whole text."""
    counts = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(raw), PART):
        counts += np.bincount(trigrams(raw[max(0, at - 2): at + PART])[min(at, 2):], minlength=1 << BITS)
    counts[0] = 0
    index = np.flatnonzero(counts)
    count = counts[index]
    return index, np.sqrt(count / max(count.sum(), 1)), int(count.sum())


def _evidence(p: np.ndarray) -> np.ndarray:
    return np.log((1 - UNSEEN) * np.maximum(p, 0) * (1 << BITS) + UNSEEN)


@dataclass
class Familiar:
    """What the learned texts are made of, and how far from that a text is as a rule."""
    evidence: np.ndarray                 # of each feature
    level: np.ndarray                    # of each language: median of its texts' means
    spread: float                        # 95 % quantile of the distances down from there

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], n: np.ndarray, y: np.ndarray, languages: int) -> Familiar:
        p = np.zeros(1 << BITS)
        part = 1 / (languages * np.bincount(y, minlength=languages))        # of each row, by its language
        for (index, value), k in zip(rows, y):
            p[index] += part[k] * np.square(value, dtype=np.float64)
        mean = np.zeros(len(rows))
        for j, ((index, value), k) in enumerate(zip(rows, y)):
            share = np.square(value, dtype=np.float64)
            mean[j] = share @ _evidence(p[index] - part[k] * share)
        level = np.array([np.median(mean[y == k]) for k in range(languages)])
        down = cls(_evidence(p), level, 1.0).oddity(mean, n, y)
        return cls(_evidence(p), level, max(float(np.quantile(down, 0.95)), LEAST_SPREAD))

    def oddity(self, mean: np.ndarray, n: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Of texts of the given mean evidence, numbers of trigrams and languages."""
        return n / (n + PULL) * (self.level[lang] - mean) / self.spread


@dataclass
class Model:
    languages: list[str]
    families: list[list[int]]            # languages of each family
    weights: np.ndarray                  # features x machines
    bias: np.ndarray
    pairs: list[tuple[int, int]]         # of each machine after the family machines: the languages it separates
    scale: np.ndarray                    # of the logistic of each machine's margin
    familiar: Familiar

    def predict(self, shares_dot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, score) of rows of machine sums."""
        p = sigmoid((shares_dot + self.bias) * self.scale)
        n, f = len(p), len(self.families)
        if f > 1:
            odds = np.clip(p[:, :f], 1e-9, None)
            odds = odds / odds.sum(axis=1, keepdims=True)
            family, score = odds.argmax(axis=1), odds.max(axis=1)
        else:
            family, score = np.zeros(n, np.int64), np.ones(n)
        votes = np.zeros((n, len(self.languages)))
        for k, (a, b) in enumerate(self.pairs):
            q = p[:, (f if f > 1 else 0) + k]
            votes[:, a] += q
            votes[:, b] += 1 - q
        member = np.zeros((f, len(self.languages)), bool)
        for i, langs in enumerate(self.families):
            member[i, langs] = True
        size = member.sum(axis=1)[family]
        best = np.where(member[family], votes, -1.0)
        lang = best.argmax(axis=1)
        rivals = np.maximum(size - 1, 1)
        within = np.where(size > 1, best.max(axis=1) / rivals, 1.0)
        return lang, np.clip(score * within, 0, 1)


def _machine(x: Rows, y: np.ndarray, size: int, steps: int = 80) -> tuple[np.ndarray, float, float]:
    """A linear machine with squared hinge loss; classes weigh the same. Then the scale of its logistic."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))

    def gradient(v):
        slack = np.maximum(0, 1 - y * (x.dot(v[:-1]) + v[-1]))
        g = -2 * weight * y * slack
        return np.append(x.back(g, size) + 1e-6 * v[:-1], g.sum())

    v = adam(np.zeros(size + 1), gradient, steps, 0.5)
    margin = y * (x.dot(v[:-1]) + v[-1])
    scales = np.geomspace(0.01, 16, 40)              # with smoothed labels, so that separable classes don't give 0 and 1
    loss = [(weight * (0.99 * np.logaddexp(0, -s * margin) + 0.01 * np.logaddexp(0, s * margin))).sum() for s in scales]
    return v[:-1], v[-1], float(scales[int(np.argmin(loss))])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            index, value, size = [], [], []
            for text in part.column("text"):
                i, v, n = profile(np.frombuffer(text.as_py().encode(), np.uint8))
                index.append(i.astype(np.int32))
                value.append(v.astype(np.float32))
                size.append(n)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32())),
                 pa.array(size, pa.int64())], names=["lang", "index", "value", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE) -> Model | None:
    """Learn from the rows that are not held out; None if there is nothing to learn from."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (crc_mod("doc_id", SPLIT) != 0))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}      # a row per language
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id").cast("string")), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1, sample / n) * (1 << 30)))])
    drawn = one_per_id(rows.where(draw < F.try_element_at(share, F.col("lang"))))       # however many rows an id has
    got = drawn.select("text", "lang").mapInArrow(trimmed(_features), "lang string, index array<int>, value array<float>, n long")
    table = got.toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    if not langs:
        return None
    y = np.array([langs.index(x) for x in table.column("lang").to_pylist()])
    rows_ = [(i.values.to_numpy(), v.values.to_numpy()) for i, v in zip(table.column("index"), table.column("value"))]
    familiar = Familiar.of(rows_, table.column("n").to_numpy(), y, len(langs))
    groups: dict[str, list[int]] = {}
    for k, lang in enumerate(langs):
        groups.setdefault(FAMILY_OF.get(lang, lang), []).append(k)
    families = list(groups.values())
    size = 1 << BITS
    machines = []
    if len(families) > 1:
        x = Rows(rows_)
        machines += [_machine(x, np.where(np.isin(y, f), 1.0, -1.0), size) for f in families]
    pairs = [p for f in families for p in itertools.combinations(f, 2)]
    for a, b in pairs:
        own = np.flatnonzero((y == a) | (y == b))
        machines.append(_machine(Rows([rows_[i] for i in own]), np.where(y[own] == a, 1.0, -1.0), size))
    if not machines:
        return Model(langs, families, np.zeros((size, 0)), np.zeros(0), pairs, np.zeros(0), familiar)
    w, b, s = zip(*machines)
    return Model(langs, families, np.stack(w, axis=1), np.array(b), pairs, np.array(s), familiar)


def score_batch(model: Model | None, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, oddity) of every text of a column, read whole."""
    data, offsets = buffers(column)
    n = len(column)
    if model is None:
        return [UNDETERMINED] * n, np.zeros(n), np.zeros(n)
    sums = np.zeros((n, model.weights.shape[1]))
    mean, size = np.zeros(n), np.zeros(n)
    for i in range(n):
        index, value, size[i] = profile(data[offsets[i]: offsets[i + 1]])
        sums[i] = value @ model.weights[index]
        mean[i] = np.square(value) @ model.familiar.evidence[index]
    lang, score = model.predict(sums)
    odd = model.familiar.oddity(mean, size, lang)
    letters = _letters(data, offsets)
    unclear = np.flatnonzero(letters < 0)         # no ASCII letter, but bytes over 127: ask each text
    texts = column.take(pa.array(unclear)).to_pylist()
    letters[unclear] = [bool(LETTER.search(t or "")) for t in texts]
    names = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(lang, letters)]
    return names, np.where(letters > 0, score, 0.0), odd


_ASCII_LETTER = np.zeros(256, np.int64)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = 1


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """1 with an ASCII letter, 0 without any letter, -1 if only bytes over 127 can tell."""
    def any_of(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[offsets[1:]] > total[offsets[:-1]]

    ascii_letter = any_of(_ASCII_LETTER[data] > 0)
    wide = any_of(data >= 0x80)
    return np.where(ascii_letter, 1, np.where(wide, -1, 0))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # 2**BITS rows x machines, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, _ = score_batch(shared.value, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(id_col, SPLIT) == 0).alias("held_out"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(trimmed(run), f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def keep(docs: DataFrame, model: Model | None, least: float = 0.5, text_col: str = "text",
         oddest: float = np.inf) -> DataFrame:
    """The documents, all columns kept, whose language is determined with a score of `least` or more and which are at
    most `oddest` units away from the learned texts. Without a model (no row had a language) nothing tells a document
    from the rest, and all with a letter stay."""
    if model is None:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                lang, score, odd = score_batch(shared.value, part.column(text_col))
                stays = [k != UNDETERMINED and s >= least and o <= oddest for k, s, o in zip(lang, score, odd)]
                yield part.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(trimmed(run), docs.schema)
