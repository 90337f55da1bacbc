"""Token counts and token files against the library run on whole texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import arrow_words, elias_fano, pieces, token_counts, token_files, workers

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}

TEXTS = [
    None, "", " ", "  \n\t ", "plain words here", "two  spaces   and\n\nlines \n end ", "it's we'll 'S don't I'D",
    "café au lait à l'été naïve", "é ́x < ̸", "a b　c d \u0085 e",
    "<|endoftext|> x<|endoftext|>y <|startoftext|>z < |endoftext|>", "1234 56 7 ٣٤ ²",
    "!!! *** ??", "\U0001f600 \U0001f468‍\U0001f469 text", "ab" * 3000, "word " * 4000, "x" + " " * 500 + "y",
    "a.b,c;d:e!f?g\"h(i)j-k/l", "it's-that/'s('ll)\"'re don't.'s x.'s-'d (I'm)'m", "a.\u0338 b/\u0301c -\u0301a(\u0338b",
    "\x00\x01 \x7f", "中文 日本語 text", "İstanbul ΣΣ ẞ",
]


def whole(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_end_at_marks(path):
    import random

    r = random.Random(6)
    texts = ["".join(r.choice("ab'sltTLé1 .,;:!?\"()-/|<>_\u0301\u0338\n") for _ in range(r.randint(1, 40))) for _ in range(3000)]
    encoder = pieces.Encoder(path)
    assert encoder.marks
    ids, counts = encoder.encode(pa.array(texts))
    want = [whole(path, t) for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_equal_whole_texts(path):
    column = pa.array(TEXTS * 2, pa.string())
    ids, counts = pieces.Encoder(path).encode(column)
    want = [whole(path, t) for t in TEXTS * 2]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert pieces.Encoder(path, lengths_only=True).count(column).tolist() == counts.tolist()


ALPHABET = st.sampled_from(list("ab'sSt1 .!<|>\n\t\r\x0b\x85") + [" ", "é", "́", " ", "中",
                                                                  "<|endoftext|>", "  ", "À", "\U0001f600"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=1, max_size=5))
def test_pieces_equal_whole_texts_property(texts):
    for path in (WORDS, BYTES):
        ids, counts = pieces.Encoder(path).encode(pa.array(texts, pa.string()))
        want = [whole(path, t) for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_pieces_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN", 3)
    coder = pieces.Encoder(BYTES)
    for n in range(20):
        text = f"some words {n} more {n * 7} words"
        assert coder.encode(pa.array([text]))[0].tolist() == whole(BYTES, text)
        assert len(coder.known) <= 3 + 7


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=700).map(sorted))
def test_elias_fano_round_trip(values):
    reader = elias_fano.Reader(elias_fano.encode(np.array(values, np.uint64)))
    assert reader.all().tolist() == values
    for i in range(0, len(values), 7):
        assert reader.select(i) == values[i]
    with pytest.raises(IndexError):
        reader.select(len(values))


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000)).astype(np.uint64)
    bits = 8 * len(elias_fano.encode(ends)) / len(ends)
    assert bits < 2 + np.log2(float(ends[-1]) / len(ends)) + 0.7


def test_token_counts(make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (3, "again")])
    docs = docs.withColumn("n_tokens", docs.doc_id)           # a clashing extra column
    got = token_counts.count(docs, WORDS, limit=5).collect()
    want = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (3, "again")]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()), len(whole(WORDS, t)), len(whole(WORDS, t)) > 5) for i, t in want)
    assert token_counts.count(docs.limit(0), WORDS).count() == 0


def expected_files(rows, end_id):
    start, out = 0, []
    for i, t in rows:
        ids = np.array([*whole(BYTES, t), end_id], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [1, 50, 1 << 21])
def test_token_files_round_trip(spark, make_docs, segment, tmp_path):
    rows = [(7 * i - 40, t) for i, t in enumerate(TEXTS)] + [(2**62, "far"), (-2**62, "near")]
    docs = make_docs(rows)
    docs = docs.withColumn("shard", docs.doc_id * 0)
    path = str(tmp_path / f"out{segment}")
    token_files.write(docs, path, BYTES, 2, segment=segment)
    got = sorted(map(tuple, token_files.read(spark, path).collect()))
    assert got == expected_files(sorted(rows), 2)


def test_token_files_odd_rows(spark, make_docs, tmp_path):
    rows = [(None, "a b"), (None, None), (5, "x y"), (5, "x y"), (5, "other"), (1, "")]
    got = token_files.write_and_read(make_docs(rows), BYTES, 2, path=str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 5, 5, 5]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    one = lambda t: zlib.crc32(np.array([*whole(BYTES, t), 2], "<u4").tobytes())
    assert sorted(r.ids_crc32 for r in got) == sorted(one(t) for _, t in rows)
    empty = token_files.write_and_read(make_docs(rows).limit(0), BYTES, 2, path=str(tmp_path / "none"))
    assert empty.count() == 0


def test_token_files_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sorted(map(tuple, token_files.write_and_read(docs, BYTES, 2).collect())) == expected_files(rows, 2)


def test_new_pieces_go_to_the_library_in_few_strings():
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder, r = pieces.Encoder(path), random.Random(4)
    given, library = [], coder.tokenizer

    class Counting:
        def encode_batch_fast(self, strings, **options):
            given.append(len(strings))
            return library.encode_batch_fast(strings, **options)

    word = lambda: "".join(r.choice("abcdeéÉß×'<|>*19") for _ in range(r.randint(1, 9)))
    texts = [" ".join(word() for _ in range(300)) for _ in range(20)] + ["", " a", "a <|endoftext|> b", "\u00a0 x y z\u00e9 z"]
    coder.tokenizer = Counting()
    ids, counts = coder.encode(pa.array(texts))
    whole = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for own in whole for i in own] and counts.tolist() == [len(own) for own in whole]
    assert sum(given) < 200


def test_worker_slices_are_small():
    assert arrow_words.SLICE <= 1 << 20 and arrow_words.CHUNK < arrow_words.SLICE and workers.ARROW_BATCH == "2m"
