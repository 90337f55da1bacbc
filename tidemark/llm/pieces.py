"""Encoding Arrow string batches with a `tokenizers` file, by pieces.

Texts are cut at places where the tokenizer cannot join what stands on both sides, so the ids of a text are the ids
of its pieces in order; each distinct piece is encoded once. Batches are taken in slices of equal bytes.

Two kinds of tokenizer, told apart by their JSON:
- white space dropped (a Split that removes what its pattern leaves out): every ASCII white space ends a piece;
- byte-level with a leading space (" word"): a piece begins at a single space between two non-space characters
  (printable ASCII or U+00C0-U+00FF); a run of spaces and any other white space stays inside a piece.
Both split runs of letters from runs of other signs, so a piece also ends between an ASCII letter and one of MARKS, on
either side (no apostrophe: contractions; nothing that composes with a letter). Special strings hold neither white space
nor MARKS (else there are no such cuts), so cuts never fall into one.

With a byte-level tokenizer that changes no byte, every id stands for a fixed number of bytes. New pieces that begin with
a space and end before where one may begin are then encoded in strings of many, and the ids dealt out by their bytes.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.arrow_words import NON_SPACE, buffers

SLICE = 2 << 20          # bytes of text encoded together
KNOWN = 6 << 20          # bytes of distinct pieces that a Python worker remembers before it starts anew
MARKS = b'.,;:!?"()-/'
BATCH = 1 << 18          # bytes of pieces given to the library at once (an encoding takes some hundred times that)
JOINED = 1 << 14         # bytes of pieces given to it as one string


@functools.lru_cache(maxsize=4)
def load(path: str):
    """(tokenizer, whether white space is dropped, whether pieces end at MARKS)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    kinds = described["pre_tokenizer"]
    drops = any(k.get("type") == "Split" and k.get("behavior") == "Removed" and k.get("invert")
                for k in kinds.get("pretokenizers", [kinds]))
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    letters_apart = any(k.get("type") == "ByteLevel" and k.get("use_regex")
                        or "[\\p{L}]+" in str(k.get("pattern", {}).get("Regex")) for k in kinds.get("pretokenizers", [kinds]))
    marks = letters_apart and not any(chr(m) in t["content"] for t in described["added_tokens"] for m in MARKS)
    return tokenizer, drops, marks


@functools.lru_cache(maxsize=4)
def widths(path: str) -> np.ndarray | None:
    """The bytes that every id stands for, where ids are the text's bytes in order; None for other tokenizers."""
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    kind, model = described["pre_tokenizer"] or {}, described["model"]
    plain = not (described["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"))
    if not plain or model.get("type") != "BPE" or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    added = {t["id"]: t for t in described["added_tokens"]}
    if any(t.get(k) for t in added.values() for k in ("lstrip", "rstrip", "single_word", "normalized")):
        return None
    size = np.zeros(max([*model["vocab"].values(), *added]) + 1, np.int64)
    for token, i in model["vocab"].items():
        size[i] = len(token)                         # a character of the byte alphabet per byte
    for i, t in added.items():
        size[i] = len(t["content"].encode())
    return size


_PRINTABLE = np.zeros(256, dtype=bool)
_PRINTABLE[0x21:0x7F] = True
_TRAILING = np.zeros(256, dtype=bool)
_TRAILING[0x80:0xC0] = True


_LETTER, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK[[*MARKS]] = True


def cuts(data: np.ndarray, drops: bool, marks: bool = False) -> np.ndarray:
    """Whether a piece may begin at each byte."""
    begins = np.zeros(len(data), dtype=bool)
    if len(data) < 3:
        return begins
    if drops:
        solid = NON_SPACE[data]
        begins[1:] = solid[1:] & ~solid[:-1]
    else:
        space = data == 0x20
        space[[0, -1]] = False
        at = np.flatnonzero(space)
        before, after = data[at - 1], data[at + 1]
        wide_before = _TRAILING[before] & (data[np.maximum(at - 2, 0)] == 0xC3)
        begins[at[(_PRINTABLE[before] | wide_before) & (_PRINTABLE[after] | (after == 0xC3))]] = True
    if marks:
        letter, mark = _LETTER[data], _MARK[data]
        begins[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    return begins


@functools.lru_cache(maxsize=2)
def encoder(path: str, lengths_only: bool = False) -> Encoder:
    """One per Python worker, so that its tasks share the pieces already encoded."""
    return Encoder(path, lengths_only)


class Encoder:
    """Ids or lengths of the texts of slices."""

    def __init__(self, path: str, lengths_only: bool = False):
        self.tokenizer, self.drops, self.marks = load(path)
        self.widths = None if self.drops else widths(path)
        self.lengths_only = lengths_only
        self._forget()

    def _forget(self):
        self.known = pa.array([], pa.string())
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, their ids in order)."""
        if self.widths is None or not len(new):
            return self._one_by_one(new)
        data, offsets = buffers(new)
        apart = self._apart(data, offsets)
        rest = new.filter(pa.array(~apart))
        counts, ids = self._together(new.filter(pa.array(apart)))
        rest_counts, rest_ids = self._one_by_one(rest)
        # pieces keep their order in `known`, so the two kinds are put back among each other
        lengths = np.zeros(len(new), np.int64)
        lengths[apart], lengths[~apart] = counts, rest_counts
        if self.lengths_only:
            return lengths, ids
        whole, kind = np.zeros(len(ids) + len(rest_ids), np.uint32), np.repeat(apart, lengths)
        whole[kind], whole[~kind] = ids, rest_ids
        return lengths, whole

    @staticmethod
    def _apart(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each piece begins and ends as `cuts` asks of both sides of a space, so that any two may meet."""
        first, last = offsets[:-1], offsets[1:] - 1
        long = np.flatnonzero(last - first >= 1)
        second, end = data[first[long] + 1], data[last[long]]
        wide = _TRAILING[end] & (data[last[long] - 1] == 0xC3)
        ok = np.zeros(len(first), bool)
        ok[long] = (data[first[long]] == 0x20) & (_PRINTABLE[second] | (second == 0xC3)) & (_PRINTABLE[end] | wide)
        return ok

    def _together(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        data, offsets = buffers(new)
        for at, to in self._runs(np.diff(offsets), BATCH):
            raw, inner = data[offsets[at]: offsets[to]].tobytes(), offsets[at: to + 1] - offsets[at]
            strings = [raw[inner[a]: inner[b]].decode() for a, b in self._runs(np.diff(inner), JOINED)]
            got = self._ids(strings)[1]
            ends = np.cumsum(self.widths[got])
            last = np.searchsorted(ends, inner[1:])
            if len(got) and ends[-1] == inner[-1] and (ends[last] == inner[1:]).all():
                counts.append(np.diff(last, prepend=-1))
            else:                                    # an id across two pieces: not known to happen
                own, got = self._one_by_one(new.slice(at, to - at))
                counts.append(own)
            if not self.lengths_only:
                ids.append(got)
        return np.concatenate(counts), np.concatenate(ids)

    def _one_by_one(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for at, to in self._runs(pc.binary_length(new).to_numpy(zero_copy_only=False), BATCH):
            own = new.slice(at, to - at).to_pylist()
            if self.lengths_only and self.widths is None:
                encoded = self.tokenizer.encode_batch_fast(own, add_special_tokens=False)
                lengths.append(np.fromiter(map(len, encoded), np.int64, len(encoded)))
            else:
                counts, got = self._ids(own)
                lengths.append(counts)
                ids.append(got)
        return np.concatenate(lengths), np.concatenate(ids)

    def _ids(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        counts = np.fromiter(map(len, own), np.int64, len(own))
        return counts, np.fromiter(itertools.chain.from_iterable(own), np.uint32, int(counts.sum()))

    @staticmethod
    def _runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
        """Runs of pieces of about `limit` bytes, one piece at least."""
        ends, at = np.cumsum(sizes), 0
        while at < len(ends):
            low = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, low + limit, "right")))
            yield at, to
            at = to

    def pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(document, known piece) of every piece of a string column."""
        data, offsets = buffers(column)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        border = cuts(data, self.drops, self.marks)
        border[offsets[:-1][offsets[:-1] < len(data)]] = True
        begin = np.flatnonzero(border)
        edges = np.append(begin, len(data)).astype(np.int64)
        strings = pa.Array.from_buffers(pa.large_string(), len(begin),
                                        [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.cast(pa.string())
        if self.known.nbytes > KNOWN:
            self._forget()
        where = pc.index_in(distinct, self.known)
        new = distinct.filter(pc.is_null(where))
        where = where.fill_null(-1).to_numpy().astype(np.int64)
        lengths, ids = self._encode(new)
        where[where < 0] = np.arange(len(new)) + len(self.known)
        self.known = pa.concat_arrays([self.known, new])
        self.lengths = np.concatenate([self.lengths, lengths])
        if not self.lengths_only:
            self.ids = np.concatenate([self.ids, ids])
        doc = np.searchsorted(offsets, begin, "right") - 1
        return doc, where[coded.indices.to_numpy()]

    def count(self, column: pa.Array) -> np.ndarray:
        doc, piece = self.pieces(column)
        return np.bincount(doc, weights=self.lengths[piece], minlength=len(column)).astype(np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each)."""
        doc, piece = self.pieces(column)
        n = self.lengths[piece]
        first = np.cumsum(self.lengths) - self.lengths
        total = int(n.sum())
        at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[piece], n)
        counts = np.bincount(doc, weights=n, minlength=len(column)).astype(np.int64)
        return self.ids[at], counts


def by_bytes(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    from tidemark.llm.arrow_words import slices

    for batch in batches:
        yield from slices(batch, column, SLICE)
