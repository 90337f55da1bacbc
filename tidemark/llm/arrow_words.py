"""Words of Arrow string batches as numpy arrays: one 64-bit hash, document index and byte span per word, without a
Python object per word.

Work is done in chunks of about `CHUNK` bytes cut at bytes outside words, so memory stays bounded by the number of
words of a batch slice however long a text is (a single word longer than a chunk is hashed whole).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19          # bytes hashed at once
SLICE = 1 << 20          # bytes of text per slice of a record batch (at least one row)

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public-domain splitmix64 generator."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


GOLDEN = U64(0x9E3779B97F4A7C15)
_BYTE = mix((np.arange(256, dtype=U64) + U64(1)) * GOLDEN)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Bytes of words: everything but ASCII white space; and ASCII letters, digits and all of non-ASCII.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, off, data = column.buffers()
    n = len(column)
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, width)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `limit` bytes of text, one row at least."""
    _, offsets = buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _cuts(data: np.ndarray, is_word: np.ndarray) -> list[int]:
    """Chunk borders: 0, then bytes outside words at least CHUNK apart, then the end."""
    cuts, at = [0], CHUNK
    while at < len(data):
        step = 1 << 12
        while at < len(data):
            gap = np.flatnonzero(~is_word[data[at: at + step]])
            if len(gap):
                at += int(gap[0])
                break
            at += step
        if at < len(data):
            cuts.append(at)
            at += CHUNK
    return [*cuts, len(data)]


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray,
          lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document index, first byte, end byte) of every word, in order. Words never cross documents."""
    parts = []
    cuts = _cuts(data, is_word)
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            breaks = offsets[np.searchsorted(offsets, a, "left"): np.searchsorted(offsets, b, "left")] - a
            h, s, e = _chunk(data[a:b], breaks, is_word, lower)
            parts.append((h, s + a, e + a))
    if not parts:
        z = np.zeros(0, np.int64)
        return np.zeros(0, U64), z, z, z
    h, s, e = (np.concatenate(x) for x in zip(*parts))
    return h, np.searchsorted(offsets, s, "right") - 1, s, e


def _chunk(data, breaks, is_word, lower):
    inside = is_word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    breaks = breaks[(breaks >= 0) & (breaks < len(data))]
    first[breaks] = inside[breaks]
    before = breaks[breaks > 0] - 1
    last[before] = inside[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, U64), starts, ends
    b = data[inside]
    if lower:
        b = _LOWER[b]
    lens = ends - starts
    base = np.cumsum(lens) - lens
    longest = int(lens.max())
    power = np.cumprod(np.full(longest, U64(0x9FB21C651E98DF25)), dtype=U64)
    k = np.arange(len(b)) - np.repeat(base, lens)
    h = np.add.reduceat(_BYTE[b] * power[k], base)
    return mix(h + lens.astype(U64) * GOLDEN), starts, ends


def ngrams(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its first word) of every run of n words inside one document."""
    if len(h) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    g = h[:m].copy()
    for j in range(1, n):
        g = g * U64(0xD6E8FEB86659FD93) + h[j: j + m]
        g ^= g >> U64(32)
    at = np.flatnonzero(doc[:m] == doc[n - 1:])
    return mix(g[at] + U64(n)), at
