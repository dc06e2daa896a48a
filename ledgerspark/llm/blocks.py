"""Vectorised word and byte helpers shared by the operators of this package.

Texts arrive as Arrow batches. ``text_blocks`` cuts a batch into blocks of a few
megabytes (a longer text is a block of its own), so that the numpy temporaries
of a task stay bounded whatever the batch size; texts themselves are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1 << 16

# A word is a run of digits, letters a-z (after lower-casing A-Z) and bytes from 0x80.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
IS_WORD[65:91] = True

LONG_SPAN = 1024  # longer spans are hashed one by one
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k of eight bytes
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (spreads every input bit over the word)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pow(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept up to the longest asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(p)
        if n <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    large = arr.cast(pa.large_binary()).fill_null(b"")
    if len(large) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = large.buffers()
    o = np.frombuffer(offs, np.int64)[large.offset:large.offset + len(large) + 1]
    buf = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, o - o[0]


def text_blocks(arr: pa.Array, block_bytes: int = BLOCK_BYTES,
                block_rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` for runs of whole rows of at most ``block_bytes`` (one row at least)."""
    buf, offs = text_bytes(arr)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, min(i + block_rows, int(np.searchsorted(offs, offs[i] + block_bytes, "right")) - 1))
        yield i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in runs of at most ``rows`` rows: for results as large as their texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and per row the index of its first word (rows + 1 entries)."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = IS_WORD[buf]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    inner = offs[(offs > 0) & (offs < len(buf))]
    first[inner] = w[inner]
    last[inner - 1] = w[inner - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs, "left")


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``values`` (small non-negative integers), independent of where it stands.

    For buckets of features, where spans overlap; words that are taken as equal go through ``byte_hashes``.
    """
    n = len(values)
    acc = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _pow(_BASE, n + 1)[:n], out=acc[1:])
        h = (acc[ends] - acc[starts]) * _pow(_BASE_INV, n + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number (zeros follow the end)."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded.data, strides=(1,))


def byte_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, eight at a time through the state; equal hashes are no proof of equal bytes."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * np.uint64(_BASE))
    eights = _eights(buf)
    at = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    done = 0
    while len(at):
        left = size[at] - done
        h[at] = mix(h[at] * np.uint64(_BASE) + (eights[starts[at] + done] & _KEEP[np.minimum(left, 8)]))
        done += 8
        at = at[left > 8]
    for i in np.flatnonzero(size > LONG_SPAN):
        h[i] = int.from_bytes(blake2b(buf[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def same_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Per pair of spans, one of ``buf`` and one of ``other``, whether their bytes are equal."""
    size = ends - starts
    same = size == other_ends - other_starts
    mine, theirs = _eights(buf), _eights(other)
    at = np.flatnonzero(same & (size > 0) & (size <= LONG_SPAN))
    done = 0
    while len(at):
        left = size[at] - done
        equal = ((mine[starts[at] + done] ^ theirs[other_starts[at] + done]) & _KEEP[np.minimum(left, 8)]) == 0
        same[at[~equal]] = False
        done += 8
        at = at[equal & (left > 8)]
    for i in np.flatnonzero(same & (size > LONG_SPAN)):
        same[i] = np.array_equal(buf[starts[i]:ends[i]], other[other_starts[i]:other_ends[i]])
    return same


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word after lower-casing A-Z."""
    return byte_hashes(LOWER[buf], starts, ends)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes (across row limits too; callers mask those)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = mix(h * np.uint64(_BASE) + words[k:k + n])
    return h


def code_point_offsets(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code point index of byte positions ``at`` of one text."""
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    return lead[at]
