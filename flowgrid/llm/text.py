"""Vectorised tokenising and hashing of Arrow text columns (numpy, inside tasks).

Texts of a batch stay one byte buffer; words are index ranges into it, so the
cost is a few array passes and no Python object per word.  Work is cut into
chunks of whole documents (``spans``) to bound memory; a single document
larger than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
_SLICE = 1 << 20
_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_FULL = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(32))
    x = x * _FULL
    x = x ^ (x >> np.uint64(32))
    x = x * _FULL
    return x ^ (x >> np.uint64(32))


#: one pseudo-random 64-bit value per byte value
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))

_code = np.arange(256)
#: bytes of ``[^\x20\x09-\x0D]``
NON_BLANK = ~((_code == 0x20) | ((_code >= 0x09) & (_code <= 0x0D)))
#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` (digits, a-z, everything beyond ASCII)
ALNUM = ((_code >= 0x30) & (_code <= 0x39)) | ((_code >= 0x61) & (_code <= 0x7A)) | (_code >= 0x80)
#: lower-cases A-Z only
LOWER = np.where((_code >= 0x41) & (_code <= 0x5A), _code + 32, _code).astype(np.uint8)


class Words(NamedTuple):
    """Words of consecutive documents: byte ranges and, per document, the
    first word (``ptr`` has one more entry than documents)."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.ptr)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` .. ``last - 1`` joined by one space."""
        d, s, e = self.data, self.starts, self.ends
        return b" ".join(d[s[i]:e[i]].tobytes() for i in range(first, last))


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    body = col.buffers()[2]
    return (np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)), offsets


def spans(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def part(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    return data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of ``kind`` bytes; a run ends at its document's end."""
    if lower:
        data = LOWER[data]
    inside = kind[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        first[edge] = inside[edge]
        last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, 0 .. n - 1, modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, _SLICE + 4096)
        made = {}
        for name, base in (("up", _STEP), ("down", _STEP_INVERSE)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            made[name] = np.multiply.accumulate(a)
        if size > 8 * _SLICE:
            return made["up"][:n], made["down"][:n]
        _powers.update(made)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash per word: a polynomial over the bytes, finalised."""
    out = np.empty(len(w.starts), np.uint64)
    i = 0
    while i < len(out):
        base = w.starts[i]
        j = int(np.searchsorted(w.starts, base + _SLICE))
        n = int(w.ends[j - 1] - base)
        up, down = powers(n + 1)
        h = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[w.data[base:base + n]] * up[:n], out=h[1:])
        s, e = w.starts[i:j] - base, w.ends[i:j] - base
        out[i:j] = mix((h[e] - h[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive word hashes (order matters)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = mix(h[:n] + np.uint64(k))
    for j in range(1, k):
        out = mix(out * np.uint64(_STEP) + h[j:n + j])
    return out


def gram_starts(ptr: np.ndarray, k: int) -> np.ndarray:
    """Indices of words at which ``k`` consecutive words of one document start."""
    ok = np.ones(int(ptr[-1]) if len(ptr) else 0, bool)
    for j in range(1, k):
        at = ptr[1:] - j
        ok[at[at >= ptr[:-1]]] = False
    return np.flatnonzero(ok)
