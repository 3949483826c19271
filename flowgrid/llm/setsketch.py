"""SetSketch registers of word-shingle sets (numpy, inside tasks).

Every element owns a Poisson process of points (value, register) drawn from
its hash; a register keeps the smallest value over all elements, stored as
``floor(1 - log_b(value / a))`` truncated to ``0 .. q + 1``: exponentially
spaced truncated minima.  Registers of a union are the element-wise maximum.
With a base near 1 equal registers are about as likely as with MinHash, so
bands of registers work as locality-sensitive keys, and the counts of larger,
smaller and equal registers give the likelihood of the Jaccard similarity.

Only points that can matter are generated: with ``n`` elements the largest of
``m`` minima is near ``ln(m) / n``, so points beyond a limit are left out, and
a set with a register still empty is done again with a larger limit.  The work
per set is about ``n + m ln m``.
"""

from __future__ import annotations

import numpy as np

from flowgrid.llm import text as tx

BASE = 1.001
RATE = 20.0
TOP = 65534
_GAP = 0x9E3779B97F4A7C15
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(h: np.ndarray, ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents and their offsets.  A
    document with fewer than ``k`` words has its whole sequence as the one
    shingle, one without words none."""
    grams = tx.gram_hashes(h, k)
    sets = []
    for a, z in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        if z - a >= k:
            sets.append(np.unique(grams[a:z - k + 1]))
        else:
            sets.append(tx.gram_hashes(h[a:z], z - a) if z > a else np.empty(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def minima(elements: np.ndarray, ptr: np.ndarray, m: int) -> np.ndarray:
    """Smallest point value per set and register (infinite for empty sets)."""
    n = np.diff(ptr)
    out = np.full((len(n), m), np.inf)
    todo, widen = np.flatnonzero(n), 1.5
    while len(todo):
        size = n[todo]
        x = np.concatenate([elements[ptr[i]:ptr[i + 1]] for i in todo])
        row = np.repeat(np.arange(len(todo)), size)
        limit = np.repeat((np.log(m) + widen) / size, size)
        best = np.full(len(todo) * m, np.inf)
        t = np.zeros(len(x))
        j = 0
        while len(x):
            j += 1
            z = tx.mix(x + np.uint64(j * _GAP % (1 << 64)))
            t = t - np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / m
            on = t <= limit
            x, row, limit, t, z = x[on], row[on], limit[on], t[on], z[on]
            reg = (tx.mix(z ^ _OTHER) % np.uint64(m)).astype(np.int64)
            np.minimum.at(best, row * m + reg, t)
        best = best.reshape(len(todo), m)
        out[todo] = best
        todo = todo[np.isinf(best).any(axis=1)]
        widen += 6.0
    return out


def registers(elements: np.ndarray, ptr: np.ndarray, m: int) -> np.ndarray:
    """uint16 registers, one row per set; 0 in empty sets."""
    low = minima(elements, ptr, m)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low / RATE) / np.log(BASE))
    return np.clip(np.where(np.isinf(low), 0, k), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(ku: np.ndarray, kv: np.ndarray, nu: np.ndarray, nv: np.ndarray, j: np.ndarray) -> np.ndarray:
    """log L(j) for pairs of register rows (``pairs x m``) of sets with known
    sizes; ``j`` is a column of similarities per pair (``pairs x grid``)."""
    more, less = (ku > kv).sum(axis=1)[:, None], (ku < kv).sum(axis=1)[:, None]
    same = ku.shape[1] - more - less
    u = (nu / (nu + nv))[:, None]
    v = 1 - u
    tiny = 1e-12
    pu = np.maximum(_p(np.maximum(u - v * j, 0)), tiny)
    pv = np.maximum(_p(np.maximum(v - u * j, 0)), tiny)
    return more * np.log(pu) + less * np.log(pv) + same * np.log(np.maximum(1 - pu - pv, tiny))


def similarity(ku: np.ndarray, kv: np.ndarray, nu: np.ndarray, nv: np.ndarray, grid: int = 64) -> np.ndarray:
    """Maximum-likelihood Jaccard estimate (grid resolution)."""
    top = np.minimum(nu, nv) / np.maximum(nu, nv)
    j = top[:, None] * np.linspace(0, 1, grid + 1)
    return j[np.arange(len(j)), log_likelihood(ku, kv, nu, nv, j).argmax(axis=1)]


def plausible(ku: np.ndarray, kv: np.ndarray, nu: np.ndarray, nv: np.ndarray, threshold: float,
              slack: float = 12.5) -> np.ndarray:
    """Pairs whose similarity may reach ``threshold``: sizes allow it, and the
    likelihood at the threshold is not below the best by a log ratio of
    ``slack`` (five standard deviations)."""
    nu, nv = nu.astype(float), nv.astype(float)
    top = np.minimum(nu, nv) / np.maximum(nu, nv)
    j = top[:, None] * np.linspace(0, 1, 65)
    ll = log_likelihood(ku, kv, nu, nv, j)
    best = ll.max(axis=1)
    at = log_likelihood(ku, kv, nu, nv, np.minimum(threshold, top)[:, None])[:, 0]
    return (top >= threshold - 1e-12) & ((j[np.arange(len(j)), ll.argmax(axis=1)] >= threshold) | (best - at <= slack))
