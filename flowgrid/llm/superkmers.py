"""Super-k-mer partitioning of word windows.

Consecutive windows of ``window`` words that share the same minimiser (the
leftmost smallest hash among their ``mer``-word pieces) travel as one packed
string.  Equal windows have equal minimisers, so all copies of a window meet
in the bucket of its minimiser.

A first pass counts minimiser values.  A value that occurs once cannot belong
to a repeated window: a bitmap of fixed size (at most ``MAX_BITS`` bits) marks
the repeated ones and keeps the other strings at home; when the bitmap fills up
it only saves less.  Values that hold a large share of the strings (the fringe
of a passage that many documents contain), at most ``1 / HOT_SHARE`` of them,
are split: their windows travel one by one, keyed by the whole window, so that
no bucket grows with them.

Map side, per Arrow batch: super-k-mers with equal words are combined; only
the first of them is sent, the windows of the others are already known to be
repeats.  Strings for one bucket are compressed into one row.

A document is (doc_id, 64-bit hash of its text); rows that repeat both are one
document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import text as tx
from flowgrid.session import materialize

BATCH_BYTES = 6 << 20
BUCKET_BYTES = 16 << 20
MAX_BITS = 1 << 27
HOT_SHARE = 1e-3
PACKED = "bucket long, payload binary"
RUNS = "doc_id long, text_key long, start int, n int, late boolean"
NO_ID = -(1 << 63)


class Piece(NamedTuple):
    """Super-k-mers: document row, first word, number of windows, minimiser
    value and its word position."""
    doc: np.ndarray
    first: np.ndarray
    n: np.ndarray
    value: np.ndarray
    anchor: np.ndarray


def pieces(h: np.ndarray, ptr: np.ndarray, window: int, mer: int) -> Piece:
    """Runs of windows with one minimiser occurrence."""
    grams = tx.gram_hashes(h, mer)
    span = window - mer + 1
    val, pos = grams, np.arange(len(grams))
    reach = 1
    while reach < span:  # smallest value, leftmost on ties, over `reach` pieces
        step = min(reach, span - reach)
        left = val[:-step] <= val[step:] if len(val) > step else np.empty(0, bool)
        val, pos = np.where(left, val[:len(left)], val[step:]), np.where(left, pos[:len(left)], pos[step:])
        reach += step
    at = tx.gram_starts(ptr, window)
    if not len(at):
        e = np.empty(0, np.int64)
        return Piece(e, e, e, np.empty(0, np.uint64), e)
    p = pos[at]
    new = np.ones(len(at), bool)
    new[1:] = (p[1:] != p[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    start = at[first]
    doc = np.searchsorted(ptr, start, "right") - 1
    return Piece(doc, start, n, val[start], p[first])


def squeeze(w: tx.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, with their new byte ranges."""
    n = w.ends - w.starts
    ends = np.cumsum(n + 1) - 1
    turn = np.zeros(len(w.data) + 1, np.int8)
    turn[w.starts] += 1  # each array holds distinct positions
    turn[w.ends] -= 1
    inside = np.cumsum(turn[:-1], dtype=np.int8).view(bool)
    out = np.full(int(ends[-1]) + 1 if len(n) else 0, 0x20, np.uint8)
    mask = np.ones(len(out), bool)
    mask[ends] = False
    out[mask] = w.data[inside]
    return out.tobytes(), ends - n, ends


def combine(p: Piece, key: np.ndarray, window: int, body: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each piece the index of the first piece (by document, word) with the
    same words, itself included.  ``p`` must be in (document, word) order."""
    order = np.lexsort((np.arange(len(key)), p.n, key))
    k, n = key[order], p.n[order]
    same = np.zeros(len(order), bool)
    same[1:] = (k[1:] == k[:-1]) & (n[1:] == n[:-1])
    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    lead = np.arange(len(order))
    for i in np.flatnonzero(same):
        x, y = int(order[i]), int(head[i])
        last = window - 1
        if body[starts[p.first[x]]:ends[p.first[x] + p.n[x] + last - 1]] == body[starts[p.first[y]]:ends[p.first[y] + p.n[y] + last - 1]]:
            lead[x] = y
    return lead


def _span_hash(h: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``size`` words from ``first``."""
    up, down = tx.powers(len(h) + 1)
    c = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:len(h)], out=c[1:])
    return tx.mix((c[first + size] - c[first]) * down[first] + size.astype(np.uint64))


def _batches(batches: Iterator[pa.RecordBatch]):
    """Parts of batches: ids, hashes, squeezed text, word ranges, hashes, ptr;
    documents of one part are in (id, hash) order."""
    for batch in batches:
        ids = batch.column("_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        keys = batch.column("_key").to_numpy(zero_copy_only=False).astype(np.int64)
        text = batch.column("_text")
        order = np.lexsort((keys, ids))
        if (np.diff(order) != 1).any():
            text, ids, keys = text.take(pa.array(order)), ids[order], keys[order]
        data, offsets = tx.utf8(text)
        for lo, hi in tx.spans(offsets, BATCH_BYTES):
            w = tx.words(*tx.part(data, offsets, lo, hi), tx.NON_BLANK)
            if len(w.starts):
                yield ids[lo:hi], keys[lo:hi], w, tx.word_hashes(w)


def split_hot(p: Piece, hot: np.ndarray, h: np.ndarray, window: int) -> Piece:
    """Replace pieces of hot minimisers by their single windows; the value of
    those is the hash of the whole window."""
    if not len(hot) or not len(p.n):
        return p
    is_hot = np.isin(p.value, hot)
    if not is_hot.any():
        return p
    times = np.where(is_hot, p.n, 1)
    src = np.repeat(np.arange(len(p.n)), times)
    shift = np.arange(len(src)) - np.repeat(np.cumsum(times) - times, times)
    single = is_hot[src]
    first = p.first[src] + np.where(single, shift, 0)
    value = np.where(single, _span_hash(h, first, np.full(len(src), window)), p.value[src])
    return Piece(p.doc[src], first, np.where(single, 1, p.n[src]), value, p.anchor[src])


def _same_rows(ids: np.ndarray, keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Pieces of rows that repeat the previous row's document."""
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (keys[1:] == keys[:-1])
    return again[doc]


def _parts(batches, window: int, mer: int, hot: np.ndarray):
    for ids, keys, w, h in _batches(batches):
        p = pieces(h, w.ptr, window, mer)
        p = Piece(*(a[~_same_rows(ids, keys, p.doc)] for a in p))
        yield ids, keys, w, h, p


def _values(window: int, mer: int):
    """Minimiser values of a part with their number of strings."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, p in _parts(batches, window, mer, np.empty(0, np.uint64)):
            v, n = np.unique(p.value, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(n.astype(np.int64))], names=["value", "n"])
    return count


def _slots(value: np.ndarray, n_bits: int) -> np.ndarray:
    """Bitmap position of a value (the value is a finalised hash already)."""
    return (value >> np.uint64(64 - (n_bits.bit_length() - 1))).astype(np.int64)


def _pack(window: int, mer: int, n_buckets: int, shared):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, bits = shared.value
        for ids, keys, w, h, p in _parts(batches, window, mer, hot):
            at = _slots(p.value, len(bits) * 64)
            twice = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
            p = split_hot(Piece(*(a[twice] for a in p)), hot, h, window)
            if not len(p.n):
                continue
            body, starts, ends = squeeze(w)
            lead = combine(p, _span_hash(h, p.first, p.n + window - 1), window, body, starts, ends)
            own = lead == np.arange(len(lead))
            copied = np.bincount(lead, minlength=len(lead)) > 1
            bucket = (tx.mix(p.value) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            rel = (p.first - w.ptr[p.doc]).astype(np.int32)
            lo, hi = starts[p.first], ends[p.first + p.n + window - 2]
            names, loads = [], []
            for a, b in zip(edges[:-1], edges[1:]):
                i = order[a:b]
                j = i[own[i]]
                loads.append(_dump(
                    [ids[p.doc[i]], keys[p.doc[i]].astype(np.int64), rel[i], p.n[i].astype(np.int32), own[i], p.value[j],
                     (p.anchor[j] - p.first[j]).astype(np.int32), copied[j]],
                    b"\n".join([body[x:y] for x, y in zip(lo[j].tolist(), hi[j].tolist())])))
                names.append(int(bucket[i[0]]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(loads, pa.binary())], names=["bucket", "payload"])
    return pack


_KINDS = [np.int64, np.int64, np.int32, np.int32, bool, np.uint64, np.int32, bool]


def _dump(arrays: list[np.ndarray], body: bytes) -> bytes:
    head = np.array([len(arrays[0]), len(arrays[5])], np.int64).tobytes()
    raw = head + b"".join(a.astype(k).tobytes() for a, k in zip(arrays, _KINDS)) + body
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _load(payload: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    raw = pa.decompress(payload[8:], int(np.frombuffer(payload[:8], np.int64)[0]), codec="zstd", asbytes=True)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    at, out = 16, []
    for i, k in enumerate(_KINDS):
        size = n if i < 5 else m
        out.append(np.frombuffer(raw, k, size, at))
        at += size * np.dtype(k).itemsize
    return out, raw[at:].split(b"\n") if m else []


class Bucket(NamedTuple):
    """The super-k-mers of a bucket whose minimiser value occurs more than once:
    owners, first word and windows of each, word ids (``ids[ptr[i]:ptr[i+1]]``),
    minimiser value and its offset in words."""
    doc: np.ndarray
    key: np.ndarray
    start: np.ndarray
    n: np.ndarray
    value: np.ndarray
    anchor: np.ndarray
    ids: np.ndarray
    ptr: np.ndarray


ALONE, LATE, FIRST = 0, 1, 2


def _runs(b: Bucket, hit: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, key, start, n) of the runs of windows in ``hit`` (ascending)."""
    owner = np.repeat(np.arange(len(b.n)), b.n)
    rel = np.arange(len(owner)) - np.repeat(np.cumsum(b.n) - b.n, b.n)
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
    a = np.flatnonzero(new)
    o = owner[hit[a]]
    return b.doc[o], b.key[o], b.start[o] + rel[hit[a]], np.diff(np.append(a, len(hit)))


def _reduce(judge: Callable[[Bucket], np.ndarray], window: int, firsts: bool):
    """``judge`` gives a code per window of the bucket: it starts earlier too
    (LATE), it is the first of several (FIRST), or neither."""
    def find(table: pa.Table) -> pa.Table:
        cols: list[list[np.ndarray]] = [[] for _ in _KINDS]
        strings: list[bytes] = []
        for payload in table.column("payload").to_pylist():
            arrays, s = _load(payload)
            for c, a in zip(cols, arrays):
                c.append(a)
            strings += s
        doc, key, start, n, own, value, anchor, copied = (np.concatenate(c) for c in cols)
        key = key.astype(np.int64)
        late, first = [(doc[~own], key[~own], start[~own], n[~own])], []
        doc, key, start, n = doc[own], key[own], start[own], n[own]
        _, inverse, times = np.unique(value, return_inverse=True, return_counts=True)
        shared = times[inverse] > 1
        if firsts:
            alone = copied & ~shared
            first.append((doc[alone], key[alone], start[alone], n[alone]))
        many = np.flatnonzero(shared)
        if len(many):
            body = b" ".join([strings[i] for i in many])
            data = np.frombuffer(body, np.uint8)
            w = tx.words(data, np.array([0, len(data)]), tx.NON_BLANK)
            size = w.ends - w.starts
            letters = data[tx.NON_BLANK[data]].tobytes()
            spots = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            ids = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(spots.tobytes()), pa.py_buffer(letters)])
            ids = ids.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            words = n[many] + window - 1
            b = Bucket(doc[many], key[many], start[many], n[many], value[many], anchor[many], ids.astype(np.int32),
                       np.concatenate([[0], np.cumsum(words)]).astype(np.int64))
            codes = judge(b)
            late.append(_runs(b, np.flatnonzero(codes == LATE)))
            if firsts:
                here = (codes == FIRST) | ((codes == ALONE) & np.repeat(copied[many], b.n))
                first.append(_runs(b, np.flatnonzero(here)))
        doc, key, start, n = (np.concatenate(x) for x in zip(*late, *first))
        is_late = np.arange(len(doc)) < sum(len(x[0]) for x in late)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "text_key": pa.array(key, pa.int64()), "start": pa.array(start.astype(np.int32)),
                         "n": pa.array(n.astype(np.int32)), "late": pa.array(is_late)})
    return find


def window_codes(cls: np.ndarray, doc: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Code of each window from its class and place (doc, key, start)."""
    order = np.lexsort((start, key, doc, cls))
    c = cls[order]
    new = np.ones(len(c), bool)
    new[1:] = c[1:] != c[:-1]
    number = np.cumsum(new) - 1
    head = order[np.flatnonzero(new)][number]
    late = (doc[order] != doc[head]) | (key[order] != key[head]) | (start[order] != start[head])
    several = np.bincount(number, late) > 0
    out = np.empty(len(c), np.int8)
    out[order] = np.where(late, LATE, np.where(several[number], FIRST, ALONE))
    return out


def source_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"),
                       F.col(text_col).alias("_text"))


def window_runs(docs: DataFrame, judge: Callable[[Bucket], np.ndarray], window: int, mer: int,
                id_col: str = "doc_id", text_col: str = "text", firsts: bool = False,
                bucket_bytes: int = BUCKET_BYTES, hot_share: float = HOT_SHARE) -> DataFrame:
    """Runs of windows whose words also start earlier, by (doc_id, hash,
    word): ``doc_id``, ``text_key``, ``start`` (0-based), ``n`` windows, ``late``
    true; with ``firsts`` also the runs of windows that are the first of several
    (``late`` false).  A null doc_id is ``NO_ID`` (before all others)."""
    rows = source_rows(docs, id_col, text_col)
    sc = docs.sparkSession.sparkContext
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    n_buckets = int(max(1, 3.3 * total // bucket_bytes))
    # strings: one for every (span + 1) / 2 windows, words of about 6.5 bytes
    strings = total / 6.5 / ((window - mer + 2) / 2)
    n_bits = 1 << int(np.clip(np.ceil(np.log2(max(1, 4 * strings))), 12, np.log2(MAX_BITS)))
    counts = rows.mapInArrow(_values(window, mer), "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    many = materialize(counts.filter(F.col("n") > 1), "minimisers")
    hot = many.filter(F.col("n") >= max(64, hot_share * strings)).select("value").toArrow().column("value").to_numpy()
    shift = 64 - (n_bits.bit_length() - 1)
    slot = F.shiftrightunsigned("value", shift)
    words = (many.groupBy(F.shiftright(slot, 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(value, {shift}) & 63 as int))")).alias("b")).toArrow())
    bits = np.zeros(n_bits // 64, np.uint64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    shared = sc.broadcast((hot.view(np.uint64), bits))
    packed = rows.mapInArrow(_pack(window, mer, n_buckets, shared), PACKED)
    return packed.groupBy("bucket").applyInArrow(_reduce(judge, window, firsts), RUNS)
