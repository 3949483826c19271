"""Exact substring deduplication by super-k-mer partitioning.

A window is ``window`` consecutive words of one document (words
``[^\\x20\\x09-\\x0D]+``, unchanged).  Every word covered by a window whose word
sequence also starts earlier - in a document with a smaller id, or earlier in
the same document - is removed; windows are judged on the input.

Super-k-mers (``superkmers``) bring all copies of a window into one bucket;
there the windows are sorted and equal neighbours, compared word by word, give
the exact classes.  Only runs of repeated windows leave the bucket; they are
grouped per document and joined with the texts once.

Edge cases: null text has no words; documents shorter than a window lose
nothing; blanks between words are not compared; a null doc_id sorts before all
others; rows that repeat doc_id and text are one document and get the same
result each; a doc_id with different texts is ordered by the texts' hash.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import superkmers as sk
from flowgrid.llm import text as tx

WINDOW = 20
MER = 5


def _window_matrix(b: sk.Bucket, window: int) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(b.n)), b.n)
    rel = np.arange(len(owner)) - np.repeat(np.cumsum(b.n) - b.n, b.n)
    return owner, b.ptr[owner] + rel


def classes(ids: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Exact class number of the ``window`` ids from each position ``at``."""
    h = tx.gram_hashes(tx.mix(ids.astype(np.uint64) + np.uint64(1)), window)[at]
    order = np.argsort(h, kind="stable")
    a = at[order]
    same = h[order][1:] == h[order][:-1]
    for j in range(window):  # equal hashes are confirmed word by word
        same &= ids[a[1:] + j] == ids[a[:-1] + j]
    if (same != (h[order][1:] == h[order][:-1])).any():  # a hash collision: sort by the words themselves
        rows = np.lib.stride_tricks.sliding_window_view(ids, window)[at]
        return np.unique(rows, axis=0, return_inverse=True)[1].ravel()
    out = np.empty(len(at), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], ~same])) if len(at) else 0
    return out


def _judge(window: int):
    def judge(b: sk.Bucket) -> np.ndarray:
        owner, at = _window_matrix(b, window)
        rel = at - b.ptr[owner]
        return sk.window_codes(classes(b.ids, at, window), b.doc[owner], b.key[owner], b.start[owner] + rel)
    return judge


def _cutter(window: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tx.utf8(batch.column("_text"))
            runs = batch.column("_runs")
            for lo, hi in tx.spans(offsets):
                w = tx.words(*tx.part(data, offsets, lo, hi), tx.NON_BLANK)
                body, starts, ends = sk.squeeze(w)
                gone = np.zeros(len(w.starts) + 1, np.int64)
                marked = runs[lo:hi]
                for i in np.flatnonzero(marked.is_valid().to_numpy(zero_copy_only=False)):
                    r = marked[int(i)].values
                    s = r.field(0).to_numpy(zero_copy_only=False).astype(np.int64) + w.ptr[i]
                    n = r.field(1).to_numpy(zero_copy_only=False)
                    np.add.at(gone, s, 1)
                    np.add.at(gone, s + n + window - 1, -1)
                lost = np.cumsum(gone)[:-1] > 0
                doc = w.docs()
                n_removed = np.bincount(doc[lost], minlength=hi - lo)
                digests, texts = [], []
                for i in range(hi - lo):
                    a, z = int(w.ptr[i]), int(w.ptr[i + 1])
                    if not n_removed[i]:
                        left = body[starts[a]:ends[z - 1]] if z > a else b""
                    else:
                        left = b" ".join([body[starts[j]:ends[j]] for j in a + np.flatnonzero(~lost[a:z])])
                    digests.append(hashlib.sha256(left).hexdigest())
                    if with_text:
                        texts.append(left.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id")[lo:hi], pa.array(w.count(), pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(digests, pa.string())] + ([pa.array(texts, pa.string())] if with_text else []),
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"] + (["kept_text"] if with_text else []))
    return cut


def repeated_runs(docs: DataFrame, window: int = WINDOW, mer: int = MER, id_col: str = "doc_id",
                  text_col: str = "text", **bounds) -> DataFrame:
    """Runs of repeated windows per document (see ``superkmers.window_runs``)."""
    return sk.window_runs(docs, _judge(window), window, mer, id_col, text_col, **bounds)


def remove_repeats(docs: DataFrame, window: int = WINDOW, mer: int = MER, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = True, **bounds) -> DataFrame:
    """Per document row: word counts, digest of the words left, and the words
    left joined by one space (``kept_text``, if ``with_text``)."""
    runs = (repeated_runs(docs, window, mer, id_col, text_col, **bounds)
            .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("_runs")))
    rows = sk.source_rows(docs, id_col, text_col)
    known = F.coalesce(rows["_id"], F.lit(sk.NO_ID))
    joined = rows.join(runs, (known == runs["doc_id"]) & (rows["_key"] == runs["text_key"]), "left").select("_id", "_text", "_runs")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return joined.mapInArrow(_cutter(window, with_text), schema)
