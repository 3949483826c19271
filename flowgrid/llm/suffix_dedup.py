"""Repeated passages by sparse suffix arrays.

Only suffixes that start at content-selected positions are kept: the leftmost
smallest ``mer``-word hash of every ``window`` consecutive words (a passage of
``window`` words holds at least one of them, the same in every copy).  Suffixes
with one selected value meet in a bucket (``superkmers``), cut to the words
that their windows can reach.  There they are sorted, neighbours are compared
for the length of their common beginning (extension to the right), the
reversed words before them likewise (extension to the left).  A passage of
``window`` words that reaches ``o`` words left of its suffix occurs again
exactly where both the first ``window - o`` words to the right and the ``o``
words to the left agree.

The result holds, per document, the maximal spans of words covered by a
passage of ``window`` words that also starts earlier (smaller doc_id, or
earlier in the same document; ``later`` is true), and the maximal spans covered
by the first occurrence of a passage that comes again (``later`` is false).
Removing the ``later`` spans keeps one copy of every passage.

Edge cases: null or short texts have no spans; a null doc_id sorts before all
others; rows that repeat doc_id and text are one document; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import superkmers as sk
from flowgrid.llm.quality_rules import let

WINDOW = 50
MER = 19


def _padded(ids: np.ndarray, first: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of ``width`` ids from ``first`` on (or backwards), 0 beyond ``size``."""
    j = np.arange(width)
    at = first[:, None] + step * j
    inside = j < size[:, None]
    return np.where(inside, ids[np.where(inside, at, 0)] + 1, 0).astype(">i4")


def sorted_neighbours(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and of each (but the first) in that order the length
    of its common beginning with its neighbour before."""
    width = rows.shape[1]
    if not width:
        return np.arange(len(rows)), np.zeros(max(0, len(rows) - 1), np.int64)
    order = np.argsort(np.ascontiguousarray(rows).view(f"V{4 * width}").ravel(), kind="stable")
    r = rows[order]
    differ = r[1:] != r[:-1]
    return order, np.where(differ.any(axis=1), differ.argmax(axis=1), width)


def _class(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Class of each row by its first ``length`` ids."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], common < length]))
    return out


def _judge(window: int, mer: int):
    reach = window - mer

    def judge(b: sk.Bucket) -> np.ndarray:
        spot = b.ptr[:-1] + b.anchor  # the selected suffix
        total = np.diff(b.ptr)
        right = sorted_neighbours(_padded(b.ids, spot, total - b.anchor, window, 1))
        left = sorted_neighbours(_padded(b.ids, spot - 1, b.anchor, reach, -1))
        base = np.cumsum(b.n) - b.n
        codes = np.zeros(int(b.n.sum()), np.int8)
        for o in range(reach + 1):
            rel = b.anchor - o  # window that starts o words before the suffix
            i = np.flatnonzero((rel >= 0) & (rel < b.n))
            if len(i) > 1:
                pair = _class(*right, window - o)[i] * len(b.n) + _class(*left, o)[i]
                codes[base[i] + rel[i]] = sk.window_codes(pair, b.doc[i], b.key[i], b.start[i] + rel[i])
        return codes
    return judge


def repeated_spans(docs: DataFrame, window: int = WINDOW, mer: int = MER, id_col: str = "doc_id",
                   text_col: str = "text", **bounds) -> DataFrame:
    """Rows (doc_id, start_word, end_word, n_words, later): maximal spans,
    0-based, end exclusive.  A doc_id with several texts has the spans of each."""
    runs = sk.window_runs(docs, _judge(window, mer), window, mer, id_col, text_col, firsts=True, **bounds)
    spans = F.array_sort(F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("n") + (window - 1)).alias("end"))))
    per_doc = runs.groupBy("doc_id", "text_key", "late").agg(spans.alias("s"))
    out = per_doc.select(F.when(F.col("doc_id") != sk.NO_ID, F.col("doc_id")).alias("doc_id"), "late", F.explode(merged("s")).alias("s"))
    return out.select("doc_id", F.col("s.start").cast("long").alias("start_word"), F.col("s.end").cast("long").alias("end_word"),
                      (F.col("s.end") - F.col("s.start")).cast("long").alias("n_words"), F.col("late").alias("later"))


def merged(spans: Column | str) -> Column:
    """Sorted [start, end) spans with overlapping or touching ones joined: a
    span opens where no earlier end reaches it, and closes before the next opening."""
    kind = "array<struct<start:int,end:int>>"

    def reach(acc, x):
        return F.struct(F.greatest(acc["top"], x["end"]).alias("top"),
                        F.concat(acc["open"], F.when(x["start"] > acc["top"], F.array(F.struct(x["start"].alias("start"), acc["top"].alias("end"))))
                                 .otherwise(F.array().cast(kind))).alias("open"))

    walk = F.aggregate(spans, F.struct(F.lit(-1).alias("top"), F.array().cast(kind).alias("open")), reach)
    return let(walk, lambda w: F.transform(w["open"], lambda x, i: F.struct(
        x["start"].alias("start"), F.coalesce(F.get(w["open"], i + 1)["end"], w["top"]).alias("end"))))
