"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are all windows of ``window`` consecutive words of the benchmark
items (an item with fewer words is one pattern).  Per pattern length there is
one matcher: a shift table indexed by the hash of a block of two words says
how far the search may jump, a suffix bucket (block hash plus hash of the
whole window) selects test strings, and a byte-for-byte comparison of the
words confirms each occurrence.  The search runs over many text lanes at once
(numpy inside Arrow batches) and needs no shuffle.

The benchmark is read in blocks of at most ``max_patterns`` windows; each
block's tables are broadcast (that is their size bound) and searched against
all documents.  With several blocks the findings are combined per document.

Words: texts are lower-cased (A-Z) and cut into
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; whole texts are searched.

Edge cases: null or empty texts have no words and no hits; null or wordless
items have no patterns; a null item_id is reported as "null"; items that
repeat an item_id count once.  Repeated document rows each get their own row.
Extra columns are ignored.  An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import text as tx

WINDOW = 10
MAX_PATTERNS = 200_000
LANE = 256
RESULT = ("doc_id long, text_key long, n_words long, n_hit long, "
          "hits array<struct<start:int,end:int>>, items array<string>")


class Matcher:
    """Shift table and suffix buckets of the patterns of one length (in words)."""

    def __init__(self, length: int, patterns: dict[bytes, list[str]]):
        self.length, self.block = length, min(2, length)
        self.strings = list(patterns)
        self.items = [patterns[s] for s in self.strings]
        body = b"\n".join(self.strings)
        data = np.frombuffer(body, np.uint8)
        sizes = np.array([len(s) + 1 for s in self.strings])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        offsets[-1] = len(data)
        w = tx.words(data, offsets, tx.ALNUM)
        h = tx.word_hashes(w).reshape(len(self.strings), length)
        self.bits = max(12, int(np.ceil(np.log2(max(1, h.size)))) + 4)
        self.shift = np.full(1 << self.bits, length - self.block + 1, np.int32)
        for end in range(self.block - 1, length):  # later block ends allow smaller jumps
            slot = self._slot(h[:, end - 1] if self.block == 2 else None, h[:, end])
            np.minimum.at(self.shift, slot, length - 1 - end)
        whole = tx.gram_hashes(h.ravel(), length)[::length]
        self.order = np.argsort(whole, kind="stable")
        self.bucket = whole[self.order]

    def _slot(self, before: np.ndarray | None, last: np.ndarray) -> np.ndarray:
        x = last if before is None else before * np.uint64(3) + last
        return (tx.mix(x) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, w: tx.Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern index) of every occurrence."""
        n = self.length
        first, stop = w.ptr[:-1] + n - 1, w.ptr[1:]
        lanes = np.maximum(0, -(-(stop - first) // LANE))
        number = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(first, lanes) + number * LANE
        limit = np.minimum(at + LANE, np.repeat(stop, lanes))
        found = []
        while len(at):
            jump = self.shift[self._slot(h[at - 1] if self.block == 2 else None, h[at])]
            stay = jump == 0
            if stay.any():
                found.append(at[stay])
            at = at + np.maximum(jump, 1)
            on = at < limit
            at, limit = at[on], limit[on]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        s = np.sort(np.concatenate(found)) - (n - 1)
        whole = tx.mix(h[s] + np.uint64(n))
        for j in range(1, n):
            whole = tx.mix(whole * np.uint64(tx._STEP) + h[s + j])
        lo = np.searchsorted(self.bucket, whole, "left")
        size = np.searchsorted(self.bucket, whole, "right") - lo
        starts, pats = [], []
        for k in np.flatnonzero(size):
            seen = w.text(int(s[k]), int(s[k]) + n)
            for p in self.order[lo[k]:lo[k] + size[k]]:
                if self.strings[p] == seen:  # patterns are distinct: at most one equals it
                    starts.append(s[k])
                    pats.append(p)
                    break
        return np.array(starts, np.int64), np.array(pats, np.int64)


def patterns_of(item_text: str | None, window: int = WINDOW) -> list[bytes]:
    """Windows of one benchmark item, words joined by one space."""
    data = np.frombuffer((item_text or "").encode(), np.uint8)
    w = tx.words(data, np.array([0, len(data)]), tx.ALNUM, lower=True)
    n = len(w.starts)
    if n <= window:
        return [w.text(0, n)] if n else []
    return [w.text(i, i + window) for i in range(n - window + 1)]


def blocks(benchmark: DataFrame, window: int, max_patterns: int, id_col: str, text_col: str) -> Iterator[dict]:
    """Pattern blocks {length: {pattern: [item ids]}}, read item by item."""
    block: dict[int, dict[bytes, list[str]]] = {}
    n = 0
    for row in benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        item = "null" if row["i"] is None else row["i"]
        for p in patterns_of(row["t"], window):
            ids = block.setdefault(p.count(b" ") + 1, {}).setdefault(p, [])
            if item not in ids:
                ids.append(item)
            n += 1
            if n >= max_patterns:
                yield block
                block, n = {}, 0
    if n:
        yield block


def _finder(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = shared.value
        for batch in batches:
            data, offsets = tx.utf8(batch.column("_text"))
            for lo, hi in tx.spans(offsets):
                w = tx.words(*tx.part(data, offsets, lo, hi), tx.ALNUM, lower=True)
                h = tx.word_hashes(w)
                doc = w.docs()
                delta = np.zeros(len(h) + 1, np.int64)
                items: dict[int, set[str]] = {}
                for m in matchers:
                    s, p = m.search(w, h)
                    np.add.at(delta, s, 1)
                    np.add.at(delta, s + m.length, -1)
                    for d, k in {*zip(doc[s].tolist(), p.tolist())}:
                        items.setdefault(d, set()).update(m.items[k])
                hit = np.cumsum(delta)[:-1] > 0
                n_hit = np.bincount(doc[hit], minlength=hi - lo)
                spans: list[list] = [[] for _ in range(hi - lo)]
                for d in np.flatnonzero(n_hit):
                    a = np.concatenate([[False], hit[w.ptr[d]:w.ptr[d + 1]], [False]])
                    edge = np.flatnonzero(a[1:] != a[:-1])
                    spans[d] = [{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])]
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id")[lo:hi], batch.column("_key")[lo:hi], pa.array(w.count(), pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array([sorted(items.get(d, ())) for d in range(hi - lo)], pa.list_(pa.string()))],
                    names=["doc_id", "text_key", "n_words", "n_hit", "hits", "items"])
    return find


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """Per document row: word count, words inside an occurrence of any pattern,
    the hit word spans and the ids of the items that occur."""
    sc = docs.sparkSession.sparkContext
    source = docs.select(F.col(id_col).cast("long").alias("_id"),
                         F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"),
                         F.col(text_col).alias("_text"))
    found = []
    for block in blocks(benchmark, window, max_patterns, item_col, item_text_col):
        shared = sc.broadcast([Matcher(n, ps) for n, ps in sorted(block.items())])
        found.append(source.mapInArrow(_finder(shared), RESULT))
    if not found:
        found.append(source.mapInArrow(_finder(sc.broadcast([])), RESULT))
    if len(found) == 1:
        return found[0].drop("text_key")
    # several blocks: rows of one document (id and text) meet; _n counts its repeated rows
    rows = found[0].withColumn("_n", F.lit(1))
    for more in found[1:]:
        rows = rows.unionByName(more.withColumn("_n", F.lit(0)))
    merged = rows.groupBy("doc_id", "text_key").agg(
        F.sum("_n").cast("int").alias("_n"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_set("hits")).alias("_h"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merged = merged.withColumn("hits", merge_spans(F.array_sort("_h")))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return (merged.withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("_n"))))
            .select("doc_id", "n_words", n_hit.alias("n_hit"), "hits", "items"))


def _dropper(shared):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers, column = shared.value
        for batch in batches:
            data, offsets = tx.utf8(batch.column(column))
            for lo, hi in tx.spans(offsets):
                w = tx.words(*tx.part(data, offsets, lo, hi), tx.ALNUM, lower=True)
                h, doc = tx.word_hashes(w), w.docs()
                clean = np.ones(hi - lo, bool)
                for m in matchers:
                    clean[doc[m.search(w, h)[0]]] = False
                yield batch.slice(lo, hi - lo).filter(pa.array(clean))
    return drop


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """The rows of ``docs`` (all columns) without an occurrence of any pattern;
    blocks of patterns are filters one after the other, without a shuffle."""
    sc = docs.sparkSession.sparkContext
    names = docs.columns
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # any input names, dots included
    for block in blocks(benchmark, window, max_patterns, item_col, item_text_col):
        shared = sc.broadcast(([Matcher(n, ps) for n, ps in sorted(block.items())], names.index(text_col)))
        docs = docs.mapInArrow(_dropper(shared), docs.schema)
    return docs.toDF(*names)


def merge_spans(spans):
    """Union of sorted [start, end) spans as disjoint spans (array expression)."""
    kind = "array<struct<start:int,end:int>>"

    def add(acc, x):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                         F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when(F.size(acc) == 0, F.array(x)).when(x["start"] <= last["end"], grown).otherwise(F.concat(acc, F.array(x))).cast(kind)
    return F.aggregate(spans, F.array().cast(kind), add)
