"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>) over the distinct terms of
the whole text.  The pairwise part lets two terms mean more together (an insult
next to a mention of a group) than their weights add up to.

Terms are lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` and, for longer
words, their first ``STEM`` characters (compounds and inflections of a word share
them), by their 64-bit hash.  The model is fitted on at most ``TRAIN_ROWS`` labelled
texts (the smallest hashes of doc_id among those allowed, each (doc_id, text)
once).  Spark counts terms against labels there; all terms with a significant
association, alone or among documents that hold one of the ``OPENERS`` most
significant ones, are kept, and the machine is fitted to those by mini-batch
AdaGrad.
Scoring is one pass over all documents with the small model broadcast.

Edge cases: null labels are ignored, of several labels of a document the
highest counts; null or empty texts and texts without a known term score the
bias; without any training row every score is 0, and with one class only the
smoothed share.  Rows that repeat a doc_id are scored row by row.  Extra
columns are ignored; an empty table gives an empty result.  Labels, ids,
languages and sources are never features.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import text as tx

STEM = 5
TRAIN_ROWS = 20_000
OPENERS = 256
MIN_Z = 6.0
FACTORS = 8
EPOCHS = 20
BATCH = 256
RATE = 0.2
L2 = 1e-5


class Model(NamedTuple):
    terms: np.ndarray  # hashes of the kept terms, sorted
    number: np.ndarray  # their term numbers
    bias: float
    weight: np.ndarray
    factors: np.ndarray


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, document, hash) of every term, by chunks."""
    data, offsets = tx.utf8(batch.column("_text"))
    for lo, hi in tx.spans(offsets):
        w = tx.words(*tx.part(data, offsets, lo, hi), tx.ALNUM, lower=True)
        lead = np.flatnonzero((w.data & 0xC0) != 0x80)  # first bytes of characters
        at = np.searchsorted(lead, w.starts)
        long = np.searchsorted(lead, w.ends) - at > STEM
        stem = w._replace(starts=w.starts[long], ends=lead[at[long] + STEM])
        term = np.concatenate([tx.word_hashes(w), tx.mix(tx.word_hashes(stem))])  # a stem is not the word of that spelling
        doc = w.docs()
        yield lo, hi, np.concatenate([doc, doc[long]]), term


def _numbers(terms: np.ndarray, number: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Term number of each hash, -1 if not kept."""
    if not len(terms):
        return np.full(len(x), -1, np.int64)
    at = np.minimum(np.searchsorted(terms, x), len(terms) - 1)
    return np.where(terms[at] == x, number[at], -1)


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, doc, term in _terms(batch):
            order = np.lexsort((term, doc))
            doc, term = doc[order], term[order]
            once = np.ones(len(doc), bool)
            once[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
            doc, term = doc[once], term[once]
            edge = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("_y")[lo:hi], pa.ListArray.from_arrays(edge, pa.array(term.view(np.int64)))],
                                             names=["y", "terms"])


def _association(rows: DataFrame, min_z: float, known: set[int] = frozenset()) -> list[int]:
    """All terms whose share differs between the labels by ``min_z`` standard
    errors, most significant first, without the known ones."""
    total = rows.agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    n, pos = total["n"], total["pos"] or 0
    if not pos or pos == n:
        return []
    c = rows.select("y", F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"), F.sum("y").alias("a"))
    share = F.col("df") / n
    z = F.abs(F.col("a") / pos - (F.col("df") - F.col("a")) / (n - pos)) / F.sqrt(share * (1 - share) * (1 / pos + 1 / (n - pos)))
    z = F.when((F.col("df") >= 3) & (F.col("df") < n), z)
    top = c.withColumn("z", z).filter(F.col("z") >= min_z).orderBy(F.desc("z"), "t").select("t").collect()
    return [r["t"] for r in top if r["t"] not in known]


def training_rows(docs: DataFrame, labels: DataFrame, allowed: Column, label: str, id_col: str, text_col: str,
                  train_rows: int) -> DataFrame:
    """(y, terms) of the bounded training sample: at most ``train_rows`` texts,
    each (id, text) once however often it is repeated."""
    named = (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_l"), F.col(label).cast("int").alias("_y"))
             .groupBy("_l").agg(F.max("_y").alias("_y")))
    texts = docs.filter(allowed).select(F.col(id_col).alias("_l"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_d"), F.col(text_col).alias("_text"))
    known = texts.select("_l", "_d").distinct().join(named, "_l").orderBy(F.xxhash64("_l"), "_l", "_d").limit(train_rows)
    # at most train_rows small rows: the broadcast is bounded, and so is what the aggregate keeps
    rows = (texts.join(F.broadcast(known), ["_l", "_d"]).groupBy("_l", "_d").agg(F.first("_y").alias("_y"), F.first("_text").alias("_text"))
            .select("_y", "_text"))
    return rows.mapInArrow(_spell, "y int, terms array<long>")


def fit(rows: DataFrame, min_z: float = MIN_Z, factors: int = FACTORS, epochs: int = EPOCHS, openers: int = OPENERS,
        seed: int = 7) -> Model | None:
    """Fit the machine; None without training rows.  Every term of the sample
    that passes the test is in the model; the ``openers`` most significant ones
    say which documents the second, conditional test looks at."""
    rows = rows.persist()
    kept = _association(rows, min_z)
    if kept:
        strong = F.array(*[F.lit(t) for t in kept[:openers]])
        kept += _association(rows.filter(F.arrays_overlap("terms", strong)), min_z, set(kept))
    hashes = np.array(kept, np.int64).view(np.uint64)
    number = np.argsort(hashes)
    terms = hashes[number]
    chosen = rows.sparkSession.sparkContext.broadcast((terms, number))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.column("terms")
            x = [_numbers(*chosen.value, t[i].values.to_numpy().view(np.uint64)) for i in range(len(t))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([np.sort(a[a >= 0]).astype(np.int32) for a in x], pa.list_(pa.int32()))], names=["y", "x"])

    table = rows.mapInArrow(narrow, "y int, x array<int>").toArrow()
    rows.unpersist()
    y = table.column("y").to_numpy().astype(float)
    if not len(y):
        return None
    x = [np.array(v, np.int64) for v in table.column("x").to_pylist()]
    order = sorted(range(len(y)), key=lambda i: (len(x[i]), y[i], x[i].tolist()))  # the order of arrival does not matter
    y, x = y[order], [x[i] for i in order]
    share = (y.sum() + 0.5) / (len(y) + 1)
    rng = np.random.default_rng(seed)
    b, w, v = float(np.log(share / (1 - share))), np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), factors))
    gb, gw, gv = 1e-8, np.full(w.shape, 1e-8), np.full(v.shape, 1e-8)
    for _ in range(epochs if kept and 0 < y.sum() < len(y) else 0):
        turn = rng.permutation(len(y))
        for a in range(0, len(turn), BATCH):
            rows_ = turn[a:a + BATCH]
            size = np.array([len(x[r]) for r in rows_])
            doc, t = np.repeat(np.arange(len(rows_)), size), np.concatenate([x[r] for r in rows_])

            def total(values, by=doc, n=len(rows_)):  # sums of rows of ``values`` by document or term
                return np.stack([np.bincount(by, c, minlength=n) for c in values.T], axis=1) if values.ndim > 1 else np.bincount(by, values, minlength=n)

            s = total(v[t])
            p = 1 / (1 + np.exp(-(b + total(w[t]) + 0.5 * ((s ** 2).sum(axis=1) - total((v[t] ** 2).sum(axis=1))))))
            e = (p - y[rows_]) / len(rows_)
            dw = total(e[doc], t, len(kept))
            dv = total(e[doc, None] * s[doc], t, len(kept)) - dw[:, None] * v + L2 * v
            dw, db = dw + L2 * w, float(e.sum())
            gb, gw, gv = gb + db ** 2, gw + dw ** 2, gv + dv ** 2
            b -= RATE * db / gb ** 0.5
            w -= RATE * dw / np.sqrt(gw)
            v -= RATE * dv / np.sqrt(gv)
    return Model(terms, number, b, w, v)


def margins(model: Model, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
    """Score before the sigmoid of ``n`` documents from (document, hash) pairs,
    each counted once."""
    k = max(1, len(model.terms))
    t = _numbers(model.terms, model.number, term)
    pair = np.unique(doc[t >= 0] * k + t[t >= 0])
    doc, t = pair // k, pair % k
    y = model.bias + np.bincount(doc, model.weight[t], minlength=n)
    for f in range(model.factors.shape[1]):
        v = model.factors[t, f]
        y += 0.5 * (np.bincount(doc, v, minlength=n) ** 2 - np.bincount(doc, v ** 2, minlength=n))
    return y


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi, doc, term in _terms(batch):
                if model is None:
                    p = np.zeros(hi - lo)
                else:
                    p = 1 / (1 + np.exp(-np.clip(margins(model, doc, term, hi - lo), -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column("_id")[lo:hi], pa.array(p)], names=["doc_id", "score"])
    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id`` and ``score`` of every document row; labels are learned only
    from documents where ``allowed`` (a column over ``docs``) holds."""
    model = fit(training_rows(docs, labels, allowed, label, id_col, text_col, train_rows))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
            .mapInArrow(_scorer(shared), "doc_id long, score double"))
