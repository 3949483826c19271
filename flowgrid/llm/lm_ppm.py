"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes, learned from the
training documents: one pass counts every context and next byte (A-Z
lower-cased, ``ORDER`` start bytes before and one end byte after a text), the
counts are summed over the whole corpus, shorter contexts are sums of longer
ones.  A byte is predicted from the longest context known; a byte not seen
there escapes (escape estimate: distinct bytes against occurrences), and in
the next shorter context all bytes the longer one has seen are excluded.  The
last resort is uniform over the bytes not excluded.  A document's score is the
log10 probability of its bytes and the end byte.

The model is whole at every size: all contexts and counts of all training
documents take part.  Contexts that share their last ``SHARE`` bytes meet in
one task, where the probability of every distinct code (context and next byte)
of the corpus is computed, trained on or not; shorter contexts are few and
broadcast.  The codes most frequent in the documents (at most ``HEAD_CODES``)
are broadcast with their probabilities; documents look up the others in a
shuffle join, one row per document and code.  Only if ``max_nodes`` is given is
the model cut to that many nodes per order, by a power-of-two count.

The base score is a unigram over words: counts of all training words, exact.
The most frequent words (at most ``HEAD_WORDS``) are broadcast; documents look
up the others in a shuffle join, one row per document and word, and sum up.
Words are identified by a 64-bit hash.

``adaptive_bits`` is the other reading of the method: a trie that starts empty
and learns from the text itself, without a corpus.

Edge cases: null is the empty text (the end token and end byte alone); rows
that repeat a doc_id are scored row by row and counted row by row; a null id
falls into a fold like the text "null".  Extra columns are ignored; an empty
table gives an empty result; without training documents every word has count
0 and every byte the uniform probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import text as tx
from flowgrid.session import materialize

ORDER = 5
SHARE = 2
HEAD_CODES = 1 << 20
HEAD_WORDS = 1 << 17
START, END = 0xFE, 0xFF  # bytes that UTF-8 never has
ALPHABET = 255  # all byte values but START
FLUSH = 1 << 21
SLAB = 1 << 19
WORD, GRAM, OTHER, ROW = 0, 1, 2, 3  # words and codes trained on, codes of the other documents, document rows


def fold(id_col: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary")) % folds


def codes(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(context and next byte) packed into one integer for every byte and end
    of every text, and the number of codes per text."""
    n = np.diff(offsets)
    buf = np.full(len(data) + (order + 1) * len(n), START, np.uint8)
    symbol = np.zeros(len(buf), bool)
    at = 0
    low = tx.LOWER[data]
    for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        at += order
        buf[at:at + z - a] = low[a:z]
        buf[at + z - a] = END
        symbol[at:at + z - a + 1] = True
        at += z - a + 1
    out = buf[order:].astype(np.uint64)
    for j in range(1, order + 1):
        out |= buf[order - j:len(buf) - j].astype(np.uint64) << np.uint64(8 * j)
    return out[symbol[order:]], n + 1


def _merge(a: tuple[np.ndarray, np.ndarray] | None, b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if a is None:
        return b
    k = np.concatenate([a[0], b[0]])
    n = np.concatenate([a[1], b[1]])
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(n, first)


def _learner(order: int):
    """Per task: (kind, key, n) of words trained on and of all byte contexts, combined."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind, kn):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(kn[0]), kind, np.int32)), pa.array(kn[0].view(np.int64)),
                                               pa.array(kn[1].astype(np.int64))], names=["kind", "key", "n"])
        held: dict[int, tuple | None] = {WORD: None, GRAM: None, OTHER: None}
        for batch, train in ((b.filter(pc.equal(b.column("_held"), not t)), t) for b in batches for t in (True, False)):
            data, offsets = tx.utf8(batch.column("_text"))
            for lo, hi in tx.spans(offsets):
                d, o = tx.part(data, offsets, lo, hi)
                found = {GRAM if train else OTHER: codes(d, o, order)[0]}
                if train:
                    found[WORD] = tx.word_hashes(tx.words(d, o, tx.NON_BLANK, lower=True))
                for kind, x in found.items():
                    if len(x):
                        held[kind] = _merge(held[kind], np.unique(x, return_counts=True))
                        if len(held[kind][0]) >= FLUSH:
                            yield rows(kind, held[kind])
                            held[kind] = None
        for kind, kn in held.items():
            if kn is not None:
                yield rows(kind, kn)
    return learn


class Trie:
    """Static byte-context model: per order, nodes (context and byte) with
    counts, and contexts with totals and what escaping from them excludes."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(levels) - 1
        self.nodes, self.counts, self.contexts, self.total, self.kinds = [], [], [], [], []
        self.left_total: list[np.ndarray] = []  # in the next shorter context, without the bytes seen here
        self.left_kinds: list[np.ndarray] = []
        for d, (code, n) in enumerate(levels):
            s = np.argsort(code)
            code, n = code[s].astype(np.uint64), n[s].astype(np.float64)
            ctx = code >> np.uint64(8)
            first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.empty(0, np.int64)
            total = np.add.reduceat(n, first) if len(n) else np.empty(0)
            kinds = np.diff(np.append(first, len(code))).astype(np.float64)
            self.nodes.append(code)
            self.counts.append(n)
            self.contexts.append(ctx[first])
            self.total.append(total)
            self.kinds.append(kinds)
            if d == 0:
                self.left_total.append(np.zeros(len(first)))
                self.left_kinds.append(ALPHABET - kinds)
                continue
            below, found = self._find(self.nodes[d - 1], code & np.uint64((1 << (8 * d)) - 1))
            seen = np.add.reduceat(np.where(found, self.counts[d - 1][below], 0.0), first) if len(n) else np.empty(0)
            known = np.add.reduceat(found.astype(np.float64), first) if len(n) else np.empty(0)
            up, there = self._find(self.contexts[d - 1], self.contexts[d] & np.uint64((1 << (8 * (d - 1))) - 1))
            self.left_total.append(np.where(there, self.total[d - 1][up] - seen, 0.0) if len(n) else np.empty(0))
            self.left_kinds.append(np.where(there, self.kinds[d - 1][up] - known, 0.0) if len(n) else np.empty(0))

    @staticmethod
    def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        i = np.minimum(np.searchsorted(table, x), len(table) - 1)
        return i, table[i] == x

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each code's byte after its context."""
        p = np.zeros(len(code))
        # denominator to use at this order: own totals, or what the longer context leaves
        total, kinds = np.full(len(code), -1.0), np.zeros(len(code))
        live = np.arange(len(code))
        for d in range(self.order, -1, -1):
            c = code[live] & np.uint64((1 << (8 * (d + 1))) - 1)
            at, known = self._find(self.contexts[d], c >> np.uint64(8))
            node, seen = self._find(self.nodes[d], c)
            fresh = known & (total[live] < 0)
            if known.any():
                t = np.where(fresh, self.total[d][at], total[live])
                k = np.where(fresh, self.kinds[d][at], kinds[live])
                size = t + k
                hit = known & seen
                p[live[hit]] += np.log10(self.counts[d][node[hit]] / size[hit])
                escape = known & ~seen & (k > 0)
                p[live[escape]] += np.log10(k[escape] / size[escape])
                out = known & ~seen
                total[live[out]] = self.left_total[d][at[out]]
                kinds[live[out]] = self.left_kinds[d][at[out]]
                live = live[~hit]
            if not len(live):
                return p
        rest = np.where(total[live] < 0, ALPHABET, np.maximum(kinds[live], 1))
        p[live] -= np.log10(rest)
        return p


class Head:
    """log10 probabilities of the frequent codes: a direct-mapped table of the
    most frequent, sorted arrays for those that share a slot with them."""

    def __init__(self, code: np.ndarray, n: np.ndarray, value: np.ndarray):
        self.bits = 21
        s = np.argsort(code)
        self.code, self.value = code[s], value[s]
        self.key = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.fast = np.zeros(1 << self.bits)
        s = np.argsort(n, kind="stable")  # the most frequent come last and stay
        slot = self._slot(code[s])
        self.key[slot], self.fast[slot] = code[s], value[s]

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return (tx.mix(code) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability (0 if not here) and whether it is here."""
        slot = self._slot(code)
        known = self.key[slot] == code
        p = np.where(known, self.fast[slot], 0.0)
        miss = np.flatnonzero(~known)
        if len(miss) and len(self.code):
            at, there = Trie._find(self.code, code[miss])
            p[miss[there]] = self.value[at[there]]
            known[miss[there]] = True
        return p, known


def _mask(d: int) -> int:
    """Bits of a code at order ``d``."""
    return (1 << (8 * (d + 1))) - 1


def _level(code: np.ndarray, n: np.ndarray, d: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    k, at = np.unique(code & np.uint64(_mask(d)), return_inverse=True)
    n = np.bincount(at, n, minlength=len(k)).astype(np.int64)
    return k[n >= floor], n[n >= floor]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups of ``part`` from a partition sorted by it."""
    held: list[pa.RecordBatch] = []
    rows, least = 0, SLAB
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= least:
            t = pa.Table.from_batches(held).combine_chunks()
            part = t.column("part").to_numpy()
            cut = int(np.searchsorted(part, part[-1]))
            if cut:
                yield t.slice(0, cut)
            held, rows = t.slice(cut).to_batches(), t.num_rows - cut
            least = max(SLAB, 2 * rows)
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _prober(shared, order: int):
    """(key, n, p) of every distinct code: occurrences in all documents and
    log10 probability, from whole groups of contexts."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, floors = shared.value
        for t in _whole(batches):
            code, n = t.column("key").to_numpy().view(np.uint64), t.column("n").to_numpy()
            train = t.column("kind").to_numpy() == GRAM
            trie = Trie(low + [_level(code[train], n[train], d, floors[d]) for d in range(len(low), order + 1)])
            u, at = np.unique(code, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.bincount(at, n).astype(np.int64)), pa.array(trie.log10(u))],
                                             names=["key", "n", "p"])
    return probe


def probabilities(grams: DataFrame, order: int = ORDER, max_nodes: int | None = None) -> DataFrame:
    """(key, n, p) of every distinct code, from the (kind, key, n) of the
    longest contexts of all documents."""
    share = min(SHARE, order)
    known = grams.filter(F.col("kind") == GRAM)
    floors = [1] * (order + 1) if max_nodes is None else _floors(known, order, max_nodes)
    low: list[tuple[np.ndarray, np.ndarray]] = []
    if share:  # at most 256 ** share rows
        t = known.groupBy(F.col("key").bitwiseAND(F.lit(_mask(share - 1))).alias("key")).agg(F.sum("n").alias("n")).toArrow()
        code, n = t.column("key").to_numpy().view(np.uint64), t.column("n").to_numpy()
        low = [_level(code, n, d, floors[d]) for d in range(share)]
    shared = grams.sparkSession.sparkContext.broadcast((low, floors))
    part = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * share)) - 1))
    return (grams.select("kind", "key", "n", part.cast("long").alias("part")).repartition("part").sortWithinPartitions("part")
            .mapInArrow(_prober(shared, order), "key long, n long, p double"))


def _floors(grams: DataFrame, order: int, max_nodes: int) -> list[int]:
    """Per order, the count a node needs if at most ``max_nodes`` stay."""
    tables = [grams]
    for d in range(order - 1, -1, -1):  # drop the oldest byte
        shorter = tables[0].groupBy(F.col("key").bitwiseAND(F.lit(_mask(d))).alias("key")).agg(F.sum("n").alias("n"))
        tables.insert(0, materialize(shorter, f"contexts-{d}"))
    floors, floor = [], 1
    for t in tables:
        floor = max(floor, _count_floor(t, max_nodes))
        floors.append(floor)
    return floors


def _count_floor(counts: DataFrame, most: int) -> int:
    """Smallest power of two that at most ``most`` counts reach."""
    bins = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).agg(F.count("*").alias("k")).collect()
    above = 0
    for r in sorted(bins, key=lambda r: -r["b"]):
        above += r["k"]
        if above > most:
            return 1 << (r["b"] + 1)
    return 1


def _tally(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, key) pairs and how often each is there."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else np.empty(0, np.int64)
    return doc[first], key[first], np.diff(np.append(first, len(doc)))


def _scorer(shared, order: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, head, head_log = shared.value
        for batch in batches:
            data, offsets = tx.utf8(batch.column("_text"))
            row_id = batch.column("_row").to_numpy()
            for lo, hi in tx.spans(offsets, 2 << 20):
                d, o = tx.part(data, offsets, lo, hi)
                w = tx.words(d, o, tx.NON_BLANK, lower=True)
                h, doc = tx.word_hashes(w), w.docs()
                at = np.minimum(np.searchsorted(head, h), max(0, len(head) - 1))
                common = head[at] == h if len(head) else np.zeros(len(h), bool)
                base = np.bincount(doc[common], head_log[at[common]], minlength=hi - lo)
                known = np.bincount(doc[common], minlength=hi - lo)
                code, n = codes(d, o, order)
                p, there = frequent.find(code)
                score = np.add.reduceat(p, np.cumsum(n) - n)
                ids = row_id[lo:hi]
                # one row per document, dealt by its own hash, then one per document and rare word or code
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(hi - lo, ROW, np.int32)), pa.array(tx.mix(ids.astype(np.uint64)).view(np.int64)), pa.array(ids),
                    pa.array(np.zeros(hi - lo, np.int64)), batch.column("_id")[lo:hi], batch.column("_held")[lo:hi],
                    pa.array(w.count().astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base.astype(np.float64)), pa.array(score)],
                    names=_SCORED_NAMES)
                rare_code = np.flatnonzero(~there)
                code_doc = np.searchsorted(np.cumsum(n), rare_code, "right")
                for kind, (rd, key, tf) in ((WORD, _tally(doc[~common], h[~common])), (GRAM, _tally(code_doc, code[rare_code]))):
                    for a in range(0, len(rd), 1 << 17):
                        z = min(len(rd), a + (1 << 17))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(z - a, kind, np.int32)), pa.array(key[a:z].view(np.int64)), pa.array(ids[rd[a:z]]), pa.array(tf[a:z]),
                            *[pa.nulls(z - a, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]],
                            names=_SCORED_NAMES)
    return score


_SCORED = "kind int, key long, row long, tf long, id long, held boolean, n long, known long, base double, score double"
_SCORED_NAMES = [c.split()[0] for c in _SCORED.split(", ")]


def score_documents(docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                    order: int = ORDER, max_nodes: int | None = None, head_words: int = HEAD_WORDS, head_codes: int = HEAD_CODES) -> DataFrame:
    """Score all documents with models learned from those where ``training``
    holds (default: fold 1 of 5 is held out).  ``head_words`` and
    ``head_codes`` only say what is broadcast; ``max_nodes`` cuts the model."""
    sc = docs.sparkSession.sparkContext
    held = fold(F.col(id_col)) == 1 if training is None else ~F.coalesce(training, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), held.alias("_held"))
    learned = materialize(rows.select("_held", "_text").mapInArrow(_learner(order), "kind int, key long, n long")
                          .groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = learned.filter(F.col("kind") == WORD).select("key", "n")
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    train_docs = rows.filter(~F.col("_held")).count()
    n_tokens, vocabulary = (sums["n"] or 0) + train_docs, sums["v"] + (train_docs > 0)

    floor = _count_floor(words, head_words)
    top = words.filter(F.col("n") >= floor).toArrow()
    head, n = top.column("key").to_numpy().view(np.uint64), top.column("n").to_numpy()
    s = np.argsort(head)
    grams = materialize(probabilities(learned.filter(F.col("kind") != WORD), order, max_nodes), "probabilities")
    gram_floor = _count_floor(grams, head_codes)
    top = grams.filter(F.col("n") >= gram_floor).toArrow()
    frequent = Head(top.column("key").to_numpy().view(np.uint64), top.column("n").to_numpy(), top.column("p").to_numpy())
    shared = sc.broadcast((frequent, head[s], np.log10(n[s] + 0.5)))

    scored = rows.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(_scorer(shared, order), _SCORED)
    tail = (words.filter(F.col("n") < floor).select(F.lit(WORD).alias("_kind"), F.col("key").alias("_key"), F.log10(F.col("n") + 0.5).alias("_v"))
            .unionByName(grams.filter(F.col("n") < gram_floor).select(F.lit(GRAM).alias("_kind"), F.col("key").alias("_key"), F.col("p").alias("_v"))))
    x = scored.join(tail, (F.col("kind") == F.col("_kind")) & (F.col("key") == F.col("_key")), "left")
    rare, code = F.col("kind") == WORD, F.col("kind") == GRAM
    per_row = x.groupBy("row").agg(
        *[F.max(k).alias(k) for k in ("id", "held", "n", "known", "base", "score")],
        F.sum(F.when(rare, F.col("tf") * F.coalesce("_v", F.log10(F.lit(0.5)))).otherwise(0.0)).alias("tail"),
        F.sum(F.when(rare & F.col("_v").isNotNull(), F.col("tf")).otherwise(0)).alias("tail_known"),
        F.sum(F.when(code, F.col("tf") * F.col("_v")).otherwise(0.0)).alias("tail_score"))
    spread = F.log10(F.lit(n_tokens + 0.5 * (vocabulary + 1)))
    end = float(np.log10(train_docs + 0.5))
    return per_row.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.col("tail_known") + int(train_docs > 0)).alias("n_known"), F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("tail") + end - (F.col("n") + 1) * spread).alias("base_score"),
        (F.col("score") + F.col("tail_score")).alias("score"))


def adaptive_bits(text: str | None, order: int = ORDER) -> float:
    """Code length in bits of a text (and its end) under a trie that learns as
    it reads; exclusion and escapes as above.  Plain Python, per byte."""
    body = bytes(tx.LOWER[np.frombuffer((text or "").encode(), np.uint8)]) + bytes([END])
    seen: dict[bytes, dict[int, int]] = {}
    past, bits = bytes([START]) * order, 0.0
    for b in body:
        excluded: set[int] = set()
        for d in range(order, -1, -1):
            counts = seen.get(past[order - d:])
            if not counts:
                continue
            free = {s: n for s, n in counts.items() if s not in excluded}
            size = sum(free.values()) + len(free)
            if b in free:
                bits -= float(np.log2(free[b] / size))
                break
            if free:
                bits -= float(np.log2(len(free) / size))
            excluded |= counts.keys()
        else:
            bits += float(np.log2(max(1, ALPHABET - len(excluded))))
        for d in range(order + 1):
            node = seen.setdefault(past[order - d:], {})
            node[b] = node.get(b, 0) + 1
        past = (past + bytes([b]))[1:] if order else past
    return bits
