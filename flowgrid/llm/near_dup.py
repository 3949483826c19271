"""Near-duplicate documents by SetSketch registers.

Documents are sets of word shingles (words ``[^\\x20\\x09-\\x0D]+`` of the whole
text, A-Z lower-cased).  Two documents are linked if 100 * |A & B| >=
``percent`` * |A | B|; a document's component is what links reach.

1. One pass computes each set's size, digest and registers (``setsketch``).
   Documents with equal sets are one class, represented by the smallest id.
2. Bands of registers are bucket keys.  Every member of a bucket is paired
   with the bucket's smallest id; pairs whose joint likelihood rules the
   threshold out are dropped, the others are verified on the full sets.
3. Buckets that still hold several components are searched completely, but
   only across components: in blocks of bounded size, members that have a
   likely partner (by registers, at the first band they share) get their full
   sets, and every likely pair is verified until the two components are
   linked.  Work within a component, where copies are many, is skipped, and
   what is passed on is members and links, not pairs.

No cap is set anywhere.  A pair at the threshold is missed by all bands with
probability ``(1 - t ** rows) ** bands`` (3e-6 at 0.8, 7e-9 at 0.85).

Edge cases: documents without words have no shingles, form their own component
and are kept; with fewer words than a shingle the whole sequence is the one
shingle; rows with a null id are linked with nothing (component null, kept);
rows that repeat an id are one node and get the same component each; where an
id may stand for several texts, ``keep_documents`` takes each (doc_id, text) as
its own node.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import setsketch as ss
from flowgrid.llm import text as tx
from flowgrid.llm.components import components
from flowgrid.session import arrow_batches, materialize

SHINGLE = 5
PERCENT = 80
BANDS = 32
ROWS = 5
OWN_BLOCK = 256
ALL_BLOCK = 1024
_PAIRS = 1 << 14
#: bytes of a batch of texts, register pairs or set pairs, and of the text sketched at once: what a task holds outside
#: the heap does not grow with the length of the texts (a batch holds one row at least)
BATCH_BYTES = 4 << 20
_TEXT_BYTES = 1 << 20


def _sketcher(shingle: int, m: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tx.utf8(batch.column("_text"))
            for lo, hi in tx.spans(offsets, _TEXT_BYTES):
                w = tx.words(*tx.part(data, offsets, lo, hi), tx.NON_BLANK, lower=True)
                e, p = ss.shingle_sets(tx.word_hashes(w), w.ptr, shingle)
                reg = ss.registers(e, p, m)
                digest = [hashlib.blake2b(e[a:z].tobytes(), digest_size=16).digest() if z > a else None
                          for a, z in zip(p[:-1], p[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id")[lo:hi], pa.array(np.diff(p), pa.int64()), pa.array(digest, pa.binary()),
                     pa.array([r.tobytes() for r in reg], pa.binary())], names=["id", "n", "digest", "reg"])
    return sketch


def _setter(shingle: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tx.utf8(batch.column("_text"))
            for lo, hi in tx.spans(offsets, _TEXT_BYTES):
                w = tx.words(*tx.part(data, offsets, lo, hi), tx.NON_BLANK, lower=True)
                e, p = ss.shingle_sets(tx.word_hashes(w), w.ptr, shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id")[lo:hi], pa.array([e[a:z].tobytes() for a, z in zip(p[:-1], p[1:])], pa.binary())],
                    names=["id", "set"])
    return sets


def _matrix(col: pa.Array, m: int) -> np.ndarray:
    data, _ = tx.utf8(col)
    return data.view(np.uint16).reshape(len(col), m) if len(col) else np.empty((0, m), np.uint16)


def _linked(x: bytes, y: bytes, percent: int) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _likely(m: int, percent: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb")]
                ok = ss.plausible(_matrix(batch.column("ra"), m), _matrix(batch.column("rb"), m), *cols, percent / 100)
                yield batch.select(["a", "b"]).filter(pa.array(ok))
    return keep


def _verify(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_linked(x, y, percent) for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return check


_MEMBER = ["key", "i", "j"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole (key, i, j) groups from batches of a partition sorted by them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        g = np.stack([t.column(c).to_numpy() for c in _MEMBER])
        cut = int(np.flatnonzero((g != g[:, -1:]).any(axis=0))[-1]) + 1 if (g != g[:, -1:]).any() else 0
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _candidate_pairs(t: pa.Table, m: int, rows: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Likely (own, other) row pairs of different components, at the first band
    in which both agree, from whole groups; in slabs of bounded size."""
    col = {c: t.column(c).to_numpy() for c in (*_MEMBER, "id", "component", "n", "band", "own", "major")}
    reg = _matrix(t.column("reg").combine_chunks(), m)
    g = np.stack([col[c] for c in _MEMBER])
    first = np.flatnonzero(np.concatenate([[True], (g[:, 1:] != g[:, :-1]).any(axis=0)]))
    size = np.diff(np.append(first, t.num_rows))
    group = np.repeat(np.arange(len(first)), size)
    own = np.flatnonzero(col["own"])
    todo = np.cumsum(size[group[own]])
    for a, b in _slabs(todo):
        o = own[a:b]
        k = size[group[o]]
        x = np.repeat(o, k)
        y = np.repeat(first[group[o]], k) + np.arange(len(x)) - np.repeat(np.cumsum(k) - k, k)
        small, large = np.minimum(col["n"][x], col["n"][y]), np.maximum(col["n"][x], col["n"][y])
        ok = (~col["own"][y] & (col["component"][x] != col["component"][y]) & (100 * small >= percent * large)
              & (col["major"][y] | (col["id"][y] > col["id"][x])))
        x, y = x[ok], y[ok]
        for s in range(0, len(x), _PAIRS):
            u, v = x[s:s + _PAIRS], y[s:s + _PAIRS]
            same = (reg[u] == reg[v]).reshape(len(u), -1, rows).all(axis=2)
            ok = same.argmax(axis=1) == col["band"][u]
            u, v = u[ok], v[ok]
            ok = ss.plausible(reg[u], reg[v], col["n"][u], col["n"][v], percent / 100) if len(u) else np.empty(0, bool)
            yield u[ok], v[ok]


def _slabs(todo: np.ndarray) -> Iterator[tuple[int, int]]:
    a, done = 0, 0
    while a < len(todo):
        b = max(a + 1, int(np.searchsorted(todo, done + 16 * _PAIRS, "right")))
        yield a, b
        a, done = b, int(todo[b - 1])


def _involved(m: int, rows: int, percent: int):
    """Members of blocks that have a likely partner there."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            hit = np.zeros(t.num_rows, bool)
            for x, y in _candidate_pairs(t, m, rows, percent):
                hit[x] = True
                hit[y] = True
            yield from t.filter(pa.array(hit)).to_batches()
    return pick


def _across(m: int, rows: int, percent: int):
    """Verified links between components, one per own row and other component."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            ids, comp = t.column("id").to_numpy(), t.column("component").to_numpy()
            sets = t.column("set").combine_chunks()
            done: set[tuple[int, int]] = set()
            a, b = [], []
            for x, y in _candidate_pairs(t, m, rows, percent):
                for u, v in zip(x.tolist(), y.tolist()):
                    pair = (int(comp[u]), int(comp[v]))
                    if pair not in done and _linked(sets[u].as_py(), sets[v].as_py(), percent):
                        done.add(pair)
                        a.append(ids[u])
                        b.append(ids[v])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return link


def _blocks(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt into blocks: each
    block holds up to OWN_BLOCK members outside the bucket's largest component
    (``own`` rows) and up to ALL_BLOCK of all members."""
    x = members.join(comp.withColumnRenamed("id", "_c"), F.col("id") == F.col("_c"), "left").drop("_c")
    x = x.withColumn("component", F.coalesce("component", "id"))
    part = x.groupBy("key", "component").agg(F.count("*").alias("k"))
    per_key = part.groupBy("key").agg(F.sum("k").alias("all"), F.max(F.struct("k", "component")).alias("top"), F.count("*").alias("parts"))
    per_key = per_key.filter(F.col("parts") > 1).select(F.col("key").alias("_k"), "all", (F.col("all") - F.col("top.k")).alias("minor"),
                                                        F.col("top.component").alias("_top"))
    x = x.join(per_key, F.col("key") == F.col("_k")).drop("_k")
    n_i, n_j = F.ceil(F.col("minor") / OWN_BLOCK).cast("int"), F.ceil(F.col("all") / ALL_BLOCK).cast("int")
    x = x.withColumns({"major": F.col("component") == F.col("_top"), "n_i": n_i, "n_j": n_j, "h": F.xxhash64("id", F.lit("block"))})
    some = (x.withColumn("own", F.lit(False)).withColumn("j", F.pmod("h", "n_j").cast("int"))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_i") - 1))))
    own = (x.filter(~F.col("major")).withColumn("own", F.lit(True)).withColumn("i", F.pmod(F.shiftright("h", 20), "n_i").cast("int"))
           .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_j") - 1))))
    cols = [*_MEMBER, "id", "component", "n", "band", "own", "major"]
    return some.select(*cols).unionByName(own.select(*cols))


_BLOCK_SCHEMA = "key long, i int, j int, id long, component long, n long, band int, own boolean, major boolean, reg binary"


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest
    id reachable) and ``kept`` (it is that document).  Every Python pass runs
    in here, in batches of bounded size; only joins are left to the caller."""
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _near_duplicates(docs, shingle, percent, bands, rows, id_col, text_col)


def _near_duplicates(docs: DataFrame, shingle: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    m = bands * rows
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sketched = materialize(source.mapInArrow(_sketcher(shingle, m), "id long, n long, digest binary, reg binary"), "sketches")
    reps = materialize(sketched.filter(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("digest")
                       .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("reg").alias("reg")), "classes")

    def band(j: int) -> Column:
        return F.struct(F.lit(j).alias("band"), F.xxhash64(F.lit(j), F.substring("reg", 2 * rows * j + 1, 2 * rows)).alias("key"))

    keyed = reps.select("id", "n", F.explode(F.array(*[band(j) for j in range(bands)])).alias("k")).select("id", "n", "k.band", "k.key")
    shared = keyed.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("_last")).filter(F.col("pivot") != F.col("_last")).drop("_last")
    members = materialize(keyed.join(shared, "key"), "buckets")
    some = members.select("id").distinct()
    sets = materialize(source.join(some, F.col("_id") == F.col("id"), "left_semi").dropDuplicates(["_id", "_text"])
                       .mapInArrow(_setter(shingle), "id long, set binary"), "sets")
    regs = reps.join(some, "id", "left_semi")

    # pairs with the bucket's smallest id
    stars = members.filter(F.col("id") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    near = (stars.join(regs.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("reg").alias("rb")), "b")
            .join(regs.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("reg").alias("ra")), "a")
            .select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely(m, percent), "a long, b long"))
    links = materialize(near.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
                        .join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
                        .select("a", "b", "sa", "sb").mapInArrow(_verify(percent), "a long, b long"), "star-links")

    # what is left: buckets of several components, complete across components
    blocks = _blocks(members.select("key", "id", "n", "band"), components(links))
    dealt = (blocks.join(regs.select(F.col("id").alias("_r"), "reg"), F.col("id") == F.col("_r")).drop("_r")
             .repartition(*_MEMBER).sortWithinPartitions(*_MEMBER))
    involved = materialize(dealt.mapInArrow(_involved(m, rows, percent), _BLOCK_SCHEMA), "involved")
    again = (involved.join(sets.select(F.col("id").alias("_s"), "set"), F.col("id") == F.col("_s")).drop("_s")
             .repartition(*_MEMBER).sortWithinPartitions(*_MEMBER))
    crossing = again.mapInArrow(_across(m, rows, percent), "a long, b long")

    comp = components(links.unionByName(crossing)).withColumnRenamed("id", "_c")
    classes = (reps.select(F.col("digest").alias("_d"), F.col("id").alias("_rep")).join(comp, F.col("_rep") == F.col("_c"), "left")
               .select("_d", F.coalesce("component", "_rep").alias("_comp")))
    out = sketched.select("id", "n", "digest").join(classes, F.col("digest") == F.col("_d"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_comp", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (F.col("id").isNull() | (component == F.col("id"))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document of each component,
    for tables whose ids name one text each: of rows that repeat an id one
    stays, rows with a null id all stay."""
    verdict = near_duplicates(docs, id_col=id_col, **options)
    kept = verdict.filter(F.col("kept")).select(F.col("doc_id").alias("_kept")).distinct()
    out = docs.join(kept, docs[id_col].cast("long").eqNullSafe(kept["_kept"]), "left_semi")
    again = docs.filter(F.col(id_col).isNotNull()).groupBy(id_col).count().filter(F.col("count") > 1)
    if again.isEmpty():
        return out
    return out.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(out.filter(F.col(id_col).isNull()))


def keep_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document, a (doc_id, text),
    of each component: that of the smallest id, one with an id before one
    without.  Of rows equal in both one stays; an id's other texts, and texts
    without an id, are documents of their own."""
    if docs.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).isEmpty():
        return keep_one(docs, id_col=id_col, text_col=text_col, **options)
    tail = "_".join(c for c in docs.columns if c.startswith(("_digest_", "_node_")))
    digest, node = f"_digest_{tail}", f"_node_{tail}"
    # numbers in (id, digest) order, so the smallest of a component has the smallest id; written, so they stay
    order = [F.col(id_col).isNull(), F.col(id_col), F.col(digest)]
    numbered = materialize(docs.withColumn(digest, F.coalesce(F.sha2(F.col(text_col).cast("binary"), 256), F.lit("")))
                           .dropDuplicates([id_col, digest]).repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn(node, F.monotonically_increasing_id()), "documents")
    kept = keep_one(numbered, id_col=node, text_col=text_col, **options)
    return kept.drop(digest, node)
