"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z lower-cased; a text's
shingles are its runs of ``shingle`` words joined by one space, repeats
included (with fewer words the whole sequence is the one shingle).  Each
shingle has its XXH64 (UTF-8, seed 42); a fingerprint bit is 1 if it is set in
over half of them.  Fingerprints link at ``distance`` or fewer differing bits;
a document's component is what links reach.

Two fingerprints within the distance agree in one of ``distance + 1`` blocks of
bits, so each distinct fingerprint goes to one bucket for each block: (mask,
value of the bits in the mask).  Buckets of over ``LIMIT`` members are dealt
again: the bits outside the mask are split into ``distance + 1`` finer blocks
by the same argument, so the bucket becomes several with longer masks, and no
pair is lost.  When few bits are left a bucket can't hold more than the values
of those bits, so all buckets are small, also those of a large group of near
copies.  Inside a bucket members are searched breadth-first by exact Hamming
distance; what leaves it is one link for each member at most, not the pairs.

Edge cases: null texts and texts without words have the fingerprint zero,
which links like any other.  Rows with a null id are linked too, but are never
the smallest id; a component without ids is null.  Rows that repeat an id are
documents of their own; a component is the smallest id among its rows.  Ids
are whole numbers.  Columns other than id and text are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from flowgrid.llm.components import components
from flowgrid.llm.spread import attach
from flowgrid.session import materialize

SHINGLE = 3
DISTANCE = 3
SEED = 42
LIMIT = 4096
_CHUNK = 1 << 16


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 of every shingle of a text."""
    w = text.lower().split()  # bytes: A-Z only, blanks \x20 and \x09-\x0D
    if not w:
        return np.empty(0, np.uint64)
    body = b" ".join(w)
    size = np.fromiter(map(len, w), np.int64, len(w)) + 1
    ends = np.cumsum(size)
    starts = (ends - size).tolist()
    ends = (ends - 1).tolist()[min(k, len(w)) - 1:]
    return np.fromiter((xxh64_intdigest(body[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))


def fingerprint(h: np.ndarray) -> int:
    """Bit by bit the majority of the hashes; 0 without any."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _CHUNK):
        part = h[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def _printer(shingle: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("_text").cast(pa.large_binary()), b"")
            fp = np.fromiter((fingerprint(shingle_hashes(t.as_py(), shingle)) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(fp.view(np.int64))], names=["id", "fp"])
    return prints


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("_id"), docs[f"`{text_col}`"].alias("_text"))
    return rows.mapInArrow(_printer(shingle), "id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer_masks(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` even blocks of the bits outside it added;
    ``[mask]`` where too few bits are left to split."""
    free = [b for b in range(64) if not mask >> b & 1]
    if len(free) < 2 * parts:
        return [mask]
    cut = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[cut[i]:cut[i + 1]]) for i in range(parts)]


def _dealt(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Each fingerprint once for each mask."""
    return rows.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask"))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))


def bucket_links(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, its component's first member) of distinct fingerprints, for
    members that reach another.  Each step compares one member with those not
    yet reached, so a group of near copies costs one pass, not its pairs."""
    left, a, b = fp, [], []
    while len(left) > 1:
        root, left, todo = left[0], left[1:], [left[0]]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                a.append(found)
                b.append(np.full(len(found), root))
                todo.extend(found)
    none = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _linker(distance: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets are runs of equal (mask, value) of a sorted partition."""
        rest = None
        for batch in _with_end(batches):
            if batch is not None and batch.num_rows:
                now = np.stack([batch.column(c).to_numpy() for c in ("mask", "value", "fp")])
                rest = now if rest is None else np.concatenate([rest, now], axis=1)
            if rest is None or not rest.shape[1]:
                continue
            new = np.flatnonzero((rest[:2, 1:] != rest[:2, :-1]).any(axis=0)) + 1
            stop = rest.shape[1] if batch is None else (int(new[-1]) if len(new) else 0)
            first = np.concatenate([[0], new[new < stop]]) if stop else np.empty(0, np.int64)
            last = np.append(first[1:], stop)
            fp = rest[2].astype(np.int64).view(np.uint64)
            a, b = [], []
            pair = first[last - first == 2]  # most buckets that hold several hold two
            near = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= distance]
            a.append(fp[near + 1])
            b.append(fp[near])
            for s, e in zip(first[last - first > 2], last[last - first > 2]):
                x, y = bucket_links(fp[s:e], distance)
                a.append(x)
                b.append(y)
            rest = rest[:, stop:]
            out = [np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["a", "b"])
    return link


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def links(prints: DataFrame, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that join
    everything within ``distance`` bits: their components are those of all
    pairs."""
    if not 0 <= distance <= 15:
        raise ValueError("distance must be 0 to 15")
    masks = finer_masks(0, distance + 1)
    todo = _dealt(prints.select("fp").distinct(), masks)
    done = None
    while True:
        todo = materialize(_keyed(todo), "blocks")
        finer = {m: finer_masks(m, distance + 1) for m in masks}
        split = [m for m in masks if finer[m] != [m]]
        if not split:
            done = todo if done is None else done.unionByName(todo)
            break
        # a few bits left bound a bucket by themselves; larger ones are split
        heavy = todo.groupBy("mask", "value").count().filter((F.col("count") > limit) & F.col("mask").isin([_signed(m) for m in split]))
        heavy = materialize(heavy.select("mask", "value"), "heavy-blocks")
        if heavy.isEmpty():
            done = todo if done is None else done.unionByName(todo)
            break
        small = todo.join(heavy, ["mask", "value"], "left_anti")
        done = small if done is None else done.unionByName(small)
        table = F.create_map(*[x for m in split for x in (F.lit(_signed(m)).cast("long"), F.array(*[F.lit(_signed(f)).cast("long") for f in finer[m]]))])
        todo = (todo.join(heavy, ["mask", "value"], "left_semi")
                .select("fp", F.explode(F.element_at(table, F.col("mask"))).alias("mask")).distinct())
        masks = sorted({f for m in split for f in finer[m]})
    dealt = done.repartition("mask", "value").sortWithinPartitions("mask", "value")
    return materialize(dealt.mapInArrow(_linker(distance), "a long, b long"), "fingerprint-links")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 lowercase hex
    digits), ``component_id`` (smallest id reachable)."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    comp = components(links(prints, distance)).withColumnRenamed("id", "fp")
    joined = prints.join(comp, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    # a component may hold a third of all fingerprints: its minimum is combined map-side, then brought back
    joined = materialize(joined, "print-components")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    table = materialize(attach(joined.select("fp", "root"), least, ["root"]).select("fp", "component_id"), "print-classes")
    return attach(rows, table, ["fp"]).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
