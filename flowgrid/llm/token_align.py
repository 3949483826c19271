"""Alignment of two tokenizers' tokens, text by text, and corpus-wide pair counts.

Each text, led by one space, is encoded by a byte-level BPE (A) and by a
sentencepiece model that adds that space itself (B), without special tokens.
Where the bytes behind both token sequences equal space + text, the byte ends
of A's and B's tokens are merged: an offset at which both have an end closes a
group, and all A and B tokens of a group are linked with each other.

* Encoding.  No token of either kind spans a place where a non-blank is
  followed by a space (A's pre-tokens end there; B's vocabulary is checked for
  it), so a text is encoded in the pieces between such places, and a worker
  encodes a piece once for as long as it keeps it.  A model for which that
  doesn't hold encodes whole texts.
* Merging.  The ends of a chunk of texts are two sorted lists.  Binary searches
  along diagonals (merge path) cut their merge into pieces of equal work, which
  are independent; an equal pair of ends is never cut apart.  A piece numbers
  its groups; the group that is open at a piece's end goes on in the next, so
  numbers are stitched by adding up the closed groups before.
* Links.  Pairs are expanded in slabs of bounded size and reduced to (pair,
  times) for each text; a group too large for a slab goes by its distinct ids.
* Counts.  Texts that hold a pair are counted in the tasks before the shuffle.
  The ``head`` most frequent pairs (20 bytes each) are sent to the workers; all
  rarer pairs are looked up by a join on the pair, where no key is hot because
  the frequent ones are gone.  Every pair takes part at any size.

Edge cases: null and empty texts, and texts whose bytes one of the tokenizers
changes, have no tokens (zeros; ``groups_sha256`` is '').  Rows that repeat an
id or have none are texts of their own and count as such.  Special tokens'
strings inside a text are plain text.  Ids are whole numbers.  Other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.session import materialize

TOKENIZERS = "/opt/tokenizers"
A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
WORK = 1 << 16
SLAB = 1 << 22
HEAD = 1 << 20
CHUNK_CHARS = 1 << 19
_KEPT = 1 << 19
_JOINED = 1 << 12
_LEAD = "▁"
#: a leading space and what follows up to a non-blank before the next space
_PIECES = re.compile(r" (?:[^ ]|(?<!\S) )*")
_BLANK_SPACE = re.compile(r"\s ")
#: ASCII and the Latin letters up to U+024F
_STABLE = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")
#: fixed value: how byte-level BPE splits texts before merging
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 stands for itself, the rest was moved beyond 255 in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(moved)}}


class Pair:
    """Both tokenizers, with the bytes of every token, and the pieces encoded
    so far: piece -> number, and by number the ids of either side."""

    def __init__(self, folder: str, a_file: str = A_FILE, b_file: str = B_FILE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(os.path.join(folder, a_file))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=os.path.join(folder, b_file))
        table = byte_of_char()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_LEAD, " ").encode() for i, p in enumerate(pieces)]
        self.by_pieces = self._identity() and not any(_LEAD in p.lstrip(_LEAD) for p in pieces)
        self.lead = self.b.piece_to_id(_LEAD)
        self.width = [np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes)]
        self.ranked = self._ranked()
        self.forget()

    def _identity(self) -> bool:
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        return not model.normalizer_spec.precompiled_charsmap and not model.normalizer_spec.remove_extra_whitespaces

    def _ranked(self):
        """The same BPE by token rank, three times as fast, for texts whose
        character classes no Unicode version changes; None where A's file isn't
        plain byte-level BPE with ids in the order of its merges."""
        spec = json.loads(self.a.to_str())
        model, split, special = spec["model"], spec["pre_tokenizer"] or {}, {t["id"] for t in spec["added_tokens"]}
        plain = (model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and spec["normalizer"] is None
                 and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space"))
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        made = [model["vocab"].get(m.replace(" ", "")) for m in merges]
        if not plain or None in made or any(x >= y for x, y in zip(made, made[1:])):
            return None
        import tiktoken
        ranks = {t: i for i, t in enumerate(self.a_bytes) if t and i not in special}
        return tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def forget(self) -> None:
        self.kept: dict[str, int] = {}
        self.ids = [np.empty(1 << 16, np.int32) for _ in range(2)]
        self.start = [np.zeros(1 << 12, np.int64) for _ in range(2)]  # one more than pieces
        self.same = np.empty(1 << 12, bool)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """A and B ids of a text without its leading space."""
        a = (self.ranked.encode_ordinary(" " + text) if self.ranked and _STABLE.fullmatch(text)
             else self.a.encode(" " + text, add_special_tokens=False).ids)
        return a, self.b.encode(text) if text else [self.lead]

    def _same(self, text: str, a: list[int], b: list[int]) -> bool:
        body = b" " + text.encode()
        return all(b"".join([t[i] for i in ids]) == body for t, ids in ((self.a_bytes, a), (self.b_bytes, b)))

    def _keep(self, pieces: list[str], sides: tuple, cuts: tuple, same: bool) -> None:
        n = len(self.kept)
        m = n + len(pieces)
        if m > len(self.same):
            self.same = np.resize(self.same, 2 * m)
        self.same[n:m] = same
        for k in (0, 1):
            at = int(self.start[k][n])
            if m >= len(self.start[k]):
                self.start[k] = np.resize(self.start[k], 2 * m)
            if at + len(sides[k]) > len(self.ids[k]):
                self.ids[k] = np.resize(self.ids[k], 2 * (at + len(sides[k])))
            self.ids[k][at:at + len(sides[k])] = sides[k]
            self.start[k][n + 1:m + 1] = at + cuts[k]
        for i, p in enumerate(pieces, n):
            self.kept[p] = i

    def learn(self, pieces: list[str]) -> None:
        """Encodes new pieces: together, joined by the spaces that part them in
        texts, and apart where one of them doesn't end in a non-blank or the
        bytes don't come out."""
        lone = [p for p in pieces if not p or p[-1].isspace() or _LEAD in p]
        rest = [p for p in pieces if p and not p[-1].isspace() and _LEAD not in p]
        if self.by_pieces:
            for lo, hi in _chunks(rest, _JOINED):
                some = rest[lo:hi]
                text = " ".join(some)
                a, b = self.encode(text)
                ends = np.cumsum([len(p.encode()) + 1 for p in some])
                if self._same(text, a, b):
                    cuts = [np.searchsorted(np.cumsum(w[x]), ends) + 1 for w, x in zip(self.width, (a, b))]
                    self._keep(some, (a, b), tuple(cuts), True)
                else:
                    lone += some
        else:
            lone += rest
        for p in lone:
            a, b = self.encode(p)
            self._keep([p], (a, b), (np.array([len(a)]), np.array([len(b)])), self._same(p, a, b))

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text, each without its leading space."""
        if not self.by_pieces:
            return [text]
        if _BLANK_SPACE.search(text) or text[0] == " ":
            return [p[1:] for p in _PIECES.findall(" " + text)]
        return text.split(" ")

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Piece numbers of each text (none for an empty one)."""
        parts = [self.pieces(t) if t else [] for t in texts]
        if len(self.kept) > _KEPT:
            self.forget()
        kept = self.kept
        new = dict.fromkeys(p for ps in parts for p in ps if p not in kept)
        if new:
            self.learn(list(new))
        at = kept.__getitem__
        return [np.fromiter(map(at, ps), np.int64, len(ps)) for ps in parts]


class Tokens(NamedTuple):
    """Tokens of consecutive texts: ids, byte ends (running on), first token of each text."""
    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_ptr: np.ndarray
    b_ptr: np.ndarray


def tokens(pair: Pair, texts: list[str]) -> Tokens:
    """Tokens of a chunk of texts; none for texts that can't be aligned."""
    index = [x if pair.same[x].all() else x[:0] for x in pair.numbers(texts)]
    words = np.concatenate(index) if index else np.empty(0, np.int64)
    word_ptr = np.concatenate([[0], np.cumsum([len(x) for x in index])]).astype(np.int64)
    ids, ends, ptrs = [], [], []
    for body, start, width in zip(pair.ids, pair.start, pair.width):
        n = start[words + 1] - start[words]
        upto = np.concatenate([[0], np.cumsum(n)])
        x = body[np.repeat(start[words] - upto[:-1], n) + np.arange(upto[-1])].astype(np.int64)
        ids.append(x)
        ends.append(np.cumsum(width[x]))
        ptrs.append(upto[word_ptr])
    return Tokens(ids[0], ids[1], ends[0], ends[1], ptrs[0], ptrs[1])


def merge_path(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts (in ``a``, in ``b``) of the merge of two sorted lists into pieces of
    ``work`` entries: a binary search along every diagonal.  Equal entries of
    both lists stay in one piece."""
    d = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        below = np.zeros(len(d), bool)
        below[open_] = a[mid[open_]] <= b[d[open_] - 1 - mid[open_]]
        lo, hi = np.where(open_ & below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
    i, j = lo, d - lo
    cut = (i > 0) & (j < len(b))
    cut[cut] = a[i[cut] - 1] == b[j[cut]]
    return i, j + cut


def group_numbers(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Group of every A and B token, from the token ends."""
    i, j = merge_path(a, b, work)
    closed, ga, gb = 0, [], []
    for s, e, u, v in zip(i[:-1], i[1:], j[:-1], j[1:]):
        x, y = a[s:e], b[u:v]
        at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
        both = y[at] == x if len(y) else np.zeros(len(x), bool)
        before = np.cumsum(both)
        ga.append(closed + before - both)
        gb.append(closed + np.searchsorted(x[both], y))
        closed += int(before[-1]) if len(x) else 0
    none = np.empty(0, np.int64)
    return np.concatenate(ga or [none]), np.concatenate(gb or [none])


def _slabs(work: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    total, lo = np.cumsum(work), 0
    while lo < len(work):
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + limit, "right"))
        yield lo, max(hi, lo + 1)
        lo = max(hi, lo + 1)


def _reduce(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) == 1:
        return keys[0], times[0]
    k, t = np.concatenate(keys), np.concatenate(times)
    out, at = np.unique(k, return_inverse=True)
    total = np.zeros(len(out), np.int64)
    np.add.at(total, at, t)
    return out, total


def linked_pairs(t: Tokens, ga: np.ndarray, gb: np.ndarray, base: int, pairs: int, slab: int = SLAB) -> tuple[np.ndarray, np.ndarray]:
    """(text * pairs + a * base + b, times), sorted and distinct."""
    n = int(ga[-1]) + 1 if len(ga) else 0
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    a0, b0 = np.cumsum(na) - na, np.cumsum(nb) - nb
    text = np.searchsorted(t.a_ptr, a0, "right") - 1 if n else a0
    keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for lo, hi in _slabs(na * nb, slab):
        first, last = a0[lo], a0[hi - 1] + na[hi - 1]
        if hi - lo == 1 and na[lo] * nb[lo] > slab:
            ua, ca = np.unique(t.a[first:last], return_counts=True)
            ub, cb = np.unique(t.b[b0[lo]:b0[lo] + nb[lo]], return_counts=True)
            step = max(1, slab // len(ub))
            for s in range(0, len(ua), step):
                keys.append((text[lo] * pairs + ua[s:s + step, None] * base + ub).ravel())
                times.append((ca[s:s + step, None] * cb).ravel())
            continue
        g = ga[first:last]
        k = nb[g]
        x = np.repeat(np.arange(first, last), k)
        y = np.repeat(b0[g], k) + np.arange(len(x)) - np.repeat(np.cumsum(k) - k, k)
        key, c = np.unique(np.repeat(text[g], k) * pairs + t.a[x] * base + t.b[y], return_counts=True)
        keys.append(key)
        times.append(c)
    return _reduce(keys[1:] or keys, times[1:] or times)


def _code_type(pairs: int) -> str:
    return "<u4" if pairs <= 1 << 32 else "<u8"


def planes(x: np.ndarray) -> bytes:
    """Byte planes of sorted numbers: the high ones hardly change, so files stay small."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplaned(col: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of planes, and the first of each row."""
    width = np.dtype(kind).itemsize
    rows = [np.frombuffer(x.as_buffer(), np.uint8).reshape(width, -1).T for x in col]
    size = [len(r) for r in rows]
    body = np.ascontiguousarray(np.concatenate(rows)) if rows else np.empty((0, width), np.uint8)
    return body.view(kind).ravel(), np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


def _written(t: Tokens, ga: np.ndarray, gb: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Decimal ids with the separator after each, in the order of the written
    groups; ``table`` has every id with each of ``, | ;``."""
    last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.empty(0, bool) for g in (ga, gb))
    n = int(ga[-1]) + 1 if len(ga) else 0
    na, nb = np.cumsum(np.bincount(ga, minlength=n)), np.bincount(gb, minlength=n)
    place_a = np.arange(len(ga)) + (np.cumsum(nb) - nb)[ga]
    place_b = np.arange(len(gb)) + na[gb]
    out = np.empty(len(ga) + len(gb), object)
    out[place_a] = table[t.a + size * last_a]
    out[place_b] = table[t.b + 2 * size * last_b]
    return out


#: rows of ``align``; codes and times are byte planes
_ROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary())])
_workers: dict[tuple, tuple] = {}


def _loaded(folder: str, a_file: str, b_file: str) -> tuple:
    key = (folder, a_file, b_file)
    if key not in _workers:
        pair = Pair(*key)
        size = max(len(pair.a_bytes), len(pair.b_bytes))
        table = np.array([f"{i}{sep}" for sep in ",|;" for i in range(size)], object)
        _workers[key] = pair, table, size
    return _workers[key]


def _chunks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if texts:
        yield lo, len(texts)


def _aligner(files: tuple[str, str, str], work: int, slab: int):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, table, size = _loaded(*files)
        base, pairs = len(pair.b_bytes), len(pair.a_bytes) * len(pair.b_bytes)
        for batch in batches:
            texts = pc.fill_null(batch.column("_text"), "").to_pylist()
            for lo, hi in _chunks(texts, CHUNK_CHARS):
                t = tokens(pair, texts[lo:hi])
                ga, gb = group_numbers(t.a_end, t.b_end, work)
                key, times = linked_pairs(t, ga, gb, base, pairs, slab)
                cut = np.searchsorted(key, np.arange(hi - lo + 1) * pairs)
                links = np.concatenate([[0], np.cumsum(times)])[cut]
                code = (key % pairs).astype(_code_type(pairs))
                said = _written(t, ga, gb, table, size)
                n_a, n_b = np.diff(t.a_ptr), np.diff(t.b_ptr)
                closed = np.concatenate([[0], ga + 1])[t.a_ptr]
                rows = []
                for i in range(hi - lo):
                    s, e = t.a_ptr[i] + t.b_ptr[i], t.a_ptr[i + 1] + t.b_ptr[i + 1]
                    sha = hashlib.sha256("".join(said[s:e].tolist())[:-1].encode()).hexdigest() if e > s else ""
                    rows.append((sha, planes(code[cut[i]:cut[i + 1]]), planes(times[cut[i]:cut[i + 1]].astype("<u8"))))
                sha, codes, counts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row")[lo:hi], batch.column("_id")[lo:hi], pa.array(n_a), pa.array(n_b), pa.array(np.diff(closed)),
                     pa.array(np.diff(links)), pa.array(sha, pa.string()), pa.array(codes, pa.binary()), pa.array(counts, pa.binary())],
                    schema=_ROW)
    return align


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, a_file: str = A_FILE,
          b_file: str = B_FILE, work: int = WORK, slab: int = SLAB) -> DataFrame:
    """One written row per text: ``row`` (its number), ``doc_id``, ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256`` and its distinct linked
    pairs (``codes``, a * size of B + b) with ``times``, as byte planes."""
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("_id"), docs[f"`{text_col}`"].alias("_text"))
    rows = rows.select(F.monotonically_increasing_id().alias("_row"), "_id", "_text")
    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary")
    return materialize(rows.mapInArrow(_aligner((folder, a_file, b_file), work, slab), schema), "aligned", compression="zstd")


def _spelled(files: tuple[str, str, str], work: int):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, _, _ = _loaded(*files)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            texts = pc.fill_null(batch.column("_text"), "").to_pylist()
            for lo, hi in _chunks(texts, CHUNK_CHARS):
                t = tokens(pair, texts[lo:hi])
                ga, gb = group_numbers(t.a_end, t.b_end, work)
                out = []
                for i in range(hi - lo):
                    sides = []
                    for ids, g, ptr in ((t.a, ga, t.a_ptr), (t.b, gb, t.b_ptr)):
                        x, y = ids[ptr[i]:ptr[i + 1]], g[ptr[i]:ptr[i + 1]]
                        sides.append([v.tolist() for v in np.split(x, np.flatnonzero(y[1:] != y[:-1]) + 1)] if len(x) else [])
                    out.append([{"a": a, "b": b} for a, b in zip(*sides)])
                yield pa.RecordBatch.from_arrays([batch.column("_id")[lo:hi], pa.array(out, kind)], names=["doc_id", "groups"])
    return spell


def aligned_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, a_file: str = A_FILE,
                   b_file: str = B_FILE, work: int = WORK) -> DataFrame:
    """The alignment itself: per row ``doc_id`` and ``groups``, an array of (a, b) id lists."""
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("_id"), docs[f"`{text_col}`"].alias("_text"))
    return rows.mapInArrow(_spelled((folder, a_file, b_file), work), "doc_id long, groups array<struct<a array<int>, b array<int>>>")


def _counter(kind: str):
    """Texts that hold each code, summed up within the task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, held = [], [], 0

        def out() -> pa.RecordBatch:
            k, n = _reduce(keys, times)
            return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(n)], names=["code", "n"])

        for batch in batches:
            k, n = np.unique(unplaned(batch.column("codes"), kind)[0], return_counts=True)
            keys.append(k)
            times.append(n)
            held += len(k)
            if held > SLAB:
                k, n = _reduce(keys, times)
                keys, times, held = [k], [n], len(k)
                if held > SLAB // 2:
                    yield out()
                    keys, times, held = [], [], 0
        if keys:
            yield out()
    return count


def pair_counts(aligned: DataFrame, base: int, pairs: int) -> DataFrame:
    """(code, n, best) of every linked pair, written: the texts that hold it,
    and whether no pair of the same A id is held by more."""
    counts = aligned.select("codes").mapInArrow(_counter(_code_type(pairs)), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pair-counts")
    a = F.expr(f"code div {base}")
    # one row for each A id: bounded by the vocabulary
    most = counts.groupBy(a.alias("_a")).agg(F.max("n").alias("_most"))
    return materialize(counts.join(F.broadcast(most), a == F.col("_a")).select("code", "n", (F.col("n") == F.col("_most")).alias("best")), "pairs")


def _valued(shared, kind: str, rest: bool):
    """Sums of the codes in the head for each text, or the codes that are not there."""
    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, n, best = shared.value
        for batch in batches:
            code, ptr = unplaned(batch.column("codes"), kind)
            times = unplaned(batch.column("times"), "<u8")[0].astype(np.int64)
            at = np.minimum(np.searchsorted(head, code), max(len(head) - 1, 0))
            known = head[at] == code if len(head) else np.zeros(len(code), bool)
            if rest:
                text = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))[~known]
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(text)), pa.array(code[~known].astype(np.int64)),
                                                  pa.array(times[~known])], names=["row", "code", "times"])
                continue
            times = np.where(known, times, 0)
            sums = []
            for x in (times * n[at], times * best[at]) if len(head) else (times, times):
                total = np.concatenate([[0], np.cumsum(x)])
                sums.append(pa.array(total[ptr[1:]] - total[ptr[:-1]]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in _ROW.names[:7]] + sums, names=[*_ROW.names[:7], "count_sum", "n_best"])
    return value


def _head(pairs_table: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``limit`` most frequent pairs, by code."""
    t = pairs_table.orderBy(F.desc("n"), "code").limit(limit).toArrow()
    code, n, best = (t.column(c).to_numpy() for c in ("code", "n", "best"))
    order = np.argsort(code)
    return code[order].astype(np.uint64), n[order], best[order].astype(np.int64)


def score_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, a_file: str = A_FILE,
                    b_file: str = B_FILE, work: int = WORK, slab: int = SLAB, head: int = HEAD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair is the most held of its A id),
    ``count_sum`` (texts that hold the pair, summed over links) and
    ``groups_sha256``."""
    pair, _, _ = _loaded(folder, a_file, b_file)
    base, pairs = len(pair.b_bytes), len(pair.a_bytes) * len(pair.b_bytes)
    kind = _code_type(pairs)
    aligned = align(docs, id_col, text_col, folder, a_file, b_file, work, slab)
    table = pair_counts(aligned, base, pairs)
    top = _head(table, head)
    top = (top[0].astype(kind), *top[1:])
    shared = docs.sparkSession.sparkContext.broadcast(top)
    names = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    out = aligned.mapInArrow(_valued(shared, kind, False), f"{names}, count_sum long, n_best long")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if table.count() <= len(top[0]):
        return out.select(*columns)
    rare = aligned.select("row", "codes", "times").mapInArrow(_valued(shared, kind, True), "row long, code long, times long")
    more = (rare.join(table, "code").groupBy("row")
            .agg(F.sum(F.col("times") * F.col("n")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best")))
    out = out.join(more, "row", "left")
    return out.withColumns({"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
                            "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}).select(*columns)
