"""SimHash links, conversation trie and token alignment against plain Python."""

import bisect
import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
import xxhash

from flowgrid.llm import conv_trie, q_link, simhash, spread, token_align
from tests.llm.helpers import edge_rows, lower, sha, table, words


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# SimHash

def plain_print(text, k=3):
    w = words(lower(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints, distance=3):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    return {f: find(f) for f in order}


def plain_simhash(rows):
    prints = [(i, plain_print(t)) for i, t, *_ in rows]
    group, least = plain_groups({f for _, f in prints}), {}
    for i, f in prints:
        if i is not None:
            least[group[f]] = min(least.get(group[f], i), i)
    return sorted(((i, f"{f:016x}", least.get(group[f])) for i, f in prints), key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_simhash_edges(spark, clash):
    got = simhash.near_duplicates(table(spark, edge_rows(), clash))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert rows_of(got) == plain_simhash(edge_rows())


def test_simhash_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = rows_of(q_link.op11_simhash_pigeonhole(spark, "/root/testdata/sf0.001"))
    assert got == plain_simhash(rows)
    assert len({c for _, _, c in got}) < len(got)


def test_simhash_empty(spark):
    assert simhash.near_duplicates(table(spark, [])).collect() == []


@pytest.mark.parametrize("limit", [60, 4096])
def test_dense_buckets_are_split_without_loss(spark, limit):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(2):
        base, bits = rng.getrandbits(64), rng.sample(range(64), 12)
        prints |= {base ^ sum(1 << b for b in bits if rng.random() < 0.3) for _ in range(150)}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in prints}
    links = simhash.links(spark.createDataFrame([(s,) for s in signed.values()], "fp long"), 3, limit).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 64 for r in links)
    root = {s: s for s in signed.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in links:
        root[find(r.a)] = find(r.b)
    ours, theirs = defaultdict(set), defaultdict(set)
    for f, g in plain_groups(prints).items():
        theirs[g].add(f)
        ours[find(signed[f])].add(f)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_finer_masks_cover_every_bit_once():
    masks = simhash.finer_masks(0, 4)
    assert sum(m.bit_count() for m in masks) == 64 and len(masks) == 4
    finer = simhash.finer_masks(masks[0], 4)
    assert all(m & masks[0] == masks[0] for m in finer) and sum((m ^ masks[0]).bit_count() for m in finer) == 48
    assert simhash.finer_masks((1 << 60) - 1, 4) == [(1 << 60) - 1]


# spread

def test_attach_spreads_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(spread, "LEAST", 5)
    rows = spark.createDataFrame([(i, 7 if i % 3 else i) for i in range(90)] + [(100, 8), (101, 8)], "i long, k long")
    side = spark.createDataFrame([(k, f"v{k}") for k in (*range(0, 50, 2), 7)], "k long, v string")
    for how in ("left", "inner", "left_semi"):
        assert spread.hot_keys(rows, ["k"]) != []
        assert rows_of(spread.attach(rows, side, ["k"], how)) == rows_of(rows.select("k", "i").join(side, "k", how).select("i", "k", *(["v"] if how != "left_semi" else [])))
    missing = side.filter("k <> 7")
    assert rows_of(spread.attach(rows, missing, ["k"], "left")) == rows_of(rows.join(missing, "k", "left").select("i", "k", "v"))


def test_running_over_partitions(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, rng.getrandbits(40), rng.randrange(9)) for i in range(400)]
    got = spread.running(spark.createDataFrame(rows, "g long, o long, x long, s long"), "g", ["o"], ["x"], ["s"]).collect()
    want, state = {}, defaultdict(lambda: (0, 0, 0))
    for g, o, x, s in sorted(rows):
        k, y, t = state[g]
        state[g] = want[g, o] = (k + 1, y ^ x, t + s)
    assert {(r.g, r.o): (r.place, r.x, r.s) for r in got} == want


# conversations

def plain_trie(rows):
    talk = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            talk[c].append((turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}"), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in talk.items()}
    built = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(c - 20 * int(c / 20))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    saved, leaves = Counter(), Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(members) - 1) * (len(words(k[-1][1])) if k else 0)
            leaves[k[:d]] += not kids[k]
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    sha(",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))))) for k, m in nodes.items()), key=repr)


def trie(df):
    return rows_of(conv_trie.prefix_trie(*conv_trie.spliced(conv_trie.turns(df))))


SCHEMA = "conv_id long, turn long, role string, text string"


def test_trie_edges(spark):
    rows = [(20, 0, "user", "a b"), (20, 1, None, None), (20, 2, "", ""), (21, None, "user", "first"), (21, 5, "user", "late"),
            (22, 0, "user", "a b"), (23, 1, "x", "y z"), (None, 0, "user", "lost"), (24, 0, None, "one  two\nthree"), (45, 0, "u", "t"),
            (40, 0, "u", "t"), (41, 0, "u", "t"), (42, 0, "u", "t"), (43, 0, "ut", ""), (0, 0, "u", "t"), (60, 0, "u", "t" * 9000),
            (61, 0, "u", "v"), (61, 0, "u", "v"), (61, 0, "a", "v"), (20, 3, "u", "v"), (200, 0, "u", "v")]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F
    clash = df.withColumns({c: F.lit("clash") for c in ("conv", "place", "t", "d", "p", "q", "seq", "a.b", "_pid")})
    want = plain_trie(rows)
    assert trie(df) == want and trie(clash) == want
    assert trie(spark.createDataFrame([], SCHEMA)) == []


def test_trie_of_random_talk(spark, monkeypatch):
    monkeypatch.setattr(spread, "LEAST", 3)  # hot keys take their own way
    rng = random.Random(8)
    rows = [(c, t, rng.choice("ua"), rng.choice(["x", "y y", "x x x"])) for c in range(0, 260) for t in range(rng.choice([1, 2, 5, 9, 17]))
            if rng.random() < 0.97]
    rows += [(c, t, "u", "same") for c in range(300, 340) for t in range(6)]
    assert trie(spark.createDataFrame(rows, SCHEMA)) == plain_trie(rows)


def test_two_fattest(spark):
    got = spark.createDataFrame([(a, b) for b in range(1, 40) for a in range(b)], "a long, b long").withColumn("f", conv_trie.two_fattest("a", "b"))
    for a, b, f in got.collect():
        assert f == max(range(a + 1, b + 1), key=lambda n: n & -n)


# token alignment

def plain_alignment(texts):
    pair = token_align._loaded(token_align.TOKENIZERS, token_align.A_FILE, token_align.B_FILE)[0]
    out, held = [], Counter()
    for t in texts:
        x, y = (pair.a.encode(" " + t, add_special_tokens=False).ids, pair.b.encode(t)) if t else ([], [])
        body = (" " + t).encode() if t else b""
        if not t or any(b"".join(table[i] for i in ids) != body for ids, table in ((x, pair.a_bytes), (y, pair.b_bytes))):
            out.append(None)
            continue
        ends = [list(accumulate(len(table[i]) for i in ids)) for ids, table in ((x, pair.a_bytes), (y, pair.b_bytes))]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in both]
        for side, ids in enumerate((x, y)):
            for i, e in zip(ids, ends[side]):
                groups[bisect.bisect_left(both, e)][side].append(i)
        links = Counter((a, b) for p, q in groups for a in p for b in q)
        held.update(links.keys())
        out.append((len(x), len(y), groups, links))
    best = Counter()
    for (a, _), n in held.items():
        best[a] = max(best[a], n)

    def row(r):
        if r is None:
            return 0, 0, 0, 0, 0, 0, ""
        n_a, n_b, groups, links = r
        spelled = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        return (n_a, n_b, len(groups), sum(links.values()), sum(k for p, k in links.items() if held[p] == best[p[0]]),
                sum(k * held[p] for p, k in links.items()), sha(spelled))
    return [row(r) for r in out], [r and r[2] for r in out]


ODD = ["a  b ", " ", "", None, " a", "\n\n x  \n y", "a▁b", "　 x   y", "<s> <|endoftext|> hi", "é" * 50, "x" * 5000, "é 😀😀 日本語 " * 3,
       "tab\t end\t", "\x1c \x85 q", "  ", "\x00 a", "the cat", "the cat"]


@pytest.mark.parametrize(("work", "slab", "head"), [(1 << 16, 1 << 22, 1 << 20), (5, 7, 3), (1, 1, 0)])
def test_alignment_edges(spark, work, slab, head):
    texts = ODD + [t for _, t, *_ in edge_rows()][3:5]
    docs = spark.createDataFrame([(i if i % 5 else None, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, row string, `a.b` string")
    got = token_align.score_alignment(docs, work=work, slab=slab, head=head)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = plain_alignment(texts)[0]
    assert rows_of(got) == sorted(((i if i % 5 else None, *w) for i, w in enumerate(want)), key=repr)


def test_alignment_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, groups = plain_alignment([r.text for r in docs])
    got = rows_of(q_link.op13_merge_path_alignment(spark, "/root/testdata/sf0.001"))
    assert got == sorted(((r.doc_id, *w) for r, w in zip(docs, want)), key=repr)
    table_ = spark.createDataFrame([tuple(r) for r in docs], "doc_id long, text string")
    spelled = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in token_align.aligned_groups(table_, work=100).collect()}
    assert spelled == {r.doc_id: g or [] for r, g in zip(docs, groups)}


def test_alignment_empty(spark):
    assert token_align.score_alignment(table(spark, [])).collect() == []


def test_merge_path_pieces():
    import numpy as np
    rng = random.Random(4)
    for _ in range(200):
        end = rng.randrange(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, end + 1), rng.randrange(end)), end})) for _ in range(2))
        work = rng.randrange(1, 9)
        i, j = token_align.merge_path(a, b, work)
        assert (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all() and i[-1] == len(a) and j[-1] == len(b)
        assert (np.diff(i) + np.diff(j) <= work + 1).all()
        both = sorted(set(a.tolist()) & set(b.tolist()))
        ga, gb = token_align.group_numbers(a, b, work)
        assert ga.tolist() == [bisect.bisect_left(both, e) for e in a] and gb.tolist() == [bisect.bisect_left(both, e) for e in b]
