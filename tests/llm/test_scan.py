"""Near-duplicates, window and suffix dedup, decontamination against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from flowgrid.llm import components, contamination, near_dup, setsketch, suffix_dedup, window_dedup
from flowgrid.llm import text as tx
from tests.llm.helpers import (alnum_words, edge_rows, late_windows, near_components, prose, sha, shingles, table, words)


def as_words(texts, lower=False, kind=tx.NON_BLANK):
    body = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"".join(body), np.uint8)
    return tx.words(data, np.concatenate([[0], np.cumsum([len(b) for b in body])]).astype(np.int64), kind, lower)


def test_tokeniser():
    texts = [r[1] for r in edge_rows()] + ["ab", "cd", "", "x\x0by\x1cz", "　a", "Ab-Cd_9 é"]
    w = as_words(texts)
    for i, t in enumerate(texts):
        assert [w.text(j, j + 1).decode() for j in range(w.ptr[i], w.ptr[i + 1])] == words(t)
    w = as_words(texts, True, tx.ALNUM)
    for i, t in enumerate(texts):
        assert [w.text(j, j + 1).decode() for j in range(w.ptr[i], w.ptr[i + 1])] == alnum_words(t)
    h = tx.word_hashes(w)
    by_word = {}
    for j in range(len(h)):
        assert by_word.setdefault(w.text(j, j + 1), h[j]) == h[j]
    assert len(set(by_word.values())) == len(by_word)


def mutate(rng, text, share):
    return " ".join(f"m{rng.random():.9f}" if rng.random() < share else x for x in text.split())


def near_rows(rng, n=12, copies=12):
    rows, i = [], 100
    for _ in range(n):
        base = prose(rng, rng.randrange(8, 160), 5000)
        for _ in range(copies):
            rows.append((i, mutate(rng, base, rng.choice([0, 0, .01, .02, .04, .1])), "en", "a"))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    rows = edge_rows() + near_rows(random.Random(k))
    expected = near_components(rows, k, percent)
    out = near_dup.near_duplicates(table(spark, rows, clash=True).repartition(5), k, percent).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out)
    want = Counter((r[0], len(shingles(r[1], k)), expected.get(r[0]), r[0] is None or expected[r[0]] == r[0]) for r in rows)
    assert got == want
    assert near_dup.near_duplicates(table(spark, rows).limit(0)).count() == 0


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """One large group around a centre: members link to the centre, rarely to one
    another, and the pivot is not the centre; small blocks."""
    monkeypatch.setattr(near_dup, "OWN_BLOCK", 8)
    monkeypatch.setattr(near_dup, "ALL_BLOCK", 16)
    rng = random.Random(11)
    centre = prose(rng, 200, 100_000)
    rows = [(i, mutate(rng, centre, 0.02 + 0.02 * rng.random()), "en", "a") for i in range(150)] + [(500, centre, "en", "a")]
    expected = near_components(rows, 3, 85)
    out = near_dup.near_duplicates(table(spark, rows), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == expected
    assert 1 < len(set(expected.values())) < 120


def test_near_duplicates_in_bounded_batches(spark, monkeypatch):
    """Long texts and pairs of long sets come in batches of bounded size; the session's own bound is restored."""
    bound, name = 1 << 16, "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(near_dup, "BATCH_BYTES", bound)

    def watched(real):
        def made(*options):
            inner = real(*options)

            def run(batches):
                def small(b):
                    assert b.nbytes <= 2 * bound, b.nbytes
                    return b
                return inner(small(b) for b in batches)
            return run
        return made
    for step in ("_sketcher", "_setter", "_verify"):
        monkeypatch.setattr(near_dup, step, watched(getattr(near_dup, step)))
    rng = random.Random(12)
    centre = prose(rng, 2000, 100_000)
    rows = [(i, mutate(rng, centre, 0.01), "en", "a") for i in range(40)] + [(500, centre, "en", "a")]
    before = spark.conf.get(name, None)
    for own in (None, str(1 << 30)):
        if own:
            spark.conf.set(name, own)
        try:
            out = near_dup.near_duplicates(table(spark, rows).coalesce(1), 3, 85).collect()
            assert {r["doc_id"]: r["component_id"] for r in out} == near_components(rows, 3, 85)
            assert spark.conf.get(name, None) == (own or before)
        finally:
            if own:
                spark.conf.unset(name)


def test_keep_one(spark):
    rows = edge_rows() + near_rows(random.Random(2), 4)
    df = table(spark, rows, clash=True)
    out = near_dup.keep_one(df)
    assert out.columns == df.columns
    expected = near_components(rows, 5, 80)
    assert sorted(r["doc_id"] for r in out.filter("doc_id is not null").collect()) == sorted({c for c in expected.values()})
    assert out.filter("doc_id is null").count() == 2


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    rng.shuffle(links)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    want = {x: find(x) for a, b in links if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in links], "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == want
    assert got.count() == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_is_mergeable_and_estimates():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2 ** 63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2600])
    m = 512
    reg = setsketch.registers(np.concatenate([a, b, np.union1d(a, b), a[:1]]), np.cumsum([0, len(a), len(b), 2600, 1]), m)
    assert (setsketch.merge(reg[0], reg[1]) == reg[2]).all()
    true = len(np.intersect1d(a, b)) / 2600
    est = setsketch.similarity(reg[:1], reg[1:2], np.array([len(a)]), np.array([len(b)]))[0]
    assert abs(est - true) < 0.08
    size = np.array([float(len(a))])
    assert setsketch.plausible(reg[:1], reg[:1], size, size, 0.85)[0]
    assert not setsketch.plausible(reg[:1], reg[1:2], size, np.array([float(len(b))]), 0.85)[0]
    # registers follow the plain definition: smallest point of each register over all elements
    low = setsketch.minima(a[:50], np.array([0, 50]), 8)
    alone = setsketch.minima(a[:50], np.arange(51), 8)
    assert np.allclose(low[0], alone.min(axis=0))


def passage_rows(rng):
    vocabulary = [f"v{i}" for i in range(3000)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (70, 25, 12, 90)]
    rows = edge_rows()
    for i in range(20, 260):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 80))]
        if i % 3:
            p = passages[i % 4]
            at = rng.randrange(len(w))
            w[at:at] = p[rng.randrange(3):]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w), "en", "a"))
    return rows + [(300, "a b " * 60, "en", "a"), (301, "b a " * 50, "en", "a"), rows[30], (15, rows[40][1], "en", "a")]


@pytest.mark.parametrize("window,mer", [(20, 5), (4, 2)])
def test_windows(spark, window, mer):
    rows = passage_rows(random.Random(window))
    late = late_windows(rows, window)
    want = Counter()
    for r in rows:
        w = words(r[1])
        gone = {i + o for i in late[(r[0], r[1])] for o in range(window)}
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[(r[0], len(w), len(gone), sha(left), left)] += 1
    for share in (1e-3, 1e-9):  # the second splits every repeated minimiser beyond 64 strings
        out = window_dedup.remove_repeats(table(spark, rows, clash=True).repartition(4), window, mer, hot_share=share, bucket_bytes=20_000)
        assert Counter(map(tuple, out.collect())) == want
    assert window_dedup.remove_repeats(table(spark, rows).limit(0), window, mer).count() == 0


@pytest.mark.parametrize("window,mer", [(50, 19), (6, 3)])
def test_suffix_spans(spark, window, mer):
    rows = passage_rows(random.Random(window))
    late, first = late_windows(rows, window, True)
    want = Counter()
    for later, found in ((True, late), (False, first)):
        for (doc, _), starts in found.items():
            covered = sorted({i + o for i in starts for o in range(window)})
            for k, i in enumerate(covered):
                if k == 0 or covered[k - 1] != i - 1:
                    begin = i
                if k == len(covered) - 1 or covered[k + 1] != i + 1:
                    want[(doc, begin, i + 1, i + 1 - begin, later)] += 1
    for share in (1e-3, 1e-9):
        out = suffix_dedup.repeated_spans(table(spark, rows, clash=True).repartition(4), window, mer, hot_share=share, bucket_bytes=20_000)
        assert Counter(map(tuple, out.collect())) == want
    assert suffix_dedup.repeated_spans(table(spark, rows).limit(0)).count() == 0


def test_hash_collisions_fall_back_to_words():
    ids = np.array([1, 2, 3, 1, 2, 3, 4, 1, 2, 3], np.int32)
    at = np.array([0, 1, 3, 4, 7])
    cls = window_dedup.classes(ids, at, 3)
    assert cls[0] == cls[2] == cls[4] and len(set(cls)) == 3


def hits_plainly(rows, items, window):
    pats = {}
    for item, text in items:
        w = alnum_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            pats.setdefault(tuple(w[i:i + n]), set()).add("null" if item is None else str(item))
    want = Counter()
    for r in rows:
        w = alnum_words(r[1])
        hit, found = set(), set()
        for n in {len(p) for p in pats}:
            for i in range(len(w) - n + 1):
                ids = pats.get(tuple(w[i:i + n]))
                if ids:
                    hit |= set(range(i, i + n))
                    found |= ids
        want[(r[0], len(w), len(hit), tuple(sorted(found)))] += 1
    return want


@pytest.mark.parametrize("max_patterns", [100_000, 40])
def test_contamination(spark, max_patterns):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.choice([0, 1, 2, 5, 10, 11, 30]) + 3, 300)) for i in range(25)]
    items += [(None, "alpha beta"), (30, None), (31, "..."), (3, "Repeated item ID, other-text"), (32, "solo")]
    rows = edge_rows()
    for i in range(20, 200):
        w = prose(rng, rng.randrange(0, 700), 300).split()
        if i % 2:
            at = rng.randrange(len(w) + 1)
            w[at:at] = (rng.choice(items)[1] or "").upper().split()
        rows.append((i, rng.choice([" ", "-", "\n"]).join(w), "en", "a"))
    df = table(spark, rows, clash=True).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = hits_plainly(rows, items, 10)
    out = contamination.find_contamination(df, bench, max_patterns=max_patterns).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"]))) for r in out) == want
    assert all(r["n_hit"] == sum(h["end"] - h["start"] for h in r["hits"]) for r in out)
    clean = contamination.drop_contaminated(df, bench, max_patterns=max_patterns)
    assert clean.columns == df.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(k[0] for k in want.elements() if not k[2])
    assert contamination.find_contamination(df, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert contamination.find_contamination(df.limit(0), bench).count() == 0


def colliding(n=2):
    """Different texts with one CRC-32."""
    import zlib
    rng, seen = random.Random(6), {}
    while True:
        t = " ".join(f"q{rng.randrange(10**6)}" for _ in range(30))
        other = seen.setdefault(zlib.crc32(t.encode()), t)
        if other != t:
            return other, t


def test_texts_of_one_id_with_one_checksum(spark):
    """The text without a repeat loses nothing to the one that has some."""
    a, b = colliding()
    first = " ".join(a.split()[:25])
    for i in (None, 4):
        rows = [(1, first, "en", "x"), (i, a, "en", "x"), (i, b, "en", "x")]
        if i is None:
            rows[0] = (None, first, "en", "x")
        late = late_windows(rows, 20)
        out = window_dedup.remove_repeats(table(spark, rows), with_text=True).collect()
        got = Counter((r["n_words"], r["n_removed"]) for r in out)
        want = Counter()
        for _, t, *_ in rows:
            w, s = t.split(), late[(i if t != first or i is None else 1, t)]
            want[len(w), len({k + j for k in s for j in range(20)})] += 1
        assert got == want and want[30, 0] >= 1


def test_null_ids_are_near_deduplicated(spark):
    rng = random.Random(8)
    t, u = prose(rng, 60, 5000), prose(rng, 60, 5000)
    rows = [(None, t, "en", "a"), (None, t, "en", "b"), (None, u, "en", "a"), (3, u, "en", "a"), (None, None, "en", "a"), (None, None, "en", "b"), (9, "", "en", "c")]
    kept = near_dup.keep_documents(table(spark, rows, clash=True))
    assert kept.columns == table(spark, rows, clash=True).columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(None, t), (3, u), (None, None), (9, "")])


def test_decontamination_keeps_any_names(spark):
    docs = table(spark, [(1, "one two three", "en", "a"), (2, None, "en", "a"), (3, "x " + "b c d " * 5, "en", "a")], clash=True)
    bench = spark.createDataFrame([("i", "b c d b c d b c d b")], "item_id string, text string")
    out = contamination.drop_contaminated(docs, bench)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 2]
