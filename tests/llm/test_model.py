"""PPM scoring against a dictionary version, and held-out quality of both models."""

import random
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowgrid.llm import lm_ppm, toxicity_fm
from flowgrid.llm import text as tx
from tests.llm.helpers import edge_rows, fold, lower, prose, table, words

ORDER = 3


def plain_trie(texts):
    trie = defaultdict(Counter)
    for t in texts:
        past = [lm_ppm.START] * ORDER
        for b in [*lower(t).encode(), lm_ppm.END]:
            for d in range(ORDER + 1):
                trie[tuple(past[ORDER - d:])][b] += 1
            past = [*past[1:], b]
    return trie


def plain_score(trie, text):
    past, total = [lm_ppm.START] * ORDER, 0.0
    for b in [*lower(text).encode(), lm_ppm.END]:
        excluded = set()
        for d in range(ORDER, -1, -1):
            counts = trie.get(tuple(past[ORDER - d:]))
            if not counts:
                continue
            free = {s: n for s, n in counts.items() if s not in excluded}
            size = sum(free.values()) + len(free)
            if b in free:
                total += log10(free[b] / size)
                break
            if free:
                total += log10(len(free) / size)
            excluded |= set(counts)
        else:
            total -= log10(max(1, lm_ppm.ALPHABET - len(excluded)))
        past = [*past[1:], b]
    return total


def test_scores(spark):
    rng = random.Random(8)
    rows = [r for r in edge_rows() if r[0] not in (4, 5)] + [(i, prose(rng, rng.randrange(0, 80), 900) + rng.choice(["", " É!", "\n"]), "en", "a") for i in range(20, 300)]
    train = [r for r in rows if fold(r[0]) != 1]
    trie = plain_trie(r[1] for r in train)
    c = Counter(w for r in train for w in words(lower(r[1])))
    n, v = sum(c.values()) + len(train), len(c) + 1
    want = defaultdict(list)
    for r in rows:
        w = words(lower(r[1]))
        base = sum(log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + log10((len(train) + 0.5) / (n + 0.5 * (v + 1)))
        want[(r[0], fold(r[0]) == 1, len(w) + 1, sum(x in c for x in w) + 1, n)].append((base, plain_score(trie, r[1])))
    for head in (1 << 17, 20):
        out = lm_ppm.score_documents(table(spark, rows, clash=True).repartition(3), order=ORDER, head_words=head).collect()
        got = defaultdict(list)
        for r in out:
            got[tuple(r)[:5]].append((r["base_score"], r["score"]))
        assert got.keys() == want.keys()
        for k in want:
            assert sorted(got[k]) == [pytest.approx(x, rel=1e-6) for x in sorted(want[k])]
    assert lm_ppm.score_documents(table(spark, rows).limit(0)).count() == 0


def test_probabilities_sum_to_one():
    rng = random.Random(9)
    text = prose(rng, 300, 50).encode()
    data = np.frombuffer(text, np.uint8)
    code, _ = lm_ppm.codes(data, np.array([0, len(data)]), ORDER)
    levels = [np.unique(code & np.uint64((1 << (8 * (d + 1))) - 1), return_counts=True) for d in range(ORDER + 1)]
    trie = lm_ppm.Trie(levels)
    symbols = np.array([b for b in range(256) if b != lm_ppm.START], np.uint64)
    for past in (b"w1 ", b"zz ", b"w1w", b"\xff\xff\xff"):
        ctx = int.from_bytes(past, "big")
        p = 10.0 ** trie.log10((np.uint64(ctx << 8)) | symbols)
        assert p.sum() == pytest.approx(1.0)


def test_bounded_trie_still_scores(spark):
    rng = random.Random(10)
    rows = [(i, prose(rng, 60, 3000), "en", "a") for i in range(300)]
    full, small = (lm_ppm.score_documents(table(spark, rows), order=ORDER, max_nodes=n).agg(F.sum("score")).first()[0] for n in (1 << 20, 300))
    assert small < full < 0 and small > 2 * full


def test_whole_model_whatever_is_broadcast(spark, monkeypatch):
    """Every count takes part, also with a small broadcast and small slabs."""
    monkeypatch.setattr(lm_ppm, "SLAB", 500)
    rng = random.Random(11)
    rows = [(i, " ".join(f"{rng.randrange(1 << 40):x}" for _ in range(30)), "en", "a") for i in range(200)]
    trie = plain_trie(r[1] for r in rows if fold(r[0]) != 1)
    for head in (1 << 20, 50):
        out = lm_ppm.score_documents(table(spark, rows).repartition(3), order=ORDER, head_codes=head).collect()
        assert len(out) == len(rows)
        for r in out:
            assert r["score"] == pytest.approx(plain_score(trie, rows[r["doc_id"]][1]), rel=1e-9)


def test_no_node_is_dropped(spark):
    """More than 2**20 distinct contexts and bytes, as the query calls it."""
    rng = random.Random(13)
    texts = ["".join(chr(97 + rng.randrange(26)) for _ in range(4500)) for _ in range(400)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    code, n = lm_ppm.codes(data, np.arange(len(texts) + 1) * 4500)
    train = np.array([fold(i) != 1 for i in range(len(texts))])
    known = code[np.repeat(train, n)]
    assert len(np.unique(known)) > 1 << 20
    trie = lm_ppm.Trie([np.unique(known & np.uint64((1 << (8 * (d + 1))) - 1), return_counts=True) for d in range(lm_ppm.ORDER + 1)])
    want = np.add.reduceat(trie.log10(code), np.cumsum(n) - n)
    out = lm_ppm.score_documents(table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-6)


def test_adaptive():
    assert lm_ppm.adaptive_bits("") == pytest.approx(np.log2(lm_ppm.ALPHABET))
    assert lm_ppm.adaptive_bits("abc " * 100) < 0.2 * lm_ppm.adaptive_bits("".join(chr(33 + (i * i * 7 + i // 3) % 90) for i in range(400)))
    assert lm_ppm.adaptive_bits("ABC") == lm_ppm.adaptive_bits("abc")


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    pos = y.sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def test_pairs_are_learned(spark):
    """Toxic only where an insult and a group stand together."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w = prose(rng, 25, 300).split() + ["scum"] * insult + ["martians"] * group
        rng.shuffle(w)
        rows.append((i, " ".join(w), "en", "a"))
        labels.append((i, int(insult and group)))
    docs, lab = table(spark, rows, clash=True), spark.createDataFrame(labels + [(1, None), (None, 1), (2, labels[2][1])], "doc_id long, toxic int")
    held = lm_ppm.fold(F.col("doc_id")) == 0
    out = toxicity_fm.score_toxicity(docs, lab, ~held).collect()
    test = [r for r in out if fold(r["doc_id"]) == 0]
    y = np.array([labels[r["doc_id"]][1] for r in test])
    s = np.array([r["score"] for r in test])
    assert auc(s, y) > 0.97 and ((s >= 0.5) == y).mean() > 0.95


def test_conditional_terms(spark):
    """Term 3 matters only next to term 1: alone it tells nothing."""
    rows = [(1, [1, 3])] * 300 + [(1, [2])] * 300 + [(0, [1])] * 100 + [(0, [3])] * 300 + [(0, [])] * 200
    model = toxicity_fm.fit(spark.createDataFrame(rows, "y int, terms array<long>"))
    assert len(model.weight) == 3


def test_no_cap_on_terms(spark):
    """Every significant term is in the model, however many there are."""
    rows = [(i % 2, [j * 2 + i % 2 for j in range(1500)] + [5000 + i]) for i in range(120)]
    model = toxicity_fm.fit(spark.createDataFrame(rows, "y int, terms array<long>"), epochs=1)
    assert len(model.weight) == 3000


def test_fit_is_bounded_by_rows(spark):
    """One id on many rows: its texts count towards the bound, repeats once."""
    rows = [(7, f"text number {i}", "en", "a") for i in range(600)] + [(8, "the same", "en", "a")] * 500 + [(9, "other", "en", "a"), (10, None, "en", "a")]
    lab = spark.createDataFrame([(7, 1), (8, 0), (9, 0), (10, 1)], "doc_id long, toxic int")
    drawn = toxicity_fm.training_rows(table(spark, rows), lab, F.lit(True), "toxic", "doc_id", "text", 200)
    assert drawn.count() == 200
    assert toxicity_fm.training_rows(table(spark, rows), lab, F.lit(True), "toxic", "doc_id", "text", 10_000).count() == 603


def test_margins_are_the_explicit_pair_sum():
    rng = np.random.default_rng(5)
    terms = np.sort(rng.integers(1, 1 << 62, 40).astype(np.uint64))
    model = toxicity_fm.Model(terms, rng.permutation(40), 0.3, rng.normal(size=40), rng.normal(size=(40, 4)))
    docs = [list(rng.choice(terms, rng.integers(0, 15))) + [np.uint64(3)] for _ in range(30)]  # repeats and an unknown term
    doc = np.repeat(np.arange(30), [len(d) for d in docs])
    got = toxicity_fm.margins(model, doc, np.concatenate(docs).astype(np.uint64), 30)
    for d, y in zip(docs, got):
        t = [int(model.number[np.searchsorted(terms, x)]) for x in sorted(set(d)) if x in terms]
        want = model.bias + sum(model.weight[i] for i in t) + sum(
            float(model.factors[a] @ model.factors[b]) for k, a in enumerate(t) for b in t[k + 1:])
        assert y == pytest.approx(want, abs=1e-9)


def test_stems_end_at_characters():
    texts = ["ééééééé abcdefg", "äbcde äbcdef 日本語日本語"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["_text"])
    (_, _, doc, term), = toxicity_fm._terms(batch)
    # 5 words and the stems of those over five characters
    assert len(term) == 5 + 4
    stems = set(term[5:].tolist())
    want = []
    for w in ("ééééé", "abcde", "äbcde", "日本語日本"):
        data = np.frombuffer(w.encode(), np.uint8)
        want.append(int(tx.mix(tx.word_hashes(tx.words(data, np.array([0, len(data)]), tx.ALNUM)))[0]))
    assert stems == set(want)


def test_long_clean_text_holds_no_term(spark):
    """Many unknown words don't add up to known ones."""
    rng = random.Random(14)
    insults = [f"{chr(103 + i)}rotz" for i in range(20)]
    rows = [(i, prose(rng, 20, 300) + (" " + " ".join(insults) if i % 2 else ""), "en", "a") for i in range(400)]
    long = " ".join(f"{rng.randrange(1 << 32):08x}" for _ in range(60_000))
    docs = table(spark, rows + [(1000, long, "en", "a"), (1001, "deadbeef", "en", "a")])
    lab = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    s = {r["doc_id"]: r["score"] for r in toxicity_fm.score_toxicity(docs, lab, F.lit(True)).collect()}
    assert s[1000] == pytest.approx(s[1001]) and s[1] > 0.9 > 0.5 > s[0]


def test_toxicity_edges(spark):
    docs = table(spark, edge_rows(), clash=True)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity_fm.score_toxicity(docs, none, F.lit(True)).collect()} == {0.0}
    one = spark.createDataFrame([(6, 0), (7, 0), (8, None)], "doc_id long, toxic int")
    out = toxicity_fm.score_toxicity(docs, one, F.lit(True)).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r["score"] < 0.5 for r in out)
    assert toxicity_fm.score_toxicity(docs.limit(0), one, F.lit(True)).count() == 0


def test_held_out_accuracy(spark):
    """Labels of the generated documents, learned from four fifths."""
    d = "/root/testdata/sf0.1"
    docs, lab = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = lm_ppm.fold(F.col("doc_id")) == 0
    scored = toxicity_fm.score_toxicity(docs, lab, ~held).filter(held).join(lab, "doc_id").toPandas()
    assert auc(scored["score"].to_numpy(), scored["toxic"].to_numpy()) > 0.95
    assert ((scored["score"] >= 0.5) == scored["toxic"]).mean() > 0.95


def test_word_hash_is_stable():
    data = np.frombuffer("naïve words".encode(), np.uint8)
    a = tx.word_hashes(tx.words(data, np.array([0, len(data)]), tx.NON_BLANK))
    b = tx.word_hashes(tx.words(data[7:], np.array([0, len(data) - 7]), tx.NON_BLANK))
    assert a[1] == b[0] and a[0] != a[1]
