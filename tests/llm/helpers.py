"""Plain-Python versions of the operators, and tables of edge cases."""

import hashlib
import random
import re
import zlib

import xxhash

BLANK = re.compile(r"[\x20\x09-\x0D]+")
CLASH = ["_id", "_text", "_key", "id", "n", "size", "slot", "shard", "hits", "sources", "component", "_runs", "key", "_h", "site", "__slot", "__shard", "a.b", "c0",
         "_src", "_n", "_pid", "place", "k_0"]


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def fold(doc_id):
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 5


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def edge_rows():
    """(doc_id, text, lang, source) with nulls, empties, a long text, ties, repeated rows."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["ab", "cd", "ef", "gh", "é", "Zz"]) + str(rng.randrange(900)) for _ in range(30_000))
    return [(1, None, "en", "a"), (2, "", "en", "b"), (3, " \t\n ", None, None), (4, long, "en", "a"), (5, long + " tail", "fr", "b"),
            (6, "one", "en", "a"), (7, "One", "en", "a"), (8, "x y", "de", None), (8, "x y", "de", None), (None, "no id here", "en", "b"),
            (None, None, None, None), (9, "ä ö ü\nß\n\nä ö ü", "de", "b"), (10, "same words here now", "en", "c"),
            (11, "same  words\there now", "en", "c"), (8, "x y other", "de", "b")]


def table(spark, rows, clash=False, schema="doc_id long, text string, lang string, source string"):
    df = spark.createDataFrame(rows, schema)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})
    return df


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def text_key(text):
    """The signed 64-bit hash that orders texts of one id."""
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def late_windows(rows, window, firsts=False):
    """{(doc_id, text): starts of windows whose words also start earlier}, and
    those that are the first of several."""
    first, out = {}, {}
    docs = sorted({(r[0], r[1]) for r in rows}, key=lambda d: (d[0] is not None, d[0] or 0, text_key(d[1])))
    heads = {d: set() for d in docs}
    for d in docs:
        w = words(d[1])
        out[d] = set()
        for i in range(len(w) - window + 1):
            head = first.setdefault(tuple(w[i:i + window]), (d, i))
            if head != (d, i):
                out[d].add(i)
                heads[head[0]].add(head[1])
    return (out, heads) if firsts else out


def shingles(text, k):
    w = words(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def near_components(rows, k, percent):
    """doc_id -> smallest linked doc_id, all pairs compared."""
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], []).append(shingles(r[1], k))
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        lo, hi = sorted((find(a), find(b)))
                        parent[hi] = lo
    return {d: find(d) for d in ids}
