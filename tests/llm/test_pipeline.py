"""The pipeline and the registration of the corpus queries."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from flowgrid.llm import mixing, queries, sharding
from flowgrid.session import materialize
from tests.llm.helpers import alnum_words, near_components, prose
from tests.llm.test_native import measured, taken_plainly


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(any(q.startswith(n) for q in queries.QUERIES) for n in names)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def corpus(rng):
    bench = [(i, prose(rng, 30, 2000)) for i in range(5)]
    rows = []
    for i in range(260):
        w = prose(rng, rng.randrange(40, 200), 20_000).split()
        if i % 20 == 3:
            w[10:10] = bench[i % 5][1].split()[:15]
        if i % 20 == 5:
            w = ["junk"] * 80
        if i % 20 == 7:
            w = [x + "$$" for x in w]
        if i % 10 == 9:
            w = rows[-1][1].split()
            if i % 20 == 19:
                w[5:6] = ["changed"]
        rows.append((i, " ".join(w), "en", rng.choice(["a", "b", "c", None])))
    return rows + [(None, prose(rng, 80), "en", "a"), (700, None, "en", "a"), rows[0]], bench


def test_pipeline(spark, tmp_path):
    rows, bench = corpus(random.Random(21))
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    state, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), rows
    for (name, stage), step in zip(corpus_pipeline.STAGES, (good, distinct, clean, None, None)):
        state = materialize(stage(spark, state, str(tmp_path)), name)
        if step:
            left = step(left, bench)
            assert state.columns == docs.columns
            assert sorted((str(r[0]), r[1]) for r in state.collect()) == sorted((str(r[0]), r[1]) for r in left), name
    expected, _ = taken_plainly(left)
    copies = sum((t // n + (2 * (t % n) >= n)) * k for (_, n, _, t), k in expected.items() if n)
    out = state.collect()
    assert len(out) == copies and set(state.columns) == {*docs.columns, "slot", "shard"}
    assert all(r["shard"] == sharding.fill_table(sharding.SHARDS)[r["slot"]] for r in out[:5])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.exceptAll(state).count() == 0 and state.exceptAll(whole).count() == 0


def test_near_duplicates_keep_all_texts_of_an_id(spark):
    """A placeholder id with unrelated texts: each stays, copies of them go, those without an id too."""
    rng = random.Random(22)
    texts = [prose(rng, 80, 20_000) for _ in range(40)]
    rows = ([(0, t, "en", "a") for t in texts[:30]] + [(0, texts[0], "en", "b"), (0, None, "en", "a"), (None, texts[1], "en", "a")]
            + [(i, t, "en", "a") for i, t in enumerate(texts[20:], 100)] + [(-5, texts[2] + " end", "en", "a"), (500, texts[3] + " end", "en", "a")])
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    want = ([(0, t) for i, t in enumerate(texts[:30]) if i != 2] + [(0, None), (-5, texts[2] + " end")]
            + [(i, t) for i, t in enumerate(texts[20:], 100) if t not in texts[:30]])
    assert out.columns == docs.columns
    assert sorted((str(r[0]), str(r[1])) for r in out.collect()) == sorted((str(a), str(b)) for a, b in want)


def good(rows, _):
    def keeps(t):
        m = measured(t)
        return not (m[0] < 50 or 100 * m[5] > 50 * m[0] or 10 * m[2] > m[0] or m[1] < 2 * m[0] or m[1] > 15 * m[0] or 100 * m[4] > 50 * m[3])
    return [r for r in rows if keeps(r[1])]


def distinct(rows, _):
    comp = near_components(rows, 5, 80)
    seen, out = set(), []
    for r in rows:
        if r[0] is None or (comp[r[0]] == r[0] and r[0] not in seen):
            out.append(r)
            seen.add(r[0])
    return out


def clean(rows, bench):
    pats = {tuple(w[i:i + 10]) for _, t in bench for w in [alnum_words(t)] for i in range(len(w) - 9)}
    return [r for r in rows if not any(tuple(w[i:i + 10]) in pats for w in [alnum_words(r[1])] for i in range(len(w) - 9))]


def test_mix_repeats_follow_the_plan(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "en", "a", 20) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.repeat_documents(docs, F.array("source"))
    assert out.count() == 75 and out.columns == docs.columns


def test_pipeline_on_nothing(spark, tmp_path):
    """An empty table stays empty through all stages; so does one of which the rules keep nothing."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([("b", "some benchmark words here to match against nothing at all now")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("none", []), ("short", [(1, "too short", "en", "a", 9), (None, None, None, None, None)])):
        folder = tmp_path / name
        folder.mkdir()
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{tmp_path}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, str(folder))
        assert out.count() == 0 and set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "slot", "shard"}
