"""Queries of the operators that scan texts with numpy inside Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.llm import contamination, near_dup, suffix_dedup, window_dedup
from flowgrid.llm.q_native import documents


def op7_shift_table_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP7_SQL = r"""
WITH iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g
        FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS i FROM iw WHERE len(ws) > 0)),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
win AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM dw, (SELECT DISTINCT n FROM pat))),
occ AS (SELECT doc_id, i, win.n, item_id FROM win JOIN pat ON win.n = pat.n AND win.g = pat.g),
hit AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS w FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM occ) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

def op4_setsketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), shingle=3, percent=85)


OP4_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(3, len(ws)) - 1], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS MATERIALIZED (SELECT a AS u, b AS v FROM link UNION ALL SELECT b, a FROM link),
reach(u, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT edge.v, reach.r FROM reach JOIN edge ON edge.u = reach.u),
c AS (SELECT u AS doc_id, min(r) AS component_id FROM reach GROUP BY u)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id)::BIGINT AS component_id,
       coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def op6_super_kmer_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeats(documents(spark, sf_dir), with_text=False)


def _windows_sql(window: int) -> str:
    """CTEs: w (words), win (windows with a class), late (windows that also start earlier)."""
    return rf"""
w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + {window - 1}], ' ')) AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {window - 1})) AS i FROM w)),
late AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1)"""


OP6_SQL = rf"""
WITH {_windows_sql(20)},
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM late, (SELECT unnest(generate_series(0, 19)) AS o)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS t
         FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op8_sparse_suffix_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(documents(spark, sf_dir))


OP8_SQL = rf"""
WITH {_windows_sql(50)},
hit AS (SELECT doc_id, i, r > 1 AS later FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r,
        count(*) OVER (PARTITION BY g) AS k FROM win) WHERE k > 1),
o AS (SELECT *, i + 50 AS e, max(i + 50) OVER (PARTITION BY doc_id, later ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM hit),
s AS (SELECT *, count(*) FILTER (WHERE top IS NULL OR i > top) OVER (PARTITION BY doc_id, later ORDER BY i) AS grp FROM o)
SELECT doc_id, min(i)::BIGINT - 1 AS start_word, max(e)::BIGINT - 1 AS end_word, (max(e) - min(i))::BIGINT AS n_words, later
FROM s GROUP BY doc_id, later, grp
"""

QUERIES = {"op4_setsketch_near_dup": op4_setsketch_near_dup, "op6_super_kmer_windows": op6_super_kmer_windows, "op7_shift_table_decontamination": op7_shift_table_decontamination,
           "op8_sparse_suffix_spans": op8_sparse_suffix_spans}
ORACLES = {"op4_setsketch_near_dup": OP4_SQL, "op6_super_kmer_windows": OP6_SQL, "op7_shift_table_decontamination": OP7_SQL, "op8_sparse_suffix_spans": OP8_SQL}
