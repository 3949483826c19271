"""Queries of the operators that run on built-in functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.llm import line_dedup, mixing, sharding
from flowgrid.llm import quality_rules as qr


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = qr.apply_policy(qr.ledger(documents(spark, sf_dir)), "v2")
    return book.withColumn("base_failed", qr.rejected("base"))


OP9_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS g3
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g3) > 1),
p AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT ln) AS d
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS ln FROM w)
      WHERE regexp_matches(ln, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(l.d, 0)::BIGINT AS n_dup_lines,
             coalesce(p.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN p USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
               + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
               + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
               + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
               + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
               + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT *, failed_bits % 4 <> 0 AS base_failed, failed_bits = 0 AS kept FROM b
"""


def op1_turn_table_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir)).select("doc_id", "slot", "shard")


def op2_flow_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), F.array("source"))
    return mixed.select("doc_id", "size", F.get("source_size", F.lit(0)).alias("source_size"),
                        F.get("target", F.lit(0)).alias("target"), "taken")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
k AS (SELECT *, 2.0::DOUBLE * source_size / weight AS k,
             (SELECT 1.5::DOUBLE * sum(source_size) FROM s) AS total FROM w),
c AS (SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below,
             sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open_weight FROM k),
lv AS (SELECT arg_min((total - below) / open_weight, k) FILTER (WHERE k >= (total - below) / open_weight) AS level FROM c),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight) AS target FROM c, lv),
q AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t),
r AS (SELECT d.*, source_size, target,
             CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size END AS passes,
             CASE WHEN source_size = 0 THEN 0 ELSE quota % source_size END AS rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (passes * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r
"""


def op10_site_spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(documents(spark, sf_dir), F.col("source"))


OP10_SQL = r"""
WITH l AS (SELECT doc_id, coalesce(source, 'null source') AS site, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
                  unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS key FROM l),
wide AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT site) >= 10),
f AS (SELECT k.*, wide.key IS NOT NULL AS gone FROM k LEFT JOIN wide USING (key)),
a AS (SELECT doc_id, count(*) FILTER (WHERE key <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, a.text
FROM documents d LEFT JOIN a USING (doc_id)
"""

QUERIES = {"op1_turn_table_sharding": op1_turn_table_sharding, "op2_flow_mix": op2_flow_mix,
           "op9_rule_ledger": op9_rule_ledger, "op10_site_spread_lines": op10_site_spread_lines}
ORACLES = {"op2_flow_mix": OP2_SQL, "op9_rule_ledger": OP9_SQL, "op10_site_spread_lines": OP10_SQL}
