"""Queries of the operators that link texts, turns or tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowgrid.llm import conv_trie, simhash, token_align
from flowgrid.llm.q_native import documents


def op11_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op12_zfast_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = conv_trie.turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conv_trie.prefix_trie(*conv_trie.spliced(ordered))


#: CRC-32 as in zip files, bit by bit; a conversation's text key is the MD5 of its turns so far
OP12_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, c - c % 20 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(c::VARCHAR, '')])),
           lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END), 4294967295) % 4 AS h
       FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT c, 0 AS part, i, m, w FROM cs JOIN (SELECT c AS b, i, m, w FROM t) USING (b) WHERE i <= h
      UNION ALL SELECT c, 1, i, m, w FROM cs JOIN t USING (c) WHERE i > h),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM r),
pre AS MATERIALIZED (SELECT c, d, w, md5(string_agg(m, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM o
        UNION ALL SELECT c, 0, 0, '' FROM cs),
n AS MATERIALIZED (SELECT k, any_value(d) AS d, any_value(w) AS w, min(c) AS conv_id, count(*) AS n_convs FROM pre GROUP BY k),
up AS (SELECT DISTINCT a.k, b.k AS pk FROM pre a JOIN pre b ON a.c = b.c AND b.d = a.d - 1),
kid AS (SELECT pk AS k, count(*) AS n_children FROM up GROUP BY pk),
below(k, x) AS (SELECT k, k FROM n UNION ALL SELECT up.pk, below.x FROM below JOIN up ON up.k = below.k),
s AS (SELECT below.k, sum((n.n_convs - 1) * n.w) AS saved, count(*) FILTER (WHERE kid.k IS NULL) AS leaves
      FROM below JOIN n ON n.k = below.x LEFT JOIN kid ON kid.k = below.x GROUP BY below.k),
l AS (SELECT c, arg_max(k, d) AS k FROM pre GROUP BY c),
e AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM l GROUP BY k)
SELECT n.conv_id, n.d::BIGINT AS depth, pn.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(kid.n_children, 0)::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM n JOIN s ON s.k = n.k LEFT JOIN up ON up.k = n.k LEFT JOIN n pn ON pn.k = up.pk LEFT JOIN kid ON kid.k = n.k LEFT JOIN e ON e.k = n.k
"""


def op13_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.score_alignment(documents(spark, sf_dir))


QUERIES = {"op11_simhash_pigeonhole": op11_simhash_pigeonhole, "op12_zfast_conversations": op12_zfast_conversations,
           "op13_merge_path_alignment": op13_merge_path_alignment}
ORACLES = {"op12_zfast_conversations": OP12_SQL}
