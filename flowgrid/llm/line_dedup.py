"""Cross-site boilerplate lines by distinct-site spread (DataFrame functions only).

For every line (hash of its trimmed text) a HyperLogLog sketch of the sites
that show it is merged by aggregation, map-side first.  Lines whose estimate
lies clearly beyond the threshold are boilerplate, clearly below are not;
lines within ``margin`` of it get an exact distinct count.  The boilerplate
lines are then removed from every document; other lines, blank ones included,
stay in place.

Skew: a line that a third of all documents show is one sketch per map task;
the exact count aggregates (line, site) pairs first; the join that finds the
affected documents can be split by the engine, as neither side is grouped.

Edge cases: null text stays null with no lines; a null site counts as one site
of its own; blank lines are never counted or removed; lines compare after
trimming blanks at both ends.  Rows that repeat a doc_id with the same text
get the same result each.  Extra columns are ignored.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.session import materialize

MIN_SITES = 10
LG_K = 12
MARGIN = 0.1  # over six standard errors of a sketch of 2**12 registers
BLANKS = " \t\x0b\x0c\r"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _key(line: Column) -> Column:
    """Hash of a line that is not blank, else null."""
    return F.when(_trimmed(line) != "", F.xxhash64(_trimmed(line)))


def line_table(docs: DataFrame, site: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line with a word: ``_id``, ``_t`` (text checksum), ``pos``, ``key``, ``site``."""
    lines = docs.select(F.col(id_col).alias("_id"), _checksum(F.col(text_col)).alias("_t"),
                        F.coalesce(site.cast("string"), F.lit("\x00null")).alias("site"),
                        F.posexplode(F.transform(F.split(F.col(text_col), "\n"), _key)).alias("pos", "key"))
    return lines.filter(F.col("key").isNotNull())


def _checksum(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_sketches(lines: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per line key: a mergeable sketch of its sites and the number of rows."""
    return lines.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.count("*").alias("n"))


def merge_sketches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two sketch tables (e.g. of two crawls) without the lines."""
    return a.unionByName(b).groupBy("key").agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n").alias("n"))


def boilerplate_keys(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """Keys of lines shown by at least ``min_sites`` distinct sites."""
    spread = line_sketches(lines, lg_k).select("key", F.hll_sketch_estimate("sketch").alias("est"))
    wide = materialize(spread.filter(F.col("est") >= min_sites * (1 - margin)), "line-spread")
    near = F.col("est") <= min_sites * (1 + margin)
    exact = (lines.join(wide.filter(near).select("key"), "key", "left_semi")
             .groupBy("key").agg(F.count_distinct("site").alias("sites")).filter(F.col("sites") >= min_sites))
    return wide.filter(~near).select("key").unionByName(exact.select("key"))


def remove_boilerplate(docs: DataFrame, site: Column, min_sites: int = MIN_SITES, margin: float = MARGIN,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: number of lines with a word, removed lines, text left."""
    lines = line_table(docs, site, id_col, text_col)
    keys = materialize(boilerplate_keys(lines, min_sites, margin), "boilerplate")
    cut = (lines.select("_id", "_t", "pos", "key").join(keys, "key", "left_semi")
           .groupBy("_id", "_t").agg(F.collect_set("pos").alias("cut")))
    d = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"), _checksum(F.col(text_col)).alias("_c"))
    x = (d.join(cut, d["_doc"].eqNullSafe(cut["_id"]) & (d["_c"] == cut["_t"]), "left")
         .withColumn("cut", F.coalesce("cut", F.array().cast("array<int>"))))
    all_lines = F.split("_text", "\n")
    left = F.filter(all_lines, lambda v, i: ~F.array_contains("cut", i))
    counted = F.filter(all_lines, lambda v: _trimmed(v) != "")
    return x.select(F.col("_doc").alias(id_col),
                    F.when(F.col("_text").isNull(), 0).otherwise(F.size(counted)).cast("long").alias("n_lines"),
                    F.size("cut").cast("long").alias("n_removed"),
                    F.when(F.size("cut") == 0, F.col("_text")).otherwise(F.array_join(left, "\n")).alias(text_col))
