"""Quality rules kept as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document.  The ledger stores the
measurements and one ``failed_bits`` integer; versioned policies are masks
over those bits, so a policy change or an ablation never reads a text again.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text.  Everything happens inside
the row: no shuffle, no Python.

Edge cases: a null text is an empty text (all measurements 0, rule
``too_few_words`` fails).  Repeated rows each get their own ledger row; an
empty table gives an empty ledger.  Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MEASUREMENTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    An array referenced inside a higher-order function's lambda would be
    recomputed for every element if the optimizer inlined it there.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Number of words inside 3-word windows found at least twice in the text."""
    empty = F.array().cast("array<bigint>")

    def hashes(w: Column) -> Column:
        return F.when(F.size(w) < 3, empty).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))

    def repeated(s: Column) -> Column:
        # windows in hash order: a window is repeated iff a neighbour has its hash
        def at(e, i):
            same = (F.get(s, i - 1)["h"].eqNullSafe(e["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(e["h"]))
            return F.when(same, e["p"])
        return F.sort_array(F.filter(F.transform(s, at), lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1), x + 3) - x).cast("bigint")),
            F.lit(0).cast("bigint"), lambda a, x: a + x)

    def count(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")) \
                .otherwise(let(let(ranked, repeated), covered))

    return let(let(words, hashes), count)


def measure(text: Column) -> Column:
    """All measurements of one text as a struct of longs."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    blanks = " \t\n\x0b\x0c\r"
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n"),
                                                (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("d")))
    word_counts = let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _repeat_words(w).alias("r")))
    chars = F.length(F.translate(text, blanks, "")).cast("bigint")
    symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")
    return let(F.struct(word_counts.alias("w"), line_counts.alias("l")), lambda s: F.struct(
        s["w"]["n"].alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"),
        s["l"]["n"].alias("n_lines"), s["l"]["d"].alias("n_dup_lines"), s["w"]["r"].alias("n_repeat_words")))


@dataclass(frozen=True)
class Rule:
    """``fails`` maps the measurement columns (by name) to a boolean column."""
    name: str
    bit: int
    fails: Callable[[Callable[[str], Column]], Column]


RULES = [
    Rule("too_few_words", 0, lambda m: m("n_words") < 50),
    Rule("repeated_windows", 1, lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("many_symbols", 2, lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("short_words", 3, lambda m: m("word_chars") < 2 * m("n_words")),
    Rule("long_words", 4, lambda m: m("word_chars") > 15 * m("n_words")),
    Rule("repeated_lines", 5, lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines")),
]

#: version -> names of the rules whose failure rejects a document
POLICIES = {
    "base": ["too_few_words", "repeated_windows"],
    "v1": ["too_few_words", "repeated_windows", "many_symbols"],
    "v2": [r.name for r in RULES],
}


def mask(rule_names: list[str], rules: list[Rule] = RULES) -> int:
    by_name = {r.name: r.bit for r in rules}
    return sum(1 << by_name[n] for n in set(rule_names))


def failed_bits(m: Callable[[str], Column], rules: list[Rule] = RULES) -> Column:
    """The bits of all rules that fail on the measurements ``m`` (by name)."""
    bits = F.lit(0).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.fails(m), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rules: list[Rule] = RULES) -> DataFrame:
    """One row per input row: id, measurements, ``failed_bits``."""
    measured = docs.select(F.col(id_col).alias("_id"), measure(F.col(text_col)).alias("_m"))
    return measured.select(F.col("_id").alias(id_col), *[F.col("_m")[n].alias(n) for n in MEASUREMENTS],
                           failed_bits(lambda n: F.col("_m")[n], rules).alias("failed_bits"))


def passing(docs: DataFrame, policy: str = "v2", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` (all columns) that the policy keeps in the ledger."""
    bits = let(measure(F.col(text_col)), lambda m: failed_bits(lambda n: m[n], rules))
    return docs.filter(~rejected(policy, rules, bits))


def rejected(policy: str, rules: list[Rule] = RULES, bits: Column | None = None) -> Column:
    """Whether a ledger row (or ``bits``) is rejected under a policy version."""
    return (F.col("failed_bits") if bits is None else bits).bitwiseAND(F.lit(mask(POLICIES[policy], rules)).cast("bigint")) != 0


def apply_policy(book: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with ``kept`` under one policy version."""
    return book.withColumn("kept", ~rejected(policy))


def ablation(book: DataFrame, policy: str = "v2", rules: list[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: documents failing it, documents only it rejects,
    and documents kept if it were dropped.

    Documents are first counted per distinct bit pattern (at most 2**rules
    rows, combined map-side); the rules are then read off the patterns.
    """
    full = mask(POLICIES[policy], rules)
    patterns = book.groupBy(F.col("failed_bits").bitwiseAND(F.lit(full).cast("bigint")).alias("b")).agg(F.count("*").alias("n"))
    per_rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("bit"))
                                   for r in rules if r.name in POLICIES[policy]])).alias("r")
    x = patterns.select("b", "n", per_rule).select("b", "n", "r.*")
    hit = F.col("b").bitwiseAND(F.col("bit")) != 0
    without = F.col("b").bitwiseAND(F.bitwise_not("bit")) == 0
    return x.groupBy("rule").agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
                                 F.sum(F.when(hit & without, F.col("n")).otherwise(0)).alias("n_only_this"),
                                 F.sum(F.when(without, F.col("n")).otherwise(0)).alias("n_kept_without"))
