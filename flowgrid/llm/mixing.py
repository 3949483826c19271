"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document
belongs to).  On that small table the driver solves a flow: a pattern offers
its words once at cost 0, a second time at cost 1, and so on (convex
repetition cost, ``max_passes`` passes), each source demands its target.  Back
on the documents, a pattern's words are handed out in a seeded order: every
document gets the full passes, the documents first in that order one more, and
the document at the boundary the part that is left, so a source's total meets
its target to the word wherever the flow allows it.

The running word count over a pattern never sits in one task: rows are
range-partitioned on pattern, seeded hash, id, size, text hash and a row
number, so a pattern, an id on a third of the rows or rows equal in everything
are split over tasks (``spread.running``).  Sources and their targets are
tables; the driver holds patterns and sources only where several patterns
compete for a source, because there the flow has something to decide.

Edge cases: null text has size 0; a null source is a source of its own, last in
order; documents without any source (empty membership) take 0; a null doc_id
hashes as "null"; rows that repeat a doc_id count like any other rows (their
order among themselves is by size, then by text).  Sources of size 0 get
target 0.  An empty table gives an empty result.  Extra columns are ignored.

Bounds: any number of sources.  The driver holds one row for each competing
pattern and each of their sources, at most ``MAX_PATTERNS`` of each; more raise
an error.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm.spread import attach, hot_keys, running
from flowgrid.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
SEED = "mix-1"
MAX_PATTERNS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], total: float,
            limit: float = MAX_PASSES) -> dict[str | None, float]:
    """Share ``total`` by weight; a source stops at ``limit`` times its size and
    its excess goes to the others by weight."""
    open_, left, weight = set(), total, sum(weights[s] for s in sizes)
    for s in sorted(sizes, key=lambda s: limit * sizes[s] / weights[s]):
        if limit * sizes[s] < left / weight * weights[s]:
            left -= limit * sizes[s]
            weight -= weights[s]
        else:
            open_.add(s)
    level = left / weight if open_ else 0.0
    return {s: level * weights[s] if s in open_ else float(limit * sizes[s]) for s in sizes}


def cycle_weights(sources: list[str | None], weights: tuple = WEIGHTS) -> dict[str | None, float]:
    """Weights repeat over the sources in code-point order, null last."""
    order = sorted((s for s in sources if s is not None)) + [s for s in sources if s is None]
    return {s: weights[i % len(weights)] for i, s in enumerate(order)}


class _Flow:
    """Maximum flow by blocking flows on an adjacency list."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[int] = []

    def add(self, u: int, v: int, cap: int) -> int:
        for a, b, c in ((u, v, cap), (v, u, 0)):
            self.out[a].append(len(self.to))
            self.to.append(b)
            self.cap.append(c)
        return len(self.to) - 2

    def run(self, s: int, t: int) -> None:
        while True:
            level = {s: 0}
            queue = deque([s])
            while queue:
                u = queue.popleft()
                for e in self.out[u]:
                    if self.cap[e] and self.to[e] not in level:
                        level[self.to[e]] = level[u] + 1
                        queue.append(self.to[e])
            if t not in level:
                return
            nxt = [0] * len(self.out)
            path: list[int] = []
            u = s
            while True:
                if u == t:
                    push = min(self.cap[e] for e in path)
                    for e in path:
                        self.cap[e] -= push
                        self.cap[e ^ 1] += push
                    while path and not self.cap[path[-1]]:
                        path.pop()
                    path = path[:next((i for i, e in enumerate(path) if not self.cap[e]), len(path))]
                    u = self.to[path[-1]] if path else s
                    continue
                while nxt[u] < len(self.out[u]):
                    e = self.out[u][nxt[u]]
                    if self.cap[e] and level.get(self.to[e]) == level[u] + 1:
                        break
                    nxt[u] += 1
                if nxt[u] < len(self.out[u]):
                    path.append(e)
                    u = self.to[e]
                elif path:
                    u = self.to[path.pop() ^ 1]
                    nxt[u] += 1
                else:
                    break


def route(sizes: dict[tuple, int], quotas: dict[str | None, int], max_passes: int = MAX_PASSES) -> dict[tuple, dict]:
    """Words each pattern sends to each of its sources, with least repetition.

    Only the arcs into patterns cost anything, so opening one pass after the
    other and augmenting to a maximum each time is the min-cost maximum flow.
    """
    pats, srcs = list(sizes), list(quotas)
    s, t = 0, 1
    p_at = {p: 2 + i for i, p in enumerate(pats)}
    s_at = {x: 2 + len(pats) + i for i, x in enumerate(srcs)}
    g = _Flow(2 + len(pats) + len(srcs))
    inner = {(p, x): g.add(p_at[p], s_at[x], sum(quotas.values())) for p in pats for x in p}
    for x in srcs:
        g.add(s_at[x], t, quotas[x])
    for _ in range(max_passes):
        for p in pats:
            g.add(s, p_at[p], sizes[p])
        g.run(s, t)
    return {p: {x: g.cap[inner[p, x] + 1] for x in p} for p in pats}


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, total: float, weights: tuple = WEIGHTS, limit: float = MAX_PASSES) -> DataFrame:
    """``sources`` (src, source_size) with ``target``: the shares of ``total`` by
    cycled weight, each stopped at ``limit`` times its size and its excess given
    to the others (``targets`` as tables, for any number of sources).

    In the order of cap / weight the sources before some place stop at their cap
    and those from it on share what is left; that place is the first whose cap
    reaches its share.  Running sums come from ordered scans; one number, the
    level, passes through the driver."""
    by = ["_none", "src"]
    place = running(sources.withColumns({"_one": F.lit(1).cast("long"), "_none": F.col("src").isNull()}), "_one", by)
    cycled = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    cap = F.lit(float(limit)) * F.col("source_size")
    s = place.withColumns({"_w": cycled, "_cap": cap}).drop("place").withColumns({"_k": F.col("_cap") / F.col("_w"), "_cw": F.col("_w"), "_cc": F.col("_cap")})
    s = materialize(running(s, "_one", ["_k", *by], sums=["_cw", "_cc"]), "mix-sources")
    all_weight = s.agg(F.sum("_w")).first()[0] or 0.0
    level = (F.lit(float(total)) - (F.col("_cc") - F.col("_cap"))) / (F.lit(all_weight) - (F.col("_cw") - F.col("_w")))
    found = s.where(F.col("_k") >= level).agg(F.min_by(level, F.struct("_k", *by))).first()[0]
    target = F.col("_cap") if found is None else F.least(F.col("_cap"), F.lit(found) * F.col("_w"))
    return s.select("src", "source_size", target.alias("target"))


def _plan(patterns: DataFrame, weights: tuple, share: float, max_passes: int) -> DataFrame:
    """Per pattern ``_key``: full passes ``_full``, words of one more ``_rest``,
    and ``source_size`` / ``target`` of its sources.

    A pattern of one source that no pattern of several shares has one arc, so
    its flow is its source's quota: these, any number of them, are joined.  The
    flow itself runs on the patterns that compete for a source."""
    spark = patterns.sparkSession
    patterns = materialize(patterns, "mix-patterns")
    total = patterns.agg(F.sum("size")).first()[0] or 0
    sizes = patterns.select(F.explode("src").alias("src"), "size").groupBy("src").agg(F.sum("size").alias("source_size"))
    goal = materialize(source_targets(sizes, share * total, weights, max_passes), "mix-targets")
    shared = patterns.where(F.size("src") > 1).select(F.explode("src").alias("src")).distinct()
    # null is a source like others
    single = patterns.where(F.size("src") == 1).select("_key", "size", F.get("src", F.lit(0)).alias("src"))
    lone = single.join(shared.withColumnRenamed("src", "_s"), F.col("src").eqNullSafe(F.col("_s")), "left_anti")
    lone = lone.join(goal.withColumnRenamed("src", "_g"), F.col("src").eqNullSafe(F.col("_g")))
    quota = F.floor(F.col("target") + 0.5)
    some = F.col("size") > 0
    lone = lone.select("_key", F.when(some, F.floor(quota / F.when(some, F.col("size")))).otherwise(0).cast("long").alias("_full"),
                       F.when(some, quota % F.when(some, F.col("size"))).otherwise(0).cast("long").alias("_rest"),
                       F.array("source_size").alias("source_size"), F.array("target").alias("target"))
    rest = patterns.join(lone.select("_key"), "_key", "left_anti").limit(MAX_PATTERNS + 1).collect()
    if len(rest) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns compete for sources")
    rows = []
    if rest:
        wanted = shared.join(goal.withColumnRenamed("src", "_g"), F.col("src").eqNullSafe(F.col("_g"))).limit(MAX_PATTERNS + 1).collect()
        if len(wanted) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} sources in competing membership patterns")
        source_size, target = ({r["src"]: r[c] for r in wanted} for c in ("source_size", "target"))
        sized = {tuple(r["src"]): r["size"] for r in rest}
        flow = route(sized, {x: int(t + 0.5) for x, t in target.items()}, max_passes)
        for r in rest:
            p = tuple(r["src"])
            full, left = divmod(sum(flow[p].values()), r["size"]) if r["size"] else (0, 0)
            rows.append((r["_key"], full, left, [source_size[x] for x in p], [target[x] for x in p]))
    return lone.unionByName(spark.createDataFrame(rows, "_key string, _full long, _rest long, source_size array<long>, target array<double>"))


def mix(docs: DataFrame, membership: Column, weights: tuple = WEIGHTS, share: float = SHARE,
        max_passes: int = MAX_PASSES, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
        keep: list[str] | None = None) -> DataFrame:
    """Per document row: ``size``, its ``sources`` (array), ``taken`` words and
    ``source_size`` / ``target`` of its sources (arrays aligned with ``sources``).

    ``keep`` names input columns to carry, as ``k_0``, ``k_1``, ... in that order.
    """
    spark = docs.sparkSession
    membership = F.coalesce(membership, F.array().cast("array<string>"))
    nulls_last = F.concat(F.array_sort(F.array_compact(F.array_distinct(membership))),
                          F.filter(F.array_distinct(membership), lambda x: x.isNull()))
    thin = docs.select(F.col(f"`{id_col}`").alias("_id"), nulls_last.alias("_src"), size_of(F.col(f"`{text_col}`")).alias("_size"),
                       F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")))).alias("_h"),
                       F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_t"),
                       *[F.col(f"`{c}`").alias(f"k_{i}") for i, c in enumerate(keep or [])])
    carried = [f"k_{i}" for i in range(len(keep or []))]
    # every text is searched once; equal rows have a number of their own, so they can be dealt apart
    rows = materialize(thin.withColumns({"_key": F.to_json("_src"), "_n": F.monotonically_increasing_id()}), "mix-rows")
    plan = _plan(rows.groupBy("_key").agg(F.first("_src").alias("src"), F.sum("_size").alias("size")), weights, share, max_passes)
    order = running(rows.select("_key", "_h", "_id", "_size", "_t", "_n", F.col("_size").alias("_cum")), "_key", ["_h", "_id", "_size", "_t", "_n"],
                    sums=["_cum"]).select("_n", (F.col("_cum") - F.col("_size")).alias("_cum"))
    hot = hot_keys(rows, ["_key"])
    placed = attach(rows.join(order, "_n"), plan, ["_key"], "inner", hot=hot)
    extra = F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_rest") - F.col("_cum")))
    return placed.select(*carried, F.col("_id").alias(id_col), F.col("_src").alias("sources"),
                         F.col("_size").alias("size"), "source_size", "target",
                         (F.col("_full") * F.col("_size") + extra).cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, membership: Column, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as it is
    passed over, a last part of at least half a document counting as a pass."""
    mixed = mix(docs, membership, id_col=id_col, keep=docs.columns, **options)
    part = F.col("taken") % F.col("size")
    passes = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size")) + (2 * part >= F.col("size")).cast("int")).otherwise(0)
    taken = mixed.withColumn("_passes", passes.cast("int")).filter(F.col("_passes") > 0)
    copies = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_passes"))))
    return copies.select(*[F.col(f"k_{i}") for i in range(len(docs.columns))]).toDF(*docs.columns)
