"""Prefix trie of conversations, as a z-fast trie in tables.

A conversation is a sequence of turns (role, text).  The compacted trie has a
node at every depth where conversations part or end; a node's edge comes from
its parent's depth ``p`` down to its extent ``e``.

* Digests.  A depth-d prefix is named by two 64-bit lanes, each the running xor
  of a hash of (depth, role, text); a turn itself is named by its SHA-256.
* Handles.  A node is hashed at its handle, the prefix at the two-fattest depth
  in (p, e], the one divisible by the largest power of two.
* Search.  A conversation finds the deepest node on its path by fat binary
  search: it looks up its prefix at the two-fattest depth of the open interval,
  and goes on below the node found or above the depth that has none.  Then the
  child by its next turn is the exit node, and the two paths are compared along
  its edge.
* Batches.  Batches of conversations grow by ``GROWTH``.  All of a batch search
  at once; edges are split where conversations leave them, and of those that
  leave at one place by the same turn one goes in as a leaf.  The others go on
  from there with the next batch; one by hash goes in, so a path that many
  share is followed by a number of rounds that grows with their logarithm.
* Sums over subtrees use pointer doubling on the compacted nodes; then edges
  are expanded into the nodes of every depth.

Every step is a join on digests between tables of rows; no conversation is held
whole (its turns stay rows, ordered by ``spread.running``), nor a node's
members, and hot prefixes are joined by ``spread.attach``.  The list of member
ids behind ``ends_sha256`` is hashed as a sorted stream.

Edge cases: rows with a null conv_id are ignored; null role or text is empty;
equal turn numbers go by the hash of role and text; equal rows are turns each;
null turn numbers come first.  Equal conversations are one path with several
members.  An empty table gives no node, not even a root.  Ids are whole
numbers.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.llm.spread import HOT_KEYS, LEAST, attach, hot_keys, running
from flowgrid.session import materialize

FIRST_SHARE = 8
GROWTH = 8
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, place from 1, t: SHA-256 of role and text, words) of every turn, written."""
    col = {c: conversations[f"`{c}`"] for c in ("conv_id", "turn", "role", "text")}
    role, text = F.coalesce(col["role"], F.lit("")), F.coalesce(col["text"], F.lit(""))
    rows = conversations.filter(col["conv_id"].isNotNull()).select(
        col["conv_id"].cast("long").alias("conv"), col["turn"].cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("t"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    rows = rows.withColumn("n", F.monotonically_increasing_id())  # spreads equal rows
    return materialize(running(rows, "conv", ["turn", "t", "n"]).select("conv", "place", "t", "words"), "turns")


def spliced(ordered: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the first turns of their block's first one:
    (all ids, rows conv, d, t, words).  Conversation c starts with the first h
    turns of c - c % ``block``, h = crc32(decimal c) % ``heads``, and goes on
    with its own after its first h."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    convs = ordered.groupBy("conv").agg(F.least(F.count("*"), F.lit(heads - 1)).alias("k"))
    convs = materialize(convs.withColumns({"base": F.col("conv") - F.col("conv") % block, "h": h}), "conversations")
    lead = convs.select(F.col("conv").alias("base"), F.col("k").alias("has"))
    convs = materialize(convs.join(lead, "base", "left").withColumn("n_head", F.least("h", F.coalesce("has", F.lit(0)))), "conversations")
    own = materialize(ordered.filter(F.col("place") > h), "own")
    own = attach(own, convs.select("conv", "h", "n_head"), ["conv"], "inner")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("n_head")).alias("d"), "t", "words")
    first = ordered.filter(F.col("place") < heads).select(F.col("conv").alias("base"), "place", "t", "words")
    head = convs.join(first, "base").filter(F.col("place") <= F.col("h")).select("conv", F.col("place").alias("d"), "t", "words")
    return convs.select("conv"), own.unionByName(head)


def _paths(rows: DataFrame) -> DataFrame:
    """(conv, d, words, p, q): the digest lanes of every prefix."""
    lanes = rows.select("conv", "d", "words", F.xxhash64(F.lit(1), "d", "t").alias("p"), F.xxhash64(F.lit(2), "d", "t").alias("q"))
    return materialize(running(lanes, "conv", ["d"], xors=["p", "q"]).drop("place"), "paths")


def two_fattest(lo: str, hi: str) -> Column:
    """The number in (lo, hi] that is divisible by the largest power of two."""
    m = f"(length(bin({lo} ^ {hi})) - 1)"
    return F.expr(f"shiftleft(shiftright({hi}, {m}), {m})").cast("long")


def _at(rows: DataFrame, paths: DataFrame, seq: str, depth: Column, names: tuple[str, str], how: str = "left") -> DataFrame:
    """Adds the digest of conversation ``seq`` at ``depth`` ((0, 0) at depth 0)."""
    side = paths.select(F.col("seq").alias("_s"), F.col("d").alias("_d"), F.col("p").alias(names[0]), F.col("q").alias(names[1]))
    out = rows.withColumn("_at", depth)
    out = out.join(side, (F.col(seq) == F.col("_s")) & (F.col("_at") == F.col("_d")), how)
    zero = {c: F.when(F.col("_at") == 0, 0).otherwise(F.col(c)) for c in names}
    return out.withColumns(zero).drop("_s", "_d", "_at")


_NODE = ["e", "ep", "eq", "p", "pp", "pq", "rep"]


def _handled(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes with their handle (f, fp, fq) and the digest one turn below the parent (sp, sq)."""
    out = _at(nodes.withColumn("f", two_fattest("p", "e")), paths, "rep", F.col("f"), ("fp", "fq"))
    return _at(out, paths, "rep", F.col("p") + 1, ("sp", "sq"))


def _search(pending: DataFrame, nodes: DataFrame, paths: DataFrame, steps: int, hot: list) -> DataFrame:
    """Fat binary search of all pending conversations: (seq, L, k, and the last
    node found); ``k`` is the depth of a node known to be on the path."""
    found = [f"n_{c}" for c in _NODE]
    handles = nodes.select(F.col("f").alias("at"), F.col("fp").alias("hp"), F.col("fq").alias("hq"), *[F.col(c).alias(f"n_{c}") for c in _NODE])
    types = dict(nodes.dtypes)
    state = pending.select("seq", "L", "k", F.col("k").alias("lo"), F.col("L").alias("hi"),
                           *[F.lit(None).cast(types[c]).alias(f"n_{c}") for c in _NODE])
    for step in range(steps):
        # a closed interval asks at depth 0, where no node has its handle
        open_, hit = F.col("lo") < F.col("hi"), F.col("n_e").isNotNull()
        asked = state.withColumn("at", F.when(open_, two_fattest("lo", "hi")).otherwise(0).cast("long")).withColumnsRenamed({c: f"o{c}" for c in found})
        asked = _at(asked, paths, "seq", F.col("at"), ("hp", "hq"))
        miss = (F.col("at") > 0) & ~hit
        state = attach(asked, handles, ["at", "hp", "hq"], hot=hot).select(
            "seq", "L", "k", F.when(hit, F.col("n_e")).otherwise(F.col("lo")).alias("lo"), F.when(miss, F.col("at") - 1).otherwise(F.col("hi")).alias("hi"),
            *[F.when(hit, F.col(c)).otherwise(F.col(f"o{c}")).alias(c) for c in found])
        if step % 2 or step == steps - 1:
            state = materialize(state, "search")
    return state


def _exits(pending: DataFrame, nodes: DataFrame, paths: DataFrame, steps: int, long: list) -> DataFrame:
    """Where pending conversations leave the trie: (seq, L, the exit node's edge
    if any, k: the depth down to which they agree, its digest kp, kq, and the
    next one np, nq).  Paths of the conversations ``long`` are spread."""
    hot = [(h["d"], h["p"], h["q"]) for h in hot_keys(paths.join(pending.select("seq"), "seq", "left_semi"), ["d", "p", "q"])]
    edge = [f"n_{c}" for c in _NODE]
    r = _at(_search(pending, nodes, paths, steps, hot), paths, "seq", F.coalesce("n_e", F.lit(0)), ("xp", "xq"))
    none = F.col("n_e").isNull()
    whole = ~none & (F.col("n_e") <= F.col("L")) & F.col("xp").eqNullSafe(F.col("n_ep")) & F.col("xq").eqNullSafe(F.col("n_eq"))
    r = r.withColumns({"inside": ~none & ~whole, "k": F.when(whole, F.col("n_e")).otherwise(F.col("k"))})
    below = ~F.col("inside") & (F.col("k") < F.col("L"))  # others ask at depth 0, where no edge starts
    r = r.withColumn("at", F.when(below, F.col("k") + 1).otherwise(0).cast("long")).withColumnsRenamed({c: f"o{c}" for c in edge})
    child = nodes.select((F.col("p") + 1).alias("at"), F.col("sp").alias("cp"), F.col("sq").alias("cq"), *[F.col(c).alias(f"n_{c}") for c in _NODE])
    r = attach(_at(r, paths, "seq", F.col("at"), ("cp", "cq")), child, ["at", "cp", "cq"], hot=hot)
    at = materialize(r.select("seq", "L", "k", *[F.when(F.col("inside"), F.col(f"o{c}")).otherwise(F.col(c)).alias(c) for c in edge]), "exit-nodes")
    # down the edge: a prefix at a depth of the exit edge that is in the trie at all is on that edge
    down = at.filter(F.col("n_e").isNotNull()).select("seq", F.col("n_p").alias("_p"), F.least("n_e", "L").alias("_e"))
    rows = attach(paths.select("seq", "d", "p", "q"), down, ["seq"], "inner", hot=long).filter((F.col("d") > F.col("_p")) & (F.col("d") <= F.col("_e")))
    there = paths.join(at.select(F.col("n_rep").alias("seq")).distinct(), "seq", "left_semi").select("d", "p", "q").distinct()
    deep = attach(rows, there, ["d", "p", "q"], "left_semi", hot=hot).groupBy("seq").agg(F.max("d").alias("_deep"))
    out = at.join(deep, "seq", "left").withColumn("k", F.greatest("k", F.coalesce("_deep", F.lit(0)))).drop("_deep")
    out = _at(out, paths, "seq", F.col("k"), ("kp", "kq"))
    return materialize(_at(out, paths, "seq", F.col("k") + 1, ("np", "nq")), "exits")


def build(seqs: DataFrame, paths: DataFrame) -> DataFrame:
    """The compacted trie of distinct sequences ``seqs`` (seq, L, p, q: their
    digest) with ``paths`` (seq, d, p, q): one row per node but the root, with
    the fields of ``_NODE``, handle and first turn."""
    spark = seqs.sparkSession
    kinds = ", ".join(f"{c} long" for c in [*_NODE, "f", "fp", "fq", "sp", "sq"])
    nodes = spark.createDataFrame([], kinds)
    seqs = seqs.filter(F.col("L") > 0)
    # the longest; a fat binary search takes one step more than the bits of its depth at most
    top = seqs.select("seq", "L").orderBy(F.desc("L"), "seq").limit(HOT_KEYS).collect()
    steps, long = (top[0]["L"].bit_length() if top else 0), [(r["seq"],) for r in top if r["L"] > LEAST]
    arrive = F.pmod(F.xxhash64("seq", F.lit("batch")), F.lit(FIRST_SHARE))
    lo, hi, pending = 0, 1, None
    while True:
        new = seqs.filter((arrive >= lo) & (arrive < hi)).select("seq", "L", F.lit(0).cast("long").alias("k")) if lo < FIRST_SHARE else None
        batch = new if pending is None else pending if new is None else pending.unionByName(new)
        lo, hi = hi, min(FIRST_SHARE, hi * GROWTH)
        if batch.isEmpty() and new is None:
            return nodes
        out = _exits(batch, nodes, paths, steps, long)
        key = [f"n_{c}" for c in ("e", "ep", "eq")]
        split = out.filter(F.col("n_e").isNotNull() & (F.col("k") < F.col("n_e")))
        hit = split.select(*[F.col(f"n_{c}").alias(c) for c in ("e", "ep", "eq")]).distinct()
        points = split.select(*[f"n_{c}" for c in _NODE], "k", "kp", "kq").distinct()
        ends = points.select(*[f"n_{c}" for c in _NODE]).distinct()
        points = points.unionByName(ends.withColumns({"k": F.col("n_e"), "kp": F.col("n_ep"), "kq": F.col("n_eq")}))
        w = Window.partitionBy(*key).orderBy("k")  # the depths at which one edge is split
        above = {c: F.coalesce(F.lag(k).over(w), F.col(f"n_{c}")) for c, k in (("p", "k"), ("pp", "kp"), ("pq", "kq"))}
        pieces = points.withColumns(above).select(F.col("k").alias("e"), F.col("kp").alias("ep"), F.col("kq").alias("eq"), "p", "pp", "pq",
                                                  F.col("n_rep").alias("rep"))
        leave = out.filter(F.col("k") < F.col("L"))
        one = materialize(leave.groupBy("k", "kp", "kq", "np", "nq").agg(F.min(F.struct(F.xxhash64("seq"), "seq")).alias("_one"))
                          .select("k", "kp", "kq", F.col("_one.seq").alias("seq")), "leaves")
        leaves = one.join(seqs, "seq").select(F.col("L").alias("e"), F.col("p").alias("ep"), F.col("q").alias("eq"), F.col("k").alias("p"),
                                              F.col("kp").alias("pp"), F.col("kq").alias("pq"), F.col("seq").alias("rep"))
        made = _handled(pieces.unionByName(leaves), paths)
        kept = nodes.join(hit, ["e", "ep", "eq"], "left_anti")
        nodes = materialize(kept.select(*made.columns).unionByName(made), "trie")
        pending = materialize(leave.join(one.select("seq"), "seq", "left_anti").select("seq", "L", "k"), "pending")


def _sum_up(nodes: DataFrame, values: dict[str, tuple]) -> DataFrame:
    """``id``, ``parent`` (null at the root) and ``values`` of each node summed
    (or otherwise combined) over its subtree, by pointer doubling: after step i
    a node has its descendants less than 2 ** i below and points 2 ** i up."""
    names = list(values)
    state = materialize(nodes.select("id", F.col("parent").alias("up"), *names), "subtree")
    while True:
        lower = state.filter(F.col("up").isNotNull())
        if lower.isEmpty():
            return state.select("id", *names)
        add = lower.groupBy("up").agg(*[values[c][0](c).alias(f"_{c}") for c in names]).withColumnRenamed("up", "id")
        both = state.join(add, "id", "left").withColumns({c: values[c][1](F.col(c), F.col(f"_{c}")) for c in names})
        jump = attach(lower.select("id", "up"), state.select(F.col("id").alias("up"), F.col("up").alias("_up")), ["up"], "inner")
        state = materialize(both.drop("up", *[f"_{c}" for c in names]).join(jump.select("id", F.col("_up").alias("up")), "id", "left")
                            .select("id", "up", *names), "subtree")


def _plus(a: Column, b: Column) -> Column:
    return a + F.coalesce(b, F.lit(0))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each run of equal (L, p, q): a stream,
    never a list."""
    key, sha = None, None
    names = ["L", "p", "q", "sha"]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in key], pa.array([sha.hexdigest()], pa.string())], names=names)

    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in names[:3]]))
        ids = batch.column("conv").to_pylist()
        i = 0
        while i < len(ids):
            j = i
            while j < len(ids) and keys[j] == keys[i]:
                j += 1
            text = ",".join(map(str, ids[i:j])).encode()
            if keys[i] == key:
                sha.update(b"," + text)
            else:
                if key is not None:
                    yield out()
                key, sha = keys[i], hashlib.sha256(text)
            i = j
    if key is not None:
        yield out()


def prefix_trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Every depth's node of the trie of conversations ``convs`` (conv) whose
    turns are ``rows`` (conv, d from 1, t, words): ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    every = _paths(rows)
    last = every.groupBy("conv").agg(F.max(F.struct("d", "p", "q")).alias("_l"))
    zero = F.lit(0).cast("long")
    ends = materialize(convs.join(last, "conv", "left").select(
        "conv", *[F.coalesce(F.col(f"_l.{c}"), zero).alias(a) for c, a in (("d", "L"), ("p", "p"), ("q", "q"))]), "ends")
    seqs = materialize(ends.groupBy("L", "p", "q").agg(F.min("conv").alias("seq"), F.count("*").alias("n")), "sequences")
    paths = materialize(attach(every, seqs.select(F.col("seq").alias("conv")), ["conv"], "left_semi").withColumnRenamed("conv", "seq"), "paths")
    trie = build(seqs.drop("n"), paths)

    # nodes with numbers, parents and what ends there
    root = seqs.groupBy().agg(F.count("*").alias("_k")).filter(F.col("_k") > 0).select(
        zero.alias("e"), zero.alias("ep"), zero.alias("eq"), *[F.lit(None).cast("long").alias(c) for c in ("p", "pp", "pq", "rep")])
    nodes = materialize(trie.select(*_NODE).unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    sha = (ends.repartition("L", "p", "q").sortWithinPartitions("L", "p", "q", "conv").select("L", "p", "q", "conv")
           .mapInArrow(_digests, "L long, p long, q long, sha string"))
    at = [F.col(c).alias(a) for c, a in (("L", "e"), ("p", "ep"), ("q", "eq"))]
    here = seqs.select(*at, F.col("seq").alias("conv_id"), F.col("n").alias("n_convs")).join(sha.select(*at, "sha"), ["e", "ep", "eq"])
    up = nodes.select(F.col("e").alias("p"), F.col("ep").alias("pp"), F.col("eq").alias("pq"), F.col("id").alias("parent"))
    linked = attach(nodes.filter(F.col("p").isNotNull()), up, ["p", "pp", "pq"], "inner")
    linked = linked.unionByName(nodes.filter(F.col("p").isNull()).withColumn("parent", F.lit(None).cast("long")))
    linked = materialize(linked.join(here, ["e", "ep", "eq"], "left"), "linked")
    kids = linked.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    linked = linked.join(kids, "id", "left").withColumns({"n_children": F.coalesce("n_children", zero), "n_convs": F.coalesce("n_convs", zero)})
    linked = materialize(linked.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "linked")
    plus = (F.sum, _plus)
    under = _sum_up(linked, {"n_convs": plus, "n_leaves": plus, "conv_id": (F.min, lambda a, b: F.least(a, b))})

    # the rows of each edge: its conversation's turns after the edges above it
    mark = nodes.filter(F.col("p").isNotNull()).select(F.col("rep").alias("seq"), F.col("e").alias("d"), F.lit(1).cast("long").alias("m"))
    marked = paths.select("seq", "d", "words").join(mark, ["seq", "d"], "left").withColumn("m", F.coalesce("m", zero))
    own = F.col("m").alias("own")
    counted = running(marked.select("*", own), "seq", ["d"], sums=["m"]).drop("place")
    counted = materialize(counted.withColumn("nth", F.col("m") - F.col("own")), "edge-rows")
    nth = counted.filter(F.col("own") == 1).select("seq", "d", "nth")
    ids = nodes.filter(F.col("p").isNotNull()).select(F.col("rep").alias("seq"), F.col("e").alias("d"), "id", F.col("p").alias("_p"), F.col("e").alias("_e"))
    edge = ids.join(nth, ["seq", "d"]).select("seq", "nth", "id", "_p", "_e")
    depth = attach(counted.select("seq", "nth", "d", "words"), edge, ["seq", "nth"], "inner").filter(F.col("d") > F.col("_p"))
    depth = materialize(running(depth.select("id", "d", "words", F.col("words").alias("upto")), "id", ["d"], sums=["upto"]).drop("place"), "depths")

    weight = depth.groupBy("id").agg(F.sum("words").alias("_w"))
    info = materialize(linked.select("id", "parent", "p", "e", "n_children", "sha").join(under, "id").join(weight, "id", "left")
                       .withColumn("own_saved", (F.col("n_convs") - 1) * F.coalesce("_w", zero)), "node-sums")
    saved = _sum_up(info, {"own_saved": plus}).withColumnRenamed("own_saved", "saved")
    above = info.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv"))
    parents = attach(info.filter(F.col("parent").isNotNull()).select("id", "parent"), above, ["parent"], "left").select("id", "parent_conv")
    info = materialize(info.drop("own_saved").join(saved, "id").join(parents, "id", "left"), "node-facts")
    out = attach(depth, info, ["id"], "inner")
    # the root has no turn, so no row of an edge
    out = out.unionByName(info.filter(F.col("p").isNull()).withColumns({"d": zero, "words": zero, "upto": zero}).select(*out.columns))
    end = F.col("d") == F.col("e")
    return out.select("conv_id", F.col("d").alias("depth"),
                      F.when(F.col("d") == F.col("p") + 1, F.col("parent_conv")).when(F.col("d") > 0, F.col("conv_id")).alias("parent_conv_id"),
                      "n_convs", F.when(end, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
                      (F.col("saved") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("words"))).alias("saved_tokens"),
                      F.when(end & F.col("sha").isNotNull(), F.col("sha")).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"))
