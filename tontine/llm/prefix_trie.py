"""Prefix tries of conversations, rolled up by centroid decomposition of the parent-edge forest.

``ordered_turns`` range-sorts the turns and gives each its position; ``rebuilt`` applies the
branching rule; ``prefix_nodes`` makes one node of every distinct sequence of first turns, named by
its smallest conversation and its depth. A turn hashes with its position, and a prefix is the
exclusive or of its turns' hashes (128 bits), so prefixes come from running aggregates and a node
knows its parent's hash without any join.

``centroid_rollup`` sums values over subtrees. A component of the forest is split at its centroid:
the deepest node whose subtree holds more than half of the component's weight, the weight of a node
being its conversations, so a subtree's weight is known from the turns below it. The subtree's total
is added along the path from the centroid to the component's top; the parts below the centroid and
the part above become components of their own, so a component's weight halves at least and a path
of any depth takes a logarithmic number of rounds. Components of more than ``bound`` nodes are split
by joins, round by round; smaller ones are packed into tasks that split them in memory the same way.

No group is unbounded: positions and prefixes run within slices of a conversation with carries
between slices; joins from many rows to one node treat the nodes that hold over a thousandth of all
turns apart (a thousand at most, broadcast). Only the digest of a node's ended conversations is one
stream a node, as SHA-256 is; its task reads sorted ids and keeps just the digest's state.

Defined results: rows with null conv_id are left out; a null role or text is empty; turns that tie
go by role, then text, repeated rows stay repeated turns; ``h`` original turns are inherited from
conversation ``c - c % 20`` as far as it has them; an empty table has no nodes; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine.llm.common import materialize, tidied
from tontine.llm.mixing import n_words

FAMILY, HEADS = 20, 4
SLICE = 4096  # depths of one conversation that run together
BOUND = 20_000  # nodes of a component that one task splits
HEAVY = 1000


def ordered_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, pos, carry_part, key, words)``: every turn's position (from 1) in its conversation, a
    digest of role and text, and the words of the text. One shuffle of the texts."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "row"]
    laid = src.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    laid = materialize(laid.select("conv", F.monotonically_increasing_id().alias("place"), F.spark_partition_id().alias("part"),
                                   F.md5(said.cast("binary")).alias("key"), n_words(F.col("text")).alias("words")), "turns")
    runs = laid.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("c"))  # a conversation in few partitions, one as a rule
    carry = runs.select("conv", "part", F.coalesce(F.sum("c").over(_before("part")), F.lit(0)).alias("carry"))
    inside = Window.partitionBy("conv", "part").orderBy("place")
    numbered = laid.withColumn("pos", F.row_number().over(inside)).join(carry, ["conv", "part"])
    return materialize(numbered.select("conv", "part", (F.col("pos") + F.col("carry")).alias("pos"), "key", "words"), "positions")


def _before(order: str) -> Window:
    return Window.partitionBy("conv").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def heads(conv: Column, n: int = HEADS) -> Column:
    """How many turns a conversation inherits."""
    return F.crc32(conv.cast("string").cast("binary")) % n


def rebuilt(turns: DataFrame, family: int = FAMILY, n: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """``ordered_turns`` -> the turns ``(conv, d, key, words, length)`` and the conversations
    ``(conv, length)`` after the branching rule."""
    convs = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    convs = convs.withColumns({"h": heads(F.col("conv"), n), "base": F.col("conv") - F.col("conv") % family})
    bases = convs.select(F.col("conv").alias("base"), F.least(F.col("own"), F.lit(n - 1)).alias("has"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least(F.col("h"), F.coalesce("has", F.lit(0))))
    convs = materialize(convs.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).select("conv", "base", "h", "taken", "length"), "conversations")
    runs = turns.groupBy("conv", "part").agg(F.lit(1).alias("one")).drop("one").join(convs, "conv")  # met by slice: no hot key
    own = turns.join(runs, ["conv", "part"]).where("pos > h").select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("d"), "key", "words", "length")
    first = turns.where(F.col("pos") < n).select(F.col("conv").alias("base"), F.col("pos").alias("d"), "key", "words")
    inherited = convs.where("taken > 0").join(first, "base").where("d <= taken").select("conv", "d", "key", "words", "length")
    return own.unionByName(inherited), convs.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, d, words, length, x, y, px, py)``: hash of the first ``d`` turns and of the first ``d - 1``."""
    hashed = turns.withColumns({"hx": F.xxhash64("d", "key"), "hy": F.xxhash64(F.lit("second"), "key", "d"), "slice": F.floor(F.col("d") / SLICE)})
    hashed = materialize(hashed, "hashed")
    sums = hashed.groupBy("conv", "slice").agg(F.bit_xor("hx").alias("sx"), F.bit_xor("hy").alias("sy"))
    w = _before("slice")
    carry = sums.select("conv", "slice", F.coalesce(F.bit_xor("sx").over(w), F.lit(0)).alias("cx"), F.coalesce(F.bit_xor("sy").over(w), F.lit(0)).alias("cy"))
    run = Window.partitionBy("conv", "slice").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    got = hashed.withColumns({"rx": F.bit_xor("hx").over(run), "ry": F.bit_xor("hy").over(run)}).join(carry, ["conv", "slice"])
    got = got.withColumns({"x": F.col("rx").bitwiseXOR(F.col("cx")), "y": F.col("ry").bitwiseXOR(F.col("cy"))})
    return got.select("conv", "d", "words", "length", "x", "y", F.col("x").bitwiseXOR(F.col("hx")).alias("px"), F.col("y").bitwiseXOR(F.col("hy")).alias("py"))


def _to_node(rows: DataFrame, nodes: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Inner join of many rows with the one node of their ``keys``; nodes with over a thousandth
    of all turns, at most a thousand, are broadcast."""
    heavy = nodes.where(F.col("n_convs") * HEAVY > total).drop("n_convs")
    marked = rows.join(F.broadcast(heavy.select(*keys).withColumn("__heavy", F.lit(True))), keys, "left")
    return (marked.where("__heavy").drop("__heavy").join(F.broadcast(heavy), keys)
            .unionByName(marked.where("__heavy is null").drop("__heavy").join(nodes.where(F.col("n_convs") * HEAVY <= total).drop("n_convs"), keys)))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (d, x, y, conv) -> one digest a node."""
    key, state = None, None
    for b in batches:
        out = []
        for *now, conv in zip(*(b.column(i).to_pylist() for i in range(4))):
            if now != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
        if out:
            yield _digest_batch(out)
    if state is not None:
        yield _digest_batch([(*key, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    d, x, y, s = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(s)], ["d", "x", "y", "ends_sha256"])


def subtree_sums(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (n x m) over the subtrees of a forest (``parent`` -1: a top; parents come
    first), by centroid decomposition, all components of a level at once."""
    n = len(parent)
    total = np.zeros_like(values)
    comp = np.zeros(n, dtype=np.int64)
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(depth)) + 1, [n]]) if n else np.zeros(1, int)
    levels = [np.arange(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
    for v in levels:  # every tree is a component, named by its top
        comp[v] = np.where(parent[v] < 0, v, comp[parent[v]])
    alive = np.ones(n, dtype=bool)
    while alive.any():
        levels = [v[alive[v]] for v in levels]
        levels = [v for v in levels if len(v)]
        up = np.where((parent >= 0) & (comp[parent] == comp) & alive[parent], parent, -1)
        size = alive.astype(np.int64)
        for v in reversed(levels):
            v = v[up[v] >= 0]
            np.add.at(size, up[v], size[v])
        live = np.flatnonzero(alive)
        half = live[2 * size[live] > size[comp[live]]]  # a path from each top down
        half = half[np.lexsort((-half, size[half], comp[half]))]
        x = half[np.concatenate([[True], comp[half][1:] != comp[half][:-1]])]  # the centroids
        is_x = np.zeros(n, dtype=bool)
        is_x[x] = True
        part = np.full(n, -1, dtype=np.int64)  # the child of the centroid that a node is below
        for v in levels:
            v = v[up[v] >= 0]
            part[v] = np.where(is_x[up[v]], v, part[up[v]])
        below = alive & ((part >= 0) | is_x)
        gain = np.zeros_like(values)
        np.add.at(gain, comp[below], values[below])
        total[x] += gain[comp[x]]
        at, add = up[x], gain[comp[x]]
        while (go := at >= 0).any():  # from each centroid to its top; paths share no node
            at, add = at[go], add[go]
            total[at] += add
            at = up[at]
        alive[x] = False
        moved = alive & (part >= 0)
        comp[moved] = part[moved]
    return total


def _in_memory(t: pa.Table) -> pa.Table:
    rep, d, prep, top, td = (t[c].to_numpy() for c in ("rep", "d", "prep", "c_rep", "c_d"))
    order = np.lexsort((rep, d))
    t = t.take(pa.array(order))
    rep, d, prep, top, td = (x[order] for x in (rep, d, prep, top, td))
    key = np.rec.fromarrays([d, rep])
    is_top = (rep == top) & (d == td)
    at = np.searchsorted(key, np.rec.fromarrays([d - 1, np.where(is_top, 0, prep)]))
    parent = np.where(is_top, -1, at)
    sums = subtree_sums(parent, d, np.stack([t["a"].to_numpy(), t["b"].to_numpy()], axis=1))
    return pa.table({"rep": pa.array(rep), "d": pa.array(d), "a": pa.array(sums[:, 0] + t["more_a"].to_numpy()), "b": pa.array(sums[:, 1] + t["more_b"].to_numpy())})


def centroid_rollup(nodes: DataFrame, paths: DataFrame, bound: int = BOUND) -> DataFrame:
    """Subtree sums of the values ``a`` and ``b``: ``(rep, d, a, b)`` for every node.

    ``nodes (rep, d, prep, weight, a, b)``: a node is named by a chain and its depth; ``prep`` is
    its parent's chain, ``weight`` the weight of its whole subtree. ``paths (conv, d, rep, next)``:
    the chains of the nodes at depths ``d`` and ``d + 1`` over every chain's own nodes.
    """
    zero = F.lit(0).cast("long")
    top = nodes.where("d = 0").select(F.col("rep").alias("c_rep"), F.col("d").alias("c_d"))
    work = nodes.crossJoin(F.broadcast(top)).withColumns({"more_a": zero, "more_b": zero})  # one root
    work = materialize(work, "component")
    done: list[DataFrame] = []  # nodes with their sums
    small: list[DataFrame] = []  # components for one task
    name = ["c_rep", "c_d"]
    n_nodes = work.count()
    while True:
        comps = materialize(work.groupBy(*name).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("whole")), "components")
        large = comps.where(F.col("n") > bound)
        if large.isEmpty():
            small.append(work)
            break
        small.append(work.join(comps.where(F.col("n") <= bound).select(*name), name, "left_semi"))
        active = work.join(large.select(*name, "whole"), name)
        # the centroid: the lightest, then deepest, of the nodes with more than half of the weight
        centre = (active.where(2 * F.col("weight") > F.col("whole")).groupBy(*name).agg(F.min(F.struct("weight", (-F.col("d")).alias("up"), "rep")).alias("x"))
                  .select(*name, F.col("x.rep").alias("x_rep"), (-F.col("x.up")).alias("x_d"), F.col("x.weight").alias("x_weight")))
        centre = materialize(centre, "centroids")
        at = paths.select(F.col("conv").alias("rep"), F.col("d").alias("x_d"), F.col("rep").alias("at"), "next")
        seen = active.join(centre, name).join(at, ["rep", "x_d"], "left")
        seen = seen.withColumns({"is_x": (F.col("rep") == F.col("x_rep")) & (F.col("d") == F.col("x_d")),
                                 "below": (F.col("d") > F.col("x_d")) & F.coalesce(F.col("at") == F.col("x_rep"), F.lit(False))})
        seen = materialize(seen.drop("whole", "at"), "split")
        gain = seen.where("is_x or below").groupBy(*name).agg(F.sum("a").alias("gain_a"), F.sum("b").alias("gain_b"))
        gain = materialize(centre.join(gain, name), "totals")
        # the centroid-to-top paths, as nodes of the centroid's own chain of ancestors
        on_path = (gain.join(paths.select(F.col("conv").alias("x_rep"), "d", "rep"), "x_rep").where("d < x_d and d >= c_d")
                   .select(*name, "rep", "d", "gain_a", "gain_b", F.col("x_weight").alias("lost")))
        done.append(seen.where("is_x").join(gain.select(*name, "gain_a", "gain_b"), name)
                    .select("rep", "d", (F.col("more_a") + F.col("gain_a")).alias("a"), (F.col("more_b") + F.col("gain_b")).alias("b")))
        under = seen.where("below").withColumns({"c_rep": F.col("next"), "c_d": F.col("x_d") + 1}).select(work.columns)
        over = seen.where("not below and not is_x").select(work.columns).join(on_path, [*name, "rep", "d"], "left")
        over = over.withColumns({"more_a": F.col("more_a") + F.coalesce("gain_a", zero), "more_b": F.col("more_b") + F.coalesce("gain_b", zero),
                                 "weight": F.col("weight") - F.coalesce("lost", zero)}).select(work.columns)
        work = materialize(under.unionByName(over), "component")
    packed = small[0]
    for more in small[1:]:
        packed = packed.unionByName(more)
    bins = max(1, -(-n_nodes // bound))
    packed = packed.withColumn("bin", F.pmod(F.xxhash64(*name), F.lit(bins)).cast("int"))
    sums = packed.groupBy("bin").applyInArrow(_in_memory, "rep long, d long, a long, b long")
    for more in done:
        sums = sums.unionByName(more)
    return sums


def prefix_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", bound: int = BOUND,
                family: int = FAMILY, n_heads: int = HEADS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``. ``n_heads`` 1 keeps conversations as they are."""
    turns, convs = rebuilt(ordered_turns(rows, conv, turn, role, text), family, n_heads)
    held = materialize(prefixes(turns), "prefixes")
    start = [F.lit(0).cast("long").alias(c) for c in ("d", "x", "y")]
    size = F.sum(F.col("length") - F.col("d") + 1)
    nodes = held.groupBy("d", "x", "y").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
                                            F.max("px").alias("px"), F.max("py").alias("py"), size.alias("weight"))
    root = (convs.agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") + 1).alias("weight")).where("rep is not null")
            .select(*start, "rep", "n_convs", F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("px"), F.lit(None).cast("long").alias("py"), "weight"))
    columns = [F.col(c).cast("long") for c in ("d", "x", "y", "rep", "n_convs", "words", "px", "py", "weight")]
    nodes = materialize(nodes.select(*columns).unionByName(root.select(*columns)), "nodes")
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    # a child names its parent by hash
    named = nodes.select((F.col("d") + 1).alias("d"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("rep").alias("prep"), "n_convs")
    edges = _to_node(nodes.where("d > 0").select("d", "x", "y", "px", "py"), named, ["d", "px", "py"], total).select("d", "x", "y", "prep")
    nodes = materialize(nodes.drop("px", "py").join(edges, ["d", "x", "y"], "left"), "edges")
    children = nodes.where("d > 0").groupBy(F.col("prep").alias("rep"), (F.col("d") - 1).alias("d")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["rep", "d"], "left").fillna(0, ["n_children"])
    nodes = materialize(nodes.withColumns({"a": (F.col("n_children") == 0).cast("long"), "b": (F.col("n_convs") - 1) * F.col("words")}), "forest")

    spots = held.select("conv", "d", "x", "y").unionByName(convs.select("conv", *start))
    spots = materialize(_to_node(spots, nodes.select("d", "x", "y", "rep", "n_convs"), ["d", "x", "y"], total).select("conv", "d", "rep"), "spots")
    nexts = spots.select("conv", (F.col("d") - 1).alias("d"), F.col("rep").alias("next"))
    paths = materialize(spots.join(nexts, ["conv", "d"], "left"), "paths")
    sums = centroid_rollup(nodes.select("rep", "d", "prep", "weight", "a", "b"), paths, bound)

    ended = held.where("d = length").select("d", "x", "y", "conv").unionByName(convs.where("length = 0").select(*start, "conv"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ended = ended.repartition(parts, "d", "x", "y").sortWithinPartitions("d", "x", "y", "conv").mapInArrow(tidied(_digests), "d long, x long, y long, ends_sha256 string")
    out = nodes.drop("a", "b").join(sums, ["rep", "d"]).join(ended, ["d", "x", "y"], "left")
    return out.select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("prep").alias("parent_conv_id"), "n_convs", "n_children",
                      F.col("a").alias("n_leaves"), F.col("b").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
