"""Approximate nearest neighbours by learned partitions.

Fit, on a sample of at most ``sample`` vectors: the sample's exact neighbour graph (computed in
Spark, block by block), a balanced partitioning of that graph (bisection along principal
directions, refined by moving vectors to the part that holds most of their neighbours, within a
capacity), and a small network that predicts from a vector which parts hold its neighbours. The
number of parts to probe is the smallest whose recall on the sample reaches ``aim``.

Index: the network places every row in its most probable part. A part is cut into blocks of
about ``block`` rows by a hash of the id, so neither a popular part nor one vector that holds a
third of all rows meets in one task. Search: the network routes each query to its most probable
parts, whose blocks rank it exactly, in double precision on the original vectors; the best of the
blocks are merged.

Defined results: vectors null, empty, zero, with null or non-finite components, or of another
length than most take no part, neither do rows without id; rows that repeat an id count once; a query is never its
own candidate; fewer candidates than ``k`` give all of them; with at most ``sample_min`` rows
there is one part, which makes the search exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine.llm.common import materialize

SAMPLE, ROWS_PER_PART, MAX_PARTS, BLOCK, QUERY_BLOCK = 20_000, 1_500, 256, 4_096, 20_000
GRAPH_K, AIM = 10, 0.97


def _matrix(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return np.asarray(column.flatten()).astype(np.float64).reshape(n, -1)


def nearest(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query index, ids, distances) of the ``k`` nearest rows, ties to the smaller id. A matrix
    product preselects with a margin for its rounding; distances are then taken directly."""
    norm = (rows ** 2).sum(1)
    for at in range(0, len(queries), 256):
        q = queries[at:at + 256]
        near = norm[None, :] - 2 * (q @ rows.T)
        near[q_ids[at:at + 256, None] == ids[None, :]] = np.inf
        kk = min(k, near.shape[1]) - 1
        cut = np.partition(near, kk, axis=1)[:, kk]
        slack = 1e-9 * (1 + np.abs(norm).max() + (q ** 2).sum(1))
        for i in range(len(q)):
            c = np.flatnonzero((near[i] <= cut[i] + slack[i]) & (near[i] < np.inf))
            d = np.sqrt(((rows[c] - q[i]) ** 2).sum(1))
            order = np.lexsort((ids[c], d))[:k]
            yield at + i, ids[c][order], d[order]


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 12) -> np.ndarray:
    """A part for every row of ``x``, of at most (1 + slack) times the mean size."""
    part = np.zeros(len(x), dtype=np.int64)
    groups, label = [(np.arange(len(x)), parts)], 0
    while groups:
        rows, p = groups.pop()
        if p == 1 or len(rows) < 2:
            part[rows] = label
            label += 1
            continue
        c = x[rows] - x[rows].mean(0)
        v = np.linalg.eigh(c.T @ c)[1][:, -1]
        order, cut = rows[np.argsort(c @ v, kind="stable")], len(rows) * (p // 2) // p
        groups += [(order[:cut], p // 2), (order[cut:], p - p // 2)]
    most = int(np.ceil(len(x) / parts * (1 + slack)))
    back = np.argsort(graph.ravel(), kind="stable")
    source = np.repeat(np.arange(len(x)), graph.shape[1])[back]
    begin = np.searchsorted(graph.ravel()[back], np.arange(len(x) + 1))
    held = np.zeros((len(x), parts), dtype=np.int32)
    owner = np.repeat(np.arange(len(x)), np.diff(begin))
    for _ in range(rounds):
        held[:] = 0
        np.add.at(held, (np.arange(len(x))[:, None], part[graph]), 1)
        np.add.at(held, (owner, part[source]), 1)
        gain = held.max(1) - held[np.arange(len(x)), part]
        want = held.argmax(1)
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable")[:int((gain > 0).sum())].tolist():
            if size[want[i]] < most:
                size[part[i]] -= 1
                size[want[i]] += 1
                part[i] = want[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass(frozen=True)
class Router:
    """A network of one hidden layer; ``weights`` is empty for a single part."""
    mean: np.ndarray
    scale: float
    weights: tuple[np.ndarray, ...]
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros((len(x), 1))
        a, b, c, d = self.weights
        return np.maximum((x - self.mean) / self.scale @ a + b, 0) @ c + d


def train_router(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, batch: int = 512, rate: float = 3e-3) -> Router:
    """Fit the network to the shares of each vector's neighbours in the parts (cross-entropy, Adam)."""
    rng = np.random.default_rng(11)
    mean, scale = x.mean(0), float(x.std()) or 1.0
    z = (x - mean) / scale
    w = [rng.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, target.shape[1])), np.zeros(target.shape[1])]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    steps = epochs * -(-len(z) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), batch):
            i = order[at:at + batch]
            h = np.maximum(z[i] @ w[0] + w[1], 0)
            s = h @ w[2] + w[3]
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = (p - target[i]) / len(i)
            dh = (d @ w[2].T) * (h > 0)
            grads = [z[i].T @ dh, dh.sum(0), h.T @ d, d.sum(0)]
            t += 1
            lr = rate * (1 - (t - 1) / steps)
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                w[j] -= lr * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
    return Router(mean, scale, tuple(w), 1)


def _graph(data: Broadcast, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = data.value
        ids = np.arange(len(x))
        for b in batches:
            for first, last in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = [(first + i, found.tolist()) for i, found, _ in nearest(x[first:last], ids[first:last], x, ids, k)]
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["i", "near"])
    return run


def fit(base: DataFrame, n: int, sample: int = SAMPLE, rows_per_part: int = ROWS_PER_PART, max_parts: int = MAX_PARTS, aim: float = AIM) -> Router:
    """Learn the partitions of ``base (vec_id, vec)`` of ``n`` rows."""
    spark = base.sparkSession
    parts = min(max_parts, max(1, min(n, sample) // 64), max(1, n // rows_per_part))
    if parts == 1:
        return Router(np.zeros(1), 1.0, (), 1)
    # equal vectors teach nothing about where neighbours lie: one of each goes in the sample
    few = base.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < F.lit(int(min(1.0, 3 * sample / n) * (1 << 20)))) if n > 3 * sample else base
    rows = few.groupBy("vec").agg(F.min("vec_id").alias("vec_id")).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    x = np.array([r.vec for r in rows], dtype=np.float64)
    if len(x) < 2 * parts:
        return Router(np.zeros(1), 1.0, (), 1)
    data = spark.sparkContext.broadcast(x)  # at most `sample` vectors
    cuts = [(a, min(a + 512, len(x))) for a in range(0, len(x), 512)]
    k = min(GRAPH_K, len(x) - 1)
    got = spark.createDataFrame(cuts, "a int, b int").repartition(len(cuts)).mapInArrow(_graph(data, k), "i long, near array<long>").collect()
    graph = np.zeros((len(x), k), dtype=np.int64)
    for r in got:
        graph[r.i] = r.near
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x))[:, None], part[graph]), 1.0)
    target[np.arange(len(x)), part] += 1.0
    router = train_router(x, target / target.sum(1, keepdims=True))
    s = router.scores(x)
    placed = s.argmax(1)
    order = np.argsort(-s, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(rank, placed[graph], axis=1)  # the probe at which each neighbour is met
    recall = np.array([(needed <= p).mean() for p in range(parts)])
    return Router(router.mean, router.scale, router.weights, int(np.argmax(recall >= aim)) + 1)


def _place(router: Router, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            s = router.scores(_matrix(b.column(1), b.num_rows)) if router.weights else np.zeros((b.num_rows, 1))
            top = np.argsort(-s, axis=1, kind="stable")[:, :probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(top.tolist(), pa.list_(pa.int32()))], ["vec_id", "vec", "parts"])
    return run


def _rank(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            q_ids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            q, x = _matrix(left["vec"], left.num_rows), _matrix(right["vec"], right.num_rows)
            for i, found, d in nearest(q, q_ids, x, ids, k):
                out[0] += [int(q_ids[i])] * len(found)
                out[1] += found.tolist()
                out[2] += d.tolist()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})
    return run


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, vec)`` of the rows that take part."""
    v = F.col("vec")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    # null components are tested first: comparisons with null would drop or keep by accident
    fine = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & F.exists(v, lambda x: x != 0))
    length = fine.groupBy(F.size("vec").alias("n")).count().agg(F.max(F.struct("count", "n")).getField("n").alias("n")).first()
    return fine.where(F.size("vec") == (length.n if length and length.n else 0))


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, probes: int | None = None,
           block: int = BLOCK, query_block: int = QUERY_BLOCK, **fitting) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest rows found for the rows of ``df`` for which
    ``is_query`` (on ``vec_id``) holds."""
    base = materialize(valid_vectors(df, id_col, vec_col), "vectors")
    n = base.count()
    if not base.groupBy("vec_id").count().where("count > 1").isEmpty():
        base = materialize(base.groupBy("vec_id").agg(F.min("vec").alias("vec")), "vectors")
        n = base.count()
    router = fit(base, n, **fitting)
    p = probes or router.probes
    schema = "vec_id long, vec array<double>, parts array<int>"
    placed = materialize(base.mapInArrow(_place(router, 1), schema).select("vec_id", "vec", F.col("parts")[0].alias("part")), "placed")
    asked = materialize(base.where(is_query).mapInArrow(_place(router, p), schema).select("vec_id", "vec", F.explode("parts").alias("part")), "asked")
    # at most one row a part
    sizes = F.broadcast(placed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")))
    loads = F.broadcast(asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("loads")))
    both = sizes.join(loads, "part")
    x = (placed.join(F.broadcast(both), "part").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
         .withColumn("load", F.explode(F.sequence(F.lit(0), F.col("loads") - 1))).select("part", "block", "load", "vec_id", "vec"))
    q = (asked.join(F.broadcast(both), "part").withColumn("load", F.pmod(F.xxhash64("vec_id"), F.col("loads")).cast("int"))
         .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("part", "block", "load", "vec_id", "vec"))
    keys = ["part", "block", "load"]
    got = q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInArrow(_rank(k), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
