"""Ranked lexical search by pipelined term partitioning.

``index`` writes the forward table of the documents (row, id, length, terms and counts).
``search`` deals the terms of the queries to ``OWNERS`` term owners, the heaviest terms first, each
owner with about as many postings. Documents are hashed into blocks. A query's bundle for a block
carries a sparse accumulator, documents and integer scores; it passes through the owners one after
the other. At each, bundles and that owner's postings of the block meet in a cogroup, and the
owner's integer contributions are added. After the last owner the best documents are selected.

Between the stages an accumulator drops the documents that cannot come back among the block's
best ``top``: those whose score and the sum of what all later owners can add at most stay below
the block's ``top``-th score so far. Once the later owners cannot reach that score at all, the
bundle takes no new documents. Both are exact; ties stay. Nothing else is left out.

A group holds the postings of one owner for ``BLOCK_ROWS`` documents or so and at most about
``GROUP_ITEMS`` bundles, however common a term or large the tables. Statistics of the terms come
from partial aggregates. The terms of the queries meet the forward table in an ordinary join,
whose strategy Spark chooses by their written size.

Score of a document: the sum over the query's distinct terms of ``w * (10^9 tf div (1000 tf + 8 m))``
with ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, ``m = 10 + (90 n N) div L``.

Defined results: null and empty texts have no terms, are not counted in N and are never found; a
query without terms gets no rows; repeated rows of documents or queries are rows of their own;
equal scores come in ascending id (null first), equal ids in the order of reading; extra columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tontine.llm.common import materialize, range_prefix, tidied

TOP, OWNERS = 10, 4
BLOCK_ROWS, GROUP_ITEMS = 2048, 128
_BATCH = 512

#: Bytes of terms: 0-9, a-z (A-Z lower-cased) and all of non-ASCII characters; every other one parts terms.
_TABLE = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split(b" ") if text else []


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, _BATCH):
            part = b.slice(at, _BATCH)
            n, offs, terms, tfs = [], [0], [], []
            for text in part.column(2):
                c = Counter(terms_of(text.as_py()))
                c.pop(b"", None)
                terms += c.keys()
                tfs += c.values()
                n.append(sum(c.values()))
                offs.append(len(terms))
            offs = pa.array(offs, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offs, pa.array(terms, pa.binary()).cast(pa.string())),
                 pa.ListArray.from_arrays(offs, pa.array(tfs, pa.int64()))], ["row", "id", "n", "terms", "tfs"])


def index(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, id, n, terms, tfs)`` of every row of ``rows``, written."""
    src = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialize(src.mapInArrow(tidied(_count), "row long, id long, n long, terms array<string>, tfs array<long>"), "forward")


def _weighted(forward: DataFrame, wanted: DataFrame, owners: int, n_docs: int, n_terms: int) -> DataFrame:
    """``(term, tid, w, owner, most)`` of the wanted terms that documents hold: weight, owner and
    the most that one document can get from the term."""
    held = forward.where("n > 0").select("n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("n", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))
    stats = held.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("tf"), F.min("n").alias("n"))
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    stats = materialize(stats.withColumn("w", w).where("w > 0"), "terms")
    parts = max(1, int(forward.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    ranked = range_prefix(stats.withColumn("light", -F.col("w")), ["light", "term"], "df", "upto", parts, "owners", rank="tid")
    total = stats.agg(F.sum("df").alias("total"))
    owner = F.least(F.lit(owners - 1), F.floor(F.lit(owners) * (F.col("upto") - F.col("df")) / F.col("total")).cast("int"))
    return materialize(ranked.crossJoin(F.broadcast(total))  # one row
                       .select("term", "tid", "w", owner.alias("owner"), _contribution(n_docs, n_terms).alias("most")), "weights")


def _contribution(n_docs: int, n_terms: int):
    return F.expr(f"w * ((1000000000L * tf) div (1000L * tf + 8L * (10L + (90L * n * {n_docs}L) div {max(1, n_terms)}L)))")


def add_postings(bundles: pa.Table, postings: pa.Table, top: int) -> pa.Table:
    """One owner's turn with the bundles of a block: contributions of each bundle's terms are added
    to its accumulator, which is then cut to what can still be among the best ``top``."""
    tid, row, gain = (postings[c].to_numpy() for c in ("tid", "row", "gain"))
    order = np.argsort(tid, kind="stable")
    tid, gain = tid[order], gain[order]
    universe, place = np.unique(row[order], return_inverse=True)
    rows_out, scores_out, closed_out = [], [], []
    for terms, rest, rows, scores, closed in zip(bundles["terms"], bundles["rest"].to_pylist(), bundles["rows"], bundles["scores"], bundles["closed"].to_pylist()):
        rows, scores = (x.values.to_numpy(zero_copy_only=False) for x in (rows, scores))
        mine = np.zeros(len(universe), dtype=np.int64)
        for t in terms.as_py() or ():
            a, b = np.searchsorted(tid, [t, t + 1])
            mine[place[a:b]] += gain[a:b]  # a document stands once in a term's postings
        scores = scores.copy()
        if len(rows) and len(universe):
            at = np.minimum(np.searchsorted(universe, rows), len(universe) - 1)
            known = universe[at] == rows
            scores[known] += mine[at[known]]
            mine[at[known]] = 0
        if not closed:
            new = np.flatnonzero(mine)
            rows, scores = np.concatenate([rows, universe[new]]), np.concatenate([scores, mine[new]])
        if len(scores) >= top:
            least = int(np.partition(scores, len(scores) - top)[len(scores) - top])
            keep = scores + rest >= least
            rows, scores = rows[keep], scores[keep]
            closed = closed or rest < least
        rows_out.append(rows)
        scores_out.append(scores)
        closed_out.append(closed)
    offs = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in rows_out])]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offs, pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())) for x in (rows_out, scores_out)]
    return pa.table([*(bundles[c].combine_chunks() for c in ("team", "block", "item")), *lists, pa.array(closed_out, pa.bool_())], names=["team", "block", "item", "rows", "scores", "closed"])


def _turn(top: int):
    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        return add_postings(bundles, postings, top)
    return run


def search(forward: DataFrame, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", top: int = TOP, owners: int = OWNERS,
           block_rows: int = BLOCK_ROWS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of ``index`` for every query."""
    spark = forward.sparkSession
    n_rows, n_docs, n_terms = forward.agg(F.count(F.lit(1)), F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    items = index(queries, id_col, text_col)
    blocks, teams = max(1, -(-n_rows // block_rows)), max(1, -(-items.count() // group_items))
    asked = items.select(F.col("row").alias("item"), F.pmod(F.xxhash64("row"), F.lit(teams)).cast("int").alias("team"), F.explode("terms").alias("term"))
    weights = _weighted(forward, asked.select("term").distinct(), owners, n_docs, n_terms)

    # what each query asks of each owner, and the most that the later ones can add
    plan = asked.join(weights, "term").groupBy("item", "team", "owner").agg(F.collect_list("tid").alias("terms"), F.sum("most").alias("most"))
    every = plan.select("item", "team").distinct().withColumn("owner", F.explode(F.sequence(F.lit(0), F.lit(owners - 1))))
    later = Window.partitionBy("item").orderBy("owner").rowsBetween(1, Window.unboundedFollowing)  # `owners` rows
    plan = materialize(every.join(plan, ["item", "team", "owner"], "left").withColumn("rest", F.coalesce(F.sum("most").over(later), F.lit(0))).drop("most"), "plan")

    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    held = forward.where("n > 0").select("row", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    held = held.select("row", "n", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf")).join(weights, "term")
    postings = materialize(held.select("owner", block.alias("block"), "row", "tid", _contribution(n_docs, n_terms).alias("gain")), "postings", by=["owner"])

    none = F.array().cast("array<bigint>")
    bundles = (plan.where("owner = 0").select("item", "team").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
               .select("team", "block", "item", none.alias("rows"), none.alias("scores"), F.lit(False).alias("closed")))
    for owner in range(owners):
        left = bundles.join(plan.where(F.col("owner") == owner).select("item", "terms", "rest"), "item")
        right = postings.where(F.col("owner") == owner).select(F.explode(F.sequence(F.lit(0), F.lit(teams - 1))).alias("team"), "block", "row", "tid", "gain")
        met = left.groupBy("team", "block").cogroup(right.groupBy("team", "block"))
        bundles = materialize(met.applyInArrow(_turn(top), "team int, block int, item long, rows array<long>, scores array<long>, closed boolean"), f"owner-{owner}")

    found = bundles.select("item", F.explode(F.arrays_zip("rows", "scores")).alias("x")).select("item", F.col("x.rows").alias("row"), F.col("x.scores").alias("score")).where("score > 0")
    found = found.join(forward.select("row", F.col("id").alias("doc_id")), "row")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(items.select(F.col("row").alias("item"), F.col("id").alias("item_id")), "item").select("item_id", "rank", "doc_id", "score")
