"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled by a hash of their id and queued, epoch after epoch (two by
default). A queued document's virtual finish time is the words of its source up to and including
it, divided by the source's target. All queues are range-sorted by finish time and cut where the
running words reach the total budget, so each source ends within about one document of its target.

The running sums are two-level (hash buckets within a source, partitions of the range sort), so
the hottest source never meets in one task. Targets: the budget shared by weight, where a
source stops at ``epochs`` times its size and its excess is reshared among the others.

Defined results: null texts have size 0; null is a source, the last; repeated rows are queued as
rows of their own; a source of size 0 has target 0 and takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine.llm.common import materialize, range_prefix

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2
BUCKET_ROWS = 10_000


def n_words(text: Column) -> Column:
    """Number of words between white space (blank and \\x09-\\x0D); null has none."""
    flat = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    gaps = F.size(F.split(flat, " +"))
    return F.when(F.coalesce(F.length(flat), F.lit(0)) == 0, F.lit(0)).otherwise(gaps).cast("long")


def shuffle_key_of(key: Column) -> Column:
    """60 bits of md5 of an id: the same order in every run and engine."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def shuffle_key(id_col: str) -> Column:
    return shuffle_key_of(F.col(id_col))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size)`` -> plus ``weight, target``: one row per source.

    Sources ordered by the level at which they stop (limit / weight): when the first k stop, the
    level of the others is (budget - their limits) / (weight of the others); the water level is
    the first of these below the next source's stop. Ranks and sums come from range sorts.
    """
    parts = max(1, int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    s = sizes.withColumns({"__null": F.col("source").isNull(), "__one": F.lit(1)})
    s = range_prefix(s, ["__null", "source"], "__one", "__n", parts, "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("__n") - 1, F.lit(len(weights))).cast("int") + 1)
    s = s.withColumn("weight", weight).withColumn("__limit", F.col("source_size") * float(epochs)).withColumn("__stop", F.col("__limit") / F.col("weight"))
    s = range_prefix(s, ["__stop", "__n"], "__limit", "__limits", parts, "stops")
    s = range_prefix(s, ["__stop", "__n"], "weight", "__weights", parts, "weights")
    total = s.agg((F.sum("source_size") * share).alias("__budget"), F.sum("weight").alias("__all"))
    s = s.crossJoin(F.broadcast(total))  # one row
    # level with exactly the sources before this one stopped
    level = (F.col("__budget") - (F.col("__limits") - F.col("__limit"))) / (F.col("__all") - (F.col("__weights") - F.col("weight")))
    s = s.withColumn("__level", level)
    lam = s.where("__level <= __stop").agg(F.min(F.struct("__stop", "__n", "__level")).getField("__level").alias("__lambda"))
    s = s.crossJoin(F.broadcast(lam))  # one row
    target = F.when(F.col("__lambda").isNull(), F.col("__limit")).otherwise(F.least("__limit", F.col("weight") * F.col("__lambda")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken, __row)``, one row per row of
    ``docs``: how often the mix takes the document, and the words that makes."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      n_words(F.col(text_col).cast("string")).alias("size"))
    rows = materialize(src.withColumn("__row", F.monotonically_increasing_id()), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__docs"))
    goal = materialize(targets(sums.drop("__docs"), weights, share, epochs), "targets")
    rows = rows.withColumn("__hash", shuffle_key("doc_id"))
    n_buckets = 1 << max(8, (max(1, rows.count()) // BUCKET_ROWS).bit_length())
    rows = rows.withColumn("__bucket", F.shiftright("__hash", 60 - n_buckets.bit_length() + 1))

    bucket = rows.groupBy("source", "__bucket").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = bucket.select(F.col("source").alias("__s"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("source", "__bucket").orderBy("__hash", "doc_id", "size", "__row").rowsBetween(Window.unboundedPreceding, 0)
    cum = rows.withColumn("__cum", F.sum("size").over(inside)).join(
        base, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b"))).drop("__s", "__b")
    g = goal.select(F.col("source").alias("__s"), "source_size", "target")
    cum = cum.join(g, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")

    queue = (cum.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
             .withColumn("__words", F.col("__cum") + F.col("__base") + F.col("__epoch") * F.col("source_size"))
             .withColumn("__finish", F.when(F.col("target") > 0, F.col("__words") / F.col("target")).otherwise(F.lit(float("inf"))))
             .select("doc_id", "source", "size", "source_size", "target", "__row", "__epoch", "__hash", "__finish"))
    queue = range_prefix(queue, ["__finish", "__hash", "doc_id", "size", "__row", "__epoch"], "size", "__total", parts, "queue")
    budget = goal.agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("__budget"))
    taken = F.col("__total") <= F.col("__budget") + F.lit(1e-6) * F.greatest(F.lit(1.0), F.col("__budget") * 1e-6)
    got = queue.crossJoin(F.broadcast(budget))  # one row
    return (got.groupBy("__row", "doc_id", "source", "size", "source_size", "target")
            .agg(F.sum(taken.cast("long")).alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def cutoffs(plan: DataFrame) -> DataFrame:
    """``plan_mix`` -> ``(source, copies, cut)``: in a source's queue, by (hash, id, size), the number of
    copies only falls; ``cut`` is the last row that still gets ``copies``. One row per source and epoch."""
    at = plan.where("copies > 0").select("source", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copies"), shuffle_key("doc_id").alias("hash"), "doc_id", "size")
    last = at.groupBy("source", "copies").agg(F.max(F.struct("hash", "doc_id", "size")).alias("last"))
    return last.select("source", "copies", F.col("last").alias("cut"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = EPOCHS, **params) -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as planned.

    Within a source the taken rows are a prefix of its queue, one prefix an epoch, so the last row
    of each prefix decides every document in the scan; texts are not shuffled. Rows that tie with
    such a last row (one id and size) may not all be taken: these few ids, one per source and epoch
    at most, are told apart by their order."""
    plan = materialize(plan_mix(docs, id_col, text_col, source_col, epochs=epochs, **params), "mix")
    cuts = cutoffs(plan)
    # one row per source: the cut of every epoch, and the ids whose rows get different numbers
    cuts = cuts.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("copies", "cut"))).alias("cuts"))
    split = (plan.groupBy("source", "doc_id", "size").agg(F.min("copies").alias("lo"), F.max("copies").alias("hi")).where("lo < hi")
             .groupBy("source").agg(F.collect_list(F.struct("doc_id", "size")).alias("split")))
    bounds = materialize(cuts.join(split, cuts["source"].eqNullSafe(split["source"]), "left").select(cuts["source"].alias("__source"), "cuts", "split"), "cutoffs")

    names = docs.columns
    key = F.col(id_col).cast("long")
    size = n_words(F.col(text_col).cast("string"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__doc"), F.struct(shuffle_key_of(key).alias("hash"), key.alias("doc_id"), size.alias("size")).alias("__key"),
                       F.col(source_col).cast("string").alias("__src"))
    rows = rows.join(bounds, F.col("__src").eqNullSafe(F.col("__source")))
    mine = F.struct(F.col("__key.doc_id").alias("doc_id"), F.col("__key.size").alias("size"))
    tied = F.coalesce(F.exists("split", lambda x: x.eqNullSafe(mine)), F.lit(False))
    copies = F.size(F.filter("cuts", lambda c: F.col("__key") <= c["cut"]))
    out = rows.where(~tied).select("__doc", F.explode(F.array_repeat(F.lit(1), copies))).select("__doc.*")
    ties = plan.join(bounds, plan["source"].eqNullSafe(F.col("__source"))).where(F.exists("split", lambda x: x.eqNullSafe(F.struct("doc_id", "size"))))
    if ties.isEmpty():
        return out
    order = Window.partitionBy("__src", "__key.doc_id", "__key.size")
    left = rows.where(tied).drop("cuts", "split", "__source").withColumn("__k", F.row_number().over(order.orderBy(F.xxhash64("__doc"))))
    right = ties.select("source", "doc_id", F.col("size").alias("s"), "copies", F.row_number().over(Window.partitionBy("source", "doc_id", "size").orderBy("__row")).alias("k"))
    extra = left.join(right, left["__src"].eqNullSafe(right["source"]) & left["__key.doc_id"].eqNullSafe(right["doc_id"]) & (left["__key.size"] == right["s"]) & (left["__k"] == right["k"]))
    return out.unionByName(extra.select("__doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("__doc.*"))
