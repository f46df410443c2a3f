"""Join helpers with explicit size checks.

Assumption/dimension tables are broadcast only after a count proves them small, in rows and in
bytes; above the bound the plain DataFrame is returned and Spark plans a shuffle join (AQE may
still convert it at run time from measured stage sizes, and splits skewed partitions). Counts are
memoized per session and semantically equal plan until the next valuation is built
(``forget_counts``), so a table is counted once however often it is joined, and rewritten inputs
are counted anew.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.params import ValuationParams

_PLANS: weakref.WeakKeyDictionary[SparkSession, dict[int, list[tuple[DataFrame, int]]]] = weakref.WeakKeyDictionary()
_KEYED: weakref.WeakKeyDictionary[SparkSession, dict[tuple, int]] = weakref.WeakKeyDictionary()


def forget_counts(spark: SparkSession) -> None:
    """Drop the memoized counts of ``spark``."""
    _PLANS.pop(spark, None)
    _KEYED.pop(spark, None)


def row_count(df: DataFrame, key: tuple | None = None) -> int:
    """count(df), memoized per session by semantic plan equality, or by ``key`` (e.g. an operator
    name plus the semantic hashes of its inputs) for plans whose own hash is not stable (scalar
    subqueries)."""
    if key is not None:
        known = _KEYED.setdefault(df.sparkSession, {})
        if key not in known:
            known[key] = df.count()
        return known[key]
    same = _PLANS.setdefault(df.sparkSession, {}).setdefault(df.semanticHash(), [])
    for other, n in same:
        if other.sameSemantics(df):
            return n
    same.append((df, df.count()))
    return same[-1][1]


def row_bytes(df: DataFrame) -> int:
    """Spark's own estimate of one row of the schema."""
    return df._jdf.schema().defaultSize()


def bounded_broadcast(df: DataFrame, max_rows: int, key: tuple | None = None,
                      max_bytes: int = ValuationParams.broadcast_max_bytes) -> DataFrame:
    """``broadcast(df)`` when ``df`` is within both bounds, else ``df`` (shuffle join)."""
    n = row_count(df, key)
    return F.broadcast(df) if n <= max_rows and n * row_bytes(df) <= max_bytes else df


def plan_key(*dfs: DataFrame) -> tuple:
    return tuple(d.semanticHash() for d in dfs)


def fan_out(df: DataFrame, dim: DataFrame, max_rows: int) -> DataFrame:
    """Attach every row of a dimension table (scenarios, curve versions) to every row of ``df``:
    |df| x |dim| rows, as the valuation defines them. A small dimension is broadcast, with no
    shuffle of ``df``; a larger one is dealt into parts of about ``max_rows`` rows, ``df`` is
    copied once a part and the two meet in an equi-join on the part."""
    n = row_count(dim)
    if n <= max_rows and n * row_bytes(dim) <= ValuationParams.broadcast_max_bytes:
        return df.crossJoin(F.broadcast(dim))
    parts = -(-n // max_rows)
    # the salt spreads the copies of df, which all hold the same parts, over many tasks
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = (df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
            .withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    right = (dim.withColumn("__part", F.pmod(F.xxhash64(*dim.columns), F.lit(parts)).cast("int"))
             .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    return left.join(right, ["__part", "__salt"], "inner").drop("__part", "__salt")


KEY_BUCKETS = 4096


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))


def hot_buckets(df: DataFrame, key: str, parts: int, least: int = 10_000) -> dict[int, int]:
    """``{bucket: pieces}`` of the hash buckets of ``key`` that hold over twice the rows that a task
    of ``parts`` gets (``least`` at least): into how many pieces they are cut. One exact count
    per bucket, summed map-side."""
    n = dict(df.where(F.col(key).isNotNull()).groupBy(_bucket(F.col(key))).count().collect())  # KEY_BUCKETS rows at most
    share = max(least, -(-sum(n.values()) // parts))
    return {b: -(-c // share) for b, c in n.items() if c > 2 * share}


def dealt_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, pieces: dict[int, int] | None = None,
               parts: int | None = None) -> DataFrame:
    """Inner join on the keys that shuffles ``left`` once at most. ``parts`` tasks get its rows, whether
    Spark shuffles or broadcasts ``right``; without ``parts`` Spark decides. Buckets in ``pieces``
    (``hot_buckets`` of ``left``) are spread over their pieces, to each of which ``right``'s rows of the bucket are copied."""
    left, on, by = left.where(F.col(left_key).isNotNull()), F.col(left_key) == F.col(right_key), [left_key]
    if pieces:
        n = F.create_map(*[F.lit(x) for b, k in pieces.items() for x in (b, k)])
        of = lambda key: F.coalesce(F.try_element_at(n, _bucket(key).cast("int")), F.lit(1)).cast("long")
        left = left.withColumn("__piece", F.pmod(F.xxhash64(*left.columns), of(F.col(left_key))))
        key = F.col(right_key).cast(left.schema[left_key].dataType)  # equal keys, equal hashes
        right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), of(key) - 1)))
        on, by = on & (F.col("__piece") == F.col("__copy")), [left_key, "__piece"]
    return (left.repartition(parts, *by) if parts else left).join(right, on, "inner").drop("__piece", "__copy")


def materialized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """For a small table derived from the data (rates per pricing key, unit factors per risk
    cell): write it to the checkpoint folder, count it, and broadcast it when it is within the
    bound, so the large side of the join is streamed and never shuffled."""
    from tontine.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    df.persist()
    mat = df.checkpoint(eager=True)
    df.unpersist()
    return bounded_broadcast(mat, max_rows)
