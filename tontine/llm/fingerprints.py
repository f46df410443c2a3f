"""Document fingerprints by winnowing, in DataFrame expressions only.

A text is the sequence of its words (runs without blank and \\x09-\\x0D). Every run of ``k`` words
gets a polynomial hash modulo 2**31; the hashes roll by doubling (the hash of 2m words from two
hashes of m), so each position costs about log2(k) steps whatever ``k``. In every window of ``w``
consecutive k-grams the smallest hash is chosen, of ties the rightmost; the chosen positions, once
each, are the fingerprint. A mark keeps its word position and the first 16 hex digits of the md5
of its k words, so marks can be compared without their texts.

Guarantees: two texts that share ``k + w - 1`` consecutive words share a mark; no mark comes from
less than ``k`` equal words (but for texts shorter than that). Equal texts have equal marks.

A text goes through in segments of ``SEGMENT`` windows, so the arrays that a step builds do not
grow with the text, and the marks are those of the whole text.

Defined results: null counts as empty; a text without words has no marks; one of fewer than ``k``
words has one mark, all its words at position 0; one of fewer than ``w`` k-grams has one window.
Two fingerprints without marks are alike (1.0), one with and one without are not (0.0). Repeated
rows are documents of their own, equal ids ordered by a hash of the text; a null id comes first;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine.llm.common import materialize

K, W = 5, 8
SEGMENT = 8192  # windows
BASE = 1103515245
_MASK = (1 << 31) - 1
_LOW = (1 << 32) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \t\n\x0b\x0c\r]+"), "")


def _ahead(x: Column, n: int) -> Column:
    return F.slice(x, F.lit(n + 1), F.size(x))


def _word_hash(word: Column) -> Column:
    return F.conv(F.substring(F.md5(word.cast("binary")), 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(_MASK))


def rolled(hashes: Column, k: int, then: Callable[[Column], Column]) -> Column:
    """``then`` of the polynomial hashes of every ``k`` consecutive elements (null where fewer follow)."""
    def join(left: Column, right: Column, at: int, size: int) -> Column:
        factor = F.lit(pow(BASE, size, 1 << 31))
        return F.zip_with(left, _ahead(right, at), lambda x, y: (x * factor + y).bitwiseAND(F.lit(_MASK)))

    def grow(power: Column, size: int, done: Column | None, length: int) -> Column:
        def on(d: Column | None, n: int) -> Column:
            if 2 * size > k:
                return then(d)
            return let(join(power, power, size, size), lambda p: grow(p, 2 * size, d, n))
        if not k & size:
            return on(done, length)
        return on(power, size) if done is None else let(join(done, power, length, size), lambda d: on(d, length + size))
    return grow(hashes, 1, None, 0)


def window_minima(values: Column, w: int, then: Callable[[Column], Column]) -> Column:
    """``then`` of the smallest of every ``w`` consecutive values (of those that there are)."""
    def both(x: Column, at: int) -> Column:
        return F.zip_with(x, _ahead(x, at), lambda a, b: F.least(a, b))

    def grow(x: Column, size: int) -> Column:
        if 2 * size <= w:
            return let(both(x, size), lambda y: grow(y, 2 * size))
        return then(both(x, w - size) if w > size else x)
    return grow(values, 1)


def _chosen(hashes: Column, k: int, w: int) -> Column:
    """Positions in ``hashes`` of the k-grams that its windows choose, ascending."""
    def select(grams: Column) -> Column:
        n = F.size(hashes) - (k - 1)
        order = F.transform(F.slice(grams, F.lit(1), n), lambda h, i: F.shiftleft(h, 32) + (F.lit(_LOW) - i))
        return let(order, lambda o: window_minima(o, w, lambda m: F.transform(
            F.array_distinct(F.slice(m, F.lit(1), F.greatest(F.lit(1), n - (w - 1)))),
            lambda x: F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW)))))
    return rolled(hashes, k, select)


def winnow(text: Column, k: int = K, w: int = W, segment: int = SEGMENT) -> Column:
    """The marks of ``text``: ``array<struct<pos: long, hash: string>>`` in order of position."""
    def whole(ws: Column) -> Column:
        n = F.size(ws)
        last = F.greatest(F.lit(0), F.floor((n - (k + w - 1)) / F.lit(segment)).cast("int"))

        def piece(s: Column) -> Column:
            hashes = F.transform(F.slice(ws, s * segment + 1, F.lit(segment + k + w - 2)), _word_hash)
            return let(hashes, lambda h: F.transform(_chosen(h, k, w), lambda p: p + s * segment))
        at = F.when(n >= k, F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), last), piece)))).otherwise(
            F.when(n > 0, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<bigint>")))
        return F.transform(at, lambda p: F.struct(
            p.alias("pos"), F.substring(F.md5(F.array_join(F.slice(ws, p.cast("int") + 1, F.lit(k)), " ").cast("binary")), 1, 16).alias("hash")))
    return let(words(text), whole)


def as_text(marks: Column) -> Column:
    """``pos:hash`` of every mark, comma-joined."""
    return F.array_join(F.transform(marks, lambda m: F.concat_ws(":", m["pos"].cast("string"), m["hash"])), ",")


def likeness(a: Column, b: Column) -> Column:
    """Share of the two fingerprints' distinct hashes that both hold (0 to 1)."""
    x, y = a["hash"], b["hash"]
    every = F.size(F.array_union(x, y))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / every).cast("double")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``(doc_id, marks)``, one row per row of ``docs``; no shuffle."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), winnow(F.col(text_col).cast("string"), k, w).alias("marks"))


def with_following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W, parts: int | None = None) -> DataFrame:
    """``(doc_id, text, marks, next_text, next_marks)``: every document beside the next one by id,
    the last beside the first.

    Documents are dealt into ``parts`` ranges of ids whose bounds come from a range sort of the ids
    alone; the first row of a range also goes to the end of the range before it, so one shuffle
    of the texts by range suffices and no window spans more than a range.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 4 * n
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.struct("doc_id", F.xxhash64("text").alias("tie"))
    first = (src.select(key.alias("key")).repartitionByRange(parts, "key").groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
             .agg(F.array_sort(F.collect_list("key")).alias("firsts")))  # `parts` keys at most, in one row
    bits = range((parts + 1).bit_length(), -1, -1)
    rows = src.withColumn("key", key).crossJoin(F.broadcast(materialize(first, "ranges")))  # one row
    found = F.aggregate(F.array(*[F.lit(1 << b) for b in bits]), F.lit(0), lambda at, step: F.when(F.get("firsts", at + step - 1) <= F.col("key"), at + step).otherwise(at))
    rows = rows.withColumn("range", found)
    before = F.when(F.col("range") == 1, F.size("firsts")).otherwise(F.col("range") - 1)
    own = F.struct(F.col("range").alias("at"), F.lit(False).alias("extra"))
    leads = F.get("firsts", F.col("range") - 1) == F.col("key")
    places = F.when(leads, F.array(own, F.struct(before.alias("at"), F.lit(True).alias("extra")))).otherwise(F.array(own))
    rows = rows.select("doc_id", "text", F.col("key.tie").alias("tie"), F.inline(places))
    rows = rows.repartition(n, "at").withColumn("marks", winnow(F.col("text"), k, w))
    order = Window.partitionBy("at").orderBy("extra", "doc_id", "tie")
    return (rows.withColumns({"next_text": F.lead("text").over(order), "next_marks": F.lead("marks").over(order)})
            .where("not extra").select("doc_id", "text", "marks", "next_text", "next_marks"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every document and of its edited text, the second half of its code points
    replaced by as many first ones of the next document: ``(doc_id, n_chars, edited, marks,
    edited_marks, near_edited, near_next)``."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_following(docs, id_col, text_col, k, w).withColumn("n_chars", F.length("text"))
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    rows = rows.withColumn("edited_marks", winnow(F.col("edited"), k, w))
    return rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited", "marks", "edited_marks",
                       likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"), likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))
