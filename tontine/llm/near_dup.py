"""MinHash near-duplicates with circulant signatures, banding and exact verification.

Signature: the 64-bit shingle hashes go through a first permutation (an invertible mixer); a
second permutation of the 32-bit circle is shifted circularly by k = 0, 1, .. to give coordinate
k, the smallest image of the document's shingles. Two permutations thus give all coordinates.
Bands of ``rows`` coordinates are hashed; documents that share a band hash are candidates and
are confirmed on their full shingle sets. With 42 bands of 5, a pair at exactly 0.75 is missed
with probability (1 - 0.75**5)**42, about 1e-5; above that, less.

Documents with equal shingle sets form a class that one representative stands for. In a bucket
every representative is first checked against the bucket's smallest one; what that links forms
components. Buckets that still hold several components are compared in blocks of bounded size, a
block's common shingles counted by one matrix product, and only pairs across components that
reach the threshold come out, so no bucket ever emits all its pairs.

Defined results: no words, or null text: no shingles, linked with nothing; rows of one doc_id
are one node; rows without doc_id get component null and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import materialize, tidied
from tontine.llm.components import connected_components
from tontine.llm.row_marks import FILE, POS, on_files, pick, placed, write_marks
from tontine.llm.words import U, mix, shingles

SHINGLE, BANDS, ROWS = 5, 42, 5
NUM, DEN = 75, 100  # linked: DEN * |A & B| >= NUM * |A | B|
_BLOCK = 1 << 16
BLOCK_ROWS, BLOCK_ITEMS = 2048, 4_000_000  # of one block of a bucket


def circulant_signature(items: np.ndarray, k: int) -> np.ndarray:
    """``k`` coordinates, each the minimum of the second permutation, shifted by the coordinate's
    number, over the first permutation's images of ``items``."""
    x = (mix(items ^ U(0x5851F42D4C957F2D)) >> U(32)).astype(np.uint32)
    out = np.empty(k, dtype=np.uint32)
    if len(x) > _BLOCK:  # a long document goes through in pieces
        out[:] = np.iinfo(np.uint32).max
        for at in range(0, len(items), _BLOCK):
            np.minimum(out, circulant_signature(items[at:at + _BLOCK], k), out=out)
        return out
    step = max(1, _BLOCK // max(1, len(x)))
    for at in range(0, k, step):
        shift = np.arange(at, min(k, at + step), dtype=np.uint32)[:, None]
        v = x[None, :] - shift
        t = v >> np.uint32(16)
        v ^= t
        v *= np.uint32(0x7FEB352D)
        np.right_shift(v, np.uint32(15), out=t)
        v ^= t
        v *= np.uint32(0x846CA68B)
        out[at:at + step] = v.min(axis=1)
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.arange(1, bands + 1, dtype=U) * U(0xA0761D6478BD642F)
    for r in range(rows):
        h = mix(h * U(0xE7037ED1A0B428DB) + sig.reshape(bands, rows)[:, r].astype(U))
    return h.view(np.int64)


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def _fingerprints(shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, k1, k2, hs = [], [], [], []
            for text in _texts(b.column(1)):
                s = shingles(text, shingle)
                n.append(len(s))
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64)
                k1.append(d[0])
                k2.append(d[1])
                hs.append(band_hashes(circulant_signature(s, bands * rows), bands, rows) if len(s) else np.zeros(0, np.int64))
            offs = np.concatenate([[0], np.cumsum([len(h) for h in hs])]).astype(np.int32)
            flat = np.concatenate(hs) if hs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offs), pa.array(flat)), b.column(2), b.column(3)], ["id", "n", "k1", "k2", "bands", FILE, POS])
    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, shingle) for t in _texts(b.column(1))]
            short = [np.unique((x >> U(32)).astype(np.uint32)).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array(short, pa.binary())], ["id", "items", "short"])
    return run


def _confirm(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                x, y = np.frombuffer(x.as_py(), dtype=U), np.frombuffer(y.as_py(), dtype=U)
                if den * min(len(x), len(y)) < num * max(len(x), len(y)):
                    continue
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = den * common >= num * (len(both) - common)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], ["a", "b"])
    return run


def cross_pairs(sets: list[np.ndarray], whole: np.ndarray, comp: np.ndarray, left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
    """Index pairs (i < j) of different components and sides whose sets can be similar enough.
    ``left`` and ``right`` mark the sides that a set belongs to (both, within one block). The sets
    hold short hashes; ``whole`` are the sizes of the full ones. Two sets have at most as many
    common shingles as common short hashes and the fewer of those that either lost to equal short
    hashes, so no pair is missed; the full sets decide later."""
    n = len(sets)
    size = np.array([len(x) for x in sets])
    owner, item = np.repeat(np.arange(n), size), np.concatenate(sets)
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    new = np.concatenate([[True], item[1:] != item[:-1]])
    column = np.cumsum(new) - 1
    held = np.bincount(column)
    keep = held[column] > 1  # what one set holds is common to no pair
    owner, column = owner[keep], np.unique(column[keep], return_inverse=True)[1]
    common = np.zeros((n, n), dtype=np.float32)
    columns = int(column[-1]) + 1 if len(column) else 0
    width = max(1, min(columns, max(256, (1 << 23) // n)))
    for at in range(0, columns, width):
        a, b = np.searchsorted(column, [at, at + width])
        x = np.zeros((n, width), dtype=np.float32)
        x[owner[a:b], column[a:b] - at] = 1
        common += x @ x.T
    lost = whole - size
    most = common.astype(np.int64) + np.minimum(lost[:, None], lost[None, :])
    fits = den * most >= num * (whole[:, None] + whole[None, :] - most)
    sides = (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    return np.argwhere(np.triu(fits & sides & (comp[:, None] != comp[None, :]), 1))


def _blocks(num: int, den: int):
    """Rows sorted by (h, lo, hi) -> the similar pairs of each block, a run of equal keys."""
    def pairs(run: list[pa.RecordBatch]) -> tuple[list[int], list[int]]:
        t = pa.Table.from_batches(run)
        rep, comp, part, whole = (t[c].to_numpy() for c in ("rep", "comp", "part", "n"))
        sets = [np.frombuffer(x.as_py(), dtype=np.uint32) for x in t["short"]]
        got = cross_pairs(sets, whole, comp, part == t["lo"].to_numpy(), part == t["hi"].to_numpy(), num, den)
        a, b = rep[got[:, 0]], rep[got[:, 1]]
        return np.minimum(a, b).tolist(), np.maximum(a, b).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key, a, b = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            h, lo, hi = (batch.column(i).to_numpy() for i in range(3))
            cut = 1 + np.flatnonzero((h[1:] != h[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
            for x, y in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if held and (h[x], lo[x], hi[x]) != key:
                    for out, more in zip((a, b), pairs(held)):
                        out += more
                    held = []
                key = (h[x], lo[x], hi[x])
                held.append(batch.slice(x, y - x))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        if held:
            for out, more in zip((a, b), pairs(held)):
                out += more
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def block_pairs(placed: DataFrame, sets: DataFrame, num: int = NUM, den: int = DEN, block_rows: int = BLOCK_ROWS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Similar pairs of different components in the buckets ``placed (h, rep, n, comp)``. A bucket
    is dealt into blocks; every two blocks meet in one group, so a row is copied once a block."""
    many = placed.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c"), F.sum("n").alias("items")).where("lo < hi")
    many = many.select("h", F.greatest(F.ceil(F.col("c") / block_rows), F.ceil(F.col("items") / block_items)).cast("int").alias("parts"))
    rows = placed.join(many, "h").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    whole = rows.where("parts = 1").withColumn("other", F.lit(0))
    dealt = rows.where("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = whole.unionByName(dealt).select("h", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "rep", "n", "comp")
    rows = rows.join(sets.select(F.col("id").alias("rep"), "short"), "rep").select("h", "lo", "hi", "part", "rep", "n", "comp", "short")
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "h", "lo", "hi").sortWithinPartitions("h", "lo", "hi").mapInArrow(tidied(_blocks(num, den)), "a long, b long").distinct())


def confirm(pairs: DataFrame, sets: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The ``(a, b)`` pairs whose sets in ``sets (id, items)`` are similar enough."""
    return (pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
            .select("a", "b", "x", "y").mapInArrow(tidied(_confirm(num, den)), "a long, b long"))


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int, num: int, den: int,
                block_rows: int, block_items: int) -> DataFrame:
    """``(id, n, comp)`` and file and position of every row of ``docs``, which scans files."""
    src = placed(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), FILE, POS)
    fp = materialize(src.mapInArrow(tidied(_fingerprints(shingle, bands, rows)),
                                    f"id long, n long, k1 long, k2 long, bands array<long>, {FILE} string, {POS} long"), "fingerprints")
    known = fp.where("n > 0 and id is not null")
    reps = materialize(known.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c")), "classes")

    # one set of bands per class, exploded to buckets; only buckets of two or more go on
    lead = known.join(reps.select("k1", "k2", F.col("rep").alias("id")), ["k1", "k2", "id"], "left_semi")
    member = lead.select(F.explode("bands").alias("h"), F.col("id").alias("rep"), "n")
    hubs = member.groupBy("h").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub < top").drop("top")
    mem = materialize(member.join(hubs, "h"), "buckets")

    star = materialize(mem.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "star")
    needed = fp.select("id", FILE, POS).join(mem.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    sets = materialize(pick(src, write_marks(needed), then=_sets(shingle), schema="id long, items binary, short binary"), "sets")
    # an id that names several texts stands for each of them
    links = materialize(confirm(star, sets, num, den), "links")
    comp = connected_components(links)

    c = comp.select(F.col("id").alias("rep"), "comp")
    at = mem.join(c, "rep", "left").select("h", "rep", "n", F.coalesce("comp", "rep").alias("comp"))
    cross = materialize(block_pairs(at, sets, num, den, block_rows, block_items), "cross")
    more = materialize(confirm(cross, sets, num, den), "links2")

    # classes hang on their representative; an id may stand in several classes
    twin = known.join(reps.where("c > 1").select("k1", "k2", "rep"), ["k1", "k2"]).select(F.col("rep").alias("a"), F.col("id").alias("b"))
    ids = connected_components(links.union(more).union(twin))
    final = ids.select(F.col("id").alias("__id"), "comp")
    return (fp.select("id", "n", FILE, POS).join(final, F.col("id") == F.col("__id"), "left")
            .select("id", "n", F.coalesce("comp", "id").alias("comp"), FILE, POS))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    bands: int = BANDS, rows: int = ROWS, num: int = NUM, den: int = DEN,
                    block_rows: int = BLOCK_ROWS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``."""
    found = _components(on_files(docs), id_col, text_col, shingle, bands, rows, num, den, block_rows, block_items)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
                        (F.col("id").isNull() | (F.col("comp") == F.col("id"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         bands: int = BANDS, rows: int = ROWS, num: int = NUM, den: int = DEN,
                         block_rows: int = BLOCK_ROWS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, its smallest id. Rows without
    an id stay; of repeated rows of one id, the first in file and position stays. Texts are not shuffled."""
    docs = on_files(docs)
    found = materialize(_components(docs, id_col, text_col, shingle, bands, rows, num, den, block_rows, block_items), "near_dup")
    place = F.struct(FILE, POS)
    gone = found.where("comp <> id")
    kept = found.where("comp = id")
    again = kept.groupBy("id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    more = kept.join(again.select("id", "first"), "id").where(place != F.col("first"))
    return pick(placed(docs), write_marks(gone.select(FILE, POS).unionByName(more.select(FILE, POS))), wanted=False)
