"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

``LineIndex`` keeps, as written tables in the shared folder,
- postings ``(doc_id, k1, k2)``: the distinct line keys (128-bit hashes) of each document;
- reference counts ``(k1, k2, n_docs, keep)``: in how many documents a key stands, and the
  largest of them;
- one cuckoo filter per shard of the key space over the keys found in ``min_docs`` documents or
  more: the keys whose lines are dropped.

``insert`` and ``delete`` merge a batch into the postings and counts and add to or remove from
the filters just the keys that crossed the threshold, so a deletion undoes an insertion exactly.
``dedup`` screens a batch's postings with the filters and looks up only what passes in the exact
counts; a false positive costs one lookup, nothing else. Filters are broadcast up to
``filter_bytes``; beyond, the postings go to their shard in a co-grouped pass instead.

A line's key is the line without white space at both ends, A-Z lower-cased; keys of fewer than
``min_chars`` code points are never dropped. Defined results: null text is one empty line; rows
without doc_id hold no lines and lose none; rows of one doc_id count as one document.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm.common import materialize, tidied

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS = 1 << 18
FILTER_BYTES = 32 << 20
_STRIP = " \t\n\x0b\x0c\r"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """128-bit key of every line, None where the line is too short to be dropped."""
    out = []
    for line in (text or "").split("\n"):
        key = line.strip(_STRIP)
        out.append(xxhash.xxh3_128_digest(key.encode().translate(_LOWER)) if len(key) >= min_chars else None)
    return out


class CuckooFilter:
    """Four 16-bit fingerprints a bucket, two candidate buckets a key, batched in numpy. Removing
    a key that was added never affects the others. ``rest`` holds what a full table leaves over,
    exactly, so an answer "absent" is always right."""

    SLOTS, ROUNDS = 4, 200

    def __init__(self, capacity: int, table: np.ndarray | None = None, rest: np.ndarray | None = None):
        n = 1 << max(4, int(max(1, capacity) / (self.SLOTS * 0.85)).bit_length())
        self.table = np.zeros((n, self.SLOTS), dtype=np.uint16) if table is None else table
        self.rest = np.zeros((0, 2), dtype=np.int64) if rest is None else rest

    def _place(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        finger = (k2.view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        finger[finger == 0] = 1
        return finger, (k1.view(np.uint64) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, at: np.ndarray, finger: np.ndarray) -> np.ndarray:
        return at ^ ((finger.astype(np.int64) * 0x5BD1E995) & (len(self.table) - 1))

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        finger, at = self._place(k1, k2)
        owner = np.arange(len(at))
        rng = np.random.default_rng(7)
        tried = np.zeros(len(at), dtype=bool)
        path: list[np.ndarray] = []
        for _ in range(self.ROUNDS):
            if not len(at):
                return
            order = np.argsort(at, kind="stable")
            at, finger, owner, tried = at[order], finger[order], owner[order], tried[order]
            first = np.concatenate([[True], at[1:] != at[:-1]])  # one key a bucket and round
            one = np.flatnonzero(first)
            free = self.table[at[one]] == 0
            has = free.any(axis=1)
            self.table[at[one[has]], free[has].argmax(axis=1)] = finger[one[has]]
            full = one[~has]
            kick = full[tried[full]]  # both buckets full: change places with a random slot
            slot = rng.integers(0, self.SLOTS, len(kick))
            held = self.table[at[kick], slot].copy()
            self.table[at[kick], slot] = finger[kick]
            finger[kick] = held
            move = full
            at[move] = self._other(at[move], finger[move])
            tried[move] = True
            left = np.ones(len(at), dtype=bool)
            left[one[has]] = False
            at, finger, owner, tried = at[left], finger[left], owner[left], tried[left]
        self.rest = np.concatenate([self.rest, np.stack([np.minimum(at, self._other(at, finger)), finger.astype(np.int64)], 1)])

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        finger, at = self._place(k1, k2)
        two = self._other(at, finger)
        hit = (self.table[at] == finger[:, None]).any(axis=1) | (self.table[two] == finger[:, None]).any(axis=1)
        for a, f in self.rest.tolist():
            hit |= (np.minimum(at, two) == a) & (finger == f)
        return hit

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Remove keys that were inserted, each once."""
        finger, at = self._place(k1, k2)
        for a, f in zip(at.tolist(), finger.tolist()):
            b = int(self._other(np.array([a]), np.array([f], dtype=np.uint16))[0])
            for bucket in (a, b):
                slot = np.flatnonzero(self.table[bucket] == f)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break
            else:
                same = np.flatnonzero((self.rest[:, 0] == min(a, b)) & (self.rest[:, 1] == f))
                self.rest = np.delete(self.rest, same[:1], axis=0)


_FILTER = "shard long, cells binary, rest binary"


def _unpack(cells: bytes, rest: bytes) -> CuckooFilter:
    return CuckooFilter(1, np.frombuffer(cells, dtype=np.uint16).reshape(-1, CuckooFilter.SLOTS).copy(),
                        np.frombuffer(rest, dtype=np.int64).reshape(-1, 2).copy())


def _postings(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, flat = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                keys = {k for k in line_keys(t.as_py(), min_chars) if k}
                ids.append(np.full(len(keys), i, dtype=np.int64))
                flat.append(b"".join(keys))
            k = np.frombuffer(b"".join(flat), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64)), pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1]))], ["doc_id", "k1", "k2"])
    return run


def _dropper(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, total, gone = [], [], []
            for t, drop in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines = (t or "").split("\n")
                total.append(len(lines))
                if drop:
                    out = {struct.pack("<qq", d["k1"], d["k2"]) for d in drop}
                    lines = [x for x, k in zip(lines, line_keys(t, min_chars)) if k not in out]
                gone.append(total[-1] - len(lines))
                text.append("\n".join(lines) if drop or t is not None else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             ["__row", "__text", "n_lines", "n_dropped"])
    return run


class LineIndex:
    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 shard_keys: int = SHARD_KEYS, filter_bytes: int = FILTER_BYTES):
        self.spark, self.min_chars, self.min_docs = spark, min_chars, min_docs
        self.shard_keys, self.filter_bytes = shard_keys, filter_bytes
        self.shards = 1
        self.postings = spark.createDataFrame([], "doc_id long, k1 long, k2 long")
        self.counts = spark.createDataFrame([], "k1 long, k2 long, n_docs long, keep long")
        self.filters = spark.createDataFrame([], _FILTER)

    def keys_of(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Distinct ``(doc_id, k1, k2)`` within each row."""
        src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
        return src.mapInArrow(tidied(_postings(self.min_chars)), "doc_id long, k1 long, k2 long")

    def _shard(self):
        return F.pmod(F.shiftright("k1", 40), F.lit(self.shards).cast("long"))

    def _hot(self, counts: DataFrame) -> DataFrame:
        return counts.where(F.col("n_docs") >= self.min_docs)

    def _rebuild(self, counts: DataFrame, n_hot: int) -> DataFrame:
        self.shards = max(1, -(-n_hot // self.shard_keys))

        def build(key, rows: pd.DataFrame) -> pd.DataFrame:
            f = CuckooFilter(2 * len(rows))
            f.insert(rows["k1"].to_numpy(), rows["k2"].to_numpy())
            return pd.DataFrame({"shard": [key[0]], "cells": [f.table.tobytes()], "rest": [f.rest.tobytes()]})

        return self._hot(counts).select(self._shard().alias("shard"), "k1", "k2").groupBy("shard").applyInPandas(build, _FILTER)

    def _update(self, before: DataFrame, after: DataFrame) -> None:
        n_hot = self._hot(after).count()
        if n_hot > self.shards * self.shard_keys * 2 or self.filters.isEmpty():
            self.filters = materialize(self._rebuild(after, n_hot), "filters")
            return
        old, new = self._hot(before).select("k1", "k2"), self._hot(after).select("k1", "k2")
        change = (new.join(old, ["k1", "k2"], "left_anti").withColumn("add", F.lit(True))
                  .union(old.join(new, ["k1", "k2"], "left_anti").withColumn("add", F.lit(False)))
                  .select(self._shard().alias("shard"), "k1", "k2", "add"))

        def apply(key, state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            f = _unpack(state["cells"][0], state["rest"][0]) if len(state) else CuckooFilter(2 * len(rows))
            gone, new_rows = rows[~rows["add"]], rows[rows["add"]]
            f.delete(gone["k1"].to_numpy(), gone["k2"].to_numpy())
            f.insert(new_rows["k1"].to_numpy(), new_rows["k2"].to_numpy())
            return pd.DataFrame({"shard": [key[0]], "cells": [f.table.tobytes()], "rest": [f.rest.tobytes()]})

        self.filters = materialize(self.filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(apply, _FILTER), "filters")

    def _count(self, postings: DataFrame) -> DataFrame:
        return postings.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep"))

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Add the documents; ids already in the index are replaced. Returns the batch's postings."""
        batch = materialize(self.keys_of(docs, id_col, text_col), "batch")
        per_id = batch.groupBy("doc_id", "k1", "k2").count()
        if not per_id.where("count > 1").isEmpty():  # rows of one id hold a line together
            batch = materialize(per_id.drop("count"), "batch")
        first = self.postings.isEmpty()
        if not first:
            ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
            if not self.postings.join(ids, "doc_id", "left_semi").isEmpty():
                self.delete(ids)
        before = self.counts
        if first:
            self.postings, self.counts = batch, materialize(self._count(batch), "counts")
        else:
            self.postings = materialize(self.postings.union(batch), "postings")
            merged = before.unionByName(self._count(batch)).groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"), F.max("keep").alias("keep"))
            self.counts = materialize(merged, "counts")
        self._update(before, self.counts)
        return batch

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents out; counts, kept documents and filters become what they would be had
        the documents never been inserted."""
        out = ids.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
        gone = materialize(self.postings.join(out, "doc_id", "left_semi"), "gone")
        self.postings = materialize(self.postings.join(out, "doc_id", "left_anti"), "postings")
        before = self.counts
        touched = gone.select("k1", "k2").distinct()
        again = self._count(self.postings.join(touched, ["k1", "k2"], "left_semi"))
        self.counts = materialize(before.join(touched, ["k1", "k2"], "left_anti").unionByName(again), "counts")
        self._update(before, self.counts)

    def screen(self, postings: DataFrame) -> DataFrame:
        """The postings that the filters do not rule out."""
        size = self.filters.agg(F.sum(F.length("cells") + F.length("rest"))).first()[0] or 0
        shards = self.shards
        if size <= self.filter_bytes:
            have = self.spark.sparkContext.broadcast({r.shard: (r.cells, r.rest) for r in self.filters.collect()})

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                filters = {k: _unpack(*v) for k, v in have.value.items()}
                for b in batches:
                    k1, k2 = b.column(1).to_numpy(), b.column(2).to_numpy()
                    shard = np.mod(k1 >> 40, shards)
                    hit = np.zeros(len(k1), dtype=bool)
                    for s, f in filters.items():
                        at = np.flatnonzero(shard == s) if shards > 1 else slice(None)
                        hit[at] = f.contains(k1[at], k2[at])
                    yield b.filter(pa.array(hit))

            return postings.mapInArrow(run, "doc_id long, k1 long, k2 long")

        # beyond the bound a key is asked once, in its shard, whatever the number of its documents
        def ask(key, state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(state) or not len(rows):
                return rows[["k1", "k2"]].iloc[:0]
            hit = _unpack(state["cells"][0], state["rest"][0]).contains(rows["k1"].to_numpy(), rows["k2"].to_numpy())
            return rows.loc[hit, ["k1", "k2"]]

        keys = postings.select("k1", "k2").distinct().select(self._shard().alias("shard"), "k1", "k2")
        maybe = self.filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(ask, "k1 long, k2 long")
        return postings.join(maybe, ["k1", "k2"], "left_semi").select("doc_id", "k1", "k2")

    def drops(self, postings: DataFrame) -> DataFrame:
        """``(doc_id, drop)``: the keys whose lines the document loses."""
        hot = self._hot(self.counts).select("k1", "k2", "keep")
        return (self.screen(postings).join(hot, ["k1", "k2"]).where("doc_id <> keep")
                .groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("drop")))

    def dedup(self, docs: DataFrame, postings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` with the text's dropped lines gone, plus ``n_lines`` (before) and
        ``n_dropped``. Documents need not be in the index, but only then keep their lines."""
        drops = self.drops(self.keys_of(docs, id_col, text_col) if postings is None else postings)
        drops = drops.select(F.col("doc_id").alias("__id"), F.col("drop").alias("__drop"))
        rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
        row = F.struct(*[F.col(f"`{c}`") for c in rest])
        joined = docs.join(drops, F.col(id_col).cast("long") == F.col("__id"), "left").select(row.alias("__row"), F.col(text_col).cast("string").alias("__text"), "__drop")
        kind = joined.schema["__row"].dataType.simpleString()
        out = joined.mapInArrow(tidied(_dropper(self.min_chars)), f"__row {kind}, __text string, n_lines long, n_dropped long")
        return out.select(*[(F.col("__text") if c == text_col else F.col("__row").getField(c)).alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
