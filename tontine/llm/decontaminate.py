"""Benchmark decontamination: a broadcast hash set of test n-grams scanned over document windows.

A test item gives every window of ``n`` consecutive words (all its words, if fewer). The windows
of a document are hashed in running sums; a small bitmap discards nearly all of them, a sorted
array of hashes the rest, and every hit is verified on the words themselves. The set is broadcast
only up to ``block_bytes`` of test text; a larger benchmark is dealt into blocks of that size,
each scanned in turn, and the hits are merged, so no broadcast grows with the benchmark.

Defined results: null or word-free texts have no words and no hits; null or word-free items have
no windows; windows of items without an id hit words but name no item; repeated items count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import in_parts, tidied
from tontine.llm.words import CLASSES, U, sequence_hashes, word_hashes

N = 13
BLOCK_BYTES = 32 << 20
BITS = 20
_LOWER = bytes(CLASSES["alnum"][0].tolist())


def _words(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, ...]:
    return tuple(text[s:e].translate(_LOWER) for s, e in zip(starts.tolist(), ends.tolist()))


def window_index(items: list[tuple[str | None, str | None]], n: int) -> dict[int, tuple]:
    """window length -> (bitmap, sorted hashes, hash -> [(words, item ids)])."""
    found: dict[int, dict[int, dict[tuple, set]]] = {}
    for item, text in items:
        raw = (text or "").encode()
        s, e, h = word_hashes(raw, "alnum")
        if not len(h):
            continue
        k = min(n, len(h))
        words = _words(raw, s, e)
        for i, x in enumerate(sequence_hashes(h, k).tolist()):
            ids = found.setdefault(k, {}).setdefault(x, {}).setdefault(words[i:i + k], set())
            if item is not None:
                ids.add(item)
    index = {}
    for k, table in found.items():
        hashes = np.sort(np.array(list(table), dtype=U))
        bitmap = np.zeros(1 << BITS, dtype=bool)
        bitmap[hashes >> U(64 - BITS)] = True
        index[k] = (bitmap, hashes, {x: list(t.items()) for x, t in table.items()})
    return index


def scan(text: bytes, index: dict[int, tuple]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit windows as (first word, words), and the ids of the items hit."""
    s, e, h = word_hashes(text, "alnum")
    spans, items = [], set()
    for k, (bitmap, hashes, table) in index.items():
        w = sequence_hashes(h, k)
        at = np.flatnonzero(bitmap[w >> U(64 - BITS)])
        if len(at):
            pos = np.minimum(np.searchsorted(hashes, w[at]), len(hashes) - 1)
            at = at[hashes[pos] == w[at]]
        for i in at.tolist():
            here = _words(text, s[i:i + k], e[i:i + k])
            for words, ids in table[int(w[i])]:
                if words == here:
                    spans.append((i, k))
                    items |= ids
    return len(h), spans, items


def _scanner(block: Broadcast, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = window_index(block.value, n)
        for b in batches:
            words, spans, items = [], [], []
            for t, old, olds in zip(b.column(1).cast(pa.large_binary()), b.column(3), b.column(4)):
                k, hit, ids = scan(t.as_py() or b"", index)
                words.append(k)
                spans.append((old.as_py() or []) + [x for pair in hit for x in pair])
                items.append(sorted(ids.union(olds.as_py() or [])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(words, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                 pa.array(items, pa.list_(pa.string()))], ["__key", "__text", "__words", "__spans", "__items"])
    return run


def _mask(n_words: int, spans: list[int]) -> np.ndarray:
    edge = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edge, spans[0::2], 1)
    np.add.at(edge, np.add(spans[0::2], spans[1::2]).astype(np.int64), -1)
    return np.cumsum(edge[:-1]) > 0


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[Broadcast]:
    """The benchmark in broadcast blocks of about ``block_bytes`` of text."""
    spark = benchmark.sparkSession
    b = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    dealt = b.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(n)))
    return [spark.sparkContext.broadcast([(r.item, r.text) for r in dealt.where(F.col("part") == k).collect()]) for k in range(n)]


def hits(docs: DataFrame, benchmark: DataFrame, key: Column | str, text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", n: int = N, block_bytes: int = BLOCK_BYTES, then: Callable | None = None, schema=None) -> DataFrame:
    """``(__key, __text, __words, __spans, __items)`` per document: number of words, hit windows
    flattened to (first word, words) pairs, and sorted item ids. ``key`` may be any column. ``then``,
    a batch function with output ``schema`` (else the same), follows in the last block's worker: a
    step of its own would hold a second worker and a copy of the rows a task."""
    key = F.col(key) if isinstance(key, str) else key
    out = docs.select(key.alias("__key"), F.col(text_col).cast("string").alias("__text"), F.lit(0).cast("long").alias("__words"),
                      F.lit(None).cast("array<long>").alias("__spans"), F.lit(None).cast("array<string>").alias("__items"))
    own = out.schema
    *first, last = blocks(benchmark, item_col, item_text, block_bytes)
    for block in first:
        out = out.mapInArrow(tidied(in_parts(_scanner(block, n))), own)
    scan_last = _scanner(last, n)
    return out.mapInArrow(tidied(in_parts(scan_last if then is None else lambda batches: then(scan_last(batches)))), own if schema is None else schema)


def _reporter(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_pylist()
            hit = [int(_mask(k, x).sum()) if x else 0 for k, x in zip(n, b.column(3).to_pylist())]
            items = b.column(4).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                 pa.array([h > 0 and den * h >= num * k for h, k in zip(hit, n)], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return run


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", num: int = 1, den: int = 20, **params) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, where
    contaminated means some hit and ``den * n_hit >= num * n_words``."""
    return hits(docs, benchmark, F.col(id_col).cast("long"), then=_reporter(num, den), **params,
                schema="doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cut_spans(text: str, spans: list[int]) -> str:
    """``text`` without its hit words; what stands between the words of one hit goes too."""
    raw = text.encode()
    s, e, h = word_hashes(raw, "alnum")
    mask = _mask(len(h), spans)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    parts, at = [], 0
    for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
        parts.append(raw[at:s[a]])
        at = e[b - 1]
    return (b"".join(parts) + raw[at:]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "documents",
                  num: int = 1, den: int = 20, **params) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit words cut
    out of every text. All columns are kept and nothing is joined: rows travel as one struct."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, spans = b.column(2).to_pylist(), b.column(3).to_pylist()
            if remove == "documents":
                hit = [int(_mask(k, x).sum()) if x else 0 for k, x in zip(n, spans)]
                yield b.filter(pa.array([not (y > 0 and den * y >= num * k) for y, k in zip(hit, n)], pa.bool_()))
            else:
                text = [cut_spans(t, x) if x else t for t, x in zip(b.column(1).to_pylist(), spans)]
                yield b.set_column(1, "__text", pa.array(text, b.schema.field(1).type))

    done = hits(docs, benchmark, whole if len(docs.columns) > 1 else F.lit(None).cast("string"), text_col, then=run, **params)
    return done.select(*[(F.col("__text") if c == text_col else F.col("__key").getField(c)).alias(c) for c in docs.columns])
