"""Token-ID files with Elias-Fano document boundaries.

A shard file holds the ids of consecutive documents as one array (16 bits an id where the
vocabulary allows), then two Elias-Fano sequences, the documents' ends within the shard and the
documents' ids, then a fixed-size footer. Nothing in it is a table of 64-bit offsets; a reader
selects the bounds of one document, or decodes them all, and reads just those ids.

``write_tokens`` range-sorts the documents by id, encodes and writes each partition as one or
more shards (to a temporary name, then renamed: a task that is run again writes the same bytes),
and writes the shards' manifest with their global starts as a Parquet table beside them.
``read_tokens`` reads documents back from the files.

Texts are encoded with the tokenizers library. For byte-level vocabularies a block of texts is cut
at places where the pre-tokenizer always cuts (before white space; where plain letters, digits and
signs meet; after a lone line break or tab), its distinct pieces are looked up among those the
worker keeps, new ones are encoded once, and Arrow gathers the ids; every other kind of vocabulary
gets the whole text at once. Both give the ids of the whole text.

Defined results: null or empty text: just the end id; rows without doc_id come first (id null);
repeated rows are written once each, equal ids in order of their text; an empty table gives no
shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm import elias_fano
from tontine.llm.common import file_system, materialize, range_prefix, scratch_path, tidied

MAGIC = b"EFTOKIDS"
_FOOT = struct.Struct("<8sIIQQQqQQ")  # magic, version, bytes an id, docs, ids, docs without id, smallest id, bytes of ends, bytes of ids' ids
SHARD_IDS = 1 << 26
CACHE_BYTES = 16 << 20  # of each of the two generations of pieces that a worker keeps
_ENTRY = 200  # bytes of a cached piece besides its text and ids
BLOCK_BYTES = 4 << 20  # of texts cut at once
_HIGH_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")  # with letters from À to ÿ
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies write as the character
_WRITTEN = dict(zip((b for b in range(256) if b not in _SHOWN), range(256, 512)))  # and the others

_OTHER, _LETTER, _DIGIT, _SIGN, _QUOTE, _BLANK, _BREAK, _HIGH = range(8)  # classes of bytes
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[39, 32]] = _QUOTE, _BLANK
_CLASS[9:14] = _BREAK
_CLASS[128:] = _HIGH
_PLAIN = (_LETTER, _DIGIT, _SIGN, _QUOTE)


def _pairs(before: tuple, after: tuple) -> np.ndarray:
    """Table by 8 * class of the byte before + class of the byte."""
    return np.array([a in before and b in after for a in range(8) for b in range(8)])


# Letters after a quote may belong to it, as in 's; signs and quotes make one word.
_CUT = (_pairs(_PLAIN, (_BLANK, _BREAK)) | _pairs((_LETTER,), (_DIGIT, _SIGN, _QUOTE)) | _pairs((_DIGIT,), (_LETTER, _SIGN, _QUOTE))
        | _pairs((_SIGN,), (_LETTER, _DIGIT)))
_AFTER_HIGH, _AFTER_BREAK = _pairs((_HIGH,), (_BLANK, _BREAK)), _pairs((_BREAK,), _PLAIN)
_WHITE = [int.from_bytes(chr(c).encode(), "big") for c in range(128, 1 << 16) if chr(c).isspace()]  # UTF-8, two or three bytes


def piece_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pieces start in the UTF-8 bytes ``raw`` of texts that start at ``texts``."""
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    kinds = _CLASS[raw]
    pair = (kinds[:-1] << 3) | kinds[1:]
    cut = np.concatenate([[True], _CUT[pair]])
    cut[texts[texts < len(raw)]] = True
    at = np.flatnonzero(_AFTER_HIGH[pair]) + 1
    last = (raw[at - 2].astype(np.int64) << 8) | raw[at - 1]
    cut[at[~np.isin(last, _WHITE) & ~np.isin(raw[at - 3].astype(np.int64) << 16 | last, _WHITE)]] = True
    at = np.flatnonzero(_AFTER_BREAK[pair]) + 1
    cut[at[cut[at - 1]]] = True  # the break stands alone
    return np.flatnonzero(cut)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts, as little-endian bytes of ``kind``."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        d = json.loads(spec)
        size = max([*self.tokenizer.get_vocab(with_added_tokens=True).values(), 0]) + 1
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        pre = d.get("pre_tokenizer") or {}
        self.pieces = (d.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and d["model"].get("type", "BPE") == "BPE" and not d["model"].get("dropout"))
        self.added = [t["content"] for t in d.get("added_tokens", [])]
        self.words = Tokenizer(self.tokenizer.model)  # the same model, for single words of the pre-tokenizer
        self.bytes = np.zeros(size, dtype=np.int64)  # of every token of a byte-level vocabulary
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = len(token)
        self.hot: dict[bytes, bytes] = {}
        self.cold: dict[bytes, bytes] = {}
        self.held = 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The ids of new pieces. Letters or digits behind a blank or nothing are one word to the
        pre-tokenizer; many such words are encoded together and told apart by their bytes."""
        words, high, rest, out = [], [], [], {}
        for p in new:
            word = p.removeprefix(b" ")
            (words if word.isalpha() or word.isdigit() else high if _HIGH_WORD.fullmatch(p) else rest).append(p)
        written = b"\n".join(words).decode("ascii").replace(" ", "Ġ").split("\n") if words else []
        written += [p.decode("latin-1").translate(_WRITTEN) for p in high]
        words += high
        groups = range(0, len(words), 200)
        for at, e in zip(groups, self.words.encode_batch_fast([written[at:at + 200] for at in groups], is_pretokenized=True, add_special_tokens=False)):
            part, ids = words[at:at + 200], np.array(e.ids, dtype=self.kind)
            upto, want = np.concatenate([[0], np.cumsum(self.bytes[ids])]), np.cumsum([0, *map(len, part)])
            cut = np.searchsorted(upto, want)
            if upto[-1] != want[-1] or (upto[cut] != want).any():  # a byte without a token
                rest += part
                continue
            raw, cut = ids.tobytes(), (cut * self.kind.itemsize).tolist()
            out.update((p, raw[a:z]) for p, a, z in zip(part, cut, cut[1:]))
        out.update(zip(rest, self._whole([p.decode() for p in rest])))
        return out

    def _hold(self, pieces: dict[bytes, bytes]) -> None:
        """Keep pieces. When the hot generation has reached its bytes it becomes the cold one, whose
        pieces come back as they are met again; what is not met is forgotten a generation later."""
        if self.held > CACHE_BYTES:
            self.hot, self.cold, self.held = {}, self.hot, 0
        self.hot.update(pieces)
        self.held += sum(map(len, pieces)) + sum(map(len, pieces.values())) + _ENTRY * len(pieces)

    def _found(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces."""
        found = list(map(self.hot.get, pieces))
        missing = [p for p, x in zip(pieces, found) if x is None]
        if missing:
            got = {p: self.cold[p] for p in missing if p in self.cold}
            got |= self._learn([p for p in missing if p not in got])
            found = [got[p] if x is None else x for p, x in zip(pieces, found)]
            self._hold(got)
        return found

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of every text, none of a null."""
        col = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if not self.pieces:
            return self._whole(col.to_pylist())
        at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        if not len(col) or at[0] == at[-1]:
            return [b""] * len(col)
        raw = np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        starts = piece_starts(raw, at[:-1])
        bounds = pa.py_buffer(np.append(starts, len(raw)).astype(np.int32))
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(raw)]).dictionary_encode()
        bounds, data = np.frombuffer(pieces.dictionary.buffers()[1], np.int32).tolist(), pieces.dictionary.buffers()[2].to_pybytes()
        distinct = [data[a:z] for a, z in zip(bounds, bounds[1:len(pieces.dictionary) + 1])]
        ids = pa.array(self._found(distinct), pa.large_binary()).take(pieces.indices)
        ends, data = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(starts, at)].tolist(), ids.buffers()[2].to_pybytes()
        out = [data[a:z] for a, z in zip(ends, ends[1:])]
        for added in self.added:  # a text that holds one goes to the tokenizer whole
            for k in pc.indices_nonzero(pc.match_substring(col, added)).to_pylist():
                out[k] = self._whole([col[k].as_py()])[0]
        return out


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: Broadcast) -> Encoder:
    """One encoder per worker and vocabulary, kept between tasks with its pieces, whose bytes are bounded."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    text = spec.value
    key = zlib.crc32(text.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(text)
    return _ENCODERS[key]


class ShardWriter:
    """Streams ids to ``path``; boundaries and ids of documents go behind them."""

    def __init__(self, fs: pafs.FileSystem, path: str, temporary: str, kind: np.dtype):
        self.fs, self.path, self.temporary, self.kind = fs, path, temporary, kind
        self.out = fs.open_output_stream(temporary)
        self.ends: list[int] = []
        self.docs: list[int] = []
        self.nulls = self.n = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.n += len(ids) // self.kind.itemsize
        self.ends.append(self.n)
        if doc_id is None:
            self.nulls += 1
        else:
            self.docs.append(doc_id)

    def close(self) -> tuple[int, int]:
        base = self.docs[0] if self.docs else 0
        ends = elias_fano.encode(np.array(self.ends, dtype=np.uint64))
        docs = elias_fano.encode(np.array([d - base for d in self.docs], dtype=np.uint64))
        self.out.write(ends + docs + _FOOT.pack(MAGIC, 1, self.kind.itemsize, len(self.ends), self.n, self.nulls, base, len(ends), len(docs)))
        self.out.close()
        if self.fs.get_file_info(self.path).type != pafs.FileType.NotFound:
            self.fs.delete_file(self.path)  # an earlier attempt's, with the same bytes
        self.fs.move(self.temporary, self.path)
        return len(self.ends), self.n


class ShardReader:
    """Random access to the documents of a shard file."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        foot = self.file.read_at(_FOOT.size, size - _FOOT.size)
        magic, version, self.width, self.n_docs, self.n_ids, self.nulls, self.base, a, b = _FOOT.unpack(foot)
        if magic != MAGIC or version != 1:
            raise ValueError(f"{path} is not a token file")
        at = size - _FOOT.size - a - b
        tail = self.file.read_at(a + b, at)
        self.ends, self.docs = elias_fano.EliasFano(tail[:a]), elias_fano.EliasFano(tail[a:])

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.docs.select(i - self.nulls)

    def ids(self, start: int, end: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((end - start) * self.width, start * self.width), dtype=f"<u{self.width}")


def _write(spec: Broadcast, folder: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(spec), TaskContext.get()
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        end = np.array([end_id], dtype=enc.kind).tobytes()
        part, done, shard = task.partitionId(), [], None

        def close() -> None:
            done.append((part, len(done), f"part-{part:05d}-{len(done):05d}.eft", *shard.close()))

        for b in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
                for i, x in zip(b.column(0).slice(at, to - at).to_pylist(), enc.encode(b.column(1).slice(at, to - at))):
                    if shard is None:
                        name = f"part-{part:05d}-{len(done):05d}.eft"
                        shard = ShardWriter(fs, f"{base}/{name}", f"{base}/_{name}.{task.taskAttemptId()}", enc.kind)
                    shard.add(i, x + end)
                    if shard.n >= shard_ids:
                        close()
                        shard = None
                at = to
        if shard is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("part", "seq", "file", "n_docs", "n_ids"), map(list, zip(*done)))))
    return run


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 end_id: int = 2, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` into shard files below ``path``, in ascending order of ``id_col``."""
    spark = docs.sparkSession
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # one vocabulary file
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = src.repartitionByRange(parts, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    rows = laid.mapInArrow(tidied(_write(spec, f"{path}/shards", end_id, shard_ids)), "part long, seq long, file string, n_docs long, n_ids long")
    rows = materialize(rows, "shards")
    ranked = range_prefix(rows, ["part", "seq"], "n_ids", "__upto", max(1, parts // 8), "manifest")
    ranked.select("file", "n_docs", "n_ids", (F.col("__upto") - F.col("n_ids")).alias("start")).write.parquet(f"{path}/manifest")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for b in batches:
            for name, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                r = ShardReader(fs, f"{base}/{name}")
                ends = r.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                ids = [None] * r.nulls + (r.docs.all().astype(np.int64) + r.base).tolist()
                at = 0
                while at < r.n_docs:  # about 8 MB of ids at a time
                    to = max(at + 1, int(np.searchsorted(ends, starts[at] + (4 << 20))))
                    block = r.ids(int(starts[at]), int(ends[to - 1])).astype("<u4")
                    cut = (ends[at:to] - starts[at]).tolist()
                    crc = [zlib.crc32(block[a:z].tobytes()) for a, z in zip([0, *cut[:-1]], cut)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at:to], pa.int64()), pa.array(starts[at:to] + first), pa.array(ends[at:to] - starts[at:to]), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
                    at = to
    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the files: ids of
    all documents before it, ids with the end id, and their crc32 as 32-bit integers."""
    files = spark.read.parquet(f"{path}/manifest").select("file", "start")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts, "file").mapInArrow(tidied(_read(f"{path}/shards")), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, **params) -> DataFrame:
    """Write ``docs`` to a fresh folder in the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **params)
    return read_tokens(docs.sparkSession, path)
