"""Picking rows out of a table by file and row position, without moving the others.

A join that picks some documents by id shuffles every text once the ids are too many to broadcast.
Here the picked rows are named by the file that holds them and their position in it; the names are
written as a table, dealt by file, and every scan task reads only the names of its own files. Texts
stay where they are, and what a task holds is the marked positions of one file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import file_system, materialize, scratch_path, tidied

FILE, POS = "__file", "__pos"
_FOLDERS = 64
_ROWS = 512  # filtered at a time
_STRETCH = 1_000_000  # positions of one file that a task writes


def on_files(rows: DataFrame) -> DataFrame:
    """``rows`` if it scans files, else written first."""
    try:
        rows.select("_metadata.file_path", "_metadata.row_index")
        return rows
    except AnalysisException:
        return materialize(rows, "rows")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` of ``on_files`` with the file and position of each."""
    return rows.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(POS))


def write_marks(marks: DataFrame) -> str:
    """Write the places of ``marks`` and return their folder."""
    path = scratch_path(marks.sparkSession, "marks")
    parts = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (marks.select(FILE, POS).distinct().withColumn("folder", F.crc32(F.col(FILE).cast("binary")) % _FOLDERS)
     .repartition(parts, FILE, F.floor(F.col(POS) / _STRETCH)).sortWithinPartitions("folder", FILE, POS).write.partitionBy("folder").parquet(path))
    return path


def _positions(path: str, file: str) -> np.ndarray:
    fs, base = file_system(f"{path}/folder={zlib.crc32(file.encode()) % _FOLDERS}")
    if fs.get_file_info(base).type == pafs.FileType.NotFound:
        return np.zeros(0, dtype=np.int64)
    got = pads.dataset(base, filesystem=fs, format="parquet").to_table(columns=[POS], filter=pads.field(FILE) == file)
    return np.sort(got[POS].to_numpy())


def _picked(path: str, wanted: bool, then: Callable | None):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, marks = None, np.zeros(0, dtype=np.int64)
        for b in (whole.slice(at, _ROWS) for whole in batches for at in range(0, whole.num_rows, _ROWS)):
            names = b.column(b.num_columns - 2).dictionary_encode()
            pos = b.column(b.num_columns - 1).to_numpy()
            keep = np.zeros(b.num_rows, dtype=bool)
            codes = names.indices.to_numpy()
            for code, name in enumerate(names.dictionary.to_pylist()):
                if name != file:
                    file, marks = name, _positions(path, name)
                mine = codes == code
                keep[mine] = np.isin(pos[mine], marks, assume_unique=True) == wanted
            out = b.filter(pa.array(keep))
            yield out.select(out.schema.names[:-2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pick(batches) if then is None else then(pick(batches))
    return tidied(run)


def pick(rows: DataFrame, path: str, wanted: bool = True, then: Callable | None = None, schema: str | None = None) -> DataFrame:
    """The marked rows of ``placed`` rows (or, not ``wanted``, the others), without their places.
    ``then`` is a batch function that runs on them in the same tasks and gives ``schema``."""
    return rows.mapInArrow(_picked(path, wanted, then), schema or rows.drop(FILE, POS).schema)
