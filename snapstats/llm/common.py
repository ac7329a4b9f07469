"""Shared by the corpus operators: tables, stored steps, size-checked broadcasts, batches of texts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.session import shared_folder

# White space of the word pattern [^\x20\x09-\x0D]+.
SPACES = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
# A table of ids up to this many rows (16 bytes each) may be broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000
# Texts handled at once by the array code, in bytes; a single longer text is one piece.
PIECE_BYTES = 1_000_000


_shipped: set[str] = set()


def ship(df: DataFrame) -> DataFrame:
    """Send this package's code to the executors once per application, as `--py-files` would, and return `df`.

    Spark serves the archive from the driver; nothing else reads it from there.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="code-")), "snapstats-code.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(top)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*steps: DataFrame) -> None:
    """Delete the files of `stored` tables that nothing reads any more; tables stored later do not depend on them."""
    for step in steps:
        spark = step.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in step.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hinted(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `limit` rows; else a shuffled join is left to Spark."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= limit else df


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Key of a row that nulls and repeated ids keep apart: rows that share it have the same id and text."""
    return [F.coalesce(doc_id.cast("bigint"), F.lit(-(1 << 63))).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_th")]


def text_pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut to about PIECE_BYTES of text: the rows, their texts' bytes in one array, and offsets (rows + 1)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        row = 0
        while row < batch.num_rows:
            done = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, done + PIECE_BYTES, "right")))
            part = pa.concat_arrays([texts.slice(row, stop - row)])
            buffers = part.buffers()
            offsets = np.frombuffer(buffers[1], np.int64)[part.offset:part.offset + len(part) + 1]
            data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
            yield batch.slice(row, stop - row), data[offsets[0]:offsets[-1]], offsets - offsets[0]
            row = stop


def packed(df: DataFrame, text: str = "_text") -> DataFrame:
    """`df` with its text compressed as `_z`, to be shuffled at a third of its size; `unpacked` is the way back."""
    others = [f for f in df.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3)
        for rows, data, offsets in text_pieces(batches, text):
            small = [squeeze.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*(rows.column(f.name) for f in others), pa.array(small, pa.binary())], [*(f.name for f in others), "_z"])
    return df.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in others), "_z binary"]))


def unpacked(batches: Iterator[pa.RecordBatch], text: str = "_text", rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of `packed` rows with their texts again, `rows` at a time."""
    widen = zstandard.ZstdDecompressor()
    for batch in batches:
        names = [n for n in batch.schema.names if n != "_z"]
        for first in range(0, batch.num_rows, rows):
            part = batch.slice(first, rows)
            whole = [widen.decompress(z).decode() for z in part.column("_z").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(whole, pa.large_string())], [*names, text])
