"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import starledger
from starledger.session import work_path
from starledger.sources import fs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ARROW = {"int": pa.int32(), "long": pa.int64()}


def few_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows that the driver holds, of int and long columns, as a table.  They are
    sent as Arrow: for plain rows every executor starts a second kind of Python
    workers, which stays beside the first."""
    fields = [pa.field(name, _ARROW[kind]) for name, kind in (c.split() for c in schema.split(", "))]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields)), schema)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, is
    computed once, and survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    root = Path(starledger.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    path = f"{shared_path(spark, 'package')}.zip"
    fs.write_bytes(spark, path, packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(spark.sparkContext.applicationId)


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets int64 of length n + 1 starting at 0, bytes uint8) of a string
    column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20):
    """Consecutive pieces of an Arrow batch holding at most ``most_bytes`` of
    the text column each (one row at least), which bounds a task's memory."""
    n = batch.num_rows
    if n == 0:
        return
    offsets, _ = utf8_buffers(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < n:
        upto = int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1
        upto = min(n, max(at + 1, upto))
        yield batch.slice(at, upto - at)
        at = upto


#: odd multiplier of the rolling word hash, and its inverse modulo 2**64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 16


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply), elementwise."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    block = np.empty(min(n, _CHUNK) or 1, np.uint64)
    v = 1
    for i in range(len(block)):
        block[i] = v
        v = v * base % (1 << 64)
    step, m = np.uint64(v), np.uint64(1)
    for s in range(0, n, _CHUNK):
        e = min(n, s + _CHUNK)
        out[s:e] = block[:e - s] * m
        m = np.uint64(int(m) * int(step) % (1 << 64))
    return out


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = _POWERS[base] = _powers(base, max(n, 1 << 20))
    return have[:n]


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): equal spans have equal
    hashes wherever they stand."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * powers(_BASE, len(raw)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(_BASE_INV, len(raw) + 1)[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: \x20 and \x09-\x0D: the word separators of the shingle and size contracts
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: lower-cases A-Z alone
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words of every row; a word never
    crosses a row border."""
    if len(raw) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~SPACE[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(inside & (border[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (border[1:] | np.r_[~inside[1:], True])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows
