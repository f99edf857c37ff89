"""A message log in Parquet files as a stream with offsets.

Layout: ``<path>/topic=<t>/partition=<p>/*.parquet`` with ``key, value, offset``,
as ``write_log`` (or any partitioned Spark write) leaves it.  What a stream has
read is one next offset per topic partition, kept in its checkpoint; a restart
reads strictly newer offsets, whatever files they lie in.  A late file of lower
offsets is not read, as a consumer group's committed offset would have it; of a
file that holds both, the newer rows are.  ``startingOffsets`` is ``earliest``
or ``latest``.

A file's first and last offset come from its footer, so planning reads no rows
and each file is a task that skips the row groups below its start.  Files are
listed with pyarrow's file systems on driver and executors alike; names that
begin with ``_`` or ``.`` are another writer's unfinished work.  A row without an
offset has no place in a log: its file fails the read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "offset_log"
SCHEMA = "key string, value string, topic string, partition int, offset bigint"


class Segment(InputPartition):
    """The rows of a file whose offset is in [start, end)."""

    def __init__(self, path: str, topic: str, partition: int, start: int, end: int):
        self.path, self.topic, self.partition, self.start, self.end = path, topic, partition, start, end


def _file_system(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root)


def _bounds(group: pq.RowGroupMetaData) -> tuple[int, int]:
    """First and last offset of a row group."""
    for i in range(group.num_columns):
        column = group.column(i)
        if column.path_in_schema == "offset":
            stats = column.statistics
            if stats is None or stats.null_count or not stats.has_min_max:
                raise ValueError("a row group of the log has rows without an offset, or no statistics of it")
            return stats.min, stats.max
    raise ValueError("a file of the log has no column 'offset'")


class _Log:
    """The files of a log, each footer read once."""

    def __init__(self, root: str):
        self.root = root
        self.known: dict[str, tuple[str, int, int, int]] = {}  # path: topic, partition, first, last

    def files(self) -> dict[str, tuple[str, int, int, int]]:
        system, base = _file_system(self.root)
        found = {}
        for info in system.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
            inner = info.path[len(base):].strip("/").split("/")
            if info.type != pafs.FileType.File or not inner[-1].endswith(".parquet") or any(n[0] in "_." for n in inner):
                continue
            keys = dict(n.split("=", 1) for n in inner[:-1] if "=" in n)
            if info.path not in self.known:
                footer = pq.read_metadata(info.path, filesystem=system)
                groups = [_bounds(footer.row_group(i)) for i in range(footer.num_row_groups) if footer.row_group(i).num_rows]
                if not groups:
                    continue
                self.known[info.path] = (unquote(keys["topic"]), int(keys["partition"]),
                                         min(a for a, _ in groups), max(b for _, b in groups))
            found[info.path] = self.known[info.path]
        return found

    def latest(self) -> dict[str, int]:
        """The next offset of each topic partition."""
        ends: dict[str, int] = {}
        for topic, partition, _, last in self.files().values():
            name = f"{topic}/{partition}"
            ends[name] = max(ends.get(name, 0), last + 1)
        return ends

    def segments(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        out = []
        for path, (topic, partition, first, last) in sorted(self.files().items()):
            name = f"{topic}/{partition}"
            a, b = start.get(name, 0), end.get(name, 0)
            if last >= a and first < b:
                out.append(Segment(path, topic, partition, a, b))
        return out


def _rows(root: str, part: Segment) -> Iterator[pa.RecordBatch]:
    system, _ = _file_system(root)
    with system.open_input_file(part.path) as handle:
        file = pq.ParquetFile(handle)
        wanted = [i for i in range(file.num_row_groups) if file.metadata.row_group(i).num_rows
                  and _bounds(file.metadata.row_group(i))[1] >= part.start
                  and _bounds(file.metadata.row_group(i))[0] < part.end]
        for batch in file.iter_batches(row_groups=wanted, columns=["key", "value", "offset"]) if wanted else ():
            offset = batch.column("offset").cast(pa.int64())
            batch = batch.filter(pc.and_(pc.greater_equal(offset, part.start), pc.less(offset, part.end)))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").cast(pa.string()), batch.column("value").cast(pa.string()),
                 pa.array([part.topic] * n, pa.string()), pa.array([part.partition] * n, pa.int32()),
                 batch.column("offset").cast(pa.int64())], ["key", "value", "topic", "partition", "offset"])


class LogStream(DataSourceStreamReader):
    def __init__(self, options):
        self.log, self.starting = _Log(options["path"]), options.get("startingOffsets", "earliest")

    def initialOffset(self) -> dict:
        return self.log.latest() if self.starting == "latest" else {}

    def latestOffset(self) -> dict:
        return self.log.latest()

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return self.log.segments(start, end)

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _rows(self.log.root, partition)


class LogBatch(DataSourceReader):
    def __init__(self, options):
        self.log = _Log(options["path"])

    def partitions(self) -> list[Segment]:
        return self.log.segments({}, self.log.latest())

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _rows(self.log.root, partition)


class OffsetLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogStream:
        return LogStream(self.options)

    def reader(self, schema) -> LogBatch:
        return LogBatch(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known; executors need no copy of this package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        spark.dataSource.register(OffsetLog)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])


def write_log(messages: DataFrame, path: str) -> None:
    """Append messages to a log; each file holds a run of offsets."""
    (messages.select("key", "value", "topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
     .write.mode("append").partitionBy("topic", "partition").parquet(path))
