"""Versioned Parquet store with an atomic commit pointer.

Layout under ``root``::

    v000001-<attempt>/<table>/part-*   data of version 1 (only tables it rewrote)
    _commits/000001.json               commit record: table -> path, meta, audit row
    _failed/<ts>-<batch>.json          failed attempts (never part of a commit)

A version becomes visible only when its commit file is created; creation
with ``overwrite=false`` is atomic on HDFS / local disk, so two writers can
not both win and a crash before the commit leaves the previous version
intact.  Every attempt writes into a folder of its own, so a writer that loses
never touches the winner's files.  Readers resolve paths through the newest
commit and never read a folder that is being written.  On an object store
without create-if-absent (S3 through S3A before conditional writes) the commit
itself needs a single writer or a lock; the data folders are safe there too.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fs


@dataclass
class Partitioned:
    """A partitioned table write.  ``df`` holds the rows of the partitions being
    written and carries ``column`` (a derived value such as the month of a date
    key; it is kept in folder names, not in the files).  ``replace`` lists the
    partition values this write replaces; ``None`` rewrites the whole table.
    Partitions not replaced are carried from the previous version by reference."""
    df: DataFrame
    column: str
    replace: list | None = None
    sort_by: tuple = ()
    positional: dict | None = None   # {"column", "pid", "pos", "start"}: key derived from row positions
    max_key: int | None = None       # largest surrogate key after this write (kept in the commit record)
    bloom: tuple = ()                # columns looked up by value: Parquet Bloom filters per row group
    index_of: str | None = None      # table this one indexes: dropped when that one is written without it
    options: dict | None = None      # further write options


class CommitConflict(RuntimeError):
    pass


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- reading -----------------------------------------------------------
    def _commit_path(self, version: int) -> str:
        return f"{self.root}/_commits/{version:06d}.json"

    def versions(self) -> list[int]:
        info = fs.file_info(self.spark, f"{self.root}/_commits")
        out = []
        for path, _, _ in info:
            name = path.rsplit("/", 1)[-1]
            if name.endswith(".json") and name[:-5].isdigit():
                out.append(int(name[:-5]))
        return sorted(out)

    def current_version(self) -> int:
        v = self.versions()
        return v[-1] if v else 0

    def manifest(self, version: int | None = None) -> dict:
        version = self.current_version() if version is None else version
        if version == 0:
            return {"version": 0, "tables": {}, "meta": {}}
        return json.loads(fs.read_text(self.spark, self._commit_path(version)))

    def table_path(self, table: str, version: int | None = None) -> str:
        m = self.manifest(version)
        if table not in m["tables"]:
            raise FileNotFoundError(f"table {table!r} not in store {self.root} version {m['version']}")
        return m["tables"][table]

    def _read_entry(self, entry, parts: list | None = None) -> DataFrame:
        if isinstance(entry, str):
            return self.spark.read.parquet(entry)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        paths = [p for v, p in sorted(entry["parts"].items()) if parts is None or v in {str(x) for x in parts}]
        df = (self.spark.read.schema(schema).parquet(*paths) if paths
              else self.spark.createDataFrame([], schema))
        pk = entry.get("positional")
        if pk:
            # rows from a reload carry (partition, position); rows written later
            # carry an explicit key (see operators/surrogate.positions)
            from ..operators.surrogate import positional_key
            key = F.coalesce(F.col(pk["column"]), positional_key(pk["offsets"], pk["start"], pk["pid"], pk["pos"]))
            cols = [key.alias(c) if c == pk["column"] else F.col(c) for c in df.columns
                    if c not in (pk["pid"], pk["pos"])]
            df = df.select(*cols)
        return df

    def read(self, table: str, version: int | None = None, parts: list | None = None) -> DataFrame:
        """A table of a version; for partitioned tables ``parts`` restricts the
        read to those partition values (only their folders are listed)."""
        return self._read_entry(self.table_path(table, version), parts)

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        m = self.manifest(version)
        return {t: self._read_entry(e) for t, e in m["tables"].items()}

    def partitions(self, table: str, version: int | None = None) -> list[str]:
        e = self.table_path(table, version)
        return [] if isinstance(e, str) else sorted(e["parts"])

    def _write_partitioned(self, spec: Partitioned, path: str, previous) -> dict:
        df = spec.df
        if spec.sort_by:
            # range clustering: several tasks per partition value, few files each
            # (led by the partition column, the order is the writer's own: it
            # sorts no second time, which would also lose the order inside)
            df = df.repartitionByRange(*spec.sort_by).sortWithinPartitions(spec.column, *spec.sort_by)
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in spec.bloom if c in df.columns}
        df.write.mode("overwrite").options(**filters, **(spec.options or {})).partitionBy(spec.column).parquet(path)
        prefix = f"{spec.column}="
        written = {d[len(prefix):]: f"{path}/{d}" for d in fs.list_dirs(self.spark, path) if d.startswith(prefix)}
        parts = {}
        if spec.replace is not None and isinstance(previous, dict):
            dropped = {str(v) for v in spec.replace}
            parts = {v: p for v, p in previous["parts"].items() if v not in dropped}
        parts.update(written)
        schema = T.StructType([f for f in spec.df.schema.fields if f.name != spec.column])
        entry = {"partition_column": spec.column, "parts": parts, "schema": schema.json()}
        if spec.index_of:
            entry["index_of"] = spec.index_of
        if spec.positional:
            from ..operators.surrogate import offsets_of
            p = spec.positional
            tags = self.spark.read.parquet(*written.values()).select(p["pid"]) if written else None
            offsets, total = offsets_of(tags, p["pid"]) if tags is not None else ([], 0)
            entry["positional"] = {**p, "offsets": offsets}
            entry["max_key"] = p["start"] - 1 + total
        elif spec.replace is not None and isinstance(previous, dict) and previous.get("positional"):
            # carried months keep positional keys; rewritten months store explicit keys
            entry["positional"] = previous["positional"]
            entry["schema"] = previous["schema"]
        if spec.max_key is not None:
            entry["max_key"] = int(spec.max_key)
        return entry

    # -- writing -----------------------------------------------------------
    def commit(self, frames: dict[str, DataFrame | Partitioned], meta: dict | Callable[[], dict] | None = None,
               writers: dict[str, Callable[[DataFrame, str], None]] | None = None,
               check: Callable[[dict[str, DataFrame]], None] | None = None,
               expected_version: int | None = None,
               derived: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] | None = None) -> int:
        """Write ``frames`` into a new version folder, run ``check`` on the
        written tables, then publish one commit record.  ``derived`` tables are
        made from the written ones and written after them.  Tables not in
        either are carried over from the current version by reference.  A
        callable ``meta`` is asked after the data has been written.  The record
        also carries the ids of all batches loaded so far."""
        base = self.current_version()
        if expected_version is not None and base != expected_version:
            raise CommitConflict(f"store moved from {expected_version} to {base}")
        new = base + 1
        parent = self.manifest(base)
        new_tables = {*frames, *(derived or {})}
        paths = {name: e for name, e in parent["tables"].items()
                 if name in new_tables or isinstance(e, str) or e.get("index_of") not in new_tables}
        folder = f"{self.root}/v{new:06d}-{uuid.uuid4().hex}"

        def write(item):
            name, df = item
            path = f"{folder}/{name}"
            if isinstance(df, Partitioned):
                return name, self._write_partitioned(df, path, paths.get(name))
            (writers or {}).get(name, _default_writer)(df, path)
            return name, path

        # the tables of one version are independent jobs: submit them together
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=max(1, min(8, len(frames)))) as pool:
            for name, entry in pool.map(write, list(frames.items())):
                paths[name] = entry
        for name, make in (derived or {}).items():
            _, paths[name] = write((name, make({t: self._read_entry(paths[t]) for t in frames})))
        if check is not None:
            check({t: self._read_entry(e) for t, e in paths.items()})
        meta = (meta() if callable(meta) else meta) or {}
        audit = meta.get("audit") or {}
        batches = set(parent.get("batches", []))
        if audit.get("status") == "SUCCESS":
            batches.add(audit["silver_batch_id"])
        record = {"version": new, "parent": base, "tables": paths, "meta": meta, "batches": sorted(batches),
                  "committed_at_utc": dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")}
        try:
            fs.mkdirs(self.spark, f"{self.root}/_commits")
            fs.write_text(self.spark, self._commit_path(new), json.dumps(record, sort_keys=True), overwrite=False)
        except Exception as e:  # another writer created the same version first
            raise CommitConflict(f"version {new} already committed in {self.root}") from e
        return new

    def record_failure(self, meta: dict) -> None:
        ts = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        fs.mkdirs(self.spark, f"{self.root}/_failed")
        fs.write_text(self.spark, f"{self.root}/_failed/{ts}.json", json.dumps(meta, sort_keys=True, default=str))

    def commit_log(self) -> list[dict]:
        return [self.manifest(v) for v in self.versions()]

    def failures(self) -> list[dict]:
        out = []
        for path, _, _ in fs.file_info(self.spark, f"{self.root}/_failed"):
            if path.endswith(".json"):
                out.append(json.loads(fs.read_text(self.spark, path)))
        return out


def _default_writer(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None) -> dict:
    """Idempotent full-refresh Parquet sink; the row count is observed
    on the write itself (no second job)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation("write_layer")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return {"path": path, "rows": int(obs.get["rows"])}
