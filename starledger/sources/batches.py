"""Published batches.

Layout under a sink's ``root``::

    silver_batch_id=<id>/attempt=<a>/part-*      rows of one try to write the batch
    _manifests/silver_batch_id=<id>/000001.json  what is published: attempt, files, rows, schema

A try writes into a folder of its own.  The batch exists for readers from the
moment its manifest appears, which is the last thing written (to a hidden name,
then renamed), and only with the files that the manifest names.  So a batch that
is still being written, or whose writer died, is never listed and never read; a
replay publishes a newer manifest, and the superseded try is removed after that.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fs
from .store import write_layer

PARTITION = "silver_batch_id"


def _manifests(root: str, batch_id: str, partition_col: str) -> str:
    return f"{root}/_manifests/{partition_col}={batch_id}"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = (p.rsplit("/", 1)[-1] for p, _, _ in fs.file_info(spark, folder))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str, batch_id: str, partition_col: str = PARTITION) -> dict | None:
    """What is published of a batch; None when nothing is."""
    folder = _manifests(root, batch_id, partition_col)
    numbers = _numbers(spark, folder)
    return json.loads(fs.read_text(spark, f"{folder}/{numbers[-1]:06d}.json")) if numbers else None


def write_attempt(df: DataFrame, root: str, batch_id: str, attempt: str | None = None,
                  partition_col: str = PARTITION) -> dict:
    """Write a batch's rows without publishing them; returns its manifest."""
    attempt = attempt or uuid.uuid4().hex
    rows = df.drop(partition_col)
    path = f"{root}/{partition_col}={batch_id}/attempt={attempt}"
    info = write_layer(rows, path)
    files = fs.data_files(df.sparkSession, path)
    return {"batch_id": batch_id, "attempt": attempt, "files": files, "rows": info["rows"], "schema": rows.schema.json(),
            "path": path}


def publish(spark: SparkSession, root: str, written: dict, partition_col: str = PARTITION) -> dict:
    """Make a written try the batch; the tries before it are removed."""
    folder = _manifests(root, written["batch_id"], partition_col)
    fs.mkdirs(spark, folder)
    number = (_numbers(spark, folder) or [0])[-1] + 1
    while not fs.write_new(spark, f"{folder}/{number:06d}.json", json.dumps(written, sort_keys=True)):
        number += 1                      # another try of this batch published first
    home = f"{root}/{partition_col}={written['batch_id']}"
    for old in fs.list_dirs(spark, home):
        if old != f"attempt={written['attempt']}" and _is_older(spark, f"{home}/{old}", written["path"]):
            fs.delete(spark, f"{home}/{old}")
    return written


def _is_older(spark: SparkSession, folder: str, published: str) -> bool:
    """Finished before the published try; one that is still being written stays."""
    done = [t for p, _, t in fs.file_info(spark, folder) if p.endswith("/_SUCCESS")]
    return bool(done) and done[0] <= max(t for _, _, t in fs.file_info(spark, published))


def write_batch_partition(df: DataFrame, root: str, batch_id: str, partition_col: str = PARTITION) -> dict:
    """Write one batch and publish it, replacing only what was published
    of that batch.  A replay whose side has become empty publishes an empty batch."""
    return publish(df.sparkSession, root, write_attempt(df, root, batch_id, None, partition_col), partition_col)


def list_batches(spark: SparkSession, root: str, partition_col: str = PARTITION) -> list[str]:
    """Ids of the published batches, in order (no data is scanned)."""
    prefix = f"{partition_col}="
    folders = [d for d in fs.list_dirs(spark, f"{root}/_manifests") if d.startswith(prefix)]
    return sorted(d[len(prefix):] for d in folders if _numbers(spark, f"{root}/_manifests/{d}"))


def read_batch(spark: SparkSession, root: str, batch_id: str, columns: list[str],
               partition_col: str = PARTITION) -> DataFrame:
    """Exactly one published batch: the files of its manifest, only the
    needed columns."""
    m = manifest(spark, root, batch_id, partition_col)
    if m is None:
        raise FileNotFoundError(f"no batch {batch_id!r} is published in {root}")
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    df = spark.read.schema(schema).parquet(*m["files"]) if m["files"] else spark.createDataFrame([], schema)
    return df.select(*columns, F.lit(batch_id).alias(partition_col))


def unpublished(spark: SparkSession, root: str, partition_col: str = PARTITION) -> list[str]:
    """Folders of tries that no manifest names: being written, or left over."""
    out = []
    for d in fs.list_dirs(spark, root):
        if d.startswith(f"{partition_col}="):
            m = manifest(spark, root, d[len(partition_col) + 1:], partition_col)
            out += [f"{root}/{d}/{a}" for a in fs.list_dirs(spark, f"{root}/{d}") if m is None or a != f"attempt={m['attempt']}"]
    return out


def sweep(spark: SparkSession, root: str, older_than_s: float, partition_col: str = PARTITION) -> list[str]:
    """Remove tries that were never published and whose newest file is older
    than ``older_than_s`` (longer than any writer may take); returns them."""
    import time

    gone = []
    for path in unpublished(spark, root, partition_col):
        newest = max((t for _, _, t in fs.file_info(spark, path)), default=0)
        if newest < (time.time() - older_than_s) * 1000:
            fs.delete(spark, path)
            gone.append(path)
    return gone
