"""Only published batches are listed, read and merged."""
import os

import pytest
from pyspark.sql import functions as F

from starledger.contracts import FACT_TRANSACTIONS
from starledger.sources import batches as B
from starledger.sources.store import VersionedStore
from starledger.streaming import silver_stream
from starledger.streaming.merge_runner import run_merge
from test_store_stream import _messages


def gold(spark, path):
    store = VersionedStore(spark, path)
    one = lambda c: spark.createDataFrame([(1,)], f"{c} int")
    fact = spark.createDataFrame([], FACT_TRANSACTIONS.schema()).withColumn("transaction_sk", F.lit(1).cast("long"))
    store.commit({"fact_transactions": fact, "dim_date": spark.createDataFrame([(20240101,)], "date_key int"),
                  "dim_time": spark.createDataFrame([(1200,)], "time_key int"), "dim_account": one("account_key"),
                  "dim_transaction_type": one("transaction_type_key"),
                  "dim_decline_reason": one("decline_reason_key"), "dim_merchant": one("merchant_key")})
    return store


def test_a_writer_stopped_half_way(spark, scratch, monkeypatch):
    """The silver rows lie on disk, but the writer dies before it publishes:
    nothing is merged; the replay publishes them and the next run merges all."""
    src, roots = f"{scratch}/src", {k: f"{scratch}/{k}" for k in ("silver", "quarantine", "dlq", "bronze")}
    _messages(src, 0, 7)
    messages = silver_stream.read_events(spark, "json", streaming=False, path=src)

    def dies(*_):
        raise OSError("executor lost")
    with monkeypatch.context() as m:
        m.setattr(silver_stream, "publish", dies)
        with pytest.raises(OSError):
            silver_stream.process_batch(messages, None, roots)
    assert len(B.unpublished(spark, roots["silver"])) == 1 and B.list_batches(spark, roots["silver"]) == []
    store = gold(spark, f"{scratch}/gold")
    assert run_merge(spark, store, roots["silver"], f"{scratch}/reject")["batches"] == []
    summary = silver_stream.process_batch(messages, None, roots)
    done = run_merge(spark, store, roots["silver"], f"{scratch}/reject")
    assert [b["silver_batch_id"] for b in done["batches"]] == [summary.batch_id] and done["totals"]["rows_staged"] == 6
    assert store.read("fact_transactions").count() == 6
    assert run_merge(spark, store, roots["silver"], f"{scratch}/reject")["batches"] == []


def test_folder_of_a_running_writer_is_no_batch(spark, scratch):
    root = f"{scratch}/silver"
    os.makedirs(f"{root}/silver_batch_id=b1/attempt=a/_temporary/0/task_1")
    os.makedirs(f"{root}/_manifests/silver_batch_id=b2")
    assert B.list_batches(spark, root) == []
    with pytest.raises(FileNotFoundError, match="no batch 'b1'"):
        B.read_batch(spark, root, "b1", ["x"])


def test_readers_see_the_files_of_the_manifest_alone(spark, scratch):
    root, df = f"{scratch}/silver", spark.range(5).withColumnRenamed("id", "x")
    B.write_batch_partition(df, root, "b1")
    m = B.manifest(spark, root, "b1")
    assert m["rows"] == 5 and all("/attempt=" in f and f.endswith(".parquet") for f in m["files"])
    later = B.write_attempt(df.where("x < 2"), root, "b1")                  # a replay under way
    df.write.parquet(f"{root}/silver_batch_id=b1/attempt={m['attempt']}/stray")
    assert B.read_batch(spark, root, "b1", ["x"]).count() == 5
    assert B.unpublished(spark, root) == [later["path"]]
    B.publish(spark, root, later)
    assert sorted(r["x"] for r in B.read_batch(spark, root, "b1", ["x"]).collect()) == [0, 1]
    assert B.unpublished(spark, root) == [] and B.manifest(spark, root, "b1")["attempt"] == later["attempt"]


def test_two_writers_of_one_batch(spark, scratch):
    root, df = f"{scratch}/silver", spark.range(4).withColumnRenamed("id", "x")
    a, b = (B.write_attempt(df, root, "b1", name) for name in "ab")
    B.publish(spark, root, a)
    B.publish(spark, root, b)
    assert B.list_batches(spark, root) == ["b1"] and B.read_batch(spark, root, "b1", ["x"]).count() == 4


def test_empty_batches_and_pruning(spark, scratch):
    root = f"{scratch}/silver"
    B.write_batch_partition(spark.createDataFrame([], "x int, y string"), root, "b1")
    got = B.read_batch(spark, root, "b1", ["x"])
    assert got.columns == ["x", "silver_batch_id"] and got.count() == 0
    B.write_batch_partition(spark.createDataFrame([(1, "a")], "x int, y string"), root, "b0")
    assert B.list_batches(spark, root) == ["b0", "b1"]
    plan = B.read_batch(spark, root, "b0", ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:int>" in plan


def test_sweep_removes_old_tries_only(spark, scratch):
    root, df = f"{scratch}/silver", spark.range(3)
    B.write_batch_partition(df, root, "b1")
    lost = B.write_attempt(df, root, "b2")
    assert B.sweep(spark, root, 3600) == [] and B.sweep(spark, root, -60) == [lost["path"]]
    assert B.unpublished(spark, root) == [] and B.read_batch(spark, root, "b1", ["id"]).count() == 3
