"""Store commits, streaming and
the merge runner end to end on small frames."""
import json
import os

import pytest
from pyspark.sql import functions as F

from starledger.contracts import FACT_TRANSACTIONS
from starledger.operators import quality
from starledger.sources.layers import list_batches, read_batch
from starledger.sources.store import CommitConflict, VersionedStore
from starledger.streaming.merge_runner import audit_log, merge_batch, run_merge
from starledger.streaming.silver_stream import run_silver_stream


def test_versioned_commit_and_conflict(spark, scratch):
    st = VersionedStore(spark, f"{scratch}/store")
    v1 = st.commit({"a": spark.range(3), "b": spark.range(2)})
    v2 = st.commit({"a": spark.range(5)}, expected_version=v1)
    assert (v1, v2) == (1, 2)
    assert st.read("a").count() == 5 and st.read("b").count() == 2 and st.read("a", 1).count() == 3
    with pytest.raises(CommitConflict):
        st.commit({"a": spark.range(1)}, expected_version=1)


def test_derived_tables_are_made_of_the_written_ones(spark, scratch):
    """The layers' events are joined once: the second layer reads the first."""
    st = VersionedStore(spark, f"{scratch}/derived")
    st.commit({"old": spark.range(4)})
    files = []

    def half(written):
        files.extend(written["a"].inputFiles())
        return written["a"].where("id % 2 = 0")

    st.commit({"a": spark.range(6)}, derived={"b": half})
    assert files and all("/a/" in f for f in files)
    assert sorted(r.id for r in st.read("b").collect()) == [0, 2, 4]
    assert set(st.tables()) == {"a", "b", "old"}


def test_gate_blocks_commit(spark, scratch):
    st = VersionedStore(spark, f"{scratch}/store")

    def check(tables):
        if tables["a"].where("id > 1").count():
            raise quality.GateFailed("bad")
    with pytest.raises(quality.GateFailed):
        st.commit({"a": spark.range(3)}, check=check)
    assert st.current_version() == 0                          # nothing published


def _messages(path, start, n, poison=()):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/m{start:06d}.json", "w") as f:
        for o in range(start, start + n):
            if o in poison:
                value = "{broken"
            else:
                payload = {c: None for c in FACT_TRANSACTIONS.names}
                payload.update(date_key="20240101", time_key="1200", account_key="1", transaction_type_key="1",
                               transaction_id=f"T{o % 7}", amount_minor="1000", amount_egp="10.00",
                               abs_amount_egp="10.00", is_outbound="0", is_declined="0", is_fx="0",
                               merchant_key="1")
                if o % 11 == 0:
                    payload["amount_egp"] = "N/A"
                value = json.dumps(payload)
            f.write(json.dumps({"key": str(o), "value": value, "topic": "t", "partition": 0, "offset": o}) + "\n")


def test_stream_and_merge_runner(spark, scratch):
    src, ck = f"{scratch}/src", f"{scratch}/ck"
    roots = {k: f"{scratch}/{k}" for k in ("silver", "quarantine", "dlq", "bronze")}
    _messages(src, 0, 20, poison={3})
    s1 = run_silver_stream(spark, src, roots, ck)
    assert len(s1) == 1 and s1[0].reconciled and s1[0].dead_letters == 1
    assert run_silver_stream(spark, src, roots, ck) == []       # I5: nothing new -> no batch
    _messages(src, 20, 10)
    s2 = run_silver_stream(spark, src, roots, ck)
    assert len(s2) == 1 and s2[0].messages == 10
    assert list_batches(spark, roots["silver"]) == sorted([s1[0].batch_id, s2[0].batch_id])
    assert read_batch(spark, roots["silver"], s1[0].batch_id, ["transaction_id"]).count() == s1[0].silver_rows

    # gold store with empty fact + dims, then the backlog merge
    store = VersionedStore(spark, f"{scratch}/gold")
    one = lambda c: spark.createDataFrame([(1,)], f"{c} int")
    empty_fact = spark.createDataFrame([], FACT_TRANSACTIONS.schema()).withColumn("transaction_sk", F.lit(1).cast("long"))
    store.commit({"fact_transactions": empty_fact, "dim_date": spark.createDataFrame([(20240101,)], "date_key int"),
                  "dim_time": spark.createDataFrame([(1200,)], "time_key int"), "dim_account": one("account_key"),
                  "dim_transaction_type": one("transaction_type_key"),
                  "dim_decline_reason": one("decline_reason_key"), "dim_merchant": one("merchant_key")})
    res = run_merge(spark, store, roots["silver"], f"{scratch}/reject")
    assert res["ok"] and len(res["batches"]) == 2
    fact = store.read("fact_transactions")
    assert fact.count() == 7 and fact.select("transaction_sk").distinct().count() == 7
    t = res["totals"]
    assert t["rows_valid"] + t["rows_rejected"] == t["rows_staged"]              # I20
    assert t["rows_inserted"] + t["rows_updated"] <= t["rows_valid"]
    again = run_merge(spark, store, roots["silver"], f"{scratch}/reject")      # I10: replay is a no-op
    assert again["batches"] == [] and store.read("fact_transactions").count() == 7
    skipped = merge_batch(spark, store, roots["silver"], s1[0].batch_id, f"{scratch}/reject")
    assert skipped["status"] == "SKIPPED"
    log = audit_log(spark, store).collect()
    assert sorted(r.status for r in log) == ["SUCCESS", "SUCCESS"]


def test_partition_scoped_upsert(spark, scratch):
    """Only months holding the old or new version of a changed row are rewritten."""
    from decimal import Decimal

    from starledger.functions.keys import month_key
    from starledger.sources.store import Partitioned
    from starledger.streaming.merge_runner import upsert_partitions

    cols = FACT_TRANSACTIONS.names

    def fact_row(tid, date_key, amount="10.00"):
        r = {c: None for c in cols}
        r.update(date_key=date_key, time_key=1200, account_key=1, transaction_type_key=1, transaction_id=tid,
                 amount_minor=1000, amount_egp=Decimal(amount), abs_amount_egp=Decimal(amount), is_outbound=0,
                 is_declined=0, is_fx=0)
        return tuple(r[c] for c in cols)

    base = spark.createDataFrame([fact_row("A", 20240105), fact_row("B", 20240210), fact_row("C", 20240315),
                                  fact_row("D", 20240420)], FACT_TRANSACTIONS.schema())
    base = base.withColumn("transaction_sk", F.monotonically_increasing_id() + 1)
    st = VersionedStore(spark, f"{scratch}/gold")
    v1 = st.commit({"fact_transactions": Partitioned(base.withColumn("date_month", month_key("date_key")),
                                                     "date_month")})
    old_parts = st.manifest(v1)["tables"]["fact_transactions"]["parts"]
    batch = spark.createDataFrame([fact_row("B", 20240312),              # moves Feb -> Mar
                                   fact_row("C", 20240315, "11.00"),     # update in place (Mar)
                                   fact_row("D", 20240420),              # identical replay
                                   fact_row("E", 20240601)], FACT_TRANSACTIONS.schema())   # new month
    spec, merged = upsert_partitions(st, v1, batch)
    assert sorted(spec.replace) == [202402, 202403, 202406]
    v2 = st.commit({"fact_transactions": spec})
    parts = st.manifest(v2)["tables"]["fact_transactions"]["parts"]
    assert parts["202401"] == old_parts["202401"] and parts["202404"] == old_parts["202404"]   # carried
    assert "202402" not in parts and parts["202403"] != old_parts["202403"]
    rows = {r.transaction_id: (r.date_key, str(r.amount_egp), r.transaction_sk)
            for r in st.read("fact_transactions").collect()}
    sk_before = {r.transaction_id: r.transaction_sk for r in base.collect()}
    assert rows["B"] == (20240312, "10.00", sk_before["B"]) and rows["C"][1] == "11.00"
    assert rows["E"][2] == max(sk_before.values()) + 1 and len(rows) == 5
    assert {r._action: 1 for r in merged.collect()}.keys() == {"UPDATE", "NOOP", "INSERT"}


def test_failed_batch_is_logged_and_reraised(spark, scratch):
    """A failing batch leaves no commit, records FAILED, stops the loop."""
    src, ck = f"{scratch}/src", f"{scratch}/ck"
    roots = {k: f"{scratch}/{k}" for k in ("silver", "quarantine", "dlq")}
    _messages(src, 0, 5)
    run_silver_stream(spark, src, roots, ck)
    store = VersionedStore(spark, f"{scratch}/gold")
    store.commit({"dim_date": spark.createDataFrame([(20240101,)], "date_key int")})   # no fact, no dims
    res = run_merge(spark, store, roots["silver"], f"{scratch}/reject")
    assert not res["ok"] and res["failed"] is not None and res["batches"] == []
    assert store.current_version() == 1
    log = audit_log(spark, store).collect()
    assert [r.status for r in log] == ["FAILED"] and log[0].error_message


def test_positional_keys_survive_upserts(spark, scratch):
    """I17 + I13: reload keys come from (partition, position) + manifest offsets;
    an upsert rewrites touched months with explicit keys, the rest stay."""
    from pyspark.sql import Window

    from starledger.plans.adapter import Star
    from starledger.plans.gold import reload_gold
    from starledger.streaming.merge_runner import upsert_partitions

    st = VersionedStore(spark, f"{scratch}/gold")
    v1 = reload_gold(spark, Star(spark, "/root/testdata/sf0.001").tables(), st)
    fact = st.read("fact_transactions")
    assert "_sk_pid" not in fact.columns
    chk = fact.withColumn("rn", F.row_number().over(Window.orderBy("transaction_id")))
    assert chk.where("rn != transaction_sk").count() == 0
    before = {r.transaction_id: r.transaction_sk for r in fact.collect()}
    n = len(before)
    first = fact.orderBy("transaction_id").limit(1).collect()[0].asDict()
    changed = dict(first, amount_egp=first["amount_egp"] + 1, transaction_sk=None)
    new = dict(first, transaction_id="TXN9999999999", transaction_sk=None)
    batch = spark.createDataFrame([changed, new], fact.schema).select(*FACT_TRANSACTIONS.names)
    spec, _ = upsert_partitions(st, v1, batch)
    st.commit({"fact_transactions": spec})
    after = {r.transaction_id: r.transaction_sk for r in st.read("fact_transactions").collect()}
    assert len(after) == n + 1 and after["TXN9999999999"] == n + 1
    assert all(after[k] == v for k, v in before.items())        # every existing key is kept


def test_max_key_kept_in_commit_record(spark, scratch):
    from starledger.plans.adapter import Star
    from starledger.plans.gold import reload_gold
    st = VersionedStore(spark, f"{scratch}/gold")
    v = reload_gold(spark, Star(spark, "/root/testdata/sf0.001").tables(), st)
    entry = st.table_path("fact_transactions", v)
    assert entry["max_key"] == st.read("fact_transactions").count()


def test_losing_writer_leaves_the_published_rows(spark, scratch):
    """Two writers build the same version; the loser writes after the winner."""
    st = VersionedStore(spark, f"{scratch}/race")
    st.commit({"a": spark.range(1)})

    def slower(tables):
        VersionedStore(spark, st.root).commit({"a": spark.range(7)})
    with pytest.raises(CommitConflict):
        st.commit({"a": spark.range(3)}, check=slower)
    assert st.current_version() == 2 and st.read("a").count() == 7


def test_lost_checkpoint_loses_no_rows(spark, scratch):
    src, roots = f"{scratch}/src", {k: f"{scratch}/{k}" for k in ("silver", "quarantine", "dlq", "bronze")}
    _messages(src, 0, 5)
    first = run_silver_stream(spark, src, roots, f"{scratch}/ck1")
    # a new source folder and a new checkpoint: epochs start at 0 again
    _messages(f"{scratch}/src2", 5, 5)
    second = run_silver_stream(spark, f"{scratch}/src2", roots, f"{scratch}/ck2")
    assert first[0].batch_id != second[0].batch_id and first[0].batch_id == "b_000000000_000000004"
    rows = spark.read.parquet(roots["silver"]).count() + spark.read.parquet(roots["quarantine"]).count()
    assert rows == 10
    again = run_silver_stream(spark, src, roots, f"{scratch}/ck3")          # a replay overwrites its own batch
    assert again[0].batch_id == first[0].batch_id
    assert spark.read.parquet(roots["silver"]).count() + spark.read.parquet(roots["quarantine"]).count() == 10


def test_replayed_and_offsetless_messages(spark, scratch):
    src, roots = f"{scratch}/src", {k: f"{scratch}/{k}" for k in ("silver", "quarantine", "dlq")}
    _messages(src, 1, 3)
    lines = open(f"{src}/m000001.json").read().splitlines()
    with open(f"{src}/m000009.json", "w") as f:
        f.write(lines[0] + "\n" + json.dumps({**json.loads(lines[1]), "offset": None}) + "\n")
    run_silver_stream(spark, src, roots, f"{scratch}/ck")
    assert spark.read.parquet(roots["silver"]).count() == 3
    reasons = sorted(r["_dq_reason"] for r in spark.read.parquet(roots["quarantine"]).collect())
    assert reasons == ["duplicate_transaction_id", "missing_kafka_offset"]


def test_offsets_of_many_partitions_stay_one_literal(spark):
    import time

    from starledger.operators.surrogate import positional_key
    offsets = [i * 3 for i in range(50_000)]
    t = time.time()
    key = positional_key(offsets, 1)
    assert time.time() - t < 2
    rows = spark.createDataFrame([(0, 5), (49_999, 1), (300, 0)], "_sk_pid int, _sk_pos long").select(key.alias("k")).collect()
    assert [r["k"] for r in rows] == [6, 1 + 49_999 * 3 + 1, 901]
