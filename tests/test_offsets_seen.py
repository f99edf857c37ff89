"""A stream that resumes by offset; I22: ids known from earlier micro-batches."""
import datetime as dt
import json

import pytest

from starledger.contracts import FACT_TRANSACTIONS
from starledger.sources.events import read_events
from starledger.sources.offsetlog import write_log
from starledger.streaming.silver_stream import run_silver_stream

COLUMNS = "key string, value string, topic string, partition int, offset long"


def value(tid, amount="10.00"):
    payload = {c: None for c in FACT_TRANSACTIONS.names} | {
        "date_key": "20240101", "time_key": "1200", "account_key": "1", "transaction_type_key": "1", "transaction_id": tid,
        "amount_minor": "1000", "amount_egp": amount, "abs_amount_egp": amount, "is_outbound": "0", "is_declined": "0",
        "is_fx": "0"}
    return json.dumps(payload)


def messages(spark, rows):
    return spark.createDataFrame([(str(o), v, t, p, o) for t, p, o, v in rows], COLUMNS)


def read_on(spark, log, checkpoint):
    """(topic, partition, offset) of what a run of the stream reads."""
    got = []
    q = (read_events(spark, "offset_log", path=log).writeStream
         .foreachBatch(lambda df, _: got.extend(df.select("topic", "partition", "offset").collect()))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(map(tuple, got))


def test_a_restart_reads_strictly_newer_offsets(spark, scratch):
    log, ck = f"{scratch}/log", f"{scratch}/ck"
    write_log(messages(spark, [("t", 0, o, "v") for o in range(10, 20)] + [("t", 1, 5, None), ("u/x", 0, 0, "v")]), log)
    assert read_on(spark, log, ck) == [("t", 0, o) for o in range(10, 20)] + [("t", 1, 5), ("u/x", 0, 0)]
    assert read_on(spark, log, ck) == []
    # one file holds older, known and newer offsets; partition 2 is new; partition 1 brings older ones only
    write_log(messages(spark, [("t", 0, o, "v") for o in (3, 15, 20, 21)] + [("t", 1, 4, "v"), ("t", 2, 0, "v")]).coalesce(1), log)
    assert read_on(spark, log, ck) == [("t", 0, 20), ("t", 0, 21), ("t", 2, 0)]
    # a fresh subscriber from the earliest offset reads all, as does a batch
    assert len(read_on(spark, log, f"{scratch}/other")) == 18
    assert read_events(spark, "offset_log", streaming=False, path=log).count() == 18


def test_a_row_without_an_offset_fails_the_read(spark, scratch):
    write_log(spark.createDataFrame([("k", "v", "t", 0, None), ("k", "v", "t", 0, 1)], COLUMNS).coalesce(1), f"{scratch}/log")
    with pytest.raises(Exception, match="without an offset"):
        read_events(spark, "offset_log", streaming=False, path=f"{scratch}/log").count()


def test_replays_in_later_batches_go_to_quarantine(spark, scratch):
    log, ck = f"{scratch}/log", f"{scratch}/ck"
    roots = {k: f"{scratch}/{k}" for k in ("silver", "quarantine", "dlq")}
    run = lambda: run_silver_stream(spark, log, roots, ck, fmt="offset_log", remember=dt.timedelta(days=7))
    big = 2**53 + 1
    write_log(messages(spark, [("t", 0, 0, value("A")), ("t", 0, 1, value("A")), ("t", 0, 2, value("B", "N/A")),
                               ("t", 0, 3, "{broken"), ("t", 0, 4, value(None)), ("t", 1, big, value("D"))]), log)
    [first] = run()
    assert first.reconciled and (first.silver_rows, first.quarantine_rows, first.dead_letters) == (2, 3, 1)
    # A and D again; B repaired; C new, twice
    write_log(messages(spark, [("t", 0, 5, value("A")), ("t", 0, 6, value("B")), ("t", 0, 7, value("C")),
                               ("t", 0, 8, value("C")), ("t", 1, big + 1, value(" D ")), ("t", 0, 9, value("A", "x"))]), log)
    [second] = run()
    assert second.reconciled and (second.silver_rows, second.quarantine_rows, second.dead_letters) == (2, 4, 0)
    from starledger.sources.layers import read_batch
    names = ["transaction_id", "_kafka_offset"]
    kept = read_batch(spark, roots["silver"], second.batch_id, names).select(*names).collect()
    assert {tuple(r) for r in kept} == {("B", 6), ("C", 7)}
    bad = read_batch(spark, roots["quarantine"], second.batch_id, [*names, "_dq_reason"]).collect()
    assert {(r[0], r[1], r["_dq_reason"]) for r in bad} == {
        ("A", 5, "duplicate_transaction_id"), ("C", 8, "duplicate_transaction_id"),
        ("D", big + 1, "duplicate_transaction_id"), ("A", 9, "invalid_or_missing_amount")}


def test_the_state_holds_what_is_remembered(spark, scratch):
    """Forgotten at once: the next batch removes the ids of the one before."""
    log, ck = f"{scratch}/log", f"{scratch}/ck"
    roots = {k: f"{scratch}/{k}" for k in ("silver", "quarantine", "dlq")}
    sizes = []
    for i in range(3):
        write_log(messages(spark, [("t", 0, 100 * i + o, value(f"{i}-{o}")) for o in range(20)]), log)
        run_silver_stream(spark, log, roots, ck, fmt="offset_log", remember=dt.timedelta(milliseconds=1))
        state = spark.read.format("statestore").load(ck)
        sizes.append(state.count())
    assert max(sizes) <= 40
