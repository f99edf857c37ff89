"""Quality split, pre-merge rules, upsert."""
from pyspark.sql import functions as F

from starledger.contracts import FACT_TRANSACTIONS
from starledger.operators.merge import action_counts, merge_fact, merge_rows
from starledger.operators.validate import split_quality, validate_batch

SCHEMA = ("date_key int, time_key int, account_key int, peer_account_key int, transaction_type_key int, "
          "decline_reason_key int, merchant_key int, transaction_id string, mc_transaction_id string, "
          "ach_transfer_id string, amount_minor long, amount_egp decimal(18,2), abs_amount_egp decimal(18,2), "
          "fx_amount_minor long, exchange_rate_e6 long, is_outbound int, is_declined int, is_fx int, "
          "_kafka_partition int, _kafka_offset long, _silver_processed_at_utc string")


def row(tid, off, **kw):
    from decimal import Decimal
    base = dict(date_key=20240101, time_key=1200, account_key=1, peer_account_key=None, transaction_type_key=1,
                decline_reason_key=None, merchant_key=1, transaction_id=tid, mc_transaction_id=None,
                ach_transfer_id=None, amount_minor=1000, amount_egp=Decimal("10.00"),
                abs_amount_egp=Decimal("10.00"), fx_amount_minor=None, exchange_rate_e6=None, is_outbound=0,
                is_declined=0, is_fx=0, _kafka_partition=0, _kafka_offset=off, _silver_processed_at_utc="T")
    base.update(kw)
    return tuple(base[c.split()[0]] for c in SCHEMA.split(", "))


def dims(spark):
    one = lambda name, col: spark.createDataFrame([(v,) for v in (1, 1200, 20240101)], f"{col} int")
    return {"dim_date": spark.createDataFrame([(20240101,)], "date_key int"),
            "dim_time": spark.createDataFrame([(1200,)], "time_key int"),
            "dim_account": spark.createDataFrame([(1,)], "account_key int"),
            "dim_transaction_type": spark.createDataFrame([(1,)], "transaction_type_key int"),
            "dim_decline_reason": spark.createDataFrame([(1,)], "decline_reason_key int"),
            "dim_merchant": spark.createDataFrame([(1,)], "merchant_key int"), "_": one("x", "k")}


def test_silver_rules_first_wins_and_duplicates(spark):
    rows = [row(None, 1, date_key=None), row("A", 2, date_key=None, amount_egp=None), row("B", 3, amount_egp=None),
            row("C", 5), row("C", 4), row("D", 6)]
    df = spark.createDataFrame(rows, SCHEMA)
    clean, quarantine = split_quality(df)
    reasons = {(r.transaction_id, r._kafka_offset): r._dq_reason for r in quarantine.collect()}
    assert reasons == {(None, 1): "missing_transaction_id", ("A", 2): "invalid_or_missing_date_key",
                       ("B", 3): "invalid_or_missing_amount", ("C", 5): "duplicate_transaction_id"}
    assert sorted((r.transaction_id, r._kafka_offset) for r in clean.collect()) == [("C", 4), ("D", 6)]
    assert clean.count() + quarantine.count() == df.count()          # I8


def test_pre_merge_rules(spark):
    rows = [row(" ", 1), row("DUP", 2), row("DUP", 3, date_key=None),           # X7: newest copy invalid
            row("K", 4, time_key=None), row("M", 5, abs_amount_egp=None), row("FD", 6, date_key=20990101),
            row("FT", 7, time_key=2359), row("FA", 8, account_key=9), row("FP", 9, peer_account_key=9),
            row("FY", 10, transaction_type_key=9), row("FR", 11, decline_reason_key=9),
            row("FM", 12, merchant_key=9), row("OK", 13, merchant_key=None, peer_account_key=1)]
    out = {r._kafka_offset: r.reject_reason
           for r in validate_batch(spark.createDataFrame(rows, SCHEMA), dims(spark)).collect()}
    assert out == {1: "null_transaction_id", 2: "duplicate_transaction_id_in_staging", 3: "missing_required_key",
                   4: "missing_required_key", 5: "null_measure", 6: "fk_date_not_found", 7: "fk_time_not_found",
                   8: "fk_account_not_found", 9: "fk_peer_account_not_found", 10: "fk_txn_type_not_found",
                   11: "fk_decline_reason_not_found", 12: "fk_merchant_not_found", 13: None}


def test_merge_cases(spark):
    from decimal import Decimal
    cols = FACT_TRANSACTIONS.names
    t = spark.createDataFrame([row("SAME", 0), row("CHG", 0), row("N2V", 0), row("V2N", 0, mc_transaction_id="x"),
                               row("MOVE", 0), row("UNTOUCHED", 0)], SCHEMA).select(*cols) \
        .withColumn("transaction_sk", F.monotonically_increasing_id() + 1)
    b = spark.createDataFrame([row("SAME", 1), row("CHG", 1, amount_egp=Decimal("11.00")),
                               row("N2V", 1, mc_transaction_id="y"), row("V2N", 1), row("MOVE", 1, date_key=20240102),
                               row("NEW", 1)], SCHEMA).select(*cols)
    compare = [c for c in cols if c != "transaction_id"]
    merged = merge_rows(t.drop("transaction_sk"), b, "transaction_id", compare)
    acts = {r.transaction_id: r._action for r in merged.collect()}
    assert acts == {"SAME": "NOOP", "CHG": "UPDATE", "N2V": "UPDATE", "V2N": "UPDATE", "MOVE": "UPDATE",
                    "NEW": "INSERT", "UNTOUCHED": "KEEP"}
    assert {r._action: r.rows for r in action_counts(merged).collect()} == {"NOOP": 1, "UPDATE": 4, "INSERT": 1}
    fact, _ = merge_fact(t, b, "transaction_id", compare)
    sk = {r.transaction_id: r.transaction_sk for r in fact.collect()}
    assert fact.count() == 7 and sk["NEW"] == max(v for k, v in sk.items() if k != "NEW") + 1
    # replay of the same batch changes nothing
    again = merge_rows(fact.drop("transaction_sk"), b, "transaction_id", compare)
    assert {r._action for r in again.where("_action != 'KEEP'").collect()} == {"NOOP"}


def moved(df):
    """The names of the columns that each shuffle by the id moves."""
    todo, out = [df._jdf.queryExecution().executedPlan().initialPlan()], []
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "hashpartitioning(transaction_id" in node.toString().splitlines()[0]:
            out.append({node.output().apply(i).name() for i in range(node.output().size())})
    return out


def test_rows_are_judged_before_they_are_moved(spark, scratch):
    """To find duplicates a row carries one number for what it fails by itself, not its keys and measures."""
    rows = [row("A", 1), row("A", 2, merchant_key=9), row("B", 3, merchant_key=9), *[row(f"X{i * 7919 % 99991}", i) for i in range(100, 4100)]]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{scratch}/b")
    batch = spark.read.parquet(f"{scratch}/b")
    few = dims(spark)
    for name in [n for n in few if n != "_"]:
        few[name].coalesce(1).write.parquet(f"{scratch}/{name}")
        few[name] = spark.read.parquet(f"{scratch}/{name}")
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    got = {}
    try:
        for limit in ("4k", "-1"):
            spark.conf.set(key, limit)
            v = validate_batch(batch, few)
            assert v.columns == [*batch.columns, "reject_reason"]
            got[limit] = sorted((r._kafka_offset, r.reject_reason) for r in v.where("_kafka_offset < 100 OR reject_reason IS NOT NULL").collect())
            out = v.select("_kafka_partition", "_kafka_offset", "transaction_id", "reject_reason")
            carried = set().union(*[names for names in moved(out) if "_salt" in names])
            assert "_kafka_offset" in carried and not carried & {"amount_minor", "amount_egp", "abs_amount_egp"}
            assert ("merchant_key" in carried) == (limit == "-1")
    finally:
        spark.conf.set(key, before)
    assert got["4k"] == got["-1"] == [(1, "duplicate_transaction_id_in_staging"), (2, "fk_merchant_not_found"), (3, "fk_merchant_not_found")]


def test_the_first_of_several_failing_rules_wins(spark):
    """Whichever dimensions are small: own rules, duplicates and both kinds of parents in one order."""
    bad = dict(date_key=20990101, account_key=9, merchant_key=9)
    rows = [row("A", 1, **bad), row("A", 2, **bad), row(" ", 3, **bad), row(None, 4, **bad), row("C", 5, **bad, amount_egp=None),
            row("D", 6, account_key=9, merchant_key=9, time_key=5), row("E", 7, account_key=9, merchant_key=9), row("F", 8, merchant_key=9),
            row("G", 9), row("G", 9), row("H", 10, time_key=None, amount_minor=None)]
    want = [(1, "duplicate_transaction_id_in_staging"), (2, "fk_date_not_found"), (3, "null_transaction_id"), (4, "null_transaction_id"),
            (5, "null_measure"), (6, "fk_time_not_found"), (7, "fk_account_not_found"), (8, "fk_merchant_not_found"),
            (9, "duplicate_transaction_id_in_staging"), (9, None), (10, "missing_required_key")]
    for far in ((), ("dim_account",), ("dim_date", "dim_merchant"), ("dim_time", "dim_account", "dim_merchant")):
        some = dims(spark)
        key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        for name in far:
            pk = some[name].columns[0]
            some[name] = some[name].unionByName(some[name].crossJoin(spark.range(20000)).select(F.col(pk)).where(F.rand(1) > 2))   # no rows, a large estimate
        try:
            spark.conf.set(key, "50k")
            out = validate_batch(spark.createDataFrame(rows, SCHEMA).repartition(3), some)
            assert sorted(((r._kafka_offset, r.reject_reason) for r in out.collect()), key=str) == sorted(want, key=str)
        finally:
            spark.conf.set(key, before)
