"""Landing, layer sinks, gate helpers."""
import os

from pyspark.sql import functions as F

from starledger.contracts import DIM_DECLINE_REASON, DIM_TIME
from starledger.operators import quality as Q
from starledger.sources.events import read_bronze_events
from starledger.sources.layers import land_csv, list_batches, read_batch, write_batch_partition
from starledger.sources.store import write_layer


def test_land_csv_all_strings_with_lineage(spark, scratch):
    path = f"{scratch}/raw"
    os.makedirs(path)
    with open(f"{path}/dim_decline_reason.csv", "w") as f:
        f.write("decline_reason_key,decline_reason_name\n1,Insufficient Funds\n2,\n3,NA\n")
    df = land_csv(spark, path, DIM_DECLINE_REASON, "2024-01-01T00:00:00Z")
    rows = sorted(tuple(r) for r in df.collect())
    assert all(isinstance(r[0], str) for r in rows)
    assert rows[1][1] is None and rows[2][1] == "NA"             # only '' -> NULL (X19)
    assert rows[0][2] == "2024-01-01T00:00:00Z" and rows[0][3] == "dim_decline_reason.csv"
    info = write_layer(df, f"{scratch}/bronze/dim_decline_reason")
    assert info["rows"] == 3
    assert write_layer(df, f"{scratch}/bronze/dim_decline_reason")["rows"] == 3      # S3 idempotent rewrite
    assert spark.read.parquet(f"{scratch}/bronze/dim_decline_reason").count() == 3


def test_batch_partitions_replace_only_their_batch(spark, scratch):
    root = f"{scratch}/silver"
    a = spark.createDataFrame([(1, "b1"), (2, "b1")], "x int, silver_batch_id string")
    b = spark.createDataFrame([(3, "b2")], "x int, silver_batch_id string")
    write_batch_partition(a, root, "b1")
    write_batch_partition(b, root, "b2")
    write_batch_partition(a.where("x = 1"), root, "b1")            # replay of b1 with fewer rows
    assert list_batches(spark, root) == ["b1", "b2"]
    assert read_batch(spark, root, "b1", ["x"]).count() == 1 and read_batch(spark, root, "b2", ["x"]).count() == 1
    write_batch_partition(a.where("x = 9"), root, "b1")            # a retry whose side has become empty
    assert read_batch(spark, root, "b1", ["x"]).count() == 0 and read_batch(spark, root, "b2", ["x"]).count() == 1


def test_missing_bronze_is_empty(spark, scratch):
    df = read_bronze_events(spark, f"{scratch}/nope")
    assert df.count() == 0 and "transaction_id" in df.columns and "_kafka_offset" in df.columns


def test_column_set_and_samples(spark):
    df = spark.createDataFrame([(1, 5, "Morning", 1, "01:05 AM", "x")],
                               "time_key int, hour_of_day int, time_bucket string, is_daytime int, "
                               "hour_label string, extra string")
    assert Q.column_set_check(df, DIM_TIME) == {"missing": [], "unexpected": ["extra"], "ok": False}
    assert Q.column_set_check(df, DIM_TIME, tolerated=("extra",))["ok"]
    many = spark.range(20).withColumn("bad", F.col("id") % 2 == 0)
    assert [r.id for r in Q.sample_violations(many, F.col("bad"), ["id"]).collect()] == [0, 2, 4, 6, 8]


def test_gate_summary_warn_does_not_fail(spark):
    m = spark.createDataFrame([("t", "a", "c", "error", 0), ("t", "b", "c", "warn", 3), ("u", "a", "c", "error", 1)],
                              "table_name string, check_name string, column_name string, severity string, "
                              "violations long")
    s = {r.table_name: (r.errors, r.warnings, r.status) for r in Q.gate_summary(m).collect()}
    assert s == {"t": (0, 3, "PASS"), "u": (1, 0, "FAIL")}


def test_kpi_reconciliation(spark):
    actual = spark.createDataFrame([(100, 2500)], "transaction_count long, declined_transactions long")
    long_actual = Q.measures_long(actual, [], ["transaction_count", "declined_transactions"])
    expected = spark.createDataFrame([("transaction_count", 100.0), ("declined_transactions", 2400.0),
                                      ("fx_transactions", 1.0)], "measure string, value double")
    out = {r.measure: r.status for r in Q.reconcile_kpis(long_actual, expected, [], 0.05).collect()}
    assert out == {"transaction_count": "OK", "declined_transactions": "OK", "fx_transactions": "MISSING"}
    out0 = {r.measure: r.status for r in Q.reconcile_kpis(long_actual, expected, []).collect()}
    assert out0["declined_transactions"] == "MISMATCH"


def test_gate_report_has_samples_and_status(spark):
    from starledger import contracts as C
    from starledger.operators import quality as Q
    from starledger.plans.gold import star_tables
    t = dict(star_tables(spark, "/root/testdata/sf0.001"))
    good = Q.gate_report(t, C.STAR)
    assert good.status == "PASS"
    bad = {**t, "fact_transactions": t["fact_transactions"].withColumn(
        "merchant_key", F.when(F.col("is_fx") == 1, F.lit(-7)).otherwise(F.col("merchant_key"))).withColumn(
        "abs_amount_egp", F.when(F.col("is_declined") == 1, -F.col("abs_amount_egp")).otherwise(F.col("abs_amount_egp")))}
    report = Q.gate_report(bad, C.STAR)
    assert report.status == "FAIL"
    orphans = report.samples["fact_transactions", "relationships", "merchant_key->dim_merchant.merchant_key"]
    assert len(orphans) == 5 and all(r["merchant_key"] == -7 for r in orphans)
    negative = report.samples["fact_transactions", "abs_amount_nonnegative", "abs_amount_egp"]
    assert 0 < len(negative) <= 5 and all(r["abs_amount_egp"] < 0 for r in negative)


def test_raw_text_keys_and_orphans(spark):
    from starledger import contracts as C
    from starledger.operators import quality as Q
    parent = spark.createDataFrame([(1,), (20,)], "location_key int")
    raw = spark.createDataFrame([("1",), (" 01 ",), ("+20",), ("3",), (" ",), (None,)], "location_key string")
    got = Q.raw_orphans(raw, "dim_account", [("location_key", parent, "location_key", "dim_location")]).collect()
    assert [(r.column_name, r.violations) for r in got] == [("location_key->dim_location.location_key", 1)]
    checks = [c for c in Q.raw_key_checks(C.DIM_ACCOUNT) if c.column == "location_key"]
    if checks:
        assert Q.row_checks(raw, "dim_account", checks).first()["violations"] == 2


def test_measures_resolve_by_name(spark):
    from starledger.operators.derived import DERIVED, evaluate
    from starledger.operators.measures import MEASURES, measure
    from starledger.plans.gold import star_tables
    t = star_tables(spark, "/root/testdata/sf0.001")
    for name in [*MEASURES, *DERIVED]:
        assert measure(name) is not None
        assert name in evaluate(t, name).columns


def test_unique_keys_are_stacked_by_number(spark):
    from starledger.operators.quality import check_unique_many
    df = spark.sql("SELECT * FROM VALUES (1, 'x'), (1, 'y'), (2, 'y'), (NULL, NULL), (NULL, NULL) AS t(a, b)")
    out = check_unique_many([(df, "t", "a"), (df, "t", "b"), (df.where("a = 2"), "u", "a")])
    assert {(r.table_name, r.column_name): r.violations for r in out.collect()} == {("t", "a"): 1, ("t", "b"): 1, ("u", "a"): 0}
    assert out.columns == ["table_name", "check_name", "column_name", "severity", "violations"]
    # no names are shuffled with every key
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [__i#" in plan and "Aggregate [table_name" not in plan
