"""Plan checks: dimension joins broadcast, no single-partition exchange on
fact-sized data, filters and column pruning reach the scan."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_joins_broadcast_and_no_single_partition(spark):
    p = plan(E.queries()["rpt_daily"](spark, SF))
    assert "BroadcastHashJoin" in p and "SinglePartition" not in p
    p = plan(E.queries()["measures_by_group"](spark, SF))
    assert "BroadcastHashJoin" in p


def test_pushdown_and_pruning(spark):
    df = E.queries()["date_range_lookup"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date_key), GreaterThanOrEqual(date_key,19970101)" in p
    assert "ReadSchema: struct<date_key:int,transaction_id:string,amount_egp:decimal(18,2)" in p


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "avg_ticket_egp" in df.columns


def test_eager_aggregation_below_dimension_join(spark):
    """Reports over account attributes aggregate the fact per account before
    joining the (data-sized) account dimension."""
    df = E.queries()["engagement_by_tier"](spark, SF)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = p.find("Join")
    agg_below = p.find("Aggregate [account_key", join_at)
    assert join_at >= 0 and agg_below > join_at, p


def test_register_views(spark):
    from starledger.plans.gold import star_tables
    from starledger.plans.reports import register_views
    names = register_views(spark, star_tables(spark, SF), "gold_")
    assert "gold_rpt_daily_transactions" in names
    assert spark.sql("SELECT count(*) AS n FROM gold_rpt_warehouse_health").collect()[0].n == 1


def test_merge_summary_validates_the_batch_once(spark):
    p = E.queries()["merge_summary"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Window [row_number") == 1


def test_fact_carries_no_lineage_through_its_dedupe(spark):
    from starledger.plans import adapter
    p = adapter.fact(adapter.DriverTables(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "_kafka_partition" not in p and "_kafka_topic" not in p


def test_the_reload_runs_in_tasks_sized_to_its_input(spark):
    from pyspark.sql import SparkSession

    from starledger.session import SHARE, build_session
    before = dict(spark.conf.getAll)
    own = build_session(spark, 1000 * SHARE + 1)
    assert own.conf.get("spark.sql.shuffle.partitions") == "1001"
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert build_session(spark, 1).conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert dict(spark.conf.getAll) == before and SparkSession.getActiveSession()._jsparkSession.equals(spark._jsparkSession)


def test_star_tables_reload_in_a_build_session(spark, tmp_path, monkeypatch):
    import shutil

    from pyspark.sql import SparkSession

    from starledger.plans import gold
    shutil.copytree(SF, tmp_path / "sf")
    sessions, whole = [], gold.reload_gold
    monkeypatch.setattr(gold, "reload_gold", lambda s, tables, *a, **k: (sessions.append((s, tables)), whole(s, tables, *a, **k))[1])
    got = gold.star_tables(spark, str(tmp_path / "sf"))
    own, tables = sessions[0]
    assert own is not spark and all(t.sparkSession is own for t in tables.values())
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "8m"
    assert all(t.sparkSession is spark for t in got.values())
    assert SparkSession.getActiveSession()._jsparkSession.equals(spark._jsparkSession)


def test_fact_orders_ties_by_the_absolute_amount(spark, tmp_path):
    """Rows of one id and offset whose amounts are equal but for their sign."""
    from starledger.plans import adapter
    d = tmp_path / "sf"
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, " \
           "l_discount double, l_returnflag string, l_linestatus string"
    rows = [(1, 2, 3, 1, 1.0, 5.25, 0.0, "A", "O"), (1, 2, 3, 1, 1.0, -5.25, 0.0, "A", "F"),
            (2, 2, 3, 1, 1.0, 5.25, 0.0, "A", "O"), (3, 2, 3, 1, 1.0, -7.5, 0.0, "A", "O"), (4, 2, 3, 1, 1.0, None, 0.0, "A", "F")]
    spark.createDataFrame(rows, line).write.parquet(f"{d}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, 1L AS o_custkey, timestamp'2024-01-01' AS o_orderdate, '1-URGENT' AS o_orderpriority "
              "FROM range(1, 5)").write.parquet(f"{d}/orders.parquet")
    got = {r.transaction_id[-2:]: (r.amount_egp, r.abs_amount_egp, r.is_outbound)
           for r in adapter.fact(adapter.DriverTables(spark, str(d))).collect()}
    plain = {k: (v if v is None else float(v), w if w is None else float(w), o) for k, (v, w, o) in got.items()}
    assert plain == {"11": (-5.25, -5.25, 0), "21": (-5.25, 5.25, 1), "31": (7.5, -7.5, 1), "41": (None, None, 0)}
    shuffled = adapter.fact(adapter.DriverTables(spark, str(d)))._jdf.queryExecution().optimizedPlan().toString()
    assert "SIGNUM" in shuffled.upper()


def test_a_build_drops_its_shuffles_and_keeps_what_the_caller_set(spark):
    from starledger.session import BUILD_CONF, build_session
    own = build_session(spark, 1)
    held = spark.conf.getAll
    assert {k: own.conf.get(k) for k in BUILD_CONF} == {**BUILD_CONF, **{k: held[k] for k in BUILD_CONF if k in held}}
    key = "spark.sql.parquet.compression.codec"
    spark.conf.set(key, "snappy")
    try:
        assert build_session(spark, 1).conf.get(key) == "snappy"
    finally:
        spark.conf.unset(key)


def test_bronze_is_written_without_silver(spark, tmp_path):
    import shutil

    from starledger.plans import gold
    shutil.copytree(SF, tmp_path / "sf")
    sf = str(tmp_path / "sf")
    n = gold.bronze_events(spark, sf).count()
    silver = gold._store(spark, "silver_events", sf)
    assert n and silver.current_version() == 0
    both = gold.layer_tables(spark, sf)
    assert silver.current_version() == 1 and gold._store(spark, "bronze_events", sf).current_version() == 1
    assert list(both) == ["bronze_events", "silver_events"] and both["silver_events"].count() == n
    assert all(t.sparkSession is spark for t in both.values())


def lines_of(spark, d, rows):
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double"
    (spark.createDataFrame(rows, line).selectExpr("*", "1L AS l_suppkey", "1D AS l_quantity", "0D AS l_discount", "'A' AS l_returnflag",
                                                  "'F' AS l_linestatus").write.parquet(f"{d}/lineitem.parquet"))
    spark.sql("SELECT id AS o_orderkey, 1L AS o_custkey, timestamp'2024-01-01' AS o_orderdate, '1-URGENT' AS o_orderpriority "
              "FROM range(0, 5)").write.parquet(f"{d}/orders.parquet")
    from starledger.plans import adapter
    return adapter.fact(adapter.DriverTables(spark, str(d)))


def test_ids_of_one_order_are_deduplicated_where_the_join_put_them(spark, tmp_path):
    """Line numbers of one digit keep the ids of orders apart; others (11 of order 1 is 1 of order 2) don't."""
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        apart = lines_of(spark, tmp_path / "a", [(1, 1, 7, 1.0), (1, 1, 5, 2.0), (1, 9, 5, 3.0), (2, 0, 5, 4.0), (2, 1, 5, 5.0), (3, None, 5, 6.0), (None, 3, 5, 6.0)])
        mixed = lines_of(spark, tmp_path / "m", [(1, 11, 7, 1.0), (2, 1, 5, 2.0), (2, -9, 6, 3.0), (1, 1, 5, 4.0), (3, None, 5, 5.0)])
        none = lines_of(spark, tmp_path / "n", [])
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in (apart, mixed)]
        assert [p.count("Exchange hashpartitioning(transaction_id") for p in plans] == [0, 1]
        assert "hashpartitioning(l_orderkey" in plans[0]
        got = [{(r.transaction_id[3:].lstrip("0"), float(r.amount_egp)) for r in f.collect()} for f in (apart, mixed, none)]
        assert got == [{("11", 2.0), ("19", 3.0), ("20", 4.0), ("21", 5.0)}, {("21", 2.0), ("11", 4.0)}, set()]
    finally:
        spark.conf.set(key, before)
