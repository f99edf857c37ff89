"""The key index of the fact: right months, few rows read, kept with
the fact through upserts, reloads and compaction."""
import pytest
from pyspark.sql import functions as F

from starledger.contracts import FACT_TRANSACTIONS
from starledger.functions.keys import month_key
from starledger.operators import keyindex as KX
from starledger.plans.gold import star_tables
from starledger.sources.store import Partitioned, VersionedStore
from starledger.streaming.merge_runner import KEY, upsert_tables

COLS = FACT_TRANSACTIONS.names


def store_of(spark, path, fact):
    st = VersionedStore(spark, path)
    rows = fact.select(*COLS, "transaction_sk").withColumn("date_month", month_key("date_key"))
    st.commit({"fact_transactions": Partitioned(rows, "date_month", None, ("date_key", KEY), max_key=fact.count(), bloom=(KEY,))})
    return st


def months(st):
    """The index's answer for every key, against the fact itself."""
    v = st.current_version()
    fact = st.read("fact_transactions", v)
    keys = fact.select(KEY)
    got = {r[KEY]: r[KX.MONTH] for r in KX.months_of(st, v, keys, KEY, None).collect()}
    assert got == {r[KEY]: r["m"] for r in fact.select(KEY, month_key("date_key").alias("m")).collect()}
    return got


def commit(st, batch):
    v = st.current_version()
    frames, merged = upsert_tables(st, v, batch.select(*COLS))
    st.commit(frames, expected_version=v)
    return merged


def test_index_follows_upserts_moves_and_compaction(spark, scratch, monkeypatch):
    monkeypatch.setattr(KX, "SEGMENTS", 2)
    fact = star_tables(spark, "/root/testdata/sf0.001")["fact_transactions"].limit(400).persist()
    st = store_of(spark, f"{scratch}/gold", fact)
    some = fact.orderBy(KEY).limit(5)
    commit(st, some.withColumn("amount_egp", (F.col("amount_egp") + 1).cast("decimal(18,2)")))        # changed in place
    assert len(st.partitions(KX.KEYS)) == 1 and len(months(st)) == 400
    commit(st, some.withColumn("date_key", F.col("date_key") + 10000))                                # moved by a year
    moved = months(st)
    assert all(moved[r[KEY]] == (r["date_key"] + 10000) // 100 for r in some.collect()) and len(st.partitions(KX.KEYS)) == 2
    commit(st, some.withColumn(KEY, F.concat(F.lit("NEW"), KEY)))                                     # new: compacted
    assert len(st.partitions(KX.KEYS)) == 1 and len(months(st)) == 405
    commit(st, some.withColumn("date_key", F.col("date_key") + 10000))                                # a replay
    assert len(months(st)) == 405


def test_an_index_never_outlives_its_fact(spark, scratch):
    fact = star_tables(spark, "/root/testdata/sf0.001")["fact_transactions"].limit(50).persist()
    st = store_of(spark, f"{scratch}/gold", fact)
    commit(st, fact.limit(3).withColumn(KEY, F.concat(F.lit("NEW"), KEY)))
    assert KX.KEYS in st.manifest()["tables"]
    st.commit({"dim_date": spark.range(1)})
    assert KX.KEYS in st.manifest()["tables"]
    rows = fact.select(*COLS, "transaction_sk").withColumn("date_month", month_key("date_key"))
    st.commit({"fact_transactions": Partitioned(rows, "date_month")})          # written without its index
    assert KX.KEYS not in st.manifest()["tables"]
    commit(st, fact.limit(3).withColumn("date_key", F.col("date_key") + 10000))
    assert len(months(st)) == 50


def _rows_scanned(df):
    """Rows that the Parquet reader gave, before the filter: a plan of one scan."""
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            return p.metrics().apply("numOutputRows").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    raise AssertionError("no scan")


@pytest.mark.parametrize("spread", [False, True])
def test_rows_read_depend_on_the_batch(spark, scratch, monkeypatch, spread):
    """1,000 keys of one stretch, or 10 keys far apart: as many rows are read
    from an index of 400,000 keys as from one of 100,000."""
    monkeypatch.setattr(KX, "ROW_GROUP", 64 << 10)
    read = []
    for size in (100_000, 400_000):
        whole = spark.range(size).select(F.format_string("TXN%010d", "id").alias(KEY), F.lit(202401).alias(KX.MONTH))
        st = VersionedStore(spark, f"{scratch}/{size}")
        st.commit({KX.KEYS: KX.kept(st, 0, whole.limit(0), KEY, "fact", whole.repartition(3))})
        ids = spark.range(10).select((F.col("id") * 9_000 + 77).alias("id")) if spread else spark.range(50_000, 51_000)
        keys = ids.select(F.format_string("TXN%010d", "id").alias(KEY))
        found = KX.months_of(st, 1, keys, KEY, None)
        assert found.count() == keys.count()
        read.append(_rows_scanned(KX.near(st.read(KX.KEYS, 1), keys, KEY)))
    assert 0 < read[1] <= 1.25 * read[0] and read[0] < 100_000 * (0.9 if spread else 0.2), read
