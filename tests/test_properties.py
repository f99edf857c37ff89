"""SURVEY §5 (ours): property and determinism checks."""
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starledger.functions import exact as X
from starledger.operators.surrogate import assign_surrogate, positions

PAIRS = st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-10**9, 10**9)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(PAIRS)
def test_half_up_div_matches_decimal(spark, pairs):
    df = spark.createDataFrame([(i, Decimal(n), Decimal(d)) for i, (n, d) in enumerate(pairs)],
                               "i int, n decimal(38,0), d decimal(38,0)")
    got = {r.i: r.q for r in df.select("i", X.half_up_div("n", "d").alias("q")).collect()}
    for i, (n, d) in enumerate(pairs):
        want = None if d == 0 else int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
        assert got[i] == want, (n, d, got[i], want)


def test_surrogate_keys_independent_of_partitioning(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).cast("string").alias("k")).repartition(5)
    a = {r.k: r.sk for r in assign_surrogate(df, "k", "sk", 1, num_partitions=3).collect()}
    b = {r.k: r.sk for r in assign_surrogate(df.repartition(11), "k", "sk", 1, num_partitions=9).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 3001))


def test_positions_cover_every_row_once(spark):
    df = spark.range(0, 2000).select((F.col("id") * 31 % 2003).cast("string").alias("k"))
    p = positions(df, "k", num_partitions=4).select("k", "_sk_pid", "_sk_pos")
    assert p.select("_sk_pid", "_sk_pos").distinct().count() == 2000
    ordered = [r.k for r in p.orderBy("_sk_pid", "_sk_pos").collect()]
    assert ordered == sorted(ordered)                 # (partition, position) follows the key order


def test_gold_build_is_deterministic(spark, scratch):
    """Rebuilding the star with another shuffle width gives the same fact,
    surrogate keys included (SURVEY §5: determinism under repartitioning)."""
    from starledger.plans.adapter import Star
    from starledger.plans.gold import reload_gold
    from starledger.sources.store import VersionedStore

    def build(width, root):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(width))
        try:
            st = VersionedStore(spark, root)
            reload_gold(spark, Star(spark, "/root/testdata/sf0.001").tables(), st)
            return st.read("fact_transactions")
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)

    a = build(3, f"{scratch}/a")
    b = build(13, f"{scratch}/b")
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
