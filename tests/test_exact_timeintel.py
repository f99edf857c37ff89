"""A3/A12/X21 exact arithmetic; W6-W8 on gaps; I17 surrogate keys."""
from decimal import Decimal

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from starledger.functions import exact as X
from starledger.operators.surrogate import assign_surrogate
from starledger.operators.timeintel import growth_ppm, same_day_shifted, shift_period


def test_half_up(spark):
    rows = [(5, 2), (-5, 2), (7, 0), (1, 3), (2, 3), (10**18, 3)]
    df = spark.createDataFrame([(Decimal(n), d) for n, d in rows], "n decimal(38,0), d long")
    out = [r.q for r in df.select(X.half_up_div("n", "d").alias("q")).collect()]
    assert out == [3, -3, None, 0, 1, 333333333333333333]
    big = spark.createDataFrame([(Decimal(10**20), 3)], "n decimal(38,0), d long")
    with pytest.raises(Exception):
        big.select(X.half_up_div("n", "d")).collect()            # never a silently wrapped value


def test_avg_money_ties(spark):
    df = spark.createDataFrame([(Decimal("2.01"), 2), (Decimal("2.03"), 2)], "s decimal(38,2), n long")
    assert [str(r.a) for r in df.select(X.avg_money("s", "n").alias("a")).collect()] == ["1.01", "1.02"]


def test_month_shift_on_gaps(spark):
    m = spark.createDataFrame([(2024, 1, Decimal("10.00"), 24288), (2024, 2, None, 24289),
                               (2024, 3, Decimal("5.00"), 24290)],
                              "year int, month int, volume decimal(38,2), month_index int")
    s = shift_period(m, "volume", -1, "prev")
    g = {r.month: (r.prev, r.g) for r in growth_ppm(s, "volume", "prev", "g").collect()}
    assert g[1] == (None, None) and g[2][0] == Decimal("10.00") and g[2][1] == -1000000 and g[3] == (None, None)


def test_same_day_clamps_month_end(spark):
    d = spark.createDataFrame([("2024-02-29", 1), ("2024-03-31", 2), ("2024-03-30", 3)],
                              "full_date string, volume int").withColumn("full_date", F.to_date("full_date"))
    out = {str(r.full_date): r.prev for r in same_day_shifted(d, "volume", -1, "prev").collect()}
    assert out["2024-03-31"] == 1 and out["2024-03-30"] == 1 and out["2024-02-29"] is None


def test_surrogate_contiguous(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("k"))
    out = assign_surrogate(df, "k", "sk", 10, num_partitions=7)
    chk = out.withColumn("rn", F.row_number().over(Window.orderBy("k")) + 9)
    assert chk.where("rn != sk").count() == 0 and out.count() == 5000
