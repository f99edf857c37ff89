"""W3-W8 per member, distinct counts from bitmaps, totals from partials, filter
contexts: plans and hand-made cases (values are held against SQL by the keys)."""
import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from starledger.operators import context as CX
from starledger.operators import measures as M
from starledger.operators import timeintel as TI

SF = "/root/testdata/sf0.001"


def plan(key, spark):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_expand_no_fact(spark):
    assert "Expand" not in plan("merchants_by_governorate", spark)
    p = E.queries()["geo_drilldown"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    below = p[p.index("Expand"):]
    assert "bitmap_construct_agg" in below and "Join" in below      # grouping sets see groups, not facts


def test_a_context_scans_the_fact_once(spark):
    p = plan("share_in_context", spark)
    assert p.count("abs_amount_egp:decimal") == 1 and p.count("FileScan") == 2


def _days(spark, rows, by=("m",)):
    cal = spark.createDataFrame([(d.year * 10000 + d.month * 100 + d.day, d) for d in
                                 (dt.date(2023, 11, 1) + dt.timedelta(i) for i in range(200))], "date_key int, full_date date")
    per = spark.createDataFrame([(m, k, Decimal(v)) for m, k, v in rows], "m string, date_key int, volume decimal(38,2)")
    return TI.member_days(per, cal, list(by))


def test_member_days_run_from_first_to_last_active_day(spark):
    rows = [("a", 20231230, "5"), ("a", 20240102, "7"), ("b", 20240101, "1"), (None, 20240101, "2"), (None, 20240103, "3")]
    d = TI.to_date(_days(spark, rows), "volume", "year", "ytd", ["m"]).collect()
    got = {(r["m"], r["full_date"].isoformat()): (r["volume"], str(r["ytd"])) for r in d}
    assert got == {("a", "2023-12-30"): (5, "5.00"), ("a", "2023-12-31"): (None, "5.00"), ("a", "2024-01-01"): (None, "0.00"),
                   ("a", "2024-01-02"): (7, "7.00"), ("b", "2024-01-01"): (1, "1.00"), (None, "2024-01-01"): (2, "2.00"),
                   (None, "2024-01-02"): (None, "2.00"), (None, "2024-01-03"): (3, "5.00")}


def test_months_of_a_member_shift_by_index(spark):
    rows = [("a", 20231105, "10"), ("a", 20240110, "30"), ("b", 20240110, "4"), ("a", 20240201, "15")]
    m = TI.growth_ppm(TI.shift_period(TI.member_months(_days(spark, rows), ["m"]), "volume", -1, "last", ["m"]), "volume", "last", "g")
    got = {(r["m"], r["year"], r["month"]): (r["volume"], r["last"], r["g"]) for r in m.collect()}
    assert got == {("a", 2023, 11): (10, None, None), ("a", 2023, 12): (None, 10, -1_000_000), ("a", 2024, 1): (30, None, None),
                   ("a", 2024, 2): (15, 30, -500_000), ("b", 2024, 1): (4, None, None)}


def test_windows_are_per_member(spark):
    p = plan("to_date_by_tier", spark)
    assert "Exchange SinglePartition" not in p


FACT = "account_key int, merchant_key int, abs_amount_egp decimal(18,2), d int, c string"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from([None, 0, 1, 40_000, 70_000, -5]), st.integers(1, 9),
                          st.integers(1, 4), st.sampled_from(["x", "y", None])), max_size=30))
def test_bitmaps_count_what_distinct_counts(spark, rows):
    fact = spark.createDataFrame([(a, m, Decimal(v), d, c) for a, m, v, d, c in rows], FACT)
    dim = spark.createDataFrame([(1, "p", "q"), (2, "p", "r"), (3, "s", None), (4, None, None)], "account_key int, g string, h string")
    ms = ["distinct_merchants", "active_accounts", "transaction_count", "gross_volume"]
    eager = M.query_eager(fact, dim, "account_key", "account_key", ["g", "h"], ms, fact_by=["c"], totals="cube")
    plain = M.query(fact.join(dim, "account_key"), ms, ["g", "h", "c"], totals="cube")
    cols = ["g", "h", "c", "grouping_level", *ms]
    assert sorted(map(tuple, eager.select(cols).collect()), key=repr) == sorted(map(tuple, plain.select(cols).collect()), key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(1, 9), st.integers(1, 4),
                          st.sampled_from(["x", "y", "z", None])), max_size=30))
def test_variants_equal_filtered_queries(spark, rows):
    fact = spark.createDataFrame([(a, m, Decimal(v), d, c) for a, m, v, d, c in rows], FACT)
    context = {"date": CX.Filter(F.col("d") <= 2), "cat": CX.Filter(F.col("c").isin("x", "y"), ("c",)),
               "account": CX.Filter(F.col("account_key") < 3), "free": CX.Filter()}
    variants = {"v": CX.Variant("gross_volume"), "v_cat": CX.Variant("gross_volume", ("cat",)),
                "n_date": CX.Variant("transaction_count", ("date",)), "t_both": CX.Variant("average_ticket", ("cat", "date"))}
    got = {r["c"]: (r["v"], r["v_cat"], r["n_date"], r["t_both"]) for r in CX.in_context(fact, context, variants, ["c"]).collect()}

    def amounts(date=True, cat=None):
        return [v for a, _, v, d, c in rows if a < 3 and (d <= 2 or not date) and (cat is None or c == cat)]
    want = {}
    for c in ("x", "y"):
        if amounts(cat=c):
            every = amounts(date=False)
            half_up = (2 * sum(every) * 100 + len(every)) // (2 * len(every))
            want[c] = (sum(amounts(cat=c)), sum(amounts()), len(amounts(date=False, cat=c)), Decimal(half_up) / 100)
    assert got == want


def test_contexts_refuse_what_does_not_add_up(spark):
    df = spark.createDataFrame([], FACT)
    with pytest.raises(ValueError, match="distinct counts"):
        CX.in_context(df, {}, {"a": CX.Variant("active_accounts")})
    with pytest.raises(KeyError, match="no filter"):
        CX.in_context(df, {}, {"a": CX.Variant("gross_volume", ("date",))})
