"""Adapter: the driver's TPC-H-like tables -> the payments star.

Every column is an expression over ``lineitem``/``orders``/``customer``/
``supplier``/``nation``/``region``; the oracle SQL (plans/oracle.py) states the
same expressions for DuckDB.  The mapping itself is part of the test fixture,
not of the library: the library operators only see star tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import AGE_BANDS, DECLINE_REASONS, FACT_TRANSACTIONS
from ..functions import exact as X
from ..functions import keys as K
from ..operators import dims
from ..operators.dedupe import keep_first

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the fixture mapping (exchange rates x1e6 by l_linenumber % 4).
FX_RATES_E6 = (48_000_000, 52_000_000, 12_800_000, 13_100_000)
TOPIC = "transactions_raw"


class DriverTables:
    """Lazy per-table parquet readers for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"


def raw_join(t: DriverTables) -> DataFrame:
    """lineitem JOIN orders on the order key: the raw event grain."""
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                              "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")
    return li.join(o, "l_orderkey", "inner")


def _txn_columns() -> list:
    l_ok, ln, pk, sk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    outbound = (F.col("l_linestatus") == "O").cast("int")
    declined = (F.col("l_returnflag") == "R").cast("int")
    fx = (F.col("l_discount") > 0.085).cast("int")
    is_peer = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    abs_amt = F.col("l_extendedprice").cast(X.MONEY)
    amt = F.when(outbound == 1, -abs_amt).otherwise(abs_amt).cast(X.MONEY)
    rate = F.col("__rate")
    abs_minor = (abs_amt * 100).cast("bigint")
    type_key = F.substring("o_orderpriority", 1, 1).cast("int")
    return [
        K.date_key("o_orderdate").alias("date_key"),
        ((pk % 24) * 100 + (sk % 60)).cast("int").alias("time_key"),
        F.col("o_custkey").cast("int").alias("account_key"),
        F.when(is_peer, sk).cast("int").alias("peer_account_key"),
        type_key.alias("transaction_type_key"),
        F.when(declined == 1, pk % 8 + 1).cast("int").alias("decline_reason_key"),
        F.when(~is_peer, sk).cast("int").alias("merchant_key"),
        K.padded_id("TXN", l_ok * 10 + ln, 10).alias("transaction_id"),
        F.when(type_key <= 3, K.padded_id("MC", pk, 12)).alias("mc_transaction_id"),
        F.when(type_key == 5, K.padded_id("ACH", pk, 10)).alias("ach_transfer_id"),
        (amt * 100).cast("bigint").alias("amount_minor"),
        amt.alias("amount_egp"),
        abs_amt.alias("abs_amount_egp"),
        F.when(fx == 1, X.fx_minor(abs_minor, rate)).alias("fx_amount_minor"),
        rate.alias("exchange_rate_e6"),
        outbound.alias("is_outbound"),
        declined.alias("is_declined"),
        fx.alias("is_fx"),
        F.lit(TOPIC).alias("_kafka_topic"),
        (l_ok % 3).cast("int").alias("_kafka_partition"),
        (pk * 100000 + sk).cast("bigint").alias("_kafka_offset"),
    ]


def _with_rate(df: DataFrame) -> DataFrame:
    """Stage the exchange rate as its own column so the amount expressions
    reference it instead of repeating the lookup."""
    rates = F.array(*[F.lit(r).cast("bigint") for r in FX_RATES_E6])
    return df.withColumn("__rate", F.when(F.col("l_discount") > 0.085,
                                          F.element_at(rates, (F.col("l_linenumber") % 4 + 1).cast("int"))))


def raw_txn(t: DriverTables) -> DataFrame:
    """Fact columns + Kafka lineage at event grain (natural duplicate ids)."""
    return _with_rate(raw_join(t)).select(*_txn_columns())


def txn(t: DriverTables) -> DataFrame:
    """raw_txn de-duplicated on transaction_id, earliest offset wins."""
    # offsets are not unique within an id in every fixture: use the total order
    return keep_first(raw_txn(t), ["transaction_id"], ["_kafka_offset"])


def _ids_of_one_order(t: DriverTables) -> bool:
    """Whether no two orders can share a transaction id (order * 10 + line): read
    from the line numbers, one narrow scan."""
    lo, hi = t["lineitem"].agg(F.min("l_linenumber"), F.max("l_linenumber")).first()
    return hi is None or (lo >= 0 and hi <= 9)


def fact(t: DriverTables) -> DataFrame:
    """``txn`` without lineage.  What follows from other columns, or comes after
    all fact columns in the order of rows, is not carried through the shuffle.
    Ids that belong to one order each are de-duplicated where the join has put
    the order, without a shuffle more."""
    # the absolute amount is the amount but for its sign, which orders rows in its stead
    sign = F.signum("abs_amount_egp").cast("int").alias("abs_amount_egp")
    carried = [sign if c == "abs_amount_egp" else c for c in FACT_TRANSACTIONS.names if c != "amount_egp"]
    order = ["l_orderkey"] if _ids_of_one_order(t) else []
    raw = _with_rate(raw_join(t)).select("l_orderkey", *_txn_columns()).select(*order, *carried, "_kafka_offset")
    kept = keep_first(raw, [*order, "transaction_id"], ["_kafka_offset"])
    signed = (F.col("amount_minor") * F.lit(0.01).cast("decimal(2,2)")).cast(X.MONEY)
    turned = F.when(F.col("abs_amount_egp") < 0, -F.abs("amount_egp")).otherwise(F.abs("amount_egp")).cast(X.MONEY)
    return (kept.withColumn("amount_egp", signed).withColumn("abs_amount_egp", turned)
                .select(*FACT_TRANSACTIONS.names))


def dirty_raw_txn(t: DriverTables) -> DataFrame:
    """All-string event rows with injected faults (I6 / Q10-Q15 inputs)."""
    base = _with_rate(raw_join(t)).select(*_txn_columns(), "l_quantity")
    q = F.col("l_quantity")
    cols = []
    for c in [*FACT_TRANSACTIONS.names, "_kafka_topic", "_kafka_partition", "_kafka_offset"]:
        s = F.col(c).cast("string")
        if c == "transaction_id":
            s = F.when(q == 50, F.lit("")).otherwise(s)
        elif c == "amount_egp":
            s = F.when(q == 1, F.lit("N/A")).otherwise(s)
        elif c == "date_key":
            s = F.when(q == 2, F.lit(" ")).otherwise(s)
        cols.append(s.alias(c))
    return base.select(*cols)


def dim_location(t: DriverTables) -> DataFrame:
    n, r = t["nation"], t["region"]
    return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
             .select(F.col("n_nationkey").cast("int").alias("location_key"), F.col("n_name").alias("city"),
                     F.col("r_name").alias("governorate"), F.lit("X").alias("country")))


def first_order_dates(t: DriverTables) -> DataFrame:
    o = t["orders"]
    return o.groupBy(F.col("o_custkey").cast("int").alias("account_key")).agg(
        F.min(K.date_key("o_orderdate")).alias("signup_date_key"))


def first_sale_dates(t: DriverTables) -> DataFrame:
    j = raw_join(t)
    return j.groupBy(F.col("l_suppkey").cast("int").alias("merchant_key")).agg(
        F.min(K.date_key("o_orderdate")).alias("opened_date_key"))


def _with_default_date(df: DataFrame, t: DriverTables, col: str) -> DataFrame:
    """Members without any order get the first order date of the data set
    (a scalar subquery: evaluated once, no join)."""
    first = t["orders"].agg(F.min(K.date_key("o_orderdate"))).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), first))


def dim_account(t: DriverTables) -> DataFrame:
    c = t["customer"]
    bal = F.col("c_acctbal")
    bands = F.array(*[F.lit(b) for b in AGE_BANDS])
    base = c.select(
        F.col("c_custkey").cast("int").alias("account_key"),
        K.padded_id("ACC", F.col("c_custkey"), 8).alias("account_id"),
        F.col("c_nationkey").cast("int").alias("location_key"),
        F.lit("EGP").alias("currency"),
        F.element_at(bands, (F.col("c_custkey") % 6 + 1).cast("int")).alias("age_band"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        F.when(bal >= 9000, "Business").when(bal >= 7000, "Premium").otherwise("Standard").alias("customer_tier"),
        F.when(bal < 0, "Dormant").otherwise("Active").alias("account_status"),
    )
    first = first_order_dates(t)
    return (_with_default_date(base.join(first, "account_key", "left"), t, "signup_date_key")
                .select("account_key", "account_id", "location_key", "currency", "age_band", "acquisition_channel",
                        "signup_date_key", "customer_tier", "account_status"))


def dim_merchant(t: DriverTables) -> DataFrame:
    s = t["supplier"]
    bal = F.col("s_acctbal")
    base = s.select(
        F.col("s_suppkey").cast("int").alias("merchant_key"),
        F.col("s_nationkey").cast("int").alias("location_key"),
        K.padded_id("MER", F.col("s_suppkey"), 6).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.concat(F.lit("CAT_"), (F.col("s_suppkey") % 8).cast("string")).alias("merchant_category"),
        F.when(bal >= 9000, "Enterprise").when(bal >= 5000, "Mid-Market").otherwise("SME").alias("merchant_size"),
    )
    return (_with_default_date(base.join(first_sale_dates(t), "merchant_key", "left"), t, "opened_date_key")
                .select("merchant_key", "location_key", "merchant_id", "merchant_name", "merchant_category",
                        "merchant_size", "opened_date_key"))


def dim_transaction_type(t: DriverTables) -> DataFrame:
    p = t["orders"].select("o_orderpriority").distinct()
    k = F.substring("o_orderpriority", 1, 1).cast("int")
    return p.select(
        k.alias("transaction_type_key"),
        F.substring_index("o_orderpriority", "-", -1).alias("transaction_type_name"),
        F.when(k <= 2, "Payment").when(k <= 4, "Transfer").otherwise("Deposit").alias("transaction_group"),
    )


def dim_decline_reason(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(i + 1).alias("decline_reason_key"), F.lit(n).alias("decline_reason_name"))
            for i, n in enumerate(DECLINE_REASONS)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def dim_date(t: DriverTables) -> DataFrame:
    return dims.calendar_covering(t["orders"], "o_orderdate")


def dim_time(spark: SparkSession) -> DataFrame:
    return dims.time_of_day(spark)


class Star:
    """The nine star frames of one driver folder, built lazily as plans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.t = spark, DriverTables(spark, sf_dir)

    @cached_property
    def fact(self) -> DataFrame:
        return fact(self.t)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(self.t)

    @cached_property
    def dim_time(self) -> DataFrame:
        return dim_time(self.spark)

    @cached_property
    def dim_account(self) -> DataFrame:
        return dim_account(self.t)

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return dim_merchant(self.t)

    @cached_property
    def dim_location(self) -> DataFrame:
        return dim_location(self.t)

    @cached_property
    def dim_transaction_type(self) -> DataFrame:
        return dim_transaction_type(self.t)

    @cached_property
    def dim_decline_reason(self) -> DataFrame:
        return dim_decline_reason(self.spark)

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_transactions": self.fact, "dim_date": self.dim_date, "dim_time": self.dim_time,
                "dim_account": self.dim_account, "dim_merchant": self.dim_merchant,
                "dim_location": self.dim_location, "dim_transaction_type": self.dim_transaction_type,
                "dim_decline_reason": self.dim_decline_reason}
