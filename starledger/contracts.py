"""Table contracts: one declared object per star table.

A contract replaces the repeated schema copies of a classic pipeline (silver
casts, warehouse DDL, validator spec): column order, Spark type, warehouse
type (for raw text checks), nullability, length limits, keys, foreign keys and
accepted-value domains.  Conform, the quality gate and the merge all read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    spark_type: T.DataType
    wh_type: str                       # int | tinyint | smallint | bigint | bit | date | decimal(18,2) | char(n) | varchar(n)
    nullable: bool = True
    domain: tuple | None = None        # accepted values (NULL passes)

    @property
    def max_len(self) -> int | None:
        if self.wh_type.startswith(("varchar(", "char(")):
            return int(self.wh_type.split("(")[1].rstrip(")"))
        return None

    @property
    def exact_len(self) -> bool:
        return self.wh_type.startswith("char(")


@dataclass(frozen=True)
class FK:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()       # single-column unique constraints besides the PK
    foreign_keys: tuple[FK, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def col(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def schema(self, extra: T.StructType | None = None) -> T.StructType:
        fields = [T.StructField(c.name, c.spark_type, c.nullable) for c in self.columns]
        if extra is not None:
            fields += list(extra.fields)
        return T.StructType(fields)

    def string_schema(self, extra: tuple[str, ...] = ()) -> T.StructType:
        """All-string schema of the raw (bronze) form of the table."""
        return T.StructType([T.StructField(n, T.StringType(), True) for n in [*self.names, *extra]])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


INT, LONG, STR, DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
MONEY = T.DecimalType(18, 2)

# ---------------------------------------------------------------------------
# Fixed values of the star: accepted domains and lookup names.
# ---------------------------------------------------------------------------
TIME_BUCKETS = ("Morning", "Afternoon", "Evening", "Night")
CUSTOMER_TIERS = ("Standard", "Premium", "Business")
ACCOUNT_STATUSES = ("Active", "Dormant", "Suspended", "Closed")
MERCHANT_SIZES = ("Enterprise", "Mid-Market", "SME")
AGE_BANDS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
DECLINE_REASONS = (
    "Insufficient Funds",
    "Card Expired",
    "Incorrect PIN",
    "Daily Limit Exceeded",
    "Suspected Fraud",
    "Card Blocked",
    "Technical Error",
    "Network Timeout",
)
BIT = (0, 1)

DIM_DATE = TableContract(
    "dim_date",
    (Col("date_key", INT, "int", False), Col("full_date", DATE, "date", False),
     Col("day", INT, "tinyint", False), Col("month", INT, "tinyint", False),
     Col("quarter", INT, "tinyint", False), Col("year", INT, "smallint", False),
     Col("is_weekend", INT, "bit", False, BIT)),
    primary_key=("date_key",))

DIM_TIME = TableContract(
    "dim_time",
    (Col("time_key", INT, "int", False), Col("hour_of_day", INT, "tinyint", False),
     Col("time_bucket", STR, "varchar(20)", False, TIME_BUCKETS),
     Col("is_daytime", INT, "bit", False, BIT), Col("hour_label", STR, "varchar(10)", False)),
    primary_key=("time_key",))

DIM_LOCATION = TableContract(
    "dim_location",
    (Col("location_key", INT, "int", False), Col("city", STR, "varchar(100)", False),
     Col("governorate", STR, "varchar(100)", False), Col("country", STR, "varchar(100)", False)),
    primary_key=("location_key",))

DIM_ACCOUNT = TableContract(
    "dim_account",
    (Col("account_key", INT, "int", False), Col("account_id", STR, "varchar(50)", False),
     Col("location_key", INT, "int", False), Col("currency", STR, "char(3)", False),
     Col("age_band", STR, "varchar(20)"), Col("acquisition_channel", STR, "varchar(50)"),
     Col("signup_date_key", INT, "int", False),
     Col("customer_tier", STR, "varchar(20)", True, CUSTOMER_TIERS),
     Col("account_status", STR, "varchar(20)", False, ACCOUNT_STATUSES)),
    primary_key=("account_key",), unique=("account_id",),
    foreign_keys=(FK("location_key", "dim_location", "location_key"),
                  FK("signup_date_key", "dim_date", "date_key")))

DIM_MERCHANT = TableContract(
    "dim_merchant",
    (Col("merchant_key", INT, "int", False), Col("location_key", INT, "int", False),
     Col("merchant_id", STR, "varchar(50)", False), Col("merchant_name", STR, "varchar(200)", False),
     Col("merchant_category", STR, "varchar(100)"),
     Col("merchant_size", STR, "varchar(20)", True, MERCHANT_SIZES),
     Col("opened_date_key", INT, "int", False)),
    primary_key=("merchant_key",), unique=("merchant_id",),
    foreign_keys=(FK("location_key", "dim_location", "location_key"),
                  FK("opened_date_key", "dim_date", "date_key")))

DIM_TRANSACTION_TYPE = TableContract(
    "dim_transaction_type",
    (Col("transaction_type_key", INT, "int", False),
     Col("transaction_type_name", STR, "varchar(100)", False),
     Col("transaction_group", STR, "varchar(50)", False)),
    primary_key=("transaction_type_key",))

DIM_DECLINE_REASON = TableContract(
    "dim_decline_reason",
    (Col("decline_reason_key", INT, "int", False), Col("decline_reason_name", STR, "varchar(200)", False)),
    primary_key=("decline_reason_key",))

# fact columns that rows are looked up by, besides the date
FACT_LOOKUPS = ("transaction_id", "account_key")

FACT_TRANSACTIONS = TableContract(
    "fact_transactions",
    (Col("date_key", INT, "int", False), Col("time_key", INT, "int", False),
     Col("account_key", INT, "int", False), Col("peer_account_key", INT, "int"),
     Col("transaction_type_key", INT, "int", False), Col("decline_reason_key", INT, "int"),
     Col("merchant_key", INT, "int"), Col("transaction_id", STR, "varchar(50)", False),
     Col("mc_transaction_id", STR, "varchar(50)"), Col("ach_transfer_id", STR, "varchar(50)"),
     Col("amount_minor", LONG, "bigint", False), Col("amount_egp", MONEY, "decimal(18,2)", False),
     Col("abs_amount_egp", MONEY, "decimal(18,2)", False), Col("fx_amount_minor", LONG, "bigint"),
     Col("exchange_rate_e6", LONG, "bigint"), Col("is_outbound", INT, "bit", False, BIT),
     Col("is_declined", INT, "bit", False, BIT), Col("is_fx", INT, "bit", False, BIT)),
    primary_key=("transaction_id",),
    foreign_keys=(FK("date_key", "dim_date", "date_key"), FK("time_key", "dim_time", "time_key"),
                  FK("account_key", "dim_account", "account_key"),
                  FK("peer_account_key", "dim_account", "account_key"),
                  FK("transaction_type_key", "dim_transaction_type", "transaction_type_key"),
                  FK("decline_reason_key", "dim_decline_reason", "decline_reason_key"),
                  FK("merchant_key", "dim_merchant", "merchant_key")))

STAR = {c.name: c for c in (DIM_DATE, DIM_TIME, DIM_LOCATION, DIM_ACCOUNT, DIM_MERCHANT,
                            DIM_TRANSACTION_TYPE, DIM_DECLINE_REASON, FACT_TRANSACTIONS)}

# Event-path lineage columns carried next to the fact columns.
KAFKA_LINEAGE = ("_kafka_topic", "_kafka_partition", "_kafka_offset", "_consumed_at_utc")
LINEAGE_SCHEMA = T.StructType([
    T.StructField("_kafka_topic", STR), T.StructField("_kafka_partition", INT),
    T.StructField("_kafka_offset", LONG), T.StructField("_consumed_at_utc", STR)])
