"""Derived fixture frames for the ingest-side queries (FIXTURES.md §3).

All are plans over the driver tables or the gold star: the dirty string
events, the conformed silver candidates, FK-reduced dimensions, the merge
target/batch pair and the event messages with poison values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import FACT_TRANSACTIONS, LINEAGE_SCHEMA
from ..operators.conform import conform
from . import adapter
from .gold import star_tables

LINEAGE3 = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]
PROCESSED_AT = "2024-01-01T00:00:00.000Z"   # one run timestamp for the whole batch


def driver(spark: SparkSession, sf_dir: str) -> adapter.DriverTables:
    return adapter.DriverTables(spark, sf_dir)


def dirty_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string events with injected faults (blank id, 'N/A' amount, ' ' date)."""
    return adapter.dirty_raw_txn(driver(spark, sf_dir))


def conform_events(bronze: DataFrame) -> DataFrame:
    """Conformed events with typed lineage."""
    types = {f.name: f.dataType for f in LINEAGE_SCHEMA.fields}
    return conform(bronze, FACT_TRANSACTIONS, LINEAGE3, types)


def silver_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_events(dirty_plan(spark, sf_dir))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze event layer (written once per input folder)."""
    from .gold import bronze_events
    return bronze_events(spark, sf_dir)


def silver_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conformed silver event layer (written once per input folder)."""
    from .gold import silver_events
    return silver_events(spark, sf_dir)


def orphaned(df: DataFrame) -> DataFrame:
    """Some foreign keys turned into keys that no dimension has (their
    negatives), so FK rules have orphans to find; the dimensions stay whole."""
    def turned(c: str, n: int):
        return F.when(F.col(c) % n == 0, -F.col(c)).otherwise(F.col(c)).alias(c)
    every = {"account_key": 50, "peer_account_key": 50, "merchant_key": 10}
    return df.select(*[turned(c, every[c]) if c in every else F.col(c) for c in df.columns])


def staged_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphaned(silver_candidates(spark, sf_dir)).withColumn("_silver_processed_at_utc", F.lit(PROCESSED_AT))


def new_ids(df: DataFrame) -> DataFrame:
    """Ids ending in 3 become ids that no table has: transactions of their own."""
    key = F.col("transaction_id")
    return df.withColumn("transaction_id", F.when(F.substring(key, -1, 1) == "3", F.concat(key, F.lit("N"))).otherwise(key))


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact."""
    return star_tables(spark, sf_dir)["fact_transactions"].select(*FACT_TRANSACTIONS.names)


def merge_batch_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact again: ids ending in 1 carry an amount correction, ids
    ending in 2 of type 3 get an ACH id (NULL -> value), ids ending in 3 are new
    (so the target's own stay untouched), all others are replays."""
    last = F.substring("transaction_id", -1, 1)
    changed = {"amount_egp": F.when(last == "1", F.col("amount_egp") + 1).otherwise(F.col("amount_egp")).cast("decimal(18,2)"),
               "amount_minor": F.when(last == "1", F.col("amount_minor") + 100).otherwise(F.col("amount_minor")),
               "ach_transfer_id": F.when((last == "2") & (F.col("transaction_type_key") == 3), F.lit("ACH-FIX"))
               .otherwise(F.col("ach_transfer_id"))}
    return new_ids(merge_target(spark, sf_dir).withColumns(changed))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records from the driver ``events`` table, with poison
    values: truncated JSON, a bare number, and empty values."""
    e = driver(spark, sf_dir)["events"].select("event_id", "value", "event_type")
    eid = F.col("event_id")
    obj = F.concat(F.lit('{"transaction_id": "EVT'), eid.cast("string"), F.lit('", "amount_egp": "'),
                   F.col("value").cast("string"), F.lit('", "event_type": "'), F.col("event_type"), F.lit('"}'))
    value = (F.when(eid % 97 == 0, F.concat(F.lit('{"transaction_id": '), eid.cast("string")))
             .when(eid % 89 == 0, F.lit("42"))
             .when(eid % 83 == 0, F.lit(""))
             .otherwise(obj))
    return e.select(eid, eid.cast("string").alias("key"), value.alias("value"),
                    F.lit(adapter.TOPIC).alias("topic"), (eid % 3).cast("int").alias("partition"),
                    eid.alias("offset"))


def account_files(spark: SparkSession, sf_dir: str) -> str:
    """dim_account as CSV files of three layouts: as contracted; reversed with a
    column more; without the nullable age_band, and every tenth record of these
    cut short by a field.  Returns the folder."""
    import uuid

    from ..session import work_path

    root = work_path(spark, "landing", uuid.uuid4().hex)
    names = star_tables(spark, sf_dir)["dim_account"].columns
    accounts = star_tables(spark, sf_dir)["dim_account"].select(*[F.col(c).cast("string").alias(c) for c in names])
    key = F.col("account_key").cast("long")
    accounts.where(key % 3 == 0).write.option("header", True).csv(f"{root}/a")
    (accounts.where(key % 3 == 1).select(F.concat(F.lit("no. "), "account_key").alias("note"), *reversed(names))
     .write.option("header", True).csv(f"{root}/b"))
    short = [c for c in names if c != "age_band"]
    line = F.concat_ws(",", *short)
    cut = F.when(key % 10 == 0, F.concat_ws(",", *short[:-1])).otherwise(line)
    # one column whose name is the header line: records of any width
    (accounts.where(key % 3 == 2).select(cut.alias(",".join(short)))
     .write.options(header=True, sep="\u0001", quote="\u0002").csv(f"{root}/c"))
    return f"{root}/*"


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight tables as raw text: the events with their faults, every tenth
    merchant key turned into one that no merchant has."""
    raw = {name: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
           for name, df in star_tables(spark, sf_dir).items() if name != "fact_transactions"}
    key = F.col("merchant_key")
    lost = F.when(key.try_cast("int") % 10 == 0, F.concat(F.lit("-"), key)).otherwise(key)
    return {**raw, "fact_transactions": dirty(spark, sf_dir).withColumn("merchant_key", lost)}
