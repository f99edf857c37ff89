"""Event envelopes, dead letters and bronze event scans.

A message is ``(key, value, topic, partition, offset)``.  Values that are
NULL/empty, not valid JSON, or valid JSON that is not an object go to the
dead-letter frame with the raw text and an error label (X9); objects are
parsed with an explicit all-string payload schema (no inference, X11) and
wrapped in the bronze envelope with Kafka lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import FACT_TRANSACTIONS, KAFKA_LINEAGE, TableContract
from . import offsetlog


def _lineage() -> list:
    return [F.col("topic").alias("_kafka_topic"), F.col("partition").cast("int").alias("_kafka_partition"),
            F.col("offset").cast("bigint").alias("_kafka_offset")]


def payload_schema(contract: TableContract = FACT_TRANSACTIONS) -> T.StructType:
    return contract.string_schema()


def bronze_schema(contract: TableContract = FACT_TRANSACTIONS) -> T.StructType:
    return T.StructType([
        T.StructField("payload", payload_schema(contract)),
        T.StructField("_kafka_topic", T.StringType()), T.StructField("_kafka_partition", T.IntegerType()),
        T.StructField("_kafka_offset", T.LongType()), T.StructField("_consumed_at_utc", T.StringType())])


def classify_value(value) -> F.Column:
    """Error label of a message value (NULL = a JSON object)."""
    v = F.col(value) if isinstance(value, str) else value
    text = v.cast("string")
    parsed = F.try_parse_json(text)
    return (F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty_value"))
            .when(parsed.isNull(), F.lit("invalid_json"))
            .when(~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("not_an_object"))
            .otherwise(F.lit(None).cast("string")))


def value_text(messages: DataFrame) -> F.Column:
    """message value as text; invalid UTF-8 bytes are replaced (U+FFFD)
    so the raw value can always be kept in the dead-letter table."""
    return F.make_valid_utf8(F.col("value").cast("string"))


def split_dead_letters(messages: DataFrame, consumed_at: str,
                       contract: TableContract = FACT_TRANSACTIONS) -> tuple[DataFrame, DataFrame]:
    """(bronze envelopes, dead letters) from one message frame."""
    text = value_text(messages)
    flagged = messages.withColumn("__err", classify_value(text)).withColumn("__text", text)
    lineage = [*_lineage(), F.lit(consumed_at).alias("_consumed_at_utc")]
    good = flagged.where(F.col("__err").isNull()).select(
        F.from_json(F.col("__text"), payload_schema(contract)).alias("payload"), *lineage)
    dlq = flagged.where(F.col("__err").isNotNull()).select(
        F.col("__text").alias("raw_value"), F.col("__err").alias("error"), *lineage)
    return good, dlq


def flatten_envelope(bronze: DataFrame) -> DataFrame:
    """Payload fields + lineage columns."""
    return bronze.select("payload.*", *KAFKA_LINEAGE)


def read_bronze_events(spark: SparkSession, path: str, contract: TableContract = FACT_TRANSACTIONS) -> DataFrame:
    """JSONL bronze with an explicit schema; a missing folder is an
    empty frame (graceful no-op), not an error."""
    from . import fs
    schema = bronze_schema(contract)
    if not fs.exists(spark, path):
        return flatten_envelope(spark.createDataFrame([], schema))
    return flatten_envelope(spark.read.schema(schema).json(path))


def read_events(spark: SparkSession, fmt: str = "kafka", options: dict | None = None, streaming: bool = True,
                path: str | None = None) -> DataFrame:
    """Subscribe from the earliest offset (Kafka), follow a log of Parquet
    files by offset (``offset_log``), or read a file source of message records
    ``key, value, topic, partition, offset``."""
    opts = {"startingOffsets": "earliest", **(options or {})} if fmt == "kafka" else dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        r = reader.format("kafka")
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load()
    if fmt == offsetlog.FORMAT:
        offsetlog.register(spark)
        return reader.format(fmt).options(**opts).load(path)
    schema = "key string, value string, topic string, partition int, offset bigint"
    r = reader.format(fmt).schema(schema)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)
