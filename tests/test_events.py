"""Dead-letter routing of poison values."""
from starledger.sources.events import flatten_envelope, split_dead_letters


def test_poison_values(spark):
    rows = [('{"transaction_id": "T1", "amount_egp": "10.00"}', 0), ("42", 1), ("[1]", 2), ("{bad", 3), ("", 4),
            (None, 5)]
    msgs = spark.createDataFrame([(str(o), v, "t", 0, o) for v, o in rows],
                                 "key string, value string, topic string, partition int, offset long")
    good, dlq = split_dead_letters(msgs, "2024-01-01T00:00:00Z")
    errs = {r._kafka_offset: r.error for r in dlq.collect()}
    assert errs == {1: "not_an_object", 2: "not_an_object", 3: "invalid_json", 4: "empty_value", 5: "empty_value"}
    flat = flatten_envelope(good).collect()
    assert len(flat) == 1 and flat[0].transaction_id == "T1" and flat[0].amount_egp == "10.00"
    assert flat[0]._kafka_offset == 0


def test_invalid_utf8_kept_in_dead_letters(spark):
    from pyspark.sql import functions as F
    msgs = spark.createDataFrame([(bytearray(b"\xff\xfe{bad"), 7)], "value binary, offset long") \
        .select(F.lit("k").alias("key"), "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset")
    good, dlq = split_dead_letters(msgs, "ts")
    r = dlq.collect()
    assert good.count() == 0 and len(r) == 1 and r[0].error == "invalid_json" and "�" in r[0].raw_value
