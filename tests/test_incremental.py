"""Offset marks and batch ids."""
from starledger.operators.incremental import advance_marks, batch_bounds, new_rows


def frame(spark):
    rows = [("t", p, o) for p in (0, 1) for o in range(10)] + [("t", 1, None)]
    return spark.createDataFrame(rows, "_kafka_topic string, _kafka_partition int, _kafka_offset long")


def test_rows_without_an_offset_pass_to_quarantine(spark):
    df = frame(spark)
    assert new_rows(df, None).count() == 21
    marks = advance_marks(None, df)
    assert new_rows(df, marks).count() == 1
    assert {r._kafka_partition: r._kafka_offset for r in marks.collect()} == {0: 9, 1: 9}


def test_marks_strictly_greater(spark):
    df = frame(spark)
    marks = advance_marks(None, df.where("_kafka_partition = 0 AND _kafka_offset <= 4"))
    nr = new_rows(df, marks).where("_kafka_offset IS NOT NULL")
    assert nr.where("_kafka_partition = 0").count() == 5        # offsets 5..9
    assert nr.where("_kafka_partition = 1").count() == 10       # missing mark = -1
    m2 = {r._kafka_partition: r._kafka_offset for r in advance_marks(marks, nr).collect()}
    assert m2 == {0: 9, 1: 9}


def test_batch_id_single_and_multi_partition(spark):
    df = frame(spark).where("_kafka_offset IS NOT NULL")
    one = batch_bounds(df.where("_kafka_partition = 0")).collect()[0]
    assert one.batch_id == "b_000000000_000000009"
    a = batch_bounds(df).collect()[0].batch_id
    b = batch_bounds(df.where("_kafka_partition = 0 OR _kafka_offset < 9")).collect()[0].batch_id
    assert a != b and a.startswith("b_000000000_000000009_")    # X5: ranges differ -> ids differ


def test_marks_persist_atomically(spark, scratch):
    from starledger.operators.incremental import load_marks, save_marks
    from starledger.sources.store import VersionedStore
    st = VersionedStore(spark, f"{scratch}/marks")
    df = frame(spark)
    assert load_marks(st) is None
    df = df.where("_kafka_offset IS NOT NULL")
    first = df.where("_kafka_offset <= 4")
    v = save_marks(st, advance_marks(load_marks(st), new_rows(first, load_marks(st))))
    nxt = new_rows(df, load_marks(st))
    assert nxt.count() == 10                      # offsets 5..9 of both partitions
    save_marks(st, advance_marks(load_marks(st), nxt), expected_version=v)
    assert {r._kafka_partition: r._kafka_offset for r in load_marks(st).collect()} == {0: 9, 1: 9}
