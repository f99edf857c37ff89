"""Corpus pipeline: quality filter, near-duplicate removal, benchmark
decontamination, source mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each result is
written as Parquet in the shared checkpoint folder and read back as the next
stage's input.  All stages but the last return the columns of ``documents``.

Cases, in every stage: rows are judged by their id and text, so a null or
repeated id joins no unlike texts; columns beyond these are carried along,
whatever their names; whole texts are read, however long; an empty table gives no
rows.  What a null or empty text and a tie mean is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starledger.llm import decontaminate, minhash, mixing, quality, sharding
from starledger.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on this input and the
    labels, doesn't reject (8).  A null or empty text has the score of the bias
    alone; a score equal to the threshold stays."""
    score = quality.scorer(quality.fit(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text")) >= quality.THRESHOLD)


def _same() -> Column:
    """What tells texts of one id, or without an id, apart."""
    return F.xxhash64(F.col("text"))


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group (10); of
    rows equal in id and text one stays (the first by the other columns), unlike
    texts under one id all do.  Null and wordless texts are linked with nothing
    and stay."""
    kept = (minhash.judged(docs).where("kept")
            .select(F.col("doc_id").alias("_kept"), F.col("same").alias("_kept_same")).distinct())
    first = Window.partitionBy("doc_id", "_same").orderBy(*_others(docs))
    return (docs.withColumn("_same", _same())
            .join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_same") == F.col("_kept_same")), "left_semi")
            .withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select(*docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage (9).  Null and empty texts hold none
    and stay; one passage within its edit budget is enough to go."""
    rows = docs.select(F.struct("doc_id", _same().alias("same")).alias("doc_id"), "text")
    # written first: its size is then known, and a small list is broadcast without moving any text
    found = written(decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"))
                    .select(F.col("doc_id.doc_id").alias("_leak"), F.col("doc_id.same").alias("_leak_same")).distinct(), "leaks")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("_leak")) & (_same() == F.col("_leak_same")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it (6), twice at most.  A text without
    words has size 0: it is repeated as its whole source is, and never taken to
    fill a target up.  Equal rows share their repetitions in order of the other
    columns."""
    taken = written(mixing.mixed(docs).groupBy(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), "same")
                    .agg(F.count(F.lit(1)).alias("_mix_rows"), F.sum("repetitions").alias("_mix_all"))
                    .where("_mix_all > 0").withColumnRenamed("same", "_mix_same"), "taken")
    ours = (F.col("doc_id").eqNullSafe(F.col("_mix_id")) & F.col("source").eqNullSafe(F.col("_mix_source"))
            & (_same() == F.col("_mix_same")))
    alone = docs.join(taken.where("_mix_rows = 1"), ours).withColumn("_times", F.col("_mix_all"))
    # equal rows are taken equally often, or some of them once more
    nth = F.row_number().over(Window.partitionBy("_mix_id", "_mix_source", "_mix_same").orderBy(*_others(docs)))
    equal = (docs.join(taken.where("_mix_rows > 1"), ours).withColumn("_nth", nth)
             .withColumn("_times", F.expr("_mix_all div _mix_rows + if(_nth <= _mix_all % _mix_rows, 1, 0)"))
             .drop("_nth").where("_times > 0"))
    return (alone.unionByName(equal)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select(*docs.columns))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row (3).  A null text has size 1, an empty one
    too; equal rows are interchangeable."""
    return sharding.shard(docs).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

ORACLE_SQL = None  # the classifier and min-hash stages have no SQL form; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
