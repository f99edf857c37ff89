"""Key index of a month-partitioned fact (J10, I13): business key -> month.

An upsert must know which months hold its keys.  The index answers that without
the fact: a narrow side table of the same store, committed with the fact, sorted
by key in small row groups with Bloom filters.  A batch's key range, and for a
small batch its keys themselves, are pushed into the scan, so what is read
depends on the batch and not on the fact.

The index is kept in segments: one from its first build, one per upsert with the
keys whose month it set.  The newest segment that holds a key is right.  When
there are ``SEGMENTS`` of them the next upsert writes them as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import Partitioned, VersionedStore

KEYS = "fact_keys"
SEGMENTS = 16
#: a batch of at most this many keys is pushed as a list (its keys come to the driver)
LISTED = 100
ROW_GROUP = 1 << 20
MONTH, SINCE, SEGMENT = "month", "since", "segment"


def entries(df: DataFrame, key: str, month: Column, since: int) -> DataFrame:
    return df.select(key, month.cast("int").alias(MONTH), F.lit(since).alias(SINCE))


def _spec(rows: DataFrame, key: str, of: str, segment: int, replace: list | None) -> Partitioned:
    return Partitioned(rows.withColumn(SEGMENT, F.lit(segment)), SEGMENT, replace, (key,), bloom=(key,), index_of=of,
                       options={"parquet.block.size": str(ROW_GROUP)})


def near(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df`` cut to what may hold one of ``keys``, by filters that row group
    statistics and Bloom filters answer.  One small job over the keys."""
    first = keys.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(key).alias("n")).first()
    if not first["n"]:
        return df.where(F.lit(False))
    df = df.where(F.col(key).between(first["lo"], first["hi"]))
    if first["n"] > LISTED:
        return df
    listed = [F.col(key) == r[key] for r in keys.where(F.col(key).isNotNull()).collect()]      # LISTED at most
    while len(listed) > 1:          # a balanced tree: its depth grows with the logarithm
        listed = [reduce(lambda a, b: a | b, listed[i:i + 2]) for i in range(0, len(listed), 2)]
    return df.where(listed[0])


def months_of(store: VersionedStore, version: int, keys: DataFrame, key: str, fallback: DataFrame) -> DataFrame:
    """key, month of those ``keys`` (distinct) that the fact holds; ``fallback``
    (the same of the whole fact) is read when no index is kept yet."""
    if KEYS not in store.manifest(version)["tables"]:
        return near(fallback, keys, key).join(keys, key, "left_semi")
    found = near(store.read(KEYS, version), keys, key).join(keys, key, "left_semi")
    return found.groupBy(key).agg(F.max_by(MONTH, SINCE).alias(MONTH))


def kept(store: VersionedStore, version: int, changed: DataFrame, key: str, of: str, whole: DataFrame) -> Partitioned:
    """The index after ``changed`` (key, month) rows: a segment more, or all of
    it as one (the first build reads ``whole``: key, month of the fact)."""
    new = entries(changed, key, F.col(MONTH), version + 1)
    if KEYS not in store.manifest(version)["tables"]:
        rows = entries(whole, key, F.col(MONTH), version).unionByName(new)
        return _spec(rows, key, of, version + 1, None)
    if len(store.partitions(KEYS, version)) < SEGMENTS:
        return _spec(new, key, of, version + 1, [version + 1])
    rows = store.read(KEYS, version).unionByName(new)
    rows = rows.groupBy(key).agg(F.max_by(MONTH, SINCE).alias(MONTH), F.max(SINCE).alias(SINCE))
    return _spec(rows, key, of, version + 1, None)
