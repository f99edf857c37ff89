"""Silver batches -> validated upsert into the gold fact with an audit log
(I10, I12, I14-I16, I18-I20).

Each batch is validated (reject rows are written, never dropped), merged, and
committed as a new store version whose commit record carries the audit row:
data and audit become visible together or not at all.  Failed attempts are
recorded separately and the error is re-raised.  A batch that already has a
SUCCESS commit is skipped, so re-running the loader is a no-op.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import FACT_LOOKUPS, FACT_TRANSACTIONS
from ..functions.keys import month_key
from ..operators import keyindex as KX
from ..operators.merge import merge_fact, merge_rows
from ..operators.star import broadcast_if_small
from ..operators.surrogate import assign_surrogate
from ..operators.validate import validate_batch
from ..sources.batches import list_batches, read_batch, write_batch_partition
from ..sources.store import Partitioned, VersionedStore

COMPARE_COLS = [c for c in FACT_TRANSACTIONS.names if c != "transaction_id"]
BATCH_COLS = [*FACT_TRANSACTIONS.names, "_kafka_partition", "_kafka_offset", "_silver_processed_at_utc"]


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


KEY, SK, OLD_MONTH = "transaction_id", "transaction_sk", "_old_month"


def _key_months(fact: DataFrame) -> DataFrame:
    return fact.select(KEY, month_key("date_key").alias(KX.MONTH))


def upsert_partitions(store: VersionedStore, version: int, valid: DataFrame, part_col: str = "date_month"):
    """I13 with a partition-scoped rewrite of a month-partitioned fact.

    The batch's keys are looked up in the key index (without one, in the fact's
    key and date columns); whole rows are read from the months that hold one of
    them.  Only months with the old or the new version of an inserted/updated row
    are rewritten, every other month folder is carried by reference.  Returns
    (Partitioned spec, merged batch rows)."""
    target = store.read("fact_transactions", version)
    keys = broadcast_if_small(valid.select(KEY).distinct())
    found = KX.months_of(store, version, keys, KEY, _key_months(target)).select(KX.MONTH).distinct()
    months = sorted(r[KX.MONTH] for r in found.collect())                # <= number of months
    existing = (store.read("fact_transactions", version, parts=months).join(keys, KEY, "left_semi")
                .withColumn(OLD_MONTH, month_key("date_key")))
    merged = merge_rows(existing, valid, KEY, COMPARE_COLS, [SK, OLD_MONTH]).persist()
    changed = merged.where(F.col("_action").isin("INSERT", "UPDATE"))
    both = changed.select(F.explode(F.array_compact(F.array(F.col(OLD_MONTH), month_key("date_key")))).alias("m"))
    touched = sorted(r["m"] for r in both.distinct().collect())          # <= number of months
    changed = changed.drop(OLD_MONTH)
    entry = store.table_path("fact_transactions", version)
    current_max = entry.get("max_key") if isinstance(entry, dict) else None
    if current_max is None:   # older commits: one scan of the key column
        current_max = target.agg(F.coalesce(F.max(SK), F.lit(0)).alias("m")).collect()[0]["m"]
    new_rows = changed.where(F.col("_action") == "INSERT").drop(SK, "_action")
    n_inserts = merged.where(F.col("_action") == "INSERT").count()        # merged is persisted
    inserts = assign_surrogate(new_rows, KEY, SK, int(current_max) + 1)
    updates = changed.where(F.col("_action") == "UPDATE").drop("_action")
    kept = store.read("fact_transactions", version, parts=touched).join(changed.select(KEY), KEY, "left_anti")
    rows = kept.unionByName(updates).unionByName(inserts).withColumn(part_col, month_key("date_key"))
    return Partitioned(rows, part_col, touched, ("date_key", KEY), max_key=int(current_max) + n_inserts,
                       bloom=FACT_LOOKUPS), merged


def upsert_tables(store: VersionedStore, version: int, valid: DataFrame) -> tuple[dict[str, Partitioned], DataFrame]:
    """The fact after a batch and its key index, to be committed together, and
    the merged batch rows.  A key gets an index entry when its row is new or has
    moved to another month."""
    fact, merged = upsert_partitions(store, version, valid)
    month = month_key("date_key")
    moved = merged.where((F.col("_action") == "INSERT") | ((F.col("_action") == "UPDATE") & (F.col(OLD_MONTH) != month)))
    index = KX.kept(store, version, moved.select(KEY, month.alias(KX.MONTH)), KEY, "fact_transactions",
                    _key_months(store.read("fact_transactions", version)))
    return {"fact_transactions": fact, KX.KEYS: index}, merged


def loaded_batches(store: VersionedStore) -> set[str]:
    """Batches with a SUCCESS commit; the newest commit lists them."""
    newest = store.manifest()
    if "batches" in newest or not newest["version"]:
        return set(newest.get("batches", []))
    out = set()          # commits of before the list was kept
    for m in store.commit_log():
        audit = m.get("meta", {}).get("audit")
        if audit and audit.get("status") == "SUCCESS":
            out.add(audit["silver_batch_id"])
    return out


def merge_batch(spark: SparkSession, store: VersionedStore, silver_root: str, batch_id: str,
                reject_root: str, loaded: set[str] | None = None) -> dict:
    """I11-I15 for one batch; returns the audit row."""
    if batch_id in (loaded_batches(store) if loaded is None else loaded):
        return {"silver_batch_id": batch_id, "status": "SKIPPED"}
    started, t0 = _now(), time.time()
    base_version = store.current_version()
    validated = merged = None
    try:
        batch = read_batch(spark, silver_root, batch_id, BATCH_COLS)
        tables = store.tables(base_version)
        validated = validate_batch(batch, tables).persist()
        rejected_at = _now().replace(tzinfo=None)
        rejects = (validated.where(F.col("reject_reason").isNotNull())
                            .withColumn("rejected_at_utc", F.lit(rejected_at).cast("timestamp")))
        write_batch_partition(rejects, reject_root, batch_id)
        valid = validated.where(F.col("reject_reason").isNull()).select(*FACT_TRANSACTIONS.names)
        if store.partitions("fact_transactions", base_version):
            frames, merged = upsert_tables(store, base_version, valid)
        else:  # an unpartitioned fact is rewritten whole
            new_fact, merged = merge_fact(tables["fact_transactions"], valid, KEY, COMPARE_COLS)
            frames = {"fact_transactions": new_fact}
        counts = (validated.select(F.when(F.col("reject_reason").isNull(), "valid").otherwise("rejected").alias("k"))
                  .unionByName(merged.select(F.col("_action").alias("k")))
                  .groupBy("k").count().collect())      # <= 6 rows: one per category
        c = {r["k"]: int(r["count"]) for r in counts}
        audit = {
            "silver_batch_id": batch_id, "status": "SUCCESS",
            "rows_staged": c.get("valid", 0) + c.get("rejected", 0), "rows_valid": c.get("valid", 0),
            "rows_inserted": c.get("INSERT", 0), "rows_updated": c.get("UPDATE", 0),
            "rows_rejected": c.get("rejected", 0), "started_at_utc": started.isoformat(),
        }

        def finished() -> dict:      # asked when the data is written
            audit.update(finished_at_utc=_now().isoformat(), duration_ms=int((time.time() - t0) * 1000))
            return {"audit": audit}

        store.commit(frames, meta=finished, expected_version=base_version)
        return audit
    except Exception as e:
        store.record_failure({"silver_batch_id": batch_id, "status": "FAILED", "error_message": str(e),
                              "started_at_utc": started.isoformat(), "finished_at_utc": _now().isoformat()})
        raise
    finally:
        if validated is not None:
            validated.unpersist()
        if merged is not None:
            merged.unpersist()


def run_merge(spark: SparkSession, store: VersionedStore, silver_root: str, reject_root: str) -> dict:
    """Backlog in order, one commit per batch, stop at the first failure."""
    loaded = loaded_batches(store)
    pending = [b for b in list_batches(spark, silver_root) if b not in loaded]
    done, failed = [], None
    for b in pending:
        try:
            done.append(merge_batch(spark, store, silver_root, b, reject_root, loaded))
        except Exception as e:  # stop; the next run retries this batch
            failed = {"silver_batch_id": b, "error": str(e)}
            break
    totals = {k: sum(a.get(k, 0) for a in done) for k in ("rows_staged", "rows_valid", "rows_inserted",
                                                            "rows_updated", "rows_rejected")}
    return {"batches": done, "failed": failed, "totals": totals, "ok": failed is None}


def audit_log(spark: SparkSession, store: VersionedStore) -> DataFrame:
    """SUCCESS rows from commits plus FAILED attempts, newest first (T5)."""
    rows = [m["meta"]["audit"] for m in store.commit_log() if m.get("meta", {}).get("audit")]
    rows += store.failures()
    schema = ("silver_batch_id string, status string, rows_staged long, rows_valid long, rows_inserted long, "
              "rows_updated long, rows_rejected long, started_at_utc string, finished_at_utc string, "
              "duration_ms long, error_message string")
    names = [f.split()[0] for f in schema.split(", ")]
    rows.sort(key=lambda r: r.get("finished_at_utc") or "")
    data = [(*[r.get(n) for n in names], i) for i, r in enumerate(rows, 1)]     # log_id: order of finishing
    return spark.createDataFrame(data, f"{schema}, log_id long").orderBy(F.desc("log_id"))
