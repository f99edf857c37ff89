"""Catalog entries of the ingest side: conform, dedupe, dimension builders,
quality gate, incremental event path, validation and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import keys as K
from ..operators import dims as D
from ..operators import incremental as INC
from ..operators import quality as Q
from ..operators import rawreport as RR
from ..operators.dedupe import keep_first
from ..operators.merge import action_counts, merge_rows
from ..operators.validate import split_quality, validate_batch
from ..sources.events import flatten_envelope, payload_schema, split_dead_letters
from ..sources.landing import land
from . import adapter
from . import fixtures as FX
from .catalog import register
from .gold import star_tables

COMPARE_COLS = [c for c in C.FACT_TRANSACTIONS.names if c != "transaction_id"]


# -- landing (S1, S2, Q9) --------------------------------------------------------
@register("land_by_header")
def q_land_by_header(spark, sf_dir):
    """Accounts landed from CSV files of three layouts; records of the wrong
    width as dead letters."""
    landed = land(spark, FX.account_files(spark, sf_dir), C.DIM_ACCOUNT, FX.PROCESSED_AT)
    rows = landed.rows.withColumn("note", F.try_element_at("_extra", F.lit("note"))).drop("_source_file", "_extra")
    dead = landed.dead_letters.select("raw_record", "error", "_ingested_at_utc")
    return rows.unionByName(dead, allowMissingColumns=True)


# -- conform / dedupe (P1-P5, W1, U2) --------------------------------------------
@register("conform_txn")
def q_conform_txn(spark, sf_dir):
    from ..operators.conform import conform
    return conform(FX.dirty(spark, sf_dir), C.FACT_TRANSACTIONS)


@register("conform_lineage")
def q_conform_lineage(spark, sf_dir):
    """P2 on the bronze layer: contract columns plus typed lineage."""
    return FX.conform_events(FX.dirty(spark, sf_dir))


@register("dedupe_earliest")
def q_dedupe_earliest(spark, sf_dir):
    raw = adapter.raw_txn(FX.driver(spark, sf_dir)).select("transaction_id", *FX.LINEAGE3)
    return keep_first(raw, ["transaction_id"], ["_kafka_offset"]).drop("_kafka_topic")


@register("dedupe_natural_key")
def q_dedupe_natural_key(spark, sf_dir):
    raw = adapter.raw_txn(FX.driver(spark, sf_dir)).select("transaction_id", "_kafka_offset")
    return keep_first(raw, ["transaction_id"], ["_kafka_offset"], latest=True)


# -- dimension builders (D1-D6) --------------------------------------------------
@register("date_dim")
def q_date_dim(spark, sf_dir):
    return star_tables(spark, sf_dir)["dim_date"]


@register("time_dim")
def q_time_dim(spark, sf_dir):
    """Minute-of-day attributes of every event timestamp (the
    same derivations that build the 1,440-row clock dimension)."""
    e = FX.driver(spark, sf_dir)["events"].select("event_id", "ts")
    return D.clock_attributes(e, "ts").drop("ts")


@register("lookup_dim")
def q_lookup_dim(spark, sf_dir):
    c = FX.driver(spark, sf_dir)["customer"].select(F.col("c_mktsegment").alias("acquisition_channel"))
    return D.assign_lookup_keys(c, "acquisition_channel", "channel_key")


@register("branch_names")
def q_branch_names(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    m = t["dim_merchant"].join(t["dim_location"].select("location_key", "city"), "location_key", "inner")
    base = F.concat(F.col("merchant_category"), F.lit(" - "), F.col("city"))
    return D.numbered_names(m, ["merchant_category", "city"], "merchant_key", base, "branch_name") \
            .select("merchant_key", "branch_name")


@register("business_ids")
def q_business_ids(spark, sf_dir):
    f = star_tables(spark, sf_dir)["fact_transactions"]
    return f.select("transaction_id", K.padded_id("ACC", F.col("account_key"), 8).alias("account_id"),
                    K.padded_id("MER", F.col("merchant_key"), 6).alias("merchant_id"))


@register("derive_amounts")
def q_derive_amounts(spark, sf_dir):
    f = star_tables(spark, sf_dir)["fact_transactions"].select(
        "transaction_id", "abs_amount_egp", "is_outbound", "exchange_rate_e6")
    return D.derive_amounts(f)


# -- quality gate (Q*) -------------------------------------------------------------
def _dim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@register("raw_type_check")
def q_raw_type_check(spark, sf_dir):
    fact = Q.row_checks(FX.dirty(spark, sf_dir), "fact_transactions",
                        [c for c in Q.raw_type_checks(C.FACT_TRANSACTIONS) if not c.check.startswith("decimal")])
    dd = Q.row_checks(_dim_strings(star_tables(spark, sf_dir)["dim_date"]), "dim_date",
                      Q.raw_type_checks(C.DIM_DATE))
    return fact.unionByName(dd)


@register("raw_decimal_check")
def q_raw_decimal_check(spark, sf_dir):
    return Q.row_checks(FX.dirty(spark, sf_dir), "fact_transactions",
                        [c for c in Q.raw_type_checks(C.FACT_TRANSACTIONS) if c.check.startswith("decimal")])


@register("raw_length_check")
def q_raw_length_check(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    parts = [Q.row_checks(FX.dirty(spark, sf_dir), "fact_transactions", Q.length_checks(C.FACT_TRANSACTIONS))]
    for name in ("dim_account", "dim_merchant", "dim_time"):
        parts.append(Q.row_checks(_dim_strings(t[name]), name, Q.length_checks(C.STAR[name])))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("raw_report")
def q_raw_report(spark, sf_dir):
    """Q9-Q18: the validation report over all eight raw tables, with examples
    and statuses; the events' lineage columns are tolerated extras."""
    tables = FX.raw_tables(spark, sf_dir)
    out = None
    for name, contract in C.STAR.items():
        part = RR.table_report(name, tables[name], contract, tables, tolerated=tuple(FX.LINEAGE3))
        out = part if out is None else out.unionByName(part)
    return RR.with_status(out).withColumn("examples", F.array_join("examples", "; "))


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    return Q.row_checks(FX.dirty(spark, sf_dir), "fact_transactions",
                        Q.not_null_checks(C.FACT_TRANSACTIONS.required, blank_is_null=True))


@register("dq_domain")
def q_dq_domain(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    parts = []
    for name in ("dim_date", "dim_time", "dim_account", "dim_merchant", "fact_transactions"):
        doms = {c.name: c.domain for c in C.STAR[name].columns if c.domain}
        parts.append(Q.row_checks(t[name], name, Q.domain_checks(doms)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq_unique")
def q_dq_unique(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    raw = adapter.raw_txn(FX.driver(spark, sf_dir))
    checks = [(raw, "raw_txn", "transaction_id")]
    for name in ("dim_account", "dim_merchant", "dim_date", "dim_location"):
        checks += [(t[name], name, key) for key in [*C.STAR[name].primary_key, *C.STAR[name].unique]]
    return Q.check_unique_many(checks)


@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    """Q4: all relationships of a table in one pass over it."""
    t = dict(star_tables(spark, sf_dir))
    t["fact_transactions"] = FX.orphaned(t["fact_transactions"])
    out = None
    for name in ("fact_transactions", "dim_account", "dim_merchant"):
        part = Q.check_fks(t[name], name, [(fk.column, t[fk.parent], fk.parent_column, fk.parent)
                                           for fk in C.STAR[name].foreign_keys])
        out = part if out is None else out.unionByName(part)
    return out


@register("dq_summary")
def q_dq_summary(spark, sf_dir):
    return Q.run_gate(star_tables(spark, sf_dir), C.STAR)


@register("flag_fk_consistency")
def q_flag_fk_consistency(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    f = t["fact_transactions"].join(
        t["dim_transaction_type"].select("transaction_type_key", "transaction_group"), "transaction_type_key")
    checks = [
        Q.RowCheck("declined_has_reason", "decline_reason_key",
                   (F.col("is_declined") == 1) != F.col("decline_reason_key").isNotNull(), "warn"),
        Q.RowCheck("fx_has_rate", "exchange_rate_e6",
                   (F.col("is_fx") == 1) != F.col("exchange_rate_e6").isNotNull(), "warn"),
        Q.RowCheck("peer_is_transfer", "peer_account_key",
                   F.col("peer_account_key").isNotNull() != (F.col("transaction_group") == "Transfer"), "warn"),
    ]
    return Q.row_checks(f, "fact_transactions", checks)


@register("layer_counts")
def q_layer_counts(spark, sf_dir):
    """Q19: rows per layer from one tagged union (one job)."""
    raw = adapter.raw_txn(FX.driver(spark, sf_dir)).select(F.lit("bronze").alias("layer"))
    clean, _ = split_quality(FX.silver_candidates(spark, sf_dir))
    silver = clean.select(F.lit("silver").alias("layer"))
    gold = star_tables(spark, sf_dir)["fact_transactions"].select(F.lit("gold").alias("layer"))
    return raw.unionByName(silver).unionByName(gold).groupBy("layer").agg(F.count(F.lit(1)).alias("rows"))


@register("date_gaps")
def q_date_gaps(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    used = t["fact_transactions"].select("date_key").distinct()
    return t["dim_date"].join(used, "date_key", "left_anti").select("date_key", "full_date")


# -- incremental event path (J6, A9, I1-I8, S8, S9) --------------------------------
def _raw_lineage(spark, sf_dir) -> DataFrame:
    return adapter.raw_txn(FX.driver(spark, sf_dir)).select("transaction_id", *FX.LINEAGE3)


def _first_run_marks(raw: DataFrame) -> DataFrame:
    """The "previous run" consumed the lower half of the offset range."""
    offset = F.col("_kafka_offset")
    middle = raw.agg(F.floor((F.min(offset) + F.max(offset)) / 2).alias("m")).scalar()
    return INC.advance_marks(None, raw.where(offset < middle))


@register("offset_filter")
def q_offset_filter(spark, sf_dir):
    raw = _raw_lineage(spark, sf_dir)
    return INC.new_rows(raw, _first_run_marks(raw)).select("transaction_id", "_kafka_partition", "_kafka_offset")


@register("offset_marks")
def q_offset_marks(spark, sf_dir):
    raw = _raw_lineage(spark, sf_dir)
    marks = _first_run_marks(raw)
    return INC.advance_marks(marks, INC.new_rows(raw, marks))


@register("batch_id")
def q_batch_id(spark, sf_dir):
    return INC.partition_bounds(_raw_lineage(spark, sf_dir))


@register("dlq_split")
def q_dlq_split(spark, sf_dir):
    msgs = FX.event_messages(spark, sf_dir)
    good, dlq = split_dead_letters(msgs, FX.PROCESSED_AT)
    g = good.select(F.col("_kafka_offset").alias("event_id"), F.col("payload.transaction_id").alias("transaction_id"),
                    F.lit(None).cast("string").alias("error"))
    d = dlq.select(F.col("_kafka_offset").alias("event_id"), F.lit(None).cast("string").alias("transaction_id"),
                   "error")
    return g.unionByName(d)


@register("payload_flatten")
def q_payload_flatten(spark, sf_dir):
    """Bronze JSON envelope parsed with the explicit payload schema."""
    raw = adapter.raw_txn(FX.driver(spark, sf_dir))
    payload = F.struct(*[F.col(c).cast("string").alias(c) for c in C.FACT_TRANSACTIONS.names])
    bronze_text = raw.select(F.to_json(payload).alias("p"), *FX.LINEAGE3,
                             F.lit(FX.PROCESSED_AT).alias("_consumed_at_utc"))
    bronze = bronze_text.select(F.from_json("p", payload_schema()).alias("payload"), *FX.LINEAGE3,
                                "_consumed_at_utc")
    return flatten_envelope(bronze).select("transaction_id", "date_key", "amount_egp", *FX.LINEAGE3)


_DQ_OUT = ["_kafka_partition", "_kafka_offset", "transaction_id", "_dq_reason"]


@register("dq_split")
def q_dq_split(spark, sf_dir):
    from ..operators.validate import first_failing, silver_rules
    s = FX.silver_candidates(spark, sf_dir)
    return s.withColumn("_dq_reason", first_failing(silver_rules())).select(*_DQ_OUT)


@register("quarantine_all")
def q_quarantine_all(spark, sf_dir):
    _, quarantine = split_quality(FX.silver_candidates(spark, sf_dir))
    return quarantine.select(*_DQ_OUT)


@register("quarantine_reconcile")
def q_quarantine_reconcile(spark, sf_dir):
    """I8: new rows = silver + quarantine, counted in one tagged aggregate."""
    s = FX.silver_candidates(spark, sf_dir)
    clean, quarantine = split_quality(s)
    tagged = (s.select(F.lit("new").alias("k")).unionByName(clean.select(F.lit("silver").alias("k")))
               .unionByName(quarantine.select(F.lit("quarantine").alias("k"))))
    a = tagged.agg(F.count_if(F.col("k") == "new").alias("new_rows"),
                   F.count_if(F.col("k") == "silver").alias("silver_rows"),
                   F.count_if(F.col("k") == "quarantine").alias("quarantine_rows"))
    return a.withColumn("reconciled",
                        (F.col("silver_rows") + F.col("quarantine_rows") == F.col("new_rows")).cast("int"))


@register("published_batches")
def q_published_batches(spark, sf_dir):
    """Events of three batches, one of them replayed; the try of
    a fourth batch that was never published stays unseen."""
    import uuid

    from ..session import work_path
    from ..sources import batches as B

    events = FX.silver_candidates(spark, sf_dir).select("transaction_id", "_kafka_partition", "_kafka_offset")
    root = work_path(spark, "batches", uuid.uuid4().hex)
    for p in (0, 1, 2):
        B.write_batch_partition(events.where(F.col("_kafka_partition") == p), root, f"p{p}")
    B.write_batch_partition(events.where(F.col("_kafka_partition") == 1), root, "p1")
    B.write_attempt(events.where(F.col("_kafka_partition") == 2), root, "p3")
    parts = [B.read_batch(spark, root, b, events.columns) for b in B.list_batches(spark, root)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register("offset_resume")
def q_offset_resume(spark, sf_dir):
    """The event messages as a log in two instalments, the second with
    late lower offsets; what the stream reads of each, before and after a restart."""
    import uuid

    from ..session import work_path
    from ..sources.events import read_events
    from ..sources.offsetlog import write_log

    messages = FX.event_messages(spark, sf_dir)
    cut = messages.agg(F.max("offset")).first()[0] or 0
    early = (F.col("offset") <= F.lit(cut) * 6 / 10) & (F.col("offset") % 50 != 7)
    root = work_path(spark, "offset-log", uuid.uuid4().hex)

    def read_on(run: int) -> DataFrame:
        (read_events(spark, "offset_log", path=f"{root}/log").writeStream
         .foreachBatch(lambda df, _: df.write.mode("append").parquet(f"{root}/run{run}"))
         .option("checkpointLocation", f"{root}/marks").trigger(availableNow=True).start().awaitTermination())
        return spark.read.schema(messages.drop("event_id").schema).parquet(f"{root}/run{run}").withColumn("run", F.lit(run))

    write_log(messages.where(early), f"{root}/log")
    first = read_on(1)
    write_log(messages.where(~early), f"{root}/log")
    return first.unionByName(read_on(2)).select("run", "key", "topic", "partition", "offset")


# -- validation and merge (I11, I13, I19) ------------------------------------------
def _validated(spark, sf_dir) -> DataFrame:
    return validate_batch(FX.staged_batch(spark, sf_dir), star_tables(spark, sf_dir))


@register("fk_reject")
def q_fk_reject(spark, sf_dir):
    return _validated(spark, sf_dir).select("_kafka_partition", "_kafka_offset", "transaction_id", "reject_reason")


@register("reject_counts")
def q_reject_counts(spark, sf_dir):
    v = _validated(spark, sf_dir).where(F.col("reject_reason").isNotNull())
    return v.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def _merged(spark, sf_dir) -> DataFrame:
    return merge_rows(FX.merge_target(spark, sf_dir), FX.merge_batch_frame(spark, sf_dir), "transaction_id",
                      COMPARE_COLS)


@register("merge_result")
def q_merge_result(spark, sf_dir):
    return _merged(spark, sf_dir).drop("_action")


@register("merge_actions")
def q_merge_actions(spark, sf_dir):
    return action_counts(_merged(spark, sf_dir)).withColumnRenamed("_action", "action")


@register("key_index_lookup")
def q_key_index_lookup(spark, sf_dir):
    """Months of a batch's keys from the index: a first segment of the whole
    fact, a second with the ids ending in 1 moved to the next year."""
    import uuid

    from ..operators import keyindex as KX
    from ..session import work_path
    from ..sources.store import VersionedStore

    fact = star_tables(spark, sf_dir)["fact_transactions"].select("transaction_id", K.month_key("date_key").alias(KX.MONTH))
    store = VersionedStore(spark, work_path(spark, "key-index", uuid.uuid4().hex))
    last = F.substring("transaction_id", -1, 1)
    none, moved = fact.limit(0), fact.where(last == "1").withColumn(KX.MONTH, F.col(KX.MONTH) + 100)
    for changed in (none, moved):
        v = store.current_version()
        store.commit({KX.KEYS: KX.kept(store, v, changed, "transaction_id", "fact", fact)})
    batch = FX.new_ids(fact.where(last.isin("1", "2", "3")).select("transaction_id"))
    return KX.months_of(store, store.current_version(), batch, "transaction_id", fact)


@register("merge_summary")
def q_merge_summary(spark, sf_dir):
    """Staged / valid / rejected / inserted / updated for one batch, with
    the valid rows merged into the target (one tagged aggregate).  The batch is
    validated once: a valid row is one that the merge has an action for (the
    target holds a key once), a rejected one any other of the staged."""
    batch = FX.staged_batch(spark, sf_dir)
    v = validate_batch(batch, star_tables(spark, sf_dir))
    valid = v.where(F.col("reject_reason").isNull()).select(*C.FACT_TRANSACTIONS.names)
    merged = merge_rows(FX.merge_target(spark, sf_dir), FX.new_ids(valid), "transaction_id", COMPARE_COLS)
    tags = batch.select(F.lit("staged").alias("k")).unionByName(merged.select(F.col("_action").alias("k")))
    counts = tags.agg(
        F.count_if(F.col("k") == "staged").alias("rows_staged"),
        F.count_if(F.col("k").isin("INSERT", "UPDATE", "NOOP")).alias("rows_valid"),
        F.count_if(F.col("k") == "INSERT").alias("rows_inserted"),
        F.count_if(F.col("k") == "UPDATE").alias("rows_updated"))
    return counts.select("rows_staged", "rows_valid", (F.col("rows_staged") - F.col("rows_valid")).alias("rows_rejected"),
                         "rows_inserted", "rows_updated")
