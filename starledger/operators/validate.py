"""Quality split of a silver batch (I6, I7, U1, P7) and the 11-rule pre-merge
validation (I11, J7, W2).

Rules are evaluated as one first-match ``CASE``; their order is part of the
contract (X7).  Foreign-key rules read one ``hit`` flag per relationship from
a left join against the parent's key set (a single pass over the batch instead
of one NOT EXISTS per rule); of several failing rules the first is kept as its
place in ``REJECT_REASONS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import flag_duplicates, null_salt
from .star import broadcast_if_small, is_small

# Fixed rule names (reason strings are part of the data contract).
SILVER_RULES = ("missing_transaction_id", "invalid_or_missing_date_key", "invalid_or_missing_amount")
DUPLICATE_REASON = "duplicate_transaction_id"


def first_failing(rules: list[tuple[str, Column]]) -> Column:
    """the reason of the first rule whose predicate holds, else NULL."""
    expr = None
    for reason, pred in rules:
        cond = F.coalesce(pred, F.lit(False))
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr.otherwise(F.lit(None).cast("string")) if expr is not None else F.lit(None).cast("string")


def silver_rules() -> list[tuple[str, Column]]:
    """The silver data-quality rules, in order."""
    return [
        ("missing_transaction_id", F.col("transaction_id").isNull()),
        ("invalid_or_missing_date_key", F.col("date_key").isNull()),
        ("invalid_or_missing_amount", F.col("amount_egp").isNull()),
        # not of the reference, which loses such rows without a trace
        ("missing_kafka_offset", F.col("_kafka_offset").isNull()),
    ]


def flag_quality(df: DataFrame, rules: list[tuple[str, Column]] | None = None, key: str = "transaction_id",
                 order_by: list[str] = ("_kafka_offset",), identity: list[str] = ("_kafka_partition", "_kafka_offset"),
                 reason_col: str = "_dq_reason") -> DataFrame:
    """Every row with its quarantine reason (NULL = clean): the first
    failing rule, else ``duplicate_transaction_id`` for a later copy of a key
    among the valid rows.  One frame, so a caller can persist it once and
    write both the clean and the quarantine sink from it."""
    flagged = df.withColumn(reason_col, first_failing(rules or silver_rules()))
    valid_key = F.when(F.col(reason_col).isNull(), F.col(key))
    marked = flag_duplicates(flagged.withColumn("__vk", valid_key), ["__vk"], list(order_by), list(identity),
                             latest=False, flag="__dup")
    return (marked.withColumn(reason_col, F.when(F.col("__dup"), F.lit(DUPLICATE_REASON))
                              .otherwise(F.col(reason_col)))
                  .drop("__vk", "__dup"))


def split_quality(df: DataFrame, rules: list[tuple[str, Column]] | None = None, key: str = "transaction_id",
                  order_by: list[str] = ("_kafka_offset",), identity: list[str] = ("_kafka_partition", "_kafka_offset"),
                  reason_col: str = "_dq_reason") -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine).  Invalid rows carry the first failing
    rule; among valid rows the earliest copy of a key is kept and later copies
    are quarantined as duplicates."""
    flagged = flag_quality(df, rules, key, order_by, identity, reason_col)
    return split_flagged(flagged, reason_col)


def split_flagged(flagged: DataFrame, reason_col: str = "_dq_reason") -> tuple[DataFrame, DataFrame]:
    clean = flagged.where(F.col(reason_col).isNull()).drop(reason_col)
    return clean, flagged.where(F.col(reason_col).isNotNull())


# -- pre-merge validation -------------------------------------------------------
REJECT_REASONS = (
    "null_transaction_id", "duplicate_transaction_id_in_staging", "missing_required_key", "null_measure",
    "fk_date_not_found", "fk_time_not_found", "fk_account_not_found", "fk_peer_account_not_found",
    "fk_txn_type_not_found", "fk_decline_reason_not_found", "fk_merchant_not_found",
)

FK_RULES = (  # (reason, fk column, dimension, pk, nullable fk)
    ("fk_date_not_found", "date_key", "dim_date", "date_key", False),
    ("fk_time_not_found", "time_key", "dim_time", "time_key", False),
    ("fk_account_not_found", "account_key", "dim_account", "account_key", False),
    ("fk_peer_account_not_found", "peer_account_key", "dim_account", "account_key", True),
    ("fk_txn_type_not_found", "transaction_type_key", "dim_transaction_type", "transaction_type_key", False),
    ("fk_decline_reason_not_found", "decline_reason_key", "dim_decline_reason", "decline_reason_key", True),
    ("fk_merchant_not_found", "merchant_key", "dim_merchant", "merchant_key", True),
)


def _parent_keys(parent: DataFrame, pk: str, hit: str) -> DataFrame:
    """``pk`` is the parent's declared key (the gate checks it), so no distinct."""
    return (parent.select(F.col(pk).alias("__k"), F.lit(0).alias("__ks"), F.lit(True).alias(hit))
            .where(F.col(pk).isNotNull()))


def _with_hit(df: DataFrame, fk: str, keys: DataFrame) -> DataFrame:
    """Rows without the foreign key are dealt out by a salt."""
    spread = [c for c in ("transaction_id", "_kafka_offset") if c in df.columns] or [df.columns[0]]
    salted = df.withColumn("__s", null_salt([fk], spread))
    return salted.join(broadcast_if_small(keys), (F.col(fk) == F.col("__k")) & (F.col("__s") == F.col("__ks")),
                       "left").drop("__k", "__ks", "__s")


def _first_code(rules: list[tuple[str, Column]]) -> Column:
    """The place in ``REJECT_REASONS`` of the first rule that holds, else NULL."""
    expr = F.lit(None).cast("int")
    for code, pred in sorted(((REJECT_REASONS.index(r), p) for r, p in rules), key=lambda x: -x[0]):
        expr = F.when(F.coalesce(pred, F.lit(False)), F.lit(code)).otherwise(expr)
    return expr


def validate_batch(batch: DataFrame, dims: dict[str, DataFrame], order_by: list[str] = ("_silver_processed_at_utc",
                   "_kafka_offset"), identity: list[str] = ("_kafka_partition", "_kafka_offset"),
                   key: str = "transaction_id") -> DataFrame:
    """Add ``reject_reason`` (NULL = valid).  Duplicates: the latest copy
    wins (processed time, then offset, descending: X6).

    What a row shows by itself or against a dimension small enough to broadcast
    is judged before the rows are moved to find duplicates, so they carry one
    number for it; larger dimensions are met afterwards."""
    own = [
        ("null_transaction_id", F.col(key).isNull() | (F.trim(F.col(key)) == "")),
        ("missing_required_key", F.col("date_key").isNull() | F.col("time_key").isNull()
         | F.col("account_key").isNull() | F.col("transaction_type_key").isNull()),
        ("null_measure", F.col("amount_minor").isNull() | F.col("amount_egp").isNull()
         | F.col("abs_amount_egp").isNull()),
    ]
    keys = {r: _parent_keys(dims[dim], pk, f"__{r}") for r, _, dim, pk, _ in FK_RULES}
    near = [rule for rule in FK_RULES if is_small(keys[rule[0]])]
    far = [rule for rule in FK_RULES if rule not in near]

    def judge(df: DataFrame, fks: list[tuple], rules: list[tuple[str, Column]], code: str) -> DataFrame:
        out = df
        for reason, fk, _, _, nullable in fks:
            out = _with_hit(out, fk, keys[reason])
            miss = F.col(f"__{reason}").isNull()
            rules = [*rules, (reason, (F.col(fk).isNotNull() & miss) if nullable else miss)]
        return out.select(*df.columns, _first_code(rules).alias(code))

    df = flag_duplicates(batch, [key], list(order_by), list(identity), latest=True, flag="__dup",
                         attach=lambda rows: judge(rows, near, own, "__near"))
    df = judge(df, far, [(REJECT_REASONS[1], F.col("__dup"))], "__far")
    code = F.least("__near", "__far")
    # element_at gives a value for a NULL place
    reason = F.when(code.isNotNull(), F.element_at(F.array(*[F.lit(r) for r in REJECT_REASONS]), code + 1))
    return df.withColumn("reject_reason", reason).drop("__dup", "__near", "__far")
