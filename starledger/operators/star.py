"""Role-aware star joins.

Relationships are declared once (child fk -> parent pk, role, active).  A join
of a dimension is broadcast only when its planned size is under the session's
broadcast threshold; otherwise the plan keeps a shuffle join and AQE may still
switch it to a broadcast once the real size is known.  Nullable foreign keys
are joined ``left`` so facts without a member stay, shown as ``(Blank)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "(Blank)"


def _threshold(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = str(raw).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20),
                      ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    try:
        return int(float(raw) * mult)
    except ValueError:
        return 10 << 20


def planned_size(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (bytes, no job is run)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only behind a size check; beyond it the shuffle join stays."""
    limit = _threshold(df) if max_bytes is None else max_bytes
    if limit < 0:
        return df
    try:
        size = planned_size(df)
    except Exception:  # pragma: no cover - plan stats unavailable (e.g. Connect)
        return df
    return F.broadcast(df) if size <= limit else df


def is_small(df: DataFrame) -> bool:
    """Whether ``broadcast_if_small`` hints a broadcast of ``df``."""
    try:
        return 0 <= planned_size(df) <= _threshold(df)
    except Exception:  # pragma: no cover - plan stats unavailable
        return False


@dataclass(frozen=True)
class Relationship:
    child: str
    fk: str
    parent: str
    pk: str
    role: str
    active: bool = True
    nullable: bool = False


# The star's relationships: 8 active, 3 inactive role-playing ones.
RELATIONSHIPS = (
    Relationship("fact_transactions", "date_key", "dim_date", "date_key", "date"),
    Relationship("fact_transactions", "time_key", "dim_time", "time_key", "time"),
    Relationship("fact_transactions", "account_key", "dim_account", "account_key", "account"),
    Relationship("fact_transactions", "peer_account_key", "dim_account", "account_key", "peer", False, True),
    Relationship("fact_transactions", "transaction_type_key", "dim_transaction_type", "transaction_type_key", "type"),
    Relationship("fact_transactions", "decline_reason_key", "dim_decline_reason", "decline_reason_key",
                 "decline_reason", True, True),
    Relationship("fact_transactions", "merchant_key", "dim_merchant", "merchant_key", "merchant", True, True),
    Relationship("dim_account", "location_key", "dim_location", "location_key", "customer_location"),
    Relationship("dim_merchant", "location_key", "dim_location", "location_key", "merchant_location"),
    Relationship("dim_account", "signup_date_key", "dim_date", "date_key", "signup_date", False),
    Relationship("dim_merchant", "opened_date_key", "dim_date", "date_key", "opened_date", False),
)


def join_dim(df: DataFrame, dim: DataFrame, fk: str, pk: str, cols: list[str] | dict[str, str],
             how: str = "inner", blank: str | None = None) -> DataFrame:
    """Attach dimension attributes through ``fk = pk``.

    ``cols`` are the attributes to carry (a list, or {attr: output name}).  With
    ``how='left'`` and ``blank`` set, string attributes of rows without a member
    become ``blank`` (the BI '(Blank)' member)."""
    mapping = {c: c for c in cols} if isinstance(cols, list) else dict(cols)
    right = dim.select(F.col(pk).alias("__pk"), *[F.col(a).alias(o) for a, o in mapping.items()])
    right = broadcast_if_small(right)
    out = df.join(right, df[fk] == right["__pk"], how).drop("__pk")
    if blank is not None and how == "left":
        types = dict(right.dtypes)
        out = out.withColumns({o: F.coalesce(F.col(o), F.lit(blank)) for o in mapping.values()
                               if types.get(o) == "string"})
    return out


def with_role(dim: DataFrame, prefix: str, cols: list[str]) -> dict[str, str]:
    """Role-playing aliases: attribute -> ``<prefix>_<attribute>``."""
    return {c: f"{prefix}_{c}" for c in cols}


def outrigger(dim: DataFrame, fk: str, parent: DataFrame, pk: str, cols: dict[str, str]) -> DataFrame:
    """Enrich a dimension with its own parent (account -> location)."""
    return join_dim(dim, parent, fk, pk, cols, "inner")


def members_without_facts(dim: DataFrame, fact: DataFrame, key: str, fact_key: str | None = None) -> DataFrame:
    """Dimension members that no fact row references (anti join with the
    facts' distinct keys, which are combined before the shuffle)."""
    fk = fact.select(F.col(fact_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return dim.join(fk, key, "left_anti")


def fact_count_per_member(dim: DataFrame, fact: DataFrame, key: str, out: str = "fact_count",
                          fact_key: str | None = None) -> DataFrame:
    """Number of facts per member, 0 when none (aggregate before the join)."""
    counts = fact.groupBy(F.col(fact_key or key).alias(key)).agg(F.count(F.lit(1)).alias(out))
    return dim.join(counts, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("bigint")))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null fk has no parent row."""
    keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(broadcast_if_small(keys), fk, "left_anti")
