"""Semantic measure layer.

A measure is a final expression over *base aggregates*.  ``query`` gathers the
base aggregates of all requested measures and evaluates them in one ``agg``
(one scan, partial aggregation before the shuffle), then applies the final
expressions, HAVING, ORDER BY and top-n.  Ratios are exact half-up integers
in parts per million (``*_ppm``); money is decimal.

``star`` builds the joined frame a query needs: only the requested roles are
joined, nullable roles are left-joined and show ``(Blank)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact as X
from .star import BLANK, join_dim

# -- base aggregates -----------------------------------------------------------
def ABS() -> Column:
    return F.col("abs_amount_egp")


def AMT() -> Column:
    return F.col("amount_egp")


def _flag(c: str) -> Column:
    return F.col(c) == 1


BASE: dict[str, Callable[[], Column]] = {
    "n": lambda: F.count(F.lit(1)),
    "gross": lambda: F.sum(ABS()).cast(X.MONEY_SUM),
    "net": lambda: F.sum(AMT()).cast(X.MONEY_SUM),
    "declined": lambda: F.count_if(_flag("is_declined")),
    "fx": lambda: F.count_if(_flag("is_fx")),
    "fx_vol": lambda: F.sum(F.when(_flag("is_fx"), ABS())).cast(X.MONEY_SUM),
    "fx_rate_sum": lambda: F.sum(F.when(_flag("is_fx"), F.col("exchange_rate_e6"))),
    "fx_rate_n": lambda: F.count(F.when(_flag("is_fx"), F.col("exchange_rate_e6"))),
    "out_vol": lambda: F.sum(F.when(_flag("is_outbound"), ABS())).cast(X.MONEY_SUM),
    "in_vol": lambda: F.sum(F.when(F.col("is_outbound") == 0, ABS())).cast(X.MONEY_SUM),
    "declined_vol": lambda: F.sum(F.when(_flag("is_declined"), ABS())).cast(X.MONEY_SUM),
    "accounts": lambda: F.count_distinct(F.col("account_key")),
    "merchants": lambda: F.count_distinct(F.col("merchant_key")),
    "p2p": lambda: F.count(F.col("peer_account_key")),
    "weekend_vol": lambda: F.sum(F.when(_flag("is_weekend"), ABS())).cast(X.MONEY_SUM),
    "weekday_vol": lambda: F.sum(F.when(F.col("is_weekend") == 0, ABS())).cast(X.MONEY_SUM),
    "daytime": lambda: F.count_if(_flag("is_daytime")),
    "surcharge": lambda: F.sum(ABS() * F.lit(0.005).cast("decimal(4,3)")).cast("decimal(38,5)"),
}


@dataclass(frozen=True)
class Measure:
    name: str
    needs: tuple[str, ...]
    final: Callable[[], Column]
    doc: str = ""


def _b(name: str) -> Column:
    return F.col(f"__{name}")


def _avg_rate() -> Column:
    e6 = X.half_up_div(_b("fx_rate_sum"), _b("fx_rate_n"))
    return (e6 * F.lit(0.000001).cast("decimal(7,6)")).cast("decimal(24,6)")


MEASURES: dict[str, Measure] = {m.name: m for m in [
    Measure("transaction_count", ("n",), lambda: _b("n"), "M1"),
    Measure("gross_volume", ("gross",), lambda: _b("gross"), "M2"),
    Measure("net_flow", ("net",), lambda: _b("net"), "M3"),
    Measure("average_ticket", ("gross", "n"), lambda: X.avg_money(_b("gross"), _b("n")), "M4"),
    Measure("declined_transactions", ("declined",), lambda: _b("declined"), "M5"),
    Measure("approved_transactions", ("n", "declined"), lambda: _b("n") - _b("declined"), "M6"),
    Measure("decline_rate_ppm", ("declined", "n"), lambda: X.ratio_ppm(_b("declined"), _b("n")), "M7"),
    Measure("fx_transactions", ("fx",), lambda: _b("fx"), "M8"),
    Measure("fx_share_ppm", ("fx", "n"), lambda: X.ratio_ppm(_b("fx"), _b("n")), "M9"),
    Measure("fx_volume", ("fx_vol",), lambda: _b("fx_vol"), "M10"),
    Measure("avg_exchange_rate", ("fx_rate_sum", "fx_rate_n"), _avg_rate, "M11"),
    Measure("outbound_volume", ("out_vol",), lambda: _b("out_vol"), "M12"),
    Measure("inbound_volume", ("in_vol",), lambda: _b("in_vol"), "M13"),
    Measure("active_accounts", ("accounts",), lambda: _b("accounts"), "M14"),
    Measure("distinct_merchants", ("merchants",), lambda: _b("merchants"), "M15"),
    Measure("avg_txn_per_account_ppm", ("n", "accounts"), lambda: X.ratio_ppm(_b("n"), _b("accounts")), "M16"),
    Measure("weekend_volume", ("weekend_vol",), lambda: _b("weekend_vol"), "M22"),
    Measure("weekday_volume", ("weekday_vol",), lambda: _b("weekday_vol"), "M22"),
    Measure("daytime_transactions", ("daytime",), lambda: _b("daytime"), "M23"),
    Measure("declined_volume", ("declined_vol",), lambda: _b("declined_vol"), "M24"),
    Measure("total_surcharge", ("surcharge",), lambda: _b("surcharge"), "M26"),
    Measure("p2p_transactions", ("p2p",), lambda: _b("p2p"), "M31"),
]}

CORE_KPIS = ["transaction_count", "gross_volume", "net_flow", "average_ticket", "declined_transactions",
             "approved_transactions", "decline_rate_ppm", "fx_transactions", "fx_share_ppm", "fx_volume",
             "outbound_volume", "inbound_volume", "active_accounts", "distinct_merchants",
             "avg_txn_per_account_ppm", "declined_volume", "p2p_transactions"]


def measure(name: str):
    """F16: metric selector by name: a ``Measure``, or for the measures with a
    grain of their own a function of the star tables (operators/derived.py)."""
    if name in MEASURES:
        return MEASURES[name]
    from .derived import DERIVED
    return DERIVED[name]


def query(df: DataFrame, measures: list[str], by: list[str | Column] = (), where: Column | None = None,
          having: Column | None = None, order: list[Column] | None = None, top: int | None = None,
          totals: str | None = None) -> DataFrame:
    """Evaluate named measures grouped by ``by`` over a (joined) fact frame.

    ``totals='rollup'|'cube'`` adds subtotal rows (A15); every measure is
    recomputed per grouping set from the base aggregates, never summed, and a
    ``grouping_level`` column tells the levels apart."""
    ms = [MEASURES[m] for m in measures]
    needs: list[str] = []
    for m in ms:
        for b in m.needs:
            if b not in needs:
                needs.append(b)
    src = df.where(where) if where is not None else df
    aggs = [BASE[b]().alias(f"__{b}") for b in needs]
    if totals in ("rollup", "cube") and by:
        g = src.rollup(*by) if totals == "rollup" else src.cube(*by)
        grouped = g.agg(*aggs, F.grouping_id().cast("int").alias("grouping_level"))
    elif by:
        grouped = src.groupBy(*by).agg(*aggs)
    else:
        grouped = _total(src, needs) if {"accounts", "merchants"} <= set(needs) else src.agg(*aggs)
    by_names = [b if isinstance(b, str) else None for b in by]
    keep = [F.col(n) for n in by_names if n] if by else []
    if "grouping_level" in grouped.columns:
        keep.append(F.col("grouping_level"))
    if by and None in by_names:
        keep = [F.col(c) for c in grouped.columns if not c.startswith("__")]
    out = grouped.select(*keep, *[m.final().alias(m.name) for m in ms])
    if having is not None:
        out = out.where(having)
    if order:
        out = out.orderBy(*order)
    if top is not None:
        out = out.limit(top)
    return out


def _total(src: DataFrame, needs: list[str]) -> DataFrame:
    """Base aggregates over all rows with both distinct counts: the facts are
    reduced by account once and by merchant once, where one plan with two
    distinct counts would expand every fact row three times."""
    per = src.groupBy("account_key").agg(*[BASE[b]().alias(f"__p_{b}") for b in needs if b not in _DISTINCT_COL])
    total = per.agg(*[_merged(b) for b in needs if b not in _DISTINCT_COL], F.count("account_key").alias("__accounts"))
    merchants = src.select("merchant_key").distinct().agg(F.count("merchant_key").alias("__merchants"))
    return total.crossJoin(merchants)          # one row each


def _merged(base: str) -> Column:
    """A base aggregate from its partial values ``__p_<base>``."""
    merged = F.sum(f"__p_{base}")
    if base in _MONEY_BASES:
        merged = merged.cast(X.MONEY_SUM)
    elif base == "surcharge":
        merged = merged.cast("decimal(38,5)")
    elif base in _COUNT_BASES:
        merged = F.coalesce(merged, F.lit(0))
    return merged.alias(f"__{base}")


# How each base aggregate merges after a pre-aggregation (all are sums of the
# partial values, except distinct counts, which need their column in the key).
_DISTINCT_COL = {"accounts": "account_key", "merchants": "merchant_key"}


def query_eager(fact: DataFrame, dim: DataFrame, fk: str, pk: str, attrs: list[str] | dict[str, str],
                measures: list[str], fact_by: list[str] = (), where: Column | None = None,
                how: str = "inner", blank: str | None = None, dates: DataFrame | None = None,
                date_attrs: list[str] = (), post: list[tuple[DataFrame, str, str, list[str]]] = (),
                having: Column | None = None, order: list[Column] | None = None, top: int | None = None,
                totals: str | None = None) -> DataFrame:
    """Measures grouped by attributes of one (possibly large) dimension, with
    the fact aggregated by the foreign key *before* the join (eager
    aggregation): the join then sees one row per member instead of one per
    fact, so a large dimension no longer forces a shuffle of the whole fact,
    and a member holding a third of all rows is reduced by partial
    aggregation before any exchange.  Results equal ``query(star(...))``.

    Distinct counts of the foreign key itself are counted after the join.
    Distinct counts of other keys, and any distinct count with ``totals``
    ('rollup' or 'cube', as in ``query``), go through bitmaps, which merge: see
    ``_from_bitmaps``.  ``dates``/``date_attrs`` and ``post`` add bounded
    dimensions (calendar, clock, ...): they are joined to the fact first, so
    that it is reduced to their few attributes and not to their raw keys."""
    ms = [MEASURES[m] for m in measures]
    needs: list[str] = []
    for m in ms:
        for b in m.needs:
            if b not in needs:
                needs.append(b)
    distinct = [b for b in needs if b in _DISTINCT_COL]
    merge = bool(totals) or any(_DISTINCT_COL[b] != fk for b in distinct)
    others = [_DISTINCT_COL[b] for b in distinct if _DISTINCT_COL[b] != fk]
    src = fact.where(where) if where is not None else fact
    if date_attrs:
        src = join_dim(src, dates, "date_key", "date_key", list(date_attrs))
    post_attrs = []
    for p_dim, p_fk, p_pk, p_attrs in post:
        src = join_dim(src, p_dim, p_fk, p_pk, list(p_attrs))
        post_attrs += list(p_attrs)
    fact_keys = [*fact_by, *date_attrs, *post_attrs]
    partial = [BASE[b]().alias(f"__p_{b}") for b in needs if b not in _DISTINCT_COL]
    pre_keys = [fk, *fact_keys, *others]
    pre = src.groupBy(*pre_keys).agg(*partial) if partial else src.select(*pre_keys).distinct()
    mapping = {a: a for a in attrs} if isinstance(attrs, list) else dict(attrs)
    joined = join_dim(pre, dim, fk, pk, mapping, how, blank)
    by = [*date_attrs, *mapping.values(), *post_attrs, *fact_by]
    if merge:
        grouped = _from_bitmaps(joined, by, needs, totals)
    else:
        final_aggs = [F.count_distinct(F.col(fk)).alias(f"__{b}") if b in _DISTINCT_COL else _merged(b) for b in needs]
        grouped = joined.groupBy(*by).agg(*final_aggs)
    level = ["grouping_level"] if totals else []
    out = grouped.select(*by, *level, *[m.final().alias(m.name) for m in ms])
    out = out.where(having) if having is not None else out
    out = out.orderBy(*order) if order else out
    return out.limit(top) if top is not None else out


def _grouping_sets(by: list[str], totals: str | None) -> list[list[str]]:
    if totals == "rollup":
        return [by[:n] for n in range(len(by), -1, -1)]
    if totals == "cube":
        return [[c for i, c in enumerate(by) if mask >> i & 1] for mask in range((1 << len(by)) - 1, -1, -1)]
    return [by]


def _from_bitmaps(pre: DataFrame, by: list[str], needs: list[str], totals: str | None) -> DataFrame:
    """Base aggregates per group, and per grouping set of ``totals``, from
    pre-aggregated rows that hold partial sums and the keys to be counted.

    A key becomes a bit of the bitmap of its bucket (32,768 keys, 4 KB).  Bitmaps
    of one bucket are merged by OR where sums are merged by addition, so
    subtotals are made of the groups below them: no row is expanded once per
    distinct count, and grouping sets see groups, not facts."""
    distinct = [b for b in needs if b in _DISTINCT_COL]
    sums = [f"__p_{b}" for b in needs if b not in _DISTINCT_COL]
    if len(distinct) < 2:
        key = F.col(_DISTINCT_COL[distinct[0]]).cast("long") if distinct else F.lit(None).cast("long")
        rows = pre.select(*by, *sums, F.lit(0).alias("__kind"), key.alias("__key"))
    else:       # one row per counted key; the sums go with the first
        types = dict(pre.dtypes)
        entries = [F.struct(F.lit(i).alias("__kind"), F.col(_DISTINCT_COL[b]).cast("long").alias("__key"),
                            *[(F.col(p) if i == 0 else F.lit(None).cast(types[p])).alias(p) for p in sums])
                   for i, b in enumerate(distinct)]
        rows = pre.select(*by, F.inline(F.array(*entries)))
    bucketed = rows.withColumn("__bucket", F.bitmap_bucket_number("__key")).withColumn("__bit", F.bitmap_bit_position("__key"))
    inner = ["__kind", "__bucket"]
    leaf = bucketed.groupBy(*by, *inner).agg(F.bitmap_construct_agg("__bit").alias("__bits"), *[F.sum(p).alias(p) for p in sums])
    merged = [F.bitmap_or_agg("__bits").alias("__bits"), *[F.sum(p).alias(p) for p in sums]]
    if totals:
        # the two inner columns are in every set: the level is what stands left of them
        groups = (leaf.groupingSets([[*s, *inner] for s in _grouping_sets(by, totals)], *by, *inner)
                  .agg(*merged, F.shiftright(F.grouping_id(), len(inner)).cast("int").alias("grouping_level")))
        keys = [*by, "grouping_level"]
    else:
        groups, keys = leaf, by
    counted = [F.coalesce(F.sum(F.when(F.col("__kind") == i, F.bitmap_count("__bits"))), F.lit(0)).cast("long").alias(f"__{b}")
               for i, b in enumerate(distinct)]
    return groups.groupBy(*keys).agg(*[_merged(b) for b in needs if b not in _DISTINCT_COL], *counted)


_COUNT_BASES = {"n", "declined", "fx", "fx_rate_n", "p2p", "daytime"}
_MONEY_BASES = {"gross", "net", "fx_vol", "out_vol", "in_vol", "declined_vol", "weekend_vol", "weekday_vol"}


def selected_value(df: DataFrame, column: str, alternate: str, out: str = "selected") -> DataFrame:
    """the single value of ``column`` in the current context, else ``alternate``."""
    return df.agg(F.when(F.count_distinct(column) == 1, F.max(column)).otherwise(F.lit(alternate)).alias(out))


# Fixed values of the volume band (labels and thresholds in EGP).
VOLUME_BANDS = (("< 100 EGP", 100), ("100–1000 EGP", 1000), ("> 1000 EGP", None))
HIGH_VALUE_THRESHOLD = 100000


def volume_band(avg_ticket: Column, bands=VOLUME_BANDS) -> Column:
    """First band whose upper bound exceeds the average ticket."""
    expr = F.when(avg_ticket.isNull(), F.lit(None).cast("string"))
    for label, bound in bands:
        expr = expr.when(avg_ticket < bound, F.lit(label)) if bound is not None else expr.otherwise(F.lit(label))
    return expr


def high_value_accounts(df: DataFrame, threshold=HIGH_VALUE_THRESHOLD, key: str = "account_key") -> DataFrame:
    """Number of accounts whose gross volume exceeds ``threshold``."""
    per = df.groupBy(key).agg(F.sum("abs_amount_egp").alias("__v"))
    return per.where(F.col("__v") > threshold).agg(F.count(F.lit(1)).alias("high_value_accounts"))


# -- star builder --------------------------------------------------------------
DATE_ATTRS = ["full_date", "day", "month", "quarter", "year", "is_weekend"]
TIME_ATTRS = ["hour_of_day", "time_bucket", "is_daytime", "hour_label"]
ACCOUNT_ATTRS = ["account_id", "age_band", "acquisition_channel", "customer_tier", "account_status",
                 "location_key", "signup_date_key"]
MERCHANT_ATTRS = ["merchant_id", "merchant_name", "merchant_category", "merchant_size", "location_key",
                  "opened_date_key"]


def star(tables: dict[str, DataFrame], roles: list[str], fact: DataFrame | None = None,
         blank: str = BLANK) -> DataFrame:
    """The fact with the attributes of the requested roles.

    Roles: date, time, account, customer_location, peer, type, decline_reason,
    merchant, merchant_location.  Outrigger roles join through their parent."""
    f = tables["fact_transactions"] if fact is None else fact
    if "date" in roles:
        f = join_dim(f, tables["dim_date"], "date_key", "date_key", DATE_ATTRS)
    if "time" in roles:
        f = join_dim(f, tables["dim_time"], "time_key", "time_key", TIME_ATTRS)
    if "account" in roles or "customer_location" in roles:
        acc = tables["dim_account"]
        cols = {a: a for a in ACCOUNT_ATTRS if a != "location_key"}
        cols["location_key"] = "customer_location_key"
        f = join_dim(f, acc, "account_key", "account_key", cols)
        if "customer_location" in roles:
            f = join_dim(f, tables["dim_location"], "customer_location_key", "location_key",
                         {"city": "customer_city", "governorate": "customer_governorate"})
    if "peer" in roles:
        f = join_dim(f, tables["dim_account"], "peer_account_key", "account_key",
                     {"customer_tier": "peer_customer_tier", "account_id": "peer_account_id"}, "left", blank)
    if "type" in roles:
        f = join_dim(f, tables["dim_transaction_type"], "transaction_type_key", "transaction_type_key",
                     ["transaction_type_name", "transaction_group"])
    if "decline_reason" in roles:
        f = join_dim(f, tables["dim_decline_reason"], "decline_reason_key", "decline_reason_key",
                     ["decline_reason_name"], "left", blank)
    if "merchant" in roles or "merchant_location" in roles:
        cols = {a: a for a in MERCHANT_ATTRS if a != "location_key"}
        cols["location_key"] = "merchant_location_key"
        f = join_dim(f, tables["dim_merchant"], "merchant_key", "merchant_key", cols, "left", blank)
        if "merchant_location" in roles:
            f = join_dim(f, tables["dim_location"], "merchant_location_key", "location_key",
                         {"city": "merchant_city", "governorate": "merchant_governorate"}, "left", blank)
    return f
