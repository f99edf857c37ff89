"""Filter contexts as values.

A context holds one predicate per dimension.  A measure can be asked in the
whole context, or with the filter of some dimensions removed (a share of "all
categories" under the same date slicer).  Filters that no measure removes go to
the scan.  The others become boolean tags of the rows; the facts are reduced
once per (group, tags), and each variant of a measure adds up the partial rows
whose remaining tags hold.  So any number of variants costs one fact scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import measures as M


@dataclass(frozen=True)
class Filter:
    """A dimension's predicate, and the attributes by which the dimension may
    group (removing the dimension's filter also leaves these groups)."""
    predicate: Column | None = None
    attributes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Variant:
    """A measure with the filters of some dimensions removed."""
    measure: str
    removed: tuple[str, ...] = field(default=())


def in_context(df: DataFrame, context: dict[str, Filter], variants: dict[str, Variant], by: list[str] = ()) -> DataFrame:
    """One row per visible group of ``by``: a column per variant.

    ``df`` has the joined columns that predicates and groups need.  Sums merge
    exactly; a distinct count does not, so such measures are refused here (use
    ``measures.query`` per variant, or ``query_eager`` with totals)."""
    by = list(by)
    unknown = {r for v in variants.values() for r in v.removed} - set(context)
    if unknown:
        raise KeyError(f"no filter of {sorted(unknown)} in this context")
    needs = list(dict.fromkeys(b for v in variants.values() for b in M.MEASURES[v.measure].needs))
    if counted := [b for b in needs if b in M._DISTINCT_COL]:
        raise ValueError(f"distinct counts are not additive over tags: {counted}")
    removed = {r for v in variants.values() for r in v.removed}
    tags = {}
    for name, f in context.items():
        if f.predicate is None:
            continue
        holds = F.coalesce(f.predicate, F.lit(False))
        if name in removed:
            tags[name] = f"__tag_{name}"
            df = df.withColumn(tags[name], holds)
        else:
            df = df.where(f.predicate)
    if tags:        # a row that no variant can see
        masks = {tuple(t for n, t in tags.items() if n not in v.removed) for v in variants.values()}
        if () not in masks:
            df = df.where(_any([_all(m) for m in masks]))
    parts = df.groupBy(*by, *tags.values()).agg(*[M.BASE[b]().alias(f"__p_{b}") for b in needs])
    out, shown = parts, _all(tuple(tags.values()))
    for name, v in variants.items():
        left = [c for c in by if all(c not in context[r].attributes for r in v.removed)]
        seen = _all(tuple(t for n, t in tags.items() if n not in v.removed))
        # partial rows: at most one per visible member and combination of tags
        group = Window.partitionBy(*left)
        values = {b: _total(b, F.when(seen, F.col(f"__p_{b}")), group) for b in M.MEASURES[v.measure].needs}
        out = out.withColumns({f"__{name}__{b}": c for b, c in values.items()})
    out = out.where(shown)
    for name, v in variants.items():
        ms = M.MEASURES[v.measure]
        out = out.withColumns({f"__{b}": F.col(f"__{name}__{b}") for b in ms.needs}).withColumn(name, ms.final())
    return out.select(*by, *variants)


def _all(tags: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for t in tags:
        out = out & F.col(t)
    return out


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _total(base: str, value: Column, group) -> Column:
    total = F.sum(value).over(group)
    if base in M._MONEY_BASES:
        return total.cast(M.X.MONEY_SUM)
    if base == "surcharge":
        return total.cast("decimal(38,5)")
    return F.coalesce(total, F.lit(0)) if base in M._COUNT_BASES else total
