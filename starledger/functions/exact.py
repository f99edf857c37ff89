"""Exact arithmetic helpers for money, ratios and averages.

Money stays ``decimal(18,2)``; aggregated sums widen to ``decimal(38,2)``.
Ratios and averages are computed in integers with half-up rounding, so the
result never depends on floating-point summation order or on how an engine
rounds a double (F10-F12, F25, A3, A12).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"
PPM = 1_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _c(c).cast(MONEY)


def to_minor(c) -> Column:
    """money -> integer minor units (x100); exact on decimals."""
    return (_c(c).cast(MONEY_SUM) * 100).cast("decimal(38,0)")


def from_minor(c) -> Column:
    """Integer minor units -> money, exact (multiplication, no division)."""
    return (_c(c).cast("decimal(38,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY_SUM)


def half_up_div(num, den) -> Column:
    """round_half_up(num / den) for integers; sign-safe; NULL when den is 0 or
    NULL.  Uses Spark's integral ``div`` (exact, bigint result), so no decimal
    quotient is ever rounded and the expression stays small for codegen."""
    n, d = _c(num).cast("decimal(38,0)"), _c(den).cast("decimal(38,0)")
    mag = F.call_function("div", F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    # ``div`` wraps silently past the bigint range: fail loudly instead
    fits = (F.abs(n).cast("double") / F.abs(d).cast("double")) < F.lit(9.0e18)
    return F.when(d != 0, F.when(fits, mag * sign).otherwise(
        F.raise_error(F.lit("half_up_div: quotient exceeds the bigint range"))))


def ratio_ppm(num, den) -> Column:
    """Safe ratio in parts per million, half-up, NULL on zero denominator."""
    return half_up_div(_c(num).cast("decimal(38,0)") * PPM, den).cast("bigint")


def money_ratio_ppm(num_money, den_money) -> Column:
    """Ratio of two money amounts in ppm (both scaled to minor units first)."""
    return ratio_ppm(to_minor(num_money), to_minor(den_money))


def avg_money(sum_money, n) -> Column:
    """Average of money as decimal(18,2), half-up on minor units."""
    return from_minor(half_up_div(to_minor(sum_money), n)).cast(MONEY)


def signed_amount(abs_amount, is_outbound) -> Column:
    """negative when outbound."""
    a = _c(abs_amount)
    return F.when(_c(is_outbound) == 1, -a).otherwise(a).cast(MONEY)


def fx_minor(abs_minor, rate_e6) -> Column:
    """foreign minor amount = abs_minor / (rate_e6 / 1e6), half-up, integer."""
    return half_up_div(_c(abs_minor).cast("decimal(38,0)") * PPM, rate_e6).cast("bigint")


def scale_rate(rate_e6) -> Column:
    """exchange rate x1e6 -> decimal rate."""
    return (_c(rate_e6).cast("decimal(38,0)") * F.lit(0.000001).cast("decimal(7,6)")).cast("decimal(24,6)")
