"""Scalar column expressions shared by the operators.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """num / den, NULL on a zero or NULL denominator (never raises under ANSI)."""
    return F.try_divide(col(num), col(den))


def fixed_point_sum(c, scale: int) -> Column:
    """Order-independent sum of a fixed-point column, as double.

    Doubles summed in different partition orders differ in the last bits; a decimal accumulator does
    not.  Only for columns whose values have at most ``scale`` decimals: a value that does not fit
    fails the query instead of being rounded.
    """
    x = col(c).cast("double")
    exact = x.cast(DecimalType(38 - 8, scale))
    wide = F.abs(exact.cast("double") - x) <= F.greatest(F.abs(x), F.lit(1.0)) * F.lit(1e-9)
    # values of up to 10 digits that lie at a whole number of units are added as such: no decimal is made of each
    scaled = x * F.lit(float(10 ** scale))
    near = F.least(F.greatest(F.abs(x), F.lit(1.0)) * F.lit(1e-9 * 10 ** scale), F.lit(1e-3))
    fits = (F.abs(scaled) < F.lit(1e10)) & (F.abs(F.rint(scaled) - scaled) <= near)
    rest = F.when(x.isNull() | fits, None).when(wide, exact).otherwise(
        F.raise_error(F.concat(F.lit(f"not a number with {scale} decimals: "), x.cast("string"))).cast(DecimalType(30, scale)))
    small = F.sum(F.when(fits, F.rint(scaled).cast("bigint"))).cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))
    large = F.sum(rest)
    return F.coalesce(small + large, small, large).cast("double")


def round_half_up(c, digits: int = 2) -> Column:
    """Round half away from zero with plain IEEE double arithmetic.

    ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``: every engine evaluating the same
    IEEE operations gets the same bits, unlike decimal-string based rounding.  From 2^53 / 10^d on a
    double has no digits left to round and is returned as it is (so are NaN and infinities).
    """
    x = col(c).cast("double")
    scale = float(10 ** digits)
    rounded = F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale) + F.lit(0.0)
    return F.when(F.abs(x) * F.lit(scale) < F.lit(float(1 << 53)), rounded).otherwise(x)


def to_day(c) -> Column:
    """timestamp_ntz / timestamp / date / string -> date (no time of day is ever used)."""
    return col(c).cast("date")


def parse_date(c) -> Column:
    """Per-row date parsing with format fallback: yyyyMMdd, then yyyy-MM-dd; bad -> NULL."""
    s = col(c).cast("string")
    return F.coalesce(F.try_to_date(s, "yyyyMMdd"), F.try_to_date(s, "yyyy-MM-dd"))


def slug_price_name(name: str) -> str:
    """Plan-time slug of a competitor name into a price column name."""
    return name.strip().lower().replace(" ", "_") + "_price"


def iso_year_week(d) -> Column:
    """ISO week id ``YYYY_WW`` (2021-01-03 -> 2020_53)."""
    d = col(d)
    return F.format_string("%d_%02d", F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d))


def week_start(d) -> Column:
    """Monday of the ISO week containing ``d``."""
    return F.date_trunc("week", col(d)).cast("date")


def day_of_week(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(d))


def year_week_key(v) -> Column:
    """Partition key for ``yearweek``: 6 digits -> YYYY_WW, else '-' -> '_'."""
    s = col(v).cast("string")
    return F.when(s.rlike(r"^[0-9]{6}$"), F.concat(F.substring(s, 1, 4), F.lit("_"), F.substring(s, 5, 2))) \
        .otherwise(F.regexp_replace(s, "-", "_"))


def price_ladder(price, min_pct: int = -10, max_pct: int = 10, digits: int = 2) -> Column:
    """Evenly spaced counterfactual prices from p*(1+min%) to p*(1+max%), inclusive.

    ``|min%| + |max%| + 1`` points (21 for +-10 %), each ``lo + i * step`` with the
    last point exactly ``hi`` (the linspace rule), rounded to ``digits``.
    """
    n = abs(int(min_pct)) + abs(int(max_pct)) + 1
    p = col(price)
    lo = p * F.lit(1 + min_pct / 100)
    hi = p * F.lit(1 + max_pct / 100)
    if n == 1:
        return F.array(round_half_up(lo, digits))
    step = (hi - lo) / F.lit(float(n - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: round_half_up(F.when(i == n - 1, hi).otherwise(i * step + lo), digits))


def min_price_level(p80, p_below10) -> Column:
    """Lowest grid level: (round(p80 / p_below10 * 100 - 100) - 10) / 100 when p80 < p_below10,
    else -0.10 (round half to even, as Python's ``round``)."""
    raw = (F.bround(ratio(col(p80), col(p_below10)) * 100 - 100, 0) - 10) / 100
    return F.when(col(p80) < col(p_below10), raw).otherwise(F.lit(-0.10))


def calc_prices(last_price, min_level) -> Column:
    """Price ladder from ``min_level`` up to +10 % in whole 1 % steps applied to ``last_price``, 2 dp."""
    steps = F.sequence(F.round(col(min_level) * 100).cast("int"), F.lit(10))
    return F.transform(steps, lambda s: round_half_up(col(last_price) * (1 + s / 100.0), 2))
