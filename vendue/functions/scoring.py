"""Score arithmetic: log scale, min-max scale, weighted sums, rank scores, decay."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log10_or_zero(col: Column) -> Column:
    """log10; missing values and values of 0 or less give 0."""
    return F.coalesce(F.when(col > 0, F.log10(col)), F.lit(0.0))


def log_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_log") -> DataFrame:
    """Add ``<col><suffix>`` for each column."""
    return df.withColumns({f"{c}{suffix}": log10_or_zero(F.col(c)) for c in cols})


def feature_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value of each column, in one pass.

    One row comes back; partial aggregation leaves one row per task before it.
    """
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in cols],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in cols],
    ).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def min_max_scale(
    df: DataFrame,
    cols: Sequence[str],
    bounds: Mapping[str, tuple[float, float]] | None = None,
    invert: Sequence[str] = (),
    suffix: str = "_norm",
) -> DataFrame:
    """Add ``<col><suffix>`` = 100 (x - min) / (max - min); inverted ones are 100 minus that.

    A column whose bounds are equal gives null.
    """
    bounds = bounds or feature_bounds(df, cols)

    def scaled(name: str) -> Column:
        low, high = bounds[name]
        if low is None or high is None or high == low:
            return F.lit(None).cast("double")
        value = F.lit(100.0) * ((F.col(name) - F.lit(low)) / F.lit(high - low))
        return F.lit(100.0) - value if name in invert else value

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in cols})


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Sum of column times weight, in the order given."""
    return reduce(add, [F.col(name) * F.lit(float(w)) for name, w in weights.items()])


def reciprocal_rank_score(weights: Mapping[str, float], scale: float = 1_000_000.0) -> Column:
    """Sum of weight times scale / rank."""
    return reduce(add, [(F.lit(scale) / F.col(name)) * F.lit(float(w)) for name, w in weights.items()])


def rank_score(rank: Column, scale: float = 10_000.0, digits: int = 4) -> Column:
    """scale / rank, rounded."""
    return F.round(F.lit(scale) / rank, digits)


def freshness(age: Column, floor_weeks: int = 12) -> Column:
    """1/n for the n-th week on display; 1/12 from week 12 on and for future dates."""
    week = F.greatest(F.ceil(age / F.lit(7)), F.lit(1))
    within = age.between(0, 7 * (floor_weeks - 1))
    return F.when(within, F.lit(1.0) / week).otherwise(F.lit(1.0 / floor_weeks))


def open_weight(age: Column) -> Column:
    """1/age to 4 decimals; missing for age 0."""
    return F.round(F.try_divide(F.lit(1.0), age), 4)


def floor_weight(weight: Column, days: int = 7) -> Column:
    """Missing weights and weights below 1/days become 1/days to 4 decimals."""
    low = 1.0 / days
    return F.when(weight.isNull() | (weight < F.lit(low)), F.lit(round(low, 4))).otherwise(weight)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double, missing where the divisor is 0."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def repair_count(clicks: Column, purchases: Column) -> Column:
    """Clicks, or clicks plus purchases where there are fewer clicks than purchases."""
    return F.when(clicks < purchases, clicks + purchases).otherwise(clicks)


def growth(now: Column, then: Column, total_now: float, total_then: float, scale: float, days: int = 7) -> Column:
    """(share now - share then) / days, times scale; missing counts are 0."""

    def share(count: Column, total: float) -> Column:
        return ratio(F.coalesce(count, F.lit(0)), F.lit(total))

    return ((share(now, total_now) - share(then, total_then)) / F.lit(float(days))) * F.lit(scale)
