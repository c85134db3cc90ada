"""Small expression helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or missing."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def dbl(name) -> Column:
    return (F.col(name) if isinstance(name, str) else name).cast("double")


def rounded(value: Column, digits: int = 6) -> Column:
    return F.round(value.cast("double"), digits)


def decimals(value: Column, digits: int) -> Column:
    """F.round of a double, digit for digit, without a decimal number for each value: only what lies next to a tie or is very large is left to F.round."""
    scaled = value * F.lit(10.0**digits)
    plain = (F.abs(scaled) < 1e11) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(plain, F.floor(scaled + 0.5).cast("double") / F.lit(10.0**digits)).otherwise(F.round(value, digits))


def share(part: Column, whole: Column) -> Column:
    """Percentage of whole; missing when whole is zero."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high], keeping a missing value missing (greatest/least alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def key_hash(columns: list[str], modulus: int, multipliers=(7919, 104729, 1709, 31)) -> Column:
    """Integer arithmetic hash of whole-number key columns, the same in any SQL engine."""
    total = None
    for column, factor in zip(columns, multipliers):
        term = F.col(column).cast("bigint") * F.lit(factor)
        total = term if total is None else total + term
    return F.pmod(total, F.lit(modulus)).cast("int")


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns behind a generator, so that later expressions read them and do not repeat them.

    Projections are merged by the optimizer; a costly value used inside an array function would
    otherwise be worked out again for every element.
    """
    return df.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))
