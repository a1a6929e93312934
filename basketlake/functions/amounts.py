"""Exact money arithmetic: decimals until the last step, half-up rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"


def money_sum(c: Column) -> Column:
    return F.sum(c).cast(MONEY)


def sum_if(cond: Column, c: Column) -> Column:
    """SUM(CASE WHEN cond THEN c ELSE 0 END)."""
    return F.sum(F.when(cond, c).otherwise(F.lit(0)))


def ratio(num: Column, den: Column, scale: int, per: int = 1) -> Column:
    """``num / den * per`` half-up to ``scale`` digits; NULL for a zero denominator.

    DECIMAL(22,2)/DECIMAL(15,0) keeps 18 fractional digits, so the one rounding
    that counts is the final cast.
    """
    n = (num.cast("decimal(20,2)") * F.lit(per)).cast("decimal(22,2)")
    d = F.nullif(den.cast("decimal(15,0)"), F.lit(0).cast("decimal(15,0)"))
    return (n / d).cast(f"decimal(20,{scale})")


def share(num: Column, den: Column, scale: int = 2, per: int = 100) -> Column:
    """``num / den * per`` where the denominator is money too."""
    n = (num.cast("decimal(20,2)") * F.lit(per)).cast("decimal(23,2)")
    d = F.nullif(den.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    return (n / d).cast(f"decimal(20,{scale})")


def change_pct(cur: Column, prev: Column, scale: int = 2) -> Column:
    """Growth in percent with fractional division; NULL when there is no base."""
    return share(cur.cast("decimal(20,2)") - prev.cast("decimal(20,2)"), prev, scale)


def avg_exact(c: Column, scale: int = 2) -> Column:
    """AVG of a money column rounded once (AVG itself rounds at four extra digits)."""
    return ratio(F.sum(c), F.count(c), scale)
