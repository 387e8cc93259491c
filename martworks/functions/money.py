"""Business rules on amounts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper bound of the average rate, share of the order total, minimum pay.
COURIER_TIERS = [("4.0", "0.05", 100), ("4.5", "0.07", 150), ("4.9", "0.08", 175), (None, "0.10", 200)]


def money(c: Column) -> Column:
    return c.cast("decimal(14,2)")


def signed_amount(amount: Column, status: Column) -> Column:
    """Refunds count as negative."""
    return F.when(status == "refunded", -amount).otherwise(amount)


def flag(condition: Column) -> Column:
    return condition.cast("int")


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def safe_ratio(a: Column, b: Column, cast: str = "decimal(38,10)") -> Column:
    """a / b as a decimal; null for a zero divisor."""
    return a.cast(cast) / F.nullif(b.cast(cast), F.lit(0).cast(cast))


def to_base_currency(amount: Column, div: Column) -> Column:
    """Whole minor units after conversion (half up), then divided by 100."""
    return (F.round(amount.cast("decimal(20,2)") * div, 0) / F.lit(100).cast("decimal(3,0)")).cast("decimal(20,2)")


def courier_pay(rate_avg: Column, total: Column) -> Column:
    """Share of the total by average rate, never below the tier's floor."""
    pay = None
    for bound, share, floor in COURIER_TIERS:
        tier = F.greatest(F.lit(share).cast("decimal(4,2)") * total, F.lit(floor).cast("decimal(14,2)"))
        if bound is None:
            return pay.when(rate_avg >= F.lit(COURIER_TIERS[-2][0]).cast("decimal(3,1)"), tier)
        below = rate_avg < F.lit(bound).cast("decimal(3,1)")
        pay = F.when(below, tier) if pay is None else pay.when(below, tier)
