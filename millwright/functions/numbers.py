"""Exact arithmetic on integers and decimals, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwright.schemas import QUANTITY, WHOLE

MICRO_INPUT = T.DecimalType(30, 6)
MILLION = Decimal(1_000_000)


def whole(col: Column) -> Column:
    return col.cast(WHOLE)


def div(n: Column, d: Column) -> Column:
    """Integer division (towards zero), result ``BIGINT``."""
    return F.call_function("div", n, d)


def half_up(n: Column, d: Column) -> Column:
    """``n / d`` for integers, rounded once, halves away from zero; ``d`` must be positive."""
    positive = div(n * 2 + d, d * 2)
    negative = -div(n * -2 + d, d * 2)
    return F.when(n < 0, negative).otherwise(positive)


def micro(col: Column) -> Column:
    """The number of millionths in a decimal of at most six decimals, as an integer."""
    return whole(col.cast(MICRO_INPUT) * F.lit(MILLION).cast(T.DecimalType(7, 0)))


def from_micro(col: Column) -> Column:
    return (col.cast(T.DecimalType(30, 0)) * F.lit(Decimal("0.000001"))).cast(T.DecimalType(30, 6))


def tenth_power(col: Column, decimals: int) -> Column:
    """An integer count of 10^-decimals as a decimal with that scale."""
    scale = F.lit(Decimal(1).scaleb(-decimals)).cast(T.DecimalType(max(decimals, 1), decimals))
    return (col.cast(T.DecimalType(20, 0)) * scale).cast(T.DecimalType(20, decimals))


def per_cent(share: Column, total: Column, decimals: int | None = None) -> Column:
    """``share / total * 100``; null in gives null, a zero total gives 0."""
    ratio = share.cast(T.DecimalType(30, 6)) / total.cast(T.DecimalType(30, 6)) * 100
    result = ratio if decimals is None else F.round(ratio, decimals)
    return F.when(share.isNull() | total.isNull(), F.lit(None)).otherwise(
        F.when(total == 0, F.lit(0).cast("int")).otherwise(result)
    )


def per_cent_exact(share: Column, total: Column, decimals: int) -> Column:
    """As ``per_cent`` for integer inputs, rounded exactly once whatever the sign of the total."""
    sign = F.when(total < 0, -1).otherwise(1)
    n = whole(share * sign) * F.lit(Decimal(100 * 10**decimals))
    count = half_up(whole(n), whole(F.abs(total)))
    return F.when(total == 0, F.when(share.isNotNull(), tenth_power(F.lit(0), decimals))).otherwise(
        tenth_power(count, decimals)
    )


def greatest_or_null(a: Column, b: Column) -> Column:
    """GREATEST that is null when either side is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def breakeven_micro(cost_micro: Column, units: Column, build: Decimal, sales: Decimal) -> Column:
    """Cost x build multiplier x sales multiplier / units, in millionths, rounded once."""
    factor = int(build * 100) * int(sales * 100)
    n = whole(whole(cost_micro) * F.lit(Decimal(factor)))
    return half_up(n, whole(units.cast(T.DecimalType(20, 0)) * F.lit(Decimal(10_000))))


def adjusted_offer_x200(offer: Column, bid: Column, adjust: int) -> Column:
    """200 x (mid + (offer - mid) x adjust / 100) with mid = (offer + bid) / 2: an integer."""
    return (offer + bid) * 100 + (offer - bid) * F.lit(adjust)


def cargo_share(volume: Column, quantity: Column, capacity_m3: int, decimals: int) -> Column:
    """Percent of a cargo hold taken by ``quantity`` units of ``volume`` m3, rounded once."""
    milli = whole(volume.cast(T.DecimalType(13, 3)) * F.lit(Decimal(1000)))
    n = whole(milli.cast(T.DecimalType(13, 0)) * micro(quantity).cast(T.DecimalType(20, 0)))
    n = whole(n * F.lit(Decimal(100 * 10**decimals)).cast(T.DecimalType(8, 0)))
    return tenth_power(half_up(n, F.lit(Decimal(capacity_m3 * 1000 * 1_000_000)).cast(WHOLE)), decimals)


def money(cents: Column) -> Column:
    """Cents shown as a two-decimal amount."""
    return (cents.cast(T.DecimalType(18, 0)) * F.lit(Decimal("0.01"))).cast(T.DecimalType(20, 2))


def to_cents(amount: Column) -> Column:
    """A decimal amount as cents, rounded half up."""
    return F.round(amount.cast(T.DecimalType(17, 2)) * 100, 0).cast("bigint")


def value_micro(price: Column, quantity: Column) -> Column:
    """Price (cents) x quantity in millionths of a cent: 13 + 24 + 1 = 38 digits, exact."""
    return (price.cast(T.DecimalType(13, 0)) * quantity.cast(QUANTITY)).cast(T.DecimalType(38, 6))


def present(df: DataFrame, money_columns: Sequence[str]) -> DataFrame:
    """The rows with the named cent columns shown as two-decimal amounts."""
    return df.withColumns({c: money(F.col(c)) for c in money_columns})
