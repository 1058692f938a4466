"""Column expressions for service level, waste, weather and prices."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from slotcast.constants import (
    COLD_BELOW_F,
    HOT_ABOVE_F,
    PRECIP_FACTOR,
    TEMPERATURE_FACTORS,
)
from slotcast.functions.slots import col


def percent_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole * 100).otherwise(F.lit(0.0))


def service_level(sold: str | Column, stockouts: str | Column) -> Column:
    """Percent of requested units that were sold; 0 without any request."""
    return percent_or_zero(col(sold), col(sold) + col(stockouts))


def waste_pct(cost: str | Column, revenue: str | Column) -> Column:
    """Waste cost in percent of revenue; 0 without revenue."""
    return percent_or_zero(col(cost), col(revenue))


def classify_weather(temp_f: str | Column, precip: str | Column) -> Column:
    """One bucket per day: precipitation first, then heat, then cold, else neutral."""
    return (
        F.when(col(precip).cast("boolean"), "precip")
        .when(col(temp_f) > HOT_ABOVE_F, "extreme_heat")
        .when(col(temp_f) < COLD_BELOW_F, "extreme_cold")
        .otherwise("neutral")
    )


def weather_multiplier(
    temp_f: str | Column, precip: str | Column, category: str | Column | None = None
) -> Column:
    """Demand factor of the weather; without a category only precipitation counts."""
    wet = F.when(col(precip).cast("boolean"), F.lit(PRECIP_FACTOR)).otherwise(F.lit(1.0))
    if category is None:
        return wet

    def factor(which: int) -> Column:
        pairs = ((F.lit(c), F.lit(f[which])) for c, f in TEMPERATURE_FACTORS.items())
        by_category = F.create_map(*chain.from_iterable(pairs))
        return F.coalesce(F.try_element_at(by_category, col(category)), F.lit(1.0))

    hot, cold = factor(0), factor(1)
    return wet * (
        F.when(col(temp_f) > HOT_ABOVE_F, hot).when(col(temp_f) < COLD_BELOW_F, cold).otherwise(1.0)
    )


def effective_price(price: str | Column, sale_price: str | Column, sale_days: str | Column,
                    day_of_week: str | Column) -> Column:
    """The sale price on the item's sale days if it has one, else the regular price."""
    on_sale = F.array_contains(col(sale_days), col(day_of_week)) & col(sale_price).isNotNull()
    return F.when(on_sale, col(sale_price)).otherwise(col(price))


def stable_seed(text: str | Column) -> Column:
    """SHA-256 of a text modulo 2^32: the same seed in every process."""
    last_32_bits = F.substring(F.sha2(col(text), 256), 57, 8)
    return F.conv(last_32_bits, 16, 10).cast("bigint")
