"""Indices, scores and estimates as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config
from tidemark.config import CompositeWeights, Economics
from tidemark.functions.bands import lookup


def half_up(value: Column, digits: int) -> Column:
    """Round half up, ignoring binary noise past the tenth decimal.

    Sums that were added up in another order therefore round to the same number.
    From 2^52 units on a double has no such decimals, and the value itself comes
    back; NaN gives null.
    """
    unit = float(10**digits)
    units = F.abs(value) * unit
    nearest = F.floor(units + (0.5 + 0.5e-10 * unit)).cast("double") / unit
    signed = F.when((value < 0) & (nearest > 0), -nearest).otherwise(nearest)
    return F.when(units < float(1 << 52), signed).when(~F.isnan(value), value)


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; a null becomes ``high`` because least/greatest skip nulls."""
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))


def minmax(value: Column, low: float, high: float, null_policy: str = "observed") -> Column:
    """Scale [low, high] to [0, 1].  ``observed`` maps null to 1.0, ``propagate`` keeps it."""
    scaled = clamp((value - F.lit(float(low))) / F.lit(float(high - low)), 0, 1)
    if null_policy == "propagate":
        return F.when(value.isNotNull(), scaled)
    return scaled


def congestion_from_speeds(current: Column, free_flow: Column, floor: float = 5.0) -> Column:
    """Lost speed as a percentage, at least ``floor``; null when free flow is zero."""
    lost = F.try_divide(free_flow - current, free_flow) * 100
    return F.when(lost.isNotNull(), half_up(F.greatest(F.lit(floor), lost), 2))


def congestion_unclamped(current: Column, free_flow: Column) -> Column:
    """Lost speed as a percentage against a free flow of at least one; may be negative."""
    return half_up((1 - current / F.greatest(free_flow, F.lit(1.0))) * 100, 2)


def mobility_index(congestion: Column) -> Column:
    return 100 - congestion


def mobility_score(congestion: Column) -> Column:
    """1 for an empty road, 0 for a full one; null stays null."""
    return F.when(congestion.isNotNull(), half_up(clamp(1 - congestion / 100, 0, 1), 4))


def level_score(level: Column) -> Column:
    """Mobility score of a 0-3 congestion level."""
    return half_up(1 - level / 3, 4)


def weather_score(condition: Column, rain_1h: Column) -> Column:
    """Base score of the condition less up to 30 points for rain, never negative."""
    base = lookup(condition, config.WEATHER_BASE, config.WEATHER_BASE_DEFAULT)
    return F.greatest(F.lit(0.0), half_up(base - F.least(rain_1h * 5, F.lit(30.0)), 1))


def load_factor(ridership: Column, capacity: Column) -> Column:
    return half_up(F.try_divide(ridership.cast("double"), capacity.cast("double")) * 100, 2)


def percent_change(old: Column, new: Column) -> Column:
    return F.try_divide(new - old, old) * 100


def composite_mobility(
    traffic: Column, weather: Column, transit: Column, price_delta: Column,
    weights: CompositeWeights = CompositeWeights(),
) -> Column:
    """Weighted mobility index; a falling price can lift it above one."""
    price_part = F.greatest(F.lit(0.0), 1 - price_delta / 100)
    total = (
        (1 - traffic) * weights.traffic
        + weather * weights.weather
        + transit * weights.transit
        + price_part * weights.price
    )
    return half_up(total, 4)


def extra_fuel_cost(congestion: Column, economics: Economics = Economics()) -> Column:
    """Daily fuel cost on top of free flow: consumption grows with congestion."""
    base_litres = economics.daily_km / economics.km_per_litre
    litres = (
        economics.daily_km * (1 + congestion / 100 * economics.congestion_penalty)
        / economics.km_per_litre
    )
    extra = F.greatest(F.lit(0.0), litres - base_litres)
    return half_up(extra * economics.price_per_litre, 2)


def extra_travel_minutes(
    speed: Column, free_flow: Column, economics: Economics = Economics()
) -> Column:
    """Daily travel time on top of free flow; a zero speed contributes nothing."""

    def minutes(pace: Column) -> Column:
        return F.when(pace > 0, economics.daily_km / pace * 60).otherwise(0.0)

    # A missing or zero free-flow average stands for "as fast as observed".
    reference = F.coalesce(F.nullif(free_flow, F.lit(0.0)), speed)
    return half_up(F.greatest(F.lit(0.0), minutes(speed) - minutes(reference)), 2)
