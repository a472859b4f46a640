"""Price and anomaly alerts, and the household budget projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scores


def price_policy(prices: DataFrame) -> DataFrame:
    """The price table, newest effective date first."""
    return prices.orderBy(F.col("effective_date").desc(), "fuel_type")


# Scope and subject names and the severity limits of the alerts below.
def price_alerts(prices: DataFrame, scope: str = "Nasional") -> DataFrame:
    """One alert per fuel whose price went up: high above 10 percent, else medium."""
    old, new = F.col("price_before"), F.col("price_after")
    return (
        prices.where(new > old)
        .withColumn("pct_change", scores.half_up(scores.percent_change(old, new), 2))
        .select(
            F.lit(scope).alias("city"),
            "fuel_type",
            old.alias("old_price"),
            new.alias("new_price"),
            "pct_change",
            F.when(F.col("pct_change") > 10, "high").otherwise("medium").alias("severity"),
        )
    )


def anomaly_alert(
    rates: DataFrame, points: float = 5.0, scope: str = "Multi-kota", subject: str = "Mobilitas"
) -> DataFrame:
    """One alert when the anomaly rate rose by more than ``points``."""

    def rate(period: str):
        return F.coalesce(
            F.max(F.when(F.col("period") == period, F.col("anomaly_rate_pct"))), F.lit(0.0)
        )

    sides = rates.agg(rate("before").alias("old_price"), rate("after").alias("new_price"))
    return sides.where(F.col("new_price") > F.col("old_price") + points).select(
        F.lit(scope).alias("city"),
        F.lit(subject).alias("fuel_type"),
        "old_price",
        "new_price",
        scores.half_up(F.col("new_price") - F.col("old_price"), 2).alias("pct_change"),
        F.lit("high").alias("severity"),
    )


def active_alerts(prices: DataFrame, rates: DataFrame, points: float = 5.0) -> DataFrame:
    return price_alerts(prices).unionByName(anomaly_alert(rates, points))


def budget_projection(consumption: DataFrame, prices: DataFrame) -> DataFrame:
    """Extra spending per day, 30 days and 365 days for each consumer's fuel use.

    ``consumption`` has (consumer, fuel_type, litres_per_day).
    """
    litres = F.col("litres_per_day")
    before, after = F.col("price_before") * litres, F.col("price_after") * litres
    extra = (F.col("price_after") - F.col("price_before")) * litres
    return consumption.join(
        prices.select("fuel_type", "price_before", "price_after"), "fuel_type"
    ).select(
        "consumer",
        "fuel_type",
        "litres_per_day",
        before.alias("daily_before"),
        after.alias("daily_after"),
        extra.alias("extra_daily"),
        (extra * 30).alias("extra_monthly"),
        (extra * 365).alias("extra_yearly"),
    )
