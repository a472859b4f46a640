"""Time-window aggregates of the four event streams.

The same functions serve batch frames and streams: nothing in them needs more
than one pass, and every aggregate combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bands

# Keys and output names of the four window tables, and the limits of valid events.
FUEL_KEYS = ("window_start", "city", "fuel_type", "price_category")
TRAFFIC_KEYS = ("window_start", "city", "traffic_severity")
CITY_KEYS = ("window_start", "city")


def valid_fuel(events: DataFrame) -> DataFrame:
    return events.where((F.col("price") > 0) & F.col("city").isNotNull())


def valid_traffic(events: DataFrame, congestion: str = "congestion_level") -> DataFrame:
    return events.where(F.col(congestion).between(0, 100) & (F.col("avg_speed") > 0))


def valid_weather(events: DataFrame) -> DataFrame:
    return events.where(F.col("weather_score").between(0, 100))


def valid_transport(events: DataFrame) -> DataFrame:
    return events.where(F.col("ridership") >= 0)


def _windowed(
    events: DataFrame, width: str, keys: Sequence[Column | str], aggregates: Sequence[Column]
) -> DataFrame:
    """Tumbling windows as (window_start, window_end, keys, aggregates).

    A stream groups by the whole window, which carries the watermark that clears
    its state.  A batch groups by the start alone, so the result is already
    partitioned for joins on ``window_start``.
    """
    slot = F.window("event_time", width)
    if events.isStreaming:
        grouped = events.groupBy(slot.alias("w"), *keys).agg(*aggregates)
        start, end = F.col("w.start"), F.col("w.end")
    else:
        grouped = events.groupBy(slot["start"].alias("w"), *keys).agg(*aggregates)
        start, end = F.col("w"), F.col("w") + F.expr(f"INTERVAL {width}")
    names = [c for c in grouped.columns if c != "w"]
    return grouped.select(start.alias("window_start"), end.alias("window_end"), *names)


def fuel_windows(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    weekend = F.dayofweek("event_time").isin(1, 7).cast("int")
    return _windowed(
        valid_fuel(events),
        width,
        ["city", "fuel_type", bands.price_category("price").alias("price_category")],
        [
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.count("*").alias("sample_count"),
            F.avg(weekend).alias("is_weekend"),
        ],
    )


def traffic_windows(
    events: DataFrame, width: str = "5 minutes", congestion: str = "congestion_level",
    extras: bool = False,
) -> DataFrame:
    """``extras`` adds ``road_sketch``, a mergeable sketch of the different roads (see
    :func:`merge_traffic` and :func:`with_estimates`)."""
    more = [F.hll_sketch_agg("road_id").alias("road_sketch")] if extras else []
    return _windowed(
        valid_traffic(events, congestion),
        width,
        ["city", bands.traffic_severity(congestion).alias("traffic_severity")],
        [
            F.avg(congestion).alias("avg_congestion"),
            F.avg("avg_speed").alias("avg_speed"),
            F.avg("mobility_index").alias("avg_mobility_index"),
            F.count("road_id").alias("roads_monitored"),
            *more,
        ],
    )


_WEATHER_MEANS = {
    "avg_weather_score": "weather_score", "avg_temperature": "temperature", "avg_humidity": "humidity",
    "avg_rain_1h": "rain_1h",
}
# Conditions that a stream counts per window; the least frequent of more share the rest.
_CONDITIONS = 64


def weather_windows(
    events: DataFrame, width: str = "5 minutes", extras: bool = False
) -> DataFrame:
    """``dominant_weather`` is the commonest condition, the alphabetically first on a tie.

    ``extras`` adds the earliest condition, at one time the first by name.  A batch counts
    per condition first, so no group holds its conditions in memory.  A stream keeps a
    frequent-items sketch of bounded size, which is exact for up to 48 conditions a window.
    """
    if events.isStreaming:
        return _weather_stream(events, width, extras)
    condition = F.col("weather_main")
    sums = [F.sum(c).alias(f"_sum_{c}") for c in _WEATHER_MEANS.values()]
    counts = [F.count(c).alias(f"_count_{c}") for c in _WEATHER_MEANS.values()]
    slot = F.window("event_time", width)["start"].alias("window_start")
    per_condition = valid_weather(events).groupBy(slot, "city", "weather_main").agg(
        F.count("*").alias("_n"), F.min("event_time").alias("_first_at"), *sums, *counts
    )
    commonest = F.when(condition.isNotNull(), F.struct((-F.col("_n")).alias("n"), "weather_main"))
    more = [F.min_by("weather_main", F.struct("_first_at", "weather_main")).alias("first_weather")]
    merged = per_condition.groupBy("window_start", "city").agg(
        *[
            F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_count_{c}")).alias(name)
            for name, c in _WEATHER_MEANS.items()
        ],
        F.min_by("weather_main", commonest).alias("dominant_weather"),
        F.sum("_n").alias("sample_count"),
        *(more if extras else []),
    )
    rest = [c for c in merged.columns if c != "window_start"]
    end = F.col("window_start") + F.expr(f"INTERVAL {width}")
    return merged.select("window_start", end.alias("window_end"), *rest)


def _weather_stream(events: DataFrame, width: str, extras: bool) -> DataFrame:
    first = F.min_by("weather_main", F.struct("event_time", "weather_main")).alias("first_weather")
    rows = _windowed(
        valid_weather(events),
        width,
        ["city"],
        [
            *[F.avg(c).alias(name) for name, c in _WEATHER_MEANS.items()],
            F.expr(f"approx_top_k(weather_main, {_CONDITIONS // 2}, {_CONDITIONS})").alias("_top"),
            F.count("*").alias("sample_count"),
            *([first] if extras else []),
        ],
    )
    named = F.filter("_top", lambda x: x["item"].isNotNull())
    ranked = F.transform(named, lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("item")))
    rows = rows.withColumn("dominant_weather", F.array_min(ranked)["item"])
    order = [
        "window_start", "window_end", "city", *_WEATHER_MEANS, "dominant_weather", "sample_count",
        *(["first_weather"] if extras else []),
    ]
    return rows.select(*order)


def transport_windows(
    events: DataFrame, width: str = "5 minutes", extras: bool = False
) -> DataFrame:
    """``extras`` adds ``mode_sketch``, a mergeable sketch of the different modes."""
    more = [F.hll_sketch_agg("transport_mode").alias("mode_sketch")] if extras else []
    return _windowed(
        valid_transport(events),
        width,
        ["city"],
        [
            F.sum("ridership").alias("total_ridership"),
            F.avg("load_factor_pct").alias("avg_load_factor"),
            F.count("transport_mode").alias("active_modes"),
            *more,
        ],
    )


_SKETCHES = {"road_sketch": "distinct_roads", "mode_sketch": "distinct_modes"}


def with_estimates(windows: DataFrame) -> DataFrame:
    """The sketches of different values as estimated numbers."""
    present = {s: n for s, n in _SKETCHES.items() if s in windows.columns}
    return windows.withColumns({n: F.hll_sketch_estimate(s) for s, n in present.items()}).drop(*present)


def merge_sketches(windows: DataFrame, *keys: str) -> DataFrame:
    """Windows (or finer groups) to one row per key with their sketches united: a road that
    several of them saw counts once, which numbers of different roads cannot tell."""
    present = [s for s in _SKETCHES if s in windows.columns]
    return windows.groupBy(*keys).agg(*[F.hll_union_agg(s).alias(s) for s in present])


def fuel_means(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Mean price per window, city and fuel, grouped once (see :func:`merge_fuel`)."""
    means = [F.avg("price").alias("avg_price"), F.count("*").alias("sample_count")]
    return _windowed(valid_fuel(events), width, ["city", "fuel_type"], means)


def traffic_means(
    events: DataFrame, width: str = "5 minutes", congestion: str = "congestion_level"
) -> DataFrame:
    """Traffic means per window and city, grouped once (see :func:`merge_traffic`)."""
    means = [
        F.avg(congestion).alias("avg_congestion"),
        F.avg("avg_speed").alias("avg_speed"),
        F.avg("mobility_index").alias("avg_mobility_index"),
        F.count("road_id").alias("roads_monitored"),
    ]
    return _windowed(valid_traffic(events, congestion), width, ["city"], means)


def weighted_merge(
    windows: DataFrame, keys: Sequence[str], means: Sequence[str], weight: str
) -> DataFrame:
    """Merge finer groups into one row per key, means weighted by their row counts."""

    def merged(name: str) -> Column:
        value = F.col(name)
        weights = F.when(value.isNotNull(), F.col(weight))
        return F.try_divide(F.sum(value * weights), F.sum(weights)).alias(name)

    sketches = [F.hll_union_agg(s).alias(s) for s in _SKETCHES if s in windows.columns]
    return windows.groupBy(*keys).agg(
        *[merged(m) for m in means], F.sum(weight).alias(weight), *sketches
    )


def merge_traffic(windows: DataFrame) -> DataFrame:
    """Traffic windows without the severity split; sketches of roads are united."""
    return weighted_merge(
        windows, CITY_KEYS, ["avg_congestion", "avg_speed", "avg_mobility_index"],
        "roads_monitored",
    )


def merge_fuel(windows: DataFrame) -> DataFrame:
    """Fuel windows without the price-band split."""
    return weighted_merge(
        windows, ("window_start", "city", "fuel_type"), ["avg_price"], "sample_count"
    )


def rejected_counts(
    events: DataFrame, stream: str, rules: dict[str, Column]
) -> DataFrame:
    """Rows per rule that break it (a null counts as a break), in one pass."""
    broken = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"r{i}")
        for i, rule in enumerate(rules.values())
    ]
    totals = events.agg(F.count("*").alias("total"), *broken)
    per_rule = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("rejected"))
                for i, name in enumerate(rules)
            ]
        )
    )
    return totals.select(F.lit(stream).alias("stream"), "total", per_rule.alias("x")).select(
        "stream", "x.rule", "x.rejected", "total"
    )


def stream_rules(congestion: str = "congestion_level") -> dict[str, dict[str, Column]]:
    """Validity rules and record contracts of the four streams."""
    col = F.col
    return {
        "fuel": {"price_positive": col("price") > 0, "city_present": col("city").isNotNull()},
        "traffic": {
            "congestion_range": col(congestion).between(0, 100),
            "speed_positive": col("avg_speed") > 0,
            "speed_not_negative": col("avg_speed") >= 0,
            "mobility_range": col("mobility_index").between(0, 100),
        },
        "weather": {"score_range": col("weather_score").between(0, 100)},
        "transport": {"ridership_not_negative": col("ridership") >= 0},
    }
