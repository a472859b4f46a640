"""Settings, thresholds and the fixed vocabulary of the results."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Congestion level names, by level 0..3.
LEVEL_EDGES = (20, 40, 60)
LEVEL_LABELS = ("Lancar", "Ramai Lancar", "Padat", "Macet")

# Impact zone names, from the smallest to the largest change.
ZONE_LABELS = ("Dampak Rendah", "Dampak Sedang", "Dampak Tinggi")
IMPACT_CODES = ("low_impact", "moderate_impact", "high_impact")

# Zone bands in percentage points of added congestion.
ZONE_BAND_HIGH = 15
ZONE_BAND_MODERATE = 5

# Fuel price bands (currency units per litre).
PRICE_EDGES = (10_000, 14_000, 16_000)
PRICE_LABELS = ("subsidi", "ron90", "ron95", "premium")

# Traffic severity, highest first, by "greater than".
SEVERITY_EDGES = (80, 60, 40)
SEVERITY_LABELS = ("critical", "heavy", "moderate", "light")

# Base weather score by condition; anything else gets the default.
WEATHER_BASE = {
    "Clear": 100,
    "Clouds": 80,
    "Drizzle": 60,
    "Rain": 40,
    "Thunderstorm": 10,
    "Fog": 50,
}
WEATHER_BASE_DEFAULT = 70

# Display status bands.
MOBILITY_STATUS_EDGES = (0.6, 0.4)
MOBILITY_STATUS_LABELS = ("Stabil", "Menurun", "Kritis")
CONGESTION_STATUS_EDGES = (40, 65)
CONGESTION_STATUS_LABELS = ("Lancar", "Sedang", "Padat")
LOAD_STATUS_EDGES = (70, 50)
LOAD_STATUS_LABELS = ("red", "yellow", "blue")

# Correlation strength by absolute r.
STRENGTH_EDGES = (0.7, 0.4, 0.2)
STRENGTH_LABELS = ("strong", "moderate", "weak", "negligible")

# The correlated pairs (x, y, name).
CORRELATION_PAIRS = (
    ("fuel_price_delta", "mobility_composite", "BBM ↔ Mobilitas"),
    ("fuel_price_delta", "avg_congestion", "BBM ↔ Kemacetan"),
    ("fuel_price_delta", "transport_usage_norm", "BBM ↔ Transportasi Umum"),
)

# National holidays of 2026.
HOLIDAYS = (
    date(2026, 1, 1),
    date(2026, 3, 22),
    date(2026, 3, 29),
    date(2026, 3, 31),
    date(2026, 4, 1),
    date(2026, 5, 1),
    date(2026, 5, 14),
    date(2026, 5, 24),
    date(2026, 6, 1),
    date(2026, 8, 17),
    date(2026, 12, 25),
)

# How long a latest value stays fresh, in seconds, by kind.
FRESH_SECONDS = {
    "fuel": 30,
    "traffic": 30,
    "mobility": 60,
    "prediction": 1_800,
    "alert": 300,
    "correlation": 3_600,
    "cluster": 86_400,
    "snapshot": 120,
    "timeseries": 86_400,
}

# Inputs of the two models and of the sequence forecast.
CLASSIFIER_FEATURES = ("hour", "day_of_week", "is_weekend", "current_speed", "free_flow_speed")
CITY_CLUSTER_FEATURES = (
    "avg_fuel_price_delta",
    "avg_mobility_drop",
    "alt_transport_ratio",
    "avg_congestion_change",
    "city_income_proxy",
)
SEQUENCE_FEATURES = (
    "fuel_price_delta",
    "traffic_index",
    "weather_score_norm",
    "transport_usage_norm",
    "time_of_day_norm",
    "day_of_week_norm",
    "holiday_flag",
)
SEQUENCE_TARGET = "mobility_composite"


# The assumptions, weights and run settings below.
@dataclass(frozen=True)
class Economics:
    """Assumptions behind the daily cost and travel-time estimates."""

    price_per_litre: float = 16_250.0
    daily_km: float = 30.0
    km_per_litre: float = 12.0
    congestion_penalty: float = 0.5


@dataclass(frozen=True)
class CompositeWeights:
    """Weights of the composite mobility index."""

    traffic: float = 0.4
    weather: float = 0.3
    transit: float = 0.2
    price: float = 0.1


@dataclass(frozen=True)
class ImpactSettings:
    """Everything a run needs to know that is not data."""

    event_date: str = "2026-06-10"
    trailing_days: int = 60
    benchmark_fuel: str = "Pertamax"
    ridership_ceiling: float = 50_000.0
    zscore_limit: float = 2.0
    top_anomalies: int = 200
    window: str = "5 minutes"
    watermark: str = "2 minutes"
    trigger: str = "30 seconds"
    min_classifier_rows: int = 50
    seed: int = 42
    trees: int = 100
    economics: Economics = field(default_factory=Economics)
    weights: CompositeWeights = field(default_factory=CompositeWeights)
