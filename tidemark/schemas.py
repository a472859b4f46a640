"""Explicit schemas of the inputs; every field may be null.

Field names, order and precision are fixed formats shared with the producers and
the readers of the tables.
"""

FUEL_EVENT = (
    "timestamp STRING, city STRING, fuel_type STRING, price DOUBLE, station STRING, "
    "source STRING, surge_event BOOLEAN"
)

TRAFFIC_EVENT = (
    "timestamp STRING, city STRING, road_id STRING, road_name STRING, congestion_level DOUBLE, "
    "avg_speed DOUBLE, free_flow_speed DOUBLE, mobility_index DOUBLE, source STRING"
)

WEATHER_EVENT = (
    "timestamp STRING, city STRING, temperature DOUBLE, humidity DOUBLE, weather_main STRING, "
    "rain_1h DOUBLE, weather_score DOUBLE, source STRING"
)

TRANSPORT_EVENT = (
    "timestamp STRING, city STRING, transport_mode STRING, transport_code STRING, ridership INT, "
    "capacity INT, load_factor_pct DOUBLE, source STRING"
)

ROAD_READING = (
    "city STRING, road_name STRING, lat DOUBLE, lon DOUBLE, current_speed DOUBLE, "
    "free_flow_speed DOUBLE, congestion_index DOUBLE, period STRING, source STRING, "
    "ingested_via STRING, recorded_at STRING"
)

WEATHER_READING = (
    "city STRING, temp DOUBLE, humidity INT, weather_desc STRING, rain_1h DOUBLE, source STRING, "
    "ingested_via STRING, recorded_at STRING"
)

# Decimal precision of the published columns.
PUBLISHED_PRECISION = {
    "lat": "decimal(9,6)",
    "lon": "decimal(9,6)",
    "avg_congestion": "decimal(6,2)",
    "avg_speed": "decimal(6,2)",
    "avg_congestion_index": "decimal(6,2)",
    "est_extra_fuel_cost_idr": "decimal(12,2)",
    "est_extra_travel_min": "decimal(6,2)",
    "ci_before": "decimal(6,2)",
    "ci_after": "decimal(6,2)",
    "delta_congestion": "decimal(6,2)",
    "baseline_mean": "decimal(6,2)",
    "baseline_stddev": "decimal(6,2)",
    "zscore": "decimal(18,3)",
    "anomaly_rate_pct": "decimal(6,2)",
    "metric_value": "decimal(6,4)",
    "current_congestion": "decimal(6,2)",
    "change_pct": "decimal(6,2)",
}

# Stored gold tables and the tables of a cycle, unrounded.
GOLD = {
    "silver_traffic": (
        "city string, road_name string, lat double, lon double, current_speed double, free_flow_speed double, "
        "congestion_index double, period string, recorded_at timestamp, ingest_seq bigint, hour int, "
        "day_of_week int, is_weekend int, congestion_level int, date date"
    ),
    "silver_cells": (
        "city string, period string, date date, hour int, readings bigint, sum_ci double, spread_ci double, "
        "min_ci double, max_ci double, sum_speed double, sum_free_flow double, free_flow_readings bigint"
    ),
    "silver_baseline": "city string, hour int, mu double, sigma double",
    "gold_city_comparison": (
        "city string, period string, avg_congestion double, avg_speed double, record_count bigint, "
        "computed_at timestamp"
    ),
    "gold_hourly_pattern": (
        "city string, period string, hour int, avg_congestion double, avg_speed double, computed_at timestamp"
    ),
    "gold_daily_summary": (
        "summary_date date, city string, avg_congestion_index double, avg_speed double, "
        "est_extra_fuel_cost_idr double, est_extra_travel_min double, computed_at timestamp"
    ),
    "gold_anomalies": (
        "city string, road_name string, recorded_at timestamp, congestion_index double, baseline_mean double, "
        "baseline_stddev double, zscore double"
    ),
    "gold_anomaly_rate": (
        "period string, total_records bigint, anomaly_count bigint, anomaly_rate_pct double, computed_at timestamp"
    ),
    "gold_road_impact": (
        "city string, road_name string, ci_before double, ci_after double, lat double, lon double, "
        "delta_congestion double, zone_band string"
    ),
    "gold_road_clusters": (
        "city string, road_name string, ci_before double, ci_after double, lat double, lon double, "
        "delta_congestion double, zone_band string, zone_cluster int, zone_label string, computed_at timestamp"
    ),
    "gold_model_metrics": (
        "model_name string, metric_name string, metric_value double, train_rows bigint, test_rows bigint, "
        "dropped_rows bigint, computed_at timestamp, run_id string"
    ),
    "gold_predictions": (
        "city string, horizon_minutes int, predicted_level int, predicted_label string, current_avg_speed double, "
        "predicted_at timestamp, current_congestion double, change_pct double, computed_at timestamp, run_id string"
    ),
    "latest_roads": (
        "city string, road_name string, lat double, lon double, current_speed double, free_flow_speed double, "
        "congestion_index double, period string, recorded_at timestamp, ingest_seq bigint"
    ),
    "serving_documents": "key string, document string",
    "cycle_state": "task string, last_batch bigint, as_of string",
}
