"""Reference SQL (DuckDB) for the registered queries."""

from __future__ import annotations


def r(expr: str, digits: int = 6) -> str:
    """Half-up rounding on the decimal value, as in ``scores.half_up``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def i(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


def level(col: str) -> str:
    return f"CASE WHEN {col} < 20 THEN 0 WHEN {col} < 40 THEN 1 WHEN {col} < 60 THEN 2 ELSE 3 END"


def label(col: str) -> str:
    return (
        f"CASE {col} WHEN 0 THEN 'Lancar' WHEN 1 THEN 'Ramai Lancar' "
        f"WHEN 2 THEN 'Padat' WHEN 3 THEN 'Macet' END"
    )


def impact_code(col: str) -> str:
    return (
        f"CASE {col} WHEN 'Dampak Tinggi' THEN 'high_impact' "
        f"WHEN 'Dampak Rendah' THEN 'low_impact' ELSE 'moderate_impact' END"
    )


BRONZE = """
bronze AS (
  SELECT concat('city_', user_id % 3) AS city, concat('road_', user_id) AS road_name,
         CAST(-6 AS DOUBLE) - CAST(user_id % 15 AS DOUBLE) * CAST(0.05 AS DOUBLE) AS lat,
         CAST(106 AS DOUBLE) + CAST(user_id % 15 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS lon,
         CASE WHEN event_id % 50 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(50 + user_id % 21 AS DOUBLE) * (1 - least(value, 100) / 200) END
           AS current_speed,
         CAST(50 + user_id % 21 AS DOUBLE) AS free_flow_speed, value AS congestion_index,
         CASE WHEN date_trunc('hour', ts) >= TIMESTAMP '2024-01-21' THEN 'after' ELSE 'before' END
           AS period,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS recorded_at, event_id AS ingest_seq
  FROM events)"""

SILVER = BRONZE + f""",
deduped AS (
  SELECT * FROM bronze QUALIFY row_number() OVER (
    PARTITION BY city, road_name, recorded_at ORDER BY ingest_seq DESC) = 1),
silver AS (
  SELECT *, {i("hour(recorded_at)")} AS hour, {i("dayofweek(recorded_at) + 1")} AS day_of_week,
         CASE WHEN dayofweek(recorded_at) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         {level("congestion_index")} AS congestion_level
  FROM deduped WHERE congestion_index BETWEEN 0 AND 100 AND current_speed > 0)"""

COMPARISON = SILVER + """,
comparison AS (
  SELECT city, period, avg(congestion_index) AS avg_congestion, avg(current_speed) AS avg_speed,
         count(*) AS record_count
  FROM silver GROUP BY city, period),
wide AS (
  SELECT city,
         coalesce(max(avg_congestion) FILTER (period = 'before'), 0) AS before_congestion,
         coalesce(max(avg_speed) FILTER (period = 'before'), 0) AS before_speed,
         coalesce(max(record_count) FILTER (period = 'before'), 0) AS before_records,
         coalesce(max(avg_congestion) FILTER (period = 'after'), 0) AS after_congestion,
         coalesce(max(avg_speed) FILTER (period = 'after'), 0) AS after_speed,
         coalesce(max(record_count) FILTER (period = 'after'), 0) AS after_records,
         bool_or(period = 'before') AS has_before, bool_or(period = 'after') AS has_after
  FROM comparison GROUP BY city)"""

CHANGE = r("after_congestion - before_congestion", 2)

DAILY = SILVER + f""",
daily_raw AS (
  SELECT CAST(CAST(recorded_at AS DATE) AS TIMESTAMP) AS summary_date, city,
         avg(congestion_index) AS ci,
         avg(current_speed) AS spd, avg(free_flow_speed) AS ff
  FROM silver GROUP BY ALL),
daily AS (
  SELECT summary_date, city, {r("ci")} AS avg_congestion_index, {r("spd")} AS avg_speed,
         {r("greatest(0, 30 * (1 + ci / 100 * 0.5) / 12 - 2.5) * 16250", 2)}
           AS est_extra_fuel_cost_idr,
         {r("greatest(0, CASE WHEN spd > 0 THEN 30 / spd * 60 ELSE 0 END - CASE WHEN ff > 0 THEN 30 / ff * 60 ELSE 0 END)", 2)}
           AS est_extra_travel_min
  FROM daily_raw)"""

ROADS = SILVER + """,
roads AS (
  SELECT city, road_name, avg(congestion_index) FILTER (period = 'before') AS ci_before,
         avg(congestion_index) FILTER (period = 'after') AS ci_after,
         min(lat) AS lat, min(lon) AS lon
  FROM silver GROUP BY city, road_name),
road_impact AS (
  SELECT *, ci_after - ci_before AS delta_congestion,
         CASE WHEN ci_after - ci_before > 15 THEN 'Dampak Tinggi'
              WHEN ci_after - ci_before >= 5 THEN 'Dampak Sedang'
              ELSE 'Dampak Rendah' END AS zone_band
  FROM roads WHERE ci_before IS NOT NULL AND ci_after IS NOT NULL)"""

ZONES_ONLY = f"""
zone_counts AS (SELECT city, zone_band, count(*) AS n FROM road_impact GROUP BY ALL),
zones AS (
  SELECT city, zone_band AS zone, CAST(sum(n) OVER (PARTITION BY city) AS BIGINT) AS roads,
         {impact_code("zone_band")} AS impact_level
  FROM zone_counts
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY n DESC, zone_band) = 1)"""

SCORED_ONLY = """
baseline AS (
  SELECT city, hour, avg(congestion_index) AS mu, stddev_samp(congestion_index) AS sigma
  FROM silver WHERE period = 'before' GROUP BY city, hour),
z AS (
  SELECT s.*, b.mu, b.sigma,
         (s.congestion_index - b.mu) / CASE WHEN b.sigma > 0 THEN b.sigma ELSE 1 END AS zscore
  FROM silver s LEFT JOIN baseline b USING (city, hour)),
scored AS (
  SELECT *, CASE WHEN abs(zscore) > 2 THEN 1 ELSE 0 END AS is_anomaly FROM z),
rates AS (
  SELECT period, count(*) AS total_records, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
         CAST(round(CAST(sum(is_anomaly) / count(*) * 100 AS DECIMAL(28,10)), 2) AS DOUBLE)
           AS anomaly_rate_pct
  FROM scored GROUP BY period)"""
SCORED = SILVER + "," + SCORED_ONLY

PLACES = """
sup AS (
  SELECT s_suppkey, r_name AS city, n_name AS nation FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ship AS (SELECT lineitem.*, sup.city FROM lineitem JOIN sup ON l_suppkey = s_suppkey)"""

FUEL_EV = """
fuel_ev AS (
  SELECT l_shipdate AS event_time, city, p_type AS fuel_type,
         CAST(8000 AS DOUBLE) + l_extendedprice / 10 AS price
  FROM ship JOIN part ON l_partkey = p_partkey)"""

TRAFFIC_EV = """
traffic_ev AS (
  SELECT l_shipdate AS event_time, city, l_suppkey AS road_id,
         round(l_discount * 100) * 10 AS congestion, l_quantity AS avg_speed,
         100 - round(l_discount * 100) * 10 AS mobility_index
  FROM ship)"""

WEATHER_EV = """
weather_ev AS (
  SELECT l_shipdate AS event_time, city, 100 - round(l_tax * 100) * 10 AS weather_score,
         CAST(25 AS DOUBLE) + l_linenumber AS temperature,
         CAST(60 AS DOUBLE) + l_quantity / 2 AS humidity, l_tax * 100 AS rain_1h,
         CASE l_linenumber % 5 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Rain'
              WHEN 3 THEN 'Drizzle' ELSE 'Thunderstorm' END AS weather_main
  FROM ship)"""

TRANSPORT_EV = """
transport_ev AS (
  SELECT o_orderdate AS event_time, r_name AS city, o_orderpriority AS transport_code,
         CAST(floor(o_totalprice / 1000) AS INTEGER) AS ridership, 600 AS capacity
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

DAY_OF = "CAST(date_trunc('day', event_time) AS TIMESTAMP) AS window_start"
DAY_END = "CAST(date_trunc('day', event_time) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end"

TRAFFIC_DAY = f"""
traffic_day AS (
  SELECT {DAY_OF}, city, avg(congestion) AS avg_congestion, avg(avg_speed) AS avg_speed,
         avg(mobility_index) AS avg_mobility_index, count(road_id) AS roads_monitored
  FROM traffic_ev WHERE congestion BETWEEN 0 AND 100 AND avg_speed > 0 GROUP BY ALL)"""

TRANSPORT_DAY = f"""
transport_day AS (
  SELECT {DAY_OF}, city, CAST(sum(ridership) AS BIGINT) AS total_ridership,
         avg(CAST(ridership AS DOUBLE) / 600 * 100) AS avg_load_factor,
         count(transport_code) AS active_modes
  FROM transport_ev WHERE ridership >= 0 GROUP BY ALL)"""

FUEL_DELTA = f"""
fuel_day AS (
  SELECT {DAY_OF}, city, fuel_type, avg(price) AS avg_price, count(*) AS sample_count
  FROM fuel_ev WHERE price > 0 AND city IS NOT NULL GROUP BY ALL),
fuel_lag AS (
  SELECT *, lag(avg_price) OVER (PARTITION BY city, fuel_type ORDER BY window_start)
           AS prev_avg_price
  FROM fuel_day),
fuel_delta AS (
  SELECT *, CASE WHEN prev_avg_price > 0 THEN (avg_price - prev_avg_price) / prev_avg_price * 100
                 ELSE CAST(0 AS DOUBLE) END AS fuel_price_delta
  FROM fuel_lag)"""


def norm(col: str, high: str) -> str:
    return f"greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), {col} / CAST({high} AS DOUBLE)))"


HOLIDAY_LIST = (
    "'01-01','03-22','03-29','03-31','04-01','05-01','05-14','05-24','06-01','08-17','12-25'"
)

FEATURES = f"""
{PLACES},{FUEL_EV},{TRAFFIC_EV},{WEATHER_EV},{TRANSPORT_EV},{TRAFFIC_DAY},{TRANSPORT_DAY},
{FUEL_DELTA},
weather_day AS (
  SELECT {DAY_OF}, city, avg(weather_score) AS avg_weather_score,
         avg(temperature) AS avg_temperature, avg(rain_1h) AS avg_rain_1h
  FROM weather_ev WHERE weather_score BETWEEN 0 AND 100 GROUP BY ALL),
joined AS (
  SELECT f.city, f.window_start, f.avg_price, f.fuel_price_delta, t.avg_congestion, t.avg_speed,
         t.avg_mobility_index, tr.total_ridership, tr.avg_load_factor, w.avg_weather_score,
         w.avg_temperature, w.avg_rain_1h
  FROM (SELECT * FROM fuel_delta WHERE fuel_type = 'ECONOMY') f
  LEFT JOIN traffic_day t USING (city, window_start)
  LEFT JOIN weather_day w USING (city, window_start)
  LEFT JOIN transport_day tr USING (city, window_start)),
normed AS (
  SELECT *, {norm("avg_congestion", "100")} AS traffic_index,
         {norm("avg_weather_score", "100")} AS weather_score_norm,
         {norm("total_ridership", "50000")} AS transport_usage_norm,
         {i("hour(window_start)")} AS time_of_day, {i("dayofweek(window_start)")} AS day_of_week,
         CASE WHEN strftime(window_start, '%m-%d') IN ({HOLIDAY_LIST})
                   AND year(window_start) BETWEEN 1992 AND 2001 THEN 1 ELSE 0 END AS holiday_flag
  FROM joined),
features AS (
  SELECT city, window_start, avg_price, coalesce(fuel_price_delta, 0) AS fuel_price_delta,
         coalesce(traffic_index, 0) AS traffic_index, avg_congestion,
         coalesce(avg_speed, 0) AS avg_speed, avg_mobility_index,
         coalesce(transport_usage_norm, 0) AS transport_usage_norm, avg_load_factor,
         coalesce(weather_score_norm, 0) AS weather_score_norm,
         coalesce(avg_temperature, 0) AS avg_temperature, coalesce(avg_rain_1h, 0) AS avg_rain_1h,
         time_of_day, day_of_week, holiday_flag,
         {r("(1 - traffic_index) * CAST(0.4 AS DOUBLE) + weather_score_norm * CAST(0.3 AS DOUBLE) + transport_usage_norm * CAST(0.2 AS DOUBLE) + greatest(CAST(0 AS DOUBLE), 1 - fuel_price_delta / 100) * CAST(0.1 AS DOUBLE)", 4)}
           AS mobility_composite
  FROM normed)"""

PAIRS = FEATURES + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY window_start) AS pos,
         count(*) OVER (PARTITION BY city) AS total
  FROM features),
pairs AS (
  SELECT city, window_start, pos, total, 'BBM ↔ Mobilitas' AS pair, fuel_price_delta AS x,
         mobility_composite AS y FROM placed
  UNION ALL
  SELECT city, window_start, pos, total, 'BBM ↔ Kemacetan', fuel_price_delta, avg_congestion
  FROM placed
  UNION ALL
  SELECT city, window_start, pos, total, 'BBM ↔ Transportasi Umum', fuel_price_delta,
         transport_usage_norm FROM placed)"""


def p_value(rr: str, n: str) -> str:
    """Two-sided p by the finite Student-t series, coefficients from gamma functions."""
    even = (
        f"1 - abs({rr}) * list_sum([exp(lgamma(k + 0.5) - lgamma(k + 1.0)) / sqrt(pi()) "
        f"* pow(1 - {rr} * {rr}, k) for k in range(0, CAST(({n} - 2) // 2 AS BIGINT))])"
    )
    odd = (
        f"1 - 2 / pi() * (asin(abs({rr})) + abs({rr}) * coalesce(list_sum("
        f"[exp(lgamma(k + 1.0) - lgamma(k + 1.5)) * sqrt(pi()) / 2 "
        f"* pow(1 - {rr} * {rr}, k + 0.5) for k in range(0, CAST(({n} - 3) // 2 AS BIGINT))]), 0))"
    )
    return (
        f"CASE WHEN {n} < 3 THEN CAST(1 AS DOUBLE) WHEN {rr} IS NULL THEN NULL "
        f"WHEN abs({rr}) >= 1 THEN CAST(0 AS DOUBLE) "
        f"ELSE greatest(0, least(1, CASE WHEN {n} % 2 = 0 THEN {even} ELSE {odd} END)) END"
    )


def pearson(x: str, y: str) -> str:
    """Pearson r over a group; null for a constant side."""
    return (
        f"CASE WHEN count(*) < 3 THEN CAST(0 AS DOUBLE) "
        f"WHEN min({x}) < max({x}) AND min({y}) < max({y}) "
        f"THEN greatest(-1, least(1, covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})))) END"
    )


OVERALL_ONLY = f"""
overall_r AS (
  SELECT city, pair, count(*) AS n, {pearson("x", "y")} AS rr
  FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY city, pair),
overall AS (SELECT *, {p_value("rr", "n")} AS pp FROM overall_r)"""

OVERALL_LABELS = """
         coalesce(pp < 0.05, false) AS significant,
         CASE WHEN rr < 0 THEN 'negative' ELSE 'positive' END AS direction,
         CASE WHEN abs(rr) >= 0.7 THEN 'strong' WHEN abs(rr) >= 0.4 THEN 'moderate'
              WHEN abs(rr) >= 0.2 THEN 'weak' ELSE 'negligible' END AS strength"""

LAG_ONLY = f"""
shifted AS (
  SELECT a.city, a.pair, l.lag_steps, a.x, b.y
  FROM pairs a JOIN (SELECT unnest(range(0, 13)) AS lag_steps) l ON true
  JOIN pairs b ON a.city = b.city AND a.pair = b.pair AND b.pos = a.pos + l.lag_steps
  WHERE a.x IS NOT NULL AND b.y IS NOT NULL),
lag_r AS (
  SELECT city, pair, lag_steps, count(*) AS n, {pearson("x", "y")} AS rr
  FROM shifted GROUP BY city, pair, lag_steps HAVING count(*) >= 10),
lag_p AS (SELECT *, {p_value("rr", "n")} AS pp FROM lag_r),
lags AS (
  SELECT city, pair, {i("lag_steps")} AS lag_steps, CAST(lag_steps * 0.5 AS DOUBLE) AS lag_hours,
         {r("rr", 4)} AS r, {r("pp")} AS p_value, coalesce(pp < 0.05, false) AS significant, n
  FROM lag_p)"""

BEST_ONLY = """
best AS (
  SELECT city, pair, lag_steps AS best_lag_steps, lag_hours AS best_lag_hours, r AS best_lag_r
  FROM lags QUALIFY row_number() OVER (
    PARTITION BY city, pair ORDER BY abs(r) DESC NULLS LAST, lag_steps) = 1)"""

SEQUENCES = FEATURES + """,
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY window_start) - 1 AS BIGINT) AS pos,
         count(*) OVER (PARTITION BY city) AS total
  FROM features),
seq AS (
  SELECT city, window_start, pos, total,
         avg(traffic_index) OVER past AS x_mean_traffic,
         first_value(fuel_price_delta) OVER past AS x_first_delta,
         last_value(day_of_week / 6.0) OVER past AS x_last_day,
         count(*) OVER past AS x_rows, count(*) OVER future AS y_rows,
         first_value(mobility_composite) OVER future AS y_first,
         last_value(mobility_composite) OVER future AS y_last,
         avg(mobility_composite) OVER future AS y_mean
  FROM placed
  WINDOW past AS (PARTITION BY city ORDER BY pos ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING),
         future AS (PARTITION BY city ORDER BY pos ROWS BETWEEN CURRENT ROW AND 47 FOLLOWING)),
kept AS (SELECT * FROM seq WHERE pos >= 48 AND pos < total - 48)"""

CONDITIONS = """
conditions AS (
  SELECT event_id, concat('city_', user_id % 3) AS city, ts AS event_time,
         CASE event_type WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'Clouds'
              WHEN 'purchase' THEN 'Rain' WHEN 'signup' THEN 'Drizzle'
              WHEN 'error' THEN 'Thunderstorm' END AS weather_main,
         CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN value / 50
              ELSE CAST(0 AS DOUBLE) END AS rain_1h
  FROM events)"""

WEATHER_SCORE = (
    "greatest(CAST(0 AS DOUBLE), "
    + r("""CASE weather_main WHEN 'Clear' THEN 100
          WHEN 'Clouds' THEN 80 WHEN 'Drizzle' THEN 60 WHEN 'Rain' THEN 40
          WHEN 'Thunderstorm' THEN 10 WHEN 'Fog' THEN 50 ELSE 70 END
          - least(rain_1h * 5, 30)""", 1)
    + ")"
)

PRICES = f"""
prices AS (
  SELECT concat('part_', l_partkey) AS fuel_type,
         {r("avg(l_extendedprice) FILTER (l_shipdate < TIMESTAMP '1998-07-01')", 2)}
           AS price_before,
         {r("avg(l_extendedprice) FILTER (l_shipdate >= TIMESTAMP '1998-07-01')", 2)}
           AS price_after
  FROM lineitem GROUP BY l_partkey),
policy AS (SELECT * FROM prices WHERE price_before IS NOT NULL AND price_after IS NOT NULL)"""

PRICE_PCT = r("(price_after - price_before) / price_before * 100", 2)

PRICE_ALERTS = f"""
  SELECT 'Nasional' AS city, fuel_type, {r("price_before")} AS old_price,
         {r("price_after")} AS new_price, {PRICE_PCT} AS pct_change,
         CASE WHEN {PRICE_PCT} > 10 THEN 'high' ELSE 'medium' END AS severity
  FROM policy WHERE price_after > price_before"""

POINTS = """
points AS (
  SELECT event_type AS metric, concat('city_', user_id % 3) AS city, ts, value FROM events)"""

MOBILITY_SCORE = r("greatest(0, least(1, 1 - after_congestion / 100))", 4)

MOBILITY_ONLY = f"""
mobility AS (
  SELECT w.city, CASE WHEN has_after THEN {MOBILITY_SCORE} END AS mobility_score,
         CASE WHEN has_after THEN {r("after_congestion / 100", 4)} END AS traffic_index,
         {CHANGE} AS congestion_change, has_after,
         coalesce(impact_level, 'moderate_impact') AS impact_level
  FROM wide w LEFT JOIN zones USING (city))"""

# ROADS, COMPARISON and DAILY each start with SILVER; these parts follow one SILVER.
ROADS_ONLY = ROADS[len(SILVER) + 1:]
COMPARISON_ONLY = COMPARISON[len(SILVER) + 1:]
DAILY_ONLY = DAILY[len(SILVER) + 1:]
MOBILITY = f"{COMPARISON},{ROADS_ONLY},{ZONES_ONLY},{MOBILITY_ONLY}"


# Silver as the two cycles of ``catalog.corrected_lake`` see it: before the correction, and
# after two days were withdrawn; ``silver`` is always the layer a gold table is computed from.
_AT = "current_speed > 0 AND recorded_at <= TIMESTAMP '{}'{})"
_GOOD_DAYS = " AND CAST(recorded_at AS DATE) NOT IN (DATE '2024-01-10', DATE '2024-01-23')"
EARLY = SILVER.replace("current_speed > 0)", _AT.format("2024-01-20 12:00:00", ""))
LATE = SILVER.replace("current_speed > 0)", _AT.format("2024-01-26 18:30:00", _GOOD_DAYS))
CORRECTED = SILVER.replace("current_speed > 0)", f"current_speed > 0{_GOOD_DAYS})")


def _both_cycles(rows: str, keys: str, more: str = "") -> str:
    """Rows of the late cycle, and of the early one those that the late one did not replace."""
    return f"""
        WITH late AS (WITH {LATE}{more} {rows}), early AS (WITH {EARLY}{more} {rows})
        SELECT * FROM late UNION ALL SELECT * FROM early WHERE ({keys}) NOT IN (SELECT ({keys}) FROM late)"""


def _anomaly_columns(extra: str) -> str:
    return (
        f"SELECT city, road_name, recorded_at, congestion_index, {r('mu')} AS baseline_mean, "
        f"{r('sigma')} AS baseline_stddev, {r('zscore')} AS zscore FROM scored "
        f"WHERE is_anomaly = 1 AND period = 'after' {extra}"
    )


_STRONGEST = f"ORDER BY {r('abs(zscore)')} DESC, recorded_at, city, road_name"


def _reject(cte: str, stream: str, rule: str, test: str) -> str:
    return (
        f"SELECT '{stream}' AS stream, '{rule}' AS rule, "
        f"count(*) FILTER (NOT coalesce({test}, false)) AS rejected, count(*) AS total FROM {cte}"
    )


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"


FIVE = "time_bucket(INTERVAL 5 MINUTE, ts) AS window_start"
FIVE_END = "time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end"
ROAD_SPEED = "CAST(50 + user_id % 21 AS DOUBLE) * (1 - least(value, 100) / 200)"
CITY = "concat('city_', user_id % 3) AS city"


ORACLES: dict[str, str] = {
    "bronze_trailing_window": f"""WITH {BRONZE}
        SELECT * EXCLUDE (ingest_seq) FROM bronze
        WHERE recorded_at >= TIMESTAMP '2024-03-10' - INTERVAL 60 DAY""",
    "history_silver": f"""WITH {SILVER}
        SELECT city, road_name, current_speed, congestion_index, congestion_level, period,
               recorded_at FROM silver""",
    "cycle_silver": f"""WITH {CORRECTED}
        SELECT city, CAST(CAST(recorded_at AS DATE) AS TIMESTAMP) AS day, count(*) AS readings
        FROM silver GROUP BY 1, 2""",
    "cycle_comparison": f"""WITH {LATE}
        SELECT city, period, {r("avg(congestion_index)")} AS avg_congestion,
               {r("avg(current_speed)")} AS avg_speed, count(*) AS record_count
        FROM silver GROUP BY city, period""",
    "cycle_hourly": f"""WITH {LATE}
        SELECT city, period, hour, {r("avg(congestion_index)")} AS avg_congestion,
               {r("avg(current_speed)")} AS avg_speed
        FROM silver GROUP BY city, period, hour""",
    "cycle_daily": _both_cycles(
        "SELECT * FROM daily WHERE summary_date = (SELECT max(summary_date) FROM daily)",
        "summary_date, city", "," + DAILY_ONLY),
    "cycle_anomaly_rate": f"WITH {LATE},{SCORED_ONLY} SELECT * FROM rates",
    "cycle_top_anomalies": f"WITH {LATE},{SCORED_ONLY} {_anomaly_columns('')} {_STRONGEST} LIMIT 200",
    "history_fallback": f"""WITH {BRONZE}
        SELECT city, road_name, current_speed, congestion_index,
               {level("congestion_index")} AS congestion_level, period, recorded_at FROM bronze""",
    "bronze_defaults": f"""WITH {CONDITIONS}
        SELECT city, weather_main AS weather_desc,
               {r("CASE WHEN rain_1h > 0 THEN rain_1h ELSE 0 END")} AS rain_1h,
               CASE WHEN event_id % 2 = 0 THEN 'station' ELSE 'openweathermap' END AS source,
               event_time AS recorded_at, 'kafka' AS ingested_via,
               CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS date
        FROM conditions""",
    "silver_traffic": f"WITH {SILVER} SELECT * FROM silver",
    "level_distribution": f"""WITH {SILVER}
        SELECT city, congestion_level, count(*) AS records,
               {label("congestion_level")} AS level_label
        FROM silver GROUP BY city, congestion_level""",
    "period_tag": f"""WITH {BRONZE}
        SELECT city, CASE WHEN CAST(recorded_at AS DATE) >= DATE '2024-01-21' THEN 'after'
                          ELSE 'before' END AS period,
               count(*) AS records, min(recorded_at) AS first_at, max(recorded_at) AS last_at
        FROM bronze GROUP BY 1, 2""",
    "derive_congestion": f"""WITH {BRONZE}
        SELECT ingest_seq, city, road_name,
               {r("greatest(5, (free_flow_speed - current_speed) / free_flow_speed * 100)", 2)}
                 AS derived_index,
               {r("(1 - current_speed / greatest(free_flow_speed, 1)) * 100", 2)}
                 AS derived_percent
        FROM bronze WHERE free_flow_speed <> 0""",
    "weather_score": f"""WITH {CONDITIONS}
        SELECT event_id, city, weather_main, {WEATHER_SCORE} AS weather_score FROM conditions""",
    "transport_load": f"""WITH {TRANSPORT_EV},
        loads AS (SELECT *, {r("CAST(ridership AS DOUBLE) / capacity * 100", 2)} AS pct
                  FROM transport_ev)
        SELECT city, transport_code, count(*) AS trips, CAST(sum(ridership) AS BIGINT) AS ridership,
               {r("avg(pct)")} AS avg_load_factor, {r("max(pct)")} AS max_load_factor
        FROM loads GROUP BY city, transport_code""",
    "dq_rejects": f"WITH {BRONZE},{PLACES},{FUEL_EV},{TRAFFIC_EV},{WEATHER_EV},{TRANSPORT_EV} "
    + " UNION ALL ".join(
        [
            _reject("bronze", "readings", "congestion_range", "congestion_index BETWEEN 0 AND 100"),
            _reject("bronze", "readings", "speed_positive", "current_speed > 0"),
            _reject("fuel_ev", "fuel", "price_positive", "price > 0"),
            _reject("fuel_ev", "fuel", "city_present", "city IS NOT NULL"),
            _reject("traffic_ev", "traffic", "congestion_range", "congestion BETWEEN 0 AND 100"),
            _reject("traffic_ev", "traffic", "speed_positive", "avg_speed > 0"),
            _reject("traffic_ev", "traffic", "speed_not_negative", "avg_speed >= 0"),
            _reject("traffic_ev", "traffic", "mobility_range", "mobility_index BETWEEN 0 AND 100"),
            _reject("weather_ev", "weather", "score_range", "weather_score BETWEEN 0 AND 100"),
            _reject("transport_ev", "transport", "ridership_not_negative", "ridership >= 0"),
        ]
    ),
    "gold_comparison": f"""WITH {COMPARISON}
        SELECT city, period, {r("avg_congestion")} AS avg_congestion,
               {r("avg_speed")} AS avg_speed, record_count FROM comparison""",
    "comparison_wide": f"""WITH {COMPARISON}
        SELECT city, {r("before_congestion")} AS before_congestion,
               {r("before_speed")} AS before_speed, before_records,
               {r("after_congestion")} AS after_congestion, {r("after_speed")} AS after_speed,
               after_records, has_before, has_after, {CHANGE} AS change_pct
        FROM wide""",
    "gold_hourly": f"""WITH {SILVER}
        SELECT city, period, hour, {r("avg(congestion_index)")} AS avg_congestion,
               {r("avg(current_speed)")} AS avg_speed
        FROM silver GROUP BY city, period, hour""",
    "hourly_dense": f"""WITH {SILVER},
        grid AS (SELECT city, CAST(h AS INTEGER) AS hour
                 FROM (SELECT DISTINCT city FROM silver), (SELECT unnest(range(0, 24)) AS h)),
        m AS (SELECT city, hour, avg(congestion_index) FILTER (period = 'before') AS b,
                     avg(congestion_index) FILTER (period = 'after') AS a
              FROM silver GROUP BY city, hour)
        SELECT grid.city, grid.hour, {r("coalesce(b, 0)")} AS before_congestion,
               {r("coalesce(a, 0)")} AS after_congestion
        FROM grid LEFT JOIN m ON grid.city = m.city AND grid.hour = m.hour""",
    "best_hour": f"""WITH {SILVER},
        m AS (SELECT city, hour, avg(congestion_index) AS c FROM silver WHERE period = 'after'
              GROUP BY city, hour),
        b AS (SELECT city, hour FROM m
              QUALIFY row_number() OVER (PARTITION BY city ORDER BY c, hour) = 1)
        SELECT city, coalesce(b.hour, 6) AS best_travel_hour, 'Tinggi' AS expected_congestion
        FROM (SELECT DISTINCT city FROM silver) LEFT JOIN b USING (city)""",
    "daily_impact": f"""WITH {DAILY}
        SELECT * FROM daily WHERE summary_date = (SELECT max(summary_date) FROM daily)""",
    "fuel_history": f"""WITH {DAILY}
        SELECT summary_date AS timestamp, city, avg_congestion_index,
               est_extra_fuel_cost_idr
        FROM daily WHERE city = 'city_0' ORDER BY summary_date DESC LIMIT 24""",
    "price_policy": f"""WITH {PRICES}
        SELECT fuel_type, price_before, price_after, TIMESTAMP '1998-07-01' AS effective_date
        FROM policy""",
    "corr_report_csv": f"""WITH {PAIRS},{OVERALL_ONLY}
        SELECT city, pair, n, {r("rr", 4)} AS pearson_r, significant, direction, strength
        FROM (SELECT *, {OVERALL_LABELS} FROM overall)""",
    "recent_daily": f"WITH {DAILY} SELECT * FROM daily ORDER BY summary_date DESC, city LIMIT 15",
    "road_impact": f"""WITH {ROADS}
        SELECT city, road_name, {r("ci_before")} AS ci_before, {r("ci_after")} AS ci_after,
               {r("lat")} AS lat, {r("lon")} AS lon,
               {r("delta_congestion")} AS delta_congestion, zone_band
        FROM road_impact""",
    "city_zone_mode": f"WITH {ROADS},{ZONES_ONLY} SELECT city, zone, roads, impact_level FROM zones",
    "hourly_trend": f"""WITH {SILVER},
        newest AS (SELECT * FROM silver WHERE date_trunc('hour', recorded_at) >=
                   (SELECT date_trunc('hour', max(recorded_at)) FROM silver) - INTERVAL 167 HOUR)
        SELECT CAST(date_trunc('hour', recorded_at) AS TIMESTAMP) AS hour, city,
               {r("avg(congestion_index)")} AS congestion_index
        FROM newest GROUP BY 1, 2""",
    "upsert_comparison": f"""WITH {SILVER},
        sides AS (SELECT city, period, recorded_at >= TIMESTAMP '2024-01-16' AS late,
                         avg(congestion_index) AS c, avg(current_speed) AS s, count(*) AS n
                  FROM silver GROUP BY ALL)
        SELECT city, period, {r("c")} AS avg_congestion, {r("s")} AS avg_speed, n AS record_count
        FROM sides QUALIFY row_number() OVER (PARTITION BY city, period ORDER BY late DESC) = 1""",
    "layer_counts": f"WITH {SCORED},{ROADS_ONLY},{DAILY_ONLY} "
    + " UNION ALL ".join(
        [
            _count("bronze_traffic", "bronze"),
            _count("bronze_weather", "events"),
            _count("silver_traffic", "silver"),
            _count("gold_city_comparison", "(SELECT DISTINCT city, period FROM silver)"),
            _count("gold_hourly_pattern", "(SELECT DISTINCT city, period, hour FROM silver)"),
            _count("gold_daily_summary", "daily WHERE summary_date = "
                                         "(SELECT max(summary_date) FROM daily)"),
            _count("gold_predictions", "(SELECT DISTINCT city, h FROM silver, "
                                       "(VALUES (30), (60)) AS m(h))"),
            _count("gold_road_clusters", "road_impact"),
            _count("gold_anomalies", "(SELECT 1 FROM scored WHERE is_anomaly = 1 "
                                     "AND period = 'after' LIMIT 200)"),
        ]
    ),
    "baseline_stats": f"""WITH {SCORED}
        SELECT city, hour, {r("mu")} AS mu, {r("sigma")} AS sigma FROM baseline""",
    "anomaly_scored": f"""WITH {SCORED}
        SELECT city, road_name, recorded_at, period, congestion_index, {r("mu")} AS mu,
               {r("sigma")} AS sigma, {r("zscore")} AS zscore, is_anomaly FROM scored""",
    "anomaly_rate": f"WITH {SCORED} SELECT * FROM rates",
    "top_anomalies": f"WITH {SCORED} {_anomaly_columns('')} {_STRONGEST} LIMIT 200",
    "top_anomalies_city": f"""WITH {SCORED}
        {_anomaly_columns("AND city = 'city_1'")} {_STRONGEST} LIMIT 50""",
    "latest_traffic": f"""WITH {BRONZE}
        SELECT city, road_name, {r("lat")} AS lat, {r("lon")} AS lon,
               {r("current_speed")} AS current_speed, free_flow_speed, congestion_index, period,
               recorded_at, ingest_seq
        FROM bronze QUALIFY row_number() OVER (
          PARTITION BY city, road_name ORDER BY recorded_at DESC, ingest_seq DESC) = 1""",
    "latest_lookup": f"""WITH {BRONZE},
        latest AS (SELECT * FROM bronze QUALIFY row_number() OVER (
          PARTITION BY city, road_name ORDER BY recorded_at DESC, ingest_seq DESC) = 1)
        SELECT city, road_name, congestion_index, {r("current_speed")} AS current_speed,
               {label("(" + level("congestion_index") + ")")} AS level_label, recorded_at
        FROM latest WHERE road_name IN (
          SELECT concat('road_', user_id) FROM events WHERE event_type = 'error' AND value > 300)""",
    "supported_city": f"""WITH {PLACES},{TRAFFIC_EV},{TRAFFIC_DAY}
        SELECT window_start, city, {r("avg_congestion")} AS avg_congestion,
               {r("avg_speed")} AS avg_speed, {r("avg_mobility_index")} AS avg_mobility_index,
               roads_monitored
        FROM traffic_day WHERE city IN (SELECT r_name FROM region WHERE r_name LIKE 'A%')""",
    "city_snapshot": f"""WITH {BRONZE},
        latest AS (SELECT * FROM bronze QUALIFY row_number() OVER (
          PARTITION BY city, road_name ORDER BY recorded_at DESC, ingest_seq DESC) = 1)
        SELECT city, {r("avg(congestion_index)")} AS avg_congestion,
               {r("avg(current_speed)")} AS avg_speed, arg_max(period, recorded_at) AS period,
               max(recorded_at) AS updated_at, count(*) AS roads_monitored,
               {r("100 - avg(congestion_index)")} AS mobility_index
        FROM latest GROUP BY city""",
    "timeseries_range": f"""WITH {POINTS}
        SELECT * FROM points WHERE ts BETWEEN TIMESTAMP '2024-01-29 00:00:00'
          AND TIMESTAMP '2024-01-30 06:00:00'
          AND ts BETWEEN TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR
          AND TIMESTAMP '2024-01-30 12:00:00'""",
    "fresh_latest": f"""WITH {POINTS},
        kinds AS (SELECT CASE metric WHEN 'click' THEN 'traffic' WHEN 'view' THEN 'mobility'
                    WHEN 'purchase' THEN 'prediction' WHEN 'signup' THEN 'correlation'
                    WHEN 'error' THEN 'cluster' END AS kind, city, ts, value FROM points)
        SELECT * FROM kinds WHERE ts <= TIMESTAMP '2024-01-30 12:00:00'
          AND ts >= TIMESTAMP '2024-01-30 12:00:00' - to_seconds(CASE kind WHEN 'traffic' THEN 30
            WHEN 'mobility' THEN 60 WHEN 'prediction' THEN 1800 WHEN 'correlation' THEN 3600
            ELSE 86400 END)
        QUALIFY row_number() OVER (PARTITION BY kind, city ORDER BY ts DESC, value DESC) = 1""",
    "price_alerts": f"WITH {PRICES} {PRICE_ALERTS}",
    "budget_projection": f"""WITH {PRICES},
        use AS (SELECT l_orderkey AS consumer, concat('part_', l_partkey) AS fuel_type,
                       l_quantity AS litres_per_day FROM lineitem)
        SELECT consumer, fuel_type, litres_per_day,
               {r("price_before * litres_per_day", 4)} AS daily_before,
               {r("price_after * litres_per_day", 4)} AS daily_after,
               {r("(price_after - price_before) * litres_per_day", 4)} AS extra_daily,
               {r("(price_after - price_before) * litres_per_day * 30", 4)} AS extra_monthly,
               {r("(price_after - price_before) * litres_per_day * 365", 4)} AS extra_yearly
        FROM use JOIN policy USING (fuel_type)""",
    "alerts": f"""WITH {PRICES},{SCORED},
        sides AS (SELECT coalesce(max(anomaly_rate_pct) FILTER (period = 'before'), 0) AS b,
                         coalesce(max(anomaly_rate_pct) FILTER (period = 'after'), 0) AS a
                  FROM rates)
        {PRICE_ALERTS}
        UNION ALL
        SELECT 'Multi-kota', 'Mobilitas', b, a, {r("a - b", 2)}, 'high' FROM sides
        WHERE a > b - 100""",
    "mobility_score": f"WITH {MOBILITY} SELECT * FROM mobility",
    "dashboard_snapshot": f"""WITH {MOBILITY},{DAILY_ONLY},{CONDITIONS},{PRICES},
        newest AS (SELECT * FROM daily
                   QUALIFY row_number() OVER (PARTITION BY city ORDER BY summary_date DESC) = 1),
        weather AS (SELECT city, {r(f"avg({WEATHER_SCORE})")} AS weather_score
                    FROM conditions GROUP BY city),
        load AS (SELECT concat('city_', user_id % 3) AS city,
                        {r("avg(" + r("floor(value) / 600 * 100", 2) + ")")} AS avg_load_factor
                 FROM events GROUP BY 1)
        SELECT m.city, mobility_score, {r("(1 - mobility_score) * 100", 2)} AS congestion_level,
               (SELECT price_after FROM policy ORDER BY fuel_type DESC LIMIT 1) AS fuel_price,
               impact_level, weather_score, avg_load_factor, summary_date,
               avg_congestion_index, est_extra_fuel_cost_idr, est_extra_travel_min
        FROM mobility m LEFT JOIN newest USING (city) LEFT JOIN weather USING (city)
        LEFT JOIN load USING (city)""",
    "kpi_strip": f"""WITH {SCORED},{COMPARISON_ONLY},{DAILY_ONLY},
        chg AS (SELECT city, {CHANGE} AS c FROM wide)
        SELECT 'worst_change' AS kpi, city, {r("c")} AS value
        FROM (SELECT * FROM chg ORDER BY c DESC, city DESC LIMIT 1)
        UNION ALL SELECT 'mean_change', NULL, {r("avg(c)")} FROM chg
        UNION ALL SELECT 'anomaly_rate_after', NULL,
          {r("max(anomaly_rate_pct) FILTER (period = 'after')")} FROM rates
        UNION ALL SELECT 'anomaly_rate_delta', NULL,
          {r("max(anomaly_rate_pct) FILTER (period = 'after') - max(anomaly_rate_pct) FILTER (period = 'before')")}
          FROM rates
        UNION ALL SELECT 'extra_fuel_cost', NULL, {r("sum(est_extra_fuel_cost_idr)")}
          FROM daily WHERE summary_date = (SELECT max(summary_date) FROM daily)""",
    "status_bands": f"""WITH {PLACES},{TRAFFIC_EV},{TRANSPORT_EV},{TRAFFIC_DAY},{TRANSPORT_DAY},
        d AS (SELECT city, {r("avg_congestion")} AS c, {r("avg_load_factor")} AS l
              FROM traffic_day JOIN transport_day USING (city, window_start)),
        s AS (SELECT city, c, l, {r("greatest(0, least(1, 1 - c / 100))", 4)} AS m FROM d)
        SELECT city, CASE WHEN m > 0.6 THEN 'Stabil' WHEN m > 0.4 THEN 'Menurun' ELSE 'Kritis' END
                 AS mobility_status,
               CASE WHEN c < 40 THEN 'Lancar' WHEN c < 65 THEN 'Sedang' ELSE 'Padat' END
                 AS congestion_status,
               CASE WHEN l > 70 THEN 'red' WHEN l > 50 THEN 'yellow' ELSE 'blue' END
                 AS load_status,
               count(*) AS days
        FROM s GROUP BY 1, 2, 3, 4""",
    "fuel_windows": f"""WITH {PLACES},{FUEL_EV}
        SELECT {DAY_OF}, {DAY_END}, city, fuel_type,
               CASE WHEN price < 10000 THEN 'subsidi' WHEN price < 14000 THEN 'ron90'
                    WHEN price < 16000 THEN 'ron95' ELSE 'premium' END AS price_category,
               {r("avg(price)")} AS avg_price, {r("min(price)")} AS min_price,
               {r("max(price)")} AS max_price, count(*) AS sample_count,
               {r("avg(CASE WHEN dayofweek(event_time) IN (0, 6) THEN 1 ELSE 0 END)")}
                 AS is_weekend
        FROM fuel_ev WHERE price > 0 AND city IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    "traffic_windows": f"""WITH {PLACES},{TRAFFIC_EV}
        SELECT {DAY_OF}, {DAY_END}, city,
               CASE WHEN congestion > 80 THEN 'critical' WHEN congestion > 60 THEN 'heavy'
                    WHEN congestion > 40 THEN 'moderate' ELSE 'light' END AS traffic_severity,
               {r("avg(congestion)")} AS avg_congestion, {r("avg(avg_speed)")} AS avg_speed,
               {r("avg(mobility_index)")} AS avg_mobility_index,
               count(road_id) AS roads_monitored
        FROM traffic_ev WHERE congestion BETWEEN 0 AND 100 AND avg_speed > 0
        GROUP BY 1, 2, 3, 4""",
    "weather_windows": f"""WITH {PLACES},{WEATHER_EV},
        v AS (SELECT *, {DAY_OF}, {DAY_END} FROM weather_ev WHERE weather_score BETWEEN 0 AND 100),
        m AS (SELECT window_start, city, weather_main, count(*) AS n FROM v GROUP BY ALL),
        top AS (SELECT window_start, city, weather_main FROM m QUALIFY row_number() OVER (
          PARTITION BY window_start, city ORDER BY n DESC, weather_main) = 1),
        agg AS (SELECT window_start, window_end, city, avg(weather_score) AS s,
                  avg(temperature) AS t, avg(humidity) AS h, avg(rain_1h) AS rain,
                  count(*) AS sample_count FROM v GROUP BY 1, 2, 3)
        SELECT agg.window_start, window_end, agg.city, {r("s")} AS avg_weather_score,
               {r("t")} AS avg_temperature, {r("h")} AS avg_humidity, {r("rain")} AS avg_rain_1h,
               weather_main AS dominant_weather, sample_count
        FROM agg JOIN top ON agg.window_start = top.window_start AND agg.city = top.city""",
    "transport_windows": f"""WITH {TRANSPORT_EV},{TRANSPORT_DAY}
        SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, city, total_ridership,
               {r("avg_load_factor")} AS avg_load_factor, active_modes FROM transport_day""",
    "fuel_delta": f"""WITH {PLACES},{FUEL_EV},{FUEL_DELTA}
        SELECT window_start, city, fuel_type, {r("avg_price")} AS avg_price, sample_count,
               {r("prev_avg_price")} AS prev_avg_price,
               {r("fuel_price_delta")} AS fuel_price_delta
        FROM fuel_delta""",
    "feature_table": f"""WITH {FEATURES}
        SELECT city, window_start, time_of_day, day_of_week, holiday_flag, mobility_composite,
               """
    + ", ".join(
        f"{r(c)} AS {c}"
        for c in (
            "avg_price", "fuel_price_delta", "traffic_index", "avg_congestion", "avg_speed",
            "avg_mobility_index", "transport_usage_norm", "avg_load_factor",
            "weather_score_norm", "avg_temperature", "avg_rain_1h",
        )
    )
    + " FROM features",
    "forecast_features": f"""WITH {FEATURES}
        SELECT city, window_start, {r("time_of_day / 23.0")} AS time_of_day_norm,
               {r("day_of_week / 6.0")} AS day_of_week_norm, holiday_flag, mobility_composite
        FROM features""",
    "feature_resample": f"""WITH {FEATURES}
        SELECT city,
               time_bucket(INTERVAL 7 DAY, window_start, TIMESTAMP '1970-01-01') AS window_start,
               {r("avg(mobility_composite)")} AS mobility_composite,
               {r("avg(traffic_index)")} AS traffic_index,
               {r("avg(fuel_price_delta)")} AS fuel_price_delta
        FROM features GROUP BY 1, 2""",
    "corr_overall": f"""WITH {PAIRS},{OVERALL_ONLY}
        SELECT city, pair, n, {r("rr")} AS pearson_r, {r("pp")} AS p_value, {OVERALL_LABELS}
        FROM overall""",
    "corr_sliding": f"""WITH {PAIRS},
        ends AS (SELECT city, pair, pos AS window_end, window_start AS window_end_at FROM pairs
                 WHERE pos >= 48 AND pos < total AND (pos - 48) % 6 = 0),
        rows48 AS (SELECT e.*, p.x, p.y FROM ends e JOIN pairs p ON p.city = e.city
                   AND p.pair = e.pair AND p.pos BETWEEN e.window_end - 47 AND e.window_end
                   WHERE p.x IS NOT NULL AND p.y IS NOT NULL),
        w AS (SELECT city, pair, window_end, window_end_at, count(*) AS n,
                     {pearson("x", "y")} AS rr
              FROM rows48 GROUP BY ALL HAVING count(*) >= 3),
        s AS (SELECT *, {p_value("rr", "n")} AS pp FROM w)
        SELECT city, pair, window_end, window_end_at, {r("rr", 4)} AS r, {r("pp")} AS p_value,
               coalesce(pp < 0.05, false) AS significant, n FROM s""",
    "corr_lag": f"WITH {PAIRS},{LAG_ONLY} SELECT * FROM lags",
    "corr_best_lag": f"WITH {PAIRS},{LAG_ONLY},{BEST_ONLY} SELECT * FROM best",
    "corr_report": f"""WITH {PAIRS},{OVERALL_ONLY},{LAG_ONLY},{BEST_ONLY}
        SELECT o.city, o.pair, {r("rr")} AS pearson_r, {r("pp")} AS p_value, {OVERALL_LABELS},
               coalesce(best_lag_hours, 0) AS best_lag_hours,
               coalesce(best_lag_r, rr) AS best_lag_r
        FROM overall o LEFT JOIN best b ON o.city = b.city AND o.pair = b.pair""",
    "sequences_summary": f"""WITH {SEQUENCES}
        SELECT city, window_start, pos, {i("x_rows")} AS x_rows, {i("y_rows")} AS y_rows,
               {r("x_mean_traffic")} AS x_mean_traffic, {r("x_first_delta")} AS x_first_delta,
               {r("x_last_day")} AS x_last_day, {r("y_first")} AS y_first,
               {r("y_last")} AS y_last, {r("y_mean")} AS y_mean
        FROM kept""",
    "chrono_split": f"""WITH {SEQUENCES},
        t AS (SELECT *, CASE WHEN pos - 48 < floor((total - 96) * CAST(0.8 AS DOUBLE))
                             THEN 'train' ELSE 'validation' END AS split
              FROM kept WHERE total - 96 >= 10)
        SELECT city, split, count(*) AS sequences, min(window_start) AS first_at,
               max(window_start) AS last_at
        FROM t GROUP BY city, split""",
    "recent_context": f"""WITH {FEATURES},
        k AS (SELECT *, {i("row_number() OVER (PARTITION BY city ORDER BY window_start DESC)")}
                AS steps_back, count(*) OVER (PARTITION BY city) AS total FROM features)
        SELECT city, window_start, steps_back, {r("fuel_price_delta")} AS fuel_price_delta,
               {r("traffic_index")} AS traffic_index, mobility_composite
        FROM k WHERE steps_back <= 48 AND total >= 48""",
    "stream_fuel_windows": f"""
        WITH e AS (SELECT ts, {CITY}, event_type AS fuel_type, 8000 + value * 20 AS price
                   FROM events)
        SELECT {FIVE}, {FIVE_END}, city, fuel_type,
               CASE WHEN price < 10000 THEN 'subsidi' WHEN price < 14000 THEN 'ron90'
                    WHEN price < 16000 THEN 'ron95' ELSE 'premium' END AS price_category,
               {r("avg(price)")} AS avg_price, {r("min(price)")} AS min_price,
               {r("max(price)")} AS max_price, count(*) AS sample_count,
               {r("avg(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END)")} AS is_weekend
        FROM e WHERE price > 0 GROUP BY 1, 2, 3, 4, 5""",
    "stream_traffic_windows": f"""
        SELECT {FIVE}, {FIVE_END}, {CITY},
               CASE WHEN value > 80 THEN 'critical' WHEN value > 60 THEN 'heavy'
                    WHEN value > 40 THEN 'moderate' ELSE 'light' END AS traffic_severity,
               {r("avg(value)")} AS avg_congestion, {r(f"avg({ROAD_SPEED})")} AS avg_speed,
               {r("avg(100 - value)")} AS avg_mobility_index, count(*) AS roads_monitored
        FROM events WHERE value BETWEEN 0 AND 100 GROUP BY 1, 2, 3, 4""",
    "stream_weather_windows": f"""
        WITH {CONDITIONS},
        e AS (SELECT ts, {CITY}, value, user_id, weather_main
              FROM events JOIN conditions USING (event_id) WHERE value BETWEEN 0 AND 100),
        v AS (SELECT {FIVE}, {FIVE_END}, * FROM e),
        m AS (SELECT window_start, city, weather_main, count(*) AS n FROM v GROUP BY ALL),
        top AS (SELECT window_start, city, weather_main FROM m QUALIFY row_number() OVER (
          PARTITION BY window_start, city ORDER BY n DESC, weather_main) = 1),
        agg AS (SELECT window_start, window_end, city, avg(value) AS s, avg(25 + user_id % 10) AS t,
                  avg(60 + user_id % 30) AS h, avg(value / 50) AS rain, count(*) AS sample_count
                FROM v GROUP BY 1, 2, 3)
        SELECT agg.window_start, window_end, agg.city, {r("s")} AS avg_weather_score,
               {r("t")} AS avg_temperature, {r("h")} AS avg_humidity, {r("rain")} AS avg_rain_1h,
               weather_main AS dominant_weather, sample_count
        FROM agg JOIN top ON agg.window_start = top.window_start AND agg.city = top.city""",
    "stream_transport_windows": f"""
        SELECT {FIVE}, {FIVE_END}, {CITY}, CAST(sum(floor(value)) AS BIGINT) AS total_ridership,
               {r("avg(floor(value) / 600 * 100)")} AS avg_load_factor, count(*) AS active_modes
        FROM events WHERE floor(value) >= 0 GROUP BY 1, 2, 3""",
    "stream_bronze_ingest": f"""
        SELECT {CITY}, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, source, 'kafka' AS ingested_via,
               count(*) AS records, bronze_table
        FROM events, (VALUES ('tomtom', 'bronze_traffic'), ('openweathermap', 'bronze_weather'))
          AS b(source, bronze_table)
        GROUP BY ALL""",
    "bronze_rejects": """
        SELECT CASE event_id % 40 WHEN 3 THEN 'other.raw' ELSE 'traffic.raw' END AS topic,
               CASE event_id % 40 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'no_time'
                    WHEN 2 THEN 'no_city' WHEN 3 THEN 'unknown_topic' ELSE 'kept' END AS reason,
               count(*) AS messages
        FROM events GROUP BY 1, 2""",
    "stream_joined_windows": f"""
        WITH e AS (SELECT {FIVE}, {CITY}, value, {ROAD_SPEED} AS speed FROM events
                   WHERE time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
                         <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE)
        SELECT window_start, city, {r("avg(8000 + value * 20)")} AS avg_price,
               {r("avg(value) FILTER (value BETWEEN 0 AND 100)")} AS avg_congestion,
               {r("avg(speed) FILTER (value BETWEEN 0 AND 100)")} AS avg_speed,
               {r("avg(value) FILTER (value BETWEEN 0 AND 100)")} AS avg_weather_score,
               CAST(sum(floor(value)) AS BIGINT) AS total_ridership
        FROM e GROUP BY 1, 2""",
    "stream_live_feed": f"""
        WITH last AS (SELECT *, {CITY}, {ROAD_SPEED} AS speed FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
        SELECT city, {r("greatest(0, least(1, 1 - avg(value) / 100))", 4)} AS mobility_score,
               {r("avg(value)", 2)} AS congestion_level, {r("avg(speed)", 2)} AS avg_speed,
               CASE WHEN max(ts) >= TIMESTAMP '2024-01-21' THEN 'after' ELSE 'before' END AS period,
               max(ts) AS updated_at
        FROM last GROUP BY city""",
    "medallion_cycle": f"WITH {SCORED},{ROADS_ONLY},{DAILY_ONLY} "
    + " UNION ALL ".join(
        [
            _count("silver_traffic", "silver"),
            _count("silver_baseline", "baseline"),
            _count("silver_cells", "(SELECT DISTINCT city, period, recorded_at FROM silver)"),
            _count("gold_city_comparison", "(SELECT DISTINCT city, period FROM silver)"),
            _count("gold_hourly_pattern", "(SELECT DISTINCT city, period, hour FROM silver)"),
            _count("gold_daily_summary", "daily WHERE summary_date = "
                                         "(SELECT max(summary_date) FROM daily)"),
            _count("gold_road_impact", "road_impact"),
            _count("gold_road_clusters", "road_impact"),
            _count("latest_roads", "(SELECT DISTINCT city, road_name FROM silver)"),
            _count("gold_anomalies", "(SELECT 1 FROM scored WHERE is_anomaly = 1 "
                                     "AND period = 'after' LIMIT 200)"),
            _count("gold_anomaly_rate", "rates"),
            _count("gold_model_metrics", "(VALUES ('accuracy'), ('f1'))"),
            _count("gold_predictions", "(SELECT DISTINCT city, h FROM silver, "
                                       "(VALUES (30), (60)) AS m(h))"),
        ]
    ),
}

# The stored features are the feature table.
ORACLES["feature_store"] = ORACLES["feature_table"]
# Stored points that are kept are the points in range.
ORACLES["timeseries_store"] = ORACLES["timeseries_range"]
ORACLES["snapshot_roads"] = f"""WITH {BRONZE},
    latest AS (SELECT * FROM bronze QUALIFY row_number() OVER (
      PARTITION BY city, road_name ORDER BY recorded_at DESC, ingest_seq DESC) = 1)
    SELECT city, road_name, {r("lat")} AS lat, {r("lon")} AS lon,
           {r("current_speed")} AS current_speed, free_flow_speed, congestion_index, recorded_at
    FROM latest"""
ORACLES["gold_summary_fields"] = f"""WITH {COMPARISON}
    SELECT concat('comparison:', city) AS key, {CHANGE} AS change_pct,
           {r("before_congestion", 2)} AS before_avg_congestion,
           {r("before_speed", 2)} AS before_avg_speed, before_records,
           {r("after_congestion", 2)} AS after_avg_congestion,
           {r("after_speed", 2)} AS after_avg_speed, after_records
    FROM wide"""

ORACLES["feature_store_late"] = ORACLES["feature_table"]
ORACLES["road_lookup"] = f"""WITH {BRONZE},
    latest AS (SELECT * FROM bronze QUALIFY row_number() OVER (
      PARTITION BY city, road_name ORDER BY recorded_at DESC, ingest_seq DESC) = 1)
    SELECT city, road_name, congestion_index, {r("current_speed")} AS current_speed,
           {label("(" + level("congestion_index") + ")")} AS level_label, recorded_at
    FROM latest WHERE (city, road_name) IN (
      ('city_0', 'road_3'), ('city_1', 'road_7'), ('city_2', 'road_11'), ('city_0', 'road_4'))"""
ORACLES["precision_losses"] = f"""WITH {ROADS}
    SELECT unnest(['lat', 'lon', 'ci_before', 'ci_after', 'delta_congestion']) AS column_name,
           unnest([0, 0, 0, (SELECT count(*) FROM road_impact WHERE ci_after * 200 >= 9999.995), 0])::BIGINT
             AS dropped"""
ORACLES["daily_documents"] = f"""WITH {LATE},{DAILY_ONLY}
    SELECT concat('daily:', city) AS key, city, summary_date,
           {r("avg_congestion_index", 2)} AS avg_congestion_index, {r("avg_speed", 2)} AS avg_speed,
           est_extra_fuel_cost_idr, est_extra_travel_min
    FROM daily WHERE summary_date = (SELECT max(summary_date) FROM daily)"""
ORACLES["hourly_documents"] = f"""WITH {LATE}
    SELECT concat('hourly:', city) AS key, period, hour, {r("avg(congestion_index)", 2)} AS avg_congestion,
           {r("avg(current_speed)", 2)} AS avg_speed
    FROM silver GROUP BY city, period, hour"""
ORACLES["distinct_estimates"] = f"""WITH {PLACES},{TRAFFIC_EV},{TRANSPORT_EV}
    SELECT 'road' AS kind, city, {i("year(event_time)")} AS year, count(DISTINCT road_id) AS exact, true AS near
    FROM traffic_ev WHERE congestion BETWEEN 0 AND 100 AND avg_speed > 0 GROUP BY ALL
    UNION ALL
    SELECT 'mode', city, {i("year(event_time)")}, count(DISTINCT transport_code), true
    FROM transport_ev WHERE ridership >= 0 GROUP BY ALL"""
ORACLES["stream_left_out"] = """
    SELECT 'traffic_agg' AS stream, count(*) AS events, count(*) FILTER (value NOT BETWEEN 0 AND 100) AS invalid,
           count(*) FILTER (event_id % 50 = 0) AS no_time, 0::BIGINT AS late
    FROM events"""
ORACLES["stream_fresh"] = f"""WITH {POINTS},
    kinds AS (SELECT CASE metric WHEN 'click' THEN 'traffic' WHEN 'view' THEN 'mobility'
                WHEN 'purchase' THEN 'prediction' WHEN 'signup' THEN 'correlation'
                WHEN 'error' THEN 'cluster' END AS kind, city, ts, value FROM points)
    SELECT * FROM kinds
    WHERE ts >= (SELECT max(ts) FROM events) - to_seconds(CASE kind WHEN 'traffic' THEN 30
        WHEN 'mobility' THEN 60 WHEN 'prediction' THEN 1800 WHEN 'correlation' THEN 3600 ELSE 86400 END)
    QUALIFY row_number() OVER (PARTITION BY kind, city ORDER BY ts DESC, value DESC) = 1"""

PREDICTIONS = f"""
predictions AS (
  SELECT {CITY}, {i("30 * (1 + event_id % 3)")} AS horizon_minutes,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS predicted_at,
         {i("max(least(floor(value / 100), 3))")} AS predicted_level, max(user_id)::DOUBLE AS current_avg_speed
  FROM events GROUP BY 1, 2, 3)"""
_NEWEST = "row_number() OVER (PARTITION BY city, horizon_minutes ORDER BY predicted_at DESC)"

ORACLES["latest_predictions"] = f"""WITH {PREDICTIONS}
    SELECT city, horizon_minutes, predicted_level, predicted_at FROM predictions
    QUALIFY row_number() OVER (PARTITION BY city ORDER BY predicted_at DESC, horizon_minutes) <= 24"""
ORACLES["forecast_sides"] = f"""WITH {PREDICTIONS},
    newest AS (SELECT * FROM predictions WHERE horizon_minutes <= 60 QUALIFY {_NEWEST} = 1),
    h30 AS (SELECT * FROM newest WHERE horizon_minutes = 30),
    h60 AS (SELECT * FROM newest WHERE horizon_minutes = 60)
    SELECT coalesce(a.city, b.city) AS city,
           greatest(a.current_avg_speed, b.current_avg_speed) AS current_avg_speed,
           a.predicted_level AS predicted_30m, {label("a.predicted_level")} AS predicted_30m_label,
           b.predicted_level AS predicted_60m, {label("b.predicted_level")} AS predicted_60m_label,
           greatest(a.predicted_at, b.predicted_at) AS updated_at
    FROM h30 a FULL JOIN h60 b ON a.city = b.city"""
ORACLES["forecast_steps_stored"] = f"""WITH {PREDICTIONS},
    cached AS (SELECT *, 0 AS source FROM predictions WHERE city <> 'city_2' AND horizon_minutes <= 60
               QUALIFY {_NEWEST} = 1),
    stored AS (SELECT *, 1 AS source FROM predictions WHERE predicted_at < TIMESTAMP '2024-01-25'
               QUALIFY {_NEWEST} = 1),
    both_sides AS (SELECT * FROM cached UNION ALL SELECT * FROM stored),
    steps AS (SELECT city, horizon_minutes / 60.0 AS hour_offset, {r("1 - predicted_level / 3", 4)} AS mobility_score,
                     {label("predicted_level")} AS congestion_level
              FROM both_sides QUALIFY row_number() OVER (PARTITION BY city, horizon_minutes ORDER BY source) = 1),
    cities AS (SELECT DISTINCT concat('city_', user_id % 5) AS city FROM events)
    SELECT city, hour_offset::DOUBLE AS hour_offset, mobility_score, congestion_level FROM steps
    UNION ALL SELECT city, 0.5, 0.5, 'Ramai Lancar' FROM cities WHERE city NOT IN (SELECT city FROM steps)"""

CLUSTERS = f"""{ROADS},
fixed AS (SELECT *, {i("CAST(regexp_extract(road_name, '[0-9]+') AS INTEGER) % 4")} AS zone_cluster FROM road_impact),
ranked AS (
  SELECT zone_cluster, count(*) AS roads, row_number() OVER (ORDER BY avg(delta_congestion), zone_cluster) AS place,
         count(*) OVER () AS clusters
  FROM fixed GROUP BY zone_cluster),
named AS (
  SELECT *, CASE place WHEN 1 THEN 'Dampak Rendah' WHEN 2 THEN 'Dampak Sedang' ELSE 'Dampak Tinggi' END AS zone_label
  FROM ranked)"""
ORACLES["cluster_ranking"] = f"WITH {CLUSTERS} SELECT zone_cluster, zone_label, roads FROM named"
ORACLES["cluster_levels"] = f"""WITH {CLUSTERS}
    SELECT city, road_name, zone_cluster AS cluster,
           CASE WHEN place = clusters THEN 'high_impact' WHEN place = 1 THEN 'low_impact'
                ELSE 'moderate_impact' END AS impact_level
    FROM fixed JOIN ranked USING (zone_cluster)"""
ORACLES["cluster_overview_fixed"] = f"""WITH {CLUSTERS},
    labelled AS (SELECT city, road_name, zone_cluster, zone_label FROM fixed JOIN named USING (zone_cluster)),
    counts AS (SELECT city, zone_label AS city_zone, count(*) AS n FROM labelled GROUP BY ALL),
    top AS (SELECT city, city_zone FROM counts
            QUALIFY row_number() OVER (PARTITION BY city ORDER BY n DESC, city_zone) = 1)
    SELECT l.*, city_zone, {impact_code("city_zone")} AS impact_level FROM labelled l JOIN top USING (city)"""
ORACLES["confusion_metrics"] = f"""WITH {SILVER},
    guessed AS (SELECT congestion_level AS label, hour,
                  CASE WHEN current_speed > 50 THEN 0 WHEN current_speed > 40 THEN 1
                       WHEN current_speed > 32 THEN 2 ELSE 3 END AS guess FROM silver),
    levels AS (SELECT level, count(*) FILTER (label = level) AS actual, count(*) FILTER (guess = level) AS predicted,
                 count(*) FILTER (label = level AND guess = level) AS hits
               FROM guessed, (SELECT unnest([0, 1, 2, 3]) AS level) GROUP BY level),
    totals AS (SELECT sum(hits) / sum(actual) AS accuracy,
                 sum(2.0 * hits / nullif(actual + predicted, 0) * actual) / sum(actual) AS f1 FROM levels)
    SELECT 'RandomForest_Congestion' AS model_name, unnest(['accuracy', 'f1']) AS metric_name,
           unnest([{r("accuracy", 4)}, {r("f1", 4)}]) AS metric_value,
           (SELECT count(*) FROM guessed WHERE hour < 12) AS train_rows, (SELECT count(*) FROM guessed) AS test_rows,
           (SELECT count(*) FROM guessed WHERE hour > 20) AS dropped_rows
    FROM totals"""

# The inputs of the forecast in the order of ``mobility_forecast.inputs_of``.
_INPUTS = (
    "fuel_price_delta", "traffic_index", "weather_score_norm", "transport_usage_norm", "time_of_day / 23.0",
    "day_of_week / 6.0", "holiday_flag",
)
_X = ["one", *(f"l{k}" for k in range(7)), *(f"m{k}" for k in range(7)), "step", "step_sin", "step_cos"]
_SUMS = [f"sum({a} * {b})" for k, a in enumerate(_X) for b in _X[k:]] + [f"sum({a} * label)" for a in _X]
ORACLES["mobility_gram"] = f"""WITH {FEATURES},
    placed AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY window_start) - 1 AS pos,
                      count(*) OVER (PARTITION BY city) AS total FROM features),
    past AS (SELECT city, pos, total, {", ".join(
        f"(lag({c}) OVER (PARTITION BY city ORDER BY pos))::DOUBLE AS l{k}, "
        f"avg({c}) OVER (PARTITION BY city ORDER BY pos ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING) AS m{k}"
        for k, c in enumerate(_INPUTS))} FROM placed),
    train AS (SELECT * FROM past WHERE pos >= 48 AND pos < total - 48 AND total - 96 >= 10
              AND pos - 48 < floor((total - 96) * CAST(0.8 AS DOUBLE))),
    rows_ AS (SELECT t.*, 1.0::DOUBLE AS one, (p.pos - t.pos + 1)::DOUBLE AS step, p.mobility_composite AS label,
                sin(2 * pi() * (l4 * 23 / 24 + (p.pos - t.pos + 1))) AS step_sin,
                cos(2 * pi() * (l4 * 23 / 24 + (p.pos - t.pos + 1))) AS step_cos
              FROM train t JOIN placed p ON p.city = t.city AND p.pos BETWEEN t.pos AND t.pos + 47),
    sums AS (SELECT city, [{", ".join(_SUMS)}] AS totals FROM rows_ GROUP BY city),
    flat AS (SELECT city, unnest(range(len(totals))) AS place, unnest(totals) AS total, totals[1] AS n FROM sums)
    SELECT city, {i("place")} AS place, {r("total / n", 5)} AS mean_product FROM flat"""
