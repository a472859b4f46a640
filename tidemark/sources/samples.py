"""Views of the star-schema sample tables in the shape of the domain inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.bands import lookup
from tidemark.functions.scores import half_up

EVENT_DATE = "2024-01-21"
PRICE_DATE = "1998-07-01"
BENCHMARK_FUEL = "ECONOMY"
CAPACITY = 600


class SampleTables:
    """Opens ``<folder>/<table>.parquet`` on attribute access."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")


def road_readings(events: DataFrame) -> DataFrame:
    """Bronze road readings: a user is a road, its city follows from the id."""
    user, value = F.col("user_id"), F.col("value")
    free_flow = (F.lit(50) + user % 21).cast("double")
    slot = (user % 15).cast("double")
    recorded = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return events.select(
        F.concat(F.lit("city_"), (user % 3).cast("string")).alias("city"),
        F.concat(F.lit("road_"), user.cast("string")).alias("road_name"),
        (F.lit(-6.0) - slot * 0.05).alias("lat"),
        (F.lit(106.0) + slot * 0.1).alias("lon"),
        F.when(F.col("event_id") % 50 == 0, 0.0)
        .otherwise(free_flow * (1 - F.least(value, F.lit(100.0)) / 200))
        .alias("current_speed"),
        free_flow.alias("free_flow_speed"),
        value.alias("congestion_index"),
        F.when(recorded >= F.lit(EVENT_DATE).cast("timestamp"), "after")
        .otherwise("before")
        .alias("period"),
        recorded.alias("recorded_at"),
        F.col("event_id").alias("ingest_seq"),
    )


def condition_events(events: DataFrame) -> DataFrame:
    """Weather conditions by event type, with rain for the last three."""
    kind = F.col("event_type")
    wet = kind.isin("purchase", "signup", "error")
    return events.select(
        "event_id",
        F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(kind == "click", "Clear")
        .when(kind == "view", "Clouds")
        .when(kind == "purchase", "Rain")
        .when(kind == "signup", "Drizzle")
        .when(kind == "error", "Thunderstorm")
        .alias("weather_main"),
        F.when(wet, F.col("value") / 50).otherwise(0.0).alias("rain_1h"),
    )


def _located(rows: DataFrame, nation_key: str, t: SampleTables) -> DataFrame:
    """Add ``nation`` and ``city`` (the region).

    Joined one table at a time: each right side is a plain file scan, so the
    planner knows its size and never broadcasts the facts by mistake.
    """
    return (
        rows.join(t.nation, F.col(nation_key) == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnsRenamed({"r_name": "city", "n_name": "nation"})
    )


def _shipments(t: SampleTables) -> DataFrame:
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return _located(rows, "s_nationkey", t).withColumn(
        "event_time", F.col("l_shipdate").cast("timestamp")
    )


def fuel_events(t: SampleTables) -> DataFrame:
    fuels = t.part.select("p_partkey", F.col("p_type").alias("fuel_type"))
    return (
        _shipments(t)
        .join(fuels, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "event_time", "city", "nation", "fuel_type",
            (F.lit(8000.0) + F.col("l_extendedprice") / 10).alias("price"),
        )
    )


def _tens(share: str) -> Column:
    """Hundredths as whole tens: 0.07 gives 70."""
    return F.floor(F.col(share) * 100 + 0.5) * 10.0


def traffic_events(t: SampleTables) -> DataFrame:
    congestion = _tens("l_discount")
    return _shipments(t).select(
        "event_time", "city", "nation",
        F.col("l_suppkey").cast("string").alias("road_id"),
        congestion.alias("congestion_level"),
        F.col("l_quantity").alias("avg_speed"),
        (100 - congestion).alias("mobility_index"),
    )


def weather_events(t: SampleTables) -> DataFrame:
    slot = F.col("l_linenumber") % 5
    return _shipments(t).select(
        "event_time", "city",
        (100 - _tens("l_tax")).alias("weather_score"),
        (25.0 + F.col("l_linenumber")).alias("temperature"),
        (60.0 + F.col("l_quantity") / 2).alias("humidity"),
        (F.col("l_tax") * 100).alias("rain_1h"),
        F.when(slot == 0, "Clear").when(slot == 1, "Clouds").when(slot == 2, "Rain")
        .when(slot == 3, "Drizzle").otherwise("Thunderstorm").alias("weather_main"),
    )


def transport_events(t: SampleTables) -> DataFrame:
    ridership = F.floor(F.col("o_totalprice") / 1000).cast("int")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return _located(rows, "c_nationkey", t).select(
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        "city", "nation",
        F.col("o_orderpriority").alias("transport_mode"),
        F.col("o_orderpriority").alias("transport_code"),
        ridership.alias("ridership"),
        F.lit(CAPACITY).alias("capacity"),
        (ridership / CAPACITY * 100).alias("load_factor_pct"),
    )


def price_table(t: SampleTables) -> DataFrame:
    """A price policy per part: mean price before and after the price date."""
    after = F.col("l_shipdate").cast("timestamp") >= F.lit(PRICE_DATE).cast("timestamp")
    price = F.col("l_extendedprice")
    return (
        t.lineitem.groupBy("l_partkey")
        .agg(
            half_up(F.avg(F.when(~after, price)), 2).alias("price_before"),
            half_up(F.avg(F.when(after, price)), 2).alias("price_after"),
        )
        .na.drop()
        .select(
            F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("fuel_type"),
            "price_before",
            "price_after",
            F.lit(PRICE_DATE).cast("date").alias("effective_date"),
        )
    )


def consumption(t: SampleTables) -> DataFrame:
    """Daily fuel use: an order is a consumer, each of its lines the use of one fuel."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("consumer"),
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("fuel_type"),
        F.col("l_quantity").alias("litres_per_day"),
    )


def event_messages(events: DataFrame, kind: str) -> DataFrame:
    """The event rows as JSON messages of one topic: (topic, value, broker_ts).

    Works on a batch frame and on a stream.
    """
    at = F.col("ts").cast("timestamp")
    user, value = F.col("user_id"), F.col("value")
    city = F.concat(F.lit("city_"), (user % 3).cast("string")).alias("city")
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    road = F.concat(F.lit("road_"), user.cast("string"))
    free_flow = (F.lit(50) + user % 21).cast("double")
    by_kind = {
        "fuel": [
            F.col("event_type").alias("fuel_type"),
            (8000.0 + value * 20).alias("price"),
        ],
        "traffic": [
            road.alias("road_id"),
            road.alias("road_name"),
            value.alias("congestion_level"),
            (free_flow * (1 - F.least(value, F.lit(100.0)) / 200)).alias("avg_speed"),
            free_flow.alias("free_flow_speed"),
            (100 - value).alias("mobility_index"),
        ],
        "weather": [
            (25 + user % 10).cast("double").alias("temperature"),
            (60 + user % 30).cast("double").alias("humidity"),
            lookup(
                "event_type",
                {"click": "Clear", "view": "Clouds", "purchase": "Rain",
                 "signup": "Drizzle", "error": "Thunderstorm"},
            ).alias("weather_main"),
            (value / 50).alias("rain_1h"),
            value.alias("weather_score"),
        ],
        "transport": [
            F.col("event_type").alias("transport_mode"),
            F.col("event_type").alias("transport_code"),
            F.floor(value).cast("int").alias("ridership"),
            F.lit(CAPACITY).alias("capacity"),
            (F.floor(value) / CAPACITY * 100).alias("load_factor_pct"),
        ],
        "reading": [
            road.alias("road_name"),
            (F.lit(-6.0) - (user % 15) * 0.05).alias("lat"),
            (F.lit(106.0) + (user % 15) * 0.1).alias("lon"),
            (free_flow * (1 - F.least(value, F.lit(100.0)) / 200)).alias("current_speed"),
            free_flow.alias("free_flow_speed"),
            value.alias("congestion_index"),
            F.when(at >= F.lit(EVENT_DATE).cast("timestamp"), "after").otherwise("before")
            .alias("period"),
            stamp.alias("recorded_at"),
        ],
        "condition": [
            (25 + user % 10).cast("double").alias("temp"),
            (60 + user % 30).cast("int").alias("humidity"),
            F.col("event_type").alias("weather_desc"),
            stamp.alias("recorded_at"),
        ],
    }
    topics = {
        "fuel": "fuel-price-stream", "traffic": "traffic-stream", "weather": "weather-stream",
        "transport": "transport-stream", "reading": "traffic.raw", "condition": "weather.raw",
    }
    return events.select(
        F.lit(topics[kind]).alias("topic"),
        F.to_json(F.struct(stamp, city, *by_kind[kind])).alias("value"),
        at.alias("broker_ts"),
    )


def events_stream(t: SampleTables) -> DataFrame:
    """The events table read as a stream."""
    return t.spark.readStream.schema(t.events.schema).parquet(
        f"{t.folder}/events*.parquet"
    )


def city_impact(t: SampleTables) -> DataFrame:
    """City cluster inputs, one row per nation."""
    after = F.col("event_time") >= F.lit(PRICE_DATE).cast("timestamp")

    def change(name: str) -> Column:
        return F.avg(F.when(after, F.col(name))) - F.avg(F.when(~after, F.col(name)))

    price_before = F.avg(F.when(~after, F.col("price")))
    fuel = fuel_events(t).groupBy("nation").agg(
        (change("price") / price_before * 100).alias("avg_fuel_price_delta")
    )
    traffic = traffic_events(t).groupBy("nation").agg(
        (-change("mobility_index")).alias("avg_mobility_drop"),
        change("congestion_level").alias("avg_congestion_change"),
    )
    transport = transport_events(t).groupBy("nation").agg(
        (F.avg("load_factor_pct") / 100).alias("alt_transport_ratio")
    )
    income = _located(t.customer, "c_nationkey", t).groupBy("nation").agg(
        (F.avg("c_acctbal") / 10_000).alias("city_income_proxy")
    )
    joined = fuel.join(traffic, "nation").join(transport, "nation").join(income, "nation")
    return joined.withColumnRenamed("nation", "city").na.drop()


def prediction_table(t: SampleTables) -> DataFrame:
    """Stored predictions as a fixed table: one per city, horizon and hour."""
    level = F.least(F.floor(F.col("value") / 100), F.lit(3)).cast("int")
    return t.events.groupBy(
        F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"),
        (30 * (1 + F.col("event_id") % 3)).cast("int").alias("horizon_minutes"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("predicted_at"),
    ).agg(F.max(level).alias("predicted_level"), F.max("user_id").cast("double").alias("current_avg_speed"))


def with_fixed_clusters(roads: DataFrame) -> DataFrame:
    """Roads with a cluster that follows from their number, in place of a model's."""
    number = F.regexp_extract("road_name", "[0-9]+", 0).cast("int")
    return roads.withColumn("zone_cluster", (number % 4).cast("int"))
