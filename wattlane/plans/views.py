"""Time-series views of the given tables, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.operators.calendar import resample
from wattlane.operators.chunks import lag_of, over_chunks
from wattlane.operators.ordering import with_positions
from wattlane.panel import Panel

SERIES = Panel(keys=("series",))
ONE = Panel(keys=())
RAW = Panel(keys=(), tie=("event_id",))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table with its zone-free times read as UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly load per event type on a full grid: series, ts, pos, load (NULL in gaps), n, price."""
    events = table(spark, folder, "events").withColumnRenamed("event_type", "series")
    return resample(
        events, SERIES, "H", {"load": ("value", "total"), "n": ("value", "count"), "price": ("value", "mean")}
    )


HOURLY = """
hourly_cells AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts, sum(value) AS load, count(*) AS n,
         avg(value) AS price
  FROM events GROUP BY 1, 2),
hourly_ends AS (SELECT series, min(ts) AS lo, max(ts) AS hi FROM hourly_cells GROUP BY 1),
hourly_grid AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM hourly_ends),
hourly AS (
  SELECT g.series, g.ts, c.load, coalesce(c.n, 0) AS n, c.price,
         row_number() OVER (PARTITION BY g.series ORDER BY g.ts) - 1 AS pos
  FROM hourly_grid g LEFT JOIN hourly_cells c ON g.series = c.series AND g.ts = c.ts)"""

# Which event types stand for which generation column.
GENERATION = {
    "generation_solar": "view",
    "generation_wind_onshore": "click",
    "generation_hydro_water_reservoir": "signup",
    "generation_fossil_gas": "purchase",
    "generation_fossil_hard_coal": "error",
}


def energy(spark: SparkSession, folder: str) -> DataFrame:
    """One hourly series: load, five generation columns, price and a day-ago forecast."""
    events = table(spark, folder, "events").select(
        "ts", "value", *[F.when(F.col("event_type") == v, F.col("value")).alias(k) for k, v in GENERATION.items()]
    )
    grid = resample(
        events, ONE, "H",
        {"total_load_actual": ("value", "total"), **{k: (k, "total") for k in GENERATION},
         "price_actual": ("value", "mean")},
    )
    return over_chunks(grid, ONE, {"total_load_forecast": lag_of("total_load_actual", 24)}, lookback=24)


ENERGY = f"""
energy_cells AS (
  SELECT date_trunc('hour', ts) AS ts, sum(value) AS total_load_actual,
         {', '.join(f"sum(value) FILTER (WHERE event_type = '{v}') AS {k}" for k, v in GENERATION.items())},
         avg(value) AS price_actual
  FROM events GROUP BY 1),
energy_grid AS (
  SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM energy_cells),
energy AS (
  SELECT g.ts, c.* EXCLUDE (ts), row_number() OVER (ORDER BY g.ts) - 1 AS pos,
         lag(c.total_load_actual, 24) OVER (ORDER BY g.ts) AS total_load_forecast
  FROM energy_grid g LEFT JOIN energy_cells c ON g.ts = c.ts)"""


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather of five cities: ts, city, temp, wind_speed, humidity, weather_main."""
    events = table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return events.groupBy(
        F.date_trunc("hour", "ts").alias("ts"), F.concat(F.lit("c"), F.col("user_id") % 5).alias("city")
    ).agg(
        (3 * F.sqrt(F.avg("value")) - 5).alias("temp"),
        (1.5 * F.count("value")).alias("wind_speed"),
        (F.sum(k) % 120).cast("double").alias("humidity"),
        F.min("event_type").alias("weather_main"),
    )


WEATHER = r"""
weather AS (
  SELECT date_trunc('hour', ts) AS ts, 'c' || CAST(user_id % 5 AS VARCHAR) AS city,
         3 * sqrt(avg(value)) - 5 AS temp, CAST(1.5 AS DOUBLE) * count(value) AS wind_speed,
         CAST(sum(CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT)) % 120 AS DOUBLE) AS humidity,
         min(event_type) AS weather_main
  FROM events GROUP BY 1, 2)"""


def hourly_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Energy with the hourly mean weather, one row per hour."""
    from wattlane.operators.joins import enrich_hourly

    return enrich_hourly(energy(spark, folder), weather(spark, folder), "ts", ["temp", "wind_speed", "humidity"])


HOURLY_WEATHER = f"""{ENERGY}, {WEATHER},
weather_hours AS (
  SELECT ts, avg(temp) AS temp, avg(wind_speed) AS wind_speed, avg(humidity) AS humidity
  FROM weather GROUP BY 1),
merged AS (
  SELECT e.*, w.temp, w.wind_speed, w.humidity FROM energy e LEFT JOIN weather_hours w ON e.ts = w.ts)"""


def supplier_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily quantity per supplier on a full grid (NULL on days without shipment)."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("series"), F.col("l_shipdate").alias("ts"), "l_quantity"
    )
    return resample(
        lines, SERIES, "D", {"load": ("l_quantity", "total"), "quantity": ("l_quantity", "sum")}
    )


SUPPLIER = """
supplier_cells AS (
  SELECT l_suppkey AS series, l_shipdate AS ts, sum(l_quantity) AS load
  FROM lineitem GROUP BY 1, 2),
supplier_ends AS (SELECT series, min(ts) AS lo, max(ts) AS hi FROM supplier_cells GROUP BY 1),
supplier_grid AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM supplier_ends),
supplier AS (
  SELECT g.series, g.ts, c.load, coalesce(c.load, 0) AS quantity,
         row_number() OVER (PARTITION BY g.series ORDER BY g.ts) - 1 AS pos
  FROM supplier_grid g LEFT JOIN supplier_cells c ON g.series = c.series AND g.ts = c.ts)"""


def daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Daily order value per priority on a full grid."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts"), "o_totalprice"
    )
    return resample(orders, SERIES, "D", {"load": ("o_totalprice", "total")})


DAILY = """
daily_cells AS (
  SELECT o_orderpriority AS series, o_orderdate AS ts, sum(o_totalprice) AS load FROM orders GROUP BY 1, 2),
daily_ends AS (SELECT series, min(ts) AS lo, max(ts) AS hi FROM daily_cells GROUP BY 1),
daily_grid AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM daily_ends),
daily AS (
  SELECT g.series, g.ts, c.load, row_number() OVER (PARTITION BY g.series ORDER BY g.ts) - 1 AS pos
  FROM daily_grid g LEFT JOIN daily_cells c ON g.series = c.series AND g.ts = c.ts)"""


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Single events in time order with their position."""
    return with_positions(
        table(spark, folder, "events").select("ts", "event_id", "user_id", "event_type", "value"), RAW
    )


RAW_EVENTS = """
raw AS (
  SELECT ts, event_id, user_id, event_type, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos
  FROM events)"""


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Actual load and day-ago forecast per series, where both are known."""
    rows = over_chunks(hourly(spark, folder), SERIES, {"prediction": lag_of("load", 24)}, lookback=24)
    known = rows.filter(F.col("load").isNotNull() & F.col("prediction").isNotNull())
    return known.select("series", "ts", "pos", F.col("load").alias("actual"), "prediction")


PAIRS = f"""{HOURLY},
paired AS (
  SELECT series, ts, pos, load AS actual, lag(load, 24) OVER (PARTITION BY series ORDER BY ts) AS prediction
  FROM hourly),
pairs AS (SELECT * FROM paired WHERE actual IS NOT NULL AND prediction IS NOT NULL)"""


def supplier_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Actual and week-ago quantity per supplier and day."""
    rows = over_chunks(supplier_daily(spark, folder), SERIES, {"prediction": lag_of("load", 7)}, lookback=7)
    known = rows.filter(F.col("load").isNotNull() & F.col("prediction").isNotNull())
    return known.select("series", "ts", "pos", F.col("load").alias("actual"), "prediction")


SUPPLIER_PAIRS = f"""{SUPPLIER},
paired AS (
  SELECT series, ts, pos, load AS actual, lag(load, 7) OVER (PARTITION BY series ORDER BY ts) AS prediction
  FROM supplier),
pairs AS (SELECT * FROM paired WHERE actual IS NOT NULL AND prediction IS NOT NULL)"""

METRIC_SQL = """avg(abs(actual - prediction)) AS mae,
  avg((actual - prediction) * (actual - prediction)) AS mse,
  sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse,
  CASE WHEN count(*) FILTER (WHERE actual = 0) = 0
       THEN avg(abs((actual - prediction) / nullif(actual, 0))) * 100 END AS mape,
  CASE WHEN count(actual - prediction) < 2 THEN NULL
       WHEN max(actual) = min(actual)
         THEN CASE WHEN sum((actual - prediction) * (actual - prediction)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((actual - prediction) * (actual - prediction))
                / nullif(var_pop(actual) * count(actual), 0) END AS r2"""
