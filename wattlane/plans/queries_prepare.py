"""Queries on reading, cleaning, resampling and joining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattlane.functions import time as tm
from wattlane.operators import calendar, cleaning, folds, joins
from wattlane.operators.ordering import reposition
from wattlane.plans import flows, views
from wattlane.plans.catalog import emit, oracle, query
from wattlane.plans.views import ENERGY, HOURLY, HOURLY_WEATHER, ONE, RAW, RAW_EVENTS, SERIES, WEATHER
from wattlane.session import scratch_path
from wattlane.sources import documents, schemas, sinks, tabular

# ---------------------------------------------------------------- sources


def _events_as_csv(spark: SparkSession, folder: str, bad_every: int, sep: str = ",") -> str:
    """Events written as a CSV export with messy names, missing values and some broken numbers."""
    events = views.table(spark, folder, "events")
    rows = events.orderBy("event_id").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Time"),
        F.when(F.col("event_id") % bad_every == 7, "broken")
        .when(F.col("event_id") % 11 == 3, "NA")
        .otherwise(F.col("value").cast("string"))
        .alias("Total Load Actual"),
        F.col("user_id").cast("string").alias("Price Actual"),
        F.col("event_type").alias("not declared"),
    )
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).option("sep", sep).csv(path)
    return path


def _csv_sql(bad_every: int) -> str:
    return f"""
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time,
       CASE WHEN event_id % 11 = 3 THEN NULL ELSE value END AS total_load_actual,
       CAST(user_id AS DOUBLE) AS price_actual, CAST(NULL AS DOUBLE) AS generation_solar
FROM events WHERE event_id % {bad_every} <> 7"""


_CSV_COLUMNS = ("time", "total_load_actual", "price_actual", "generation_solar")


@query("SRC1 SRC4", oracle(_csv_sql(1999), "total_load_actual price_actual generation_solar"))
def csv_validated_load(spark: SparkSession, folder: str) -> DataFrame:
    path = _events_as_csv(spark, folder, 1999, sep=";")
    return emit(tabular.load_csv(spark, path, schemas.ENERGY).good, *_CSV_COLUMNS)


@query("SRC5", oracle(_csv_sql(20), "total_load_actual price_actual generation_solar"))
def csv_error_budget(spark: SparkSession, folder: str) -> DataFrame:
    """A twentieth of the rows is bad; all others come back."""
    path = _events_as_csv(spark, folder, 20)
    return emit(tabular.load_csv(spark, path, schemas.ENERGY, max_bad_share=0.1).good, *_CSV_COLUMNS)


@query("SRC5", oracle("""
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, CAST(user_id AS VARCHAR) AS price_actual
FROM events WHERE event_id % 20 = 7"""))
def csv_rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every bad row, as it was read."""
    path = _events_as_csv(spark, folder, 20)
    return emit(tabular.load_csv(spark, path, schemas.ENERGY).rejected, "time", "price_actual")


@query(
    "SRC4 SRC7",
    oracle(
        """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S+00:00') AS dt_iso, event_type AS city_name, value AS temp,
       800 + event_id % 3 AS weather_id
FROM events WHERE event_id % 1500 <> 9""",
        "temp", "weather_id",
    ),
)
def weather_csv_load(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers written as 800.0 are integers, 800.5 is not."""
    half = F.when(F.col("event_id") % 1500 == 9, ".5").otherwise(".0")
    rows = views.table(spark, folder, "events").orderBy("event_id").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+00:00'").alias("dt_iso"),
        F.col("event_type").alias("city_name"),
        F.col("value").cast("string").alias("temp"),
        F.concat((800 + F.col("event_id") % 3).cast("string"), half).alias("weather_id"),
    )
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).csv(path)
    return emit(tabular.load_weather(spark, path), "dt_iso", "city_name", "temp", "weather_id")


_RECORD = T.StructType(
    [T.StructField("time", T.StringType()), T.StructField("series", T.StringType()), T.StructField("load", T.DoubleType())]
)
_RECORD_SQL = "SELECT ts AS time, event_type AS series, value AS load FROM events"


@query("SRC8", oracle(_RECORD_SQL, "load", times="time"))
def json_records_load(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events")
    rows = events.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"),
                         F.col("event_type").alias("series"), F.col("value").alias("load"))
    path = scratch_path(spark, "json")
    rows.write.json(path)
    read = documents.load_records(spark, path, _RECORD, lines=True)
    return emit(read.withColumn("time", tm.parse_time(F.col("time"))))


@query("SRC9", oracle(_RECORD_SQL, "load", times="time"))
def json_envelope_load(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per hour; every other one is wrapped in ``{"data": [...]}``."""
    events = views.table(spark, folder, "events")
    record = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"),
                      F.col("event_type").alias("series"), F.col("value").alias("load"))
    # An hour of one type and user group bounds the payload.
    group = (F.unix_timestamp(F.date_trunc("hour", "ts")) / 3600).cast("long")
    lists = events.groupBy(group.alias("g"), "event_type", (F.col("user_id") % 16).alias("u")).agg(
        F.to_json(F.collect_list(record)).alias("value")
    )
    payload = F.when(F.col("g") % 2 == 0, F.col("value")).otherwise(
        F.concat(F.lit('{"data":'), F.col("value"), F.lit("}"))
    )
    return emit(documents.open_envelopes(lists.select(payload.alias("value")), _RECORD))


@query("SRC10", oracle("SELECT event_type, count(*) AS n, avg(value) AS mean FROM events GROUP BY 1", "mean", "n"))
def sql_query_load(spark: SparkSession, folder: str) -> DataFrame:
    views.table(spark, folder, "events").createOrReplaceTempView("wattlane_events")
    return emit(tabular.load_query(
        spark, "SELECT event_type, count(*) AS n, avg(value) AS mean FROM wattlane_events GROUP BY event_type"
    ))


@query("SRC11 FLT12", oracle("SELECT ts AS time, value FROM events WHERE event_id % 13 <> 5", "value", times="time"))
def csv_time_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose time does not parse are dropped."""
    events = views.table(spark, folder, "events")
    text = F.when(F.col("event_id") % 13 == 5, "not a time").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    path = scratch_path(spark, "csv")
    events.select(text.alias("time"), "value").write.option("header", True).csv(path)
    loaded = tabular.load_with_time(spark, path).filter(F.col("time").isNotNull())
    return emit(cleaning.coerce_numeric(loaded, ["value"]))


@query(
    "SRC13",
    oracle("""SELECT event_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-05' AND value IS NOT NULL""", "value", "event_id"),
)
def reference_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A time range of the events as a monitoring reference."""
    events = views.table(spark, folder, "events")
    return emit(tabular.reference_sample(events, "ts", "value", "2024-01-02", "2024-01-05"), "event_id", "value")


@query("SRC15", oracle("SELECT event_id, value AS prediction FROM events", "prediction", "event_id"))
def predictions_load(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events")
    path = scratch_path(spark, "csv")
    sinks.write_csv(events.select("event_id", F.col("value").alias("prediction")), path)
    loaded = tabular.load_predictions(spark, path)
    return emit(loaded.withColumn("event_id", F.col("event_id").cast("long")), "event_id", "prediction")


@query(
    "SNK1 WIN14",
    oracle(
        f"""WITH {RAW_EVENTS}, facts AS (SELECT count(*) AS c FROM raw)
SELECT event_id, ts, value, CASE WHEN pos < floor(c * CAST(0.9 AS DOUBLE)) THEN 'reference' ELSE 'current' END AS batch
FROM raw, facts""",
        "value", "event_id",
    ),
)
def batch_files(spark: SparkSession, folder: str) -> DataFrame:
    """Reference and current batches written to files and read back, with their time column."""
    split = folds.reference_and_current(views.raw_events(spark, folder), RAW)
    path = scratch_path(spark, "batches")
    sinks.write_batches(split, path)
    return emit(spark.read.parquet(path), "event_id", "ts", "value", "batch")


# ---------------------------------------------------------------- filters


@query(
    "FLT1",
    oracle(
        """
SELECT 'event_id' AS field, true AS present, true AS type_ok, count(*) FILTER (WHERE event_id IS NULL) AS nulls,
       count(*) AS rows FROM events
UNION ALL SELECT 'value', true, true, count(*) FILTER (WHERE value IS NULL), count(*) FROM events
UNION ALL SELECT 'user_id', true, false, count(*) FILTER (WHERE user_id IS NULL), count(*) FROM events
UNION ALL SELECT 'weight', false, false, NULL, count(*) FROM events""",
        ints="nulls rows",
    ),
)
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    expected = {"event_id": "bigint", "value": "double", "user_id": "string", "weight": "double"}
    report = cleaning.contract_report(views.table(spark, folder, "events"), expected)
    return emit(report.withColumn("type_ok", F.coalesce("type_ok", F.lit(False))))


_BOUNDS = """
bounds AS (
  SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi
  FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))"""


@query(
    "FLT3",
    oracle(f"WITH {_BOUNDS} SELECT event_id, value FROM events, bounds WHERE value BETWEEN lo AND hi", "value", "event_id"),
)
def outlier_filter(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.drop_outliers(views.table(spark, folder, "events"), ["value"]), "event_id", "value")


@query(
    "FLT4",
    oracle(f"WITH {_BOUNDS} SELECT event_id, value < lo OR value > hi AS is_outlier FROM events, bounds", ints="event_id"),
)
def outlier_flags(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.flag_outliers(views.table(spark, folder, "events"), "value"), "event_id", "is_outlier")


_SEQUENTIAL = """
b1 AS (
  SELECT quantile_cont({a}, 0.25) AS q1, quantile_cont({a}, 0.75) AS q3 FROM {src}),
s1 AS (
  SELECT t.* FROM {src} t, b1
  WHERE NOT coalesce({a} < q1 - 1.5::DOUBLE * (q3 - q1) OR {a} > q3 + 1.5::DOUBLE * (q3 - q1), false)),
b2 AS (
  SELECT quantile_cont({b}, 0.25) AS q1, quantile_cont({b}, 0.75) AS q3 FROM s1),
s2 AS (
  SELECT s1.* FROM s1, b2
  WHERE NOT coalesce({b} < q1 - 1.5::DOUBLE * (q3 - q1) OR {b} > q3 + 1.5::DOUBLE * (q3 - q1), false))"""


@query(
    "FLT5",
    oracle(
        f"""WITH {_SEQUENTIAL.format(a='l_extendedprice', b='l_quantity', src='lineitem')}
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM s2""",
        "l_extendedprice l_quantity", "l_orderkey l_linenumber",
    ),
)
def outlier_filter_in_turn(spark: SparkSession, folder: str) -> DataFrame:
    """The second column's bounds come from the rows that survive the first."""
    rows = cleaning.drop_outliers(views.table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])
    return emit(rows, "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


@query(
    "FLT5",
    oracle("""
WITH a AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem),
x AS (SELECT l.* FROM lineitem l, a WHERE l_extendedprice IS NULL OR abs(l_extendedprice - m) <= 1.5 * s),
b AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS s FROM x)
SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM x, b
WHERE l_quantity IS NULL OR abs(l_quantity - m) <= 1.5 * s GROUP BY 1""", "quantity", "n"),
)
def outlier_filter_zscore(spark: SparkSession, folder: str) -> DataFrame:
    """Outliers by distance from the mean, column after column."""
    rows = cleaning.drop_outliers(
        views.table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"], method="zscore", factor=1.5)
    return emit(rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")))


@query("FLT7", oracle("SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2031-01-01'", ints="n"))
def empty_date_range(spark: SparkSession, folder: str) -> DataFrame:
    """A range without rows gives no row."""
    rows = calendar.slice_dates(views.table(spark, folder, "events"), RAW, "2031-01-01", "2031-01-02")
    return emit(rows.agg(F.count("*").alias("n")))


@query(
    "FLT6",
    oracle(
        f"""WITH {_BOUNDS}
SELECT count(*) FILTER (WHERE value < lo OR value > hi) AS outliers,
       count(*) FILTER (WHERE value < lo OR value > hi) * 100.0 / count(*) AS outlier_pct
FROM events, bounds""",
        "outlier_pct", "outliers",
    ),
)
def outlier_report(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.outlier_report(views.table(spark, folder, "events"), "value"))


@query(
    "FLT7",
    oracle(
        """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'""",
        "value", "event_id",
    ),
)
def date_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = calendar.slice_dates(views.table(spark, folder, "events"), RAW, "2024-01-05", "2024-01-12")
    return emit(rows, "event_id", "ts", "value")


@query(
    "FLT8 FLT9",
    oracle(
        f"""WITH {HOURLY}, lagged AS (
  SELECT series, ts, load, price, lag(load, 1) OVER (PARTITION BY series ORDER BY ts) AS load_lag_1 FROM hourly)
SELECT * FROM lagged WHERE load IS NOT NULL AND price IS NOT NULL AND load_lag_1 IS NOT NULL""",
        "load price load_lag_1",
    ),
)
def complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    from wattlane.operators.features import add_lags

    rows = add_lags(views.hourly(spark, folder), SERIES, ["load"], [1])
    kept = cleaning.drop_incomplete(rows, ["load", "price", "load_lag_1"])
    return emit(kept, "series", "ts", "load", "price", "load_lag_1")


@query(
    "FLT9",
    oracle(
        """SELECT event_id, CAST(split_part(ref, '-', 2) AS DOUBLE) AS number
FROM (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN event_type ELSE 'x-' || CAST(user_id AS VARCHAR) END AS ref FROM events)
WHERE ref LIKE 'x-%'""",
        "number", "event_id",
    ),
)
def numeric_coercion(spark: SparkSession, folder: str) -> DataFrame:
    """Text that is no number becomes NULL and is dropped."""
    ref = F.when(F.col("user_id") % 3 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    rows = views.table(spark, folder, "events").select("event_id", ref.alias("number"))
    return emit(cleaning.drop_incomplete(cleaning.coerce_numeric(rows, ["number"]), ["number"]))


# ---------------------------------------------------------------- imputation and scaling

_FILLED = "SELECT series, ts, coalesce(load, fill) AS load FROM hourly, "


@query("AGG1 PL1", oracle(f"WITH {HOURLY} {_FILLED} (SELECT avg(load) AS fill FROM hourly)", "load"))
def impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.impute(views.hourly(spark, folder), ["load"], "mean"), "series", "ts", "load")


@query("AGG1 PL1", oracle(f"WITH {HOURLY} {_FILLED} (SELECT median(load) AS fill FROM hourly)", "load"))
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.impute(views.hourly(spark, folder), ["load"], "median"), "series", "ts", "load")


@query(
    "AGG1 PL1",
    oracle(
        f"""WITH {HOURLY}, counts AS (
  SELECT round(load) AS v, count(*) AS c FROM hourly WHERE load IS NOT NULL GROUP BY 1),
top AS (SELECT v AS fill FROM counts ORDER BY c DESC, v LIMIT 1)
SELECT series, ts, coalesce(round(load), fill) AS load FROM hourly, top""",
        "load",
    ),
)
def impute_most_frequent(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.hourly(spark, folder).withColumn("load", F.round("load"))
    return emit(cleaning.impute(rows, ["load"], "most_frequent"), "series", "ts", "load")


@query("AGG1 PL1", oracle(f"WITH {HOURLY} SELECT series, ts, coalesce(load, 0) AS load FROM hourly", "load"))
def impute_constant(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.impute(views.hourly(spark, folder), ["load"], "constant"), "series", "ts", "load")


@query(
    "WIN9 PL1",
    oracle(
        f"""WITH {HOURLY}
SELECT series, ts, coalesce(
    last_value(load IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(load IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    (SELECT avg(load) FROM hourly), 0) AS load
FROM hourly""",
        "load",
    ),
)
def impute_fill_both_ways(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.impute(views.hourly(spark, folder), ["load"], "ffill_bfill", panel=SERIES)
    return emit(rows, "series", "ts", "load")


@query(
    "MTH1 JN8",
    oracle(
        f"""WITH {HOURLY}, p AS (SELECT avg(load) AS m, stddev_pop(load) AS s FROM hourly)
SELECT series, ts, (load - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS load FROM hourly, p""",
        "load",
    ),
)
def scale_standard(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.normalize(views.hourly(spark, folder), ["load"])[0], "series", "ts", "load")


@query(
    "MTH2 JN8",
    oracle(
        f"""WITH {HOURLY}, p AS (SELECT min(load) AS lo, max(load) - min(load) AS r FROM hourly)
SELECT series, ts, (load - lo) / CASE WHEN r = 0 THEN 1 ELSE r END AS load FROM hourly, p""",
        "load",
    ),
)
def scale_minmax(spark: SparkSession, folder: str) -> DataFrame:
    return emit(cleaning.normalize(views.hourly(spark, folder), ["load"], "minmax")[0], "series", "ts", "load")


@query("MTH7 JN8", oracle(f"WITH {HOURLY} SELECT series, ts, load FROM hourly", "load"))
def scale_and_restore(spark: SparkSession, folder: str) -> DataFrame:
    """Per-series scaling and its inverse give the input back."""
    rows = views.hourly(spark, folder)
    params = cleaning.fit_scaler(rows, ["load"], by=["series"])
    scaled = cleaning.scale(rows, params, ["load"], by=["series"])
    return emit(cleaning.unscale(scaled, params, ["load"], by=["series"]), "series", "ts", "load")


# ---------------------------------------------------------------- time grids


@query("AGG2", oracle(f"WITH {HOURLY} SELECT series, ts, pos, price AS mean, coalesce(load, 0) AS sum, n FROM hourly", "mean sum", "pos n"))
def resample_hourly(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events").withColumnRenamed("event_type", "series")
    grid = calendar.resample(events, SERIES, "H", {"mean": ("value", "mean"), "sum": ("value", "sum"), "n": ("value", "count")})
    return emit(grid, "series", "ts", "pos", "mean", "sum", "n")


@query(
    "AGG2",
    oracle(
        f"""WITH {HOURLY}, ends_of AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts, arg_min(value, ts) AS first, arg_max(value, ts) AS last
  FROM events GROUP BY 1, 2)
SELECT h.series, h.ts, e.first, e.last FROM hourly h LEFT JOIN ends_of e ON h.series = e.series AND h.ts = e.ts""",
        "first last",
    ),
)
def resample_first_last(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events").withColumnRenamed("event_type", "series")
    grid = calendar.resample(events, SERIES, "H", {"first": ("value", "first"), "last": ("value", "last")})
    return emit(grid, "series", "ts", "first", "last")


@query("AGG2 WIN21", oracle(f"WITH {views.DAILY} SELECT series, ts, pos, load FROM daily", "load", "pos", digits=2))
def daily_grid(spark: SparkSession, folder: str) -> DataFrame:
    return emit(views.daily_orders(spark, folder), "series", "ts", "pos", "load", digits=2)


@query("WIN21", oracle(f"WITH {HOURLY} SELECT series, ts, pos, load FROM hourly", "load", "pos"))
def regular_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that exist are put on the full hourly grid."""
    events = views.table(spark, folder, "events")
    cells = events.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("ts")).agg(
        F.sum("value").alias("load")
    )
    return emit(calendar.regularize(cells, SERIES, "H", ["load"]), "series", "ts", "pos", "load")


@query(
    "WIN20",
    oracle(
        """SELECT event_type AS series, date_trunc('hour', ts) AS ts, min(event_id) AS event_id, arg_min(value, event_id) AS value
FROM events GROUP BY 1, 2""",
        "value", "event_id",
    ),
)
def first_per_time(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.table(spark, folder, "events").select(
        F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("ts"), "event_id", "value"
    )
    return emit(calendar.keep_first_per_time(rows, views.Panel(tie=("event_id",))))


@query("TOP1 FLT10", oracle(f"WITH {RAW_EVENTS} SELECT event_id, pos, value FROM raw WHERE pos >= 168", "value", "event_id pos"))
def positions_of_events(spark: SparkSession, folder: str) -> DataFrame:
    """Row numbers in time order over the whole table, without the first week of rows."""
    return emit(views.raw_events(spark, folder).filter(F.col("pos") >= 168), "event_id", "pos", "value")


@query(
    "FLT10 FLT3",
    oracle(
        f"""WITH {HOURLY}, kept AS (SELECT * FROM hourly WHERE load >= (SELECT avg(load) FROM hourly))
SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos FROM kept""",
        ints="pos",
    ),
)
def positions_after_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.hourly(spark, folder)
    kept = rows.filter(F.col("load") >= rows.agg(F.avg("load")).scalar())
    return emit(reposition(kept, SERIES), "series", "ts", "pos")


@query("TOP5", oracle(f"WITH {RAW_EVENTS}, c AS (SELECT count(*) AS n FROM raw) SELECT event_id, value FROM raw, c WHERE pos >= n - 1000", "value", "event_id"))
def last_rows(spark: SparkSession, folder: str) -> DataFrame:
    return emit(folds.tail(views.raw_events(spark, folder), RAW, 1000), "event_id", "value")


# ---------------------------------------------------------------- time functions


@query(
    "DT1 DT3",
    oracle("SELECT event_id, ts AS parsed, date_trunc('second', ts) AS parsed_with_format FROM events", ints="event_id"),
)
def time_parsing(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events")
    rows = events.select(
        "event_id",
        tm.without_zone(tm.parse_time(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))).alias("parsed"),
        tm.without_zone(tm.parse_time(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), "dd/MM/yyyy HH:mm:ss")).alias(
            "parsed_with_format"
        ),
    )
    return emit(rows)


@query(
    "DT2 JN3",
    oracle(
        f"""WITH {ENERGY}, {WEATHER}
SELECT e.ts AS time, w.city, e.total_load_actual, w.temp FROM energy e JOIN weather w ON e.ts = w.ts""",
        "total_load_actual temp",
    ),
)
def join_on_utc(spark: SparkSession, folder: str) -> DataFrame:
    """Text times with different offsets meet at the same instant."""
    left = views.energy(spark, folder).select(
        F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")).alias("time"),
        "total_load_actual",
    )
    right = views.weather(spark, folder).select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("dt_iso"), "city", "temp"
    )
    return emit(joins.merge_on_utc(left, right), "time", "city", "total_load_actual", "temp")


# ---------------------------------------------------------------- joins


@query(
    "JN1",
    oracle(
        f"""WITH {ENERGY}, {WEATHER}
SELECT e.ts AS time, e.price_actual, w.city, w.humidity FROM energy e JOIN weather w ON e.ts = w.ts""",
        "price_actual humidity",
    ),
)
def join_on_time(spark: SparkSession, folder: str) -> DataFrame:
    left = views.energy(spark, folder).select(F.col("ts").alias("time"), "price_actual")
    right = views.weather(spark, folder).select(F.col("ts").alias("dt_iso"), "city", "humidity")
    return emit(joins.merge_on_time(left, right))


@query(
    "JN4 AGG3",
    oracle(
        f"WITH {HOURLY_WEATHER} SELECT ts, total_load_actual, temp, wind_speed, humidity FROM merged",
        "total_load_actual temp wind_speed humidity", digits=9,
    ),
)
def enrich_with_hourly_weather(spark: SparkSession, folder: str) -> DataFrame:
    return emit(views.hourly_weather(spark, folder), "ts", "total_load_actual", "temp", "wind_speed", "humidity", digits=9)


@query(
    "JN5",
    oracle(
        f"""WITH {HOURLY}
SELECT a.series, a.ts, a.load AS actual, b.load AS prediction
FROM hourly a JOIN hourly b ON a.series = b.series AND a.ts = b.ts + INTERVAL 24 HOUR""",
        "actual prediction",
    ),
)
def align_with_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.hourly(spark, folder)
    actuals = rows.select("series", "ts", F.col("load").alias("actual"))
    ahead = rows.select("series", (F.col("ts") + F.expr("INTERVAL 24 HOUR")).alias("ts"), F.col("load").alias("prediction"))
    return emit(joins.align_forecasts(actuals, ahead, ["series", "ts"]))


# ---------------------------------------------------------------- preparation flows

_PREPARED = f"""{HOURLY},
filled AS (
  SELECT series, ts, coalesce(load, (SELECT avg(load) FROM hourly)) AS load,
         coalesce(price, (SELECT avg(price) FROM hourly)) AS price FROM hourly)"""


@query(
    "PL2",
    oracle(
        f"""WITH {_PREPARED},
b AS (SELECT quantile_cont(load, 0.25) AS q1, quantile_cont(load, 0.75) AS q3 FROM filled),
kept AS (
  SELECT f.* FROM filled f, b
  WHERE load BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1))
SELECT series, ts, load, price, lag(load, 1) OVER w AS load_lag_1, lag(load, 24) OVER w AS load_lag_24,
       lag(load, 168) OVER w AS load_lag_168
FROM kept WINDOW w AS (PARTITION BY series ORDER BY ts)""",
        "load price load_lag_1 load_lag_24 load_lag_168",
    ),
)
def prepare_energy(spark: SparkSession, folder: str) -> DataFrame:
    """Fill, drop outliers, lag over the surviving rows."""
    rows = views.hourly(spark, folder).select("series", "ts", "pos", "load", "price")
    made = flows.prepare_energy(rows, SERIES, "load")
    return emit(made, "series", "ts", "load", "price", "load_lag_1", "load_lag_24", "load_lag_168")


@query(
    "PL3",
    oracle(
        f"WITH {WEATHER} SELECT ts, city, temp, wind_speed, humidity FROM weather", "temp wind_speed humidity",
    ),
)
def prepare_weather(spark: SparkSession, folder: str) -> DataFrame:
    made = flows.prepare_weather(views.weather(spark, folder), ONE)
    return emit(made, "ts", "city", "temp", "wind_speed", "humidity")


@query(
    "PL4",
    oracle(
        f"""WITH {_PREPARED}, {_SEQUENTIAL.format(a='load', b='price', src='filled')},
p AS (SELECT avg(load) AS m, stddev_pop(load) AS s FROM s2)
SELECT series, ts, (load - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS load, price FROM s2, p""",
        "load price",
    ),
)
def prepare_merged(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.hourly(spark, folder).select("series", "ts", "pos", "load", "price")
    made = flows.prepare(rows, SERIES, ["load", "price"], normalize=True, normalize_columns=["load"])
    return emit(made, "series", "ts", "load", "price")


_PREPARED_ENERGY = f"""{ENERGY}, {WEATHER},
efill AS (
  SELECT ts, coalesce(total_load_actual, (SELECT avg(total_load_actual) FROM energy)) AS total_load_actual,
         coalesce(price_actual, (SELECT avg(price_actual) FROM energy)) AS price_actual FROM energy),
eb AS (SELECT quantile_cont(total_load_actual, 0.25) AS q1, quantile_cont(total_load_actual, 0.75) AS q3 FROM efill),
ekept AS (
  SELECT f.* FROM efill f, eb
  WHERE total_load_actual BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)),
elag AS (
  SELECT *, lag(total_load_actual, 24) OVER (ORDER BY ts) AS total_load_actual_lag_24 FROM ekept)"""


@query(
    "PL5 JN4",
    oracle(
        f"""WITH {_PREPARED_ENERGY},
hours AS (SELECT ts, avg(temp) AS temp, avg(humidity) AS humidity, avg(wind_speed) AS wind_speed FROM weather GROUP BY 1)
SELECT e.ts, e.total_load_actual, e.price_actual, e.total_load_actual_lag_24, h.temp, h.humidity, h.wind_speed
FROM elag e JOIN hours h ON e.ts = h.ts""",
        "total_load_actual price_actual total_load_actual_lag_24 temp humidity wind_speed", digits=9,
    ),
)
def prepare_energy_and_weather(spark: SparkSession, folder: str) -> DataFrame:
    made = flows.prepare_both(views.energy(spark, folder), views.weather(spark, folder))
    return emit(made, "ts", "total_load_actual", "price_actual", "total_load_actual_lag_24", "temp", "humidity", "wind_speed",
                digits=9)


@query(
    "PL5 JN2",
    oracle(
        f"""WITH {_PREPARED_ENERGY}
SELECT e.ts, w.city, e.total_load_actual, e.total_load_actual_lag_24, w.temp FROM elag e JOIN weather w ON e.ts = w.ts""",
        "total_load_actual total_load_actual_lag_24 temp", digits=9,
    ),
)
def prepare_with_city_fanout(spark: SparkSession, folder: str) -> DataFrame:
    made = flows.prepare_both(views.energy(spark, folder), views.weather(spark, folder), fanout=True)
    return emit(made, "ts", "city", "total_load_actual", "total_load_actual_lag_24", "temp", digits=9)
