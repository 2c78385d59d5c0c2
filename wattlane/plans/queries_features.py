"""Queries on feature columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.functions import categories, energy as energy_fn, time as tm
from wattlane.operators import cleaning, features, folds, supervised
from wattlane.operators.chunks import over_chunks, rolling_of
from wattlane.plans import views
from wattlane.plans.catalog import emit, oracle, query
from wattlane.plans.views import ENERGY, HOURLY, HOURLY_WEATHER, ONE, SERIES, SUPPLIER, WEATHER

_PER_SERIES = "PARTITION BY series ORDER BY ts"


def _rolling_sql(column: str, n: int, func: str, name: str, window: str, shift: int = 0) -> str:
    agg = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}[func]
    frame = f"ROWS BETWEEN {n - 1 + shift} PRECEDING AND " + (f"{shift} PRECEDING" if shift else "CURRENT ROW")
    return (
        f"CASE WHEN count({column}) OVER ({window} {frame}) = {n} "
        f"THEN {agg}({column}) OVER ({window} {frame}) END AS {name}"
    )


# ---------------------------------------------------------------- lags, leads, rolling statistics


@query(
    "WIN1",
    oracle(
        f"""WITH {HOURLY}
SELECT series, ts, load, lag(load, 1) OVER w AS load_lag_1, lag(load, 24) OVER w AS load_lag_24,
       lag(load, 168) OVER w AS load_lag_168
FROM hourly WINDOW w AS ({_PER_SERIES})""",
        "load load_lag_1 load_lag_24 load_lag_168",
    ),
)
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_lags(views.hourly(spark, folder), SERIES, ["load"], [1, 24, 168])
    return emit(rows, "series", "ts", "load", "load_lag_1", "load_lag_24", "load_lag_168")


@query(
    "WIN2 FLT10",
    oracle(
        f"""WITH {HOURLY}, lagged AS (
  SELECT series, ts, pos, lag(load, 1) OVER w AS load_lag_1h, lag(load, 24) OVER w AS load_lag_24h,
         lag(price, 1) OVER w AS price_lag_1h, lag(price, 24) OVER w AS price_lag_24h
  FROM hourly WINDOW w AS ({_PER_SERIES}))
SELECT * EXCLUDE (pos) FROM lagged WHERE pos >= 24""",
        "load_lag_1h load_lag_24h price_lag_1h price_lag_24h",
    ),
)
def lag_features_trimmed(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that do not exist are skipped; the warm-up rows are dropped."""
    rows = features.add_lags_and_trim(views.hourly(spark, folder), SERIES, ["load", "price", "absent"], [1, 24])
    return emit(rows, "series", "ts", "load_lag_1h", "load_lag_24h", "price_lag_1h", "price_lag_24h")


@query(
    "WIN2",
    oracle(
        f"""WITH {HOURLY}
SELECT a.series, a.ts, b.load AS load_lag_24h FROM hourly a
LEFT JOIN hourly b ON a.series = b.series AND a.ts = b.ts + INTERVAL 24 HOUR""",
        "load_lag_24h",
    ),
)
def lag_by_clock(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_time_lags(views.hourly(spark, folder), SERIES, ["load"], [24])
    return emit(rows, "series", "ts", "load_lag_24h")


@query(
    "WIN3",
    oracle(
        f"""WITH {SUPPLIER}
SELECT series, ts, {', '.join(f'lag(load, {k}) OVER w AS lag_{k}' for k in features.BOOSTED_LAGS)}
FROM supplier WINDOW w AS ({_PER_SERIES})""",
        " ".join(f"lag_{k}" for k in features.BOOSTED_LAGS),
    ),
)
def boosted_lags(spark: SparkSession, folder: str) -> DataFrame:
    new = supervised.boosted_window_columns("load", windows=())
    rows = over_chunks(views.supplier_daily(spark, folder), SERIES, new, lookback=168)
    return emit(rows, "series", "ts", *new)


_ROLL = [(n, f) for n in (6, 24) for f in features.ROLLING]


@query(
    "WIN4",
    oracle(
        f"""WITH {SUPPLIER}
SELECT series, ts, {', '.join(_rolling_sql('quantity', n, f, f'quantity_rolling_{n}h_{f}', _PER_SERIES) for n, f in _ROLL)}
FROM supplier""",
        " ".join(f"quantity_rolling_{n}h_{f}" for n, f in _ROLL),
    ),
)
def rolling_statistics(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_rolling(views.supplier_daily(spark, folder), SERIES, ["quantity"], [6, 24])
    return emit(rows, "series", "ts", *[f"quantity_rolling_{n}h_{f}" for n, f in _ROLL])


@query(
    "WIN4",
    oracle(
        f"WITH {HOURLY} SELECT series, ts, {_rolling_sql('load', 6, 'mean', 'load_rolling_6h_mean', _PER_SERIES)} FROM hourly",
        "load_rolling_6h_mean",
    ),
)
def rolling_mean_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """NULL until six known rows fill the frame."""
    rows = features.add_rolling(views.hourly(spark, folder), SERIES, ["load"], [6], ["mean"])
    return emit(rows, "series", "ts", "load_rolling_6h_mean")


_SHIFTED = [(n, f) for n in features.BOOSTED_WINDOWS for f in features.ROLLING]


@query(
    "WIN5",
    oracle(
        f"""WITH {HOURLY}
SELECT series, ts, {', '.join(_rolling_sql('load', n, f, f'rolling_{f}_{n}', _PER_SERIES, 1) for n, f in _SHIFTED)}
FROM hourly""",
        " ".join(f"rolling_{f}_{n}" for n, f in _SHIFTED),
    ),
)
def rolling_without_leakage(spark: SparkSession, folder: str) -> DataFrame:
    new = supervised.boosted_window_columns("load", lags=())
    rows = over_chunks(views.hourly(spark, folder), SERIES, new, lookback=max(features.BOOSTED_WINDOWS))
    return emit(rows, "series", "ts", *[f"rolling_{f}_{n}" for n, f in _SHIFTED])


@query(
    "WIN6",
    oracle(
        f"WITH {ENERGY} SELECT ts, {_rolling_sql('price_actual', 24, 'std', 'price_volatility', 'ORDER BY ts')} FROM energy",
        "price_volatility",
    ),
)
def price_volatility(spark: SparkSession, folder: str) -> DataFrame:
    new = {"price_volatility": rolling_of("price_actual", 24, "std")}
    return emit(over_chunks(views.energy(spark, folder), ONE, new, lookback=23), "ts", "price_volatility")


@query("WIN7", oracle(f"WITH {HOURLY} SELECT series, ts, load - lag(load, 1) OVER ({_PER_SERIES}) AS change FROM hourly", "change"))
def first_difference(spark: SparkSession, folder: str) -> DataFrame:
    new = {"change": lambda w: F.col("load") - F.lag("load", 1).over(w)}
    return emit(over_chunks(views.hourly(spark, folder), SERIES, new, lookback=1), "series", "ts", "change")


@query(
    "WIN8",
    oracle(
        f"""WITH {HOURLY}
SELECT series, ts, {', '.join(f'lead(load, {h}) OVER w AS load_target_{h}h' for h in features.HORIZONS)}
FROM hourly WINDOW w AS ({_PER_SERIES})""",
        " ".join(f"load_target_{h}h" for h in features.HORIZONS),
    ),
)
def lead_targets(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_targets(views.hourly(spark, folder), SERIES, "load", features.HORIZONS)
    return emit(rows, "series", "ts", *[f"load_target_{h}h" for h in features.HORIZONS])


@query(
    "WIN10",
    oracle(
        f"""WITH {HOURLY}, past AS (
  SELECT series, ts, load, list(load) OVER ({_PER_SERIES} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS s FROM hourly)
SELECT series, ts, load, s[1] AS oldest, s[24] AS newest, list_sum(s) AS total FROM past WHERE len(s) = 24""",
        "load oldest newest total",
    ),
)
def sequence_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = supervised.add_sequences(views.hourly(spark, folder), SERIES, "load", 24)
    total = F.aggregate(F.filter("sequence", lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + x)
    some = F.exists("sequence", lambda x: x.isNotNull())
    return emit(rows.select("series", "ts", "load", F.get("sequence", F.lit(0)).alias("oldest"),
                            F.get("sequence", F.lit(23)).alias("newest"), F.when(some, total).alias("total")))


# ---------------------------------------------------------------- calendar, weather and energy columns


@query(
    "DT4 DT5 DT6",
    oracle(
        """SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, month(ts) AS month, quarter(ts) AS quarter,
  dayofyear(ts) AS day_of_year, weekofyear(ts) AS week_of_year,
  sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
  sin(2 * pi() * month(ts) / 12) AS month_sin, cos(2 * pi() * month(ts) / 12) AS month_cos,
  sin(2 * pi() * (isodow(ts) - 1) / 7) AS day_of_week_sin, cos(2 * pi() * (isodow(ts) - 1) / 7) AS day_of_week_cos,
  CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(ts) BETWEEN 9 AND 17 AND isodow(ts) <= 5 THEN 1 ELSE 0 END AS is_business_hours
FROM events""",
        "hour_sin hour_cos month_sin month_cos day_of_week_sin day_of_week_cos",
        "event_id hour day_of_week month quarter day_of_year week_of_year is_weekend is_business_hours",
    ),
)
def calendar_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_seasonal(views.table(spark, folder, "events").select("event_id", "ts"), ONE)
    return emit(rows.drop("ts"))


@query(
    "DT7",
    oracle(
        """SELECT l_orderkey, l_linenumber, l_shipdate, day(l_shipdate) AS day_of_month,
  isodow(l_shipdate) - 1 AS day_of_week, sin(2 * pi() * (isodow(l_shipdate) - 1) / 7) AS dow_sin,
  cos(2 * pi() * month(l_shipdate) / 12) AS month_cos, CASE WHEN isodow(l_shipdate) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM lineitem""",
        "dow_sin month_cos", "l_orderkey l_linenumber day_of_month day_of_week is_weekend",
    ),
)
def boosted_calendar_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    made = rows.withColumns(tm.boosted_time_columns(F.col("l_shipdate")))
    return emit(made, "l_orderkey", "l_linenumber", "l_shipdate", "day_of_month", "day_of_week", "dow_sin",
                "month_cos", "is_weekend")


@query(
    "CAT1 CAT2 CAT3",
    oracle(
        f"""WITH {WEATHER}
SELECT ts, city,
  CASE WHEN temp IS NULL THEN NULL WHEN temp <= 0 THEN 'freezing' WHEN temp <= 10 THEN 'cold' WHEN temp <= 20 THEN 'cool'
       WHEN temp <= 30 THEN 'warm' ELSE 'hot' END AS temp_category,
  CASE WHEN w <= 0 THEN NULL WHEN w <= 5 THEN 'calm' WHEN w <= 10 THEN 'light' WHEN w <= 15 THEN 'moderate'
       WHEN w <= 20 THEN 'strong' WHEN w > 20 THEN 'storm' END AS wind_category,
  CASE WHEN humidity <= 0 THEN NULL WHEN humidity <= 30 THEN 'dry' WHEN humidity <= 60 THEN 'comfortable'
       WHEN humidity <= 80 THEN 'humid' WHEN humidity <= 100 THEN 'very_humid' END AS humidity_category
FROM (SELECT *, wind_speed - 1.5 AS w FROM weather)""",
    ),
)
def weather_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Wind is shifted so that 0, which falls in no bin, occurs."""
    rows = views.weather(spark, folder)
    return emit(rows.select(
        "ts", "city",
        categories.temperature_category(F.col("temp")).alias("temp_category"),
        categories.wind_category(F.col("wind_speed") - 1.5).alias("wind_category"),
        categories.humidity_category(F.col("humidity")).alias("humidity_category"),
    ))


_TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "CAT4 SET1",
    oracle(
        f"""WITH {WEATHER}, thinned AS (
  SELECT ts, city, CASE WHEN humidity > 60 THEN NULL ELSE weather_main END AS weather_main FROM weather)
SELECT ts, city, {', '.join(f"coalesce(weather_main = '{t}', false) AS weather_{t}" for t in _TYPES)} FROM thinned"""
    ),
)
def one_hot_weather(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.weather(spark, folder).withColumn(
        "weather_main", F.when(F.col("humidity") > 60, None).otherwise(F.col("weather_main"))
    )
    # A type that no row has still gets its flag.
    values = sorted({*_TYPES, *features.weather_values(rows)})
    flags = categories.one_hot("weather_main", values)
    return emit(rows.withColumns(flags), "ts", "city", *[f"weather_{t}" for t in _TYPES])


_MIX_SQL = """coalesce(generation_solar, 0) + coalesce(generation_wind_onshore, 0)
    + coalesce(generation_hydro_water_reservoir, 0) AS total_renewable,
  coalesce(generation_fossil_gas, 0) + coalesce(generation_fossil_hard_coal, 0) AS total_fossil"""


@query(
    "MTH3 MTH4 MTH5",
    oracle(
        f"""WITH {ENERGY}, mix AS (SELECT *, {_MIX_SQL} FROM energy)
SELECT ts, total_load_actual / nullif(total_load_forecast, 0) AS load_factor,
       total_load_actual - total_load_forecast AS load_error, total_renewable, total_fossil,
       total_renewable / nullif(total_renewable + total_fossil, 0) AS renewable_ratio
FROM mix""",
        "load_factor load_error total_renewable total_fossil renewable_ratio",
    ),
)
def energy_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.energy(spark, folder)
    new = {**energy_fn.load_columns(rows.columns), **energy_fn.mix_columns(rows.columns)}
    return emit(rows.withColumns(new), "ts", *new)


@query(
    "MTH6",
    oracle(
        f"""WITH {HOURLY_WEATHER}
SELECT ts, temp * sin(2 * pi() * hour(ts) / 24) AS temp_hour_interaction,
       wind_speed * generation_wind_onshore AS wind_generation_interaction,
       total_load_actual * temp AS load_temp_interaction
FROM merged""",
        "temp_hour_interaction wind_generation_interaction load_temp_interaction", digits=7,
    ),
)
def interaction_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_seasonal(views.hourly_weather(spark, folder), ONE)
    made = features.add_interactions(rows)
    return emit(made, "ts", "temp_hour_interaction", "wind_generation_interaction", "load_temp_interaction", digits=7)


# ---------------------------------------------------------------- whole feature frames

_FULL = (
    "total_load_actual_lag_72h", "temp_lag_1h", "generation_solar_lag_24h", "wind_speed_rolling_6h_max",
    "total_load_actual_rolling_48h_mean", "total_load_actual_rolling_24h_std", "temp_rolling_12h_min", "temp_change",
    "price_volatility", "load_error", "renewable_ratio", "load_temp_interaction", "total_load_actual_target_1h",
    "total_load_actual_target_24h",
)


@query(
    "PL6",
    oracle(
        f"""WITH {HOURLY_WEATHER},
lagged AS (
  SELECT *, lag(total_load_actual, 72) OVER w AS total_load_actual_lag_72h, lag(temp, 1) OVER w AS temp_lag_1h,
         lag(generation_solar, 24) OVER w AS generation_solar_lag_24h, {_MIX_SQL}
  FROM merged WINDOW w AS (ORDER BY ts)),
trimmed AS (SELECT * FROM lagged WHERE pos >= 72)
SELECT ts, total_load_actual_lag_72h, temp_lag_1h, generation_solar_lag_24h,
  {_rolling_sql('wind_speed', 6, 'max', 'wind_speed_rolling_6h_max', 'ORDER BY ts')},
  {_rolling_sql('total_load_actual', 48, 'mean', 'total_load_actual_rolling_48h_mean', 'ORDER BY ts')},
  {_rolling_sql('total_load_actual', 24, 'std', 'total_load_actual_rolling_24h_std', 'ORDER BY ts')},
  {_rolling_sql('temp', 12, 'min', 'temp_rolling_12h_min', 'ORDER BY ts')},
  temp - lag(temp, 1) OVER (ORDER BY ts) AS temp_change,
  {_rolling_sql('price_actual', 24, 'std', 'price_volatility', 'ORDER BY ts')},
  total_load_actual - total_load_forecast AS load_error,
  total_renewable / nullif(total_renewable + total_fossil, 0) AS renewable_ratio,
  total_load_actual * temp AS load_temp_interaction,
  lead(total_load_actual, 1) OVER (ORDER BY ts) AS total_load_actual_target_1h,
  lead(total_load_actual, 24) OVER (ORDER BY ts) AS total_load_actual_target_24h
FROM trimmed""",
        " ".join(_FULL), digits=7,
    ),
)
def full_feature_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Lags drop their warm-up first; rolling statistics warm up again after it."""
    made = features.full_features(views.hourly_weather(spark, folder), ONE)
    return emit(made, "ts", *_FULL, digits=7)


_GBM = ("lag_1", "lag_48", "rolling_mean_24", "rolling_std_6", "hour_sin", "day_of_month", "is_weekend")
_GBM_SQL = f"""
made AS (
  SELECT series, split, ts, load, lag(load, 1) OVER w AS lag_1, lag(load, 48) OVER w AS lag_48,
    {_rolling_sql('load', 24, 'mean', 'rolling_mean_24', 'PARTITION BY series, split ORDER BY ts', 1)},
    {_rolling_sql('load', 6, 'std', 'rolling_std_6', 'PARTITION BY series, split ORDER BY ts', 1)},
    sin(2 * pi() * hour(ts) / 24) AS hour_sin, day(ts) AS day_of_month,
    CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM sides WINDOW w AS (PARTITION BY series, split ORDER BY ts)),
fitted AS (
  SELECT {', '.join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS {c}_s" for c in _GBM)}
  FROM made WHERE split = 'train')"""


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly load with gaps filled by the mean, so that long windows are complete."""
    rows = views.hourly(spark, folder).select("series", "ts", "pos", "load")
    return cleaning.impute(rows, ["load"])


@query(
    "PL7 WIN13",
    oracle(
        f"""WITH {HOURLY},
filled AS (SELECT series, ts, pos, coalesce(load, (SELECT avg(load) FROM hourly)) AS load FROM hourly),
sides AS (
  SELECT *, CASE WHEN pos >= floor(count(*) OVER (PARTITION BY series) * CAST(0.8 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
  FROM filled), {_GBM_SQL}
SELECT series, split, ts, load, {', '.join(f"({c} - {c}_m) / {c}_s AS {c}" for c in _GBM)}
FROM made, fitted WHERE {' AND '.join(f"{c} IS NOT NULL" for c in ('lag_48', 'rolling_mean_24', 'rolling_std_6'))}""",
        "load " + " ".join(_GBM),
    ),
)
def boosted_train_and_test(spark: SparkSession, folder: str) -> DataFrame:
    """Features per side, scaler from training rows, incomplete rows dropped."""
    made, _, _ = supervised.supervised_split(_dense(spark, folder), SERIES, "load", 0.8, (1, 48), (6, 24))
    return emit(made, "series", "split", "ts", "load", *_GBM)


@query(
    "PL8",
    oracle(
        f"""WITH {HOURLY},
sides AS (SELECT series, ts, pos, coalesce(load, (SELECT avg(load) FROM hourly)) AS load, 'train' AS split FROM hourly),
{_GBM_SQL}
SELECT series, ts, load, {', '.join(f"({c} - {c}_m) / {c}_s AS {c}" for c in _GBM)} FROM made, fitted""",
        "load " + " ".join(_GBM),
    ),
)
def boosted_frame(spark: SparkSession, folder: str) -> DataFrame:
    made, _, _ = supervised.supervised_frame(_dense(spark, folder), SERIES, "load", (1, 48), (6, 24))
    return emit(made, "series", "ts", "load", *_GBM)


@query(
    "PL9 WIN10",
    oracle(
        f"""WITH {HOURLY},
filled AS (SELECT series, ts, pos, coalesce(load, (SELECT avg(load) FROM hourly)) AS load FROM hourly),
sides AS (
  SELECT *, CASE WHEN pos >= floor(count(*) OVER (PARTITION BY series) * CAST(0.8 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
  FROM filled),
p AS (SELECT series, avg(load) AS m, stddev_pop(load) AS s FROM sides WHERE split = 'train' GROUP BY 1),
scaled AS (SELECT d.series, d.split, d.ts, (d.load - p.m) / p.s AS load FROM sides d JOIN p ON d.series = p.series),
past AS (
  SELECT series, split, ts, load,
         list(load) OVER (PARTITION BY series, split ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS s FROM scaled)
SELECT series, split, ts, load, s[1] AS oldest, s[24] AS newest FROM past WHERE len(s) = 24""",
        "load oldest newest",
    ),
)
def sequence_train_and_test(spark: SparkSession, folder: str) -> DataFrame:
    made, _ = supervised.sequence_split(_dense(spark, folder), SERIES, "load")
    return emit(made.select("series", "split", "ts", "load", F.get("sequence", F.lit(0)).alias("oldest"),
                            F.get("sequence", F.lit(23)).alias("newest")))


@query("FLT14", oracle("SELECT count(*) AS rows, 0 AS target_columns FROM events", ints="rows target_columns"))
def no_future_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Feature lists never name a future value of the target."""
    events = views.table(spark, folder, "events")
    rows = events.withColumn("value_target_1h", F.col("value")).withColumn("value_target_24h", F.col("value"))
    names = supervised.feature_names(rows, "value")
    leaks = [c for c in names if "_target_" in c]
    return emit(rows.select(*names).agg(F.count(F.lit(1)).alias("rows"), F.lit(len(leaks)).alias("target_columns")))
