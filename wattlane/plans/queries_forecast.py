"""Queries on forecasts and learners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.operators import autoregression, boosted, cleaning, explore, features, folds, forecast, metrics, seasonal, supervised
from wattlane.plans import flows, views
from wattlane.plans.catalog import METRIC_DIGITS, emit, oracle, query
from wattlane.plans.views import HOURLY, METRIC_SQL, ONE, SERIES
from wattlane.session import materialize, scratch_path
from wattlane.sources import sinks

_FILLED = f"""{HOURLY},
filled AS (SELECT series, ts, pos, coalesce(load, (SELECT avg(load) FROM hourly)) AS load FROM hourly),
ends_of AS (SELECT series, max(ts) AS last_ts, max(pos) AS last_pos, arg_max(load, pos) AS last_value FROM filled GROUP BY 1)"""


def _filled(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly load without gaps, written once because forecasts read it several times."""
    rows = views.hourly(spark, folder).select("series", "ts", "pos", "load")
    return materialize(cleaning.impute(rows, ["load"]), "hourly")


# ---------------------------------------------------------------- simple forecasts


@query(
    "MDL1 WIN12 WIN19",
    oracle(
        f"""WITH {_FILLED}
SELECT series, last_ts AS origin_ts, last_ts + to_hours(CAST(k AS BIGINT)) AS ts, k AS step, last_value AS prediction
FROM ends_of, generate_series(1, 24) AS g(k)""",
        "prediction", "step",
    ),
)
def naive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return emit(forecast.naive(_filled(spark, folder), SERIES, "load"), "series", "origin_ts", "ts", "step", "prediction")


@query(
    "MDL13",
    oracle(f"WITH {_FILLED} SELECT series, last_ts + INTERVAL 1 HOUR AS ts, last_value AS prediction FROM ends_of", "prediction"),
)
def next_step_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return emit(forecast.next_step(_filled(spark, folder), SERIES, "load"), "series", "ts", "prediction")


@query(
    "MDL8 WIN12 WIN19",
    oracle(
        f"""WITH {_FILLED},
base AS (SELECT f.series, avg(f.load) AS tail_mean FROM filled f JOIN ends_of e ON f.series = e.series WHERE f.pos > e.last_pos - 24 GROUP BY 1)
SELECT e.series, e.last_ts + to_hours(CAST(k AS BIGINT)) AS ts,
       tail_mean + (k - 1) * (2000.0::DOUBLE / 47) + 2000 * sin(2 * pi() * hour(e.last_ts + to_hours(CAST(k AS BIGINT))) / 24) AS prediction
FROM ends_of e JOIN base b ON e.series = b.series, generate_series(1, 48) AS g(k)""",
        "prediction",
    ),
)
def seasonal_ramp_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return emit(forecast.seasonal_ramp(_filled(spark, folder), SERIES, "load", 48), "series", "ts", "prediction")


@query(
    "MDL12 MDL1",
    oracle(
        f"""WITH {views.SUPPLIER}, sized AS (SELECT *, count(*) OVER (PARTITION BY series) AS c FROM supplier)
SELECT series, pos // 24 AS chunk, ts + to_hours(CAST(k AS BIGINT)) AS ts, k AS step, quantity AS prediction
FROM sized, generate_series(1, 3) AS g(k) WHERE pos % 24 = 23 AND (pos // 24) * 24 <= c - 24""",
        "prediction", "series chunk step",
    ),
)
def batch_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """A forecast after every chunk of 24 rows but the one that reaches the end."""
    rows = views.supplier_daily(spark, folder)
    made = forecast.batch_naive(rows, SERIES, "quantity", batch=24, horizon=3)
    return emit(made, "series", "chunk", "ts", "step", "prediction")


_MEMBERS = f"""{HOURLY},
long AS (
  SELECT series, ts, 'hour' AS model, lag(load, 1) OVER w AS prediction FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts)
  UNION ALL SELECT series, ts, 'day', lag(load, 24) OVER w FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts))"""


def _members(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_lags(views.hourly(spark, folder), SERIES, ["load"], [1, 24])
    return rows.withColumnsRenamed({"load_lag_1": "hour", "load_lag_24": "day"}).unpivot(
        ["series", "ts"], ["hour", "day"], "model", "prediction"
    )


@query(
    "MDL14",
    oracle(
        f"""WITH {_MEMBERS}
SELECT series, ts, sum(prediction * CASE model WHEN 'hour' THEN 3 ELSE 1 END) / sum(CASE model WHEN 'hour' THEN 3 ELSE 1 END) AS prediction
FROM long WHERE prediction IS NOT NULL GROUP BY 1, 2""",
        "prediction",
    ),
)
def weighted_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    members = _members(spark, folder).filter(F.col("prediction").isNotNull())
    return emit(forecast.ensemble(members, ["series", "ts"], {"hour": 3, "day": 1}))


@query(
    "MDL14 AGG31",
    oracle(
        f"""WITH {_MEMBERS}, e AS (SELECT series, ts, avg(prediction) AS p FROM long WHERE prediction IS NOT NULL GROUP BY 1, 2)
SELECT series, avg(p) AS mean_prediction, min(p) AS min_prediction, max(p) AS max_prediction FROM e GROUP BY 1""",
        "mean_prediction min_prediction max_prediction",
    ),
)
def ensemble_statistics(spark: SparkSession, folder: str) -> DataFrame:
    members = _members(spark, folder).filter(F.col("prediction").isNotNull())
    return emit(forecast.forecast_stats(forecast.ensemble(members, ["series", "ts"]), ["series"]))


@query(
    "MTH8",
    oracle(
        f"""WITH {_FILLED},
ramp AS (
  SELECT e.series, k AS step, last_value + 10 * k AS prediction FROM ends_of e, generate_series(1, 24) AS g(k)),
s AS (SELECT *, stddev_pop(prediction) OVER (PARTITION BY series) * 0.1::DOUBLE AS d FROM ramp)
SELECT series, step, prediction, prediction - 1.96::DOUBLE * d AS lower_bound, prediction + 1.96::DOUBLE * d AS upper_bound FROM s""",
        "prediction lower_bound upper_bound", "step",
    ),
)
def confidence_band(spark: SparkSession, folder: str) -> DataFrame:
    flat = forecast.naive(_filled(spark, folder), SERIES, "load")
    ramp = flat.select("series", "step", (F.col("prediction") + 10 * F.col("step")).alias("prediction"))
    return emit(forecast.with_band(ramp, ["series"]))


@query(
    "MDL17 WIN19 MTH8",
    oracle(
        f"""WITH {_FILLED}, req AS (SELECT event_id AS request_id, event_type AS series, user_id % 190 AS hours_ahead FROM events)
SELECT r.request_id, r.series, CASE WHEN hours_ahead BETWEEN 1 AND 168 THEN hours_ahead END AS steps,
  CASE WHEN hours_ahead BETWEEN 1 AND 168 THEN last_ts + to_hours(CAST(hours_ahead AS BIGINT)) END AS last_step,
  CASE WHEN hours_ahead BETWEEN 1 AND 168 THEN last_value END AS prediction,
  last_pos + 1 AS data_points_used, NOT hours_ahead BETWEEN 1 AND 168 AS rejected
FROM req r JOIN ends_of e ON r.series = e.series""",
        "prediction", "request_id steps data_points_used",
    ),
)
def scoring_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every event asks for a forecast of its type; horizons outside 1..168 hours are rejected."""
    requests = views.table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"), F.col("event_type").alias("series"),
        (F.col("user_id") % 190).cast("int").alias("hours_ahead"),
    )
    rows = forecast.score_requests(requests, _filled(spark, folder), SERIES, "load")
    per_request = rows.groupBy("request_id", "series").agg(
        F.count("step").alias("n"), F.max("ts").alias("last_step"),
        F.max(F.when(F.col("error").isNull(), F.col("prediction"))).alias("prediction"),
        F.max("data_points_used").alias("data_points_used"), F.bool_or(F.col("error").isNotNull()).alias("rejected"),
    )
    return emit(per_request.withColumn("steps", F.nullif(F.col("n"), F.lit(0))),
                "request_id", "series", "steps", "last_step", "prediction", "data_points_used", "rejected")


# ---------------------------------------------------------------- autoregression

_AR1 = """
z AS (SELECT series, ts, pos, load, load - lag(load, 1) OVER w AS z,
             lag(load, 1) OVER w - lag(load, 2) OVER w AS z1 FROM {src} WINDOW w AS (PARTITION BY series ORDER BY ts))"""


@query(
    "MDL6",
    oracle(
        f"""WITH {_FILLED}, {_AR1.format(src='filled')},
phi AS (SELECT series, sum(z * z1) / sum(z1 * z1) AS phi FROM z WHERE z1 IS NOT NULL GROUP BY 1)
SELECT e.series, k AS step, e.last_ts + to_hours(CAST(k AS BIGINT)) AS ts,
       z.load + z.z * phi * (1 - pow(phi, k)) / (1 - phi) AS prediction
FROM ends_of e JOIN z ON z.series = e.series AND z.pos = e.last_pos JOIN phi p ON p.series = e.series,
     generate_series(1, 24) AS g(k)""",
        "prediction", "step",
    ),
)
def autoregressive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    rows = autoregression.forecast(_filled(spark, folder), SERIES, "load", p=1, d=1, horizon=24)
    return emit(rows, "series", "step", "ts", "prediction")


def _level_sql(level: str) -> str:
    return oracle(
        f"""WITH {_FILLED}, means AS (SELECT series, avg(load) AS mean FROM filled GROUP BY 1)
SELECT e.series, k AS step, e.last_ts + to_hours(CAST(k AS BIGINT)) AS ts, {level} AS prediction
FROM ends_of e JOIN filled z ON z.series = e.series AND z.pos = e.last_pos JOIN filled b ON b.series = e.series AND b.pos = e.last_pos - 1
  JOIN means m ON m.series = e.series, generate_series(1, 24) AS g(k)""",
        "prediction", "step",
    )


@query("MDL6", _level_sql("z.load"))
def random_walk_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Order (0, 1, 0)."""
    rows = autoregression.forecast(_filled(spark, folder), SERIES, "load", p=0, d=1, horizon=24)
    return emit(rows, "series", "step", "ts", "prediction")


@query("MDL6", _level_sql("m.mean"))
def mean_level_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Order (0, 0, 0)."""
    rows = autoregression.forecast(_filled(spark, folder), SERIES, "load", p=0, d=0, horizon=24)
    return emit(rows, "series", "step", "ts", "prediction")


@query("MDL6", _level_sql("z.load + k * (z.load - b.load)"))
def last_slope_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Order (0, 2, 0)."""
    rows = autoregression.forecast(_filled(spark, folder), SERIES, "load", p=0, d=2, horizon=24)
    return emit(rows, "series", "step", "ts", "prediction")


@query("MDL6")
def autoregressive_forecast_high_order(spark: SparkSession, folder: str) -> DataFrame:
    rows = autoregression.forecast(_filled(spark, folder), SERIES, "load", p=24, d=1, horizon=48)
    return emit(rows, "series", "step", "ts", "prediction")


@query(
    "MDL6 WIN16",
    oracle(
        f"""WITH {_FILLED}, {_AR1.format(src='filled')},
sums AS (
  SELECT series, pos, load, z, sum(z * z1) OVER w AS zz1, sum(z1 * z1) OVER w AS z1z1 FROM z
  WINDOW w AS (PARTITION BY series ORDER BY pos)),
origins AS (
  SELECT s.series, (s.pos + 1 - 168) // 24 AS fold, s.pos, s.load, s.z, zz1 / z1z1 AS phi
  FROM sums s JOIN ends_of e ON s.series = e.series WHERE s.pos >= 167 AND (s.pos + 1 - 168) % 24 = 0 AND s.pos + 24 <= e.last_pos),
pairs AS (
  SELECT o.series, o.fold, f.load AS actual, o.load + o.z * phi * (1 - pow(phi, f.pos - o.pos)) / (1 - phi) AS prediction
  FROM origins o JOIN filled f ON f.series = o.series AND f.pos > o.pos AND f.pos <= o.pos + 24)
SELECT series, fold, {METRIC_SQL} FROM pairs GROUP BY 1, 2""",
        "mae mse rmse mape r2", "fold", digits=METRIC_DIGITS,
    ),
)
def autoregressive_walk_forward(spark: SparkSession, folder: str) -> DataFrame:
    """Expanding folds from accumulated cross-product sums."""
    rows = autoregression.walk_forward(_filled(spark, folder), SERIES, "load", 1, 1, 168, 24)
    return emit(metrics.fold_metrics(rows, ["series"], "prediction"), digits=METRIC_DIGITS)


@query(
    "MDL9",
    oracle(
        f"""WITH {_FILLED},
train AS (SELECT f.* FROM filled f JOIN ends_of e ON f.series = e.series WHERE f.pos <= e.last_pos - 24),
test AS (SELECT f.series, f.pos - e.last_pos + 24 AS step, f.load AS actual FROM filled f JOIN ends_of e ON f.series = e.series
         WHERE f.pos > e.last_pos - 24),
{_AR1.format(src='train')},
lagged AS (SELECT series, pos, load, lag(load, 1) OVER (PARTITION BY series ORDER BY ts) AS l1 FROM train),
last AS (SELECT series, arg_max(load, pos) AS y, arg_max(z, pos) AS z FROM z GROUP BY 1),
phi1 AS (SELECT series, sum(z * z1) / sum(z1 * z1) AS phi FROM z WHERE z1 IS NOT NULL GROUP BY 1),
phi0 AS (SELECT series, regr_slope(load, l1) AS phi, regr_intercept(load, l1) AS c FROM lagged WHERE l1 IS NOT NULL GROUP BY 1)
SELECT t.series, 1 AS p, 1 AS d, avg(abs(actual - (y + z * phi * (1 - pow(phi, step)) / (1 - phi)))) AS mae
FROM test t JOIN last l ON t.series = l.series JOIN phi1 p ON p.series = t.series GROUP BY 1
UNION ALL
SELECT t.series, 1, 0, avg(abs(actual - (c * (1 - pow(phi, step)) / (1 - phi) + pow(phi, step) * y))) AS mae
FROM test t JOIN last l ON t.series = l.series JOIN phi0 p ON p.series = t.series GROUP BY 1""",
        "mae", "p d",
    ),
)
def autoregressive_order_search(spark: SparkSession, folder: str) -> DataFrame:
    tried = autoregression.tune(_filled(spark, folder), SERIES, "load", ps=(1,), ds=(0, 1))
    return emit(tried, "series", "p", "d", "mae")


_LAGGED_PAIRS = [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)]
# Shocks of the differenced load from an autoregression of order 2, running over the rows up to each position.
_SHOCKS = f"""z AS (SELECT series, ts, pos, load, load - lag(load) OVER (PARTITION BY series ORDER BY pos) AS z0 FROM filled),
lagged AS (SELECT *, lag(z0, 1) OVER w AS z1, lag(z0, 2) OVER w AS z2, lag(z0, 3) OVER w AS z3 FROM z WINDOW w AS (PARTITION BY series ORDER BY pos)),
moments AS (
  SELECT series, ts, pos, load, z0, z1, z2,
         {", ".join(f"sum(CASE WHEN z3 IS NOT NULL THEN z{i} * z{j} END) OVER w AS m{i}{j}" for i, j in _LAGGED_PAIRS)}
  FROM lagged WINDOW w AS (PARTITION BY series ORDER BY pos)),
long_ar AS (
  SELECT *, (m01 * m22 - m02 * m12) / (m11 * m22 - m12 * m12) AS b1, (m11 * m02 - m12 * m01) / (m11 * m22 - m12 * m12) AS b2 FROM moments),
shocks AS (
  SELECT *, z0 - b1 * z1 - b2 * z2 AS e, m01 - b1 * m02 - b2 * m03 AS s0e, m11 - b1 * m12 - b2 * m13 AS s1e,
         m11 + b1 * b1 * m22 + b2 * b2 * m33 - 2 * b1 * m12 - 2 * b2 * m13 + 2 * b1 * b2 * m23 AS see FROM long_ar),
arma AS (
  SELECT *, (m01 * see - s0e * s1e) / (m11 * see - s1e * s1e) AS phi, (m11 * s0e - s1e * m01) / (m11 * see - s1e * s1e) AS theta,
         s0e / see AS theta_alone FROM shocks)"""


@query(
    "MDL6",
    oracle(
        f"""WITH {_FILLED}, {_SHOCKS}
SELECT e.series, k AS step, e.last_ts + to_hours(CAST(k AS BIGINT)) AS ts, a.load + a.theta_alone * a.e AS prediction
FROM ends_of e JOIN arma a ON a.series = e.series AND a.pos = e.last_pos, generate_series(1, 24) AS g(k)""",
        "prediction", "step", digits=4,
    ),
)
def moving_average_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Order (0, 1, 1)."""
    rows = autoregression.forecast(_filled(spark, folder), SERIES, "load", p=0, d=1, horizon=24, q=1, long=2)
    return emit(rows, "series", "step", "ts", "prediction", digits=4)


@query(
    "MDL6",
    oracle(
        f"""WITH {_FILLED}, {_SHOCKS}
SELECT e.series, k AS step, e.last_ts + to_hours(CAST(k AS BIGINT)) AS ts,
       a.load + (a.phi * a.z0 + a.theta * a.e) * (1 - pow(a.phi, k)) / (1 - a.phi) AS prediction
FROM ends_of e JOIN arma a ON a.series = e.series AND a.pos = e.last_pos, generate_series(1, 24) AS g(k)""",
        "prediction", "step", digits=4,
    ),
)
def arma_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Order (1, 1, 1)."""
    rows = autoregression.forecast(_filled(spark, folder), SERIES, "load", p=1, d=1, horizon=24, q=1, long=2)
    return emit(rows, "series", "step", "ts", "prediction", digits=4)


@query(
    "MDL6 WIN16",
    oracle(
        f"""WITH {_FILLED}, {_SHOCKS},
origins AS (
  SELECT a.*, (a.pos + 1 - 168) // 24 AS fold FROM arma a JOIN ends_of e ON a.series = e.series
  WHERE a.pos >= 167 AND (a.pos + 1 - 168) % 24 = 0 AND a.pos + 24 <= e.last_pos),
pairs AS (
  SELECT o.series, o.fold, f.load AS actual,
         o.load + (o.phi * o.z0 + o.theta * o.e) * (1 - pow(o.phi, f.pos - o.pos)) / (1 - o.phi) AS prediction
  FROM origins o JOIN filled f ON f.series = o.series AND f.pos > o.pos AND f.pos <= o.pos + 24)
SELECT series, fold, {METRIC_SQL} FROM pairs GROUP BY 1, 2""",
        "mae mse rmse mape r2", "fold", digits={**METRIC_DIGITS, "": 4},
    ),
)
def arma_walk_forward(spark: SparkSession, folder: str) -> DataFrame:
    """Expanding folds of order (1, 1, 1), each with shocks of its own training rows."""
    rows = autoregression.walk_forward(_filled(spark, folder), SERIES, "load", 1, 1, 168, 24, q=1, long=2)
    return emit(metrics.fold_metrics(rows, ["series"], "prediction"), digits={**METRIC_DIGITS, "": 4})


@query("MDL9 MDL6")
def arma_order_search(spark: SparkSession, folder: str) -> DataFrame:
    """All orders p 0 to 5, d 0 to 2, q 0 to 5, from one set of cross products per degree."""
    tried = autoregression.tune(_filled(spark, folder), SERIES, "load", ps=range(6), ds=range(3), qs=range(6))
    return emit(tried, "series", "p", "d", "q", "mae", digits=4)


@query("MDL11 AGG10 AGG30")
def autoregressive_validation(spark: SparkSession, folder: str) -> DataFrame:
    return emit(autoregression.validate(_filled(spark, folder), SERIES, "load", p=2, d=1))


@query("MDL10 PL12 TOP4")
def model_validation_flow(spark: SparkSession, folder: str) -> DataFrame:
    """Naive forecast and two autoregressions over all folds, composite scores and the winner."""
    orders = {"ar_1_1": (1, 1), "ar_2_0": (2, 0)}
    _, scores = flows.validate_models(_filled(spark, folder), SERIES, "load", 168, 24, orders)
    return emit(scores)


# ---------------------------------------------------------------- trend and seasonality


@query("MDL7")
def seasonal_regression_forecast(spark: SparkSession, folder: str) -> DataFrame:
    rows = seasonal.forecast(_filled(spark, folder), SERIES, "load", 24)
    return emit(rows, "series", "ts", "step", "prediction")


@query("MDL7")
def seasonal_regression_standardized(spark: SparkSession, folder: str) -> DataFrame:
    rows = seasonal.forecast(_filled(spark, folder), SERIES, "load", 24, standardize=True)
    return emit(rows, "series", "ts", "step", "prediction")


@query(
    "MDL7",
    oracle(
        f"""WITH {_FILLED},
h AS (SELECT f.series, f.ts, f.load, date_diff('hour', min(f.ts) OVER (PARTITION BY f.series), f.ts) AS t FROM filled f),
m AS (SELECT series, regr_slope(load, t) AS b, regr_intercept(load, t) AS a FROM h GROUP BY 1)
SELECT h.series, h.ts, a + b * t AS prediction FROM h JOIN m ON h.series = m.series""",
        "prediction", digits=3,
    ),
)
def linear_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The regression without seasonal terms is a straight line."""
    rows = _filled(spark, folder)
    model = seasonal.fit(rows, SERIES, "load", seasons=(), ridge=0.0)
    return emit(seasonal.predict(rows, SERIES, model, seasons=()), "series", "ts", "prediction", digits=3)


# ---------------------------------------------------------------- learners

def _learning_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Train and test rows with boosted-tree features, written once for the learner's passes."""
    rows, names, _ = supervised.supervised_split(_filled(spark, folder), SERIES, "load", 0.8, (1, 2, 24), (6, 24))
    return materialize(rows, "features"), names


@query("MDL2 PL7 PL13")
def boosted_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of boosted trees on training and test rows."""
    rows, names = _learning_rows(spark, folder)
    model = boosted.fit(rows.filter("split = 'train'"), names, boosted.boosted_a("load"))
    return emit(boosted.split_metrics(model, rows, "load"))


@query("MDL3")
def boosted_with_early_stop(spark: SparkSession, folder: str) -> DataFrame:
    """The later fifth of the training rows decides when to stop."""
    rows, names = _learning_rows(spark, folder)
    train = boosted.mark_later(rows.filter("split = 'train'"), SERIES)
    learner = boosted.boosted_b("load", validationIndicatorCol="_later")
    return emit(boosted.split_metrics(boosted.fit(train, names, learner), rows, "load"))


@query("MDL5 SNK5 TOP2")
def boosted_importances(spark: SparkSession, folder: str) -> DataFrame:
    """Importances of a boosted model, written as CSV and read back, top ten."""
    rows, names = _learning_rows(spark, folder)
    model = boosted.fit(rows.filter("split = 'train'"), names, boosted.boosted_a("load"))
    path = scratch_path(spark, "importances")
    sinks.write_importances(boosted.importances(model, names), path)
    table = spark.read.schema("feature string, importance double").csv(path, header=True)
    return emit(boosted.top_features(table, 10))


@query("MDL4 FLT14 TOP2")
def forest_importances(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_targets(views.hourly_weather(spark, folder), ONE, "total_load_actual", [1])
    names = supervised.feature_names(rows, "total_load_actual", exclude=["pos"])
    table = boosted.forest_importances(materialize(rows, "features"), "total_load_actual", names)
    return emit(boosted.top_features(table, 15))


@query("MDL9")
def boosted_search(spark: SparkSession, folder: str) -> DataFrame:
    rows, names = _learning_rows(spark, folder)
    grid = [{"maxDepth": d} for d in (2, 4)]
    return emit(boosted.search(rows.filter("split = 'train'"), SERIES, names, "load", boosted.boosted_a, grid))


@query("MDL9 WIN15")
def boosted_fold_search(spark: SparkSession, folder: str) -> DataFrame:
    """Random parameter sets on three time-ordered folds; the better half goes on after each."""
    rows, names = _learning_rows(spark, folder)
    ranges = {"maxIter": (20, 60), "maxDepth": (3, 5), "stepSize": ("log", 0.02, 0.3), "subsamplingRate": (0.6, 1.0)}
    tried = boosted.search_folds(
        rows.filter("split = 'train'"), SERIES, names, "load", boosted.boosted_b, boosted.random_grid(ranges, 4))
    return emit(tried)


@query("AGG23 MDL10 WIN15")
def learner_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    rows, names = _learning_rows(spark, folder)
    train = folds.assign_time_series_split(rows.filter("split = 'train'").withColumn("pos", F.col("pos") - 24), SERIES, 3)
    scored = boosted.cross_validate(train, names, "load", boosted.linear("load", regParam=0.1), 3)
    return emit(metrics.fold_summary(scored.withColumn("model", F.lit("linear"))), digits=4)


@query(
    "MDL10 SNK7 PL13",
    oracle(
        f"""WITH {_FILLED},
rows_ AS (SELECT series, ts, pos, load, lag(load, 1) OVER w AS l1, count(*) OVER (PARTITION BY series) AS c
          FROM filled WINDOW w AS (PARTITION BY series ORDER BY ts)),
sides AS (SELECT *, CASE WHEN pos < floor(c * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM rows_ WHERE l1 IS NOT NULL),
m AS (SELECT regr_slope(load, l1) AS b, regr_intercept(load, l1) AS a FROM sides WHERE split = 'train'),
pairs AS (SELECT split, load AS actual, a + b * l1 AS prediction FROM sides, m)
SELECT split, {METRIC_SQL} FROM pairs GROUP BY 1""",
        "mae mse rmse mape r2", digits={"": 4, "mse": 1},
    ),
)
def saved_linear_model(spark: SparkSession, folder: str) -> DataFrame:
    """A fitted model is saved, loaded and applied to both sides of the split."""
    rows = features.add_lags(_filled(spark, folder), SERIES, ["load"], [1])
    sides = folds.split_by_fraction(rows, SERIES).dropna(subset=["load_lag_1"])
    path = scratch_path(spark, "model")
    sinks.save_model(boosted.fit(sides.filter("split = 'train'"), ["load_lag_1"], boosted.linear("load")), path)
    return emit(boosted.split_metrics(sinks.load_model(path), sides, "load"), digits={"": 4, "mse": 1})


@query("PL10 MDL10 TOP3 SNK3")
def training_flow(spark: SparkSession, folder: str) -> DataFrame:
    """Prepared hours, boosted features, two learners, comparison and best model."""
    table = flows.train_and_compare(
        _filled(spark, folder), SERIES, "load",
        {"boosted_a": boosted.boosted_a("load"), "linear": boosted.linear("load", regParam=0.1)},
        lags=(1, 2, 24), windows=(6, 24),
    )
    return emit(table, digits=4)
