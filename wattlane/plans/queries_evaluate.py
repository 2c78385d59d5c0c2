"""Queries on splits, validation folds, metrics and model choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.operators import calendar, cleaning, features, folds, kpi, metrics
from wattlane.plans import flows, views
from wattlane.plans.catalog import METRIC_DIGITS, emit, oracle, query
from wattlane.plans.views import DAILY, HOURLY, METRIC_SQL, PAIRS, SERIES, SUPPLIER_PAIRS
from wattlane.session import materialize, scratch_path
from wattlane.sources import documents, sinks

_M = "mae mse rmse mape r2"


def _naive_folds_sql(src: str, value: str, window: int, horizon: int) -> str:
    """Fold rows of ``src`` (series, ts, pos) with the value before the fold as forecast."""
    return f"""
ends_of AS (SELECT series, count(*) AS c FROM {src} GROUP BY 1),
fold_rows AS (
  SELECT d.series, (d.pos - {window}) // {horizon} AS fold, d.ts, d.pos, d.{value} AS actual, o.{value} AS prediction
  FROM {src} d
  JOIN ends_of e ON d.series = e.series
  LEFT JOIN {src} o ON o.series = d.series AND o.pos = {window} + ((d.pos - {window}) // {horizon}) * {horizon} - 1
  WHERE d.pos >= {window} AND {window} + ((d.pos - {window}) // {horizon}) * {horizon} <= e.c - {horizon})"""


# ---------------------------------------------------------------- flagship


@query(
    "AGG2 PL1 WIN1 WIN4 WIN16 MDL1 AGG10",
    oracle(
        f"""WITH {HOURLY},
filled AS (SELECT series, ts, pos, coalesce(load, (SELECT avg(load) FROM hourly)) AS load FROM hourly),
{_naive_folds_sql('filled', 'load', 168, 24)},
warm AS (
  SELECT f.series, avg(f.load) AS mean_load,
         avg(f.lag_24) AS mean_lag_24, max(f.roll) AS max_rolling_24
  FROM (SELECT series, load, lag(load, 24) OVER w AS lag_24,
               CASE WHEN pos >= 23 THEN avg(load) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END AS roll
        FROM filled WINDOW w AS (PARTITION BY series ORDER BY ts)) f
  GROUP BY 1),
scores AS (SELECT series, count(DISTINCT fold) AS folds, {METRIC_SQL} FROM fold_rows GROUP BY 1)
SELECT s.*, w.mean_load, w.mean_lag_24, w.max_rolling_24 FROM scores s JOIN warm w ON s.series = w.series""",
        f"{_M} mean_load mean_lag_24 max_rolling_24", "folds", digits=METRIC_DIGITS,
    ),
)
def forecast_scorecard(spark: SparkSession, folder: str) -> DataFrame:
    """Events to hourly series, gaps filled, lag and rolling features, naive walk-forward scores."""
    rows = views.hourly(spark, folder).select("series", "ts", "pos", "load")
    # The hourly table is small next to the events and is read three times from here.
    filled = materialize(cleaning.impute(rows, ["load"]), "hourly")
    made = features.add_rolling(features.add_lags(filled, SERIES, ["load"], [24]), SERIES, ["load"], [24], ["mean"])
    warm = made.groupBy("series").agg(
        F.avg("load").alias("mean_load"), F.avg("load_lag_24").alias("mean_lag_24"),
        F.max("load_rolling_24h_mean").alias("max_rolling_24"),
    )
    tested = folds.walk_forward(filled, SERIES, "load", 168, 24)
    scores = tested.groupBy("series").agg(
        (F.max("fold") + 1).alias("folds"), *metrics.metric_columns("actual", "naive")
    )
    return emit(scores.join(warm, "series"), digits=METRIC_DIGITS)


# ---------------------------------------------------------------- splits


_SPLIT_SQL = "floor(count(*) OVER (PARTITION BY series) * CAST(0.8 AS DOUBLE))"


@query(
    "WIN13",
    oracle(
        f"""WITH {HOURLY}
SELECT series, ts, CASE WHEN pos >= {_SPLIT_SQL} THEN 'test' ELSE 'train' END AS split FROM hourly""",
    ),
)
def split_by_time(spark: SparkSession, folder: str) -> DataFrame:
    return emit(folds.split_by_fraction(views.hourly(spark, folder), SERIES), "series", "ts", "split")


@query(
    "WIN13",
    oracle(
        f"""WITH {HOURLY}
SELECT series, split, count(*) AS rows, min(ts) AS first_ts FROM (
  SELECT series, ts, CASE WHEN pos < floor({_SPLIT_SQL} * CAST(0.8 AS DOUBLE)) THEN 'train'
                          WHEN pos < {_SPLIT_SQL} THEN 'validation' ELSE 'test' END AS split FROM hourly)
GROUP BY 1, 2""",
        ints="rows",
    ),
)
def split_nested(spark: SparkSession, folder: str) -> DataFrame:
    rows = folds.split_train_validation_test(views.hourly(spark, folder), SERIES)
    return emit(rows.groupBy("series", "split").agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts")))


@query(
    "WIN15",
    oracle(
        f"""WITH {HOURLY}, sized AS (SELECT *, count(*) OVER (PARTITION BY series) AS c FROM hourly)
SELECT series, ts, CASE WHEN pos >= c - 5 * (c // 6) THEN (pos - (c - 5 * (c // 6))) // (c // 6) END AS fold FROM sized""",
        ints="fold",
    ),
)
def time_series_split(spark: SparkSession, folder: str) -> DataFrame:
    return emit(folds.assign_time_series_split(views.hourly(spark, folder), SERIES, 5), "series", "ts", "fold")


@query(
    "WIN15",
    oracle(
        f"""WITH {views.SUPPLIER}, c AS (SELECT series, count(*) AS n FROM supplier GROUP BY 1)
SELECT series, k AS fold, n - (3 - k) * (n // 4) AS test_start, n // 4 AS test_size FROM c, (VALUES (0), (1), (2)) AS t(k)""",
        ints="series fold test_start test_size",
    ),
)
def time_series_split_table(spark: SparkSession, folder: str) -> DataFrame:
    return emit(folds.time_series_splits(views.supplier_daily(spark, folder), SERIES, 3))


@query(
    "WIN16 MDL1 WIN12",
    oracle(
        f"""WITH {HOURLY}, {_naive_folds_sql('hourly', 'load', 168, 24)}
SELECT series, fold, ts, actual, prediction AS naive FROM fold_rows""",
        "actual naive", "fold",
    ),
)
def walk_forward_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = folds.walk_forward(views.hourly(spark, folder), SERIES, "load", 168, 24)
    return emit(rows, "series", "fold", "ts", "actual", "naive")


@query(
    "WIN16 AGG10",
    oracle(
        f"""WITH {DAILY}, {_naive_folds_sql('daily', 'load', 720, 24)}
SELECT series, fold, {METRIC_SQL} FROM fold_rows GROUP BY 1, 2""",
        _M, "fold", digits={**METRIC_DIGITS, "": 6},
    ),
)
def walk_forward_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = folds.walk_forward(views.daily_orders(spark, folder), SERIES, "load", 720, 24)
    return emit(metrics.fold_metrics(rows, ["series"]), digits={**METRIC_DIGITS, "": 6})


@query(
    "WIN17 AGG10",
    oracle(
        f"""WITH {HOURLY}, {_naive_folds_sql('hourly', 'load', 168, 24)}
SELECT series, fold, {METRIC_SQL} FROM fold_rows GROUP BY 1, 2""",
        _M, "fold", digits=METRIC_DIGITS,
    ),
)
def expanding_window_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = folds.expanding_window(views.hourly(spark, folder), SERIES, "load")
    return emit(metrics.fold_metrics(rows, ["series"]), digits=METRIC_DIGITS)


def _tail_sql(src: str, value: str = "load") -> str:
    return f"""
tail_size AS (SELECT series, count(*) AS c FROM {src} GROUP BY 1),
tail_rows AS (
  SELECT d.series, (d.pos - (e.c - 36)) // 12 AS fold, d.ts, d.{value} AS actual, o.{value} AS prediction
  FROM {src} d JOIN tail_size e ON d.series = e.series
  LEFT JOIN {src} o ON o.series = d.series AND o.pos = e.c - 36 + ((d.pos - (e.c - 36)) // 12) * 12 - 1
  WHERE d.pos >= e.c - 36 AND e.c - 36 + ((d.pos - (e.c - 36)) // 12) * 12 >= 50)"""


@query(
    "WIN18 MDL1",
    oracle(
        f"""WITH {HOURLY}, {_tail_sql('hourly')}
SELECT series, fold, ts, actual, prediction AS naive FROM tail_rows""",
        "actual naive", "fold",
    ),
)
def tail_fold_rows(spark: SparkSession, folder: str) -> DataFrame:
    return emit(folds.tail_folds(views.hourly(spark, folder), SERIES, "load"), "series", "fold", "ts", "actual", "naive")


@query(
    "WIN18 AGG10",
    oracle(
        f"""WITH {DAILY},
recent AS (
  SELECT series, ts, load, CAST(pos - (c - floor(c * CAST(0.3 AS DOUBLE))) AS BIGINT) AS pos
  FROM (SELECT *, count(*) OVER (PARTITION BY series) AS c FROM daily)
  WHERE pos >= c - floor(c * CAST(0.3 AS DOUBLE))),
{_tail_sql('recent')}
SELECT series, fold, {METRIC_SQL} FROM tail_rows GROUP BY 1, 2""",
        _M, "fold", digits=METRIC_DIGITS,
    ),
)
def tail_fold_metrics_recent(spark: SparkSession, folder: str) -> DataFrame:
    """Tail folds on the last 30 % of each series."""
    rows = folds.tail_folds(views.daily_orders(spark, folder), SERIES, "load", recent=0.3)
    return emit(metrics.fold_metrics(rows, ["series"]), digits=METRIC_DIGITS)


# ---------------------------------------------------------------- metrics


@query("AGG10", oracle(f"WITH {SUPPLIER_PAIRS} SELECT series, {METRIC_SQL} FROM pairs GROUP BY 1", _M, "series"))
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.regression_metrics(views.supplier_pairs(spark, folder), ["series"]))


@query(
    "AGG11",
    oracle(
        f"""WITH {PAIRS}
SELECT series,
  avg(abs(actual - prediction)) FILTER (WHERE pos % 24 IN (6, 7, 8, 9, 18, 19, 20, 21)) AS peak_hour_mae,
  abs(CASE WHEN max(actual) > 0 THEN avg(actual) / max(actual) ELSE 0 END
      - CASE WHEN max(prediction) > 0 THEN avg(prediction) / max(prediction) ELSE 0 END) AS load_factor_error,
  abs(max(actual) - max(prediction)) AS max_demand_error
FROM pairs GROUP BY 1""",
        "peak_hour_mae load_factor_error max_demand_error",
    ),
)
def energy_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.energy_metrics(views.pairs(spark, folder), SERIES, ["series"]))


@query(
    "AGG12",
    oracle(
        f"""WITH {PAIRS}
SELECT series, avg(abs((actual - prediction) / nullif(actual, 0))) * 100 AS mape, max(abs(actual - prediction)) AS max_error,
  abs(max(actual) - max(prediction)) AS peak_demand_error,
  1 - avg(abs(actual - prediction) / nullif(actual, 0)) FILTER (WHERE hour(ts) IN (8, 9, 17, 18, 19)) AS peak_hour_accuracy
FROM pairs GROUP BY 1 HAVING count(*) FILTER (WHERE actual = 0) = 0""",
        "mape max_error peak_demand_error peak_hour_accuracy",
    ),
)
def domain_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.domain_metrics(views.pairs(spark, folder), SERIES, ["series"]))


@query(
    "AGG18",
    oracle(
        f"""WITH {PAIRS}, scores AS (SELECT series, {METRIC_SQL}, avg(actual - prediction) AS mean_error FROM pairs GROUP BY 1)
SELECT series, mae, rmse, r2 AS r2_score, mean_error FROM scores""",
        "mae rmse r2_score mean_error",
    ),
)
def monitored_performance(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.performance(views.pairs(spark, folder), ["series"]))


# ---------------------------------------------------------------- summaries and choice

_MODELS_SQL = f"""{HOURLY},
guesses AS (
  SELECT series, ts, pos, load AS actual, lag(load, 1) OVER w AS last_hour, lag(load, 24) OVER w AS last_day,
         lag(load, 168) OVER w AS last_week FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts)),
long AS (
  SELECT series, ts, pos, actual, 'last_hour' AS model, last_hour AS prediction FROM guesses
  UNION ALL SELECT series, ts, pos, actual, 'last_day', last_day FROM guesses
  UNION ALL SELECT series, ts, pos, actual, 'last_week', last_week FROM guesses),
scored AS (
  SELECT model, CAST(pos // 96 AS BIGINT) AS fold, {METRIC_SQL} FROM long
  WHERE actual IS NOT NULL AND prediction IS NOT NULL GROUP BY 1, 2)"""


def _guesses(spark: SparkSession, folder: str) -> DataFrame:
    """Three simple forecasts in long form: series, ts, pos, actual, model, prediction."""
    lags = {"last_hour": 1, "last_day": 24, "last_week": 168}
    rows = features.add_lags(views.hourly(spark, folder), SERIES, ["load"], list(lags.values()))
    wide = rows.select(
        "series", "ts", "pos", F.col("load").alias("actual"), *[F.col(f"load_lag_{k}").alias(m) for m, k in lags.items()]
    )
    return wide.unpivot(["series", "ts", "pos", "actual"], list(lags), "model", "prediction")


def model_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Fold metrics of the three forecasts, a fold being 96 hours."""
    known = _guesses(spark, folder).filter(F.col("actual").isNotNull() & F.col("prediction").isNotNull())
    fold = F.floor(F.col("pos") / 96).alias("fold")
    return known.groupBy("model", fold).agg(*metrics.metric_columns())


_SUMMARY = [f"{m}_{s}" for m in metrics.METRICS for s in ("mean", "std", "min", "max")]


@query(
    "AGG22 AGG23",
    oracle(
        f"""WITH {_MODELS_SQL}
SELECT model, count(*) AS folds, {', '.join(
    f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std, min({m}) AS {m}_min, max({m}) AS {m}_max" for m in metrics.METRICS)}
FROM scored GROUP BY 1""",
        " ".join(_SUMMARY), "folds", digits=METRIC_DIGITS,
    ),
)
def fold_summary(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.fold_summary(model_folds(spark, folder)), "model", "folds", *_SUMMARY, digits=METRIC_DIGITS)


@query(
    "AGG24",
    oracle(
        f"""WITH {_MODELS_SQL}, m AS (SELECT model, avg(mae) AS mae FROM scored GROUP BY 1)
SELECT count(*) AS models, arg_min(model, mae) AS best_model, min(mae) AS best_mae, avg(mae) AS average_mae FROM m""",
        "best_mae average_mae", "models",
    ),
)
def evaluation_overview(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.evaluation_overview(model_folds(spark, folder)))


@query(
    "AGG32",
    oracle(
        f"""WITH {_MODELS_SQL}, m AS (
  SELECT model, count(*) AS folds, avg(mae) AS mae_mean, avg(rmse) AS rmse_mean, avg(mape) AS mape_mean, avg(r2) AS r2_mean
  FROM scored GROUP BY 1)
SELECT m.*, t.test, CASE t.test WHEN 'many_folds' THEN m.folds >= 7 ELSE m.r2_mean > 0 END AS passed
FROM m, (VALUES ('many_folds'), ('positive_fit')) AS t(test)""",
        "mae_mean rmse_mean mape_mean r2_mean", "folds", digits=METRIC_DIGITS,
    ),
)
def validation_detail(spark: SparkSession, folder: str) -> DataFrame:
    scored = model_folds(spark, folder)
    tests = scored.groupBy("model").agg(
        F.create_map(F.lit("many_folds"), F.count(F.lit(1)) >= 7, F.lit("positive_fit"), F.avg("r2") > 0).alias("tests")
    )
    return emit(metrics.validation_detail(scored, tests), digits=METRIC_DIGITS)


@query("WIN24", oracle(f"WITH {_MODELS_SQL} SELECT model, fold, mae FROM scored", "mae", "fold"))
def validation_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.validation_timeline(model_folds(spark, folder)))


@query(
    "TOP3",
    oracle(
        f"""WITH {_MODELS_SQL}, m AS (SELECT model, avg(mae) AS mae FROM scored GROUP BY 1)
SELECT model AS best_model, mae AS best_error FROM m ORDER BY mae, model LIMIT 1""",
        "best_error",
    ),
)
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.best_by_error(metrics.fold_summary(model_folds(spark, folder))))


@query(
    "TOP4 PL12",
    oracle(
        f"""WITH {_MODELS_SQL}, m AS (SELECT model, avg(mae) AS mae, avg(r2) AS r2, stddev_pop(mae) AS s FROM scored GROUP BY 1),
c AS (SELECT model, 0.4::DOUBLE / (1 + mae) + 0.3::DOUBLE * greatest(0, r2) + 0.3::DOUBLE / (1 + s) AS score FROM m)
SELECT model, score, model = (SELECT model FROM c ORDER BY score DESC, model LIMIT 1) AS is_best FROM c""",
        "score",
    ),
)
def best_model_by_composite(spark: SparkSession, folder: str) -> DataFrame:
    return emit(metrics.best_by_composite(metrics.fold_summary(model_folds(spark, folder))))


@query(
    "PL12",
    oracle(
        f"""WITH {HOURLY}, {_naive_folds_sql('hourly', 'load', 168, 24)},
scored AS (SELECT series, fold, {METRIC_SQL} FROM fold_rows GROUP BY 1, 2),
c AS (
  SELECT 'naive' AS model, 0.4::DOUBLE / (1 + avg(mae)) + 0.3::DOUBLE * greatest(0, avg(r2))
         + 0.3::DOUBLE / (1 + stddev_pop(mae)) AS score FROM scored)
SELECT model, score, true AS is_best FROM c""",
        "score",
    ),
)
def validate_naive_model(spark: SparkSession, folder: str) -> DataFrame:
    return emit(flows.validate_models(views.hourly(spark, folder), SERIES, "load")[1])


@query(
    "SNK2 SRC14",
    oracle(f"WITH {_MODELS_SQL} SELECT model, fold, {', '.join(metrics.METRICS)} FROM scored", _M, "fold", digits=METRIC_DIGITS),
)
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    """The nested report is written as JSON, read back and flattened to folds."""
    report = sinks.build_report(materialize(model_folds(spark, folder), "folds"), F.lit("2024-02-01").cast("timestamp"))
    path = scratch_path(spark, "report")
    sinks.write_report(report, path)
    return emit(documents.report_folds(documents.load_reports(spark, path)).drop("timestamp"), digits=METRIC_DIGITS)


@query(
    "SNK3 SET3",
    oracle(
        f"""WITH {_MODELS_SQL}, m AS (SELECT model, avg(mae) AS mae FROM scored GROUP BY 1),
b AS (SELECT model, mae FROM m ORDER BY mae, model LIMIT 1)
SELECT r.run_id, b.model AS best_model, b.mae AS best_mae, 3 AS models_evaluated, r.run_id = 'r2' AS is_latest
FROM b, (VALUES ('r1'), ('r2')) AS r(run_id)""",
        "best_mae", "models_evaluated",
    ),
)
def evaluation_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs are appended (one of them twice); the index has one row per run."""
    scored = materialize(model_folds(spark, folder), "folds")
    path = scratch_path(spark, "history")
    for run, day in (("r1", "2024-02-01"), ("r2", "2024-02-02"), ("r2", "2024-02-02")):
        sinks.append_history(scored, path, run, F.lit(day).cast("timestamp"))
    history = sinks.read_history(spark, path)
    latest = sinks.latest_run(history).select(F.max("run_id")).scalar()
    index = sinks.history_index(history)
    return emit(index.select("run_id", "best_model", "best_mae", "models_evaluated", (F.col("run_id") == latest).alias("is_latest")))


@query(
    "SNK4",
    oracle(
        f"""WITH {_MODELS_SQL} SELECT model, count(*) AS folds, avg(mae) AS mae_mean, avg(rmse) AS rmse_mean, avg(mape) AS mape_mean,
avg(r2) AS r2_mean FROM scored GROUP BY 1""",
        "mae_mean rmse_mean mape_mean r2_mean", "folds", digits=METRIC_DIGITS,
    ),
)
def summary_export(spark: SparkSession, folder: str) -> DataFrame:
    table = metrics.model_comparison(metrics.fold_summary(model_folds(spark, folder)))
    path = scratch_path(spark, "summary")
    sinks.write_csv(table, path, ["mae_mean", "model"])
    return emit(spark.read.schema(table.schema).csv(path, header=True), digits=METRIC_DIGITS)


@query(
    "MDL16",
    oracle(
        f"""WITH {_MODELS_SQL},
runs AS (SELECT model || '-' || CAST(fold AS VARCHAR) AS run_id, model, fold, mae FROM scored),
numbered AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY fold) AS version FROM runs)
SELECT run_id, model, version, mae,
       CASE WHEN run_id = (SELECT run_id FROM runs ORDER BY mae, model LIMIT 1) THEN 'production' ELSE 'staging' END AS stage
FROM numbered""",
        "mae", "version", digits=METRIC_DIGITS,
    ),
)
def staged_models(spark: SparkSession, folder: str) -> DataFrame:
    from wattlane.operators.forecast import stage_models

    runs = model_folds(spark, folder).select(
        F.concat_ws("-", "model", F.col("fold").cast("string")).alias("run_id"), "model", "mae",
        F.make_dt_interval(days=F.col("fold").cast("int")).alias("_age"),
    )
    timed = runs.withColumn("run_ts", F.lit("2024-02-01").cast("timestamp") + F.col("_age")).drop("_age")
    return emit(stage_models(timed), "run_id", "model", "version", "mae", "stage", digits=METRIC_DIGITS)
