"""Queries on business figures, quality, drift and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.operators import alerts, drift, folds, joins, kpi
from wattlane.plans import flows, views
from wattlane.plans.catalog import emit, oracle, query
from wattlane.plans.views import ENERGY, PAIRS, RAW, RAW_EVENTS, SERIES
from wattlane.session import materialize

_ERR = "(actual - prediction)"

# ---------------------------------------------------------------- business figures

_PEAK_SQL = f"""
  coalesce(avg(abs{_ERR}) FILTER (WHERE hour(ts) IN (17, 18, 19, 20)), 0) AS peak_mae,
  avg(abs({_ERR} / nullif(actual, 0))) FILTER (WHERE hour(ts) IN (17, 18, 19, 20)) * 100 AS peak_mape,
  100 - avg(abs({_ERR} / nullif(actual, 0))) FILTER (WHERE hour(ts) IN (17, 18, 19, 20)) * 100 AS peak_accuracy,
  count(*) FILTER (WHERE hour(ts) IN (17, 18, 19, 20)) AS peak_hours_count"""
_RELIABILITY_SQL = f"""
  avg{_ERR} AS forecast_bias, var_samp{_ERR} AS forecast_variance, 1 / (1 + stddev_samp{_ERR}) AS forecast_consistency,
  greatest(0, least(100, ((1 - abs(avg{_ERR}) / nullif(avg(actual), 0)) * 0.4::DOUBLE
    + 1 / (1 + stddev_samp{_ERR}) * 0.4::DOUBLE) * 100)) AS reliability_score"""
_IMPACT_SQL = f"""
  sum(abs{_ERR}) * 0.12::DOUBLE AS total_error_cost,
  coalesce(sum{_ERR} FILTER (WHERE actual > prediction), 0) * 0.12::DOUBLE * 1.5 AS under_forecast_cost,
  coalesce(sum(prediction - actual) FILTER (WHERE actual < prediction), 0) * 0.12::DOUBLE * 0.3::DOUBLE AS over_forecast_cost,
  greatest(0, (1 - sum(abs{_ERR}) * 0.12::DOUBLE / nullif(sum(actual) * 0.12::DOUBLE, 0)) * 100) AS business_impact_score,
  CASE WHEN sum(actual) > 0 THEN sum(abs{_ERR}) * 0.12::DOUBLE / sum(actual) ELSE 0 END AS error_cost_per_mwh"""


@query("AGG13", oracle(f"WITH {PAIRS} SELECT series, {_PEAK_SQL} FROM pairs GROUP BY 1", "peak_mae peak_mape peak_accuracy", "peak_hours_count"))
def peak_demand_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return emit(kpi.peak_demand(views.pairs(spark, folder), SERIES, ["series"]))


@query(
    "AGG13",
    oracle(
        f"""WITH {PAIRS}
SELECT series, avg(abs{_ERR}) FILTER (WHERE pos % 6 >= 3) AS peak_mae, count(*) FILTER (WHERE pos % 6 >= 3) AS peak_hours_count
FROM pairs GROUP BY 1""",
        "peak_mae", "peak_hours_count",
    ),
)
def peak_demand_kpi_by_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Without a clock, rows 3-5 of every six stand for the peak."""
    rows = kpi.peak_demand(views.pairs(spark, folder), SERIES, ["series"], clock=False)
    return emit(rows, "series", "peak_mae", "peak_hours_count")


@query(
    "AGG14",
    oracle(
        f"""WITH {ENERGY}, t AS (
  SELECT *, coalesce(generation_solar, 0) + coalesce(generation_wind_onshore, 0) + coalesce(generation_hydro_water_reservoir, 0) AS green
  FROM energy)
SELECT avg(green) AS avg_renewable_generation, max(green) AS max_renewable_generation,
       sum(green) / sum(total_load_actual) * 100 AS renewable_penetration FROM t""",
        "avg_renewable_generation max_renewable_generation renewable_penetration",
    ),
)
def renewable_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return emit(kpi.renewable_contribution(views.energy(spark, folder), "total_load_actual"))


@query(
    "AGG15",
    oracle(
        f"WITH {PAIRS} SELECT series, {_RELIABILITY_SQL}, 0 AS pred_coverage, 0 AS actual_coverage FROM pairs GROUP BY 1",
        "forecast_bias forecast_variance forecast_consistency reliability_score pred_coverage actual_coverage",
    ),
)
def reliability_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return emit(kpi.reliability(views.pairs(spark, folder), ["series"]))


@query(
    "AGG15",
    oracle(
        f"""WITH {PAIRS}
SELECT series, avg(CASE WHEN prediction BETWEEN 50 AND 300 THEN 1.0 ELSE 0.0 END) * 100 AS pred_coverage,
       avg(CASE WHEN actual BETWEEN 50 AND 300 THEN 1.0 ELSE 0.0 END) * 100 AS actual_coverage
FROM pairs GROUP BY 1""",
        "pred_coverage actual_coverage",
    ),
)
def interval_coverage(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.pairs(spark, folder).withColumn("low", F.lit(50.0)).withColumn("high", F.lit(300.0))
    return emit(kpi.reliability(rows, ["series"], lower="low", upper="high"), "series", "pred_coverage", "actual_coverage")


@query(
    "AGG16",
    oracle(
        f"WITH {PAIRS} SELECT series, {_IMPACT_SQL} FROM pairs GROUP BY 1",
        "total_error_cost under_forecast_cost over_forecast_cost business_impact_score error_cost_per_mwh",
    ),
)
def business_impact_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return emit(kpi.business_impact(views.pairs(spark, folder), ["series"]))


def daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """All business figures of every series and day: a history of monitoring runs."""
    rows = views.pairs(spark, folder).withColumn("run_ts", F.date_trunc("day", "ts"))
    return kpi.all_metrics(rows, SERIES, ["series", "run_ts"])


_RUN_FIGURES = (
    "peak_demand.peak_mae peak_demand.peak_mape peak_demand.peak_accuracy peak_demand.peak_hours_count "
    "forecast_reliability.forecast_bias forecast_reliability.forecast_variance forecast_reliability.forecast_consistency "
    "forecast_reliability.pred_coverage forecast_reliability.actual_coverage forecast_reliability.reliability_score "
    "business_impact.total_error_cost business_impact.under_forecast_cost business_impact.over_forecast_cost "
    "business_impact.business_impact_score business_impact.error_cost_per_mwh"
).split()
_DAILY_SQL = f"""{PAIRS},
wide AS (
  SELECT series, date_trunc('day', ts) AS run_ts, {_PEAK_SQL}, {_RELIABILITY_SQL}, {_IMPACT_SQL},
         0 AS pred_coverage, 0 AS actual_coverage
  FROM pairs GROUP BY 1, 2),
history AS (
  {' UNION ALL '.join(
      f"SELECT series, run_ts, '{m}' AS metric, CAST("
      + (f"CASE WHEN peak_hours_count = 0 THEN 0 ELSE {m.split('.')[1]} END" if m.startswith('peak_demand') else m.split('.')[1])
      + " AS DOUBLE) AS value FROM wide"
      for m in _RUN_FIGURES)})"""


@query(
    "AGG17 SET3",
    oracle(
        f"""WITH {_DAILY_SQL}
SELECT series, run_ts, metric, CASE WHEN metric LIKE '%variance' THEN round(value, 2) ELSE value END AS value FROM history""",
        "value", times="run_ts",
    ),
)
def all_kpis_per_run(spark: SparkSession, folder: str) -> DataFrame:
    """Variances are squares of larger numbers and are compared to two decimals."""
    coarse = F.when(F.col("metric").endswith("variance"), F.round("value", 2)).otherwise(F.col("value"))
    return emit(daily_metrics(spark, folder).withColumn("value", coarse), "series", "run_ts", "metric", "value")


@query(
    "AGG17",
    oracle(
        f"""WITH {_DAILY_SQL}
SELECT series, metric, arg_max(value, run_ts) AS value, max(run_ts) AS run_ts FROM history
WHERE metric IN ({', '.join(f"'{m}'" for m in kpi.SUMMARY)}) GROUP BY 1, 2""",
        "value", times="run_ts",
    ),
)
def latest_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return emit(kpi.latest_summary(daily_metrics(spark, folder), by=["series"]))


@query(
    "AGG17",
    oracle(
        f"""WITH {_DAILY_SQL}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY series, metric ORDER BY run_ts DESC) AS nth FROM history WHERE metric NOT LIKE '%variance')
SELECT series, metric, run_ts, value FROM numbered WHERE nth <= 7""",
        "value", times="run_ts",
    ),
)
def recent_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """The last week of every figure; variances are compared by ``all_kpis_per_run``."""
    history = daily_metrics(spark, folder).filter(~F.col("metric").endswith("variance"))
    return emit(kpi.recent_runs(history, 7, by=["series"]), "series", "metric", "run_ts", "value")


# ---------------------------------------------------------------- quality and drift

_SIDES = f"""{RAW_EVENTS},
facts AS (SELECT count(*) AS c FROM raw),
sides AS (
  SELECT *, CASE WHEN pos < floor(c * CAST(0.9 AS DOUBLE)) THEN 'reference' ELSE 'current' END AS batch FROM raw, facts)"""


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """First 90 % and last 10 % of the events by time."""
    both = folds.reference_and_current(views.raw_events(spark, folder), RAW)
    return both.filter("batch = 'reference'"), both.filter("batch = 'current'")


@query(
    "AGG19",
    oracle(
        f"""WITH {ENERGY}, s AS (
  SELECT count(*) FILTER (WHERE total_load_forecast IS NULL) / count(*) AS a, count(*) FILTER (WHERE price_actual IS NULL) / count(*) AS b,
         count(*) FILTER (WHERE total_load_actual IS NULL) / count(*) AS c FROM energy)
SELECT greatest(0, 1 - 0.1::DOUBLE * (a + b + c)) AS data_quality_score,
       CAST(a > 0 AS BIGINT) + CAST(b > 0 AS BIGINT) + CAST(c > 0 AS BIGINT) AS columns_with_missing FROM s""",
        "data_quality_score", "columns_with_missing",
    ),
)
def quality_score(spark: SparkSession, folder: str) -> DataFrame:
    shares = drift.missing_shares(views.energy(spark, folder), ["total_load_forecast", "price_actual", "total_load_actual"])
    return emit(drift.quality_score(shares))


_SHIFT_SQL = f"""{_SIDES},
m AS (
  {' UNION ALL '.join(
      f"SELECT '{c}' AS field, avg({c}) FILTER (WHERE batch = 'reference') AS reference_mean, "
      f"avg({c}) FILTER (WHERE batch = 'current') AS current_mean FROM sides" for c in ('event_id', 'user_id', 'value'))}),
shift AS (SELECT *, abs(reference_mean - current_mean) > 0.1::DOUBLE * abs(reference_mean) AS drifted FROM m)"""


@query("AGG20", oracle(f"WITH {_SHIFT_SQL} SELECT * FROM shift", "reference_mean current_mean"))
def mean_shift(spark: SparkSession, folder: str) -> DataFrame:
    reference, current = _sides(spark, folder)
    return emit(drift.mean_shift(reference, current, ["event_id", "user_id", "value"]))


@query(
    "AGG20",
    oracle(
        f"""WITH {_SHIFT_SQL}
SELECT bool_or(drifted) AS drift_detected, count(*) FILTER (WHERE drifted) * 0.1 AS drift_score FROM shift""",
        "drift_score",
    ),
)
def drift_score(spark: SparkSession, folder: str) -> DataFrame:
    reference, current = _sides(spark, folder)
    return emit(drift.drift_score(drift.mean_shift(reference, current, ["event_id", "user_id", "value"])))


@query(
    "AGG21",
    oracle(
        f"""WITH {_SIDES},
cells AS (
  SELECT value AS v, count(*) FILTER (WHERE batch = 'reference') AS a, count(*) FILTER (WHERE batch = 'current') AS b
  FROM sides GROUP BY 1),
steps AS (SELECT v, sum(a) OVER (ORDER BY v) AS ca, sum(b) OVER (ORDER BY v) AS cb FROM cells),
t AS (SELECT sum(a) AS n, sum(b) AS m FROM cells),
d AS (SELECT max(abs(ca / n - cb / m)) AS statistic, max(n) AS n, max(m) AS m FROM steps, t),
l AS (SELECT *, (sqrt(n * m / (n + m)) + 0.12 + 0.11 / sqrt(n * m / (n + m))) * statistic AS lam FROM d),
p AS (
  SELECT statistic, n, m, CASE WHEN any_value(lam) < 0.2 THEN 1.0
         ELSE least(1, greatest(0, 2 * sum(pow(-1, k - 1) * exp(-2 * k * k * lam * lam)))) END AS p_value
  FROM l, generate_series(1, 100) AS g(k) GROUP BY 1, 2, 3)
SELECT 'value' AS field, statistic, n AS reference_rows, m AS current_rows, p_value, p_value < 0.05 AS drifted FROM p""",
        "statistic p_value", "reference_rows current_rows",
    ),
)
def distribution_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of the event values."""
    reference, current = _sides(spark, folder)
    return emit(drift.ks_test(reference, current, "value"))


@query(
    "AGG21",
    oracle(
        f"""WITH {_SIDES},
cells AS (
  SELECT event_type AS v, count(*) FILTER (WHERE batch = 'reference') AS a, count(*) FILTER (WHERE batch = 'current') AS b
  FROM sides GROUP BY 1),
t AS (SELECT sum(a) AS n, sum(b) AS m FROM cells),
chi AS (
  SELECT sum(pow(a - (a + b) * n / (n + m), 2) / ((a + b) * n / (n + m))
             + pow(b - (a + b) * m / (n + m), 2) / ((a + b) * m / (n + m))) AS chi2, count(*) AS n_values, sum(a + b) AS n_rows
  FROM cells, t)
SELECT 'event_type' AS field, chi2, n_values, sqrt(chi2 / n_rows) AS cramers_v, sqrt(chi2 / n_rows) > 0.1 AS drifted FROM chi""",
        "chi2 cramers_v", "n_values",
    ),
)
def category_drift(spark: SparkSession, folder: str) -> DataFrame:
    reference, current = _sides(spark, folder)
    return emit(drift.categorical_drift(reference, current, "event_type"))


_NUMBERS, _KINDS = ("event_id", "user_id", "value"), ("event_type",)
_COLUMN_DRIFT = f"""{_SIDES},
numbers AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS field, CAST({c} AS DOUBLE) AS v, batch FROM sides" for c in _NUMBERS)}),
number_cells AS (
  SELECT field, v, count(*) FILTER (WHERE batch = 'reference') AS a, count(*) FILTER (WHERE batch = 'current') AS b
  FROM numbers WHERE v IS NOT NULL GROUP BY 1, 2),
number_steps AS (
  SELECT field, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY field) AS n, sum(b) OVER (PARTITION BY field) AS m
  FROM number_cells WINDOW w AS (PARTITION BY field ORDER BY v)),
number_gaps AS (SELECT field, max(abs(ca / n - cb / m)) AS statistic, max(n) AS n, max(m) AS m FROM number_steps GROUP BY 1),
number_lam AS (SELECT *, (sqrt(n * m / (n + m)) + 0.12 + 0.11 / sqrt(n * m / (n + m))) * statistic AS lam FROM number_gaps),
number_p AS (
  SELECT field, statistic, n, m, CASE WHEN any_value(lam) < 0.2 THEN 1.0
         ELSE least(1, greatest(0, 2 * sum(pow(-1, k - 1) * exp(-2 * k * k * lam * lam)))) END AS p_value
  FROM number_lam, generate_series(1, 100) AS g(k) GROUP BY 1, 2, 3, 4),
kind_cells AS (
  SELECT event_type AS v, count(*) FILTER (WHERE batch = 'reference') AS a, count(*) FILTER (WHERE batch = 'current') AS b
  FROM sides WHERE event_type IS NOT NULL GROUP BY 1),
kind_sums AS (SELECT sum(a) AS n, sum(b) AS m FROM kind_cells),
column_drift AS (
  SELECT field, 'numeric' AS kind, statistic, p_value, n AS reference_rows, m AS current_rows, p_value < 0.05 AS drifted FROM number_p
  UNION ALL
  SELECT 'event_type', 'categorical', v, NULL, n, m, v > 0.1 FROM (
    SELECT sqrt(sum(pow(a - (a + b) * n / (n + m), 2) / ((a + b) * n / (n + m))
             + pow(b - (a + b) * m / (n + m), 2) / ((a + b) * m / (n + m))) / sum(a + b)) AS v, max(n) AS n, max(m) AS m
    FROM kind_cells, kind_sums))"""


def _column_drift(spark: SparkSession, folder: str) -> DataFrame:
    reference, current = _sides(spark, folder)
    return drift.column_drift(reference, current, _NUMBERS, _KINDS)


@query("AGG21", oracle(f"WITH {_COLUMN_DRIFT} SELECT * FROM column_drift", "statistic p_value", "reference_rows current_rows"))
def drift_of_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    return emit(_column_drift(spark, folder))


@query(
    "AGG21",
    oracle(
        f"""WITH {_COLUMN_DRIFT}
SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted, count(*) FILTER (WHERE drifted) / count(*) AS drifted_share,
       count(*) FILTER (WHERE drifted) / count(*) >= 0.5 AS dataset_drift FROM column_drift""",
        "drifted_share", "n_columns n_drifted",
    ),
)
def dataset_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Whether at least half of the columns drifted."""
    return emit(drift.dataset_drift(_column_drift(spark, folder)))


# ---------------------------------------------------------------- rules and alerts

_DAY_RULES = (
    ("High Peak Demand Error", "peak_demand.peak_mape", ">", 15.0, "error", "Peak demand forecast error exceeds 15%"),
    ("Low Reliability Score", "forecast_reliability.reliability_score", "<", 40.0, "warning", "Reliability low"),
    ("High Business Impact", "business_impact.business_impact_score", "<=", 20.0, "error", ""),
    ("Full Peak Day", "peak_demand.peak_hours_count", "==", 4.0, "info", "All peak hours present"),
    ("Short Peak Day", "peak_demand.peak_hours_count", "!=", 4.0, "info", "Peak hours missing"),
    ("Unknown Operator", "peak_demand.peak_hours_count", "~", 4.0, "critical", "Never fires"),
    ("Unknown Metric", "no.such.metric", ">", 0.0, "critical", "Never fires"),
)
_RULE_ROWS = ", ".join(
    f"('{n}', '{m}', '{o}', CAST({t} AS DOUBLE), '{s}', '{d}')" for n, m, o, t, s, d in _DAY_RULES
)
_ALERT_SQL = f"""{_DAILY_SQL},
rules(rule_name, metric, operator, threshold, severity, description) AS (VALUES {_RULE_ROWS}),
fired AS (
  SELECT h.series, h.run_ts, r.*, h.value
  FROM history h JOIN rules r ON h.metric = r.metric
  WHERE CASE r.operator WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold WHEN '>=' THEN value >= threshold
        WHEN '<=' THEN value <= threshold WHEN '==' THEN abs(value - threshold) < 1e-6
        WHEN '!=' THEN abs(value - threshold) >= 1e-6 ELSE false END)"""


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    rules = alerts.rules_table(spark, _DAY_RULES)
    return alerts.evaluate(daily_metrics(spark, folder), rules, ["series", "run_ts"])


@query(
    "CND1 JN6",
    oracle(
        f"WITH {_ALERT_SQL} SELECT series, run_ts, rule_name, metric, value, operator, threshold, severity, description FROM fired",
        "value threshold", times="run_ts",
    ),
)
def rule_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return emit(_alerts(spark, folder))


_MESSAGE_SQL = """'• *' || rule_name || '*' || chr(10) || '  Metric: ' || metric || chr(10) || '  Value: ' || printf('%.4f', value)
  || chr(10) || '  Condition: ' || operator || ' ' || CAST(threshold AS VARCHAR) || chr(10) || '  Severity: ' || severity
  || CASE WHEN description <> '' THEN chr(10) || '  ' || description ELSE '' END
  || chr(10) || '  Time: ' || strftime(run_ts, '%Y-%m-%dT%H:%M:%S')"""


@query(
    "STR1",
    oracle(
        f"""WITH {_ALERT_SQL}
SELECT series, run_ts, rule_name, operator || ' ' || CAST(threshold AS VARCHAR) AS condition, {_MESSAGE_SQL} AS message FROM fired""",
        times="run_ts",
    ),
)
def alert_messages(spark: SparkSession, folder: str) -> DataFrame:
    return emit(alerts.with_message(_alerts(spark, folder)), "series", "run_ts", "rule_name", "condition", "message")


@query(
    "STR1",
    oracle(
        f"""WITH {_ALERT_SQL}, told AS (SELECT series, run_ts, severity, rule_name, {_MESSAGE_SQL} AS message FROM fired)
SELECT series, run_ts, severity, count(*) AS alerts, string_agg(message, chr(10) || chr(10) ORDER BY rule_name) AS text
FROM told GROUP BY 1, 2, 3""",
        ints="alerts", times="run_ts",
    ),
)
def alert_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One text per run and severity."""
    return emit(alerts.digest(_alerts(spark, folder), by=["series"]), "series", "run_ts", "severity", "alerts", "text")


@query(
    "WIN22",
    oracle(f"WITH {_ALERT_SQL} SELECT rule_name, count(*) AS trigger_count, max(run_ts) AS last_triggered FROM fired GROUP BY 1",
           ints="trigger_count", times="last_triggered"),
)
def rule_trigger_counts(spark: SparkSession, folder: str) -> DataFrame:
    return emit(alerts.trigger_counts(_alerts(spark, folder)))


@query(
    "WIN22",
    oracle(
        f"""WITH {_ALERT_SQL}
SELECT series, run_ts, rule_name, row_number() OVER (PARTITION BY series, rule_name ORDER BY run_ts) AS trigger_count FROM fired""",
        ints="trigger_count", times="run_ts",
    ),
)
def numbered_alerts(spark: SparkSession, folder: str) -> DataFrame:
    rows = alerts.number_triggers(_alerts(spark, folder), by=["series"])
    return emit(rows, "series", "run_ts", "rule_name", "trigger_count")


@query(
    "WIN23",
    oracle(
        f"WITH {_ALERT_SQL} SELECT run_ts, series, rule_name FROM fired ORDER BY run_ts DESC, series, rule_name LIMIT 100",
        times="run_ts",
    ),
)
def newest_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The alert log keeps its newest entries only."""
    rows = alerts.newest(_alerts(spark, folder), 100, tie=["series", "rule_name"])
    return emit(rows, "run_ts", "series", "rule_name")


_NOW = "2024-01-30 12:00:00"


@query(
    "WIN23",
    oracle(
        f"WITH {_ALERT_SQL} SELECT series, run_ts, rule_name FROM fired WHERE run_ts > TIMESTAMP '{_NOW}' - INTERVAL 72 HOUR",
        times="run_ts",
    ),
)
def alerts_of_last_hours(spark: SparkSession, folder: str) -> DataFrame:
    now = F.lit(_NOW).cast("timestamp")
    return emit(alerts.since(_alerts(spark, folder), now, 72), "series", "run_ts", "rule_name")


@query(
    "AGG25",
    oracle(
        f"""WITH {_ALERT_SQL}
SELECT severity, count(*) AS alerts, count(*) FILTER (WHERE run_ts > TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR) AS recent_alerts
FROM fired GROUP BY 1""",
        ints="alerts recent_alerts",
    ),
)
def alert_summary(spark: SparkSession, folder: str) -> DataFrame:
    return emit(alerts.summary(_alerts(spark, folder), F.lit(_NOW).cast("timestamp")))


@query(
    "CND3",
    oracle(
        f"""WITH {PAIRS}, m AS (
  SELECT series, avg(abs{_ERR}) AS mae, 1 - sum({_ERR} * {_ERR}) / nullif(var_pop(actual) * count(*), 0) AS r2_score FROM pairs GROUP BY 1)
SELECT series, 'Critical Model Degradation' AS rule_name, r2_score AS value, 'critical' AS severity FROM m WHERE r2_score < 0.5
UNION ALL SELECT series, 'Low Model Accuracy', mae, 'info' FROM m WHERE mae > 100""",
        "value",
    ),
)
def rule_table_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Configured rules, one replaced by name, one removed, applied to the metrics of every series."""
    from wattlane.operators import metrics

    table = alerts.rules_table(spark, alerts.CONFIGURED_RULES)
    stricter = alerts.rules_from_records(spark, [
        {"name": "Low Model Accuracy", "metric": "mae", "condition": ">", "threshold": 500},
        {"name": "Low Model Accuracy", "metric": "mae", "condition": ">", "threshold": 100, "severity": "INFO"},
    ])
    rules = alerts.remove_rule(alerts.add_rules(table, stricter), "High Peak Demand Error")
    scores = kpi.long_metrics(metrics.performance(views.pairs(spark, folder), ["series"]), "", ["series"])
    return emit(alerts.evaluate(scores, rules, ["series"]), "series", "rule_name", "value", "severity")


@query(
    "JSN1",
    oracle(
        f"""WITH {PAIRS}
SELECT series, avg(abs{_ERR}) AS mae, max(actual) AS peak, CAST(NULL AS DOUBLE) AS absent FROM pairs GROUP BY 1""",
        "mae peak absent",
    ),
)
def nested_metric_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Figures are nested in a JSON text and read back by dotted path."""
    nested = F.struct(F.avg(F.abs(F.col("actual") - F.col("prediction"))).alias("mae"),
                      F.struct(F.max("actual").alias("value")).alias("peak"))
    rows = views.pairs(spark, folder).groupBy("series").agg(F.to_json(nested).alias("payload"))
    return emit(rows.select("series", *[alerts.metric_at(F.col("payload"), path).alias(n)
                                        for n, path in (("mae", "mae"), ("peak", "peak.value"), ("absent", "peak.value.x"))]))


@query(
    "JSN1",
    oracle(
        f"""WITH {PAIRS}, m AS (SELECT series, avg(abs{_ERR}) AS mae, max(actual) AS peak FROM pairs GROUP BY 1)
SELECT series, 'mae' AS metric, mae AS value FROM m UNION ALL SELECT series, 'peak.value', peak FROM m""",
        "value",
    ),
)
def nested_metric_table(spark: SparkSession, folder: str) -> DataFrame:
    nested = F.struct(F.avg(F.abs(F.col("actual") - F.col("prediction"))).alias("mae"),
                      F.struct(F.max("actual").alias("value")).alias("peak"))
    rows = views.pairs(spark, folder).groupBy("series").agg(nested.alias("figures"))
    return emit(alerts.flatten_metrics(rows, "figures", ["series"]))


_CYCLE_SQL = f"""{_SHIFT_SQL}, paired AS (
  SELECT batch, value AS actual, lag(value, 1) OVER (ORDER BY ts, event_id) AS prediction FROM sides),
scored AS (
  SELECT avg(abs{_ERR}) AS mae, 1 - sum({_ERR} * {_ERR}) / nullif(var_pop(actual) * count(*), 0) AS r2_score
  FROM paired WHERE batch = 'current'),
found AS (
  SELECT 'data_drift.drift_detected' AS metric, CAST(bool_or(drifted) AS DOUBLE) AS value FROM shift
  UNION ALL SELECT 'mae', mae FROM scored UNION ALL SELECT 'r2_score', r2_score FROM scored)"""


@query(
    "PL11 CND2 AGG18 AGG19 AGG20",
    oracle(
        f"""WITH {_CYCLE_SQL}
SELECT 'Data drift' AS rule_name, value, 'warning' AS severity FROM found WHERE metric = 'data_drift.drift_detected' AND value > 0.5
UNION ALL SELECT 'Performance degraded', value, 'error' FROM found WHERE metric = 'mae' AND value > 1000
UNION ALL SELECT 'Low R2', value, 'error' FROM found WHERE metric = 'r2_score' AND value < 0.7""",
        "value",
    ),
)
def monitoring_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Quality, drift and performance of the current batch against the reference, and its alerts."""
    from wattlane.operators.chunks import lag_of, over_chunks

    rows = over_chunks(views.raw_events(spark, folder), RAW, {"prediction": lag_of("value", 1)}, lookback=1)
    both = materialize(folds.reference_and_current(rows, RAW), "sides")
    reference, current = both.filter("batch = 'reference'"), both.filter("batch = 'current'")
    pairs = current.select(F.col("value").alias("actual"), "prediction")
    rules = alerts.rules_table(spark, alerts.CYCLE_RULES)
    found = flows.monitoring_cycle(reference, current, pairs, ["event_id", "user_id", "value"], rules,
                                   F.lit(_NOW).cast("timestamp"))
    return emit(found, "rule_name", "value", "severity")


@query(
    "JN7 MDL15",
    oracle(
        f"""WITH {views.HOURLY}
SELECT series, ts, lag(load, 1) OVER w AS hour_prediction, lag(load, 24) OVER w AS day_prediction
FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts)""",
        "hour_prediction day_prediction",
    ),
)
def forecasts_side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    from wattlane.operators.features import add_lags

    rows = add_lags(views.hourly(spark, folder), SERIES, ["load"], [1, 24])
    long = rows.withColumnsRenamed({"load_lag_1": "hour", "load_lag_24": "day"}).unpivot(
        ["series", "ts"], ["hour", "day"], "model", "prediction"
    )
    return emit(joins.side_by_side(long, ["series", "ts"], ["hour", "day"]))
