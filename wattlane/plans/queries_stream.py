"""Streaming jobs run to the end of the available data; results are read back from their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattlane.operators import alerts, boosted, features, folds
from wattlane.plans import views
from wattlane.plans.catalog import emit, oracle, query
from wattlane.plans.views import HOURLY, PAIRS, RAW, RAW_EVENTS, SERIES
from wattlane.session import scratch_path
from wattlane.streaming import jobs


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table, a file or a folder of them, as a stream; watermarks need instants, not zone-free times."""
    path = f"{folder}/events.parquet"
    schema = spark.read.parquet(path).schema
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stream = jobs.read_parquet_stream(spark, path, schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _stream_of(df: DataFrame, label: str) -> DataFrame:
    """A stream over rows that are first written to files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return jobs.read_parquet_stream(spark, path, df.schema)


def _arriving(df: DataFrame, ts: str, batches: int, label: str) -> DataFrame:
    """A stream over rows that arrive in equal spans of time, one micro-batch each."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    ends = df.agg(F.min(ts).cast("double").alias("a"), F.max(ts).cast("double").alias("b")).first()
    width = ((ends["b"] or 0) - (ends["a"] or 0)) / batches or 1
    span = F.least(F.floor((F.col(ts).cast("double") - F.lit(ends["a"] or 0)) / F.lit(width)), F.lit(batches - 1))
    for k in range(batches):
        # Files are read in the order in which they were written.
        df.where(span == k).coalesce(1).write.mode("append").parquet(path)
    return jobs.read_parquet_stream(spark, path, df.schema, per_trigger=1)


def _collected(stream: DataFrame, label: str, mode: str = "append", processors: bool = False) -> DataFrame:
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    jobs.finish(jobs.to_table(stream, path, mode, processors=processors))
    return spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)


@query(
    "STM1 AGG2",
    oracle(
        """WITH h AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts, sum(value) AS load, count(*) AS n, avg(value) AS mean FROM events GROUP BY 1, 2)
SELECT * FROM h WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
        "load mean", "n",
    ),
)
def stream_hourly_load(spark: SparkSession, folder: str) -> DataFrame:
    """Closed hours only: open ones are held back by the watermark."""
    events = _event_stream(spark, folder).withColumnRenamed("event_type", "series")
    rows = _collected(jobs.hourly_load(events, ["series"], "ts", "value"), "hours")
    return emit(rows, "series", "ts", "load", "n", "mean")


@query(
    "STM2 AGG13 AGG15 AGG16",
    oracle(
        f"""WITH {PAIRS},
spread AS (SELECT p.*, ts - to_hours(CAST(k AS BIGINT)) AS window_start FROM pairs p, generate_series(0, 23) AS g(k)),
w AS (
  SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS rows, avg(abs(actual - prediction)) AS mae,
    avg(abs(actual - prediction)) FILTER (WHERE hour(ts) IN (17, 18, 19, 20)) AS peak_mae, avg(actual - prediction) AS forecast_bias,
    sum(abs(actual - prediction)) * 0.12::DOUBLE AS total_error_cost,
    greatest(0, (1 - sum(abs(actual - prediction)) * 0.12::DOUBLE / nullif(sum(actual) * 0.12::DOUBLE, 0)) * 100) AS business_impact_score
  FROM spread GROUP BY 1)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM pairs)""",
        "mae peak_mae forecast_bias total_error_cost business_impact_score", "rows",
    ),
)
def stream_sliding_kpis(spark: SparkSession, folder: str) -> DataFrame:
    stream = _stream_of(views.pairs(spark, folder), "pairs")
    return emit(_collected(jobs.sliding_kpis(stream, "ts"), "kpis").drop("batch_id"))


_STREAM_RULES = (
    ("large view", "view", ">", 30.0, "warning", ""),
    ("small click", "click", "<", 2.0, "info", ""),
    ("large error", "error", ">=", 50.0, "error", ""),
)


@query(
    "STM3 CND1 WIN22",
    oracle(
        """WITH rules(rule_name, metric, op, threshold, severity) AS (VALUES
  ('large view', 'view', '>', 30, 'warning'), ('small click', 'click', '<', 2, 'info'), ('large error', 'error', '>=', 50, 'error'))
SELECT rule_name, severity, count(*) AS trigger_count, max(ts) AS last_triggered FROM events JOIN rules ON event_type = metric
WHERE CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold ELSE value >= threshold END GROUP BY 1, 2""",
        ints="trigger_count",
    ),
)
def stream_rule_triggers(spark: SparkSession, folder: str) -> DataFrame:
    """The newest count of every rule."""
    figures = _event_stream(spark, folder).select("ts", F.col("event_type").alias("metric"), "value")
    counts = jobs.count_triggers(figures, alerts.rules_table(spark, _STREAM_RULES), "ts")
    rows = _collected(counts, "triggers", "update")
    latest = rows.groupBy("rule_name", "severity").agg(
        F.max_by("trigger_count", "batch_id").alias("trigger_count"), F.max("last_triggered").alias("last_triggered")
    )
    return emit(latest)


_ALERTS = """WITH RECURSIVE rules(rule_name, metric, op, threshold, severity) AS (VALUES
  ('large view', 'view', '>', 30, 'warning'), ('small click', 'click', '<', 2, 'info'), ('large error', 'error', '>=', 50, 'error')),
slots AS (
  SELECT rule_name, severity, date_trunc('hour', ts) AS ts, count(*) FILTER (
    WHERE CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold ELSE value >= threshold END) AS broken
  FROM events JOIN rules ON event_type = metric GROUP BY 1, 2, 3
  HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rule_name ORDER BY ts) AS k FROM slots),
step AS (
  SELECT rule_name, severity, CAST(0 AS BIGINT) AS k, CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS TIMESTAMP) AS opened, CAST(NULL AS TIMESTAMP) AS told,
    CAST(NULL AS TIMESTAMP) AS last, CAST(0 AS BIGINT) AS broken, CAST(NULL AS VARCHAR) AS event, CAST(NULL AS TIMESTAMP) AS expired,
    CAST(NULL AS TIMESTAMP) AS was_opened, CAST(0 AS BIGINT) AS was_broken
  FROM numbered WHERE k = 1
  UNION ALL
  SELECT n.rule_name, n.severity, n.k, n.ts,
    CASE WHEN n.broken = 0 THEN NULL WHEN held THEN s.opened ELSE n.ts END,
    CASE WHEN n.broken = 0 THEN NULL WHEN held AND n.ts - s.told < INTERVAL 6 HOUR THEN s.told ELSE n.ts END,
    CASE WHEN n.broken > 0 THEN n.ts END,
    CASE WHEN n.broken = 0 THEN 0 WHEN held THEN s.broken + n.broken ELSE n.broken END,
    CASE WHEN n.broken = 0 THEN CASE WHEN held THEN 'cleared' END WHEN NOT held THEN 'opened'
         WHEN n.ts - s.told >= INTERVAL 6 HOUR THEN 'repeated' END,
    CASE WHEN s.opened IS NOT NULL AND NOT held THEN s.last + INTERVAL 24 HOUR END, s.opened, s.broken
  FROM step s JOIN (SELECT n.*, p.k AS before FROM numbered n JOIN (SELECT 0 AS k UNION ALL SELECT k FROM numbered GROUP BY k) p ON p.k = n.k - 1) n
    ON n.rule_name = s.rule_name AND n.before = s.k,
    LATERAL (SELECT s.opened IS NOT NULL AND n.ts <= s.last + INTERVAL 24 HOUR AS held) h),
ends AS (SELECT s.* FROM step s JOIN (SELECT rule_name, max(k) AS k FROM numbered GROUP BY 1) e ON e.rule_name = s.rule_name AND e.k = s.k)
SELECT rule_name, severity, event, ts, CASE WHEN event = 'cleared' THEN was_opened ELSE opened END AS opened,
  CASE WHEN event = 'cleared' THEN was_broken ELSE broken END AS broken FROM step WHERE event IS NOT NULL
UNION ALL SELECT rule_name, severity, 'expired', expired, was_opened, was_broken FROM step WHERE expired IS NOT NULL
UNION ALL SELECT rule_name, severity, 'expired', last + INTERVAL 24 HOUR, opened, broken FROM ends
  WHERE opened IS NOT NULL AND last + INTERVAL 24 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""


@query("STM3 CND1 WIN22", oracle(_ALERTS, ints="broken"))
def stream_rule_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts that open, repeat after a cool-down, clear and expire, from events in six micro-batches."""
    events = views.table(spark, folder, "events").select("ts", F.col("event_type").alias("metric"), "value")
    rules = alerts.rules_table(spark, _STREAM_RULES)
    slots = jobs.breaches(_arriving(events, "ts", 6, "figures"), rules, "ts")
    return emit(_collected(jobs.alert_states(slots, "ts"), "alerts", processors=True).drop("batch_id"))


_LOOSE = T.StructType([
    T.StructField("time", T.StringType(), False), T.StructField("load", T.DoubleType()), T.StructField("code", T.IntegerType()),
])


@query(
    "STM4 SRC4 SRC5",
    oracle(
        """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, CASE WHEN event_id % 11 = 3 THEN NULL ELSE value END AS load,
       user_id AS code, true AS accepted FROM events WHERE event_id % 40 <> 7
UNION ALL SELECT strftime(ts, '%Y-%m-%d %H:%M:%S'), NULL, user_id, false FROM events WHERE event_id % 40 = 7""",
        "load", "code",
    ),
)
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events")
    raw = events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.when(F.col("event_id") % 40 == 7, "broken").when(F.col("event_id") % 11 == 3, "NA")
        .otherwise(F.col("value").cast("string")).alias("load"),
        F.col("user_id").cast("string").alias("code"),
    )
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    jobs.finish(jobs.quarantine(_stream_of(raw, "raw"), _LOOSE, good, bad))
    accepted = spark.read.parquet(good).select("time", "load", "code", F.lit(True).alias("accepted"))
    rejected = spark.read.parquet(bad).select(
        "time", F.col("load").try_cast("double").alias("load"), F.col("code").cast("int").alias("code"),
        F.lit(False).alias("accepted"),
    )
    return emit(accepted.unionByName(rejected))


@query(
    "STM5 PL11 AGG20",
    oracle(
        f"""WITH {RAW_EVENTS}, facts AS (SELECT count(*) AS c FROM raw),
sides AS (SELECT *, pos < floor(c * CAST(0.9 AS DOUBLE)) AS ref FROM raw, facts),
m AS (
  SELECT 'value' AS field, avg(value) FILTER (WHERE ref) AS reference_mean, avg(value) FILTER (WHERE NOT ref) AS current_mean FROM sides
  UNION ALL SELECT 'user_id', avg(user_id) FILTER (WHERE ref), avg(user_id) FILTER (WHERE NOT ref) FROM sides)
SELECT *, abs(reference_mean - current_mean) > 0.1::DOUBLE * abs(reference_mean) AS drifted FROM m""",
        "reference_mean current_mean",
    ),
)
def stream_monitoring(spark: SparkSession, folder: str) -> DataFrame:
    """Figures after the last of ten micro-batches: merged moments of all of them against the fixed reference."""
    both = folds.reference_and_current(views.raw_events(spark, folder), RAW)
    reference, current = (both.filter(F.col("batch") == b) for b in ("reference", "current"))
    path = scratch_path(spark, "drift")
    arriving = _arriving(current, "ts", 10, "current")
    jobs.finish(jobs.monitor(arriving, reference, ["value", "user_id"], path))
    figures = spark.read.parquet(f"{path}/figures")
    last = figures.join(figures.agg(F.max("batch_id").alias("batch_id")), "batch_id")
    return emit(last, "field", "reference_mean", "current_mean", "drifted")


@query(
    "STM6 SNK7",
    oracle(
        f"""WITH {HOURLY},
lagged AS (SELECT series, ts, load, lag(load, 1) OVER w AS l1, lag(load, 24) OVER w AS l24 FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts)),
m AS (SELECT regr_slope(load, l1) AS b, regr_intercept(load, l1) AS a FROM lagged WHERE load IS NOT NULL AND l1 IS NOT NULL)
SELECT series, ts, l24 AS lag_24, a + b * l1 AS prediction FROM lagged, m WHERE load IS NOT NULL AND l1 IS NOT NULL
  AND ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
        "prediction lag_24", digits=4,
    ),
)
def stream_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Raw events in six micro-batches: closed hours, lags from state per series, predictions of a saved model."""
    rows = features.add_lags(views.hourly(spark, folder), SERIES, ["load"], [1]).dropna(subset=["load", "load_lag_1"])
    model = boosted.fit(rows.withColumnRenamed("load_lag_1", "lag_1"), ["lag_1"], boosted.linear("load"))
    events = views.table(spark, folder, "events").select("ts", F.col("event_type").alias("series"), "value")
    hours = jobs.hourly_load(_arriving(events, "ts", 6, "raw"), ["series"], "ts", "value")
    lagged = jobs.lagged_hours(hours, ["series"], "ts", "load", [1, 24, 168])
    path = scratch_path(spark, "scored")
    jobs.finish(jobs.score(lagged.where("lag_1 IS NOT NULL"), model, path))
    return emit(spark.read.parquet(path), "series", "ts", "lag_24", "prediction", digits=4)


@query("STM7 WIN20", oracle("SELECT event_id, value FROM events", "value", "event_id"))
def stream_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice and is kept once."""
    events = views.table(spark, folder, "events").select("event_id", "ts", "value")
    stream = _stream_of(events.unionByName(events), "twice")
    return emit(_collected(jobs.first_seen(stream, ["event_id"], "ts"), "unique"), "event_id", "value")
