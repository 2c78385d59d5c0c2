"""Alert rules, their evaluation on metric tables, and alert history."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from wattlane.functions.conditions import holds

RULE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("operator", T.StringType(), False),
        T.StructField("threshold", T.DoubleType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("enabled", T.BooleanType(), False),
        T.StructField("seq", T.IntegerType(), False),
    ]
)

# The default rules (name, metric, operator, threshold, severity, description).
DEFAULT_RULES = (
    ("High Peak Demand Error", "peak_demand.peak_mape", ">", 15.0, "error",
     "Peak demand forecast error exceeds 15%"),
    ("Low Model Accuracy", "mae", ">", 300.0, "warning", "Model MAE exceeds acceptable threshold"),
    ("Data Drift Detected", "data_drift.drift_score", ">", 0.05, "warning", "Significant data drift detected"),
    ("Low Reliability Score", "forecast_reliability.reliability_score", "<", 70.0, "warning",
     "Forecast reliability score below 70%"),
    ("High Business Impact", "business_impact.business_impact_score", "<", 80.0, "error",
     "Business impact score below 80%"),
    ("Low Renewable Penetration", "renewable_contribution.renewable_penetration", "<", 20.0, "info",
     "Renewable energy penetration below 20%"),
)
# Fixed value: the rule that the configured set has on top of the default set.
CONFIGURED_RULES = DEFAULT_RULES + (
    ("Critical Model Degradation", "r2_score", "<", 0.5, "critical", "Model R² score critically low"),
)
# Thresholds of the monitoring cycle as rules.
CYCLE_RULES = (
    ("Data drift", "data_drift.drift_detected", ">", 0.5, "warning", "Data drift detected"),
    ("Performance degraded", "mae", ">", 1000.0, "error", "Model performance degraded"),
    ("Low R2", "r2_score", "<", 0.7, "error", "Model R² score below threshold"),
)


def rules_table(spark: SparkSession, rules: Iterable[Sequence] = DEFAULT_RULES) -> DataFrame:
    rows = [(*r[:4], r[4].lower(), *r[5:6], True, i) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def rules_from_records(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """Rules from configuration records; severity, description and enabled have defaults."""
    rows = [
        (r["name"], r["metric"], r["condition"], float(r["threshold"]), r.get("severity", "warning").lower(),
         r.get("description", ""), bool(r.get("enabled", True)), i)
        for i, r in enumerate(records)
    ]
    return add_rules(spark.createDataFrame([], RULE_SCHEMA), spark.createDataFrame(rows, RULE_SCHEMA))


def add_rules(rules: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by name: of several rules with one name the last stands."""
    merged = rules.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    last = Window.partitionBy("name").orderBy(F.col("_gen").desc(), F.col("seq").desc())
    return merged.withColumn("_r", F.row_number().over(last)).filter("_r = 1").drop("_r", "_gen")


def remove_rule(rules: DataFrame, name: str) -> DataFrame:
    return rules.filter(F.col("name") != name)


def evaluate(metrics: DataFrame, rules: DataFrame, run: Sequence[str] = ("run_ts",)) -> DataFrame:
    """Alerts: rows of the long metric table that break an enabled rule on their metric.

    The rules table has a handful of rows written by hand, so the optimizer broadcasts it by size.
    """
    active = rules.filter("enabled").select(
        "metric", F.col("name").alias("rule_name"), "operator", "threshold", "severity", "description"
    )
    joined = metrics.filter(F.col("value").isNotNull()).join(active, "metric")
    return joined.filter(holds(F.col("value"), F.col("operator"), F.col("threshold"))).select(
        *run, "rule_name", "metric", "value", "operator", "threshold", "severity", "description"
    )


def number_text(value: Column) -> Column:
    return F.format_string("%.4f", value)


def condition_text() -> Column:
    return F.concat_ws(" ", F.col("operator"), F.col("threshold").cast("string"))


def with_message(alerts: DataFrame, run: str = "run_ts", style: str = "text") -> DataFrame:
    """Add ``condition`` and ``message``; ``style`` is ``text`` or ``html``.

    The wording, the labels and the four decimals are fixed values.
    """
    when = F.date_format(run, "yyyy-MM-dd'T'HH:mm:ss") if run in alerts.columns else F.lit(None).cast("string")
    described = F.when(F.col("description") != "", F.col("description"))
    labelled = [
        ("Metric: ", F.col("metric")),
        ("Value: ", number_text(F.col("value"))),
        ("Condition: ", condition_text()),
        ("Severity: ", F.col("severity")),
        ("", described),
        ("Time: ", when),
    ]
    # concat gives NULL for a missing part and concat_ws leaves that line out.
    if style == "text":
        lines = [F.concat(F.lit(f"  {label}"), value) for label, value in labelled]
        text = F.concat_ws("\n", F.concat(F.lit("• *"), F.col("rule_name"), F.lit("*")), *lines)
    elif style == "html":
        lines = [F.concat(F.lit(label), value) for label, value in labelled]
        title = F.concat(F.lit("<strong>"), F.col("rule_name"), F.lit("</strong>"))
        text = F.concat(F.lit("<li>"), F.concat_ws("<br>", title, *lines), F.lit("</li>"))
    else:
        raise ValueError(f"unknown message style: {style}")
    return alerts.withColumn("condition", condition_text()).withColumn("message", text)


def digest(alerts: DataFrame, run: str = "run_ts", by: Sequence[str] = ()) -> DataFrame:
    """One text per run and severity.  A run has at most one alert per rule, so groups stay small."""
    lines = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rule_name", "message"))), lambda x: x["message"]
        ),
        "\n\n",
    )
    return with_message(alerts, run).groupBy(*by, run, "severity").agg(
        lines.alias("text"), F.count(F.lit(1)).alias("alerts")
    )


def trigger_counts(alerts: DataFrame, run: str = "run_ts") -> DataFrame:
    """How often each rule fired and when last."""
    return alerts.groupBy("rule_name").agg(
        F.count(F.lit(1)).alias("trigger_count"), F.max(run).alias("last_triggered")
    )


def number_triggers(alerts: DataFrame, run: str = "run_ts", by: Sequence[str] = ()) -> DataFrame:
    """Running count of each rule's alerts (per group in ``by``).

    Counts per day are accumulated first, so the window inside a day is the only one that sees
    alert rows.
    """
    rule = [*by, "rule_name"]
    day = F.to_date(run)
    daily = alerts.groupBy(*rule, day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*rule).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = daily.select(*rule, "_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(*rule, "_day").orderBy(run)
    return (
        alerts.withColumn("_day", day)
        .withColumn("_i", F.row_number().over(inside))
        .join(offsets, [*rule, "_day"])
        .withColumn("trigger_count", F.col("_i") + F.col("_o"))
        .drop("_day", "_i", "_o")
    )


def newest(alerts: DataFrame, keep: int = 1000, run: str = "run_ts", tie: Sequence[str] = ("rule_name",)) -> DataFrame:
    """The alert log holds the last ``keep`` alerts."""
    return alerts.orderBy(F.col(run).desc(), *tie).limit(keep)


def since(alerts: DataFrame, now: Column, hours: int = 24, run: str = "run_ts") -> DataFrame:
    return alerts.filter(F.col(run) > now - F.make_dt_interval(hours=F.lit(hours)))


def summary(alerts: DataFrame, now: Column, hours: int = 24, run: str = "run_ts") -> DataFrame:
    """Alerts per severity, in total and in the last hours."""
    recent = F.col(run) > now - F.make_dt_interval(hours=F.lit(hours))
    return alerts.groupBy("severity").agg(
        F.count(F.lit(1)).alias("alerts"), F.count_if(recent).alias("recent_alerts")
    )


def metric_at(payload: Column, path: str) -> Column:
    """Number at a dotted path of a JSON text; NULL where the path leads nowhere."""
    return F.get_json_object(payload, "$." + path).try_cast("double")


def flatten_metrics(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long metric table from a nested struct of numbers, with dotted names."""

    def leaves(kind: T.StructType, at: Column, path: str) -> list[Column]:
        out = []
        for f in kind.fields:
            name = f"{path}.{f.name}" if path else f.name
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, at[f.name], name)
            elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
                out.append(F.struct(F.lit(name).alias("metric"), at[f.name].cast("double").alias("value")))
        return out

    cells = leaves(df.schema[column].dataType, F.col(column), "")
    return df.select(*keep, F.inline(F.array(*cells)))
