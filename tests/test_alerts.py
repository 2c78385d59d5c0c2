import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlane.operators import alerts, drift, kpi

NOW = dt.datetime(2024, 1, 2)


def metric_table(spark, values):
    return spark.createDataFrame([(NOW, m, v) for m, v in values.items()], "run_ts timestamp, metric string, value double")


def test_default_rules_on_the_sample_metrics(spark):
    table = metric_table(spark, {
        "mae": 250.0, "peak_demand.peak_mape": 12.0, "data_drift.drift_score": 0.03,
        "forecast_reliability.reliability_score": 85.0, "business_impact.business_impact_score": 75.0,
        "renewable_contribution.renewable_penetration": 25.0,
    })
    fired = alerts.evaluate(table, alerts.rules_table(spark)).collect()
    assert [r["rule_name"] for r in fired] == ["High Business Impact"]


@pytest.mark.parametrize("mae,r2,drifted,names", [
    (50.0, 0.9, 0.0, set()), (1500.0, 0.9, 0.0, {"Performance degraded"}),
    (50.0, 0.5, 1.0, {"Low R2", "Data drift"}), (None, None, 0.0, set()),
])
def test_cycle_rules(spark, mae, r2, drifted, names):
    table = metric_table(spark, {"mae": mae, "r2_score": r2, "data_drift.drift_detected": drifted})
    fired = alerts.evaluate(table, alerts.rules_table(spark, alerts.CYCLE_RULES)).collect()
    assert {r["rule_name"] for r in fired} == names


def test_rule_sets(spark):
    assert len(alerts.DEFAULT_RULES) == 6 and len(alerts.CONFIGURED_RULES) == 7
    rules = alerts.rules_from_records(spark, [
        {"name": "a", "metric": "m", "condition": ">", "threshold": 1, "severity": "ERROR"},
        {"name": "a", "metric": "m", "condition": "<", "threshold": 2, "enabled": False},
        {"name": "b", "metric": "m", "condition": ">", "threshold": 0},
    ])
    kept = {r["name"]: r for r in rules.collect()}
    assert kept["a"]["operator"] == "<" and not kept["a"]["enabled"] and kept["b"]["severity"] == "warning"
    assert [r["rule_name"] for r in alerts.evaluate(metric_table(spark, {"m": 1.0}), rules).collect()] == ["b"]
    assert alerts.remove_rule(rules, "b").count() == 1


def test_numbering_spans_days(spark):
    data = [("r", NOW + dt.timedelta(hours=7 * i)) for i in range(10)]
    df = spark.createDataFrame(data, "rule_name string, run_ts timestamp")
    assert [r["trigger_count"] for r in alerts.number_triggers(df).orderBy("run_ts").collect()] == list(range(1, 11))


def test_message(spark):
    rows = alerts.evaluate(metric_table(spark, {"mae": 412.34567}), alerts.rules_table(spark))
    text = alerts.with_message(rows).first()["message"]
    assert "412.3457" in text and "Condition: > 300.0" in text and "Low Model Accuracy" in text


def test_json_paths(spark):
    df = spark.createDataFrame([('{"a": {"b": 2.5}, "c": "x"}',)], "p string")
    row = df.select(*[alerts.metric_at(F.col("p"), path).alias(path.replace(".", "_")) for path in ("a.b", "a.z", "c", "a.b.q")]).first()
    assert tuple(row) == (2.5, None, None, None)


def test_drift_of_a_shifted_copy(spark):
    ref = spark.range(100).select((1000 + F.sin("id") * 50).alias("load"), (15 + F.cos("id")).alias("temp"), F.lit(60.0).alias("hum"))
    cur = ref.select((F.col("load") * 1.05).alias("load"), (F.col("temp") + 2).alias("temp"), "hum")
    shift = drift.mean_shift(ref, cur, ["load", "temp", "hum"])
    assert {r["field"]: r["drifted"] for r in shift.collect()} == {"load": False, "temp": True, "hum": False}
    score = drift.drift_score(shift).first()
    assert score["drift_detected"] and score["drift_score"] == pytest.approx(0.1)
    assert drift.ks_test(ref, cur, "temp").first()["drifted"]
    same = drift.ks_test(ref, ref, "temp").first()
    assert same["statistic"] == 0.0 and same["p_value"] == 1.0


def test_quality_score(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "a double, b double")
    assert drift.quality_score(drift.missing_shares(df)).first()["data_quality_score"] == pytest.approx(0.95)


def test_business_impact(spark):
    df = spark.createDataFrame([(100.0, 90.0), (100.0, 120.0)], "actual double, prediction double")
    row = kpi.business_impact(df).first()
    assert row["total_error_cost"] == pytest.approx(30 * 0.12)
    assert row["under_forecast_cost"] == pytest.approx(10 * 0.12 * 1.5)
    assert row["over_forecast_cost"] == pytest.approx(20 * 0.12 * 0.3)
    assert row["business_impact_score"] == pytest.approx(85.0)
