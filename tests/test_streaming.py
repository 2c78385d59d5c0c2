"""Streaming specifics that one pass over a file does not show."""

import datetime as dt

from wattlane.streaming import jobs


def write(spark, path, rows):
    spark.createDataFrame(rows, "id long, ts timestamp, x double").coalesce(1).write.mode("append").parquet(path)


def test_rows_behind_the_watermark_are_ignored(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    start = dt.datetime(2024, 1, 1)
    write(spark, source, [(1, start, 1.0), (2, start + dt.timedelta(hours=5), 1.0)])
    stream = lambda: jobs.hourly_load(
        jobs.read_parquet_stream(spark, source, spark.read.parquet(source).schema), [], "ts", "x"
    )
    jobs.finish(jobs.to_table(stream(), out, checkpoint=state))
    write(spark, source, [(3, start + dt.timedelta(minutes=10), 100.0), (4, start + dt.timedelta(hours=9), 1.0)])
    jobs.finish(jobs.to_table(stream(), out, checkpoint=state))
    got = {r["ts"].hour: r["load"] for r in spark.read.parquet(out).collect()}
    assert got == {0: 1.0, 5: 1.0}


def test_a_restart_continues_after_the_last_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    start = dt.datetime(2024, 1, 1)
    write(spark, source, [(1, start, 1.0), (1, start, 1.0)])
    schema = spark.read.parquet(source).schema
    for extra in ([], [(1, start, 1.0), (2, start, 2.0)]):
        if extra:
            write(spark, source, extra)
        unique = jobs.first_seen(jobs.read_parquet_stream(spark, source, schema), ["id"], "ts")
        jobs.finish(jobs.to_table(unique, out, checkpoint=state))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(hour, minute=30):
    return START + dt.timedelta(hours=hour, minutes=minute)


def test_alerts_open_repeat_clear_and_expire_across_restarts(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rules = spark.createDataFrame(
        [("high", "x", ">", 10.0, "warning", True)],
        "name string, metric string, operator string, threshold double, severity string, enabled boolean")
    # Broken in hours 0-3, well in 4, broken in 5, silent until 40; 60 only moves the watermark.
    parts = [[(0, 11.0), (0, 12.0), (1, 20.0)], [(2, 11.0), (3, 50.0)], [(4, 1.0), (5, 99.0)], [(40, 1.0), (60, 1.0)]]
    for part in parts:
        write(spark, source, [(h, at(h), x) for h, x in part])
        figures = jobs.read_parquet_stream(spark, source, spark.read.parquet(source).schema).selectExpr(
            "ts", "'x' AS metric", "x AS value")
        states = jobs.alert_states(jobs.breaches(figures, rules, "ts"), "ts", cool_down_hours=2)
        jobs.finish(jobs.to_table(states, out, checkpoint=state, processors=True))
    hours = lambda t: int((t.replace(tzinfo=dt.timezone.utc) - START).total_seconds() // 3600)
    got = sorted((hours(r["ts"]), r["event"], hours(r["opened"]), r["broken"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, "opened", 0, 2), (2, "repeated", 0, 4), (4, "cleared", 0, 5), (5, "opened", 5, 1), (29, "expired", 5, 1)]


def test_lags_come_from_state_across_restarts_and_only_from_the_hour_asked_for(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in ([(0, 1.0), (1, 2.0)], [(2, 4.0), (24, 8.0)], [(170, 16.0), (192, 32.0), (400, 0.0)]):
        write(spark, source, [(h, at(h), x) for h, x in part])
        events = jobs.read_parquet_stream(spark, source, spark.read.parquet(source).schema).selectExpr(
            "ts", "x", "'s' AS series")
        lagged = jobs.lagged_hours(jobs.hourly_load(events, ["series"], "ts", "x"), ["series"], "ts", "load", [1, 24, 168])
        jobs.finish(jobs.to_table(lagged, out, checkpoint=state, processors=True))
    got = sorted((r["load"], r["lag_1"], r["lag_24"], r["lag_168"]) for r in spark.read.parquet(out).collect())
    assert got == [(1.0, None, None, None), (2.0, 1.0, None, None), (4.0, 2.0, None, None), (8.0, None, 1.0, None),
                   (16.0, None, None, 4.0), (32.0, None, None, 8.0)]


def test_moments_of_batches_and_restarts_are_those_of_one_pass(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    values = [1e9 + v for v in (1.0, 4.0, 9.0)], [None, 1e9 + 16.0], [None]
    reference = spark.createDataFrame([(1e9 + 1.0,), (1e9 + 3.0,), (None,)], "x double")
    for part in values:
        write(spark, source, [(1, at(0), x) for x in part])
        arriving = jobs.read_parquet_stream(spark, source, spark.read.parquet(source).schema, per_trigger=1)
        jobs.finish(jobs.monitor(arriving, reference, ["x"], out, checkpoint=state))
    figures = spark.read.parquet(f"{out}/figures").orderBy("batch_id").collect()
    assert [r["current_n"] for r in figures] == [3, 4, 4]
    assert figures[-1]["current_mean"] == 1e9 + 7.5 and figures[-1]["current_missing"] == 2 / 6
    assert abs(figures[-1]["current_std"] - 5.678908345800274) < 1e-6
    assert figures[-1]["reference_std"] == 1.0 and not figures[-1]["drifted"]
