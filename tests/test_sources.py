"""Readers and writers on files written by the test."""

import pytest
from pyspark.sql import functions as F, types as T

from wattlane.operators import boosted
from wattlane.sources import documents, schemas, sinks, tabular


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_energy_csv(spark, tmp_path):
    path = write(tmp_path, "e.csv", "time,generation biomass,Generation Fossil-Gas,extra\n2024-01-01 00:00:00,100,200,x\n2024-01-01 01:00:00,110,NaN,y\n")
    out = tabular.load_csv(spark, path, schemas.ENERGY)
    assert out.rejected.count() == 0
    assert out.good.columns == schemas.ENERGY.names
    got = out.good.orderBy("time").select("generation_biomass", "generation_fossil_gas", "price_actual").collect()
    assert [tuple(r) for r in got] == [(100.0, 200.0, None), (110.0, None, None)]


def test_missing_required_field(spark, tmp_path):
    path = write(tmp_path, "bad.csv", "time,generation_biomass\n,100\n")
    out = tabular.load_csv(spark, path, schemas.ENERGY)
    assert (out.good.count(), out.rejected.count()) == (0, 1)


def test_weather_csv(spark, tmp_path):
    path = write(tmp_path, "w.csv", "dt_iso;city_name;temp;weather_id\n2024-01-01 00:00:00+00:00;Madrid;15.0;800\n")
    row = tabular.load_weather(spark, path).first()
    assert (row["city_name"], row["temp"], row["weather_id"]) == ("Madrid", 15.0, 800)


def test_empty_and_narrow_files(spark, tmp_path):
    with pytest.raises(ValueError):
        tabular.load_csv(spark, write(tmp_path, "one.csv", "time\n2024\n"), schemas.ENERGY)
    out = tabular.load_csv(spark, write(tmp_path, "head.csv", "time,total_load_actual\n"), schemas.ENERGY)
    assert (out.good.count(), out.rejected.count()) == (0, 0)


def test_every_valid_row_is_kept(spark, tmp_path):
    lines = ["time,total_load_actual"]
    for i in range(25):
        lines.append(f"t{i},{'oops' if i in (3, 10, 18, 20) else i}")
    path = write(tmp_path, "b.csv", "\n".join(lines) + "\n")
    out = tabular.load_csv(spark, path, schemas.ENERGY)
    assert sorted(r["time"] for r in out.good.collect()) == sorted(f"t{i}" for i in range(25) if i not in (3, 10, 18, 20))
    assert out.rejected.count() == 4
    with pytest.raises(ValueError, match="4 of 25"):
        tabular.load_csv(spark, path, schemas.ENERGY, max_bad_share=0.1)


def test_numbers_are_text_too(spark, tmp_path):
    out = tabular.load_csv(spark, write(tmp_path, "n.csv", "time,total_load_actual\n1,2\n2,3\n"), schemas.ENERGY)
    assert out.good.count() == 2


def test_integers(spark, tmp_path):
    body = "dt_iso,city_name,weather_id\n" + "".join(f"2024-01-{i:02d} x,c,800.0\n" for i in range(1, 11)) + "2024-02-01 x,c,800.5\n"
    out = tabular.load_csv(spark, write(tmp_path, "i.csv", body), schemas.WEATHER)
    assert out.good.count() == 10 and out.rejected.count() == 1


def test_envelopes(spark, tmp_path):
    record = T.StructType([T.StructField("time", T.StringType()), T.StructField("v", T.DoubleType())])
    folder = tmp_path / "payloads"
    folder.mkdir()
    (folder / "a.json").write_text('[{"time": "2024-01-01 00:00:00", "v": 1}]')
    (folder / "b.json").write_text('{"data": [{"time": "2024-01-01 01:00:00", "v": 2}, {"time": "bad", "v": 3}]}')
    got = documents.load_envelopes(spark, str(folder), record).orderBy("v").collect()
    assert [r["v"] for r in got] == [1.0, 2.0, 3.0] and got[2]["time"] is None
    (folder / "c.json").write_text('{"rows": []}')
    with pytest.raises(Exception, match="invalid payload"):
        documents.load_envelopes(spark, str(folder), record).collect()


def test_record_list(spark, tmp_path):
    path = write(tmp_path, "api.json", '[{"key": "value"}]')
    assert documents.load_records(spark, path).first()["key"] == "value"


def test_report_round_trip(spark, tmp_path):
    folds = spark.createDataFrame(
        [("a", 0, 1.0, 1.0, 1.0, 1.0, 0.5), ("a", 1, 3.0, 9.0, 3.0, 3.0, 0.1), ("b", 0, 5.0, 25.0, 5.0, 5.0, 0.0)],
        "model string, fold long, mae double, mse double, rmse double, mape double, r2 double",
    )
    path = str(tmp_path / "report")
    sinks.write_report(sinks.build_report(folds, F.lit("2024-01-01").cast("timestamp")), path)
    report = documents.load_reports(spark, path)
    row = report.first()
    assert row["best_model"] == "a" and row["summary"]["total_models_evaluated"] == 2
    assert documents.report_folds(report).count() == 3


def test_reference_sample_takes_a_range(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' + make_dt_interval(0, CAST(id AS INT)) AS ts, IF(id = 5, NULL, id) AS y FROM range(48)")
    assert tabular.reference_sample(df, "ts", "y", "2024-01-01", "2024-01-02").count() == 23
    assert tabular.reference_sample(df, "ts", "y", "2030-01-01", "2030-01-02").count() == 0


def test_model_round_trip(spark, tmp_path):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    path = str(tmp_path / "model")
    sinks.save_model(boosted.fit(df, ["x"], boosted.linear("y")), path)
    row = boosted.predict(sinks.load_model(path), df).filter("x = 10").first()
    assert row["prediction"] == pytest.approx(21.0)
