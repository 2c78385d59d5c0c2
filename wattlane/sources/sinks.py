"""Writers for batches, reports, histories and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattlane.operators import metrics


def write_batches(df: DataFrame, path: str, fmt: str = "parquet", batch: str = "batch") -> None:
    """Reference and current rows, one folder each; the time column stays in the files."""
    writer = df.write.mode("overwrite").partitionBy(batch)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def build_report(folds: DataFrame, now: Column, tests: DataFrame | None = None) -> DataFrame:
    """One row with the nested evaluation report: every model's folds, the best model, a summary.

    A report lists fold metrics, not data rows; its size is models times folds.
    """
    fold = F.struct("fold", *metrics.METRICS)
    per_model = folds.groupBy("model").agg(F.sort_array(F.collect_list(fold)).alias("walk_forward"))
    if tests is not None:
        per_model = per_model.join(tests, "model", "left").withColumnRenamed("tests", "statistical_tests")
    else:
        per_model = per_model.withColumn("statistical_tests", F.lit(None).cast("map<string,boolean>"))
    entry = F.struct(
        "model",
        F.struct(F.struct("walk_forward").alias("cv_metrics"), F.col("statistical_tests")).alias("result"),
    )
    best = metrics.best_by_error(metrics.fold_summary(folds)).select("best_model").scalar()
    return (
        per_model.agg(F.map_from_entries(F.collect_list(entry)).alias("model_comparison"))
        .withColumn("best_model", best)
        .select(
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            "model_comparison",
            "best_model",
            F.struct(F.size("model_comparison").alias("total_models_evaluated"), "best_model").alias("summary"),
        )
    )


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def append_history(folds: DataFrame, path: str, run_id: str, run_ts: Column) -> None:
    """Fold metrics of one run under ``run_id=...``; a repeated run replaces its own folder only."""
    folds.withColumn("run_ts", run_ts).write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def history_index(history: DataFrame) -> DataFrame:
    """One row per run: time, best model and its MAE, models evaluated."""
    per_model = history.groupBy("run_id", "run_ts", "model").agg(F.avg("mae").alias("_mae"))
    return per_model.groupBy("run_id", "run_ts").agg(
        F.min_by("model", F.struct("_mae", "model")).alias("best_model"),
        F.min("_mae").alias("best_mae"),
        F.count(F.lit(1)).alias("models_evaluated"),
    )


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the newest run."""
    newest = history.agg(F.max_by("run_id", F.struct("run_ts", "run_id")).alias("r"))
    return history.filter(F.col("run_id") == newest.scalar())


def write_csv(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """CSV export of a summary table."""
    rows = df.orderBy(*order) if order else df
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_importances(table: DataFrame, path: str) -> None:
    write_csv(table, path, [F.desc("importance"), F.col("feature")])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_parameters(params: DataFrame, path: str) -> None:
    """Scaler parameters and the like."""
    params.write.mode("overwrite").parquet(path)


def load_parameters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
