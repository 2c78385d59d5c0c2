"""JSON sources: record files, request envelopes and evaluation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattlane.functions.time import parse_time

FOLD = T.StructType(
    [T.StructField("fold", T.LongType()), *[T.StructField(m, T.DoubleType()) for m in ("mae", "mse", "rmse", "mape", "r2")]]
)
REPORT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "model_comparison",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("cv_metrics", T.StructType([T.StructField("walk_forward", T.ArrayType(FOLD))])),
                        T.StructField("statistical_tests", T.MapType(T.StringType(), T.BooleanType())),
                    ]
                ),
            ),
        ),
        T.StructField("best_model", T.StringType()),
        T.StructField(
            "summary",
            T.StructType(
                [T.StructField("total_models_evaluated", T.LongType()), T.StructField("best_model", T.StringType())]
            ),
        ),
    ]
)


def load_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None, lines: bool = False
) -> DataFrame:
    """Landed JSON files: each a list of records, or one record per line (which Spark can split)."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def load_envelopes(spark: SparkSession, path: str, record: T.StructType, time_column: str = "time") -> DataFrame:
    """Payload files that hold a list of records or ``{"data": [...]}``; one request per file.

    Files that are neither raise when read.
    """
    return open_envelopes(spark.read.text(path, wholetext=True), record, time_column)


def open_envelopes(payloads: DataFrame, record: T.StructType, time_column: str = "time") -> DataFrame:
    """Records of payload texts in column ``value``."""
    listed = F.from_json("value", T.ArrayType(record))
    wrapped = F.from_json("value", T.StructType([T.StructField("data", T.ArrayType(record))]))["data"]
    is_list = F.ltrim("value").startswith("[")
    records = F.when(is_list, listed).otherwise(wrapped)
    checked = F.when(records.isNotNull(), records).otherwise(F.raise_error(F.lit("invalid payload")))
    rows = payloads.select(F.inline(checked))
    if time_column in record.names:
        return rows.withColumn(time_column, parse_time(F.col(time_column)))
    return rows


def load_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).json(path, multiLine=True)


def report_folds(reports: DataFrame) -> DataFrame:
    """One row per model and fold."""
    models = reports.select("timestamp", F.explode("model_comparison").alias("model", "result"))
    return models.select("timestamp", "model", F.inline("result.cv_metrics.walk_forward"))


def report_tests(reports: DataFrame) -> DataFrame:
    """One row per model with its map of test flags."""
    models = reports.select(F.explode("model_comparison").alias("model", "result"))
    return models.select("model", F.col("result.statistical_tests").alias("tests"))
