"""Tables, reports and fitted models out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError, require_columns
from loanweft.operators.position import Order, row_positions
from loanweft.session import literal_table, materialize

MODEL_KINDS: Mapping[str, type[MLReadable]] = {
    "pipeline": PipelineModel, "logistic": LogisticRegressionModel, "isotonic": IsotonicRegressionModel}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """S9, S11. Parquet table; returns it as read back."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_splits(df: DataFrame, path: str, temporary: Sequence[str] = ("issue_month",),
                 split: str = "modeling_split") -> DataFrame:
    """S10. One table with a folder per split, temporary columns dropped."""
    require_columns(df, [split])
    return write_table(df.drop(*[name for name in temporary if name != split]), path, [split])


def write_report(df: DataFrame, path: str, file_format: str = "csv", allow_empty: bool = False,
                 compression: str | None = None) -> None:
    """S11. A report as one CSV or Parquet file, its rows in the order of ``df``.

    Reports are aggregated, so one file is enough. Rows are numbered while they
    are in order, and the one file is sorted by that number.
    """
    seen = Observation()  # counts the rows while they are computed, once
    numbered = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("_line", F.monotonically_increasing_id())
    report = materialize(numbered, "report")
    if not allow_empty and not seen.get["rows"]:
        raise DataCheckError(f"report for {path} has no rows")
    writer = report.coalesce(1).sortWithinPartitions("_line").drop("_line").write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if file_format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_numbered_report(df: DataFrame, orders: Sequence[Order], path: str, line: str = "line", allow_empty: bool = False) -> None:
    """S11 for reports that grow with the data: CSV in as many files as tasks, each row with its line from 0.

    ``orders`` must tell all rows apart. The order is in the lines, so the report
    is written and read in parallel, and no task sees all of it.
    """
    seen = Observation()
    numbered = row_positions(df, orders, name=line)
    numbered.select((F.col(line) - 1).alias(line), *df.columns).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "header", True).csv(path)
    if not allow_empty and not seen.get["rows"]:
        raise DataCheckError(f"report for {path} has no rows")


def write_features(df: DataFrame, names: Sequence[str], path: str, names_path: str,
                   split: str = "modeling_split") -> DataFrame:
    """S12. Keyed vectors and labels by split, and the slot names."""
    listed = literal_table(df.sparkSession, list(enumerate(names)), "slot int, feature_name string")
    write_report(listed, names_path, "parquet")
    return write_table(df, path, [split])


def write_comparison_reports(reports: Mapping[str, DataFrame], folder: str, file_format: str = "csv") -> None:
    """S13. Each report under its name."""
    for name, report in reports.items():
        write_report(report, f"{folder}/{name}", file_format)


def save_model(model: MLWritable, path: str) -> None:
    """S14."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str, kind: str):
    """S14. A fitted pipeline, logistic model or isotonic calibrator; a logistic model must know two classes."""
    if kind not in MODEL_KINDS:
        raise ValueError(f"kind must be one of {sorted(MODEL_KINDS)}")
    model = MODEL_KINDS[kind].load(path)
    if kind == "logistic" and model.numClasses != 2:
        raise DataCheckError("the model must know exactly two classes")
    return model
