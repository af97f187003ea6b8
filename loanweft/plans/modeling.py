"""Labeled table to modeling base, feature types and time splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanweft.functions.checks import enforce, require_columns
from loanweft.operators.governance import (
    enforce_catalog, identifier_columns, modeling_columns, names, selected_columns, selection_report,
    selection_violations, target_columns, time_split_columns)
from loanweft.operators.profile import feature_type_profile, missingness_profile
from loanweft.operators.quality import enforce_labeled_table
from loanweft.operators.splits import add_parsed_month, enforce_parsed_months, fit_time_split, split_summary
from loanweft.session import materialize
from loanweft.sources.readers import read_columns, read_projection
from loanweft.sources.writers import write_report, write_splits, write_table


def build_modeling_base(spark: SparkSession, labeled_path: str, catalog: DataFrame, path: str,
                        report_path: str | None = None) -> DataFrame:
    """G14. Checked projection of the labeled table; every check on names comes before the scan."""
    catalog = materialize(catalog, "catalog")
    enforce_catalog(catalog)
    enforce(selection_violations(catalog, read_columns(spark, labeled_path)), "column selection")
    order = selected_columns(catalog).orderBy("modeling_base_column_order").collect()
    base = read_projection(spark, labeled_path, [row.column_name for row in order])
    target = names(target_columns(catalog))[0]
    enforce_labeled_table(base.select(target), target, both_classes=False)
    written = write_table(base, path)
    if report_path:
        write_report(selection_report(catalog), report_path)
    return written.select(*base.columns)


def feature_type_reports(spark: SparkSession, base_path: str, catalog: DataFrame, folder: str) -> DataFrame:
    """A19. Feature-type and missingness profile of the approved columns."""
    catalog = materialize(catalog, "catalog")
    enforce_catalog(catalog)
    features = names(modeling_columns(catalog))
    key = names(identifier_columns(catalog))[0]
    base = read_projection(spark, base_path, [key, *features])
    profile = write_table(feature_type_profile(base, features, key), f"{folder}/feature_type_profile_table")
    write_report(profile, f"{folder}/feature_type_profile")
    write_report(missingness_profile(profile), f"{folder}/missingness_profile")
    return profile


def build_splits(spark: SparkSession, base_path: str, catalog: DataFrame, path: str, report_path: str | None = None,
                 whole_months: bool = False, **fractions: float) -> DataFrame:
    """W1, S10, A21. Time splits of the modeling base as one table with a folder per split."""
    catalog = materialize(catalog, "catalog")
    date, target = names(time_split_columns(catalog))[0], names(target_columns(catalog))[0]
    key = names(identifier_columns(catalog))[0]
    base = spark.read.parquet(base_path)
    require_columns(base, [*names(modeling_columns(catalog)), date, target], base_path)
    dated = add_parsed_month(base, date)
    enforce_parsed_months(dated, date)
    split = fit_time_split(dated, "issue_month", key, whole_months=whole_months, **fractions)
    # the month stays in the table: later steps order by it
    written = write_splits(split.apply(dated), path, temporary=())
    if report_path:
        write_report(split_summary(written, target=target), report_path)
    return written
