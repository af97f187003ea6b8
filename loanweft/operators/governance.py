"""Which columns a model may use: tables about columns, one row per column.

These tables have as many rows as the data has columns, so they may be joined,
numbered and listed freely. Only the profile they start from reads the data:
write it once (``materialize``) before it is checked from several sides.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanweft.functions.checks import (
    DataCheckError, duplicate_values, enforce, require_columns, union_violations, violations)
from loanweft.functions.text import (
    has_repeated_items, normalize_list, parse_list, starts_with_any, strip, unknown_items)
from loanweft.operators.features import FeatureColumns
from loanweft.session import literal_table, materialize

# The vocabulary of the catalog.
PURPOSES = (
    "modeling",
    "monitoring",
    "target",
    "target_source",
    "identifier",
    "lender_derived_feature",
    "conditionally_available",
    "high_cardinality_or_text",
    "post_application_leakage",
    "constant_or_empty",
    "exclude_from_model_features",
)
USE_CASES = (
    "benchmarking",
    "data_quality_check",
    "portfolio_monitoring",
    "portfolio_segmentation",
    "reporting",
    "time_split",
)
EXCLUDED_PURPOSES = tuple(purpose for purpose in PURPOSES if purpose != "modeling")

# Automatic purposes and uses.
ROLE_PURPOSES = (
    ("target", "target"),
    ("target_source", "target_source"),
    ("identifier", "identifier"),
    ("monitoring_only", "monitoring"),
    ("post_application_leakage", "post_application_leakage"),
    ("constant_or_empty", "constant_or_empty"),
)
AUTOMATIC_USES = (
    ("bad_loan", "portfolio_monitoring,reporting"),
    ("loan_status", "portfolio_monitoring,reporting"),
    ("id", "data_quality_check"),
    ("issue_d", "portfolio_segmentation,reporting,time_split"),
)

# Action and reason per role, as the reports show them.
ROLE_ACTIONS = (
    ("target", "retain_as_target", "Outcome variable used for supervised modeling."),
    ("target_source", "exclude_from_model_features",
     "Source column used to construct the target. Exclude to prevent direct target leakage."),
    ("identifier", "exclude_from_model_features",
     "Record identifier or record-level reference. Not suitable as a model feature. "),
    ("monitoring_only", "retain_for_monitoring",
     "Retain for portfolio monitoring or cohort analysis, but do not automatically use as a model feature."),
    ("post_application_leakage", "exclude_from_model_features",
     "Contains information generated after loan issuance or during repayment performance. "
     "Exclude to prevent leakage."),
    ("constant_or_empty", "exclude_from_model_features",
     "Column is empty or contains no meaningful variation. Exclude from model features. "),
    ("requires_review", "requires_review",
     "No obvious automatic classification applies. Review manually before deciding feature eligibility. "),
)

NUMERIC_TYPES = ("numeric_continuous", "numeric_discrete_or_count")
CATEGORICAL_TYPES = ("binary_or_two_value", "categorical_low_cardinality")
# the last two are what type inference calls the members of the problem group
EXCLUDED_TYPES = ("categorical_high_cardinality_or_text", "date_like", "problem_column", "all_missing", "constant")


@dataclass(frozen=True)
class RoleRules:
    """Names and prefixes behind the preliminary roles, first match wins."""

    target: Sequence[str] = ("bad_loan",)
    target_source: Sequence[str] = ("loan_status",)
    identifier: Sequence[str] = ("id", "url")
    monitoring_only: Sequence[str] = ("issue_d",)
    # Columns filled after the loan was granted.
    leakage: Sequence[str] = (
        "recoveries",
        "collection_recovery_fee",
        "total_pymnt",
        "total_pymnt_inv",
        "total_rec_prncp",
        "total_rec_int",
        "total_rec_late_fee",
        "last_pymnt_d",
        "last_pymnt_amnt",
        "next_pymnt_d",
        "out_prncp",
        "out_prncp_inv",
        "last_fico_range_low",
        "last_fico_range_high",
        "last_credit_pull_d",
        "payment_plan_start_date",
        "debt_settlement_flag",
    )
    leakage_prefixes: Sequence[str] = ("hardship_", "settlement_", "debt_settlement_")


def assign_roles(profile: DataFrame, rules: RoleRules = RoleRules()) -> DataFrame:
    """G1. Preliminary role per profiled column."""
    require_columns(profile, ["column_name", "unique_non_missing_count", "is_constant_non_missing"], "column profile")
    name = F.col("column_name")
    leaked = name.isin(*rules.leakage) | starts_with_any(name, rules.leakage_prefixes)
    flat = (F.col("unique_non_missing_count") == 0) | F.col("is_constant_non_missing")
    role = (
        F.when(name.isin(*rules.target), "target")
        .when(name.isin(*rules.target_source), "target_source")
        .when(name.isin(*rules.identifier), "identifier")
        .when(name.isin(*rules.monitoring_only), "monitoring_only")
        .when(leaked, "post_application_leakage")
        .when(flat, "constant_or_empty")
        .otherwise("requires_review")
    )
    return profile.withColumn("column_role", role)


def role_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, list(ROLE_ACTIONS), "column_role string, recommended_action string, reason string")


def unknown_roles(roles: DataFrame, table: DataFrame) -> DataFrame:
    """G2. Roles without an entry in the role table, as violations."""
    found = roles.select("column_role").distinct().join(table, "column_role", "left_anti")
    return violations(found, "unknown_role", F.col("column_role"), F.lit(True))


def review_inventory(profile: DataFrame, rules: RoleRules = RoleRules(), table: DataFrame | None = None) -> DataFrame:
    """G3. Profile with role, action and reason."""
    table = role_table(profile.sparkSession) if table is None else table
    roles = assign_roles(profile, rules)
    return roles.join(table, "column_role", "left").select(
        *profile.columns, "column_role", "recommended_action", "reason")


def review_coverage(inventory: DataFrame, decisions: DataFrame) -> DataFrame:
    """G4. Unresolved columns without a decision, and decisions nobody asked for."""
    open_columns = inventory.where(F.col("column_role") == "requires_review").select("column_name")
    missing = open_columns.join(decisions, "column_name", "left_anti")
    extra = decisions.join(open_columns, "column_name", "left_anti")
    name = F.col("column_name")
    return union_violations([
        violations(missing, "missing_decision", name, F.lit(True)),
        violations(extra, "extra_decision", name, F.lit(True))])


def final_usage(inventory: DataFrame, decisions: DataFrame, role_purposes=ROLE_PURPOSES,
                automatic_uses=AUTOMATIC_USES) -> DataFrame:
    """G5. Purpose and uses: decided for unresolved columns, automatic for the rest."""
    spark = inventory.sparkSession
    purposes = literal_table(spark, list(role_purposes), "column_role string, _purpose string")
    uses = literal_table(spark, list(automatic_uses), "column_name string, _uses string")
    decided = decisions.select("column_name", F.col("primary_purpose").alias("_decided_purpose"),
                               F.col("additional_use_cases").alias("_decided_uses"))
    review = F.col("column_role") == "requires_review"
    joined = (inventory.select("column_name", "column_role").join(purposes, "column_role", "left")
              .join(uses, "column_name", "left").join(decided, "column_name", "left"))
    return joined.select(
        "column_name",
        F.when(review, F.col("_decided_purpose")).otherwise(F.col("_purpose")).alias("primary_purpose"),
        normalize_list(F.when(review, F.col("_decided_uses")).otherwise(F.col("_uses"))).alias("additional_use_cases"))


def catalog_violations(catalog: DataFrame, purposes: Sequence[str] = PURPOSES,
                       uses: Sequence[str] = USE_CASES) -> DataFrame:
    """G8. Blank, repeated and unknown entries of a catalog, one row per offence."""
    require_columns(catalog, ["column_name", "primary_purpose", "additional_use_cases"], "column catalog")
    name, purpose, use = F.col("column_name"), F.col("primary_purpose"), F.col("additional_use_cases")

    def blank(column):
        return column.isNull() | (strip(column) == "")

    unknown = unknown_items(use, uses)
    return union_violations([
        violations(catalog, "blank_column_name", F.coalesce(name, F.lit("")), blank(name)),
        violations(catalog, "blank_primary_purpose", name, blank(purpose)),
        duplicate_values(catalog, "column_name", "duplicate_column_name"),
        violations(catalog, "unknown_primary_purpose", purpose, ~blank(purpose) & ~purpose.isin(*purposes)),
        violations(catalog, "unknown_use_case", F.array_join(unknown, ","), F.size(unknown) > 0),
        violations(catalog, "repeated_use_case", use, has_repeated_items(use)),
    ])


def enforce_catalog(catalog: DataFrame) -> None:
    if catalog.isEmpty():
        raise DataCheckError("column catalog is empty")
    enforce(catalog_violations(catalog), "column catalog")


def final_usage_violations(final: DataFrame, inventory: DataFrame, expected_count: int | None = None) -> DataFrame:
    """G6. Schema, count, duplicates, same columns as the inventory, allowed values."""
    expected = {"column_name", "primary_purpose", "additional_use_cases"}
    if set(final.columns) != expected:
        raise DataCheckError(f"final inventory must have exactly the columns {sorted(expected)}")
    name = F.col("column_name")
    parts = [
        catalog_violations(final),
        violations(inventory.join(final, "column_name", "left_anti"), "missing_column", name, F.lit(True)),
        violations(final.join(inventory, "column_name", "left_anti"), "unknown_column", name, F.lit(True)),
    ]
    if expected_count is not None:
        counted = final.agg(F.count(F.lit(1)).alias("n"))
        parts.append(violations(counted, "unexpected_row_count", F.col("n"), F.col("n") != expected_count))
    return union_violations(parts)


def build_catalog(inventory: DataFrame, decisions: DataFrame, expected_count: int | None = None,
                  fail_on_extra: bool = False) -> DataFrame:
    """G7. Final catalog, checked."""
    require_columns(inventory, ["column_name", "column_role"], "review inventory")
    inventory = materialize(inventory, "review-inventory")
    coverage = review_coverage(inventory, decisions)
    enforce(coverage if fail_on_extra else coverage.where(F.col("rule") == "missing_decision"), "review decisions")
    raw = decisions.select(F.col("additional_use_cases").alias("u"))
    unknown = unknown_items(F.col("u"), USE_CASES)
    enforce(union_violations([
        violations(raw, "unknown_use_case", F.array_join(unknown, ","), F.size(unknown) > 0),
        violations(raw, "repeated_use_case", F.col("u"), has_repeated_items(F.col("u")))]), "review decisions")
    final = materialize(final_usage(inventory, decisions), "column-catalog")
    enforce(final_usage_violations(final, inventory, expected_count), "final inventory")
    return final


def with_position(catalog: DataFrame, order_by: str = "column_name") -> DataFrame:
    """Number the rows of a catalog that carries no order of its own."""
    return catalog.withColumn("position", F.row_number().over(Window.partitionBy().orderBy(order_by)))


def columns_by_purpose(catalog: DataFrame, purposes: str | Iterable[str]) -> DataFrame:
    """G9. Columns of the given purposes, in catalog order."""
    wanted = [purposes] if isinstance(purposes, str) else list(purposes)
    unknown = sorted(set(wanted) - set(PURPOSES))
    if unknown:
        raise ValueError(f"unknown purposes: {unknown}")
    return catalog.where(F.col("primary_purpose").isin(*wanted)).select("position", "column_name").orderBy("position")


def columns_by_use(catalog: DataFrame, uses: str | Iterable[str]) -> DataFrame:
    """G10. Columns with any of the given additional uses, in catalog order."""
    wanted = [uses] if isinstance(uses, str) else list(uses)
    unknown = sorted(set(wanted) - set(USE_CASES))
    if unknown:
        raise ValueError(f"unknown use cases: {unknown}")
    overlap = F.arrays_overlap(parse_list(F.col("additional_use_cases")), F.array(*[F.lit(u) for u in wanted]))
    return catalog.where(overlap).select("position", "column_name").orderBy("position")


def modeling_columns(catalog: DataFrame) -> DataFrame:
    return columns_by_purpose(catalog, "modeling")


def target_columns(catalog: DataFrame) -> DataFrame:
    return columns_by_purpose(catalog, "target")


def target_source_columns(catalog: DataFrame) -> DataFrame:
    return columns_by_purpose(catalog, "target_source")


def identifier_columns(catalog: DataFrame) -> DataFrame:
    return columns_by_purpose(catalog, "identifier")


def monitoring_columns(catalog: DataFrame) -> DataFrame:
    return columns_by_purpose(catalog, "monitoring")


def time_split_columns(catalog: DataFrame) -> DataFrame:
    return columns_by_use(catalog, "time_split")


def excluded_columns(catalog: DataFrame) -> DataFrame:
    return columns_by_purpose(catalog, EXCLUDED_PURPOSES)


def names(listed: DataFrame) -> list[str]:
    """Names of a column list, in order; bounded by the number of columns."""
    return [row.column_name for row in listed.orderBy("position").collect()]


def column_roles(catalog: DataFrame) -> DataFrame:
    """G11. (role_order, role, position, column_name) of the columns a modeling table keeps."""
    listed = (("identifier_tracking", identifier_columns), ("time_split", time_split_columns),
              ("model_feature", modeling_columns), ("target", target_columns))
    parts = [pick(catalog).select(F.lit(i).alias("role_order"), F.lit(role).alias("role"), "position", "column_name")
             for i, (role, pick) in enumerate(listed, start=1)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def selected_columns(catalog: DataFrame) -> DataFrame:
    """G11, W7. Kept columns without repeats, numbered: identifiers, time, features, target."""
    first = column_roles(catalog).groupBy("column_name").agg(F.min(F.struct("role_order", "position")).alias("first"))
    number = F.row_number().over(Window.partitionBy().orderBy("first"))
    return first.select("column_name", number.alias("modeling_base_column_order"))


def selection_violations(catalog: DataFrame, available: Sequence[str]) -> DataFrame:
    """G12. Everything that makes a selection unsafe or impossible; no data is read."""
    spark = catalog.sparkSession
    present = literal_table(spark, [(name,) for name in available], "column_name string")
    groups = literal_table(spark,
        [("target", True, 1), ("time_split", True, 1), ("identifier_tracking", False, 1), ("model_feature", False, 1)],
        "role string, exact boolean, wanted int")
    roles = column_roles(catalog)
    counts = roles.groupBy("role").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    off = (F.col("exact") & (n != F.col("wanted"))) | (~F.col("exact") & (n < F.col("wanted")))
    features = roles.where(F.col("role") == "model_feature").select("column_name")
    reserved = (target_columns(catalog).unionByName(target_source_columns(catalog))
                .unionByName(identifier_columns(catalog)).unionByName(time_split_columns(catalog))
                .unionByName(excluded_columns(catalog)).select("column_name").distinct())
    name = F.col("column_name")
    return union_violations([
        violations(catalog.join(present, "column_name", "left_anti"), "missing_from_data", name, F.lit(True)),
        violations(groups.join(counts, "role", "left"), "wrong_column_count", F.concat_ws("=", "role", n), off),
        violations(features.join(reserved, "column_name", "left_semi"), "unsafe_feature", name, F.lit(True)),
        violations(selected_columns(catalog).join(target_source_columns(catalog), "column_name", "left_semi"),
                   "target_source_selected", name, F.lit(True)),
    ])


def selection_report(catalog: DataFrame) -> DataFrame:
    """G13. Every column with selection flag, roles and order; unselected columns last."""
    roles = column_roles(catalog).groupBy("column_name").agg(
        F.array_sort(F.collect_set(F.struct("role_order", "role"))).alias("roles"))
    joined = catalog.join(selected_columns(catalog), "column_name", "left").join(roles, "column_name", "left")
    order = F.col("modeling_base_column_order")
    role_text = F.array_join(F.transform("roles", lambda item: item["role"]), ", ")
    return joined.select(
        "column_name", "primary_purpose", "additional_use_cases", order.isNotNull().alias("selected_for_modeling_base"),
        F.coalesce(role_text, F.lit("")).alias("role_in_modeling_base"), order,
    ).orderBy(F.desc("selected_for_modeling_base"), order.asc_nulls_last(), "column_name")


def usage_summary(catalog: DataFrame) -> DataFrame:
    """A11. Columns per purpose."""
    return catalog.groupBy("primary_purpose").agg(F.count(F.lit(1)).alias("column_count")).orderBy("primary_purpose")


def feature_group_violations(profile: DataFrame, approved: DataFrame) -> DataFrame:
    """G15. Repeated, missing and untyped features."""
    known = (*NUMERIC_TYPES, *CATEGORICAL_TYPES, *EXCLUDED_TYPES)
    used = profile.join(approved.select("column_name"), "column_name", "left_semi")
    kind = F.col("inferred_feature_type")
    return union_violations([
        duplicate_values(profile, "column_name", "duplicate_feature"),
        violations(approved.join(profile, "column_name", "left_anti"), "feature_without_profile",
                   F.col("column_name"), F.lit(True)),
        violations(used, "unexpected_feature_type", kind, kind.isNull() | ~kind.isin(*known)),
    ])


def feature_groups(profile: DataFrame, approved: DataFrame) -> DataFrame:
    """G15. (feature_group, column_name) of approved features; constant and empty ones are left out of models."""
    kind = F.col("inferred_feature_type")
    group = (F.when(kind.isin(*NUMERIC_TYPES), "numeric").when(kind.isin(*CATEGORICAL_TYPES), "categorical")
             .when(kind.isin(*EXCLUDED_TYPES), "excluded"))
    return profile.join(approved.select("column_name"), "column_name", "left_semi").select(
        group.alias("feature_group"), "column_name", "needs_manual_review", "recommended_preprocessing_group")


def feature_columns(profile: DataFrame, approved: DataFrame) -> FeatureColumns:
    """G15. Checked groups as lists, in profile order (review first, group, name)."""
    require_columns(profile, ["column_name", "inferred_feature_type"], "feature-type profile")
    enforce(feature_group_violations(profile, approved), "feature-type profile")
    rows = feature_groups(profile, approved).orderBy(
        F.desc("needs_manual_review"), "recommended_preprocessing_group", "column_name").collect()
    return FeatureColumns(*[tuple(row.column_name for row in rows if row.feature_group == group)
                            for group in ("numeric", "categorical", "excluded")])
