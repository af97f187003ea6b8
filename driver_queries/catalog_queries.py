"""Column governance, starting from the profile of the labeled loans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries.data_queries import (
    TYPES_CTE, feature_profile, profile_sql, scratch)
from driver_queries.views import LABELED_COLUMNS, LOANS, labeled, sql_list
from loanweft.operators import governance
from loanweft.operators.profile import column_profile
from loanweft.session import literal_table, materialize

QUERIES: dict = {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function
    return keep


# what a reviewer decided about the columns the rules leave open
DECISIONS = (
    ("loan_amnt", "modeling", ""),
    ("annual_inc", "modeling", "data_quality_check, benchmarking"),
    ("emp_length", "modeling", ""),
    ("purpose", "modeling", "reporting,portfolio_segmentation"),
    ("addr_state", "modeling", "portfolio_segmentation"),
    ("term", "modeling", "portfolio_segmentation"),
    ("application_type", "modeling", ""),
    ("open_acc", "modeling", ""),
    ("dti", "modeling", ""),
    ("il_util", "modeling", ""),
    ("earliest_cr_line", "modeling", ""),
    ("title", "high_cardinality_or_text", ""),
    ("grade", "lender_derived_feature", "benchmarking"),
)
RULES = governance.RoleRules()

PROFILE = LOANS + ", profile AS (" + profile_sql(LABELED_COLUMNS, "labeled") + ")"
ROLES = PROFILE + f""", roles AS (SELECT *, CASE WHEN column_name IN ({sql_list(RULES.target)}) THEN 'target'
  WHEN column_name IN ({sql_list(RULES.target_source)}) THEN 'target_source'
  WHEN column_name IN ({sql_list(RULES.identifier)}) THEN 'identifier'
  WHEN column_name IN ({sql_list(RULES.monitoring_only)}) THEN 'monitoring_only'
  WHEN column_name IN ({sql_list(RULES.leakage)}) OR {' OR '.join(f"starts_with(column_name, '{p}')" for p in RULES.leakage_prefixes)}
    THEN 'post_application_leakage'
  WHEN unique_non_missing_count = 0 OR is_constant_non_missing THEN 'constant_or_empty' ELSE 'requires_review' END AS column_role
FROM profile)"""


def values_sql(rows) -> str:
    return ", ".join("(" + sql_list(row) + ")" for row in rows)


REVIEW = ROLES + f""", actions(column_role, recommended_action, reason) AS (VALUES {values_sql(governance.ROLE_ACTIONS)}
), review AS (SELECT * FROM roles LEFT JOIN actions USING (column_role))"""
FINAL = REVIEW + f""", decisions(column_name, primary_purpose, uses) AS (VALUES {values_sql(DECISIONS)}
), purposes(column_role, p) AS (VALUES {values_sql(governance.ROLE_PURPOSES)}
), automatic(column_name, u) AS (VALUES {values_sql(governance.AUTOMATIC_USES)}
), final AS (SELECT r.column_name,
    CASE WHEN r.column_role = 'requires_review' THEN d.primary_purpose ELSE p.p END AS primary_purpose,
    coalesce(list_aggregate(list_sort(list_filter(list_transform(string_split(
      CASE WHEN r.column_role = 'requires_review' THEN d.uses ELSE coalesce(a.u, '') END, ','), lambda x: trim(x)),
      lambda x: x <> '')), 'string_agg', ','), '') AS additional_use_cases
  FROM review r LEFT JOIN decisions d USING (column_name) LEFT JOIN purposes p USING (column_role)
  LEFT JOIN automatic a USING (column_name)
), catalog AS (SELECT *, row_number() OVER (ORDER BY column_name) AS position FROM final
), kept AS (
  SELECT 1 AS role_order, 'identifier_tracking' AS role, position, column_name FROM catalog WHERE primary_purpose = 'identifier'
  UNION ALL SELECT 2, 'time_split', position, column_name FROM catalog
    WHERE list_contains(string_split(additional_use_cases, ','), 'time_split')
  UNION ALL SELECT 3, 'model_feature', position, column_name FROM catalog WHERE primary_purpose = 'modeling'
  UNION ALL SELECT 4, 'target', position, column_name FROM catalog WHERE primary_purpose = 'target'
), selected AS (SELECT column_name, cast(row_number() OVER (ORDER BY o, position) AS integer) AS modeling_base_column_order
  FROM (SELECT column_name, min(role_order) AS o, any_value(position) AS position FROM kept GROUP BY column_name))"""


def _profile(spark, folder) -> DataFrame:
    return materialize(column_profile(labeled(spark, folder)), "profile")


def _review(spark, folder) -> DataFrame:
    return governance.review_inventory(_profile(spark, folder))


def _decisions(spark) -> DataFrame:
    return literal_table(spark, list(DECISIONS), "column_name string, primary_purpose string, additional_use_cases string")


def _final(spark, folder) -> DataFrame:
    return governance.final_usage(_review(spark, folder), _decisions(spark))


def _catalog(spark, folder) -> DataFrame:
    return materialize(governance.with_position(_final(spark, folder)), "catalog")


@register("g1_column_roles", ROLES + "SELECT column_name, column_role FROM roles")
def g1_column_roles(spark, folder):
    return governance.assign_roles(_profile(spark, folder)).select("column_name", "column_role")


@register("g2_role_actions", REVIEW + "SELECT column_name, recommended_action, reason FROM review")
def g2_role_actions(spark, folder):
    return _review(spark, folder).select("column_name", "recommended_action", "reason")


@register("g3_review_inventory", REVIEW + "SELECT * FROM review")
def g3_review_inventory(spark, folder):
    return _review(spark, folder)


@register("a11_roles_counted", REVIEW + "SELECT column_role, count(*) AS column_count FROM review GROUP BY 1")
def a11_roles_counted(spark, folder):
    return _review(spark, folder).groupBy("column_role").agg(F.count(F.lit(1)).alias("column_count"))


@register("g4_review_coverage", FINAL + """, given AS (SELECT column_name FROM decisions WHERE column_name <> 'dti'
  UNION ALL SELECT 'url'), open_columns AS (SELECT column_name FROM review WHERE column_role = 'requires_review')
SELECT 'missing_decision' AS rule, column_name AS offender FROM open_columns WHERE column_name NOT IN (FROM given)
UNION ALL SELECT 'extra_decision', column_name FROM given WHERE column_name NOT IN (FROM open_columns)""")
def g4_review_coverage(spark, folder):
    """One decision left out, one too many."""
    given = _decisions(spark).select("column_name").where("column_name <> 'dti'").union(
        literal_table(spark, [("url",)], "column_name string"))
    return governance.review_coverage(_review(spark, folder), given)


@register("g5_final_usage", FINAL + "SELECT * FROM final")
def g5_final_usage(spark, folder):
    return _final(spark, folder)


@register("g6_final_usage_violations", FINAL + """
SELECT 'unexpected_row_count' AS rule, cast(count(*) AS varchar) AS offender FROM final WHERE column_name <> 'grade'
UNION ALL SELECT 'missing_column', 'grade'
UNION ALL SELECT 'unknown_primary_purpose', 'high_cardinality_or_text_x' """)
def g6_final_usage_violations(spark, folder):
    """A final table without one column, with one purpose misspelt."""
    review = _review(spark, folder)
    final = governance.final_usage(review, _decisions(spark)).where("column_name <> 'grade'").withColumn(
        "primary_purpose", F.when(F.col("column_name") == "title", "high_cardinality_or_text_x").otherwise(F.col("primary_purpose")))
    return governance.final_usage_violations(final, review, expected_count=len(LABELED_COLUMNS))


@register("g7_column_catalog", FINAL + "SELECT * FROM final")
def g7_column_catalog(spark, folder):
    return governance.build_catalog(_review(spark, folder), _decisions(spark), len(LABELED_COLUMNS))


@register("g8_catalog_violations", FINAL + """
SELECT 'duplicate_column_name' AS rule, 'dti' AS offender FROM final WHERE column_name = 'dti'
UNION ALL SELECT 'unknown_use_case', 'gossip' FROM final WHERE column_name = 'title'
UNION ALL SELECT 'repeated_use_case', 'reporting,reporting' FROM final WHERE column_name = 'term'
UNION ALL SELECT 'blank_primary_purpose', column_name FROM final WHERE column_name = 'policy_code'""")
def g8_catalog_violations(spark, folder):
    """The catalog with a repeated row, a blank and two bad use lists."""
    final, name = _final(spark, folder), F.col("column_name")
    broken = final.union(final.where(name == "dti")).select(
        "column_name", F.when(name == "policy_code", " ").otherwise(F.col("primary_purpose")).alias("primary_purpose"),
        F.when(name == "title", "gossip").when(name == "term", "reporting,reporting")
        .otherwise(F.col("additional_use_cases")).alias("additional_use_cases"))
    return governance.catalog_violations(broken)


@register("g9_columns_by_purpose", FINAL + """
SELECT cast(position AS integer) AS position, column_name FROM catalog WHERE primary_purpose IN ('modeling', 'identifier')""")
def g9_columns_by_purpose(spark, folder):
    return governance.columns_by_purpose(_catalog(spark, folder), ["modeling", "identifier"])


@register("g10_columns_by_use", FINAL + """
SELECT cast(position AS integer) AS position, column_name FROM catalog
WHERE list_has_any(string_split(additional_use_cases, ','), ['reporting', 'benchmarking'])""")
def g10_columns_by_use(spark, folder):
    return governance.columns_by_use(_catalog(spark, folder), ["reporting", "benchmarking"])


@register("g11_selected_columns", FINAL + "SELECT * FROM selected")
def g11_selected_columns(spark, folder):
    return governance.selected_columns(_catalog(spark, folder))


@register("g12_selection_violations", FINAL + """
SELECT 'missing_from_data' AS rule, column_name AS offender FROM catalog WHERE column_name IN ('dti', 'title')
UNION ALL SELECT 'wrong_column_count', 'target=' || cast(2 AS varchar)
UNION ALL SELECT 'unsafe_feature', 'issue_d'""")
def g12_selection_violations(spark, folder):
    """Two columns gone from the data, a second target, the split column declared a feature."""
    catalog = _catalog(spark, folder)
    name = F.col("column_name")
    broken = catalog.withColumn("primary_purpose", F.when(name == "member_id", "target").when(
        name == "issue_d", "modeling").otherwise(F.col("primary_purpose")))
    available = [column for column, _ in LABELED_COLUMNS if column not in ("dti", "title")]
    return governance.selection_violations(broken, available)


@register("g13_selection_report", FINAL + """
SELECT c.column_name, c.primary_purpose, c.additional_use_cases, s.column_name IS NOT NULL AS selected_for_modeling_base,
  coalesce(k.roles, '') AS role_in_modeling_base, s.modeling_base_column_order
FROM catalog c LEFT JOIN selected s USING (column_name)
LEFT JOIN (SELECT column_name, string_agg(role, ', ' ORDER BY role_order) AS roles FROM kept GROUP BY 1) k USING (column_name)""")
def g13_selection_report(spark, folder):
    return governance.selection_report(_catalog(spark, folder))


@register("w7_column_order", FINAL + "SELECT modeling_base_column_order, column_name FROM selected")
def w7_column_order(spark, folder):
    return governance.selected_columns(_catalog(spark, folder))


BASE_COLUMNS = ["id", "url", "issue_d", "addr_state", "annual_inc", "application_type", "dti", "earliest_cr_line", "emp_length",
                "il_util", "loan_amnt", "open_acc", "purpose", "term", "bad_loan"]


@register("g14_modeling_base", LOANS + f"SELECT {', '.join(BASE_COLUMNS)} FROM labeled")
def g14_modeling_base(spark, folder):
    """Catalog from the data, then the checked projection, written and read back."""
    from loanweft.plans.modeling import build_modeling_base
    path = scratch(spark)
    labeled(spark, folder).write.parquet(f"{path}/labeled")
    review = governance.review_inventory(column_profile(spark.read.parquet(f"{path}/labeled")))
    catalog = governance.with_position(governance.build_catalog(review, _decisions(spark)))
    return build_modeling_base(spark, f"{path}/labeled", catalog, f"{path}/base")


_APPROVED = ("loan_amnt", "annual_inc", "emp_length", "purpose", "addr_state", "term", "application_type", "open_acc", "dti",
             "il_util", "earliest_cr_line", "policy_code")


@register("g15_feature_groups", LOANS + TYPES_CTE + f"""
SELECT column_name, CASE WHEN inferred_feature_type LIKE 'numeric%' THEN 'numeric'
  WHEN inferred_feature_type IN ('binary_or_two_value', 'categorical_low_cardinality') THEN 'categorical' ELSE 'excluded' END
  AS feature_group FROM feature_profile WHERE column_name IN ({sql_list(_APPROVED)})""")
def g15_feature_groups(spark, folder):
    approved = literal_table(spark, [(name,) for name in _APPROVED], "column_name string")
    return governance.feature_groups(feature_profile(spark, folder), approved).select("feature_group", "column_name")


@register("g15_feature_group_violations", LOANS + TYPES_CTE + """
SELECT 'feature_without_profile' AS rule, 'not_profiled' AS offender
UNION ALL SELECT 'unexpected_feature_type', 'mystery' FROM feature_profile WHERE column_name = 'purpose'""")
def g15_feature_group_violations(spark, folder):
    approved = literal_table(spark, [("purpose",), ("dti",), ("not_profiled",)], "column_name string")
    broken = materialize(feature_profile(spark, folder), "types").withColumn("inferred_feature_type", F.when(
        F.col("column_name") == "purpose", "mystery").otherwise(F.col("inferred_feature_type")))
    return governance.feature_group_violations(broken, approved)


@register("a19_feature_type_reports", LOANS + TYPES_CTE + f"""
SELECT column_name, inferred_feature_type, missing_count FROM feature_profile WHERE column_name IN ({sql_list(_APPROVED[:-1])})""")
def a19_feature_type_reports(spark, folder):
    """Both profiles written as reports, from a projected scan of a written modeling base."""
    from loanweft.plans.modeling import feature_type_reports
    path = scratch(spark)
    labeled(spark, folder).write.parquet(f"{path}/base")
    catalog = _catalog(spark, folder)
    return feature_type_reports(spark, f"{path}/base", catalog, f"{path}/reports").select(
        "column_name", "inferred_feature_type", "missing_count")
