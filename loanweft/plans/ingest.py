"""Raw loans to the labeled table and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loanweft.operators.labels import add_target, keep_labeled, status_distribution, target_summary
from loanweft.operators.profile import column_profile
from loanweft.operators.quality import (
    duplicate_summary, enforce_identifier, enforce_issue_dates, enforce_labeled_table, identifier_integrity,
    issue_date_integrity, missingness_report)
from loanweft.sources.writers import write_report, write_table


def raw_reports(raw: DataFrame, folder: str, status: str = "loan_status") -> None:
    """A2, A4. Status distribution and target summary of the raw table."""
    write_report(status_distribution(raw, status), f"{folder}/raw_loan_status_counts")
    write_report(target_summary(add_target(raw, status)), f"{folder}/bad_loan_target_summary")


def label_table(raw: DataFrame, path: str, status: str = "loan_status") -> tuple[DataFrame, dict[str, int]]:
    """S9. Write the rows with a resolved outcome; returns them and the row counts seen while writing."""
    seen = Observation()
    marked = add_target(raw, status).observe(
        seen, F.count(F.lit(1)).alias("raw_row_count"), F.count("bad_loan").alias("labeled_row_count"))
    labeled = write_table(keep_labeled(marked), path)
    counts = seen.get
    return labeled, {**counts, "excluded_row_count": counts["raw_row_count"] - counts["labeled_row_count"]}


def quality_reports(labeled: DataFrame, folder: str, identifier: str = "id", date: str = "issue_d",
                    expected_rows: int | None = None) -> None:
    """A5 to A10. Integrity reports are written before they are enforced."""
    enforce_labeled_table(labeled, expected_rows=expected_rows)
    write_report(missingness_report(labeled), f"{folder}/missingness_report")
    write_report(duplicate_summary(labeled), f"{folder}/duplicate_summary")
    write_report(column_profile(labeled), f"{folder}/column_profile")
    identifiers = identifier_integrity(labeled, identifier)
    write_report(identifiers, f"{folder}/identifier_integrity")
    enforce_identifier(identifiers)
    dates = issue_date_integrity(labeled, date)
    write_report(dates, f"{folder}/issue_date_integrity")
    enforce_issue_dates(dates)
