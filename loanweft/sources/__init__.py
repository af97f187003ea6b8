from loanweft.sources.readers import (
    read_catalog, read_columns, read_feature_names, read_features, read_metadata, read_projection,
    read_raw_loans, read_split)
from loanweft.sources.writers import (
    load_model, save_model, write_comparison_reports, write_features, write_report, write_splits, write_table)

__all__ = [
    "load_model", "read_catalog", "read_columns", "read_feature_names", "read_features", "read_metadata",
    "read_projection", "read_raw_loans", "read_split", "save_model", "write_comparison_reports",
    "write_features", "write_report", "write_splits", "write_table",
]
