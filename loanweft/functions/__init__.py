from loanweft.functions.checks import enforce, require_columns, require_fractions
from loanweft.functions.dates import month_text, parse_month
from loanweft.functions.numeric import clip, direction_label, log_odds, sigmoid
from loanweft.functions.text import normalize_list, parse_list, starts_with_any, strip

__all__ = [
    "clip", "direction_label", "enforce", "log_odds", "month_text", "normalize_list",
    "parse_list", "parse_month", "require_columns", "require_fractions", "sigmoid",
    "starts_with_any", "strip",
]
