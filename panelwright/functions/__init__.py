from panelwright.functions.numeric import (
    null_if_nan,
    parse_number,
    ratio,
    round_exact,
    round_scaled,
    scaled_int,
    share_text,
    to_double,
    whole_number,
)
from panelwright.functions.text import (
    accent_fold,
    casefold_key,
    exact_key,
    extract_year,
    first_chars,
    upper_key,
)

__all__ = [
    "accent_fold",
    "casefold_key",
    "exact_key",
    "extract_year",
    "first_chars",
    "null_if_nan",
    "parse_number",
    "ratio",
    "round_exact",
    "round_scaled",
    "scaled_int",
    "share_text",
    "to_double",
    "upper_key",
    "whole_number",
]
