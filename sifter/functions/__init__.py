"""Column functions: JVM built-ins first, one Arrow UDF for long block lists."""

from sifter.functions.text import (
    all_matches,
    ascii_fold,
    code_points,
    contains_any,
    first_match,
    scan_text,
    unicode_trim,
    words_array,
)

__all__ = [
    "all_matches",
    "ascii_fold",
    "code_points",
    "contains_any",
    "first_match",
    "scan_text",
    "unicode_trim",
    "words_array",
]
