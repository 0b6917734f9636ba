"""Text conforming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that also count as blank.
_BLANK = r"[\s\x1c-\x1f]"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def strip(column: Column) -> Column:
    """Remove blanks of any kind at both ends; ``trim`` would remove spaces only."""
    return F.regexp_replace(column, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def title_case(column: Column) -> Column:
    """Capital after every non-letter, so that apostrophes and hyphens start a word."""
    runs = F.regexp_extract_all(column, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(0))
    capital = F.transform(
        runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(run.substr(F.lit(2), F.length(run))))
    )
    return F.array_join(capital, "")


def clean_name(column: Column) -> Column:
    return title_case(strip(column))


def clean_email(column: Column) -> Column:
    return strip(F.lower(column))


def same_text(column: Column, value: str) -> Column:
    """Comparison that ignores case; null stays null.

    The first letter is also compared in both cases: that adds nothing to the
    result, but unlike ``lower`` it reaches the scan as a pushed filter. (K and I
    have other letters that lower to them, so they go without.)
    """
    same, first = F.lower(column) == F.lit(value.lower()), value[:1]
    if not (first.isascii() and first.isalpha()) or first.lower() in "ki":
        return same
    return (column.startswith(first.upper()) | column.startswith(first.lower())) & same


def month_label(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
