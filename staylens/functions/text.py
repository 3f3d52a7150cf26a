"""Text expressions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(col: Column) -> Column:
    """Trim spaces, turn each whitespace run into one space, empty to NULL."""
    return F.nullif(F.regexp_replace(F.btrim(col), r"\s+", " "), F.lit(""))


def clean_code(col: Column) -> Column:
    return F.upper(clean_text(col))


def normalize_category(col: Column, labels: dict[str, list[str]], default: str) -> Column:
    """Map the cleaned upper-case text onto the label whose values hold it."""
    text = clean_code(col)
    out = None
    for label, values in labels.items():
        hit = text.isin(values)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def default_text(col: Column, value: str) -> Column:
    return F.coalesce(col, F.lit(value))


def contains_any(col: Column, words: list[str]) -> Column:
    """True where any word occurs in the text, ignoring case; NULL is false."""
    text = F.upper(F.coalesce(col, F.lit("")))
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word.upper())
    return hit


def strip_quotes(col: Column) -> Column:
    return F.replace(col, F.lit('"'), F.lit(""))


def sentinels_to_null(col: Column, sentinels: tuple[str, ...] = ("", "nan", "None")) -> Column:
    return F.when(~col.isin(list(sentinels)), col)


def to_number(col: Column) -> Column:
    """Text to double; text that is no finite number becomes NULL."""
    number = F.trim(col).try_cast("double")
    return finite(number)


def finite(col: Column) -> Column:
    """NaN and both infinities become NULL."""
    return F.when(F.abs(col) < F.lit(float("inf")), col)
