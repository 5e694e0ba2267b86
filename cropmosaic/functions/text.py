"""Text and number clean-up as Spark column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_leading_zero(code: Column) -> Column:
    """Drop one leading zero: '01' -> '1', '005' -> '05', '0' -> ''."""
    return F.regexp_replace(code, "^0", "")


def strip_trailing_newline(url: Column) -> Column:
    return F.regexp_replace(url, r"\n\z", "")


def first_of(text: Column, words: list[str]) -> Column:
    """Earliest of the given words found in the text, NULL if none is."""
    return F.get(F.regexp_extract_all(text, F.lit("(" + "|".join(words) + ")"), F.lit(1)), F.lit(0))


def clean_number(text: Column) -> Column:
    """Number in the first run of digits and dots; NULL where that run is no number.

    An exponent is cut off ('1.2e-05 [1]' gives 1.2), so keep numeric columns numeric
    and use this for text that really came from outside.
    """
    return F.regexp_substr(text, F.lit("[0-9.]+")).try_cast("double")


def strip_unit(text: Column) -> Column:
    """Number left after removing a bracketed unit: '0.12 [m^2]' -> 0.12."""
    return F.trim(F.regexp_replace(text, r"\[.*\]", "")).try_cast("double")
