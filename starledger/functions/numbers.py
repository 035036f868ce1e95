"""Text to number, money and percentages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A plain decimal literal. The cast alone would also take '12d', '12f' and 'NaN'.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def try_double(text: Column) -> Column:
    """Number or NULL, never an error."""
    literal = F.regexp_extract_all(text.cast("string"), F.lit(NUMBER_PATTERN), F.lit(0))
    return F.get(literal, F.lit(0)).try_cast("double")


def strip_symbol(text: Column, symbol: str = "£") -> Column:
    """Price text without its currency sign, as a number."""
    return try_double(F.replace(text, F.lit(symbol), F.lit("")))


def revenue(price: Column, units: Column) -> Column:
    """Exact money: two-decimal price times a whole number.

    With a SMALLINT quantity the product still fits the fast 18-digit decimals.
    """
    return price.cast("decimal(12,2)") * units


def money(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")


def percent_of_count(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` rounded half up to two places, in whole-number arithmetic.

    Shares of counts hit exact ties often; binary floats would round those either way.
    """
    hundredths = F.call_function("div", part * 20000 + whole, whole * 2)
    return hundredths / F.lit(100.0)


def percent_of_amount(part: Column, whole: Column) -> Column:
    return F.round(part.cast("double") / whole.cast("double") * 100, 2)
