"""Number helpers: coercion, percentages and half-even rounding on doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# What a number may look like as text. The cast alone would also take "1d", "1f" and "nan".
_NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def to_number(c: Column, data_type: T.DataType) -> Column:
    """DOUBLE value of a column; anything that is not a number becomes NULL, never NaN."""
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        text = F.trim(c)
        return F.when(text.rlike(_NUMBER), text.try_cast("double"))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        number = c.cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def round_even(c: Column, digits: int) -> Column:
    """Round a double to a number of digits, ties to even."""
    scale = 10.0**digits
    return F.rint(c * scale) / scale + 0.0  # no negative zero


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded; 0 when there is nothing to divide by."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100.0
    return round_even(F.coalesce(share, F.lit(0.0)), digits)


def number_text(c: Column) -> Column:
    """Plain decimal text of a rounded double: 12.5, 900000.0, 12500000.0, or None."""
    fixed = F.regexp_replace(F.format_string("%.4f", c), "0{1,3}$", "")
    return F.when(c.isNull(), F.lit("None")).otherwise(fixed)


def fixed_percent(c: Column) -> Column:
    """Two-digit percent text such as 12.34%."""
    return F.format_string("%.2f%%", round_even(c, 2))
