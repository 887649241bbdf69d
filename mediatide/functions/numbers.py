"""Numbers: lenient parsing, guarded division and the three kinds of rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
)

# Text that counts as a number in the feeds: digits may be grouped by single underscores,
# `nan` and `inf` are allowed, type suffixes such as `1.5d` are not.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = (
    rf"^[{WHITESPACE}]*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|(?i:nan|inf|infinity))[{WHITESPACE}]*$"
)
_INTEGER = rf"^[{WHITESPACE}]*[+-]?{_DIGITS}[{WHITESPACE}]*$"
# How nearly all numbers are written.
_USUAL = r"^-?[0-9]+(?:\.[0-9]+)?$"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def _bare(text: Column) -> Column:
    """Without the white space and the grouping that the patterns allow."""
    return F.translate(text, WHITESPACE + "_", "")


def parse_double(text: Column) -> Column:
    """Text to double, NULL when it is not a number.

    The cheap pattern settles nearly every text.  One cast serves both patterns, which keeps
    the generated code of a mapping with many such columns small enough to be compiled.
    """
    accepted = F.when(text.rlike(_USUAL), text).when(text.rlike(_NUMBER), _bare(text))
    return accepted.try_cast("double")


def parse_integer(text: Column) -> Column:
    """Whole-number text to bigint, NULL for anything else (`1.5` included)."""
    return F.when(text.rlike(_INTEGER), _bare(text)).try_cast("bigint")


def truncate_long(value: Column) -> Column:
    """Double to bigint towards zero; NaN, infinities and overflow give NULL."""
    return value.try_cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is zero or either side is NULL (staging, marts, reports)."""
    return F.try_divide(numerator, denominator)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Zero instead of NULL (common data model tables)."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def ratio_floor_one(numerator: Column, denominator: Column) -> Column:
    """A zero denominator counts as one (the daily funnel of the rounded tables)."""
    return F.try_divide(numerator, F.when(denominator == 0, F.lit(1)).otherwise(denominator))


def money_sum(amount: Column) -> Column:
    """Total of money, the same for every order of the rows.

    Amounts are added as decimals with 18 digits after the point, so neither the number of partitions
    nor a task that runs again changes the last digit.  NaN is no amount and is left out, as NULL is.
    An amount or a total of 1e20 or more, an infinity included, is an error.
    """
    wide = "decimal(38,18)"
    refused = F.raise_error(F.concat(F.lit("money out of range: "), amount.cast("string"))).cast(wide)
    value = F.when(F.isnan(amount), F.lit(None).cast(wide)).when(F.abs(amount) >= 1e20, refused).otherwise(amount.cast(wide))
    return F.sum(value).cast("double")


def round_half_up(value: Column, digits: int) -> Column:
    """SQL rounding: ties go away from zero."""
    return F.round(value, digits)


def round_frame(value: Column, digits: int) -> Column:
    """Data-frame rounding: scale, take the nearest even integer, scale back."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def round_exact(value: Column, digits: int) -> Column:
    """Correctly rounded decimal of the stored binary value, ties to even.

    `0.15` is stored a little below fifteen hundredths and so gives 0.1 at one digit;
    scaling alone would see a tie.  When the scaled value looks like a tie, the part that
    the multiplication rounded off (splitting the value in two halves whose products are
    exact) tells on which side of the tie the stored value lies.
    """
    scale = F.lit(float(10**digits))
    scaled = value * scale
    nearest = F.rint(scaled)
    spread = value * F.lit(134217729.0)
    high = spread - (spread - value)
    residue = (high * scale - scaled) + (value - high) * scale
    looks_tied = F.abs(scaled - nearest) == 0.5
    whole = (
        F.when(looks_tied & (residue > 0), scaled + 0.5)
        .when(looks_tied & (residue < 0), scaled - 0.5)
        .otherwise(nearest)
    )
    return whole / scale
