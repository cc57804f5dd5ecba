"""Numbers as text whose lexicographic order is the numeric order.

Integers and decimals: a value becomes a sign digit (``0`` negative, ``1`` otherwise) and its
absolute decimal text, left-padded with zeros to a fixed width. Digits of negative values are
replaced by their nine's complement, so larger magnitudes sort first. Fractions keep a fixed
number of decimals (``scale``), which makes the text of integers and decimals alike.

Doubles have no fixed scale. Their IEEE bits without the sign are ordered like their magnitudes;
the text is a sign digit and those 63 bits in hexadecimal, complemented where negative.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pigeonhole.columns import long_lit

_DIGITS = "0123456789"
_COMPLEMENT = "9876543210"

# The layout of IEEE 754 doubles.
FRACTION = 2**52
BIAS = 1023
LEAST_EXPONENT = -1022
INFINITY = 0x7FF0000000000000
NOT_A_NUMBER = 0x7FF8000000000000
ALL_BITS = 2**63 - 1
HEX_DIGITS = 16


def encode_number(value: Column, width: int = 19, scale: int = 0) -> Column:
    """Sortable text of a number; raises if it needs more than ``width`` integer digits.

    With ``scale`` > 0 the value is first rounded to that many decimals. Defaults hold any
    ``bigint``.
    """
    total = width + (scale + 1 if scale else 0)
    exact = value.cast(f"decimal({min(38, width + 1 + scale)},{scale})")
    digits = F.lpad(F.ltrim(exact.cast("string"), F.lit("-")), total, "0")
    fits = F.length(F.ltrim(exact.cast("string"), F.lit("-"))) <= total
    text = F.when(
        exact < 0, F.concat(F.lit("0"), F.translate(digits, _DIGITS, _COMPLEMENT))
    ).otherwise(F.concat(F.lit("1"), digits))
    return F.when(fits, text).when(
        exact.isNotNull(), F.raise_error(F.lit(f"number does not fit in {width} digits"))
    )


def decode_number(text: Column, data_type: str = "bigint") -> Column:
    """Inverse of :func:`encode_number`."""
    digits = F.substring(text, 2, 100)
    plain = F.when(
        F.substring(text, 1, 1) == "0",
        F.concat(F.lit("-"), F.translate(digits, _DIGITS, _COMPLEMENT)),
    ).otherwise(digits)
    return plain.cast(data_type)


def encode_double(value: Column) -> Column:
    """Sortable text of a double: 17 characters, exact for every value.

    The order is -Infinity, negative numbers, -0, 0, positive numbers, Infinity, NaN, which is
    Spark's own but for the two zeros, equal as numbers. Null stays null.
    """
    x = value.cast("double")
    # Only a zero does not show its sign in a comparison.
    negative = (x < 0) | ((x == 0) & F.startswith(x.cast("string"), F.lit("-")))
    bits = _magnitude_bits(F.abs(x))
    shown = F.when(negative, long_lit(ALL_BITS) - bits).otherwise(bits)
    sign = F.when(negative, F.lit("0")).otherwise(F.lit("1"))
    return F.concat(sign, F.lpad(F.hex(shown), HEX_DIGITS, "0"))


def decode_double(text: Column) -> Column:
    """Inverse of :func:`encode_double`, to the same double."""
    shown = F.conv(F.substring(text, 2, HEX_DIGITS), 16, 10).cast("bigint")
    negative = F.startswith(text, F.lit("0"))
    bits = F.when(negative, long_lit(ALL_BITS) - shown).otherwise(shown)
    exponent = F.shiftright(bits, 52)
    fraction = bits.bitwiseAND(long_lit(FRACTION - 1)).cast("double")
    magnitude = (
        F.when(bits > INFINITY, F.lit(float("nan")))
        .when(bits == INFINITY, F.lit(float("inf")))
        .when(exponent == 0, fraction * _power(F.lit(-537)) * _power(F.lit(-537)))
        .otherwise((F.lit(1.0) + fraction / float(FRACTION)) * _power(exponent - BIAS))
    )
    return F.when(negative, -magnitude).otherwise(magnitude)


def _power(exponent: Column) -> Column:
    """2 to a whole exponent, which ``pow`` gives exactly."""
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _magnitude_bits(x: Column) -> Column:
    """The IEEE bits of a double that is not negative, by exact scaling with powers of two."""
    # The logarithm may miss a power of two by its last digit; then the next one is right.
    near = F.floor(F.log2(x))
    near = F.when(_power(near) > x, near - 1).otherwise(near)
    exponent = F.when(x / _power(near) >= 2, near + 1).otherwise(near)
    exponent = F.least(F.greatest(exponent, F.lit(LEAST_EXPONENT)), F.lit(BIAS))
    fraction = ((x / _power(exponent) - 1) * float(FRACTION)).cast("bigint")
    normal = (exponent.cast("bigint") + BIAS) * long_lit(FRACTION) + fraction
    small = (x * _power(F.lit(537)) * _power(F.lit(537))).cast("bigint")
    return (
        F.when(F.isnan(x), long_lit(NOT_A_NUMBER))
        .when(x == float("inf"), long_lit(INFINITY))
        .when(x < 2.0**LEAST_EXPONENT, small)
        .otherwise(normal)
    )
