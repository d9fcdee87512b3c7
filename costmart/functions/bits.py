"""Doubles as longs of the same order, in built-in expressions only.

The image of a double x >= 0 is its 64 IEEE 754 bits read as a whole number, that of x < 0 the
bits of -x, inverted; so images compare as the numbers do, both zeros have the image 0, and
-infinity, infinity and NaN (the greatest, as in Spark's order) are values like any other.
Leading bits of an image are sign, exponent and first digits of the fraction, which makes them
cells of a histogram that needs no bounds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY_BITS = 0x7FF << 52
NAN_BITS = INFINITY_BITS + (1 << 51)
_ONE = float(1 << 52)
_SMALLEST_NORMAL = 2.0 ** -1022


def _power(e: Column) -> Column:
    return F.pow(F.lit(2.0), e.cast("double"))  # exact for whole exponents


def ordered_bits(x: Column) -> Column:
    """The order-preserving long of a double column (null stays null)."""
    size = F.abs(x)
    guess = F.floor(F.log2(size))  # may be off by one beside a power of two
    e = guess - (_power(guess) > size).cast("long") + (_power(guess + 1) <= size).cast("long")
    normal = (e + 1023) * F.lit(1 << 52) + ((size / _power(e) - 1.0) * F.lit(_ONE)).cast("long")
    subnormal = (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    bits = (F.when(x.isNull(), F.lit(None).cast("long")).when(F.isnan(x), F.lit(NAN_BITS)).when(size == F.lit(float("inf")), F.lit(INFINITY_BITS))
             .when(size == 0.0, F.lit(0).cast("long")).when(size < F.lit(_SMALLEST_NORMAL), subnormal).otherwise(normal))
    return F.when(x < 0.0, F.bitwise_not(bits)).otherwise(bits)


def from_ordered_bits(image: Column) -> Column:
    """The double of an image."""
    bits = F.when(image < 0, F.bitwise_not(image)).otherwise(image)
    e, fraction = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    size = (F.when(bits > F.lit(INFINITY_BITS), F.lit(float("nan"))).when(bits == F.lit(INFINITY_BITS), F.lit(float("inf")))
             .when(e == 0, fraction * F.lit(5e-324)).otherwise((1.0 + fraction / F.lit(_ONE)) * _power(e - 1023)))
    return F.when(image < 0, -size).otherwise(size)
