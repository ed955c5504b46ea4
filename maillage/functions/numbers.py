"""Numbers out of text, rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Measures are summed as decimals: the total is then the same whatever order the
# tasks finish in, so a re-run after a lost executor cannot flip a rounding. 20 digits
# before the point and 10 after it, so that products and sums still have room.
MEASURE = "decimal(30,10)"


def _number(text: Column) -> Column:
    """Double in a text. The JVM also reads ``12d``, ``1f`` and ``0x1p3``, which are no
    numbers in the sources: texts with such letters give null, infinity apart."""
    foreign = text.rlike("[dDfFxX]") & ~F.lower(text).contains("inf")
    return F.when(~foreign, text.try_cast("double"))


def to_double(col: Column) -> Column:
    """Number in a text, null when there is none."""
    return _number(col.cast("string"))


def to_int(col: Column) -> Column:
    """Integer in a text; decimals round half away from zero instead of giving null."""
    return _nearest(to_double(col)).try_cast("int")


def to_measure(col: Column, kind: str = MEASURE) -> Column:
    """Summable number in a text, null when there is none. A number too large for
    ``kind`` is an error: leaving it out would falsify the sum in silence."""
    text = col.cast("string")
    value, number = text.try_cast(kind), _number(text)
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    too_large = F.raise_error(F.concat(F.lit(f"does not fit {kind}: "), text))
    return F.when(value.isNull() & finite, too_large).otherwise(F.when(number.isNotNull(), value))


def spaced_number(col: Column, target: str = "double") -> Column:
    """``'12 345'`` to 12345; null when what is left is no number."""
    stripped = F.replace(col.cast("string"), F.lit(" "), F.lit(""))
    if target == "int":
        return to_int(stripped)
    return _number(stripped) if target == "double" else stripped.try_cast(target)


def comma_number(col: Column) -> Column:
    """Decimal comma and an optional percent suffix: ``'3,5 %'`` to 3.5."""
    text = F.replace(col.cast("string"), F.lit(","), F.lit("."))
    return _number(F.replace(text, F.lit(" %"), F.lit("")))


def _nearest(col: Column) -> Column:
    """Nearest whole double, halves away from zero.

    ``rint`` settles halves towards even; where that was downwards, one is added. All
    in double arithmetic: ``round`` would build a decimal object per row.
    """
    size = F.abs(col)
    even = F.rint(size)
    return F.signum(col) * F.when(size - even == 0.5, even + 1.0).otherwise(even)


def round_half(col: Column, digits: int) -> Column:
    """Round the scaled binary value, half away from zero.

    Spark's ``round(x, n)`` works on the printed decimal of x and disagrees with
    scale-and-round on values such as 1.005 or 0.285.
    """
    power = F.lit(float(10**digits))
    return _nearest(col.cast("double") * power) / power


def ratio(
    numerator: Column,
    denominator: Column,
    *,
    scale: float = 1.0,
    digits: int | None = None,
    scale_first: bool = False,
) -> Column:
    """numerator / denominator x scale; null for a zero denominator.

    ``scale_first`` multiplies before dividing, which rounds once less.
    """
    top, bottom = numerator.cast("double"), denominator.cast("double")
    if scale_first:
        value = F.try_divide(top * F.lit(float(scale)), bottom)
    else:
        value = F.try_divide(top, bottom)
        if scale != 1.0:
            value = value * F.lit(float(scale))
    return value if digits is None else round_half(value, digits)
