"""Numbers as a NumPy-based reader would see them."""

from pyspark.sql import functions as F


def nan_to_null(value):
    """NaN as NULL: Spark orders NaN above every number, which would turn a comparison true."""
    return F.when(~F.isnan(value), value)


def round_half_even(value, digits=2):
    """Scale, round half to even on the double, scale back, as ``numpy.round`` does.

    ``round`` goes half away from zero and ``bround`` works on the decimal text, so both
    differ from it on halves.
    """
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def number_text(value, digits=2):
    """The shortest plain text of a rounded number: 1, 0.5, 0.25."""
    exact = value.try_cast(f"decimal(38,{digits})").cast("string")
    plain = F.regexp_replace(exact, r"\.?0+$", "")
    return F.coalesce(plain, value.cast("string"))
