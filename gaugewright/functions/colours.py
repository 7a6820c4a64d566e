"""Range classes and their colours."""

from pyspark.sql import functions as F

# Fixed values.
IN_RANGE = "#05a300"
BELOW_RANGE = "#0033ff"
OTHER = "#ff0000"


def range_colour(value, low, high, in_range=IN_RANGE, below=BELOW_RANGE, other=OTHER):
    """Colour of a reading against its typical range, both ends included.

    A comparison with NULL is not true, so a reading with an unknown range gets ``other``.
    """
    return (
        F.when((value >= low) & (value <= high), F.lit(in_range))
        .when(value < low, F.lit(below))
        .otherwise(F.lit(other))
    )


def hex_to_rgb(colour):
    """``#rrggbb`` as ``[r, g, b]``."""
    digits = F.ltrim(colour, F.lit("#"))
    return F.array(*[F.conv(F.substring(digits, at, 2), 16, 10).cast("int") for at in (1, 3, 5)])
