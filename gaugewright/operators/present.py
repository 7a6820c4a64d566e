"""Clean-up of joined rows for display."""

from pyspark.sql import functions as F

from gaugewright.functions.colours import hex_to_rgb, range_colour
from gaugewright.functions.numbers import nan_to_null, number_text, round_half_even
from gaugewright.functions.text import UNIT_LABELS
from gaugewright.functions.times import DISPLAY_FORMAT, LOCAL_ZONE, local_time_text, utc_wall_clock

MEASURED = ("typical_range_high", "typical_range_low", "value")


def show_local_time(df, column="last_update", zone=LOCAL_ZONE, pattern=DISPLAY_FORMAT):
    """A UTC time as local time text."""
    return df.withColumn(column, local_time_text(utc_wall_clock(df, column), zone, pattern))


def relabel_units(df, labels=None, column="unit"):
    """Replace whole unit texts; a text that only contains one stays."""
    return df.replace(labels or UNIT_LABELS, subset=[column])


def round_columns(df, columns=MEASURED, digits=2):
    """Round to digits, half to even; NaN becomes NULL first."""
    return df.withColumns({c: round_half_even(nan_to_null(F.col(c)), digits) for c in columns})


def classify(df, **colours):
    """Adds ``color``, the hex colour of the range class. Expects rounded columns."""
    return df.withColumn(
        "color",
        range_colour(F.col("value"), F.col("typical_range_low"), F.col("typical_range_high"),
                     **colours),
    )


def colour_as_rgb(df, column="color"):
    return df.withColumn(column, hex_to_rgb(F.col(column)))


def add_position(df):
    """Adds ``position``: longitude, latitude."""
    return df.withColumn("position", F.array("longitude", "latitude"))


def add_tooltip(df, null_text="null"):
    """Adds ``tooltip``, the HTML shown for a station; a missing value reads ``null_text``."""
    def shown(name):
        column = F.col(name)
        text = number_text(column) if name in MEASURED else column.cast("string")
        return F.coalesce(text, F.lit(null_text))

    unit = shown("unit")
    # The labels.
    return df.withColumn("tooltip", F.concat(
        F.lit("<b>Station:</b> "), shown("station_name"),
        F.lit(" (id: "), shown("station_notation"), F.lit(")<br>"),
        F.lit("<b>River:</b> "), shown("river_name"), F.lit("<br>"),
        F.lit("<b>Town:</b> "), shown("town"), F.lit("<br>"),
        F.lit("<b>Updated:</b> "), shown("last_update"), F.lit("<br>"),
        F.lit("<b>Measurement:</b> "), shown("value"), F.lit(" "), unit, F.lit("<br>"),
        F.lit("<b>Typical range:</b> "), shown("typical_range_low"), F.lit(" "), unit,
        F.lit(" - "), shown("typical_range_high"), F.lit(" "), unit,
    ))
