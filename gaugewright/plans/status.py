"""Current status of every station, ready for a map or a table."""

from gaugewright.functions.times import DISPLAY_FORMAT, LOCAL_ZONE
from gaugewright.operators.latest import latest_by_key
from gaugewright.operators.present import (
    add_position,
    add_tooltip,
    classify,
    colour_as_rgb,
    relabel_units,
    round_columns,
    show_local_time,
)
from gaugewright.plans.views import stations_measurements


def present(joined, zone=LOCAL_ZONE, pattern=DISPLAY_FORMAT, unit_labels=None, colours=None):
    """Table rows from the joined view: local time, unit, rounding, range colour as RGB."""
    rows = show_local_time(joined, zone=zone, pattern=pattern)
    rows = round_columns(relabel_units(rows, unit_labels))
    return colour_as_rgb(classify(rows, **(colours or {})))


def map_rows(joined, **settings):
    """Table rows plus position and tooltip."""
    return add_tooltip(add_position(present(joined, **settings)))


def station_status(stations, measurements, latest=latest_by_key, **settings):
    """Map rows straight from both histories."""
    return map_rows(stations_measurements(stations, measurements, latest), **settings)
