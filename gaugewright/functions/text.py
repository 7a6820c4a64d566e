"""Message JSON, row ids and tooltip text."""

from pyspark.sql import functions as F

# Fixed value.
MESSAGE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Fixed value: whole unit text and its short form.
UNIT_LABELS = {"http://qudt.org/1.1/vocab/unit#Meter": "m"}


def message_json(row):
    """A struct as message text; null fields are written, times carry microseconds in UTC."""
    return F.to_json(
        row,
        {"timestampFormat": MESSAGE_TIME_FORMAT, "ignoreNullFields": "false", "timeZone": "UTC"},
    )


def hashed_id(*parts):
    """A UUID-shaped id (version 8: custom content) derived from the parts.

    The same message gets the same id when it is read again, unlike a random id.
    """
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.regexp_replace(
        digest, "^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$", "$1-$2-8$3-8$4-$5"
    )


def random_id():
    """A random id per row; a row read twice gets two ids."""
    return F.uuid()
