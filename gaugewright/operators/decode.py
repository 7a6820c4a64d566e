"""Topic messages to typed rows, with unusable messages kept aside."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gaugewright.functions.text import hashed_id, random_id
from gaugewright.functions.variants import has_field, is_object, parse_variant
from gaugewright.schemas import CORRUPT, RELATIONAL, message_schema, table_schema

# A time without a zone in a message is UTC, whatever the session says.
_JSON_OPTIONS = {"mode": "PERMISSIVE", "timeZone": "UTC"}


def parse(messages, schema, column="value", marked=False):
    """Adds the fields of the message; an unreadable field becomes NULL, an unreadable message
    gives NULL in all fields.

    The struct is expanded by a generator over one element. Spark pushes a filter on a parsed
    field through a projection by parsing again in the filter, but not through a generator.
    ``marked`` adds the text of a message in which anything could not be read, as ``_corrupt_record``.
    """
    options = _JSON_OPTIONS
    if marked:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType())])
        options = {**options, "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(column), schema, options)
    return messages.select("*", F.inline(F.array(parsed)))


def expand(messages, column):
    """The struct's fields as the only columns."""
    return messages.select(f"{column}.*")


def _reject_reason(value, schema):
    usable = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in schema.names])
    return (
        F.when(usable, F.lit(None).cast("string"))
        .when(value.isNull() | (F.trim(value) == ""), F.lit("empty message"))
        .when(F.col(CORRUPT).isNull(), F.lit("no known field"))
        # Only messages with an unreadable field and no readable one come here.
        .when(~F.ltrim(value).startswith("{"), F.lit("malformed message"))
        .when(is_object(parse_variant(value)), F.lit("no readable field"))
        .otherwise(F.lit("malformed message"))
    )


def message_errors(messages, topic, layout=RELATIONAL):
    """Fields of messages that could not be read and are NULL in their row: row id, ``field``, ``message``.

    Only messages that the typed parse marks are looked at again, as VARIANT.
    """
    schema = message_schema(topic, layout)
    id_column = table_schema(topic, layout).names[0]
    position = [c for c in ("partition", "offset") if c in messages.columns]
    texts = messages.select(F.col("value").cast("string").alias("_text"), *position)
    value = F.col("parsed")
    rows = parse(texts, schema, "_text", marked=True).where(F.col(CORRUPT).isNotNull())
    rows = rows.select("*", F.inline(F.array(F.struct(parse_variant(F.col("_text")).alias("parsed")))))
    lost = F.array(*[
        F.when(F.col(n).isNull() & has_field(value, n), F.lit(n)) for n in schema.names])
    return rows.where(is_object(value)).select(
        message_id(messages.columns, topic, "_text").alias(id_column),
        F.explode(F.array_compact(lost)).alias("field"), F.col("_text").alias("message"))


def message_id(columns, topic, text="value"):
    """Deterministic row id: from topic position where known, else from the whole text, in
    which case identical messages share an id."""
    if {"partition", "offset"} <= set(columns):
        return hashed_id(F.lit(topic), F.col("partition").cast("string"),
                         F.col("offset").cast("string"))
    return hashed_id(F.lit(topic), F.coalesce(text, F.lit("")))


def decode(messages, topic, layout=RELATIONAL, ids="hashed"):
    """All messages as table rows plus ``reject_reason`` and ``reject_value``.

    Accepted messages have a NULL reason; a rejected one keeps its whole text. One plan
    serves both, so a batch is read and parsed once.
    """
    schema = message_schema(topic, layout)
    table = table_schema(topic, layout)
    id_column = table.names[0]
    row_id = random_id() if ids == "random" else message_id(messages.columns, topic, "_text")
    sequence = F.col("offset") if "offset" in messages.columns else F.lit(None)
    position = [c for c in ("partition", "offset") if c in messages.columns]
    texts = messages.select(F.col("value").cast("string").alias("_text"), *position)
    columns = {f.name: f.dataType for f in table.fields}
    rows = parse(texts, schema, "_text", marked=True).select(
        row_id.alias(id_column),
        *[F.col(n).cast(columns[n]).alias(n) for n in schema.names],
        *([sequence.cast("bigint").alias("sequence")] if "sequence" in columns else []),
        _reject_reason(F.col("_text"), schema).alias("reject_reason"),
        "_text",
    )
    rejected = F.col("reject_reason").isNotNull()
    return rows.withColumn("reject_value", F.when(rejected, F.col("_text"))).drop("_text")


def accepted(decoded):
    """Rows for the history table."""
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason", "reject_value")


def rejects(decoded):
    """Unusable messages: ``reject_reason, reject_value``."""
    return decoded.where(F.col("reject_reason").isNotNull()).select(
        "reject_reason", "reject_value"
    )
