"""Landed JSON documents, as a batch or a stream of files."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugewright.functions.variants import is_object, parse_variant, typed_fields
from gaugewright.schemas import CORRUPT, DOCUMENT, STAGE_SCALE_DOCUMENT, STAGE_SCALE_TEXT


def _parsing(fields, on_bad):
    """Schema and JSON options for documents that fail the job, or are kept, when bad."""
    options = {"columnNameOfCorruptRecord": CORRUPT, "timeZone": "UTC"}
    if on_bad == "fail":
        return fields, {**options, "mode": "FAILFAST"}
    if on_bad == "keep":
        return f"{fields}, {CORRUPT} STRING", {**options, "mode": "PERMISSIVE"}
    raise ValueError(f"on_bad must be 'fail' or 'keep', not {on_bad!r}")


def _read(spark, path, fields, stream, multi_line, on_bad, fetched_at, options):
    if fetched_at:
        fields += f", `{fetched_at}` TIMESTAMP"
    schema, parsing = _parsing(fields, on_bad)
    documents = (
        (spark.readStream if stream else spark.read)
        .options(**{**parsing, "multiLine": str(multi_line).lower(), **(options or {})})
        .schema(schema)
        .json(path)
    )
    if fetched_at:
        return documents.withColumnRenamed(fetched_at, "fetched_at")
    return documents.withColumn("fetched_at", F.col("_metadata.file_modification_time"))


def read_documents(spark, path, stream=False, multi_line=True, on_bad="fail", fetched_at=None,
                   options=None):
    """Station or measurement documents: ``items`` (raw item texts) and ``fetched_at``.

    ``multi_line=True`` is one document per file, parsed by one task, as a provider sends
    it. Land many or large documents one per line with ``multi_line=False``: such files
    split across tasks. A bad document fails the job; with ``on_bad="keep"`` it is a row whose
    ``_corrupt_record`` holds its text, and ends up among the rejects. ``fetched_at`` names a
    field with the fetch time; without it the file's modification time counts.
    """
    return _read(spark, path, DOCUMENT, stream, multi_line, on_bad, fetched_at, options)


def read_items(spark, path, stream=False, on_bad="fail", fetched_at=None, options=None):
    """Landed items, one raw item per line, as documents of one item each.

    A document is parsed by one task; items that come in bulk should land like this, since
    such files split anywhere between lines. Blank lines are no items. A line that is not an
    item fails the job, or with ``on_bad="keep"`` ends up among the rejects. ``fetched_at``
    names a field of the item with the fetch time, as for documents.
    """
    _parsing(DOCUMENT, on_bad)
    reader = (spark.readStream if stream else spark.read).options(**(options or {}))
    lines = reader.text(path).where(F.trim("value") != "")
    stamped = F.col("_metadata.file_modification_time")
    if fetched_at:
        named = F.from_json("value", f"`{fetched_at}` TIMESTAMP", {"timeZone": "UTC"})[fetched_at]
        stamped = F.coalesce(named, stamped)
    kept = [F.lit(None).cast("string").alias(CORRUPT)] if on_bad == "keep" else []
    return lines.select(F.array("value").alias("items"), stamped.alias("fetched_at"), *kept)


def read_stage_scales(spark, path, multi_line=True, on_bad="fail", fetched_at=None, options=None, stream=False):
    """Stage-scale documents, landed with their ``url``; ``path`` may be a list of files.
    ``fetched_at`` is as for documents."""
    documents = _read(spark, path, STAGE_SCALE_TEXT, stream, multi_line, on_bad, fetched_at, options)
    return _with_scale(documents, on_bad)


def _with_scale(documents, on_bad="fail"):
    """The scale's numbers out of the text of ``items``; what is no number is NULL. Items that are no object
    fail the job, or where bad documents are kept count as missing."""
    schema = StructType.fromDDL(STAGE_SCALE_DOCUMENT)["items"].dataType
    value = F.col("scale_value")
    read = documents.select("*", F.inline(F.array(F.struct(parse_variant(F.col("items")).alias("scale_value")))))
    scale = F.when(is_object(value), F.struct(*typed_fields(value, schema)))
    if on_bad == "fail":
        text = F.concat(F.lit("malformed stage scale: "), F.col("items"))
        scale = F.when(F.col("items").isNotNull() & ~is_object(value), F.raise_error(text)).otherwise(scale)
    return read.select(*[scale.alias("items") if c == "items" else F.col(f"`{c}`") for c in documents.columns])


def parse_documents(texts, column="document", on_bad="fail"):
    """Documents already held as text in a column, for example in a table; other columns stay."""
    schema, parsing = _parsing(DOCUMENT, on_bad)
    kept = [c for c in texts.columns if c != column]
    parsed = texts.withColumn("_doc", F.from_json(column, schema, parsing))
    if on_bad == "fail":
        return parsed.select(*kept, "_doc.items")
    # Blank texts and documents without items are bad as well.
    bad = F.when(F.col("_doc.items").isNull(), F.coalesce(F.col(column), F.lit("")))
    return parsed.select(*kept, "_doc.items", F.coalesce(f"_doc.{CORRUPT}", bad).alias(CORRUPT))


def parse_stage_scales(texts, column="document"):
    """Stage-scale documents held as text in a column; other columns stay. A text that is
    not JSON fails the job."""
    kept = [c for c in texts.columns if c != column]
    schema, parsing = _parsing(STAGE_SCALE_TEXT, "fail")
    # Expanded by a generator, so that filters on the fields do not parse again.
    return _with_scale(texts.select(*kept, F.inline(F.array(F.from_json(column, schema, parsing)))))
