"""Documents to items, items to measures, nested to flat."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugewright.functions.variants import is_object, misshapen, odd_fields, parse_variant, typed_fields
from gaugewright.schemas import CORRUPT, MEASUREMENT_ITEM, STATION_ITEM


BAD_DOCUMENT = "malformed document"
BAD_ITEM = "malformed item"


def unnest_items(documents, item_schema, lists=None):
    """One row per element of ``items``: ``raw`` text, typed ``item``, ``bad``, ``odd``, ``item_pos``.

    Other document columns (such as ``fetched_at``) are kept. ``width`` is the largest number
    of rows one item of the document can give, for a sequence over the document's rows;
    ``lists`` names the item's list that is unnested later. A field of another type is NULL, or its JSON text
    where a text belongs, and is named in ``odd``; the item goes on. A document without ``items``, or an item that is no
    object, or has something else in place of an inner object or list, fails the job. Where bad documents are kept, each gives
    a row with a NULL ``item``, its whole text, and in ``bad`` what is wrong.
    """
    schema = StructType.fromDDL(item_schema)
    keep = CORRUPT in documents.columns
    if keep:
        otherwise = F.array(F.struct(F.col(CORRUPT).alias("raw"), F.lit(True).alias("whole")))
        usable = F.col("items").isNotNull() & F.col(CORRUPT).isNull()
    else:
        otherwise = F.raise_error(F.lit("a document has no items"))
        usable = F.col("items").isNotNull()
    kept = [c for c in documents.columns if c not in ("items", CORRUPT)]
    texts = documents.select(*kept, F.when(usable, F.transform(
        "items", lambda text: F.struct(text.alias("raw"), F.lit(False).alias("whole"))
    )).otherwise(otherwise).alias("texts"))
    entries = _with_width(texts, kept, lists) if lists else _one_by_one(texts, kept)
    value = F.col("parsed")
    bad = (
        F.when(F.col("whole"), BAD_DOCUMENT)
        .when(~is_object(value) | misshapen(value, schema), BAD_ITEM)
    )
    rows = entries.select(*kept, "width", "item_pos", "raw", "parsed", bad.alias("bad"))
    if not keep:
        text = F.concat(F.lit(f"{BAD_ITEM}: "), F.coalesce("raw", F.lit("null")))
        good = F.when(F.col("bad").isNotNull(), F.raise_error(text)).otherwise(F.lit(True))
    else:
        good = F.col("bad").isNull()
    return rows.select(
        *kept, "width", "item_pos", "raw",
        F.when(good, F.struct(*typed_fields(value, schema))).alias("item"), "bad",
        F.when(F.col("bad").isNull(), odd_fields(value, schema)).alias("odd"),
    )


def _exploded(entries, kept, column):
    # The outer form, then a filter: for the inner form Spark infers a filter on the array and
    # pushes it below what makes the array, which would parse every document again.
    return entries.select(
        *kept, F.posexplode_outer(column).alias("item_pos", "entry")
    ).where(F.col("item_pos").isNotNull())


def _one_by_one(texts, kept):
    """Items are parsed after they are split off, in generated code, and large documents can be
    spread before. The generator over one element keeps fields and filters from parsing again."""
    rows = _exploded(texts, kept, "texts").select(
        *kept, "item_pos", "entry.raw", "entry.whole")
    return rows.select(
        *rows.columns, F.lit(1).cast("bigint").alias("width"),
        F.inline(F.array(F.struct(F.when(~F.col("whole"), parse_variant(F.col("raw"))).alias("parsed")))),
    )


def _with_width(texts, kept, lists):
    """Items are parsed within their document, whose rows need the longest list."""
    entries = texts.select(*kept, F.transform("texts", lambda t: F.struct(
        t["raw"].alias("raw"), t["whole"].alias("whole"),
        F.when(~t["whole"], parse_variant(t["raw"])).alias("parsed"),
    )).alias("entries"))
    sizes = F.transform("entries", lambda e: F.coalesce(
        F.size(F.try_variant_get(e["parsed"], f"$['{lists}']", "array<variant>")), F.lit(0)))
    width = F.greatest(F.array_max(sizes), F.lit(1)).cast("bigint")
    return _exploded(entries.withColumn("width", width), [*kept, "width"], "entries").select(
        *kept, "width", "item_pos", "entry.raw", "entry.whole", "entry.parsed")


def field_errors(items):
    """Fields of items that have another type than they should: ``raw, item_pos, field``."""
    return items.select("raw", "item_pos", F.explode("odd").alias("field"))


def station_items(documents):
    return unnest_items(documents, STATION_ITEM, lists="measures")


def measurement_items(documents):
    return unnest_items(documents, MEASUREMENT_ITEM)


def unnest_measures(items):
    """One row per measure of an item; an empty list gives no row. Adds ``measure_pos``,
    ``measures_id``. Items without a list give none either and are reported as rejects by
    the ingest plan."""
    return items.select("*", F.posexplode("item.measures").alias("measure_pos", "measure")).select(
        *items.columns, "measure_pos", F.col("measure.`@id`").alias("measures_id")
    )


def with_reading(items):
    """Only items that carry a latest reading."""
    return items.where(F.col("item.latestReading").isNotNull())


def matching(items, wanted):
    """Optional equality filter on raw attributes, e.g. ``{"status": "Active"}``.

    The provider normally applies these before delivery; it is for landed files that hold
    more. What could not be parsed stays, to be reported.
    """
    for name, value in wanted.items():
        attribute = F.get_json_object("raw", f"$['{name}']")
        items = items.where(F.col("bad").isNotNull() | (attribute == F.lit(value)))
    return items


def flat_station(rows):
    """Station message fields from an item with its measure and stage scale."""
    return rows.select(
        *[c for c in rows.columns if c not in ("item", "bad", "odd", "measures_id", "high", "low")],
        F.col("item.RLOIid").alias("rloiid"),
        F.col("item.label").alias("label"),
        "measures_id",
        F.col("item.notation").alias("notation"),
        F.col("item.riverName").alias("rivername"),
        F.col("high").alias("typicalrangehigh"),
        F.col("low").alias("typicalrangelow"),
        F.col("item.town").alias("town"),
        F.col("item.lat").alias("lat"),
        F.col("item.long").alias("long"),
    )


def flat_measurement(rows):
    """Measurement message fields from an item."""
    return rows.select(
        *[c for c in rows.columns if c not in ("item", "bad", "odd")],
        F.col("item.`@id`").alias("id"),
        F.col("item.stationReference").alias("stationreference"),
        F.col("item.latestReading.dateTime").alias("datetime"),
        F.col("item.latestReading.value").alias("value"),
        F.col("item.unit").alias("unit"),
    )
