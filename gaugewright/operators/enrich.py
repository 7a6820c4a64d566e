"""Stage-scale enrichment: one join in place of one request per station."""

from pyspark.sql import functions as F

from gaugewright.operators.joins import same_key
from gaugewright.operators.latest import latest_by_key


def stage_scale_table(documents):
    """``url, high, low`` from landed stage-scale documents, the latest fetch per URL."""
    usable = documents.where(F.col("items").isNotNull())
    return latest_by_key(usable, "url", "fetched_at", ["items"]).select(
        "url",
        F.col("items.typicalRangeHigh").alias("high"),
        F.col("items.typicalRangeLow").alias("low"),
    )


def enrich_stage_scale(items, stage_scale, link="item.stageScale", strict=False):
    """Left join on the stage-scale URL: adds ``high``, ``low`` and ``scale_found``.

    No broadcast hint: the table grows with the stations, so Spark broadcasts it only while
    its size is under the threshold, and otherwise shuffles both sides by URL, where
    adaptive execution splits a URL that holds many items. ``strict`` fails the job on an
    item without a scale.
    """
    link = F.col(link)
    scales = stage_scale.select("url", "high", "low", F.lit(True).alias("found"))
    joined = items.join(scales, same_key(link, F.col("url")), "left")
    found = F.coalesce("found", F.lit(False))
    if strict:
        problem = F.concat(F.lit("no stage scale document: "), F.coalesce(link, F.lit("no link")))
        found = F.when(F.col("found"), F.lit(True))
        if "bad" in items.columns:  # kept as a reject for another reason
            found = found.when(F.col("bad").isNotNull(), F.lit(False))
        found = found.otherwise(F.raise_error(problem))
    return joined.withColumn("scale_found", found).drop("url", "found")
