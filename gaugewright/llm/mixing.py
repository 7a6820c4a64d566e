"""Mixing sources to target weights by entropy balancing.

The rates r of a source's documents are those nearest to one copy each (least sum of r log r - r + 1)
for which its words add up to the source's target, with r at most ``MOST``. The dual has one
unknown for each source, the tilt t, and r = min(MOST, exp(t x)), x being the size over the source's
mean size. Newton steps on the dual run for all sources at once on the counts of
(source, size), which hold all documents; a bracket catches steps that leave the convex part.

Rates become copies by systematic rounding in order of size: a document gets the whole numbers that the
running sum of rates passes. Since sizes rise along the order, a source misses its target by about its
largest document at most; where that is still far, a few single copies close the gap. The running sum is taken over cells (source, size class, hash class): sums
of cells first, then within each cell, so that a hot source is spread over many tasks.

Everything that decides is summed in whole numbers, so reruns agree. DataFrame functions only.

Defined cases: a NULL text has size 0 and is never taken. A NULL source is a source of its own, in the
last place. Repeated rows count each and share out the copies. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugewright.llm.common import free_name, stage, words_of
from gaugewright.operators.joins import same_key

WEIGHTS = (1, 2, 3)  # repeated over the sources in order
MOST = 3             # copies of a document, and target over size of a source
UNIT = 1 << 24       # a rate of one, as a whole number
HASH_CLASSES = 256
CLOSE = 1e-7         # relative distance to the target at which Newton stops
STEPS = 60
CORRECTIONS = 4      # single copies, for each source, that close what rounding leaves
CLOSE_WORDS = 0.001  # relative distance to the target from which they are needed

_EXACT = "decimal(38,0)"


def source_key(source):
    """Text that differs for each source, also NULL."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _ranked(sources):
    """``sources`` (key, source_size) with ``rank`` from 0 in code-point order, NULL ("n") last.

    Ranks come from a range partitioning: the place within a part and the sizes of the parts before.
    """
    absent = F.col("key") == "n"
    placed = stage(
        sources.repartitionByRange(absent, "key").sortWithinPartitions(absent, "key")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "placed")
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(parts), "part").select(
        "key", "source_size", (F.col("before") + F.col("place")).alias("rank"))


def source_targets(sizes, weights=WEIGHTS, most=MOST):
    """A staged table (key, source_size, target) from rows (key, size)."""
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = stage(_ranked(sources).withColumn("weight", turn), "sources")
    cap = F.col("source_size") * most
    total, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    level, n_capped = (total or 0) / (weight or 1), -1
    while True:  # the capped sources only grow in number; what they leave goes to the others by weight
        above = cap < F.lit(level) * F.col("weight")
        n, kept, share = weighed.agg(
            F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == n_capped or not share:
            break
        n_capped, level = n, ((total or 0) - (kept or 0)) / share
    return stage(weighed.select(
        "key", "source_size",
        F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight")).alias("target")), "targets")


def rate(tilt, size, mean, most=MOST):
    """The rate of a document, in units: at most ``most``, and at ``most`` for a NULL tilt."""
    power = F.least(tilt * size / mean, F.lit(math.log(most)))
    return F.coalesce(F.round(F.exp(power) * UNIT), F.lit(most * UNIT)).cast("long")


def tilts(sizes, targets, most=MOST):
    """A staged table (key, source_size, target, mean, tilt) from rows (key, size).

    The tilt is NULL where the target is the cap itself: every document then has the full rate.
    """
    counts = stage(
        sizes.where("size > 0").groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "size_counts")
    moments = counts.groupBy("key").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
        (F.sum((F.col("size") * F.col("size")).cast(_EXACT) * F.col("n")) / F.sum(F.col("size") * F.col("n")))
        .cast("double").alias("mean_of_words"))
    share = F.try_divide(F.col("target"), F.col("source_size"))
    state = stage(
        targets.join(moments, "key", "left").select(
            "key", "source_size", "target", F.coalesce("mean", F.lit(1.0)).alias("mean"),
            F.when((share < most * (1 - 1e-12)) & (F.col("target") > 0),
                   F.log(share) * F.col("mean") / F.col("mean_of_words")).alias("tilt"),
            F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
            F.lit(1.0).alias("miss")), "tilts")
    for _ in range(STEPS):
        state = stage(_newton(counts, state, most), "tilts")
        if not (state.agg(F.max("miss")).first()[0] or 0) > CLOSE:
            break
    return state.select("key", "source_size", "target", "mean", "tilt")


def _newton(counts, state, most):
    """One step for every source that is not there yet."""
    words = F.col("size") * F.col("n")
    units = rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
    x = F.col("size") / F.col("mean")
    sums = (
        counts.join(state.where("tilt IS NOT NULL").select("key", "tilt", "mean"), "key")
        .groupBy("key").agg(
            F.sum(words.cast("decimal(20,0)") * units.cast("decimal(18,0)")).cast("double").alias("got"),
            F.sum(F.when(units < most * UNIT, F.round(words * x * units).cast(_EXACT))).cast("double")
            .alias("slope"))
        .select("key", (F.col("got") / UNIT).alias("got"), (F.col("slope") / UNIT).alias("slope")))
    both = state.join(sums, "key", "left")
    gap = F.col("got") - F.col("target")
    both = both.withColumns({
        "miss": F.coalesce(F.try_divide(F.abs(gap), F.col("target")), F.lit(0.0)),
        "low": F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")),
        "high": F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high")),
    })
    step = F.col("tilt") - F.try_divide(gap, F.col("slope"))
    inside = (step > F.coalesce("low", F.lit(float("-inf")))) & (step < F.coalesce("high", F.lit(float("inf"))))
    wide = F.abs("tilt") + 1
    tilt = (
        F.when(F.col("miss") <= CLOSE, F.col("tilt"))
        .when((F.col("slope") > 0) & inside, step)
        .when(F.col("low").isNotNull() & F.col("high").isNotNull(),
              F.when(F.col("high") - F.col("low") > 1e-14 * wide, (F.col("low") + F.col("high")) / 2)
              .otherwise(F.col("high")))
        .when(gap < 0, F.col("tilt") + wide).otherwise(F.col("tilt") - wide))
    narrow = F.col("high") - F.col("low") <= 1e-14 * wide
    return both.select(
        "key", "source_size", "target", "mean", tilt.alias("tilt"), "low", "high",
        F.when(narrow, F.lit(0.0)).otherwise(F.col("miss")).alias("miss"))


def with_copies(docs, doc_id="doc_id", text="text", source="source", weights=WEIGHTS, most=MOST):
    """``docs`` with a struct column of size, source_size, target and copies; returns it and its name.

    The texts are read twice: once for their sizes, and once for the result.
    """
    return _copied(docs, doc_id, words_of(F.col(text)), source_key(F.col(source)), weights, most)


def _copied(docs, doc_id, size, key, weights, most):
    figures = {"size": size, "key": key, "hash": F.xxhash64(F.col(doc_id))}
    bare = stage(docs.select(
        F.col(f"`{doc_id}`").alias("id"), *[value.alias(name) for name, value in figures.items()]), "sizes")
    sizes = bare.select("key", "size")
    solved = tilts(sizes, source_targets(sizes, weights, most), most)

    mix = free_name(docs, "mix")
    bits = F.length(F.bin("size"))
    size_class = bits * 64 + F.floor(F.col("size") / F.pow(F.lit(2.0), F.greatest(bits - 6, F.lit(0))))
    class_of = F.struct(
        F.col("size"), F.col("key"), F.col("hash"), size_class.cast("int").alias("size_class"),
        F.pmod("hash", F.lit(HASH_CLASSES)).cast("int").alias("hash_class"))

    def placed(rows, columns):
        """(columns, at): ``at`` holds the cell, the rate and the source's figures."""
        at = rows.withColumn("at", class_of).select(*columns, "at")
        return at.join(solved, F.col("at.key") == F.col("key")).select(*columns, F.struct(
            "at.*", "source_size", "target",
            F.when(F.col("at.size") > 0, rate(F.col("tilt"), F.col("at.size"), F.col("mean"), most))
            .otherwise(F.lit(0)).alias("rate")).alias("at"))

    cell = ["at.key", "at.size_class", "at.hash_class"]

    def drawn(rows, columns, order):
        """``rows`` with the running sum of their rates in the cell, and their copies."""
        within = (Window.partitionBy(*cell).orderBy("at.size", "at.hash", order)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        summed = placed(rows, columns).withColumn("sum", F.sum("at.rate").over(within))
        passed = summed.join(
            cells, (F.col("at.key") == F.col("cell.key"))
            & (F.col("at.size_class") == F.col("cell.size_class"))
            & (F.col("at.hash_class") == F.col("cell.hash_class")))
        to = F.col("before") + F.col("sum") + UNIT // 2
        copies = F.shiftright(to, 24) - F.shiftright(to - F.col("at.rate"), 24)
        return passed.select(*columns, "at", "sum", copies.alias("copies"))

    sums = stage(placed(bare, []).groupBy(*cell).agg(F.sum("at.rate").alias("rate")), "cell_rates")

    def rising(*keys, by):
        return Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)

    # Before a cell come the smaller size classes of its source, and the hash classes before it in its own:
    # some hundred rows to a window, however large the source.
    sizes_before = sums.groupBy("key", "size_class").agg(F.sum("rate").alias("rate")).select(
        F.col("key").alias("s_key"), F.col("size_class").alias("s_size_class"),
        F.coalesce(F.sum("rate").over(rising("key", by="size_class")), F.lit(0)).alias("smaller"))
    in_class = F.coalesce(F.sum("rate").over(rising("key", "size_class", by="hash_class")), F.lit(0))
    cells = stage(sums.withColumn("before", in_class).join(
        sizes_before, (F.col("key") == F.col("s_key")) & (F.col("size_class") == F.col("s_size_class"))
    ).select(
        F.struct("key", "size_class", "hash_class").alias("cell"),
        (F.col("before") + F.col("smaller")).alias("before")), "cells")
    first = stage(drawn(bare, ["id"], F.col("id")).where("at.rate > 0").select(
        "at.key", "at.size_class", "at.hash_class", "sum", "at.size", "copies"), "drawn")
    changes = _corrections(first, solved, most)

    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[value.alias(name) for name, value in figures.items()])
    rows = drawn(whole, ["row"], F.col(f"row.`{doc_id}`"))
    joined = rows.join(
        changes, (F.col("at.key") == F.col("c_key")) & (F.col("at.size_class") == F.col("c_size_class"))
        & (F.col("at.hash_class") == F.col("c_hash_class")) & (F.col("sum") == F.col("c_sum"))
        & (F.col("at.rate") > 0), "left")
    copies = F.col("copies") + F.coalesce("change", F.lit(0))
    return joined.select(
        "row.*", F.struct("at.size", "at.source_size", "at.target", copies.alias("copies")).alias(mix)), mix


def _corrections(drawn, solved, most, rounds=CORRECTIONS, close=CLOSE_WORDS):
    """A staged table of single copies to add or take away, at most ``rounds`` for each source.

    Each round takes, for every source that is not yet near its target, the one document whose size is nearest to
    what is missing or too much. Only sources of few documents need it. A document is known by its cell and its
    running sum, which rises with every document that has a rate.
    """
    changes = drawn.where("false").select(
        F.col("key").alias("c_key"), F.col("size_class").alias("c_size_class"),
        F.col("hash_class").alias("c_hash_class"), F.col("sum").alias("c_sum"),
        F.col("copies").alias("change"), F.col("size").alias("c_size"))
    got = drawn.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    got = stage(solved.select("key", "target").join(got, "key", "left").select(
        "key", "target", F.coalesce("got", F.lit(0)).alias("got")), "got")
    for _ in range(rounds):
        added = changes.groupBy(F.col("c_key").alias("key")).agg(
            F.sum(F.col("change") * F.col("c_size")).alias("added"))
        off = got.join(added, "key", "left").select(
            "key", (F.col("target") - F.col("got") - F.coalesce("added", F.lit(0))).alias("gap"), "target")
        # Stored, it is broadcast where it is small; else a hot source is split, as both sides are dealt out anew.
        off = stage(off.where(F.abs("gap") > F.lit(close) * F.col("target")).withColumnRenamed("key", "off_key"), "off")
        if off.isEmpty():
            break
        now = drawn.join(off, same_key(F.col("key"), F.col("off_key"))).join(
            changes.groupBy("c_key", "c_size_class", "c_hash_class", "c_sum").agg(F.sum("change").alias("change")),
            (F.col("key") == F.col("c_key")) & (F.col("size_class") == F.col("c_size_class"))
            & (F.col("hash_class") == F.col("c_hash_class")) & (F.col("sum") == F.col("c_sum")), "left")
        copies = F.col("copies") + F.coalesce("change", F.lit(0))
        able = F.when(F.col("gap") > 0, copies < most).otherwise(copies > 0)
        left = F.abs(F.abs("gap") - F.col("size"))
        best = now.where(able & (left < F.abs("gap"))).groupBy("key").agg(F.min(F.struct(
            left.alias("left"), "size_class", "hash_class", "sum", "size",
            F.signum("gap").cast("long").alias("sign"))).alias("best"))
        new = best.select(
            F.col("key").alias("c_key"), F.col("best.size_class").alias("c_size_class"),
            F.col("best.hash_class").alias("c_hash_class"), F.col("best.sum").alias("c_sum"),
            F.col("best.sign").alias("change"), F.col("best.size").alias("c_size"))
        size = changes.count()
        changes = stage(changes.unionByName(new), "changes")
        if changes.count() == size:
            break
    return changes.groupBy("c_key", "c_size_class", "c_hash_class", "c_sum").agg(F.sum("change").alias("change"))


def mix_report(docs, doc_id="doc_id", text="text", source="source", weights=WEIGHTS, most=MOST):
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    slim = stage(docs.select(
        F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("size"),
        source_key(F.col(source)).alias("key")), "sized")
    rows, mix = _copied(slim, "doc_id", F.col("size"), F.col("key"), weights, most)
    return rows.select(
        "doc_id", f"{mix}.size", f"{mix}.source_size", f"{mix}.target",
        (F.col(f"{mix}.copies") * F.col(f"{mix}.size")).alias("taken"), f"{mix}.copies")


def mix_documents(docs, doc_id="doc_id", text="text", source="source", weights=WEIGHTS, most=MOST):
    """``docs`` with each row repeated by its number of copies, all columns unchanged."""
    rows, mix = with_copies(docs, doc_id, text, source, weights, most)
    copy = free_name(rows, "copy")
    taken = rows.where(F.col(f"{mix}.copies") > 0)
    taken = taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(f"{mix}.copies").cast("int"))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
