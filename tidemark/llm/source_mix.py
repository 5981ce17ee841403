"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source's ratio of target to size says how often its documents enter the mix. The whole part of the ratio is
taken of every document for certain. The rest is the inclusion probability of one more copy: documents are
ranked by their random odds over the odds of inclusion, and the first are taken until the words reach the
target as closely as whole documents allow. Ratios, and so inclusion probabilities, differ between sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged

#: Documents in a slice of a source's ranking; only the slice in which a source's sample ends is ordered.
SLICE_ROWS = 2_000


def word_count(text: Column) -> Column:
    """Runs of anything but space and tab to carriage return; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2) -> DataFrame:
    """``sizes(source, source_size, ...)``, a row per source, with ``target`` added.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``percent`` of all sizes; no
    target is above ``most`` times its source's size, and what is cut off goes to the others by weight until none is
    above. Targets so have the form ``min(cap, level * weight)``: in the order of cap to weight, the first sources
    are at their caps, and the level follows from what they leave. A source of size 0 has the target 0.
    """
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*(F.lit(w) for w in weights))
    weighed = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(place) - 1) % len(weights)) + 1).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = (F.sum("source_size").over(everything) * percent / 100) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = weighed.withColumn("level", left / rest).withColumn("place", F.row_number().over(order))
    levelled = levelled.withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    level = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return levelled.select(*sizes.columns, target.alias("target"))


def random_unit(*columns: Column, seed: str) -> Column:
    """A number in (0, 1) from a digest of the columns, the same on every run."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *columns))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **shares) -> DataFrame:
    """``(id, size, source, source_size, target, taken)`` of every row; ``taken`` counts the words of all its copies.

    Sizes are word counts (null text: 0). The extra copies of a source end at the document whose inclusion
    brings the words nearest to the target, the earlier one on a tie; so a source misses its target by at most half
    a document. Rows without words come with 0 taken. The random number depends on id (where it is null, on the
    text) and size alone; rows that agree in both and in source rank next to each other, in an order that changes
    no result. A null source is a source like others.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), word_count(text).alias("size"), F.col(source_col).alias("source"), F.when(F.col(id_col).isNull(), F.md5(F.coalesce(text, F.lit("")))).alias("digest"))
    u = random_unit(F.coalesce(F.col("id").cast("string"), F.col("digest")), F.col("size").cast("string"), seed=seed)
    rows = staged(rows.withColumn("u", u).drop("digest"))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    targets = source_targets(sources, **shares)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("copies", copies.cast("long"))
    targets = targets.withColumn("more", F.col("target") - F.col("copies") * F.col("source_size"))
    targets = targets.withColumn("p", F.when(F.col("source_size") > 0, F.col("more") / F.col("source_size")).otherwise(0.0))
    targets = staged(targets.withColumn("slices", F.floor(F.col("source_rows") / SLICE_ROWS) + 1))

    u = F.col("u")
    rank = F.when(F.col("p") > 0, (u / (1 - u)) * ((1 - F.col("p")) / F.col("p"))).otherwise(float("inf"))
    ranked = rows.join(targets.withColumnRenamed("source", "s"), rows["source"].eqNullSafe(F.col("s"))).drop("s")
    ranked = staged(ranked.withColumn("rank", rank).withColumn("slice", F.floor(u * F.col("slices"))))

    # One row per slice: the sample of a source ends in the first slice that reaches what is still to be taken.
    sums = ranked.where("more > 0").groupBy("source", "more", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("words_before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    ends = ends.where("words_before < more AND words_before + words >= more").selectExpr("source AS s", "slice AS end_slice", "words_before")
    told = ranked.join(ends, ranked["source"].eqNullSafe(F.col("s")), "left").drop("s")
    within = told.where("slice = end_slice AND more > 0")
    running = Window.partitionBy("source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("words_before") + F.sum("size").over(running)
    nearest = F.abs(upto - F.col("more")) < F.abs(upto - F.col("size") - F.col("more"))
    within = within.withColumn("extra", (upto <= F.col("more")) | ((upto - F.col("size") < F.col("more")) & nearest))
    outside = told.where("more <= 0 OR end_slice IS NULL OR slice <> end_slice")
    outside = outside.withColumn("extra", (F.col("more") > 0) & (F.col("end_slice").isNull() | (F.col("slice") < F.col("end_slice"))))
    taken = F.col("size") * (F.col("copies") + F.when(F.col("extra"), 1).otherwise(0))
    return within.unionByName(outside).select("id", "size", "source", "source_size", "target", taken.alias("taken"))
