"""Mixing sources to target weights, in SQL functions only.

Sizes are summed per source and shared out again by weight, where no source gets more
than ``cap`` times what it has and the excess goes to the others by weight. The rate of a
source is its target over its size: every document is taken floor(rate) times, and once
more when a number made from its id and a seed falls below the fraction.

Defined results: a null or empty text has size 0. Null is a source of its own, the last
in order. A source without words has target 0 and rate 0. Rows that share an id share
the decision; equal rows are all taken alike. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.tables import Workspace
from tidewater.session import broadcast_if_small

# What separates words, and the digits of a digest that make a fraction.
WORD = r"[^\x20\x09-\x0D]+"
HEX_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``source, source_size, target, rate`` from ``sized (source, size)``.

    Sizes are aggregated before they are shuffled, so a source of any size is one row
    per task. What follows runs over one row per source. With the sources in the order of
    ``cap * size / weight``, those whose share of what is left exceeds their cap come
    first, so one running sum finds them all.
    """
    whole = Window.partitionBy()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(place - 1, F.lit(len(weights))).cast("int") + 1)
    sources = sources.withColumns({"place": place, "weight": weight.cast("bigint")})
    sources = sources.withColumns(
        {"limit": F.col("source_size") * cap, "total": F.sum("source_size").over(whole), "weights": F.sum("weight").over(whole)}
    )
    before = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = [F.coalesce(F.sum(name).over(before), F.lit(0)) for name in ("limit", "weight")]
    share = (F.col("total") - earlier[0]) / (F.col("weights") - earlier[1]) * F.col("weight")
    sources = sources.withColumn("capped", share > F.col("limit"))
    held = [F.coalesce(F.sum(F.when(F.col("capped"), F.col(name))).over(whole), F.lit(0)) for name in ("limit", "weight")]
    sources = sources.withColumn("unit", (F.col("total") - held[0]) / (F.col("weights") - held[1]))
    target = F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(F.col("unit") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def unit_interval(key: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on ``key`` and ``seed`` only."""
    text = F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(seed)))
    digits = F.conv(F.substring(F.sha2(text, 256), 1, HEX_DIGITS), 16, 10)
    return digits.cast("double") / F.lit(float(16**HEX_DIGITS))


def with_copies(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: int = 1) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` and ``row``, the columns of ``docs``.

    ``copies`` says how often the mix takes a row.
    """
    sized = docs.select("doc_id", "source", F.struct("*").alias("row"), word_count(F.col("text").cast("string")).alias("size"))
    targets = source_targets(sized.select("source", "size"), weights, cap).withColumnRenamed("source", "_source")
    # Written once: the size is measured on the table that is joined, not computed again.
    targets = broadcast_if_small(Workspace(docs.sparkSession, "mixing").write(targets, "targets"))
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    whole = F.floor("rate")
    extra = (unit_interval(F.col("doc_id"), seed) < F.col("rate") - whole).cast("bigint")
    return joined.withColumn("copies", whole + extra).drop("_source", "rate")


def mixed(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: int = 1) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    taken = with_copies(docs, weights, cap, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
