"""App-log operators: parse, repair the new-visitor flag, split into topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import jsonops as J
from tidewater.schemas import DEAD_LETTER_TOPIC, DISPLAY_TOPIC, PAGE_TOPIC, START_TOPIC
from tidewater.session import broadcasts_enabled, measured, shared_dir

NEW_VISITOR = "1"
KNOWN_VISITOR = "0"


def parse_logs(df: DataFrame, strict: bool = False) -> DataFrame:
    """Parse ``value`` once and add ``rec``, ``mid``, ``is_new`` and ``reason``.

    ``reason`` is NULL for good records; otherwise it says why the record is a
    dead letter. With ``strict`` such a record fails the job instead.
    """
    rec = F.col("rec")
    parsed = J.with_computed(df, rec=J.parse_text(F.col("value"), strict))
    mid = J.path_string(rec, "$.common.mid")
    why = (
        F.when(rec.isNull(), "bad_json").when(J.as_object(rec).isNull(), "not_object").otherwise("no_mid")
    )
    if strict:
        why = F.raise_error(F.concat(why, F.lit(": "), F.coalesce("value", F.lit(""))))
    return parsed.withColumns(
        {
            "mid": mid,
            "is_new": J.path_string(rec, "$.common.is_new"),
            "reason": F.when(mid.isNull(), why),
        }
    )


def good_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where("reason IS NULL")


def dirty_logs(parsed: DataFrame) -> DataFrame:
    """Dead letters of the parse step: the original text and the reason."""
    bad = parsed.where("reason IS NOT NULL").drop("rec", "mid", "is_new")
    return bad.withColumn("stage", F.lit("parse_logs"))


def is_flagged() -> Column:
    """Whether a row claims a new visitor."""
    return F.col("is_new").eqNullSafe(NEW_VISITOR) & F.col("mid").isNotNull()


def split_flagged(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that claim a new visitor, and all other rows."""
    return df.where(is_flagged()), df.where(~is_flagged())


def first_order(order_by: Sequence[str]) -> Column:
    """Smallest order key; one plain column keeps the aggregation hash-based."""
    if len(order_by) == 1:
        return F.struct(F.min(order_by[0]).alias(order_by[0]))
    return F.min(F.struct(*order_by))


def repair_is_new(df: DataFrame, order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """Keep ``is_new = '1'`` on the first such row of a device, set later ones to ``'0'``.

    ``order_by`` must identify a row within its device. Adds ``repaired``. The first order
    key per device is a partially aggregated minimum, written to the shared folder, so the
    input is scanned once for it and once for the result. When the minima are small they
    are broadcast and nothing is shuffled. Otherwise rows join on (device, order key), which
    spreads a device with a large share of the rows over all tasks, and a parsed ``rec`` is
    rebuilt after the exchange rather than sent through it.
    """
    spark = df.sparkSession
    flagged = is_flagged()
    firsts = df.where(flagged).groupBy(F.col("mid").alias("first_mid")).agg(first_order(order_by).alias("first"))
    firsts = firsts.select("first_mid", *[F.col(f"first.{c}").alias(f"first_{c}") for c in order_by])
    side, small = firsts, False
    if broadcasts_enabled(spark):  # otherwise there is nothing to measure
        path = shared_dir(spark, "first_visits")
        firsts.write.parquet(path)
        side, small = measured(spark.read.schema(firsts.schema).parquet(path))
    # A plain comparison: the null-safe one would become a key of the join.
    same_row = (F.col("is_new") == NEW_VISITOR) & (F.col("mid") == F.col("first_mid"))
    for name in order_by:
        same_row &= F.col(name).eqNullSafe(F.col(f"first_{name}"))
    rows = df if small else df.drop("rec")
    joined = rows.join(side, same_row, "left")
    repaired = with_repair(joined, flagged & F.col("first_mid").isNull()).drop(*firsts.columns)
    if "rec" in df.columns and not small:
        repaired = J.with_computed(repaired, rec=J.parse_text(F.col("value")))
    return repaired.select(*df.columns, "repaired")


def with_repair(df: DataFrame, is_later: Column) -> DataFrame:
    return df.withColumns(
        {
            "is_new": F.when(is_later, KNOWN_VISITOR).otherwise(F.col("is_new")),
            "repaired": is_later,
        }
    )


def union_repaired(original: DataFrame, checked: DataFrame, rest: DataFrame) -> DataFrame:
    """Bring checked rows and untouched rows back together in one column order."""
    if "rec" in original.columns:
        checked = J.with_computed(checked, rec=J.parse_text(F.col("value")))
    columns = [*original.columns, "repaired"]
    rest = rest.withColumn("repaired", F.lit(False))
    return checked.select(*columns).unionByName(rest.select(*columns))


def record_text(rec: Column, value: Column, is_new: Column, repaired: Column) -> Column:
    """The record as text: the original, or rewritten where the flag was repaired."""
    common = J.set_field(J.as_object(rec, "$.common"), "is_new", J.to_variant(is_new))
    rewritten = J.set_field(J.as_object(rec), "common", F.to_variant_object(common))
    return F.when(repaired, F.to_json(rewritten)).otherwise(value)


def display_text(display: Column, page_id: Column) -> Column:
    """A display object with its page's ``page_id``, which is left out when null."""
    others = F.map_filter(display, lambda key, _: key != "page_id")
    own = F.create_map(F.lit("page_id"), J.to_variant(page_id))
    return F.to_json(F.when(page_id.isNull(), others).otherwise(F.map_concat(others, own)))


def route_logs(df: DataFrame, keep: Sequence[str] = ("seq",)) -> DataFrame:
    """Split records into start, page and display topics in one pass.

    Output: ``topic, value, reason, branch`` and the ``keep`` columns; ``branch``
    numbers the outputs of one record. Branches are not exclusive, and a record
    with neither branch yields nothing. Records that could not be parsed, and
    branches of the wrong JSON type, go to the dead-letter topic with a reason.
    """
    rec = F.col("rec")
    good = F.col("reason").isNull()
    start, page = J.as_object(rec, "$.start"), J.as_object(rec, "$.page")
    elements = J.as_array(rec, "$.displays")
    parts = df.withColumns(
        {
            "has_start": good & J.nonempty(start),
            "has_page": good & J.nonempty(page),
            "bad_start": good & start.isNull() & J.has_path(rec, "$.start"),
            "bad_page": good & page.isNull() & J.has_path(rec, "$.page"),
            "displays": F.transform(elements, lambda element: J.as_object(element)),
        }
    )
    has_page, displays = F.col("has_page"), F.col("displays")
    bad_displays = has_page & F.when(displays.isNull(), J.has_path(rec, "$.displays")).otherwise(
        F.exists(displays, lambda display: display.isNull())
    )
    whole = record_text(rec, F.col("value"), F.col("is_new"), F.col("repaired"))
    page_id = J.path_string(rec, "$.page.page_id")
    shown = F.filter(displays, lambda display: display.isNotNull())
    outputs = F.concat(
        _outputs(~good, _dead(F.col("reason"))),
        _outputs(F.col("has_start"), _output(START_TOPIC, whole)),
        _outputs(has_page, _output(PAGE_TOPIC, whole)),
        F.when(
            has_page & J.nonempty(shown),
            F.transform(shown, lambda display: _output(DISPLAY_TOPIC, display_text(display, page_id))),
        ).otherwise(_no_outputs()),
        _outputs(F.col("bad_start"), _dead(F.lit("bad_start"))),
        _outputs(F.col("bad_page"), _dead(F.lit("bad_page"))),
        _outputs(bad_displays, _dead(F.lit("bad_displays"))),
    )
    routed = parts.select(*keep, F.posexplode(outputs).alias("branch", "out"))
    return routed.select("out.topic", "out.value", "out.reason", "branch", *keep)


def _output(topic: str, value: Column, reason: Column | None = None) -> Column:
    why = F.lit(None).cast("string") if reason is None else reason
    return F.struct(F.lit(topic).alias("topic"), value.alias("value"), why.alias("reason"))


def _dead(reason: Column) -> Column:
    return _output(DEAD_LETTER_TOPIC, F.col("value"), reason)


def _outputs(condition: Column, output: Column) -> Column:
    return F.when(condition, F.array(output)).otherwise(_no_outputs())


def _no_outputs() -> Column:
    return F.array().cast("array<struct<topic:string,value:string,reason:string>>")
