"""Change feeds: business tables after a point in time, and the rule table with its snapshot.

A snapshot is either taken before the first change (:func:`rule_feed`), or in chunks while
changes go on (:func:`snapshot_with_changes`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import jsonops as J
from tidewater.operators.changes import dirty_changes, normalize_changes, parse_change_records
from tidewater.operators.ordered import with_order
from tidewater.schemas import OPEN_OBJECT
from tidewater.session import broadcast_if_small, computed_once

# A snapshot comes before every change.
SNAPSHOT_SEQ = -1


def change_feed(messages: DataFrame, decode: bool = False, **options: bool) -> DataFrame:
    """Landed change messages (``topic, value``) as envelopes with ``reason``.

    A message without a value is the tombstone that follows a delete, and is skipped. With
    ``decode`` values that a record's schema block says are encoded are decoded.
    """
    return normalize_changes(parse_change_records(messages, decode).where("value IS NOT NULL"), **options)


def row_image(*columns: str) -> Column:
    """Columns of a table row as one open object."""
    pairs = [part for name in columns for part in (F.lit(name), F.col(name).cast("variant"))]
    return F.create_map(*pairs)


def snapshot_changes(table: DataFrame, database: str, name: str, seq: int = SNAPSHOT_SEQ) -> DataFrame:
    """The rows of a table as envelopes of type ``read``; null columns are left out."""
    image = J.drop_null_entries(row_image(*table.columns))
    return table.select(*_snapshot_envelope(database, name, image), F.lit(seq).cast("bigint").alias("seq"))


def rule_feed(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Rule rows that already exist, followed by every good change of the rule database."""
    existing = snapshot_changes(snapshot, "rules", "rules")
    good = changes.where("reason IS NULL").select(*existing.columns)
    return existing.unionByName(good)


def rule_feed_letters(changes: DataFrame) -> DataFrame:
    """Dead letters of the rule feed: change records that could not be read, with the reason."""
    return dirty_changes(changes, "rule_feed")


def snapshot_with_changes(
    chunks: DataFrame, marks: DataFrame, changes: DataFrame, keys: Sequence[str], database: str, name: str
) -> DataFrame:
    """A table read in chunks while it changes, and its changes, as one feed without gap or double.

    ``chunks`` holds the rows that were read, with their ``chunk``; ``marks`` has for every
    chunk the ``seq`` of the feed just before it was read (``low``) and just after it
    (``high``), which are positions of their own. Chunks may be read side by side; without
    any, the feed is the changes. ``changes`` are good envelopes of the table with ``seq`` that reach back to the first mark.

    A row that was read may already hold changes between its marks, so when its key has one
    there, the row is left out and the change speaks for it. Every other row stands for its
    key at its low mark, after all changes before. Changes up to the first mark are part of
    the rows and are left out. Rows of one chunk are numbered by their key in ``row``, from
    1, and changes have 0, so (``seq``, ``row``) orders the feed.
    """
    marks = broadcast_if_small(computed_once(marks.select("chunk", "low", "high"), "marks"))
    first = marks.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    low, high = (first.low, first.high) if first.low is not None else (-(1 << 63), -(1 << 63))
    columns = [column for column in chunks.columns if column != "chunk"]
    read = chunks.join(marks, "chunk").withColumn("key", F.struct(*[F.col(key).cast("string").alias(key) for key in keys]))
    since = changes.where(F.col("seq") > F.lit(low))

    beaten = changed_meanwhile(read.select("chunk", "key", "low", "high"), since.where(F.col("seq") <= F.lit(high)), keys)
    kept = read.join(beaten, ["chunk", "key"], "left_anti")
    image = J.drop_null_entries(row_image(*columns))
    kept = kept.select("chunk", "key", F.col("low").alias("seq"), F.to_json(image).alias("image"))
    kept = with_order(kept, ["chunk"], "key").withColumn("after", F.from_json("image", OPEN_OBJECT))
    rows = kept.select(*_snapshot_envelope(database, name, F.col("after")), "seq", (F.col("position") + 1).alias("row"))
    return rows.unionByName(since.select(*[column for column in rows.columns if column != "row"], F.lit(0).alias("row")))


def changed_meanwhile(spans: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ``chunk, key`` of rows that have a change after their ``low`` mark and up to ``high``.

    The estimate for columns taken out of open objects is far below their size, so by itself
    Spark would gather all changes on the driver; the join is a shuffle join, whatever it expects.
    """

    def of_change(key: str) -> Column:
        """The key of a change; a deletion has it in ``before`` only."""
        images = [J.path_string(F.try_element_at(image, F.lit(key))) for image in ("after", "before")]
        return F.coalesce(*images).alias(key)

    during = changes.select(F.struct(*map(of_change, keys)).alias("changed"), F.col("seq").alias("at"))
    between = (F.col("key") == F.col("changed")) & (F.col("at") > F.col("low")) & (F.col("at") <= F.col("high"))
    return spans.join(during.hint("merge"), between).select("chunk", "key").distinct()


def _snapshot_envelope(database: str, name: str, after: Column) -> list[Column]:
    return [
        F.lit(database).alias("database"),
        F.lit(name).alias("tableName"),
        J.empty_object().alias("before"),
        after.alias("after"),
        F.lit("read").alias("type"),
        F.lit(None).cast("string").alias("reason"),
    ]
