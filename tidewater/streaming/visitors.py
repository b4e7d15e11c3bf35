"""New-visitor repair as a stream, with one keyed state entry per device."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewater.operators.logs import KNOWN_VISITOR, NEW_VISITOR, is_flagged, split_flagged, union_repaired
from tidewater.session import session_conf

# Keyed state needs RocksDB; with a changelog a commit uploads what changed, not the whole state.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
LANES_PER_PARTITION = 4


def repair_is_new_stream(
    df: DataFrame,
    order_by: Sequence[str] = ("seq",),
    ttl_ms: int | None = None,
    state_partitions: int | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Streaming form of ``repair_is_new``; the first row of a device may be in an earlier batch.

    Within a micro-batch "first" follows ``order_by``; later batches never change
    earlier output. State lasts for good unless ``ttl_ms`` is set, after which a
    returning device counts as new again. ``known`` has the devices (``mid``) that were seen
    before the stream begins, say by a batch run over older logs; the first run of a
    checkpoint puts them into the state.

    Only rows that claim a new visitor reach the stateful operator. Of those, rows that
    come after another one of the same device in the same Arrow batch are settled before
    the shuffle and spread over lanes that need no state, so a device that sends a large
    share of a micro-batch does not end up in one task.
    """
    flagged, rest = split_flagged(df)
    # What the flag was is known, and what it becomes follows from ``repaired``.
    flagged = flagged.drop("rec", "is_new")
    later = later_in_batch()(F.struct("mid", *order_by))
    partitions = state_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*order_by), F.lit(LANES_PER_PARTITION * partitions)).cast("int")
    marked = flagged.withColumn("settled", later)
    keyed = marked.withColumns(
        {
            "device": F.when(F.col("settled"), F.lit("")).otherwise(F.col("mid")),
            "lane": F.when(F.col("settled"), spread).otherwise(F.lit(-1)),
        }
    )
    output = T.StructType([*flagged.schema.fields, T.StructField("repaired", T.BooleanType())])
    before = None
    if known is not None:
        devices = known.where("mid IS NOT NULL").select(F.col("mid").alias("device"), F.lit(-1).alias("lane"))
        before = devices.distinct().groupBy("device", "lane")
    checked = keyed.groupBy("device", "lane").transformWithState(
        statefulProcessor=first_visit(flagged.columns, order_by, ttl_ms),
        outputStructType=output,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
        initialState=before,
    )
    flag = F.when(F.col("repaired"), KNOWN_VISITOR).otherwise(NEW_VISITOR)
    return union_repaired(df, checked.withColumn("is_new", flag), rest)


def later_in_batch():
    """Per Arrow batch: whether a row comes after another row of the same device.

    The answer may differ between runs, as batches do, but a row is only ever marked
    when an earlier one exists, so the repaired flags do not depend on it.
    """

    def mark(rows: pd.DataFrame) -> pd.Series:
        order = [name for name in rows.columns if name != "mid"]
        first = rows.sort_values(order, kind="stable", na_position="first").drop_duplicates("mid")
        return pd.Series(~rows.index.isin(first.index))

    mark.__annotations__ = {"rows": pd.DataFrame, "return": pd.Series}
    return F.pandas_udf(mark, "boolean").asNondeterministic()


def known_devices(parsed: DataFrame) -> DataFrame:
    """Devices that a batch of parsed logs has seen as new visitors: ``mid``."""
    return parsed.where(is_flagged()).select("mid").distinct()


def first_visit(columns: Sequence[str], order_by: Sequence[str], ttl_ms: int | None) -> StatefulProcessor:
    """Processor that adds ``repaired`` to each row: false for the first row of a device, true for others.

    ``columns`` are the first ones of a row. Rows are built by place, as looking values up by
    name costs more than all else. Defined in a function so that it travels to the workers by value.
    """
    order = [list(columns).index(name) for name in order_by]
    made, width, new = Row(*columns, "repaired"), len(columns), NEW_VISITOR

    class FirstVisit(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            schema = T.StructType([T.StructField("is_new", T.StringType())])
            self.seen = handle.getValueState("seen", schema, ttl_ms)

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self.seen.update((new,))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            if key[1] >= 0 or self.seen.exists():
                for row in rows:
                    yield made(*row[:width], True)
                return
            first = None
            for row in rows:
                if first is None:
                    first = row
                elif self.position(row) < self.position(first):
                    first, row = row, first
                    yield made(*row[:width], True)
                else:
                    yield made(*row[:width], True)
            self.seen.update((new,))
            yield made(*first[:width], False)

        @staticmethod
        def position(row: Row) -> tuple:
            return tuple((row[place] is not None, row[place]) for place in order)

        def close(self) -> None:
            pass

    return FirstVisit()


def state_settings(spark: SparkSession, state_partitions: int | None = None):
    """Scope in which queries of this package must be started.

    The number of state partitions is fixed by the first run of a checkpoint.
    """
    settings = dict(STATE_STORE)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    return session_conf(spark, settings)
