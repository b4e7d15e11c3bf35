"""Session helpers: shared working folders, scoped settings and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, where every executor can reach it.

    Only a local master without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tidewater-")
    return f"{base.rstrip('/')}/tidewater/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once below the shared folder and read back, so that nothing computes it again."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` itself when it is persisted, otherwise a stored copy."""
    level = df.storageLevel
    return df if level.useMemory or level.useDisk else stored(df, purpose)


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply settings for the block and put the former values back afterwards."""
    former = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in former.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_if_exists(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet at ``path``, or no rows while nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def broadcasts_enabled(spark: SparkSession) -> bool:
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


def measured(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> tuple[DataFrame, bool]:
    """``df``, with a broadcast hint when its measured size is within the limit, and whether it is.

    Measuring runs one small aggregation over ``df``.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    size = df.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0
    small = size <= limit_bytes
    return F.broadcast(df) if small else df, small


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its measured size is within the limit.

    Larger inputs come back without the hint, so the join runs as a shuffle join
    with adaptive skew handling.
    """
    return measured(df, limit_bytes)[0]
