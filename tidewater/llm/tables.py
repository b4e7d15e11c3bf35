"""Written intermediate tables, row identity and streaming over sorted groups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_dir


class Workspace:
    """Tables of one run, written below ``spark.checkpoint.dir`` and read back.

    A written table cuts the lineage and outlives any executor.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.root = spark, shared_dir(spark, purpose)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete the folder of a written table that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def row_key(*columns: str) -> Column:
    """Together with ``doc_id`` this names a row by its content; equal rows share it."""
    return F.xxhash64(*(columns or ("doc_id", "text")))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut batches that are sorted by ``keys`` so that no group spans two tables."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.num_rows - 1
        cut = last
        names = [batch.column(key) for key in keys]
        final = [column[last] for column in names]
        low, high = 0, last  # the first row of the last group, by bisection
        while low < high:
            middle = (low + high) // 2
            if all(column[middle].equals(value) for column, value in zip(names, final, strict=True)):
                high = middle
            else:
                low = middle + 1
        cut = low
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        elif rest and not all(
            rest[-1].column(key)[-1].equals(value) for key, value in zip(keys, final, strict=True)
        ):
            yield pa.Table.from_batches(rest)
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def with_block_pairs(members: DataFrame, size: str, block: int, salt: Column) -> DataFrame:
    """Deal each group out to pairs of blocks ``(block_a, block_b)`` of about ``block`` rows.

    A group of up to ``block`` rows is the one pair (0, 0). In a larger one every row meets
    every other row in exactly one pair of two blocks, or in the pair of its own block.
    """
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    dealt = members.withColumn("_blocks", blocks).withColumn("_own", F.pmod(salt, F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return dealt.withColumns(
        {"block_a": F.least("_own", "_other"), "block_b": F.greatest("_own", "_other")}
    ).drop("_blocks", "_other")


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], size: str, salt: Column, share: int = 256, salts: int = 64) -> DataFrame:
    """Inner join with one row per key on the right, where ``size`` counts the rows of the key on the left.

    A key with more than one in ``share`` of all rows is dealt to ``salts`` tasks by ``salt``, a
    column over ``left`` that a task gets alike when it runs again. There are fewer such keys
    than ``share``, so they are broadcast. ``right`` should be a written table; ``size`` is dropped.
    """
    total = right.agg(F.sum(size).alias("rows")).first()["rows"] or 0
    is_hot = F.col(size) * share > F.lit(total)
    hot = F.broadcast(right.where(is_hot).select(*[F.col(key).alias(f"_hot_{key}") for key in keys]))
    match = F.lit(True)
    for key in keys:
        match &= F.col(key) == F.col(f"_hot_{key}")
    lane = F.when(F.col(f"_hot_{keys[0]}").isNotNull(), F.pmod(salt, F.lit(salts))).otherwise(F.lit(0)).cast("int")
    left = left.join(hot, match, "left").withColumn("_salt", lane).drop(*hot.columns)
    lanes = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(lanes)).drop(size)
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def slices_of_groups(table: pa.Table, keys: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """``(start, end, block_a, block_b)`` of every group of a table sorted by ``keys``."""
    columns = [table[key].to_numpy() for key in keys]
    changed = np.zeros(max(0, table.num_rows - 1), dtype=bool)
    for column in columns:
        changed |= column[1:] != column[:-1]
    starts = np.concatenate(([0], np.flatnonzero(changed) + 1)) if table.num_rows else np.zeros(0, int)
    ends = np.append(starts[1:], table.num_rows)
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        yield start, end, int(columns[-2][start]), int(columns[-1][start])
