"""Catalog tables for dimensions: created when a rule asks for them, filled batch by batch.

What a rule names is a view with exactly its columns. Behind it stands a Parquet table of
the same name with ``__rows`` added, partitioned by a bucket of the row key; it also holds the
key and, per column, the ``seq`` of the change that set it. A batch rewrites the buckets it
touches into a new folder and then points the partitions there, one metadata change each. So
a reader sees a bucket before or after a batch, a run that dies leaves every bucket whole,
and a batch that is run again changes nothing. A table takes one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.dims import merge_cells
from tidewater.schemas import HIDDEN_COLUMNS, ROWS_SUFFIX

# Table options a rule may set; anything else in its free text is ignored.
ALLOWED_OPTIONS = ("comment", "compression")

# The table behind a dimension, and its columns that are not the rule's.
ROWS = ROWS_SUFFIX
KEY, SEQS, BUCKET = HIDDEN_COLUMNS

DEFAULT_BUCKETS = 16
DAY_MS = 24 * 3600 * 1000


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def allowed_options(text: str) -> dict[str, str]:
    """The allowed ``name=value`` pairs of a rule's comma-separated table options."""
    pairs = (part.partition("=") for part in text.split(","))
    options = {name.strip().lower(): value.strip() for name, sep, value in pairs if sep}
    return {name: options[name] for name in ALLOWED_OPTIONS if name in options}


def table_properties(pk: str, extend: str, **more: str) -> str:
    """The clauses for comment and properties of a dimension."""
    options = allowed_options(extend)
    properties = {"pk": pk, **more}
    if "compression" in options:
        properties["parquet.compression"] = options["compression"]
    comment = f" COMMENT {text_literal(options['comment'])}" if "comment" in options else ""
    pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
    return f"{comment} TBLPROPERTIES ({pairs})"


def create_statement(database: str, table: str, pk: str, columns: Sequence[str], extend: str, buckets: int) -> str:
    """The table that holds the rows of a dimension."""
    fields = ", ".join(f"{quoted(name)} STRING" for name in columns)
    hidden = f"{quoted(KEY)} STRING, {quoted(SEQS)} MAP<STRING, BIGINT>, {quoted(BUCKET)} INT"
    return (
        f"CREATE TABLE IF NOT EXISTS {quoted(database, table + ROWS)} ({fields}, {hidden}) USING parquet "
        f"PARTITIONED BY ({quoted(BUCKET)}){table_properties(pk, extend, buckets=str(buckets))}"
    )


def view_statement(database: str, table: str, pk: str, columns: Sequence[str], extend: str) -> str:
    """The dimension as its readers see it."""
    fields = ", ".join(map(quoted, columns))
    return (
        f"CREATE OR REPLACE VIEW {quoted(database, table)}{table_properties(pk, extend)} "
        f"AS SELECT {fields} FROM {quoted(database, table + ROWS)}"
    )


def create_dim_tables(
    spark: SparkSession,
    definitions: DataFrame,
    database: str,
    known: set | None = None,
    failures: list | None = None,
    buckets: int = DEFAULT_BUCKETS,
) -> list[str]:
    """Create missing tables and add missing columns; returns the tables looked at.

    A table that the catalog refuses does not stop the others: with ``failures`` its name
    and the error are added to that list, without it the error is raised at the end.

    Definitions are one short row per table and are fetched partition by partition.
    Those in ``known`` are passed over, and new ones are added to it, so that a job
    which calls this for every micro-batch asks the catalog about new rules only. A new table
    gets ``buckets`` buckets for good; choose them so that one is rewritten in short time.
    """
    known = set() if known is None else known
    refused = [] if failures is None else failures
    names = []
    for row in definitions.toLocalIterator():
        definition = (database, row.sink_table, tuple(row.columns))
        if definition in known:
            continue
        known.add(definition)
        try:
            _create_dim_table(spark, database, row, buckets)
        except AnalysisException as error:
            refused.append((row.sink_table, error.getCondition() or "unknown"))
            continue
        names.append(row.sink_table)
    if failures is None and refused:
        raise ValueError(f"tables the catalog refuses: {refused}")
    return names


def _create_dim_table(spark: SparkSession, database: str, row: Row, buckets: int) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    rows = quoted(database, row.sink_table + ROWS)
    spark.sql(create_statement(database, row.sink_table, row.sink_pk, row.columns, row.sink_extend, buckets))
    present = {name.lower() for name in spark.table(rows).columns}
    missing = [name for name in row.columns if name.lower() not in present]
    if missing:
        fields = ", ".join(f"{quoted(name)} STRING" for name in missing)
        spark.sql(f"ALTER TABLE {rows} ADD COLUMNS ({fields})")
    columns = [name for name in spark.table(rows).columns if name not in HIDDEN_COLUMNS]
    spark.sql(view_statement(database, row.sink_table, row.sink_pk, columns, row.sink_extend))


def bucket_counts(spark: SparkSession, database: str, tables: Sequence[str]) -> dict[str, int]:
    """Buckets of those dimensions that the catalog has."""
    counts = {}
    for table in tables:
        rows = quoted(database, table + ROWS)
        if spark.catalog.tableExists(rows):
            counts[table] = int(spark.sql(f"SHOW TBLPROPERTIES {rows} ('buckets')").first()["value"])
    return counts


def fill_dim_tables(
    spark: SparkSession, database: str, cells: DataFrame, keep_ms: int = DAY_MS
) -> dict[str, list[int]]:
    """Merge cells (``sink_table, pk, column, value, seq``) into their tables.

    Returns the buckets that were rewritten per table. Dimensions without a table, and
    columns that their table does not have, are passed over. ``cells`` is read once per
    table, so it should be a written or persisted table. Folders that no bucket uses any
    more are deleted when they are older than ``keep_ms``, time for their readers to end.
    """
    names = [row.sink_table for row in cells.select("sink_table").distinct().toLocalIterator()]
    counts = bucket_counts(spark, database, names)
    if not counts:
        return {}
    sizes = F.create_map(*[F.lit(part) for pair in counts.items() for part in pair])
    placed = cells.where(F.col("sink_table").isin(*counts) & F.col("pk").isNotNull())
    placed = placed.select("sink_table", bucket_of(sizes[F.col("sink_table")]).alias(BUCKET)).distinct()
    # At most one short row per table and bucket.
    touched: dict[str, list[int]] = {}
    for row in placed.collect():
        touched.setdefault(row.sink_table, []).append(row[BUCKET])
    for table, buckets in touched.items():
        mine = cells.where((F.col("sink_table") == table) & F.col("pk").isNotNull())
        _rewrite_buckets(spark, database, table, mine, sorted(buckets), counts[table])
        remove_old_buckets(spark, database, table, keep_ms)
    return touched


def bucket_of(count: Column) -> Column:
    return F.pmod(F.xxhash64("pk"), count).cast("int")


def merged_rows(old: DataFrame, cells: DataFrame, columns: Sequence[str], count: int) -> DataFrame:
    """Rows of some buckets after the cells: per column the value with the greatest ``seq``."""
    latest = F.map_from_entries(F.collect_list(F.struct("column", F.struct("value", "seq"))))
    # One cell per column is left, so a row gathers no more than its columns.
    new = merge_cells(cells).groupBy("pk").agg(latest.alias("cells")).withColumn("bucket", bucket_of(F.lit(count)))
    joined = old.join(new, (F.col(BUCKET) == F.col("bucket")) & (F.col(KEY) == F.col("pk")), "full_outer")

    def value(name: str) -> Column:
        cell, before = F.col("cells")[name], F.col(SEQS)[name]
        newer = cell.isNotNull() & (before.isNull() | (cell["seq"] >= before))
        return F.when(newer, cell["value"]).otherwise(F.col(quoted(name))).alias(name)

    empty = F.create_map().cast("map<string,bigint>")
    seqs = F.transform_values(F.col("cells"), lambda _, cell: cell["seq"])
    seqs = F.map_zip_with(F.coalesce(SEQS, empty), F.coalesce(seqs, empty), lambda _, a, b: F.greatest(a, b))
    return joined.select(
        *[value(name) for name in columns],
        F.coalesce(KEY, "pk").alias(KEY), seqs.alias(SEQS), F.coalesce(BUCKET, "bucket").alias(BUCKET),
    )


def _rewrite_buckets(
    spark: SparkSession, database: str, table: str, cells: DataFrame, buckets: list[int], count: int
) -> None:
    target = quoted(database, table + ROWS)
    rows = spark.table(target)
    columns = [name for name in rows.columns if name not in HIDDEN_COLUMNS]
    merged = merged_rows(rows.where(F.col(BUCKET).isin(*buckets)), cells, columns, count)
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        merged = merged.hint("rebalance", BUCKET)
    folder = f"{_location(spark, database, table)}/{uuid.uuid4().hex}"
    merged.write.partitionBy(BUCKET).parquet(folder)
    places = {bucket: text_literal(f"{folder}/{BUCKET}={bucket}") for bucket in buckets}
    known = {int(row.partition.split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {target}").collect()}
    for bucket in known & set(places):
        spark.sql(f"ALTER TABLE {target} PARTITION ({quoted(BUCKET)} = {bucket}) SET LOCATION {places.pop(bucket)}")
    if places:
        added = " ".join(f"PARTITION ({quoted(BUCKET)} = {bucket}) LOCATION {place}" for bucket, place in places.items())
        spark.sql(f"ALTER TABLE {target} ADD {added}")


def _location(spark: SparkSession, database: str, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {quoted(database, table + ROWS)}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def remove_old_buckets(spark: SparkSession, database: str, table: str, keep_ms: int = DAY_MS) -> None:
    """Delete folders of former bucket contents that are older than ``keep_ms``."""
    hadoop, uri = spark._jvm.org.apache.hadoop.fs, spark._jvm.java.net.URI
    root = hadoop.Path(_location(spark, database, table))
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files = spark.table(quoted(database, table + ROWS)).inputFiles()
    used = {hadoop.Path(uri(name)).getParent().toUri().getPath() for name in files}
    oldest = time.time() * 1000 - keep_ms
    for version in fs.listStatus(root):
        buckets = [s for s in fs.listStatus(version.getPath()) if s.isDirectory()] if version.isDirectory() else []
        unused = [s for s in buckets if s.getPath().toUri().getPath() not in used and s.getModificationTime() < oldest]
        for status in unused:
            fs.delete(version.getPath() if len(unused) == len(buckets) else status.getPath(), True)
