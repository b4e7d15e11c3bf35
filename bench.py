"""Time the headline queries and print one JSON line.

Inputs (log texts, change texts, dimension rows) are derived from the tables first and
written to the shared folder, untimed, so that the times are those of the operators.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators import changes as C
from tidewater.operators import dims as D
from tidewater.operators import logs as L
from tidewater.operators import rules as U
from tidewater.plans.changes import change_outputs, routed_changes
from tidewater.plans.logs import log_outputs
from tidewater.session import shared_dir
from tidewater.sinks.dim_store import DimStore
from tidewater.sources.feeds import change_feed
from tidewater.sources.topics import FileTopics
from tidewater.streaming import jobs
from verification import recipes as R
from verification.registry import CUSTOMER_COLUMNS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FILES = 10
FILES_PER_BATCH = 5
# A single run is too noisy to tell a change from chance.
RUNS = 3


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def stage(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Write ``df`` as ``FILES`` files; gives the table and its number of rows."""
    df.repartition(FILES).write.parquet(path)
    staged = df.sparkSession.read.parquet(path)
    return staged, staged.count()


def stream(df: DataFrame, path: str, files: int = FILES_PER_BATCH) -> DataFrame:
    """The staged table as a stream with some files per micro-batch."""
    reader = df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = shared_dir(spark, "bench")

    logs, n_logs = stage(R.log_text(spark, SF_DIR), f"{root}/logs")
    raw, n_raw = stage(R.shop_changes(spark, SF_DIR), f"{root}/raw")
    texts = C.envelope_text(change_feed(raw)).select("seq", "value", "tableName")
    texts, n_texts = stage(texts, f"{root}/texts")
    dims, n_dims = stage(R.customer_dim_rows(spark, SF_DIR), f"{root}/dims")
    rules, n_rules = stage(R.part_rule_changes(spark, SF_DIR), f"{root}/rules")
    envelopes = texts.select("seq", "value")

    def rule_set() -> DataFrame:
        return U.validate_rules(U.bind_rules(rules))

    def log_stream(tag: str) -> None:
        jobs.start_log_job(
            stream(logs, f"{root}/logs"), FileTopics(f"{root}/{tag}-out"), f"{root}/{tag}-ck", ("seq",)
        ).awaitTermination()

    def change_stream(tag: str) -> None:
        messages = stream(texts, f"{root}/texts")
        sink, store = FileTopics(f"{root}/{tag}-out"), DimStore(f"{root}/{tag}-dims")
        jobs.start_change_job(
            messages.withColumnRenamed("tableName", "source"), R.rule_changes, sink, store, f"{root}/{tag}-ck",
            order_by=("source", "seq"),
        ).awaitTermination()

    def dim_stream(tag: str) -> None:
        store = DimStore(f"{root}/{tag}-dims")
        jobs.start_dim_job(stream(dims, f"{root}/dims", 1), store, f"{root}/{tag}-ck").awaitTermination()
        run(store.table(spark, "dim_customer", CUSTOMER_COLUMNS))

    cases = {
        "log_parse": (n_logs, lambda: run(L.parse_logs(logs))),
        "log_repair": (n_logs, lambda: run(L.repair_is_new(L.good_logs(L.parse_logs(logs))).drop("rec"))),
        "log_outputs": (n_logs, lambda: run(log_outputs(logs))),
        "change_normalize": (n_raw, lambda: run(C.envelope_text(change_feed(raw)))),
        "change_route": (n_texts, lambda: run(change_outputs(routed_changes(envelopes, R.rule_changes(spark))))),
        "change_route_asof": (
            n_texts,
            lambda: run(routed_changes(envelopes, R.rule_changes(spark, R.RULE_HISTORY), asof=True)),
        ),
        "rules_current": (n_rules, lambda: run(U.current_rules(rule_set()))),
        "dim_definitions": (n_rules, lambda: run(D.dim_definitions(rule_set()))),
        "dim_merge": (n_dims, lambda: run(D.merge_dim(dims, CUSTOMER_COLUMNS))),
    }
    streams = {
        "log_job_stream": (n_logs, log_stream),
        "change_job_stream": (n_texts, change_stream),
        "dim_job_stream": (n_dims, dim_stream),
    }

    seconds, rows = {}, {}
    def timed(case) -> float:
        started = time.perf_counter()
        case()
        return time.perf_counter() - started

    for name, (count, case) in cases.items():
        case()  # warm-up
        seconds[name], rows[name] = median(timed(case) for _ in range(RUNS)), count
    for name, (count, job) in streams.items():
        job(f"{name}-warm-up")
        seconds[name] = median(timed(lambda: job(f"{name}-{i}")) for i in range(RUNS))  # noqa: B023
        rows[name] = count

    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "rows_per_sec": {name: int(rows[name] / value) for name, value in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
