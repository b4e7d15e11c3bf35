"""Log texts, change records and rules that Spark derives from the given tables."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import jsonops as J
from tidewater.schemas import RAW_LOG_TOPIC
from tidewater.sinks.dim_store import DimStore
from tidewater.sources.feeds import row_image
from tidewater.sources.topics import FileTopics

# (seq, rule) in the order in which the rules were written.
ROUTING_RULES = (
    (1, "orders", "insert", "kafka", "dwd_orders", "o_orderkey,o_custkey,o_totalprice", None),
    (2, "orders", "update", "topic", "dwd_orders_upd", "o_orderkey,o_orderstatus", None),
    (3, "customer", "insert", "hbase", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey"),
    (4, "customer", "update", "dim", "dim_customer", "c_custkey,c_name,c_acctbal", "c_custkey"),
    (5, "nation", "insert", "clickhouse", "x", "n_nationkey", None),
)

# Rules that change while orders arrive: a first rule, its successor, and one more key.
RULE_HISTORY = (
    (100, "orders", "insert", "topic", "dwd_orders", "o_orderkey,o_custkey", None),
    (700, "orders", "insert", "topic", "dwd_orders_v2", "o_orderkey,o_totalprice", None),
    (400, "orders", "update", "topic", "dwd_orders_upd", "o_orderkey,o_orderstatus", None),
    (1200, "orders", "read", "clickhouse", "x", "o_orderkey", None),
)
HISTORY_FIELDS = ("seq", "source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk")


# Rows of a table that make a task of their own while cores are free, and that are enough for any task.
FEW_ROWS, MANY_ROWS = 20_000, 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, dealt out by its key.

    The files are packed so tightly that a few tasks read them, and what is derived from a row
    costs far more than the row; so the number of tasks comes from the rows and not from the bytes.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    count = rows.count()
    tasks = max(min(-(-count // FEW_ROWS), 2 * spark.sparkContext.defaultParallelism), -(-count // MANY_ROWS))
    return rows.repartition(tasks, rows.columns[0]) if tasks > 1 else rows


def log_text(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """App-log messages ``seq, value`` from ``events``; errors become broken texts."""
    kind = F.col("event_type")
    new = F.when(F.col("event_id") % 2 == 0, "1").otherwise("0")
    entry = F.struct(kind.alias("entry"))
    page = F.struct(kind.alias("page_id"))
    count = (F.col("event_id") % 3 + 1).cast("int")
    items = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(i.alias("item")))
    record = F.to_json(
        F.struct(
            F.struct(F.col("user_id").cast("string").alias("mid"), new.alias("is_new")).alias("common"),
            F.when(kind.isin("signup", "click"), entry).alias("start"),
            F.when(kind.isin("view", "click", "purchase"), page).alias("page"),
            F.when(kind == "view", items)
            .when(kind == "purchase", F.filter(items, lambda _: F.lit(False)))
            .alias("displays"),
            F.parse_json("props").alias("props"),
        )
    )
    broken = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"))
    value = F.when(kind == "error", broken).otherwise(record)
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_id").alias("seq"), value.alias("value"), *extra)


# How far the logs have come, as shares of all lines, and whether the open files have been rolled.
GROWTH = ((0.3, False), (0.6, False), (1.0, True))
ROLLED_SHARE = 0.8


def write_growing_logs(spark: SparkSession, sf_dir: str, root: str, step: tuple[float, bool]) -> None:
    """Log texts as the open logs of three collectors, written up to a share of all lines.

    What was there before stays as it is, so a task that runs again writes the same files. A
    rolled log has the first lines under the name of a day, and the open one goes on anew.
    """
    share, rolled = step
    last = table(spark, sf_dir, "events").agg(F.max("event_id").alias("last")).first().last
    rows = log_text(spark, sf_dir).where(F.col("seq") <= share * last)
    rows = rows.withColumn("folder", (F.col("seq") % 3).cast("string"))
    rows = rows.withColumn("old", F.lit(rolled) & (F.col("seq") <= ROLLED_SHARE * last))
    folder_of = root.removeprefix("file://").removeprefix("file:")

    def write(batches):
        paths = {}
        for batch in batches:
            for (folder, old), lines in batch.groupby(["folder", "old"], sort=False):
                name = "app.2024-06-01.log" if old else "app.log"
                path = f"{folder_of}/{folder}/{name}"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "ab" if path in paths else "wb") as file:
                    file.write("".join(line + "\n" for line in lines["value"]).encode())
                paths[path] = True
        yield from ()

    ordered = rows.repartition("folder").sortWithinPartitions("folder", F.col("old").desc(), "seq")
    ordered.mapInPandas(write, "seq bigint").count()


def raw_changes(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """Landed change records ``topic, value, seq`` for a table; the key picks the operation."""
    rows = table(spark, sf_dir, name)
    for column, kind in rows.dtypes:
        if kind.startswith("timestamp"):
            rows = rows.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))
    image = row_image(*rows.columns)
    slot = F.col(key) % 4
    op = F.when(slot == 0, "CREATE").when(slot == 1, "u").when(slot == 2, "delete").otherwise("r")
    record = F.struct(
        op.alias("op"),
        F.when(slot.isin(1, 2), image).alias("before"),
        F.when(slot != 2, image).alias("after"),
    )
    return rows.select(
        F.lit(f"srv.shop.{name}").alias("topic"),
        F.to_json(record).alias("value"),
        F.col(key).cast("bigint").alias("seq"),
    )


def encoded_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order changes with a schema block and encoded values, and the key as ``seq``.

    ``price`` is in cents, negative for odd keys and in 16 bytes for every third; ``total``
    has more digits than a 64-bit number; ``day`` and ``at`` count days and microseconds.
    """
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") * F.when(key % 2 == 1, -1).otherwise(1)
    fill = F.when(cents < 0, "F").otherwise("0")
    price = F.concat(F.when(key % 3 == 0, F.repeat(fill, F.lit(16))).otherwise(""), F.lpad(F.hex(cents), F.lit(16), F.lit("0")))
    # The high 64 bits are the key, the low ones the cents.
    total = F.concat(F.lpad(F.hex(key), F.lit(16), F.lit("0")), F.lpad(F.hex(F.abs(cents)), F.lit(16), F.lit("0")))
    bytes_of = lambda digits: F.base64(F.to_binary(digits, F.lit("hex")))
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + key
    row = F.struct(
        key.alias("id"), bytes_of(price).alias("price"), bytes_of(total).alias("total"),
        F.datediff("o_orderdate", F.lit("1970-01-01")).alias("day"), micros.alias("at"), F.col("o_orderstatus").alias("status"),
    )
    decimal = "org.apache.kafka.connect.data.Decimal"
    column = lambda name, kind, encoding=None, scale=None: {
        "field": name, "type": kind, **({"name": encoding} if encoding else {}), **({"parameters": {"scale": scale}} if scale else {}),
    }
    columns = [
        column("id", "int64"), column("price", "bytes", decimal, "2"), column("total", "bytes", decimal, "5"),
        column("day", "int32", "io.debezium.time.Date"), column("at", "int64", "io.debezium.time.MicroTimestamp"), column("status", "string"),
    ]
    block = json.dumps({"type": "struct", "fields": [{"field": image, "type": "struct", "fields": columns} for image in ("before", "after")]})
    record = F.concat(F.lit(f'{{"schema": {block}, "payload": {{"op": "c", "after": '), F.to_json(row), F.lit("}}"))
    return table(spark, sf_dir, "orders").select(F.lit("srv.shop.orders").alias("topic"), record.alias("value"), key.alias("seq"))


def shop_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of three tables, as one source."""
    orders = raw_changes(spark, sf_dir, "orders", "o_orderkey")
    customers = raw_changes(spark, sf_dir, "customer", "c_custkey")
    nations = raw_changes(spark, sf_dir, "nation", "n_nationkey")
    return orders.unionByName(customers).unionByName(nations)


def envelope(after, before=None, kind: str = "insert", table_name: str = "rules"):
    """Columns of an envelope around the given images."""
    return [
        F.lit("shop").alias("database"),
        F.lit(table_name).alias("tableName"),
        (J.empty_object() if before is None else before).alias("before"),
        after.alias("after"),
        F.lit(kind).alias("type"),
        F.lit(None).cast("string").alias("reason"),
    ]


def rule_changes(spark: SparkSession, rules=ROUTING_RULES) -> DataFrame:
    """Rule rows as changes of the rule table."""
    schema = ", ".join(f"{n} {'bigint' if n == 'seq' else 'string'}" for n in HISTORY_FIELDS)
    rows = spark.createDataFrame(list(rules), schema)
    image = J.drop_null_entries(row_image(*HISTORY_FIELDS[1:]))
    return rows.select(*envelope(image), "seq")


def part_rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long rule-table history from ``part``: every part rewrites the rule of its brand.

    Every 13th change is a deletion, every 17th moves a rule away from another key, and
    odd keys write field names in camel case.
    """
    n = F.col("p_partkey")
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))
    operate = F.element_at(F.array(*map(F.lit, ("insert", "update", "delete"))), (F.col("p_size") % 3 + 1))
    sink = F.element_at(
        F.array(*map(F.lit, ("kafka", "hbase", "topic", "dim", "clickhouse"))), (n % 5 + 1).cast("int")
    )
    columns = (
        F.when(n % 11 == 0, F.lit(None))
        .when(n % 7 == 0, F.lit("id, p_name"))
        .when(n % 10 == 1, F.lit("name,p_size"))
        .when(n % 3 == 0, F.lit("id,p_name,p_size,"))
        .otherwise(F.lit("id,p_type,p_name"))
    )
    pk = F.when(n % 19 == 0, "p_name")
    fields = {
        "source_table": brand,
        "operate_type": operate,
        "sink_type": sink,
        "sink_table": F.concat(F.lit("t_"), brand),
        "sink_columns": columns,
        "sink_pk": pk,
        "sink_extend": F.when(n % 2 == 0, "comment=parts"),
    }

    def image(names, values) -> object:
        pairs = [part for name, value in zip(names, values) for part in (F.lit(name), J.to_variant(value))]
        return J.drop_null_entries(F.create_map(*pairs))

    snake = list(fields)
    camel = [s.split("_")[0] + "".join(w.title() for w in s.split("_")[1:]) for s in snake]
    values = list(fields.values())
    after = F.when(n % 2 == 1, image(camel, values)).otherwise(image(snake, values))
    other = F.element_at(F.array(*map(F.lit, ("update", "delete", "insert"))), (F.col("p_size") % 3 + 1))
    old = image(snake[:2], [brand, F.when(n % 17 == 0, other).otherwise(operate)])
    gone = n % 13 == 0
    kind = F.when(gone, "delete").otherwise("update")
    rows = table(spark, sf_dir, "part")
    return rows.select(
        F.lit("rules").alias("database"),
        F.lit("rules").alias("tableName"),
        old.alias("before"),
        F.when(gone, J.empty_object()).otherwise(after).alias("after"),
        kind.alias("type"),
        F.lit(None).cast("string").alias("reason"),
        n.alias("seq"),
    )


def rules_of_deleted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part a dimension rule, for odd parts its deletion, and a rule with another key for its table."""
    n = F.col("p_partkey").cast("bigint")
    name = n.cast("string")
    text = lambda value: J.to_variant(value if not isinstance(value, str) else F.lit(value))

    def image(operate: str, pk: str):
        fields = {
            "source_table": F.concat(F.lit("t"), name), "operate_type": operate, "sink_type": "hbase",
            "sink_table": F.concat(F.lit("d"), name), "sink_columns": "id,x", "sink_pk": pk,
        }
        return F.create_map(*[part for key, value in fields.items() for part in (F.lit(key), text(value))])

    def change(step: int, kind: str, after=None, before=None):
        empty = J.empty_object()
        images = (empty if before is None else before, empty if after is None else after)
        return F.struct(
            (n * 3 + step).alias("seq"), images[0].alias("before"), images[1].alias("after"), F.lit(kind).alias("type")
        )

    first = image("insert", "id")
    steps = F.array(change(0, "insert", first), change(1, "delete", None, first), change(2, "insert", image("update", "x")))
    wanted = F.filter(steps, lambda step: (step["type"] != "delete") | (n % 2 == 1))
    return table(spark, sf_dir, "part").select(F.inline(wanted))


# The changes of a table come in passes, one per line number, which are this far apart.
PASS = 10**12
CHUNKS = 4


def line_rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-table changes from ``lineitem``: every order is a rule, every line rewrites it.

    Line 4 deletes the rule, line 3 leaves it without columns, and the text of every 50th change is broken.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    number, order = F.col("l_linenumber"), F.col("l_orderkey")
    key = F.struct(F.concat(F.lit("o"), order.cast("string")).alias("source_table"), F.lit("insert").alias("operate_type"))
    rule = F.struct(
        key["source_table"].alias("source_table"), key["operate_type"].alias("operate_type"), F.lit("kafka").alias("sink_type"),
        F.concat(F.lit("x"), number.cast("string")).alias("sink_table"), F.when(number != 3, "id").alias("sink_columns"),
    )
    op = F.when(number == 1, "c").when(number == 4, "d").otherwise("u")
    record = F.to_json(F.struct(op.alias("op"), F.when(number != 1, key).alias("before"), F.when(number != 4, rule).alias("after")))
    broken = (order + number) % 50 == 0
    return lines.select(
        F.lit("srv.rules.rules").alias("topic"), F.when(broken, "{broken").otherwise(record).alias("value"),
        ((number * PASS + order) * 10).alias("seq"), "l_orderkey", "l_linenumber", broken.alias("broken"),
    )


def line_rule_chunks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rules of :func:`line_rule_changes` read in chunks, and the marks around each chunk.

    Chunk c is read during pass c + 2, when the orders up to 3000 have gone through it.
    """
    changes = line_rule_changes(spark, sf_dir)
    chunk = (F.col("l_orderkey") % CHUNKS).cast("int")
    read = changes.withColumn("chunk", chunk).where(F.col("seq") < ((F.col("chunk") + 2) * PASS + 3000) * 10 + 5)
    last = read.groupBy("chunk", "l_orderkey").agg(F.max("l_linenumber").alias("line")).where("line <> 4")
    rows = last.select(
        "chunk", F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("source_table"), F.lit("insert").alias("operate_type"),
        F.lit("kafka").alias("sink_type"), F.concat(F.lit("x"), F.col("line").cast("string")).alias("sink_table"),
        F.when(F.col("line") != 3, "id").alias("sink_columns"),
    )
    low = (F.col("chunk") + 2) * PASS * 10 + 5
    marks = spark.range(CHUNKS).select(F.col("id").cast("int").alias("chunk"))
    return rows, marks.select("chunk", low.alias("low"), (low + PASS * 10).alias("high"))


def part_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three changes per part, one of every type, in the table of its brand."""
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))
    image = F.create_map(
        F.lit("id"), F.col("p_partkey").cast("variant"), F.lit("p_name"), F.col("p_name").cast("variant")
    )
    rows = table(spark, sf_dir, "part").select(
        brand.alias("brand"), image.alias("image"), F.col("p_partkey").alias("seq"),
        F.explode(F.array(*map(F.lit, ("insert", "update", "delete")))).alias("kind"),
    )
    changes = rows.select(*envelope(F.col("image")), "seq", "brand", "kind")
    return changes.withColumns({"tableName": F.col("brand"), "type": F.col("kind")}).drop("brand", "kind")


def customer_dim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three changes per customer: the full row, one column, and a column cleared."""
    rows = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    full = row_image(*rows.columns)
    balance = F.create_map(
        F.lit("c_custkey"), key.cast("variant"), F.lit("c_acctbal"), (-F.col("c_acctbal")).cast("variant")
    )
    null = F.parse_json(F.lit("null"))
    cleared = F.create_map(F.lit("c_custkey"), key.cast("variant"), F.lit("c_mktsegment"), null)

    def change(step: int, payload) -> object:
        return F.struct((key * 3 + step).alias("seq"), payload.alias("payload"))

    steps = F.array(change(0, full), change(1, balance), change(2, cleared))
    wanted = F.filter(steps, lambda s: (s["seq"] % 3 != 2) | (key % 5 == 0))
    exploded = rows.select(key.alias("k"), F.inline(wanted))
    return exploded.select(
        F.lit("dim_customer").alias("sink_table"), F.col("k").cast("string").alias("pk"), "payload", "seq"
    )


def stage_logs(spark: SparkSession, sf_dir: str, root: str) -> FileTopics:
    """Log texts written to a file-backed topic; the key carries ``seq``."""
    topics = FileTopics(f"{root}/source")
    rows = log_text(spark, sf_dir).select(
        F.lit(RAW_LOG_TOPIC).alias("topic"), F.col("seq").cast("string").alias("key"), "value"
    )
    topics.write_batch(rows, 0)
    return topics


def with_seq(messages: DataFrame) -> DataFrame:
    return messages.withColumn("seq", F.col("key").cast("bigint"))


def dim_store(root: str) -> DimStore:
    return DimStore(f"{root}/dims")
