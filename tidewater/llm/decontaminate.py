"""Benchmark decontamination on a distributed positional inverted index.

The index stores postings of *all* words of the training documents. Documents are indexed
in blocks of some megabytes of text; a block has one row per word, with the ascending
positions of that word as differences in variable-length bytes. Positions run through the
documents of a block with a gap between them, so a phrase never spans two documents. A
block is made by the task that reads its documents: building the index needs no shuffle.

A search looks up the words of the benchmark, counts their postings over all blocks, and
orders the words of every phrase from the rarest on. A phrase is looked at in those blocks
only that hold its rarest word; there its lists are adjusted by the offsets of the words
and intersected in that order. ``slop`` allows words that many places off (proximity).

Defined results: null and empty texts have no words, are hit by nothing and are no items.
Rows that share an id are judged one by one; equal items count once for each row. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import words as W
from tidewater.llm.tables import Workspace, grouped, partitions, row_key
from tidewater.session import broadcast_if_small


@dataclass(frozen=True)
class Contamination:
    """Windows of ``window`` words; a document is contaminated from 1/``share`` of its words on."""

    window: int = 13
    slop: int = 0
    share: int = 20
    block_bytes: int = 6 << 20

    @property
    def gap(self) -> int:
        return self.window + self.slop + 1


# One row of the index: the postings of a word, or (with a NULL word) a document's place.
INDEX_SCHEMA = "block bigint, word bigint, count bigint, data binary, doc_id bigint, rid bigint, start bigint"
_INDEX = pa.schema(
    [("block", pa.int64()), ("word", pa.int64()), ("count", pa.int64()), ("data", pa.binary()),
     ("doc_id", pa.int64()), ("rid", pa.int64()), ("start", pa.int64())]
)


def encode_postings(word: np.ndarray, place: np.ndarray):
    """Distinct words, their counts, and their places as differences in 7-bit groups."""
    order = np.argsort(word, kind="stable")
    word, place = word[order], place[order]
    first = np.concatenate(([True], word[1:] != word[:-1])) if len(word) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    step = place.copy()
    step[1:] -= place[:-1]
    step[starts] = place[starts]
    step = step.astype(np.uint32)
    width = np.ones(len(step), dtype=np.int64)
    for bits in (7, 14, 21, 28):
        width += step >= np.uint32(1 << bits)
    ends = np.cumsum(width)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    begin = ends - width
    for i in range(int(width.max()) if len(width) else 0):
        has = np.flatnonzero(width > i)
        value = (step[has] >> np.uint32(7 * i)) & np.uint32(127)
        data[begin[has] + i] = value | ((width[has] > i + 1).astype(np.uint32) << np.uint32(7))
    return word[starts], np.diff(np.append(starts, len(word))), data, np.append(begin[starts], len(data))


def decode_postings(data: bytes) -> np.ndarray:
    byte = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(byte < 128)
    begin = np.concatenate(([0], last[:-1] + 1))
    shift = np.arange(len(byte)) - np.repeat(begin, last - begin + 1)
    step = np.add.reduceat((byte & 127).astype(np.int64) << (7 * shift), begin)
    return np.cumsum(step)


def _index_blocks(p: Contamination):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in W.slices(batches, "text", p.block_bytes):
            words, rows = W.word_hashes(batch.column("text"))
            counts = np.diff(rows)
            start = rows[:-1] + p.gap * np.arange(batch.num_rows)
            place = np.arange(len(words)) + np.repeat(p.gap * np.arange(batch.num_rows), counts)
            word, n, data, offsets = encode_postings(words.view(np.int64), place)
            postings = pa.BinaryArray.from_buffers(
                pa.binary(), len(word), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
            )
            for columns in (
                [pa.array(np.full(len(word), block)), pa.array(word), pa.array(n), postings,
                 *[pa.nulls(len(word), pa.int64())] * 3],
                [pa.array(np.full(len(start), block)), pa.nulls(len(start), pa.int64()), pa.array(counts),
                 pa.nulls(len(start), pa.binary()), batch.column("doc_id"), batch.column("rid"), pa.array(start)],
            ):
                yield pa.RecordBatch.from_arrays(columns, schema=_INDEX)
            block += 1

    return run


def build_index(docs: DataFrame, work: Workspace, p: Contamination = Contamination()) -> DataFrame:
    """The written index over ``docs (doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("rid", row_key())
    return work.write(rows.mapInArrow(_index_blocks(p), INDEX_SCHEMA), "postings")


def _windows(width: int):
    schema = pa.schema([("item", pa.string()), ("phrase", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            words, rows = W.word_hashes(batch.column("text"))
            items, phrases = [], []
            for item, a, b in zip(batch.column("item").to_pylist(), rows[:-1], rows[1:], strict=True):
                found = words[a:b].view(np.int64)
                size = min(width, len(found))
                for at in range(len(found) - size + 1 if size else 0):
                    items.append(item)
                    phrases.append(found[at : at + size])
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(phrases, schema[1].type)], schema=schema)

    return run


def phrases_of(items: DataFrame, width: int) -> DataFrame:
    """``item, phrase``: the windows of ``items (item_id, text)`` as lists of word hashes."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                        F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_windows(width), "item string, phrase array<bigint>")


def intersect(lists: dict[int, np.ndarray], order: list[tuple[int, int]], slop: int) -> np.ndarray:
    """Starts of a phrase whose ``(word, offset)`` are ordered from the rarest word on."""
    starts = None
    for word, offset in order:
        places = lists.get(word)
        if places is None or not len(places):
            return np.zeros(0, dtype=np.int64)
        if starts is None:
            starts = places - offset
            continue
        near = np.searchsorted(places, starts + offset - slop)
        inside = near < len(places)
        inside[inside] = places[near[inside]] <= starts[inside] + offset + slop
        starts = starts[inside]
        if not len(starts):
            break
    return starts


class _Postings(dict):
    """Lists of one block, decoded when they are first needed."""

    def __init__(self, encoded: dict[int, bytes]) -> None:
        super().__init__()
        self.encoded = encoded

    def get(self, word: int, default=None):
        if word not in self and word in self.encoded:
            self[word] = decode_postings(self.encoded[word])
        return super().get(word, default)


def _search_blocks(p: Contamination):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("rid", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["block"]):
            block = table["block"].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield _search_block(table.slice(low, high - low), p, schema)

    return run


def _search_block(table: pa.Table, p: Contamination, schema: pa.Schema) -> pa.RecordBatch:
    """All documents of a block with the words that are hit and the items that hit them."""
    kind = table["kind"].to_numpy()
    places = table.filter(pa.array(kind == 0)).sort_by("start")
    start, counts = places["start"].to_numpy(), places["count"].to_numpy()
    encoded = table.filter(pa.array(kind == 1))
    lists = _Postings(dict(zip(encoded["word"].to_pylist(), encoded["data"].to_pylist(), strict=True)))
    hits: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    probes = table.filter(pa.array(kind == 2))
    for words, offsets, names in zip(*(probes[c].to_pylist() for c in ("words", "offsets", "items")), strict=True):
        found = intersect(lists, list(zip(words, offsets, strict=True)), p.slop)
        for at in found.tolist():
            row = int(np.searchsorted(start, at + p.slop, side="right")) - 1
            hits.setdefault(row, []).append((max(at, int(start[row])), at + len(words)))
            items.setdefault(row, set()).update(names)
    n_hit = np.zeros(len(start), dtype=np.int64)
    for row, spans in hits.items():
        reach = 0
        for low, high in sorted(spans):
            high = min(high, int(start[row] + counts[row]))
            n_hit[row] += max(0, high - max(low, reach))
            reach = max(reach, high)
    named = [sorted(items.get(row, ())) for row in range(len(start))]
    columns = [places["doc_id"].combine_chunks(), places["rid"].combine_chunks(), pa.array(counts), pa.array(n_hit), pa.array(named, schema[4].type)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def find_phrases(index: DataFrame, phrases: DataFrame, work: Workspace, p: Contamination = Contamination()) -> DataFrame:
    """``doc_id, rid, n_words, n_hit, items`` for every document of the index."""
    spark = index.sparkSession
    phrases = work.write(
        phrases.groupBy("phrase").agg(F.sort_array(F.collect_set("item")).alias("items")), "phrases"
    ).withColumn("id", F.xxhash64("phrase"))
    placed = phrases.select("id", F.posexplode("phrase").alias("offset", "word"))
    postings = index.where("word IS NOT NULL")
    # Postings of the words that are looked for, and how often each one occurs.
    vocabulary = broadcast_if_small(placed.select("word").distinct())
    wanted = work.write(postings.join(vocabulary, "word", "left_semi").select("block", "word", "count", "data"), "wanted")
    counts = wanted.groupBy("word").agg(F.sum("count").alias("count"))
    ordered = placed.join(counts, "word", "left").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "offset", "word"))).alias("order")
    )
    # A phrase with a word that no document has cannot occur.
    ordered = ordered.where("order[0].count > 0").join(phrases.select("id", "items"), "id")
    ordered = ordered.select(
        F.col("order")[0]["word"].alias("word"), F.col("order.word").alias("words"), F.col("order.offset").alias("offsets"), "items"
    )
    probes = wanted.select("block", "word").join(broadcast_if_small(ordered), "word")

    shape = {"kind": "int", "word": "bigint", "count": "bigint", "data": "binary", "doc_id": "bigint", "rid": "bigint", "start": "bigint",
             "words": "array<bigint>", "offsets": "array<int>", "items": "array<string>"}

    def rows(df: DataFrame, kind: int) -> DataFrame:
        fields = {name: F.col(name) if name in df.columns else F.lit(None) for name in shape} | {"kind": F.lit(kind)}
        return df.select("block", *[fields[name].cast(of).alias(name) for name, of in shape.items()])

    places = index.where("word IS NULL").select("block", "count", "doc_id", "rid", "start")
    together = rows(places, 0).unionByName(rows(wanted, 1)).unionByName(rows(probes.drop("word"), 2))
    dealt = together.repartition(partitions(spark), "block").sortWithinPartitions("block")
    return dealt.mapInArrow(_search_blocks(p), "doc_id bigint, rid bigint, n_words bigint, n_hit bigint, items array<string>")


def contamination(docs: DataFrame, items: DataFrame, p: Contamination = Contamination()) -> DataFrame:
    """``doc_id, rid, n_words, n_hit, items, contaminated`` for every row of ``docs``."""
    work = Workspace(docs.sparkSession, "decontaminate")
    found = find_phrases(build_index(docs, work, p), phrases_of(items, p.window), work, p)
    hit = (F.col("n_hit") > 0) & (F.lit(p.share) * F.col("n_hit") >= F.col("n_words"))
    return found.withColumn("contaminated", hit)
