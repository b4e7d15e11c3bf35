"""Repeated byte strings by a logarithmic family of sampled suffix arrays.

A string of ``length`` bytes holds the heads (``head`` bytes) of ``length - head + 1``
suffixes. The one whose head hashes lowest depends on the string alone, so equal strings
sample the same suffix, and only sampled suffixes are indexed: about one for every hundred
bytes. Consecutive strings that sample one suffix make one entry.

The index is a family of levels. A new batch becomes a suffix array, a table bucketed and
sorted by the head of the suffix; it is merge-scanned against every level, bucket by
bucket and without a shuffle, for heads that both have. Then levels of equal size merge,
so that n batches leave at most log n levels. Suffixes are ordered by a hash of the head
and not by its letters: only equal heads can carry a match, and hashed buckets are even.

Entries of shared heads are compared whole: equal regions are repeats. Where the regions of
a head differ, one of each kind is cut out of its text and its strings of ``length`` bytes
are compared one by one. Regions of very common heads are dealt out string by string.

Defined results: null and empty texts are empty; texts below ``length`` bytes lose nothing;
matches never cross rows, and equal rows are repeats of each other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import words as W
from tidewater.llm.tables import Workspace, grouped, partitions, row_key


@dataclass(frozen=True)
class Repeats:
    """Parameters. A head of half the length keeps short common lines out of the index."""

    length: int = 400
    head: int = 201
    batches: int = 4
    # Heads with more different regions than this are compared string by string over all tasks.
    regions: int = 8192
    buffer: int = 1 << 18

    @property
    def window(self) -> int:
        return self.length - self.head + 1


def sliding(values: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` of every ``width`` values in a row."""
    n = len(values)
    blocks = np.concatenate((values, np.full(-n % width, fill, values.dtype))).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def hashes_of(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` bytes in a row."""
    prefix = W.prefix_hash(data)
    count = len(data) - length + 1
    return W.mix((prefix[length:] - prefix[:-length]) * W.inverse_powers(len(data) + 1)[:count]), prefix


def _buffers(offsets: np.ndarray, p: Repeats) -> Iterator[tuple[int, int, int]]:
    """Parts of the joined texts: start, end, and where the strings that start in it end."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        start = int(offsets[row])
        if offsets[row + 1] - start > p.buffer:
            for at in range(start, int(offsets[row + 1]), p.buffer):
                owned = min(at + p.buffer, int(offsets[row + 1]))
                yield at, min(owned + p.length - 1, int(offsets[row + 1])), owned
            row += 1
            continue
        last = max(row + 1, int(np.searchsorted(offsets, start + p.buffer, side="right")) - 1)
        yield start, int(offsets[last]), int(offsets[last])
        row = last


def entries_of(data: np.ndarray, offsets: np.ndarray, p: Repeats):
    """Sampled suffixes: head, hash of the region, row, first string, strings, and whether
    the head occurs more than once within a string."""
    found: list[list[np.ndarray]] = [[], [], [], [], [], []]
    for start, end, owned in _buffers(offsets, p):
        if end - start < p.length:
            continue
        part = data[start:end]
        heads, prefix = hashes_of(part, p.head)
        low = sliding(heads, p.window, np.minimum, 0xFFFFFFFFFFFFFFFF)
        place = np.arange(len(low))
        row = np.searchsorted(offsets, place + start, side="right") - 1
        valid = (place + start + p.length <= offsets[row + 1]) & (place + start < owned)
        if not valid.any():
            continue
        cut = np.ones(len(low), dtype=bool)
        cut[1:] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(low)) - 1
        keep = valid[first]
        first, last = first[keep], last[keep]
        # A run beyond the window is periodic text; it is cut to bounded regions.
        pieces = (last - first) // p.window + 1
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + inner * p.window
        last = np.minimum(np.repeat(last, pieces), first + p.window - 1)
        bounds = np.zeros(len(low) + 2 * p.window - 2, dtype=np.uint64)
        bounds[p.window - 1 : p.window - 1 + len(low)] = np.where(valid, low, 0)
        chosen = np.flatnonzero(sliding(bounds, p.window, np.maximum, 0) == heads)
        twice = chosen[1:][(heads[chosen[1:]] == heads[chosen[:-1]]) & (np.diff(chosen) <= p.window)]
        tied = np.searchsorted(twice, last + p.window) > np.searchsorted(twice, first)
        to = last + p.length
        region = (prefix[to] - prefix[first]) * W.inverse_powers(len(part) + 1)[first]
        values = (low[first], W.mix(region + (to - first).astype(np.uint64)), row[first],
                  first + start - offsets[row[first]], last - first + 1, tied)
        for column, value in zip(found, values, strict=True):
            column.append(value)
    return [np.concatenate(column) if column else np.zeros(0, np.int64) for column in found]


ENTRY_SCHEMA = "key bigint, region bigint, rid bigint, start int, strings smallint, tied boolean"


def _entries(p: Repeats):
    schema = pa.schema([("key", pa.int64()), ("region", pa.int64()), ("rid", pa.int64()), ("start", pa.int32()),
                        ("strings", pa.int16()), ("tied", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", 4 << 20):
            data, offsets = W.text_bytes(batch.column("text"))
            key, region, row, start, strings, tied = entries_of(data, offsets, p)
            columns = [pa.array(key.view(np.int64)), pa.array(region.view(np.int64)), batch.column("rid").take(pa.array(row, pa.int64())),
                       pa.array(start, pa.int32()), pa.array(strings, pa.int16()), pa.array(tied.astype(bool))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


@dataclass
class SuffixIndex:
    """Levels of suffix arrays, smallest first, and the heads that occur more than once."""

    spark: SparkSession
    work: Workspace
    p: Repeats = Repeats()
    levels: list[tuple[int, str]] = field(default_factory=list)
    shared: list[DataFrame] = field(default_factory=list)

    def _save(self, entries: DataFrame) -> str:
        name = f"suffix_array_{uuid.uuid4().hex}"
        entries.write.bucketBy(partitions(self.spark), "key").sortBy("key").format("parquet").saveAsTable(name)
        return name

    def add(self, rows: DataFrame) -> None:
        """Index a batch of ``rows (rid, text)`` and match it against all levels."""
        entries = rows.mapInArrow(_entries(self.p), ENTRY_SCHEMA)
        size, table = 1, self._save(entries.repartition(partitions(self.spark), "key"))
        batch = self.spark.table(table)
        own = batch.groupBy("key").agg(F.sum(F.when(F.col("tied"), 2).otherwise(1)).alias("n")).where("n > 1").select("key")
        self.shared.append(self.work.write(own, "shared"))
        for _, level in self.levels:
            # A merge join of two arrays with the same buckets; each head leaves once.
            old = self.spark.table(level).select("key").distinct()
            both = batch.select("key").distinct().hint("merge").join(old, "key")
            self.shared.append(self.work.write(both, "shared"))
        while self.levels and self.levels[0][0] == size:
            _, level = self.levels.pop(0)
            merged = self._save(self.spark.table(level).unionByName(self.spark.table(table)))
            for old_table in (level, table):
                self.spark.sql(f"DROP TABLE {old_table}")
            size, table = 2 * size, merged
        self.levels.insert(0, (size, table))

    def matched(self) -> DataFrame:
        """Entries of all levels whose head occurs more than once; the index stays as it is."""
        heads = self.shared[0]
        for more in self.shared[1:]:
            heads = heads.unionByName(more)
        heads = self.work.write(heads.distinct(), "heads")
        found = [self.spark.table(level).join(heads, "key", "left_semi") for _, level in self.levels]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return self.work.write(out, "matched")

    def drop(self) -> None:
        for _, level in self.levels:
            self.spark.sql(f"DROP TABLE {level}")
        self.levels = []


class KeyFilter:
    """Bits of a set of hashed row keys. It may let others pass, but stops none of the set.

    At most ``limit`` bits are made, so its size is bounded whatever the number of keys.
    It only spares a shuffle of texts that no join would keep.
    """

    def __init__(self, keys: DataFrame, limit: int = 1 << 26) -> None:
        count = keys.count()
        self.bits = 1 << 16
        while self.bits < min(limit, 16 * count):
            self.bits *= 2
        place = F.pmod(F.col("rid"), F.lit(self.bits))
        words = keys.select((place / 64).cast("bigint").alias("word"), (place % 64).cast("int").alias("bit"))
        words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toArrow()
        mask = np.zeros(self.bits // 64, dtype=np.uint64)
        mask[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
        self.mask = keys.sparkSession.sparkContext.broadcast(mask)

    def passes(self, rid: np.ndarray) -> np.ndarray:
        place = np.mod(rid, self.bits).astype(np.uint64)
        return (self.mask.value[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def _only(keys: KeyFilter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keys.passes(batch.column("rid").to_numpy())))

    return run


_REGION = pa.schema([("key", pa.int64()), ("region", pa.int64()), ("copies", pa.int64()), ("kinds", pa.int64()), ("data", pa.binary())])
REGION_SCHEMA = "key bigint, region bigint, copies bigint, kinds bigint, data binary"


def _cut(p: Repeats):
    """The wanted regions of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", 2 << 20):
            out: list[list] = [[], [], [], [], []]
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                data = text.encode()
                for item in wanted:
                    region = data[item["start"] : item["start"] + item["strings"] + p.length - 1]
                    for column, value in zip(out, (item["key"], item["region"], item["copies"], item["kinds"], region), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _REGION, strict=True)], schema=_REGION)

    return run


def _strings(data: list[bytes], p: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every string of the regions, with its region and its place in it."""
    joined = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(d) for d in data])
    counts = np.array([len(d) - p.length + 1 for d in data])
    owner = np.repeat(np.arange(len(data)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (ends - [len(d) for d in data])[owner] + place
    prefix = W.prefix_hash(joined)
    return W.mix((prefix[at + p.length] - prefix[at]) * W.inverse_powers(len(joined) + 1)[at]), owner, place


def repeated_strings(data: list[bytes], copies: np.ndarray, p: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Region and place of each string that occurs more than once, copies counted."""
    hashed, owner, place = _strings(data, p)
    order = np.argsort(hashed, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], hashed[order][1:] != hashed[order][:-1])))
    total = np.add.reduceat(copies[owner[order]], first)
    often = order[np.repeat(total > 1, np.diff(np.append(first, len(order))))]
    often.sort()
    return owner[often], place[often]


def ranges(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted places per owner as ranges of consecutive ones."""
    if not len(owner):
        return owner, place, place
    cut = np.concatenate(([True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)))
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], place[first], place[last]


_PARTIAL = pa.schema([("key", pa.int64()), ("region", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
PARTIAL_SCHEMA = "key bigint, region bigint, first int, last int"


def _compare(p: Repeats):
    """Ranges of repeated strings of the regions with one copy, head by head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["key"]):
            key = table["key"].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            at = 0
            while at < len(cuts) - 1:
                # Heads share no string, so some may be compared together.
                to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + 400, side="right")) - 1)
                part = table.slice(cuts[at], cuts[to] - cuts[at])
                at = to
                region = part["region"].to_numpy()
                _, fresh = np.unique(np.stack((part["key"].to_numpy(), region)), axis=1, return_index=True)  # equal rows
                part = part.take(pa.array(np.sort(fresh)))
                copies = part["copies"].to_numpy()
                owner, place = repeated_strings(part["data"].to_pylist(), copies, p)
                once = copies[owner] == 1
                owner, first, last = ranges(owner[once], place[once])
                columns = [part["key"].to_numpy()[owner], part["region"].to_numpy()[owner], first.astype(np.int32), last.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_PARTIAL)

    return run


def _explode(p: Repeats):
    """Every string of every region as a row of its own."""
    schema = pa.schema([("hash", pa.int64()), ("key", pa.int64()), ("region", pa.int64()), ("copies", pa.int64()), ("first", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                hashed, owner, place = _strings(part.column("data").to_pylist(), p)
                columns = [hashed.view(np.int64), *[part.column(n).to_numpy()[owner] for n in ("key", "region", "copies")], place.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _compare_common(regions: DataFrame, p: Repeats) -> DataFrame:
    """The same for heads with very many regions: strings are counted over all tasks."""
    strings = regions.mapInArrow(_explode(p), "hash bigint, key bigint, region bigint, copies bigint, first int")
    strings = strings.dropDuplicates(["key", "region", "first"])
    often = strings.groupBy("hash").agg(F.sum("copies").alias("n")).where("n > 1").select("hash")
    found = strings.where("copies = 1").join(often, "hash", "left_semi")
    return found.select("key", "region", "first", F.col("first").alias("last"))


def repeated_spans(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """``rid, spans``: byte ranges of each row of ``docs (doc_id, text)`` that are repeated strings."""
    spark = docs.sparkSession
    work = Workspace(spark, "suffixes")
    rows = docs.select(F.col("text").cast("string").alias("text"), row_key().alias("rid"))
    index = SuffixIndex(spark, work, p)
    long_enough = rows.where(F.octet_length("text") >= p.length)
    for batch in range(p.batches):
        index.add(long_enough.where(F.pmod(F.xxhash64("rid"), F.lit(p.batches)) == batch))
    matched = index.matched()
    index.drop()

    least = F.min(F.struct("rid", "start")).alias("least")
    regions = matched.groupBy("key", "region").agg(
        least, F.count("*").alias("copies"), F.max("tied").alias("tied"), F.first("strings").alias("strings")
    )
    regions = work.write(regions, "regions")
    heads = regions.groupBy("key").agg(F.count("*").alias("kinds"), F.min("copies").alias("fewest"), F.max("tied").alias("any_tied"))
    unclear = heads.where("fewest = 1 AND (kinds > 1 OR any_tied)").select("key", "kinds")
    wanted = regions.join(unclear, "key").select("least.rid", "least.start", "key", "region", "copies", "kinds", "strings")
    wanted = work.write(
        wanted.groupBy("rid").agg(F.collect_list(F.struct("key", "region", "copies", "kinds", "start", "strings")).alias("wanted")), "wanted"
    )
    near = rows.mapInArrow(_only(KeyFilter(wanted.select("rid"))), "text string, rid bigint")
    cut = near.join(wanted, "rid").select("text", "wanted").mapInArrow(_cut(p), REGION_SCHEMA)
    cut = work.write(cut, "cut")
    dealt = cut.where(F.col("kinds") <= p.regions).repartition(partitions(spark), "key").sortWithinPartitions("key")
    partial = dealt.mapInArrow(_compare(p), PARTIAL_SCHEMA)
    partial = partial.unionByName(_compare_common(cut.where(F.col("kinds") > p.regions), p))
    whole = regions.where("copies > 1").select("key", "region", F.lit(0).alias("first"), (F.col("strings") - 1).cast("int").alias("last"))
    verdicts = work.write(whole.unionByName(partial), "verdicts")
    spans = matched.join(verdicts, ["key", "region"]).select(
        "rid", F.struct((F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + p.length).alias("end")).alias("span")
    )
    return work.write(spans.groupBy("rid").agg(F.collect_list("span").alias("spans")), "spans")


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Ranges as maximal runs."""
    out: list[list[int]] = []
    for start, end in sorted((span["start"], span["end"]) for span in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(run) for run in out]


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for start, end in runs:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]])


def _hash_or_text(keys: KeyFilter):
    """The digest of texts that surely lose nothing, and the others as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", 2 << 20):
            maybe = keys.passes(batch.column("rid").to_numpy())
            digest, size, text = [], [], []
            for value, held in zip(batch.column("text").to_pylist(), maybe, strict=True):
                data = (value or "").encode()
                size.append(len(data))
                digest.append(None if held else hashlib.sha256(data).hexdigest())
                text.append(value if held else None)
            columns = [batch.column("doc_id"), batch.column("rid"), pa.array(size), pa.array(digest, pa.string()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "rid", "n_bytes", "kept_sha256", "text"])

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text", 2 << 20):
        removed, count, digest = [], [], []
        for text, spans, known in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "kept_sha256")), strict=True):
            runs = merged(spans or [])
            removed.append(sum(end - start for start, end in runs))
            count.append(len(runs))
            digest.append(known or hashlib.sha256(kept_bytes((text or "").encode(), runs)).hexdigest())
        columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removal_digest(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``."""
    spans = repeated_spans(docs, p)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("rid"), F.col("text").cast("string").alias("text"))
    ready = rows.mapInArrow(
        _hash_or_text(KeyFilter(spans.select("rid"))), "doc_id bigint, rid bigint, n_bytes bigint, kept_sha256 string, text string"
    )
    joined = ready.join(spans, "rid", "left").select("doc_id", "n_bytes", "kept_sha256", "text", "spans")
    return joined.mapInArrow(_remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """``docs`` with ``kept``, the bytes that remain of each text; all columns stay."""
    spans = repeated_spans(docs, p).select(F.col("rid").alias("_rid"), F.col("spans").alias("_spans"))
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("_key"))
    joined = rows.join(spans, F.col("_key") == F.col("_rid"), "left")

    def cut(text: str | None, spans: list | None) -> bytes:
        return kept_bytes((text or "").encode(), merged([{"start": s["start"], "end": s["end"]} for s in spans or []]))

    kept = F.udf(cut, "binary", useArrow=False)(F.col("row.text").cast("string"), "_spans")
    return joined.select(F.col("row").withField("kept", kept).alias("row")).select("row.*")
