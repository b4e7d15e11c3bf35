"""Similarity join on word shingles: Bayesian pruning of candidates, exact verification.

1. Every text becomes the set of its five-word shingles. Equal sets are one *text class*
   with a number of copies, so copies are never paired with one another.
2. Bands of MinHash values put classes into buckets. Within a bucket the pairs are
   compared on further MinHash values, a few at a time; a pair is dropped as soon as the
   posterior probability that its similarity reaches the threshold is below ``tolerance``.
   The survivors are reduced to spanning links of candidate components.
3. Within a candidate component the pairs are pruned in the same way, and what is left is
   verified exactly on the shingle sets. Only counts per class and spanning links leave a
   task; a bucket or component of any size is dealt out in pairs of bounded blocks.

Defined results: null and empty texts, and texts without a word, are classes of their own
row with no links. Texts of fewer than five words are one shingle. Equal rows count as
copies of each other. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import words as W
from tidewater.llm.components import connected_components
from tidewater.llm.tables import Workspace, grouped, partitions, row_key, slices_of_groups, with_block_pairs


@dataclass(frozen=True)
class JaccardJoin:
    """Parameters. 24 bands of 4 rows miss a pair at 0.8 with a probability of 3e-6."""

    threshold: float = 0.8
    width: int = 5
    bands: int = 24
    rows: int = 4
    compared: int = 64
    step: int = 16
    tolerance: float = 1e-6
    block: int = 384
    seed: int = 7


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float, compared: int, step: int) -> tuple[int, ...]:
    """After each ``step`` values, the fewest matches with which a pair is kept.

    With a uniform prior, m matches of n give the similarity a Beta(1 + m, 1 + n - m)
    distribution, whose upper tail at t is the chance of at most m successes of n + 1.
    """
    out = []
    for n in range(step, compared + 1, step):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def surviving_pairs(sketch: np.ndarray, left: np.ndarray, right: np.ndarray, p: JaccardJoin):
    """The pairs that no step of the comparison has dropped."""
    matches = np.zeros(len(left), dtype=np.int32)
    bounds = least_matches(p.threshold, p.tolerance, p.compared, p.step)
    for i, bound in enumerate(bounds):
        part = slice(i * p.step, (i + 1) * p.step)
        matches += (sketch[left, part] == sketch[right, part]).sum(axis=1, dtype=np.int32)
        keep = matches >= bound
        left, right, matches = left[keep], right[keep], matches[keep]
    return left, right


def pairs_of(own: np.ndarray, block_a: int, block_b: int):
    """Index pairs of one group: within its block, or between its two blocks; in portions."""
    if block_a == block_b:
        first, second = np.arange(len(own)), np.arange(len(own))
    else:
        first, second = np.flatnonzero(own == block_a), np.flatnonzero(own == block_b)
    portion = max(1, 200_000 // max(1, len(second)))
    for at in range(0, len(first), portion):
        left, right = np.meshgrid(first[at : at + portion], second, indexing="ij")
        left, right = left.ravel(), right.ravel()
        if block_a == block_b:
            left, right = left[left < right], right[left < right]
        yield left, right


def spanning(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each index is linked to."""
    root = np.arange(count)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _sketches(p: JaccardJoin):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("rid", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
         ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            words, rows = W.word_hashes(batch.column("text"))
            low, high, bands, sketch = [], [], [], []
            for i in range(batch.num_rows):
                values = W.distinct(W.shingles(words[rows[i] : rows[i + 1]], p.width))
                if not len(values):
                    for column in (low, high, bands, sketch):
                        column.append(None)
                    continue
                key = W.set_key(values)
                low.append(key[0])
                high.append(key[1])
                hashes = W.minhash(values, p.bands * p.rows + p.compared, p.seed)
                bands.append(W.band_keys(hashes[: p.bands * p.rows], p.rows))
                sketch.append(hashes[p.bands * p.rows :].astype(np.uint16).tobytes())
            columns = [batch.column("doc_id"), batch.column("rid"), *map(pa.array, (low, high)),
                       pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _candidate_links(p: JaccardJoin):
    """Spanning links of the pairs of each bucket that survive the comparison."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["bucket", "block_a", "block_b"]):
            node = table["low"].to_numpy()
            own, sketch = table["_own"].to_numpy(), _matrix(table["sketch"], p)
            found_a, found_b = [], []
            for start, end, a, b in slices_of_groups(table, ["bucket", "block_a", "block_b"]):
                left, right = [], []
                for i, j in pairs_of(own[start:end], a, b):
                    i, j = surviving_pairs(sketch[start:end], i, j, p)
                    left.append(i)
                    right.append(j)
                root = spanning(end - start, np.concatenate(left), np.concatenate(right)) if left else []
                linked = np.flatnonzero(root != np.arange(end - start)) if len(root) else []
                found_a.append(node[start:end][linked] if len(linked) else node[:0])
                found_b.append(node[start:end][root[linked]] if len(linked) else node[:0])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found_a, found_b)], schema=schema)

    return run


def _matrix(column: pa.ChunkedArray, p: JaccardJoin) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint16).reshape(-1, p.compared)


def exact_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of the sorted sets have at least the Jaccard similarity, in integers."""
    if not len(left):
        return np.zeros(0, dtype=bool)
    size = np.array([len(s) for s in sets])
    used = np.unique(np.concatenate((left, right)))
    values = np.concatenate([sets[i] for i in used])
    holder = np.repeat(np.arange(len(used)), size[used])
    order = np.argsort(values, kind="stable")
    values, holder = values[order], holder[order]
    fresh = np.concatenate(([True], values[1:] != values[:-1]))
    term = np.cumsum(fresh) - 1
    shared = np.bincount(term)[term] > 1
    _, term = np.unique(term[shared], return_inverse=True)
    holder = holder[shared]
    common = np.zeros((len(used), len(used)), dtype=np.float32)
    order = np.argsort(term, kind="stable")
    term, holder = term[order], holder[order]
    terms = int(term[-1]) + 1 if len(term) else 0
    columns = max(1, min(terms, (8 << 20) // len(used)))
    for at in range(0, terms, columns):
        low, high = np.searchsorted(term, (at, at + columns))
        part = np.zeros((len(used), columns), dtype=np.float32)
        part[holder[low:high], term[low:high] - at] = 1
        common += part @ part.T
    place = np.searchsorted(used, np.stack((left, right)))
    both = common[place[0], place[1]].astype(np.int64)
    # |A and B| / |A or B| >= t, without a division
    return both * 1_000_000 >= round(threshold * 1_000_000) * (size[left] + size[right] - both)


def _verified_links(p: JaccardJoin):
    """Per class of a pair of blocks: links to other classes, weighted by their copies."""
    schema = pa.schema([("low", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])
    keys = ["component", "block_a", "block_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, keys):
            for start, end, a, b in slices_of_groups(table, keys):
                part = table.slice(start, end - start)
                _, first = np.unique(part["low"].to_numpy(), return_index=True)  # equal rows
                part = part.take(pa.array(np.sort(first)))
                node, copies, own = (part[name].to_numpy() for name in ("low", "copies", "_own"))
                sets = []
                for piece in W.slices(part.select(["text"]).to_batches(), "text"):
                    words, rows = W.word_hashes(piece.column("text"))
                    sets += [W.distinct(W.shingles(words[rows[i] : rows[i + 1]], p.width)) for i in range(piece.num_rows)]
                sketch = _matrix(part["sketch"], p)
                links = np.zeros(len(node), dtype=np.int64)
                root = np.arange(len(node))
                for i, j in pairs_of(own, a, b):
                    i, j = surviving_pairs(sketch, i, j, p)
                    keep = exact_pairs(sets, i, j, p.threshold)
                    i, j = i[keep], j[keep]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    known = np.flatnonzero(root != np.arange(len(root)))
                    root = spanning(len(node), np.concatenate((i, known)), np.concatenate((j, root[known])))
                found = links > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[found]), pa.array(node[root[found]]), pa.array(links[found])], schema=schema
                )

    return run


def _by_group(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)


def jaccard_classes(docs: DataFrame, p: JaccardJoin = JaccardJoin()) -> DataFrame:
    """``doc_id, rid, class_id, n_links`` for every row of ``docs (doc_id, text)``.

    ``class_id`` is the smallest ``doc_id`` that similar texts lead to, ``n_links`` the
    number of other rows whose similarity reaches the threshold.
    """
    work = Workspace(docs.sparkSession, "jaccard")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("rid", row_key())
    sketches = rows.mapInArrow(
        _sketches(p), "doc_id bigint, rid bigint, low bigint, high bigint, bands array<bigint>, sketch binary"
    )
    sketches = work.write(sketches, "sketches")

    # The least row of each class stands for it; equal sets have equal bands and sketches.
    least = F.min(F.struct("doc_id", "rid")).alias("least")
    classes = work.write(
        sketches.where("low IS NOT NULL").groupBy("low", "high").agg(
            least, F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    banded = classes.select("low", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = banded.join(shared, "bucket").join(classes.select("low", "sketch"), "low")
    dealt = with_block_pairs(members, "size", p.block, F.xxhash64("low", F.lit(p.seed)))
    candidates = _by_group(dealt, ["bucket", "block_a", "block_b"]).mapInArrow(_candidate_links(p), "a bigint, b bigint")
    component = work.write(connected_components(work, candidates.distinct()), "candidates")

    sizes = component.groupBy("component").agg(F.count("*").alias("size"))
    wanted = component.join(sizes, "component").join(classes.drop("bands"), F.col("node") == F.col("low"))
    wanted = wanted.select("component", "size", "low", "copies", "sketch", F.col("least.rid").alias("rid"),
                           F.col("least.doc_id").alias("least_id"))
    texts = rows.join(wanted, "rid").where(F.col("doc_id").eqNullSafe(F.col("least_id"))).drop("rid", "doc_id", "least_id")
    dealt = with_block_pairs(texts, "size", p.block, F.xxhash64("low", F.lit(p.seed)))
    verified = _by_group(dealt, ["component", "block_a", "block_b"]).mapInArrow(
        _verified_links(p), "low bigint, root bigint, links bigint"
    )
    verified = work.write(verified, "verified")

    joined = connected_components(work, verified.select(F.col("low").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("low").agg(F.sum("links").alias("links"))
    named = classes.select("low", "high", "copies", F.col("least.doc_id").alias("least_id"))
    named = named.join(joined.withColumnRenamed("node", "low"), "low", "left").join(links, "low", "left")
    named = named.withColumn("component", F.coalesce("component", "low"))
    lowest = named.groupBy("component").agg(F.min("least_id").alias("class_id"))
    named = work.write(
        named.join(lowest, "component").select(
            "low", "high", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "named",
    )
    return sketches.select("doc_id", "rid", "low", "high").join(named, ["low", "high"], "left").select(
        "doc_id", "rid", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def keep_one_per_class(docs: DataFrame, p: JaccardJoin = JaccardJoin()) -> DataFrame:
    """The row of each class with the smallest ``doc_id``; all columns of ``docs`` stay."""
    found = jaccard_classes(docs, p)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = kept.groupBy(F.col("rid").alias("_row_key")).agg(F.max("class_id").alias("_class"), F.count("*").alias("_rows"))
    rows = docs.select(F.struct("*").alias("row"), row_key("doc_id", "text").alias("_row_key")).join(kept, "_row_key")
    rows = rows.where(F.col("row.doc_id").eqNullSafe(F.col("_class")))
    single = rows.where("_rows = 1 OR coalesce(row.text, '') = ''")
    repeated = rows.where("_rows > 1 AND coalesce(row.text, '') <> ''").dropDuplicates(["_row_key"])
    return single.unionByName(repeated).select("row.*")
