"""Nearest neighbours by a permutation index.

Pivots are vectors of the table itself, chosen apart from each other out of a bounded
sample. Every vector is represented by its ``length`` nearest pivots in order. The rows are
dealt into shards of a bounded size; in a shard, each pivot has an inverted file of
(vector, place of the pivot). A query reads the files of its own nearest pivots only, adds
up the footrule distance (a pivot that one side lacks counts as place ``length``), takes
the best ``share`` of the shard and reranks them by their exact distance. Equal vectors of a
shard are indexed once, with their smallest ids, so that copies take one place of the share.

Queries are a stated set: they meet the shards in blocks, and only the best few of each
query and shard leave a task.

Defined results: a vector that is null, zero, of another length than most of the sample, or that
holds null or a component that is not finite takes no part. Rows that share an id count as
one, at their nearest; a query never finds a row with its own id. Ties go to the smaller id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.tables import Workspace, grouped, partitions, slices_of_groups


@dataclass(frozen=True)
class PermutationIndex:
    """Parameters. ``sample`` bounds the vectors that pivots are chosen from."""

    pivots: int = 128
    length: int = 48
    sample: int = 4096
    share: float = 0.15
    least: int = 200
    shard: int = 4096
    query_block: int = 512
    seed: int = 3


def valid_vectors(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(F.col(key).cast("bigint").alias("vec_id"), values.alias("vector"))
    return rows.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def choose_pivots(vectors: DataFrame, p: PermutationIndex) -> np.ndarray:
    """Pivots far apart from each other, out of the ``sample`` rows of least hash."""
    draw = vectors.select("vector", F.xxhash64("vec_id", F.lit(p.seed)).alias("draw"), "vec_id")
    rows = draw.orderBy("draw", "vec_id").limit(p.sample).collect()
    if not rows:
        return np.zeros((0, 0))
    size = Counter(len(row.vector) for row in rows).most_common(1)[0][0]
    points = np.array([row.vector for row in rows if len(row.vector) == size])
    points = np.unique(points, axis=0)
    chosen, far = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(p.pivots, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), size)


def orders(points: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of each point, nearest first."""
    far = (pivots**2).sum(axis=1)[None, :] - 2 * points @ pivots.T
    length = min(length, len(pivots))
    near = np.argpartition(far, length - 1, axis=1)[:, :length]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1)


def _represent(pivots: np.ndarray, p: PermutationIndex):
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.float64())), ("permutation", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = orders(_matrix(batch.column("vector"), pivots.shape[1]), pivots, p.length)
            offsets = np.arange(0, order.size + 1, order.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(order.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), lists], schema=schema)

    return run


def build(vectors: DataFrame, work: Workspace, p: PermutationIndex = PermutationIndex()) -> tuple[DataFrame, np.ndarray]:
    """The written index (``vec_id, vector, permutation, shard``) of every row, and its pivots."""
    pivots = choose_pivots(vectors, p)
    size = pivots.shape[1] if len(pivots) else 0
    fitting = vectors.where(F.size("vector") == size) if size else vectors.where("false")
    rows = fitting.count()
    shards = max(1, -(-rows // p.shard))
    represented = fitting.mapInArrow(_represent(pivots, p), "vec_id bigint, vector array<double>, permutation array<int>")
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    return work.write(represented.withColumn("shard", shard), "index"), pivots


def footrule(queries: np.ndarray, files: list[tuple[np.ndarray, np.ndarray]], rows: int, length: int) -> np.ndarray:
    """Footrule distance of each query to the rows of a shard, up to a constant per query.

    Each pivot that both sides have replaces the two places ``length`` by their difference.
    """
    out = np.zeros((len(queries), rows), dtype=np.int32)
    for q, order in enumerate(queries):
        for place, pivot in enumerate(order.tolist()):
            row, other = files[pivot]
            out[q, row] += np.abs(other - place) - (length - other) - (length - place)
    return out


def _search(pivots: int, k: int, p: PermutationIndex):
    keys = ["shard", "query_block"]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, keys):
            for start, end, *_ in slices_of_groups(table, keys):
                yield _search_shard(table.slice(start, end - start), pivots, k, p, schema)

    return run


def _distinct_vectors(ids: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of each different vector, that of its smallest id, in the order of these ids; the
    rows of its ``most`` smallest different ids, one vector after the other; and where each begins.
    """
    plain = np.ascontiguousarray(vectors + 0.0)  # -0.0 is 0.0
    raw = plain.view(np.dtype((np.void, plain.dtype.itemsize * plain.shape[1]))).ravel()
    _, group = np.unique(raw, return_inverse=True)
    order = np.lexsort((ids, group))
    group, own = group[order], ids[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (group[1:] != group[:-1]) | (own[1:] != own[:-1])
    order, group, own = order[fresh], group[fresh], own[fresh]
    begin = np.searchsorted(group, np.arange(group[-1] + 1 if len(group) else 0))
    rank = np.arange(len(group)) - begin[group]
    place = np.empty(len(begin), dtype=np.int64)
    place[np.lexsort((begin, own[begin]))] = np.arange(len(begin))
    kept = np.flatnonzero(rank < most)
    kept = kept[np.lexsort((rank[kept], place[group[kept]]))]
    starts = np.searchsorted(place[group[kept]], np.arange(len(begin) + 1))
    return order[kept][starts[:-1]], order[kept], starts


def _search_shard(table: pa.Table, pivots: int, k: int, p: PermutationIndex, schema: pa.Schema) -> pa.RecordBatch:
    asked = table["is_query"].to_numpy()
    ids, size = table["vec_id"].to_numpy(), len(table["vector"][0])
    vectors = _matrix(table["vector"], size)
    order = table["permutation"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    length = order.shape[1]
    queries, rows = np.flatnonzero(asked), np.flatnonzero(~asked)
    first, members, starts = _distinct_vectors(ids[rows], vectors[rows], k + 1)
    first, members = rows[first], rows[members]
    base = order[first]
    posted = np.argsort(base.ravel(), kind="stable")
    cuts = np.searchsorted(base.ravel()[posted], np.arange(pivots + 1))
    files = [(part // length, part % length) for part in (posted[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))]
    wanted = min(len(first), max(p.least, k + 1, round(p.share * len(rows))))
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(queries), 64):
        part = queries[at : at + 64]
        distance = footrule(order[part], files, len(first), length)
        for q, row in zip(part.tolist(), distance, strict=True):
            # Of equal distances the smaller id comes first, whatever the order of the rows.
            key = row.astype(np.int64) * len(first) + np.arange(len(first))
            near = np.argpartition(key, wanted - 1)[:wanted] if wanted else np.zeros(0, int)
            far = np.sqrt(((vectors[first[near]] - vectors[q]) ** 2).sum(axis=1))
            counts = starts[near + 1] - starts[near]
            begin = np.cumsum(counts) - counts
            held = members[np.arange(counts.sum()) + np.repeat(starts[near] - begin, counts)]
            exact, other = np.repeat(far, counts), ids[held] != ids[q]
            held, exact = held[other], exact[other]
            best = np.lexsort((ids[held], exact))[:k]
            for column, value in zip(out, (np.full(len(best), ids[q]), ids[held[best]], exact[best]), strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c) if c else np.zeros(0), f.type) for c, f in zip(out, schema, strict=True)], schema=schema
    )


def nearest(index: DataFrame, pivots: np.ndarray, queries: DataFrame, k: int = 10, p: PermutationIndex = PermutationIndex()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each of ``queries``.

    ``queries`` are rows of the index. Blocks of queries are copied to every shard.
    """
    spark = index.sparkSession
    count = queries.count()
    blocks = max(1, -(-count // p.query_block))
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    block = F.pmod(F.xxhash64("vec_id", F.lit(p.seed + 1)), F.lit(blocks)).cast("int")
    asked = queries.select("vec_id", "vector", "permutation", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                           block.alias("query_block"), F.lit(True).alias("is_query"))
    held = index.select("vec_id", "vector", "permutation", "shard",
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("query_block"), F.lit(False).alias("is_query"))
    together = held.unionByName(asked).repartition(partitions(spark), "shard", "query_block").sortWithinPartitions("shard", "query_block")
    found = together.mapInArrow(_search(len(pivots), k, p), "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
