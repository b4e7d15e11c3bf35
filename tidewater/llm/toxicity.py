"""Toxicity: boosted trees over dense features of the whole text, with isotonic calibration.

The lexicon is a short public word list and what labelled rows add to it: words, and the
beginnings of words, that stand out in toxic texts. Features are densities of the lexicon,
its nearness to the second person, capitals, punctuation and obfuscated words. A row never
gets its training features from a lexicon that has seen it: two halves of the labelled
rows learn a lexicon for each other.

Defined results: null and empty texts have all features 0 and are scored like any other
text; rows that share an id are scored one by one; without labels of both kinds every
score is the share of label 1, or 0. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import boosted
from tidewater.llm import words as W
from tidewater.llm.tables import Workspace

# Common English insults, and second-person words of four languages.
INSULTS = (
    "clown disgusting dumb dumbass fool freak garbage hate idiot idiotic imbecile jerk kill loser losers moron "
    "morons nazi pathetic pig rat retard scum shut slut stupid suck sucks trash ugly vermin whore worthless"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine sie ihr euch ti tú usted "
    "ustedes vosotros vuestro"
).split()
OBFUSCATING = np.zeros(256, dtype=bool)
OBFUSCATING[[ord(c) for c in "*@$#!|+013457"]] = True
LETTER = W.IS_WORD.copy()
LETTER[48:58] = False
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
EMPHASIS = np.zeros(256, dtype=bool)
EMPHASIS[[ord(c) for c in "!?*%$&#@"]] = True
FEATURES = 12


@dataclass(frozen=True)
class Toxicity:
    """Parameters. ``labelled`` bounds the labelled rows that a model is fitted on."""

    labelled: int = 30_000
    lexicon: int = 4_000
    prefixes: tuple[int, ...] = (4, 5, 6)
    support: int = 3
    deviation: float = 3.5
    threshold: float = 0.7
    near: int = 4


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _terms(column: pa.Array, p: Toxicity):
    """Per word: its hash, the hashes of its beginnings (0 if shorter), and its row."""
    data, offsets = W.text_bytes(column)
    starts, ends, rows = W.word_bounds(data, offsets)
    out = np.zeros((1 + len(p.prefixes), len(starts)), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + W.PIECE, side="right")))
        part = W.LOWER[data[base : ends[to - 1]]]
        hashed, inverse = W.prefix_hash(part), W.inverse_powers(len(part) + 1)
        begin, end = starts[at:to] - base, ends[at:to] - base
        scale = inverse[begin]
        out[0, at:to] = W.mix((hashed[end] - hashed[begin]) * scale + (end - begin).astype(np.uint64))
        for i, size in enumerate(p.prefixes):
            longer = np.flatnonzero(end - begin > size)
            value = (hashed[begin[longer] + size] - hashed[begin[longer]]) * scale[longer]
            out[1 + i, at + longer] = W.mix(value + np.uint64(1000 + size))
        at = to
    return data, offsets, starts, ends, rows, out


def _count_terms(p: Toxicity):
    schema = pa.schema([("term", pa.int64()), ("half", pa.int32()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", 2 << 20):
            *_, rows, terms = _terms(batch.column("text"), p)
            counts = np.diff(rows)
            row = np.tile(np.repeat(np.arange(batch.num_rows, dtype=np.uint64), counts), len(terms))
            flat = terms.ravel()
            once = np.unique(np.stack((flat, row))[:, flat != 0], axis=1)
            label = batch.column("toxic").to_numpy(zero_copy_only=False)[once[1].astype(np.int64)]
            half = batch.column("half").to_numpy(zero_copy_only=False)[once[1].astype(np.int64)]
            for side in (0, 1):
                mine = half == side
                term, place = np.unique(once[0][mine], return_inverse=True)
                toxic = np.bincount(place, weights=label[mine], minlength=len(term)).astype(np.int64)
                total = np.bincount(place, minlength=len(term))
                columns = [term.view(np.int64), np.full(len(term), side, np.int32), toxic, total - toxic]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _lexicon(counts: DataFrame, sizes: dict[tuple[int, int], int], halves: tuple[int, ...], p: Toxicity) -> dict[int, float]:
    """The terms that stand out in the toxic rows of ``halves``, with their log odds."""
    toxic, clean = (sum(sizes.get((half, label), 0) for half in halves) for label in (1, 0))
    sums = counts.where(F.col("half").isin(*halves)).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    odds = F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(clean + 1.0))
    deviation = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    found = sums.where(F.col("t") >= p.support).select("term", odds.alias("odds"), deviation.alias("deviation"))
    found = found.where(F.col("deviation") >= p.deviation).orderBy(F.desc("deviation"), "term").limit(p.lexicon)
    learned = {row.term: row.odds for row in found.collect()}  # at most ``p.lexicon`` rows
    seeds = W.word_hashes(pa.array([" ".join(INSULTS)]))[0].view(np.int64).tolist()
    return {**dict.fromkeys(seeds, 2.0), **learned}


class _Lookup:
    """Weights of hashed terms; a table of bits rules out nearly all other terms."""

    def __init__(self, weights: dict[int, float]) -> None:
        keys = np.array(sorted(weights), dtype=np.int64)
        self.weights = np.array([weights[int(k)] for k in keys])
        order = np.argsort(keys.view(np.uint64))
        self.keys, self.weights = keys.view(np.uint64)[order], self.weights[order]
        self.bits = np.zeros(1 << 18, dtype=bool)
        self.bits[self.keys >> np.uint64(46)] = True

    def __call__(self, terms: np.ndarray) -> np.ndarray:
        out = np.zeros(len(terms))
        maybe = np.flatnonzero(self.bits[terms >> np.uint64(46)])
        place = np.minimum(np.searchsorted(self.keys, terms[maybe]), len(self.keys) - 1)
        same = self.keys[place] == terms[maybe]
        out[maybe[same]] = self.weights[place[same]]
        return out


def _per_row(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return (total[edges[1:]] - total[edges[:-1]]).astype(np.float64)


def features(column: pa.Array, lookup: _Lookup, p: Toxicity) -> np.ndarray:
    """One row of dense features for each text."""
    data, offsets, starts, ends, rows, terms = _terms(column, p)
    n = np.diff(rows).astype(np.float64)
    words, size = np.maximum(n, 1), np.maximum(np.diff(offsets), 1)
    weight = np.zeros(len(starts))
    for one in terms:
        np.maximum(weight, lookup(one), out=weight)
    hit = weight > 0
    hits = _per_row(hit, rows)
    out = np.zeros((len(n), FEATURES))
    out[:, 0] = np.log1p(n)
    out[:, 1] = _per_row(weight, rows) / words
    out[:, 2] = hits / words
    out[:, 3] = np.log1p(hits)
    full = np.flatnonzero(np.diff(rows))
    if len(full):
        out[full, 4] = np.maximum.reduceat(weight, rows[:-1][full])
    out[:, 5] = _per_row(weight, rows) / np.maximum(hits, 1)
    persons = np.sort(W.word_hashes(pa.array([" ".join(SECOND_PERSON)]))[0])
    person = np.isin(terms[0], persons, kind="sort")
    place, spoken = np.flatnonzero(hit), np.flatnonzero(person)
    if len(place) and len(spoken):
        row = np.searchsorted(rows, np.arange(len(starts)), side="right")
        before = np.clip(np.searchsorted(spoken, place) - 1, 0, len(spoken) - 1)
        after = np.clip(np.searchsorted(spoken, place), 0, len(spoken) - 1)
        close = np.zeros(len(place), dtype=bool)
        for other in (before, after):
            close |= (np.abs(spoken[other] - place) <= p.near) & (row[spoken[other]] == row[place])
        out[:, 6] = np.bincount(row[place[close]] - 1, minlength=len(n))[: len(n)] / words
    out[:, 7] = _per_row(person, rows) / words
    letters = np.maximum(_per_row(LETTER[data], offsets), 1)
    out[:, 8] = _per_row(UPPER[data], offsets) / letters
    out[:, 9] = _per_row(EMPHASIS[data], offsets) / size
    if len(data) > 2:
        odd = np.zeros(len(data), dtype=bool)
        odd[1:-1] = OBFUSCATING[data[1:-1]] & LETTER[data[:-2]] & LETTER[data[2:]]
        out[:, 10] = _per_row(odd, offsets) / words
    out[:, 11] = _per_row(ends - starts, rows) / words
    return out


def _with_features(lexicons: list[dict[int, float]], p: Toxicity):
    """Adds ``features``; the column ``lexicon`` says which lexicon a row is measured with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = [_Lookup(weights) for weights in lexicons]
        for batch in W.slices(batches, "text", 4 << 20):
            which = batch.column("lexicon").to_numpy(zero_copy_only=False)
            found = np.zeros((batch.num_rows, FEATURES))
            for i in np.unique(which).tolist():
                mine = np.flatnonzero(which == i)
                found[mine] = features(batch.column("text").take(pa.array(mine)), lookups[i], p)
            lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, FEATURES, dtype=np.int32), found.ravel())
            kept = [(name, batch.column(name)) for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*[c for _, c in kept], lists], [*[n for n, _ in kept], "features"])

    return run


@dataclass(frozen=True)
class ToxicityModel:
    trees: boosted.BoostedModel
    lexicon: dict[int, float]
    parameters: Toxicity


def fit(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> ToxicityModel:
    """Learn from at most ``p.labelled`` of the labels whose rows are not held out.

    Of more labels, those with the least hash of their id are taken.
    """
    work = Workspace(docs.sparkSession, "toxicity")
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col("toxic").cast("double").alias("toxic"), F.xxhash64("doc_id").alias("draw"))
    known = F.broadcast(known.orderBy("draw", "doc_id", "toxic").limit(p.labelled))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id").select(
        "toxic", "text", F.pmod("draw", F.lit(2)).cast("int").alias("half"), F.pmod(F.shiftright("draw", 8), F.lit(4)).cast("int").alias("part")
    )
    rows = work.write(rows, "labelled")
    sizes = {(r.half, int(r.toxic)): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}
    counted = rows.select("text", "half", "toxic").mapInArrow(_count_terms(p), "term bigint, half int, toxic bigint, clean bigint")
    counts = work.write(counted.groupBy("term", "half").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "terms")
    lexicons = [_lexicon(counts, sizes, halves, p) for halves in ((1,), (0,), (0, 1))]
    measured = rows.withColumn("lexicon", F.col("half")).mapInArrow(
        _with_features(lexicons, p), "toxic double, half int, part int, lexicon int, features array<double>"
    )
    measured = work.write(measured.select("features", F.col("toxic").alias("label"), "part"), "features")
    return ToxicityModel(boosted.fit(measured), lexicons[2], p)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``row`` (the columns of ``docs`` as a struct) and its ``score``."""
    p = model.parameters
    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"), F.lit(0).alias("lexicon"))
    schema = packed.select("row", "lexicon", F.lit(None).cast("array<double>").alias("features")).schema
    return model.trees.score(packed.mapInArrow(_with_features([model.lexicon], p), schema)).select("row", "score")
