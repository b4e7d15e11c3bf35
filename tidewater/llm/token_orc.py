"""Token ids in ORC files, in the order of document ids.

Documents are range-partitioned by id, sorted and encoded in place, so that each file
holds a run of ids and a reader that wants one document opens one file. Integer columns
are run-length encoded by the format; row indexes and Bloom filters on ``doc_id`` let a
reader skip stripes and row groups, and stripes are read in parallel.

Columns: ``part`` (number of the file), ``before`` (ids ahead of the document in its
file), ``doc_id``, ``n_tokens`` and ``ids`` (with the end id).

Defined results: a null or empty text is the end id alone; a null id comes first; rows
that share an id follow one another in the order of a hash of the text, and equal rows
are written as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.tables import partitions, row_key
from tidewater.llm.words import slices
from tidewater.session import broadcast_if_small

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
# Pieces whose ids a task remembers, and their greatest length.
MEMO_PIECES, MEMO_LENGTH = 400_000, 48
WRITE_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(16 << 20),
}
FILE_SCHEMA = "part int, before bigint, doc_id bigint, n_tokens bigint, ids array<int>"

# How the pre-tokenizer cuts a text, for texts of ASCII and Latin letters.
# In those, the pieces can be told without the Unicode tables of the tokenizer.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
# Words come first, as nearly all pieces are words; no other part begins as they do.
_PIECE = re.compile(rf" ?[{_LETTERS}]++|'(?:s|t|re|ve|m|ll|d)| ?[0-9]++| ?[^\s{_LETTERS}0-9]++|\s+(?!\S)|\s+")
_PLAIN = re.compile(r"[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")
_WORD = re.compile(rf" [{_LETTERS}]+")
# In other texts a single space before a visible character starts a new piece all the same.
_CUT = re.compile(r"(?= [!-~]| \w)")


class Encoder:
    """Ids of texts through a tokenizer, remembering the ids of the pieces it cuts.

    Pieces are encoded independently of one another, so the ids of a text are those of its
    pieces. The first ``MEMO_PIECES`` pieces that a task meets are remembered; among them
    are nearly all frequent ones. The others are encoded once for every slice of texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.sizes = self._token_sizes()

    def _token_sizes(self) -> np.ndarray | None:
        """Bytes that each id stands for, if the tokenizer writes a byte as one character of its vocabulary."""
        if type(self.tokenizer.pre_tokenizer).__name__ != "ByteLevel" or self.tokenizer.normalizer is not None:
            return None
        vocabulary = self.tokenizer.get_vocab()
        sizes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            sizes[number] = len(token)
        return sizes

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(item.ids, dtype="<u4").tobytes() for item in encoded]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with their space: together they are one text of such words."""
        out: list[bytes] = []
        for at in range(0, len(words), 500):
            part = words[at : at + 500]
            cuts, ids = self._cuts(part)
            out += [ids[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return out

    def _cuts(self, words: list[str]) -> tuple[np.ndarray, bytes]:
        """Ids of the words as one text, and where those of each word begin and end."""
        text = "".join(words)
        if self.sizes is not None:
            # The bytes of the ids tell the words apart; offsets would cost as much as the ids.
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum([len(word.encode()) for word in words])
            last = np.searchsorted(ends, wanted)
            if len(ends) and ends[-1] == wanted[-1] and (ends[last] == wanted).all():
                return np.concatenate(([0], last + 1)), ids.tobytes()
        encoded = self.tokenizer.encode(text, add_special_tokens=False)
        starts = np.fromiter((start for start, _ in encoded.offsets), np.int64, len(encoded.ids))
        cuts = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(word) for word in words]))))
        return cuts, np.array(encoded.ids, dtype="<u4").tobytes()

    def _pieces(self, text: str) -> list[str] | None:
        """Parts of a text that are encoded independently; None if it holds a special token."""
        if any(token in text for token in self.special):
            return None
        return _PIECE.findall(text) if _PLAIN.fullmatch(text) else _CUT.split(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self._pieces(text) for text in texts]
        missing = set().union(*[pieces for pieces in cut if pieces]).difference(self.memo)
        words = [piece for piece in missing if _WORD.fullmatch(piece)]
        others = list(missing.difference(words))
        fresh = dict(zip(words, self._word_ids(words), strict=True))
        fresh.update(zip(others, self._ids(others), strict=True))
        kept, new = self.memo.get, fresh.__getitem__
        whole = iter(self._ids([text for text, pieces in zip(texts, cut, strict=True) if pieces is None]))
        out = [next(whole) if pieces is None else b"".join([kept(p) or new(p) for p in pieces]) for pieces in cut]
        for piece, ids in fresh.items():
            if len(self.memo) >= MEMO_PIECES:
                break
            if ids and len(piece) <= MEMO_LENGTH:
                self.memo[piece] = ids
        return out


@lru_cache(maxsize=1)
def _encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return Encoder(path)


def _encode(path: str | None):
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    schema = pa.schema(list(zip(("part", "before", "doc_id", "n_tokens", "ids"), types, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in slices(batches, "text", 4 << 20):
            texts = ["" if text is None else text for text in batch.column("text").to_pylist()]
            ids = [item + end for item in _encoder(path).encode(texts)]
            counts = np.array([len(item) // 4 for item in ids], dtype=np.int64)
            offsets = np.concatenate(([0], np.cumsum(counts)))
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            columns = [
                pa.array(np.full(len(ids), part, np.int32)),
                pa.array(before + offsets[:-1]),
                batch.column("doc_id"),
                pa.array(counts),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values),
            ]
            before += int(offsets[-1])
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, files: int | None = None) -> None:
    """Encode ``docs (doc_id, text)`` into ``files`` ORC files below ``path``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("rid", row_key("text"))
    ordered = rows.repartitionByRange(files or partitions(docs.sparkSession), "doc_id", "rid")
    ordered = ordered.sortWithinPartitions("doc_id", "rid").select("doc_id", "text")
    ordered.mapInArrow(_encode(tokenizer), FILE_SCHEMA).write.options(**WRITE_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files with ``start``, the number of ids of all documents before each one."""
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    # One short row per file; a join of such a table must not shuffle the ids.
    return files.join(broadcast_if_small(offsets), "part").withColumn("start", F.col("offset") + F.col("before")).drop("part", "before", "offset")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy() - ids.offsets[0].as_py() if len(ids) else []
        data = ids.flatten().to_numpy().astype("<i4").tobytes()
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        kept = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digest(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of documents as read back from the files."""
    read = tokens.select("doc_id", "start", "n_tokens", "ids")
    return read.mapInArrow(_checksums, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
