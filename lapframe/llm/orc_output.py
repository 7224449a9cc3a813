"""Token ids as ORC files: sorted by document, with row indexes and Bloom filters on the ids.

Documents are dealt by ranges of ``doc_id``, so files follow one another in ascending order. Within a
stripe ORC stores the ids with its integer run-length encoding; the row index and the Bloom filter of
``doc_id`` let a reader skip stripes and row groups, and stripes of one file are read in parallel.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapframe.llm.common import id_and_text, text_chunks

# Encoded words kept per Python worker, in each of two generations.
CACHE_WORDS = 5 << 17
# A longer word is encoded without being kept.
LONG_WORD = 64
# Trailing marks that are tokens of their own: no apostrophe, and nothing of a special token's name.
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
# Letters below this code point are letters, and have a lower case, in every Unicode version.
LATIN = 0x250

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}

_SCHEMA = "part int, doc_id {kind}, start_in_part bigint, n_tokens int, ids array<int>"


class _Known(dict):
    """Words with their ids; one that is not there is found by ``find`` and kept if it is short."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        super().__init__({"": b""})
        self.find = find

    def __missing__(self, word: str) -> bytes:
        ids = self.find(word)
        if len(word) <= LONG_WORD:
            self[word] = ids
        return ids


class WordEncoder:
    """Encodes texts word by word.

    The tokenizer drops white space and no merge, contraction or normal form reaches across it, so
    the ids of a text are those of its words in turn. Words are cut at spaces and line feeds alone;
    other white space is left to the tokenizer.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.merges = self.tokenizer.model
        self.young = _Known(self._found)
        self.old: dict[str, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        # how the vocabulary writes bytes: printable ones as themselves, others from 256 on, in order
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.written = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.int32).tobytes()

    def _found(self, word: str) -> bytes:
        """Latin letters with marks behind them, nearly all words, go to the library's merge model in two
        parts; normal form, splitting and all other words are left to the whole tokenizer."""
        known = self.old.get(word)
        if known is not None:
            return known
        core = word.rstrip(MARKS)
        tail = word[len(core) :]
        plain = core.isascii()
        if not core.isalpha() or not (plain or max(core) < chr(LATIN)) or (not plain and "İ" in core):
            return self._whole(word)
        core = core.lower() if plain else "".join(map(str.lower, core))
        ids = self.letters.get(core)
        if ids is None:
            text = core if plain else "".join(map(self.written.__getitem__, core.encode("utf-8")))
            ids = self.letters[core] = array("i", [t.id for t in self.merges.tokenize(text)]).tobytes()
        end = self.marks.get(tail)
        if end is None:
            end = self.marks[tail] = self._whole(tail)
        return ids + end

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = dict(self.young), _Known(self._found)
        if len(self.letters) > CACHE_WORDS:
            self.letters.clear()
        if len(self.marks) > CACHE_WORDS:
            self.marks = {"": b""}
        ids_of = self.young.__getitem__
        return [b"".join(map(ids_of, t.replace("\n", " ").split(" "))) for t in texts]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(shared: Broadcast) -> WordEncoder:
    definition = shared.value
    if definition not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[definition] = WordEncoder(definition)
    return _ENCODERS[definition]


def encoded_in_order(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2) -> DataFrame:
    """``part, doc_id, start_in_part, n_tokens, ids``, in ascending order of ``doc_id``.

    ``part`` numbers the ranges and ``start_in_part`` counts the ids before a document in its range.
    A NULL text is empty and has only the end id; NULL ids come first; rows of one ``doc_id`` stay
    together, ordered by a hash of their text. An empty table gives an empty result; other columns
    are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary: of fixed size
    end = b"" if end_id is None else np.array([end_id], np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, done = _encoder(shared), TaskContext.get().partitionId(), 0
        for chunk, texts in text_chunks(batches):
            ids = [x + end for x in encoder.encode(texts)]
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            ends = np.concatenate([[0], np.cumsum(counts)])
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)),
                    chunk.column(0),
                    pa.array(ends[:-1] + done),
                    pa.array(counts.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat),
                ],
                ["part", "doc_id", "start_in_part", "n_tokens", "ids"],
            )
            done += int(ends[-1])

    kind = dict(docs.dtypes)["doc_id"]
    ordered = (
        id_and_text(docs)
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    return ordered.mapInArrow(run, _SCHEMA.format(kind=kind))


def write_token_ids(docs: DataFrame, tokenizer_path: str, path: str, end_id: int | None = 2, **options: str) -> None:
    """Encode ``docs`` and write the ORC files; ``options`` go to the ORC writer."""
    encoded_in_order(docs, tokenizer_path, end_id).write.options(**{**ORC_OPTIONS, **options}).orc(path)


def read_token_ids(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None, kind: str = "bigint") -> DataFrame:
    """The written rows; with ``doc_ids`` the scan skips stripes and row groups by index and Bloom filter."""
    rows = spark.read.schema(_SCHEMA.format(kind=kind)).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(list(doc_ids)))


def document_index(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the files.

    Only one row per range is summed up in a single task.
    """
    rows = read_token_ids(spark, path, kind=kind)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy("part")
        .agg(F.max(F.col("start_in_part") + F.col("n_tokens")).alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            counts = ids.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(counts)])
            flat = memoryview(ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
            )

    summed = rows.select("part", "doc_id", "start_in_part", "ids").mapInArrow(
        checksums, f"part int, doc_id {kind}, start_in_part bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return summed.join(bases, "part").select(
        "doc_id", (F.col("start_in_part") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )
