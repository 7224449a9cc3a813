"""Language-model scores: a word-count baseline over the corpus, and a causal attention model.

Every text is encoded into subwords once; the ids are stored and all later passes read them. A word is
the run of ids from one that begins with a space up to the next. The training documents are gone
through three times, in whole: words, by 64-bit hash of their ids, and subwords are counted; then the
neighbours of subwords, from which their classes come; then the model is trained. The last pass scores
every text. Frequent words are looked up in a table of bounded size that every task has; the others
are joined with the counts.

Training: one network is made on the driver, as a common start, from a bounded number of texts. Groups of
documents each go on from it over all their windows, and the networks are averaged by the number of
windows.

The model's probability of a word mixes the attention model's, the product over its subwords, with
the word's share of the corpus.
"""

from __future__ import annotations

from base64 import b64decode
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.llm import attention, bpe
from lapframe.llm.attention import Adam, Model, Vocabulary
from lapframe.llm.bpe import Encoder, encoder_of, share_ranks
from lapframe.llm.common import forget, id_and_text, id_fold, stored
from lapframe.llm.shingles import limited, lowered_bytes, span_hashes

# Words with counts in every task; the others are joined.
HEAD_WORDS = 1 << 18
# Texts, and subwords, of the common start of training.
START_DOCS = 2_000
START_TOKENS = 2_000_000
# Subwords that one network is trained on; there are as many networks as it takes.
GROUP_TOKENS = 4_000_000
# Subwords handled at once; a longer text is handled alone.
PIECE = 1 << 19
# Windows scored at once.
BATCH = 128
# Words whose subwords are kept per Python worker, in each of two generations.
CACHE_WORDS = 1 << 18
# Rows per Arrow batch of ids, which take four bytes a subword on both sides.
BATCH_ROWS = 500
SMOOTHING = 0.1
# Weight of the attention model; the corpus shares of words have the rest.
ATTENTION = 0.5


class Subwords:
    """Subword ids of words by a rank file."""

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.end = np.int32(len(encoder.tokens)).tobytes()  # the id after the last stands for the end of a text
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def of(self, words: set[bytes]) -> dict[bytes, bytes]:
        """A dictionary with the ids of at least these words; a word is encoded with a space before it."""
        missing = [w for w in words if w not in self.young]
        if len(self.young) + len(missing) > CACHE_WORDS:
            self.old, self.young, missing = self.young, {}, list(words)
        young, old, new = self.young, self.old, []
        for w in missing:
            if w in old:
                young[w] = old[w]
            else:
                new.append(w)
        whole, counts, _, _ = self.encoder.encode([" " + w.decode("utf-8") for w in new])
        cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
        for w, a, b in zip(new, cuts[:-1], cuts[1:], strict=True):
            young[w] = whole[a:b].tobytes()
        return young


_SUBWORDS: dict[str, Subwords] = {}


def _subwords(key: str, shared: Broadcast) -> Subwords:
    if key not in _SUBWORDS:
        _SUBWORDS.clear()
        _SUBWORDS[key] = Subwords(encoder_of(key, shared))
    return _SUBWORDS[key]


def _release() -> None:
    """Drop what encoding keeps in a Python worker; later passes use the same workers."""
    _SUBWORDS.clear()
    bpe._ENCODERS.clear()


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of few rows for the jobs run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def encoded(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, ids`` of all rows, the ids of each text with an end after it; stored."""
    key, shared = share_ranks(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = _subwords(key, shared)
        for batch in batches:
            for part in limited(batch):
                data, bounds = lowered_bytes(part.column(1))
                # bytes are split at the same six blanks
                texts = [data[a:b].tobytes().split() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                of = subwords.of(set(chain.from_iterable(texts)))
                texts = [b"".join([of[w] for w in words]) + subwords.end for words in texts]
                cuts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in texts])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(b"".join(texts), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return stored(id_and_text(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>"), "lm-ids")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """First columns, ids and numbers of ids of slices of about ``PIECE`` ids."""
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + PIECE, "right")))
            yield batch.column(0).slice(start, stop - start), column.slice(start, stop - start).flatten().to_numpy(), sizes[start:stop]
            start = stop


def _word_starts(ranks_path: str) -> np.ndarray:
    """Which ids begin a word or are the end of a text, which is the last id."""
    with open(ranks_path, "rb") as f:
        encoder = {int(rank): token for token, rank in map(bytes.split, f)}
    starts = np.zeros(max(encoder, default=-1) + 2, bool)
    starts[-1] = True
    for rank, token in encoder.items():
        starts[rank] = b64decode(token).startswith(b" ")
    return starts


def _words(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words and ends begin, which of these are ends, and the hashes of the others."""
    at = np.flatnonzero(starts[ids])
    is_end = ids[at] == len(starts) - 1
    stop = np.append(at[1:], len(ids))
    return at, is_end, span_hashes(ids, at[~is_end], stop[~is_end]).astype(np.int64)


@dataclass(frozen=True)
class Corpus:
    """Counts over all training documents: words by hash (stored), ends, tokens, distinct tokens, subwords."""

    words: DataFrame
    ends: int
    tokens: int
    distinct: int
    subwords: np.ndarray


def training(ids: DataFrame) -> DataFrame:
    """The encoded documents outside fold 0 of 10."""
    return ids.filter(id_fold(10) != 0)


def count_corpus(ids: DataFrame, starts: np.ndarray) -> Corpus:
    """Count words and subwords of all encoded training documents, every one in whole.

    Tasks send one row per distinct word and a row per subword id; words are never brought to the
    driver, of subwords as many rows as the vocabulary has ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        sums, held, held_size = np.zeros(len(starts), np.int64), [], 0

        def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            kinds = pa.array(np.full(len(keys), kind, np.int32))
            return pa.RecordBatch.from_arrays([kinds, pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

        for _, tokens, _ in _pieces(batches):
            sums += np.bincount(tokens, minlength=len(starts))
            held.append(_words(tokens, starts)[2])
            held_size += len(held[-1])
            if held_size >= 2_000_000:
                yield rows(0, *np.unique(np.concatenate(held), return_counts=True))
                held, held_size = [], 0
        if held_size:
            yield rows(0, *np.unique(np.concatenate(held), return_counts=True))
        at = np.flatnonzero(sums)
        yield rows(1, at, sums[at])

    counted = training(ids).mapInArrow(run, "kind int, key bigint, n bigint")
    summed = stored(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    subwords = np.zeros(len(starts), np.float64)
    for r in summed.filter("kind = 1").collect():
        subwords[r["key"]] = r["n"]
    words = summed.filter("kind = 0").select(F.col("key").alias("word"), "n")
    n, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = int(subwords[-1])
    return Corpus(words, ends, int(n) + ends, distinct + (ends > 0), subwords)


def learn_classes(ids: DataFrame, corpus: Corpus) -> Vocabulary:
    """Classes of subwords by their neighbours in all training documents.

    The counts that reach the driver are bounded by the vocabulary times the neighbours told apart.
    """
    _, rank = attention.by_frequency(corpus.subwords)
    size = len(rank) * 2 * attention.NEAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        sums = np.zeros(size, np.int32)
        for _, tokens, lengths in _pieces(batches):
            for found in attention.neighbours(rank, tokens, lengths):
                keys, n = np.unique(found, return_counts=True)
                sums[keys] += n.astype(np.int32)
        at = np.flatnonzero(sums)
        for i in range(0, len(at), 1 << 16):
            keys = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(sums[keys].astype(np.int64))], ["key", "n"])

    counted = training(ids).mapInArrow(run, "key int, n bigint").groupBy("key").agg(F.sum("n").cast("float").alias("n")).toArrow()
    seen = np.zeros(size, np.float32)
    seen[counted["key"].to_numpy()] = counted["n"].to_numpy()
    return attention.classed(corpus.subwords, seen.reshape(len(rank), -1), SMOOTHING)


def train(ids: DataFrame, corpus: Corpus, voc: Vocabulary, start_docs: int = START_DOCS, group_tokens: int = GROUP_TOKENS) -> Model:
    """The network after all windows of all training documents.

    Documents are put into groups by a hash of their id, so the result does not follow from how the
    table is split. One row per parameter and group is summed; the parameters reach the driver.
    """
    chosen = training(ids).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(start_docs)
    first = training(ids).join(F.broadcast(chosen), "doc_id", "left_semi").limit(start_docs).toArrow().sort_by("doc_id")  # at most start_docs ids
    texts, size = [], 0
    for x in first["ids"].combine_chunks():
        tokens = np.asarray(x.values)[: max(0, START_TOKENS - size)]
        if len(tokens):
            texts.append(tokens)
            size += len(tokens)
    if not texts:
        return Model()
    given, wanted, _ = attention.windows(np.concatenate(texts), np.array([len(x) for x in texts]), voc)
    start = attention.train(given, wanted, voc.pad).flat()
    shared = ids.sparkSession.sparkContext.broadcast((start, voc))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        start, voc = shared.value
        adam, seen = Adam(Model.unflat(start)), 0
        for _, tokens, lengths in _pieces(batches):
            given, wanted, _ = attention.windows(tokens, lengths, voc)
            attention.train_on(adam, given, wanted, voc.pad)
            seen += len(given)
        if seen:
            values = np.append(adam.model.flat().astype(np.float64) * seen, seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["place", "value"])

    groups = -(-int(corpus.subwords.sum()) // group_tokens)
    placed = training(ids).repartition(groups, "doc_id").sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("ids"))
    sums = placed.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow().sort_by("place")
    values = sums["value"].to_numpy()
    return Model.unflat(values[:-1] / values[-1])


def token_scores(model: Model, voc: Vocabulary, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each token of the sequences: the class's from the model, the share from the counts."""
    given, wanted, _ = attention.windows(tokens, lengths, voc)
    tables = model.tables()
    per_place = np.concatenate([model.log10_probabilities(given[i : i + BATCH], wanted[i : i + BATCH], voc.pad, tables) for i in range(0, len(given), BATCH)])
    return per_place[wanted >= 0] + voc.share[tokens]


def mixed(attended: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """log10 of the mixture of two log10 probabilities."""
    a, b = attended + np.log10(ATTENTION), shares + np.log10(1 - ATTENTION)
    top = np.maximum(a, b)
    return top + np.log10(10 ** (a - top) + 10 ** (b - top))


def score(docs: DataFrame, ranks_path: str, head_words: int = HEAD_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    A NULL or empty text is its end alone. NULL ids count as held out; repeated rows count as often as
    they occur. An empty table gives an empty result; other columns are not read.
    """
    with _small_batches(docs.sparkSession):
        return _scored(docs, ranks_path, head_words)


def _scored(docs: DataFrame, ranks_path: str, head_words: int) -> DataFrame:
    ids, starts = encoded(docs, ranks_path), _word_starts(ranks_path)
    corpus = count_corpus(ids, starts)
    voc = learn_classes(ids, corpus)
    model = train(ids, corpus, voc)
    # at most head_words rows reach the driver
    top = corpus.words.orderBy(F.col("n").desc(), "word").limit(head_words).toArrow()
    order = np.argsort(top["word"].to_numpy())
    spark, floor = docs.sparkSession, corpus.tokens + SMOOTHING * (corpus.distinct + 1)
    known = spark.sparkContext.broadcast((top["word"].to_numpy()[order], top["n"].to_numpy()[order].astype(np.float64), model, voc))
    end_score = float(np.log10((corpus.ends + SMOOTHING) / floor))
    end_known = int(corpus.ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        words, counts, model, voc = known.value
        serial = TaskContext.get().partitionId() << 40
        for keys, tokens, lengths in _pieces(batches):
            at, is_end, hashes = _words(tokens, starts)
            n = len(lengths)
            per_text = np.diff(np.flatnonzero(is_end), prepend=-1) - 1
            unique, where = np.unique(hashes, return_inverse=True)
            place = np.minimum(np.searchsorted(words, unique), max(0, len(words) - 1))
            hit = words[place] == unique if len(words) else np.zeros(len(unique), bool)
            logs = np.zeros(len(unique))
            logs[hit] = np.log10((counts[place[hit]] + SMOOTHING) / floor)
            owner = np.repeat(np.arange(n), per_text)
            hits = hit[where]
            base = np.bincount(owner, logs[where], n) + end_score
            attended = np.add.reduceat(token_scores(model, voc, tokens, lengths), at)
            of_words = attended[~is_end]
            scores = np.bincount(owner[hits], mixed(of_words[hits], logs[where][hits]), n) + mixed(attended[is_end], np.full(n, end_score))
            # words without a count here
            rest = np.flatnonzero(~hits)
            cuts = np.searchsorted(owner[rest], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(serial + np.arange(n)),
                    keys,
                    pa.array(per_text + 1),
                    pa.array(np.bincount(owner, hits, n).astype(np.int64) + end_known),
                    pa.array(base),
                    pa.array(scores),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(unique[where[rest]])),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(of_words[rest])),
                ],
                ["serial", "doc_id", "n_tokens", "n_head", "base", "score", "words", "attended"],
            )
            serial += n

    kind = dict(docs.dtypes)["doc_id"]
    read = stored(
        ids.mapInArrow(
            run, f"serial bigint, doc_id {kind}, n_tokens bigint, n_head bigint, base double, score double, words array<bigint>, attended array<double>"
        ),
        "lm-read",
    )
    forget(ids)
    tail = read.select("serial", F.explode(F.arrays_zip("words", "attended")).alias("w")).select("serial", F.col("w.words").alias("word"), F.col("w.attended").alias("attended"))
    count = F.coalesce(F.col("n"), F.lit(0))
    share = (count + SMOOTHING) / floor
    rare = (
        tail.join(corpus.words, "word", "left")
        .groupBy("serial")
        .agg(
            F.sum(F.log10(share)).alias("rare_base"),
            F.sum(F.log10(ATTENTION * F.pow(F.lit(10.0), F.col("attended")) + (1 - ATTENTION) * share)).alias("rare_score"),
            F.sum((count > 0).cast("bigint")).alias("rare_known"),
        )
    )
    return read.join(rare, "serial", "left").select(
        "doc_id",
        (id_fold(10) == 0).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
