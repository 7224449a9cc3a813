"""Ranked lexical search with pair-bound MaxScore over shards of documents.

The index holds, for each shard of some thousand documents, the postings of the terms that a set of
queries uses, with integer impacts, and for neighbouring terms of a query (by weight) their
intersection: its joint maximum impact and, where it is short, its documents. The index is built in two
passes: terms are counted in the texts, and impacts and pairs follow once the corpus statistics are known.

A query meets each shard with its threshold, the k-th best score so far. Its terms are combined into
pairs where that lowers the bound most (a matching on the path of neighbours). A pair's bound is the
larger of the joint maximum and the two single maxima; documents of a short list become candidates by
themselves, and then the joint maximum counts for no other document. The units of least bound that
together stay below the threshold open no candidates; candidates are dropped as soon as what is left
cannot lift them to it. Bounds decide only what is skipped: scores are exact, in 64-bit integers.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapframe.llm.common import byte_pieces, id_and_text, stored, text_chunks

TOP_K = 50
# A shard is closed at so many documents or postings, so its size does not depend on the input.
SHARD_DOCS = 8_192
SHARD_POSTINGS = 4_000_000
# A pair's documents are listed if they are at most this part of the shard; its joint maximum always is.
LIST_PART = 64
# Text of queries that one pass serves; more queries are worked off in blocks.
QUERY_CHARS = 4_000_000
# Shards that are searched first for thresholds.
SEED_SHARDS = 4

_DELIMITERS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(65, 91))
_FOLDED = bytes.maketrans(_DELIMITERS + _UPPER, b" " * len(_DELIMITERS) + _UPPER.lower())


def count_terms(text: str) -> Counter[bytes]:
    """Occurrences of each term of a whole text; only A-Z is folded. Long texts are cut at delimiters."""
    counts: Counter[bytes] = Counter()
    for piece in byte_pieces(text.encode("utf-8")):
        counts.update(piece.translate(_FOLDED).split())
    return counts


@dataclass(frozen=True)
class Queries:
    """Some queries: their ids, their terms as numbers, and the numbers of all terms."""

    ids: list[Any]
    terms: list[list[int]]
    numbers: dict[bytes, int]


def numbered_queries(ids: Sequence[Any], texts: Sequence[str]) -> Queries:
    numbers: dict[bytes, int] = {}
    terms = [[numbers.setdefault(t, len(numbers)) for t in sorted(count_terms(x))] for x in texts]
    return Queries(list(ids), terms, numbers)


@dataclass(frozen=True)
class Index:
    """``rows``: by shard, documents (``term`` -1), postings and pairs (``other`` from 0); ``weights`` by term."""

    rows: DataFrame
    weights: np.ndarray
    pairs: list[tuple[int, int]]


_POSTINGS = "shard bigint, term int, docs array<bigint>, counts array<bigint>"
_ROWS = "shard bigint, term int, other int, docs array<bigint>, impacts array<bigint>, top bigint, listed boolean"


def _list_array(parts: Sequence[Any]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate([np.asarray(p, np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def postings(docs: DataFrame, queries: Queries) -> DataFrame:
    """``shard, term, docs, counts``: local numbers of the documents with a term and its occurrences.

    A shard's row with ``term`` -1 holds the lengths of its documents in terms, and in ``docs`` their
    ids (one more such row, ``term`` -2, marks NULL ids).
    """
    numbers = queries.numbers

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shards = TaskContext.get().partitionId(), 0
        ids: list[Any] = []
        lengths, size = array("q"), 0
        found: dict[int, tuple[array, array]] = {}

        def closed() -> Iterator[pa.RecordBatch]:
            shard = part << 32 | shards
            rows: list[tuple[int, Any, Any]] = [(-2, [i for i, x in enumerate(ids) if x is None], []), (-1, [x or 0 for x in ids], lengths)]
            rows += [(term, *lists) for term, lists in sorted(found.items())]
            for at in range(0, len(rows), 2000):
                terms, docs_, counts = zip(*rows[at : at + 2000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(terms), shard, np.int64)), pa.array(terms, pa.int32()), _list_array(docs_), _list_array(counts)],
                    ["shard", "term", "docs", "counts"],
                )

        for batch, texts in text_chunks(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                counts = count_terms(text)
                at = len(ids)
                ids.append(doc_id)
                lengths.append(sum(counts.values()))
                for term in counts.keys() & numbers.keys():
                    number = numbers[term]
                    lists = found.get(number)
                    if lists is None:
                        lists = found[number] = (array("q"), array("q"))
                    lists[0].append(at)
                    lists[1].append(counts[term])
                    size += 1
                if len(ids) >= SHARD_DOCS or size >= SHARD_POSTINGS:
                    yield from closed()
                    shards += 1
                    ids, lengths, size, found = [], array("q"), 0, {}
        if ids:
            yield from closed()

    return id_and_text(docs).mapInArrow(counted, _POSTINGS)


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    flat = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of one shard after the other; columns of lists come as arrays."""
    rows: list[tuple] = []
    for batch in batches:
        columns = [_lists(c) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if rows and rows[0][0] != row[0]:
                yield rows[0][0], rows
                rows = []
            rows.append(row)
    if rows:
        yield rows[0][0], rows


def _shards_together(rows: DataFrame) -> DataFrame:
    return rows.repartition("shard").sortWithinPartitions("shard", "term")


def build_index(docs: DataFrame, queries: Queries) -> Index:
    """Postings of all ``docs`` for the terms of ``queries``, with pairs of neighbouring terms of a query.

    Texts are read once, whole. NULL texts have no terms. What reaches the driver is one number per term
    of the queries and two of the corpus.
    """
    counted = stored(postings(docs, queries), "search-postings")
    totals = counted.filter("term = -1").agg(
        F.sum(F.size(F.filter("counts", lambda n: n > 0))).alias("n"),
        F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("l"),
    )
    n_docs, n_terms = (int(x or 0) for x in totals.first())
    df = np.zeros(len(queries.numbers), np.int64)
    for term, count in counted.filter("term >= 0").groupBy("term").agg(F.sum(F.size("docs"))).collect():
        df[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    # neighbours by weight: pairs of rare terms have short intersections, pairs of common ones low joint maxima
    known = [_ordered([t for t in terms if df[t]], weights) for terms in queries.terms]
    pairs = sorted({(min(p), max(p)) for terms in known for p in zip(terms, terms[1:])})

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            by_term = {term: (ids, counts) for _, term, ids, counts in rows}
            ids, lengths = by_term.pop(-1)
            nulls = by_term.pop(-2)[0]
            # of 64-bit integers; the floor division rounds down
            m = 50 + 50 * lengths * n_docs // max(n_terms, 1)
            out: list[tuple[Any, ...]] = [(-2, -1, nulls, [], 0, True), (-1, -1, ids, [], 0, True)]
            impacts: dict[int, np.ndarray] = {}
            for term, (where, tf) in by_term.items():
                impacts[term] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[where]))
                out.append((term, -1, where, impacts[term], int(impacts[term].max()), True))
            score = np.zeros(len(ids), np.int64)
            for a, b in pairs:
                if a in impacts and b in impacts:
                    short, long = (a, b) if len(impacts[a]) <= len(impacts[b]) else (b, a)
                    score[by_term[long][0]] = impacts[long]
                    there = score[by_term[short][0]]
                    both = there > 0
                    if both.any():
                        where = by_term[short][0][both]
                        listed = len(where) * LIST_PART <= len(ids)
                        out.append((a, b, where if listed else [], [], int((there + impacts[short])[both].max()), listed))
                    score[by_term[long][0]] = 0
            for at in range(0, len(out), 2000):
                terms, others, where, imp, tops, listed = zip(*out[at : at + 2000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(terms), shard, np.int64)), pa.array(terms, pa.int32()), pa.array(others, pa.int32()), _list_array(where), _list_array(imp), pa.array(tops, pa.int64()), pa.array(listed)],
                    ["shard", "term", "other", "docs", "impacts", "top", "listed"],
                )

    return Index(stored(_shards_together(counted).mapInArrow(weighed, _ROWS), "search-index"), weights, pairs)


def _ordered(terms: Sequence[int], weights: np.ndarray) -> list[int]:
    """Terms by falling weight, those of no document first."""
    return sorted(terms, key=lambda t: (-int(weights[t]), t))


@dataclass
class Shard:
    """A shard's part of the index. ``pairs``: joint maximum, and the documents if they are listed."""

    ids: np.ndarray
    nulls: np.ndarray
    docs: dict[int, np.ndarray] = field(default_factory=dict)
    impacts: dict[int, np.ndarray] = field(default_factory=dict)
    tops: dict[int, int] = field(default_factory=dict)
    pairs: dict[tuple[int, int], tuple[int, np.ndarray | None]] = field(default_factory=dict)


def _loaded(rows: list[tuple]) -> Shard:
    shard = Shard(np.zeros(0, np.int64), np.zeros(0, bool))
    marked = np.zeros(0, np.int64)
    for _, term, other, docs, impacts, top, listed in rows:
        if term == -1:
            shard.ids = docs
        elif term == -2:
            marked = docs
        elif other < 0:
            shard.docs[term], shard.impacts[term], shard.tops[term] = docs, impacts, top
        else:
            shard.pairs[term, other] = (top, docs if listed else None)
    shard.nulls = np.zeros(len(shard.ids), bool)
    shard.nulls[marked] = True
    return shard


@dataclass(frozen=True)
class Unit:
    """One or two terms: a bound for any document, one for documents that are not listed, and the list."""

    terms: tuple[int, ...]
    bound: int
    rest: int
    listed: np.ndarray | None = None


def units(terms: Sequence[int], shard: Shard) -> list[Unit]:
    """The terms in the order of weight, combined into the neighbouring pairs that lower the bounds most."""
    here = [t for t in terms if t in shard.docs]

    def pair(a: int, b: int) -> Unit:
        single = max(shard.tops[a], shard.tops[b])
        joint, listed = shard.pairs.get((min(a, b), max(a, b)), (0, None))
        return Unit((a, b), max(joint, single), single if listed is not None else max(joint, single), listed)

    # neighbours in the whole query only: for others no intersection was taken
    places = {t: i for i, t in enumerate(terms)}
    best: list[tuple[int, list[Unit]]] = [(0, [])]
    for i, t in enumerate(here):
        gain, chosen = best[i]
        options = [(gain, [*chosen, Unit((t,), shard.tops[t], shard.tops[t])])]
        if i and places[t] == places[here[i - 1]] + 1:
            u = pair(here[i - 1], t)
            options.append((best[i - 1][0] + shard.tops[t] + shard.tops[here[i - 1]] - u.rest, [*best[i - 1][1], u]))
        best.append(max(options, key=lambda o: o[0]))
    return best[-1][1]


def best_of_shard(terms: Sequence[int], shard: Shard, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Local numbers and exact scores of all documents of the shard that score at least ``threshold``."""
    parts = sorted(units(terms, shard), key=lambda u: (u.rest, u.terms))
    below, skipped = 0, 0
    for u in parts:
        if below + u.rest >= threshold:
            break
        below += u.rest
        skipped += 1
    score = np.zeros(len(shard.ids), np.int64)
    for u in parts[skipped:]:
        for t in u.terms:
            score[shard.docs[t]] += shard.impacts[t]
    lists = [u.listed for u in parts[:skipped] if u.listed is not None]
    seen = score > 0
    for listed in lists:
        seen[listed] = True
    left = sum(u.bound for u in parts[:skipped])
    at = np.flatnonzero(seen)
    for u in sorted(parts[:skipped], key=lambda u: -u.bound):
        at = at[score[at] + left >= threshold]
        if not len(at):
            break
        left -= u.bound
        for t in u.terms:
            docs = shard.docs[t]
            place = np.searchsorted(docs, at)
            place[place == len(docs)] = 0
            match = docs[place] == at
            score[at[match]] += shard.impacts[t][place[match]]
    at = at[score[at] >= max(threshold, 1)]
    return at, score[at]


def _search(index: Index, queries: Queries, k: int, rows: DataFrame, thresholds: list[int], kind: str) -> DataFrame:
    ordered = [_ordered(t, index.weights) for t in queries.terms]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = list(thresholds)
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * len(ordered)
        for _, part in _by_shard(batches):
            shard = _loaded(part)
            for q, terms in enumerate(ordered):
                at, score = best_of_shard(terms, shard, least[q])
                if not len(at):
                    continue
                found = (score, shard.nulls[at], shard.ids[at])
                if best[q] is not None:
                    found = tuple(np.concatenate(x) for x in zip(best[q], found, strict=True))
                if len(found[0]) > k:
                    order = np.lexsort((found[2], found[1], -found[0]))[:k]
                    found = tuple(x[order] for x in found)
                best[q] = found
                if len(found[0]) == k:
                    least[q] = max(least[q], int(found[0].min()))
        for q, found in enumerate(best):
            if found is not None:
                score, null, ids = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), q, np.int32)), pa.array(ids, mask=null), pa.array(score)], ["query", "doc_id", "score"]
                )

    return rows.mapInArrow(searched, f"query int, doc_id {kind}, score bigint")


def search(index: Index, queries: Queries, k: int = TOP_K, kind: str = "bigint") -> DataFrame:
    """``query, rank, doc_id, score``: the best ``k`` documents of each query by its number.

    First a few shards are searched: their k-th best scores are lower bounds of the final ones, so all
    tasks start with them. This changes what is skipped, not what is found.
    """
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    n = len(queries.ids)
    seeds = [r.shard for r in index.rows.filter("term = -1").select("shard").orderBy(F.xxhash64("shard"), "shard").limit(SEED_SHARDS).collect()]
    first = _search(index, queries, k, _shards_together(index.rows.filter(F.col("shard").isin(seeds))), [0] * n, kind) if seeds else None
    thresholds = [0] * n
    if first is not None:
        ranked = first.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") == k)
        for r in ranked.select("query", "score").collect():  # at most one row a query
            thresholds[r["query"]] = r["score"]
    found = _search(index, queries, k, _shards_together(index.rows), thresholds, kind)
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``k`` best documents with a score above 0.

    ``doc_id`` is of an integer type. ``items`` has ``item_id, text``; equal rows are one item, and an id with several texts has a ranking
    for each. NULL texts have no terms, so such items have no rows and such documents no rank. Equal
    scores are ordered by doc_id, NULL last; repeated document rows are ranked one by one. Only these columns
    are read. Empty tables give an empty result.
    """
    kind, id_kind = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType
    wanted = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    chars = wanted.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = chars // QUERY_CHARS + 1
    out = None
    for block in range(blocks):
        rows = wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        queries = numbered_queries([r.item_id for r in rows], [r.text for r in rows])
        found = search(build_index(docs, queries), queries, k, kind)
        ids = docs.sparkSession.createDataFrame([(i, x) for i, x in enumerate(queries.ids)], f"query int, item_id {id_kind.simpleString()}")
        named = found.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")  # one row a query of the block
        out = named if out is None else out.unionByName(named)
    return out
