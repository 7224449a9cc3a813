"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases, each the shortest string from its place on that is not yet a phrase.
Texts with much in common share many phrases, as they would compress well together. The phrase set is
hashed and reduced to minimum hashes; the share of equal minima estimates the likeness of the sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapframe.llm.common import id_and_text, stored, text_chunks
from lapframe.llm.shingles import BLOCK, hash_spans, mix

HASHES = 64
_rng = np.random.default_rng(911)
_FACTOR = _rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, HASHES, np.uint64)
_NONE = np.full(HASHES, 0xFFFFFFFFFFFFFFFF, np.uint64)


def parse(text: str, start: int, seen: set[str], limit: int | None = None) -> list[int]:
    """Ends of the phrases from ``start`` on, which are added to ``seen``.

    With ``limit`` it stops before a phrase that would end beyond it. The set holds every prefix of
    its members, so the length of the longest known prefix is sought from a middle length up or down.
    A rest that is a known phrase ends the text and adds nothing new.
    """
    n, i, ends = len(text), start, []
    add = seen.add
    while i < n:
        j = i + 4
        if j <= n and text[i:j] in seen:
            j += 1
            while j <= n and text[i:j] in seen:
                j += 1
        else:
            j = min(j, n)
            while j > i + 1 and text[i : j - 1] not in seen:
                j -= 1
        # text[i:j] is the first unknown prefix, or the text is over
        j = min(j, n)
        if limit is not None and j > limit:
            break
        add(text[i:j])
        ends.append(j)
        i = j
    return ends


def _lowest(text: str, start: int, ends: list[int]) -> np.ndarray:
    """Minimum hashes of the phrases that end at ``ends``, the first of which begins at ``start``."""
    low = _NONE
    if not ends:
        return low
    stops = np.array(ends, np.int64)
    starts = np.concatenate([[start], stops[:-1]])
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + BLOCK, "right")))
        a, b = int(starts[i]), int(stops[j - 1])
        points = np.frombuffer(text[a:b].encode("utf-32-le"), np.uint32)
        hashes = hash_spans(points, starts[i:j] - a, stops[i:j] - a)
        for at in range(0, len(hashes), 512):
            low = np.minimum(low, (hashes[at : at + 512, None] * _FACTOR + _SHIFT).min(0))
        i = j
    return low


def _written(low: np.ndarray, empty: bool) -> str:
    """Sixteen bits of each minimum in hexadecimal; an empty text has the empty fingerprint."""
    return "" if empty else (mix(low) >> np.uint64(48)).astype(">u2").tobytes().hex()


def fingerprint(text: str) -> str:
    return _written(_lowest(text, 0, parse(text, 0, set())), not text)


def likeness(a: str, b: str) -> float:
    """Share of equal minima; two empty texts are alike, an empty and another are not."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint16) for s in (a, b))
    return float((x == y).mean())


@dataclass
class Parsed:
    """A text with its fingerprint, and its parse up to where its second half may be replaced."""

    doc_id: int | None
    text: str
    seen: set[str]
    at: int
    low: np.ndarray
    fingerprint: str

    @classmethod
    def of(cls, doc_id: int | None, text: str) -> Parsed:
        cut = len(text) - len(text) // 2
        seen: set[str] = set()
        ends = parse(text, 0, seen, cut)
        at = ends[-1] if ends else 0
        low = _lowest(text, 0, ends)
        rest = parse(text, at, seen.copy())
        return cls(doc_id, text, seen, at, low, _written(np.minimum(low, _lowest(text, at, rest)), not text))

    def edited(self, following: str) -> tuple[str, str]:
        """The text whose second half is the head of ``following``, and its fingerprint."""
        half = len(self.text) // 2
        new = self.text[: len(self.text) - half] + following[:half]
        rest = parse(new, self.at, self.seen)  # used once
        return new, _written(np.minimum(self.low, _lowest(new, self.at, rest)), not new)


_RESULT = "doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _row(doc: Parsed, following: Parsed) -> tuple:
    text, changed = doc.edited(following.text)
    sha = hashlib.sha256(text.encode("utf-8")).hexdigest()
    near = likeness(doc.fingerprint, changed), likeness(doc.fingerprint, following.fingerprint)
    return doc.doc_id, len(doc.text), sha, doc.fingerprint, changed, *near


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(id_type: pa.DataType) -> pa.Schema:
    kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.schema(list(zip(_NAMES, kinds, strict=True)))


# What a row of the first pass is: a result, or the text at the head or the foot of a range.
RESULT, HEAD, FOOT = 0, 1, 2


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses, one row per input row.

    The next document is that of the next lower ``doc_id``, after the last the first; NULL ids come
    last, and rows of one id follow a hash of their texts. NULL texts are empty. A single row is its
    own next; an empty table gives an empty result; other columns are not read.

    Texts are dealt once, by ranges of the id, and walked in order inside each range. Only the first
    and the last text of each range go through one task to meet their neighbours.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, previous, schema = TaskContext.get().partitionId(), None, None

        def edge(doc: Parsed, what: int) -> tuple:
            return (doc.doc_id, *[None] * 6, what, part, doc.text)

        for chunk, texts in text_chunks(batches):
            if schema is None:
                schema = _schema(chunk.column(0).type)
                for field in (pa.field("what", pa.int32()), pa.field("part", pa.int32()), pa.field("text", pa.string())):
                    schema = schema.append(field)
            out = []
            for key, text in zip(chunk.column(0).to_pylist(), texts, strict=True):
                doc = Parsed.of(key, text)
                out.append(edge(doc, HEAD) if previous is None else (*_row(previous, doc), RESULT, part, None))
                previous = doc
            yield _batch(out, schema)
        if previous is not None:
            yield _batch([edge(previous, FOOT)], schema)

    ordered = (
        id_and_text(docs)
        .repartitionByRange(F.col("doc_id").desc_nulls_last())
        .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    )
    first = stored(ordered.mapInArrow(walk, f"{_RESULT.format(kind=kind)}, what int, part int, text string"), "fingerprints")
    edges = first.filter(F.col("what") != RESULT)
    by_range = Window.orderBy("part", "what")
    head = F.first("text").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    meeting = (
        edges.withColumn("following", F.coalesce(F.lead("text").over(by_range), head))
        .filter(F.col("what") == FOOT)
        .select("doc_id", "text", "following")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(Parsed.of(a, b), Parsed.of(None, c)) for a, b, c in zip(*(x.to_pylist() for x in batch.columns), strict=True)]
            yield _batch(rows, _schema(batch.column(0).type))

    results = first.filter(F.col("what") == RESULT).select(*_NAMES)
    return results.union(meeting.mapInArrow(meet, _RESULT.format(kind=kind)))
