"""Byte-level BPE: encode whole texts by a public rank file and decode the ids again.

Pre-tokenisation uses no regular expression. Every code point gets a class (letter, number, blank,
other, with what follows folded in where the split depends on it); each class is a function from
automaton state to automaton state. Function composition is associative, so the states of all
positions of a batch come from a blocked scan: compose inside blocks, scan over the blocks, then
run all blocks side by side. State and class tell where a piece begins. The slices go through a
cache of merged pieces.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.llm.common import id_and_text, text_chunks

# White space of the split pattern, and its contractions.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SHORT = ("s", "t", "m", "d")
LONG = ("re", "ve", "ll")

# Merged pieces kept per Python worker, in each of two generations: when the young one is full, it
# becomes the old one, and pieces in use move over.
CACHE_PIECES = 3 << 17
# Pieces of more bytes are merged with a heap.
LONG_PIECE = 64

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
# Classes with what follows: blank before a blank or the end, last space, last other blank,
# letter, number, other, apostrophe of a two- or three-character contraction.
C_INNER, C_SPACE, C_BLANK, C_LETTER, C_NUMBER, C_OTHER, C_SHORT, C_LONG = range(8)
CLASSES = 8
# What the position before belongs to.
S_START, S_LETTER, S_NUMBER, S_OTHER, S_INNER, S_SPACE, S_BLANK, S_TWO_LEFT, S_ONE_LEFT, S_DONE = range(10)
STATES = 10


def code_point_kinds() -> np.ndarray:
    """Letter, number, blank or other for every code point, by the Unicode version of tiktoken.

    Python's own tables may be of another version; the library is asked once, on the driver.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    kind = np.zeros(0x110000, np.uint8)
    for value, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        ask = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = ask.decode_bytes(ask.encode_ordinary(every)).decode("utf-8")
        kind[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = value
    kind[list(SPACES)] = BLANK
    kind[0x20] = SPACE
    return kind


def _step(state: int, cls: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins at this position."""
    if cls == C_INNER:
        return S_INNER, state != S_INNER
    if cls in (C_SPACE, C_BLANK):
        return (S_SPACE if cls == C_SPACE else S_BLANK), True
    if cls == C_LETTER and state in (S_TWO_LEFT, S_ONE_LEFT):
        return (S_ONE_LEFT if state == S_TWO_LEFT else S_DONE), False
    if cls in (C_SHORT, C_LONG) and state not in (S_SPACE, S_OTHER):
        return (S_ONE_LEFT if cls == C_SHORT else S_TWO_LEFT), True
    run = {C_LETTER: S_LETTER, C_NUMBER: S_NUMBER}.get(cls, S_OTHER)
    return run, state not in (run, S_SPACE)


class Splitter:
    """Piece boundaries of concatenated texts by an associative scan of transition functions."""

    def __init__(self, kind: np.ndarray) -> None:
        self.kind = kind
        # the first position of a text starts anew: classes 8 to 15 ignore the state before
        steps = [[_step(S_START if c >= CLASSES else s, c % CLASSES) for c in range(2 * CLASSES)] for s in range(STATES)]
        self.next = np.array([[n for n, _ in row] for row in steps], np.uint8).ravel()
        self.begins = np.array([[b for _, b in row] for row in steps], bool).ravel()
        table = self.next.reshape(STATES, -1)
        functions = {tuple(range(STATES)): 0}
        queue = [tuple(range(STATES))]
        of_class = [tuple(int(x) for x in table[:, c]) for c in range(2 * CLASSES)]
        while queue:  # all compositions that can occur
            f = queue.pop()
            for g in of_class:
                h = tuple(g[x] for x in f)
                if h not in functions:
                    functions[h] = len(functions)
                    queue.append(h)
        every = list(functions)
        self.count = len(every)
        self.of_class = np.array([functions[g] for g in of_class], np.int32)
        compose = np.empty((self.count, self.count), np.int32)
        images = np.array(every, np.int64)
        for i, f in enumerate(images):
            for j, h in enumerate(images[:, f]):
                compose[i, j] = functions[tuple(int(x) for x in h)]
        self.compose = compose.ravel()
        self.from_start = images[:, S_START].astype(np.uint8)

    def classes(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Class of each code point; ``starts`` are the first positions of the non-empty texts."""
        n = len(points)
        kind = self.kind[points]
        blank = kind >= SPACE
        last = np.zeros(n, bool)
        last[starts[1:] - 1] = True
        last[-1] = True
        inner = np.empty(n, bool)
        inner[:-1] = blank[1:]
        inner[-1] = True
        inner |= last
        cls = np.array([C_OTHER, C_LETTER, C_NUMBER, C_SPACE, C_BLANK], np.uint8)[kind]
        cls[blank & inner] = C_INNER
        marks = np.flatnonzero(points == 0x27)
        if len(marks):
            first = np.zeros(n + 2, bool)
            first[starts] = True
            first[n:] = True
            padded = np.append(points, np.zeros(2, points.dtype))
            one, two = padded[marks + 1], padded[marks + 2]
            ok1, ok2 = ~first[marks + 1], ~first[marks + 1] & ~first[marks + 2]
            short = ok1 & np.isin(one, [ord(x) for x in SHORT])
            long = np.zeros(len(marks), bool)
            for a, b in LONG:
                long |= ok2 & (one == ord(a)) & (two == ord(b))
            cls[marks[short]] = C_SHORT
            cls[marks[long]] = C_LONG
        cls[starts] += CLASSES
        return cls

    def boundaries(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """First positions of all pieces, ascending."""
        n = len(points)
        if not n:
            return np.zeros(0, np.int64)
        cls = self.classes(points, starts)
        width = max(1, int(np.sqrt(n)))
        blocks = -(-n // width)
        padded = np.zeros(blocks * width, np.uint8)
        padded[:n] = cls
        columns = np.ascontiguousarray(padded.reshape(blocks, width).T).astype(np.int32)
        f = self.of_class[columns[0]]
        for column in columns[1:]:
            f = self.compose[f * self.count + self.of_class[column]]
        step = 1
        while step < blocks:  # inclusive scan over the blocks
            later = self.compose[f[:-step] * self.count + f[step:]]
            f = np.concatenate([f[:step], later])
            step *= 2
        state = np.concatenate([[S_START], self.from_start[f[:-1]]]).astype(np.int32)
        out = np.empty(columns.shape, bool)
        for i, column in enumerate(columns):
            at = state * (2 * CLASSES) + column
            out[i] = self.begins[at]
            state = self.next[at].astype(np.int32)
        return np.flatnonzero(out.T.ravel()[:n])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: join the adjacent pair of lowest rank, leftmost first, until none has one."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONG_PIECE:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
    while pairs:
        low = min(pairs)
        if low == 1 << 60:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            pair = parts[i] + parts[j]
            if (rank := ranks.get(pair)) is not None:
                heapq.heappush(heap, (rank, i, pair))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, pair = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= n or parts[i] + parts[j] != pair:
            continue
        parts[i], parts[j] = pair, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[p] for p in parts if p is not None]


class Encoder:
    """Ranks, splitter and piece cache of one Python worker."""

    def __init__(self, rank_file: bytes, kinds: np.ndarray) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.splitter = Splitter(kinds)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, ids per text, piece offsets in code points of their text, pieces per text."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        at = self.splitter.boundaries(points, (ends - lengths)[lengths > 0])
        cuts = at.tolist()
        pieces = [whole[a:b] for a, b in zip(cuts, [*cuts[1:], len(whole)][: len(cuts)], strict=True)]
        found = list(map(self._merged(set(pieces)).__getitem__, pieces))
        per_piece = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), np.int32)
        first = np.searchsorted(at, ends - lengths)
        stop = np.searchsorted(at, ends)
        total = np.concatenate([[0], np.cumsum(per_piece)])
        counts = total[stop] - total[first]
        offsets = at - np.repeat(ends - lengths, stop - first)
        return ids, counts, offsets.astype(np.int32), stop - first

    def _merged(self, pieces: set[str]) -> dict[str, bytes]:
        """A dictionary with the ids, as bytes, of at least these pieces."""
        missing = [p for p in pieces if p not in self.young]
        if len(self.young) + len(missing) > CACHE_PIECES:
            self.old, self.young, missing = self.young, {}, list(pieces)
        for p in missing:
            known = self.old.get(p)
            if known is None:
                known = np.array(merge(p.encode("utf-8"), self.ranks), np.int32).tobytes()
            self.young[p] = known
        return self.young

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        tokens, flat, out, at = self.tokens, ids.tolist(), [], 0
        for n in counts.tolist():
            out.append(b"".join([tokens[i] for i in flat[at : at + n]]))
            at += n
        return out


_ENCODERS: dict[str, Encoder] = {}
_KINDS: list[np.ndarray] = []


def share_ranks(docs: DataFrame, ranks_path: str) -> tuple[str, Broadcast]:
    """The rank file and the code point kinds, read on the driver and broadcast.

    Their size is that of the vocabulary and of Unicode, not of the data.
    """
    if not _KINDS:
        _KINDS.append(code_point_kinds())
    with open(ranks_path, "rb") as f:
        raw = f.read()
    return hashlib.sha256(raw).hexdigest(), docs.sparkSession.sparkContext.broadcast((raw, _KINDS[0]))


def encoder_of(key: str, shared: Broadcast) -> Encoder:
    """The worker's encoder for a rank file; one is kept at a time."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(*shared.value)
    return _ENCODERS[key]


def _lists(values: np.ndarray, counts: Iterable[int]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def encode_documents(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, ids, offsets``: token ids of each whole text and where its pieces begin.

    ``offsets`` are code points of the text. A NULL text counts as empty and gives empty arrays; a
    NULL or repeated ``doc_id`` is carried through, one row per input row. An empty table gives an
    empty result; columns other than ``doc_id`` and ``text`` are not read.
    """
    key, shared = share_ranks(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(key, shared)
        for chunk, texts in text_chunks(batches):
            ids, counts, offsets, pieces = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), _lists(ids, counts), _lists(offsets, pieces)], ["doc_id", "ids", "offsets"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return id_and_text(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that the ids stand for, empty for empty or NULL ids."""
    key, shared = share_ranks(encoded, ranks_path)
    rest = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(key, shared)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            done = np.concatenate([[0], np.cumsum(counts)])
            flat = column.flatten().to_numpy(zero_copy_only=False)
            start = 0
            while start < len(counts):  # about a million ids at once
                stop = max(start + 1, int(np.searchsorted(done, done[start] + (1 << 20), "right")) - 1)
                decoded = encoder.decode(flat[done[start] : done[stop]], counts[start:stop])
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], [*rest, "decoded"])
                start = stop

    fields = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes if n != "decoded")
    return encoded.select(*rest).mapInArrow(run, f"{fields}, decoded binary")


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Per document the number of ids and pieces, and digests of its ids and of their decoding."""
    return decode_documents(encode_documents(docs, ranks_path), ranks_path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.size("offsets").cast("bigint").alias("n_pieces"),
    )
