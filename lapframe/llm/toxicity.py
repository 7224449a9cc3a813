"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed terms. The machine adds a weight per term and, for every pair of
terms present, the inner product of their factor vectors, so that two terms that are harmless alone
can count together. It is fitted with numpy on a bounded sample of labelled documents and scores
whole texts in Spark tasks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.llm.common import id_and_text, id_fold

HASH_BITS = 26
# Labelled documents that the machine is fitted on, chosen by a hash of their ids.
SAMPLE_ROWS = 8_000
# Terms that get a weight for their own sake: those whose presence differs most between the labels.
MAX_TERMS = 512
# Least number of standard errors between the shares of toxic and other documents with a term.
LEAST_Z = 5.0
# Terms, by frequency, whose pairs are tested; pairs that matter beyond their terms; standard errors for that.
PAIR_TERMS = 512
MAX_PAIRS = 64
LEAST_PAIR_Z = 6.0
FACTORS = 8
STEPS = 600
# Words whose terms are kept per Python worker; the store starts anew when it is full.
CACHE_WORDS = 1 << 19

_TERM = re.compile(r"[^\W_]+")


def hashed(term: str) -> int:
    return zlib.crc32(term.encode("utf-8")) & ((1 << HASH_BITS) - 1)


def hashed_terms(text: str) -> set[int]:
    """Hashes of the distinct lower-case runs of letters and digits in the whole text."""
    return {hashed(t) for w in set(text.lower().split()) for t in _TERM.findall(w)}


@dataclass
class Machine:
    """Bias, weights and factors; ``index`` maps a term's hash to its row."""

    index: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "seen": {}}

    def present(self, text: str) -> set[int]:
        """Rows of the weighted terms that the text contains."""
        words = set(text.lower().split())
        seen, out = self.seen, set()
        if len(seen) > CACHE_WORDS:
            seen.clear()
        for word in words:
            rows = seen.get(word)
            if rows is None:
                rows = tuple(self.index[h] for t in _TERM.findall(word) if (h := hashed(t)) in self.index)
                if len(word) <= 64:
                    seen[word] = rows
            if rows:
                out.update(rows)
        return out

    def score(self, texts: Iterable[str]) -> np.ndarray:
        """Probability of the label for each text; an empty text gets the bias alone."""
        found = [self.present(t) for t in texts]
        n = len(found)
        owner = np.repeat(np.arange(n), [len(x) for x in found])
        rows = np.array([i for x in found for i in x], np.int64)
        margin = self.bias + np.bincount(owner, self.weights[rows], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[rows, f]
            margin += 0.5 * (np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n))
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def _distinct(sets: list[np.ndarray], labels: np.ndarray) -> list[int]:
    """Positions without copies of an earlier row: those with the same label and an equal set."""
    first: dict[tuple[int, bytes], int] = {}
    for i, (s, y) in enumerate(zip(sets, labels, strict=True)):
        first.setdefault((int(y), np.unique(s).astype(np.int64).tobytes()), i)
    return list(first.values())


def _telling_pairs(sets: list[np.ndarray], labels: np.ndarray, counts: Counter) -> list[tuple[int, int]]:
    """Pairs of frequent terms whose presence together says more or less than both alone.

    The contrast is p11 - p10 - p01 + p00 of the label's shares among documents with both terms, one, the
    other and neither; each of the four must be at least five documents. Terms that are neutral alone
    are found here, such as two that are harmless together only.
    """
    terms = [t for t, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:PAIR_TERMS]]
    place = {t: i for i, t in enumerate(terms)}
    x = np.zeros((len(sets), len(terms)), np.float32)
    for row, s in enumerate(sets):
        x[row, [place[t] for t in s.tolist() if t in place]] = 1
    y = labels.astype(np.float32)
    n11, t11 = (x.T @ x).astype(np.float64), (x.T @ (x * y[:, None])).astype(np.float64)
    n1, t1, n, t = np.diag(n11).copy(), np.diag(t11).copy(), float(len(y)), float(y.sum())
    cells = [
        (n11, t11), (n1[:, None] - n11, t1[:, None] - t11), (n1[None, :] - n11, t1[None, :] - t11),
        (n - n1[:, None] - n1[None, :] + n11, t - t1[:, None] - t1[None, :] + t11),
    ]
    contrast, variance, enough = np.zeros_like(n11), np.zeros_like(n11), np.ones_like(n11, bool)
    for sign, (size, hits) in zip((1, -1, -1, 1), cells, strict=True):
        share = (hits + 0.5) / (size + 1)
        contrast += sign * share
        variance += share * (1 - share) / np.maximum(size, 1)
        enough &= size >= 5
    z = np.where(enough, np.abs(contrast) / np.sqrt(variance + 1e-12), 0)
    first, second = np.nonzero(np.triu(z >= LEAST_PAIR_Z, 1))
    best = sorted(zip(-z[first, second], first.tolist(), second.tolist(), strict=True))[:MAX_PAIRS]
    return [(terms[i], terms[j]) for _, i, j in best]


def fit(sets: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """Fit a machine on sets of hashed terms; equal sets with one label count once.

    Without documents, or with one label only, no term gets a weight and the bias is the smoothed
    share of the label.
    """
    kept = _distinct(sets, labels)
    sets, labels = [sets[i] for i in kept], labels[kept].astype(np.float64)
    n, pos = len(labels), float(labels.sum())
    rate = (pos + 0.5) / (n + 2)
    bias = float(np.log(rate / (1 - rate)))
    none = Machine({}, bias, np.zeros(0), np.zeros((0, FACTORS)))
    if not 0 < pos < n:
        return none
    both: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for s, y in zip(sets, labels, strict=True):
        both[bool(y)].update(s.tolist())
    scored = []
    for term in both[True].keys() | both[False].keys():
        a, b = both[True][term], both[False][term]
        if a + b < 5:
            continue
        p = (a + b) / n
        z = (a / pos - b / (n - pos)) / np.sqrt(p * (1 - p) * (1 / pos + 1 / (n - pos)) + 1e-12)
        if abs(z) >= LEAST_Z:
            scored.append((-abs(z), term))
    chosen = [t for _, t in sorted(scored)[:MAX_TERMS]]
    pairs = _telling_pairs(sets, labels, both[True] + both[False])
    chosen += sorted({t for pair in pairs for t in pair} - set(chosen))
    if not chosen:
        return none
    index = {t: i for i, t in enumerate(chosen)}
    x = np.zeros((n, len(chosen)), np.float32)
    for i, s in enumerate(sets):
        x[i, [index[t] for t in s.tolist() if t in index]] = 1
    # both labels weigh the same; Adam on the whole sample
    sample_weight = np.where(labels == 1, n / (2 * pos), n / (2 * (n - pos))).astype(np.float32) / n
    rng = np.random.default_rng(seed)
    params = [np.zeros(1, np.float32), np.zeros(len(chosen), np.float32), rng.normal(0, 0.05, (len(chosen), FACTORS)).astype(np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    y = labels.astype(np.float32)
    for step in range(1, STEPS + 1):
        b, w, v = params
        xv = x @ v
        margin = b[0] + x @ w + 0.5 * ((xv * xv).sum(1) - x @ (v * v).sum(1))
        d = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * sample_weight
        xd = x.T @ d
        grads = [
            np.array([d.sum()], np.float32),
            xd + 1e-4 * w,
            x.T @ (xv * d[:, None]) - v * xd[:, None] + 1e-3 * v,
        ]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - 0.05 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Machine(index, float(params[0][0]), params[1].astype(np.float64), params[2].astype(np.float64))


def training_sets(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """Term sets and labels of at most ``sample_rows`` labelled documents outside fold 0.

    The ids are chosen first, by their hash, from the label table; only these documents are brought
    to the driver, as hashed terms.
    """
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_fold(5) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )

    @F.pandas_udf("array<int>")
    def terms(text: pd.Series) -> pd.Series:
        return text.map(lambda t: sorted(hashed_terms(t)))

    rows = (
        id_and_text(docs)
        .join(F.broadcast(chosen), "doc_id")  # at most sample_rows ids
        .select("doc_id", "toxic", terms("text").alias("terms"))
        .limit(sample_rows)
        .toArrow()
        .sort_by("doc_id")
    )
    # slices of one array: lists of Python numbers would take many times the memory of the driver
    terms_of = rows["terms"].combine_chunks()
    flat, ends = terms_of.flatten().to_numpy(), np.cumsum(terms_of.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1].astype(np.int64)) if len(ends) else [], rows["toxic"].to_numpy().astype(np.int64)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    return fit(*training_sets(docs, labels, sample_rows))


def score_column(machine: Machine, text: str = "text") -> Column:
    """The score of a text column, NULL read as empty."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(machine.score(part))

    return score(F.coalesce(F.col(text), F.lit("")))


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per input row.

    NULL texts are empty; NULL ids count as held out. Only ``doc_id`` and ``text`` are read, so other
    columns can neither clash nor be inputs. An empty table gives an empty result.
    """
    return docs.select("doc_id", (id_fold(5) == 0).alias("held_out"), score_column(machine).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )
