"""Quality classifier: a sparse ensemble of rules taken from boosted trees.

Small boosted trees over text statistics are grown at several depths. Each node below a root is a
path, that is a conjunction of intervals of statistics; equal conjunctions count once. A logistic
regression with an L1 penalty gives most rules no weight. The rest becomes one Spark expression over
the statistics: a sum of conditionals inside the logistic function.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.llm.boosting import Leaf, Split, boost
from lapframe.llm.common import byte_pieces, id_and_text, id_fold

STATISTICS = (
    "words", "mean_length", "longest_word", "distinct_share", "top_share", "symbol_share", "mark_share", "upper_share",
    "digit_share", "stop_share", "symbol_ends", "dup_line_share", "words_per_line", "wide_share", "packed_share",
)
# Labelled documents that the ensemble is fitted on, chosen by a hash of their ids.
SAMPLE_ROWS = 20_000
QUANTILES = (0.001, 0.002, 0.005, 0.01, 0.02, *(i / 40 for i in range(2, 39)), 0.98, 0.99, 0.995, 0.998, 0.999)
DEPTHS = (1, 2, 3)
ROUNDS = 16
# L1 penalties that are tried, as parts of the one that leaves no rule.
PENALTIES = tuple(0.5**i for i in range(1, 12))
PREDICT_AT = 0.3

_SYMBOLS, _MARKS, _STOPS = b"#*$%&|<>", b"!?", b".,;:"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_BLANK = bytes([32, *range(9, 14)])


def statistics_of(text: str) -> list[float]:
    """The values of ``STATISTICS`` for one whole text; shares of nothing are 0.

    Words and lines are counted piece by piece, so beside the text itself only its distinct words and
    lines are held.
    """
    data = text.encode("utf-8")
    words: Counter[bytes] = Counter()
    for piece in byte_pieces(data):
        words.update(piece.split())
    solid = data.translate(None, _BLANK)
    n_words, n_solid = sum(words.values()), len(solid)
    lines, last = Counter(zlib.crc32(x) | len(x) << 32 for x in data.split(b"\n") if x.strip()), len(data)
    n_lines = sum(lines.values())

    def among(chars: bytes) -> float:
        return (n_solid - len(solid.translate(None, chars))) / n_solid if n_solid else 0.0

    def per_word(x: float) -> float:
        return x / n_words if n_words else 0.0

    return [
        float(n_words),
        per_word(n_solid),
        float(max(map(len, words), default=0)),
        per_word(len(words)),
        per_word(max(words.values(), default=0)),
        among(_SYMBOLS),
        among(_MARKS),
        among(_UPPER),
        among(_DIGITS),
        among(_STOPS),
        per_word(sum(c for w, c in words.items() if w[-1] in _SYMBOLS)),
        1 - len(lines) / n_lines if n_lines else 0.0,
        n_words / n_lines if n_lines else 0.0,
        (last - len(text)) / last if last else 0.0,
        len(zlib.compress(data, 1)) / last if last else 0.0,
    ]


def statistics(text: Column) -> Column:
    """The statistics of a text column as an array, NULL read as empty."""

    @F.pandas_udf("array<double>")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(statistics_of)

    return counted(F.coalesce(text, F.lit("")))


@dataclass(frozen=True)
class Rule:
    """Holds where each statistic named lies in its interval ``(above, limit]``; an open end is None."""

    parts: tuple[tuple[int, float | None, float | None], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, above, limit in self.parts:
            if above is not None:
                out &= x[:, f] > above
            if limit is not None:
                out &= x[:, f] <= limit
        return out

    def column(self, values: Sequence[Column]) -> Column:
        out = F.lit(True)
        for f, above, limit in self.parts:
            if above is not None:
                out = out & (values[f] > F.lit(above))
            if limit is not None:
                out = out & (values[f] <= F.lit(limit))
        return out

    def __str__(self) -> str:
        def side(f: int, above: float | None, limit: float | None) -> str:
            low, high = "" if above is None else f"{above:g} < ", "" if limit is None else f" <= {limit:g}"
            return f"{low}{STATISTICS[f]}{high}"

        return " and ".join(side(*p) for p in self.parts)


def paths(tree: Split | Leaf, edges: Sequence[np.ndarray]) -> set[Rule]:
    """The rule of every node below the root: its path, with the intervals of a statistic intersected."""
    found: set[Rule] = set()

    def walk(node: Split | Leaf, bounds: dict[int, tuple[int, int]]) -> None:
        if bounds:
            found.add(Rule(tuple((f, float(edges[f][a - 1]) if a else None, float(edges[f][b]) if b < len(edges[f]) else None) for f, (a, b) in sorted(bounds.items()))))
        if isinstance(node, Split):
            low, high = bounds.get(node.feature, (0, len(edges[node.feature])))
            walk(node.left, {**bounds, node.feature: (low, min(high, node.bin))})
            walk(node.right, {**bounds, node.feature: (max(low, node.bin + 1), high)})

    walk(tree, {})
    return found


def _loss(margin: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    return float(pos @ np.logaddexp(0, -margin) + neg @ np.logaddexp(0, margin)) / max(float((pos + neg).sum()), 1.0)


def lasso(a: np.ndarray, pos: np.ndarray, neg: np.ndarray, penalty: float, start: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of a logistic regression with an L1 penalty on all but the first column (the constant).

    Accelerated proximal gradient on rows that stand for ``pos`` and ``neg`` cases each.
    """
    total = pos + neg
    n = total.sum()
    v = np.ones(a.shape[1])
    for _ in range(20):  # largest curvature
        v = a.T @ (total * (a @ v))
        v /= np.linalg.norm(v)
    size = 4 * n / float(v @ (a.T @ (total * (a @ v))))
    w, z, t = start.copy(), start.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ z, -40, 40)))
        u = z - size * (a.T @ (p * total - pos)) / n
        new = np.sign(u) * np.maximum(np.abs(u) - size * penalty, 0)
        new[0] = u[0]
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / grown * (new - w)
        if np.abs(new - w).max() < 1e-6:
            return new
        w, t = new, grown
    return w


@dataclass(frozen=True)
class Ensemble:
    """Constant and weighted rules of the log odds that the label is 1."""

    bias: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = self.bias + sum((w * r.holds(x) for r, w in zip(self.rules, self.weights, strict=True)), np.zeros(len(x)))
        return 1 / (1 + np.exp(-margin))

    def column(self, values: Sequence[Column]) -> Column:
        """The score as an expression over the statistics."""
        margin = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            margin = margin + F.when(rule.column(values), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Ensemble:
    """Grow trees, take their paths and weigh them; ``held`` rows choose the penalty and then count too.

    Without rows, or with one label only, there are no rules and the score is the smoothed share of
    the label.
    """
    share = (float(y.sum()) + 0.5) / (len(y) + 1)
    none = Ensemble(float(np.log(share / (1 - share))), (), ())
    if not 0 < y.sum() < len(y):
        return none
    edges = [np.unique(np.quantile(column, QUANTILES, method="lower")) for column in x.T]
    bins = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], axis=1)
    grown = ~held if 0 < y[~held].sum() < (~held).sum() else np.ones(len(y), bool)
    found: set[Rule] = set()
    for depth in DEPTHS:
        for tree in boost(bins[grown], y[grown].astype(float), 1.0 - y[grown], rounds=ROUNDS, depth=depth, rate=0.3).trees:
            found |= paths(tree, edges)
    rules = sorted(found, key=lambda r: (len(r.parts), str(r)))
    fires = np.stack([r.holds(x) for r in rules], axis=1) if rules else np.zeros((len(x), 0), bool)

    def counted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct patterns of rules with their cases: rows that fire alike are one."""
        patterns, which = np.unique(fires[rows], axis=0, return_inverse=True)
        which = which.reshape(-1)
        a = np.hstack([np.ones((len(patterns), 1)), patterns.astype(float)])
        return a, np.bincount(which, y[rows], len(patterns)), np.bincount(which, 1.0 - y[rows], len(patterns))

    a, pos, neg = counted(grown)
    b, b_pos, b_neg = counted(held) if held.any() else (a, pos, neg)
    start = np.zeros(a.shape[1])
    start[0] = none.bias
    p = pos.sum() / (pos + neg).sum()
    most = float(np.abs(a[:, 1:].T @ (p * (pos + neg) - pos)).max()) / len(y) if rules else 0.0
    best, w, chosen = np.inf, start, 1.0
    for part in PENALTIES:
        w = lasso(a, pos, neg, most * part, w)
        if (loss := _loss(b @ w, b_pos, b_neg)) < best - 1e-4:
            best, chosen = loss, part
    a, pos, neg = counted(np.ones(len(y), bool))
    w = lasso(a, pos, neg, most * chosen, start, 2000)
    kept = [i for i in range(len(rules)) if abs(w[i + 1]) > 1e-6]
    return Ensemble(float(w[0]), tuple(rules[i] for i in kept), tuple(float(w[i + 1]) for i in kept))


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, labels and held-back marks of at most ``sample_rows`` labelled documents outside fold 0.

    An id counts with its lowest label. Ids are chosen by their hash from the label table; of several
    documents with one id, each is a row, and the ids last in order give way.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (id_fold(5) != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    rows = (
        id_and_text(docs)
        .join(F.broadcast(chosen), "doc_id")  # at most sample_rows ids
        .select("doc_id", "quality", (id_fold(5) == 1).alias("held"), statistics(F.col("text")).alias("x"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "x")
        .limit(sample_rows)
        .toArrow()
    )
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(-1, len(STATISTICS))
    return x, np.array(rows["quality"].to_pylist(), np.int64), np.array(rows["held"].to_pylist(), bool)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ensemble:
    return fit(*training_rows(docs, labels, sample_rows))


def score_documents(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_rules``, one row per input row.

    ``n_rules`` counts the rules that hold. NULL texts are empty; NULL ids count as held out. Only
    ``doc_id`` and ``text`` are read, so other columns can neither clash nor be inputs. An empty table
    gives an empty result, repeated rows give equal rows.
    """
    values = [F.col("x")[i] for i in range(len(STATISTICS))]
    fired = F.lit(0)
    for rule in ensemble.rules:
        fired = fired + rule.column(values).cast("int")
    rows = docs.select("doc_id", (id_fold(5) == 0).alias("held_out"), statistics(F.col("text")).alias("x"))
    scored = rows.select("doc_id", "held_out", ensemble.column(values).alias("score"), fired.alias("n_rules"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).alias("predicted"), "n_rules")
