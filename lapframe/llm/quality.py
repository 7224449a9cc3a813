"""Quality rules: text statistics and a learned decision list, in Spark expressions only.

Sequential covering: a rule is a conjunction of thresholds, grown literal by literal on one part of
the labelled documents by information gain, cut back on another part, and kept while it is precise
there; the documents it covers leave, and the next rule is grown. Every step is one grouped aggregate
of bin counts, so only a few hundred numbers reach the driver. The list becomes an ordered
conditional expression.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.llm.common import BLANKS, forget, stored
from lapframe.llm.pii import let

FEATURES = ("words", "mean_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "mark_share")
# Thresholds: quantiles with fine tails, and those of the rejected documents alone, for rare kinds of junk.
QUANTILES = (0.001, 0.002, 0.005, 0.01, 0.02, *(i / 20 for i in range(1, 20)), 0.98, 0.99, 0.995, 0.998, 0.999)
BAD_QUANTILES = (0.05, 0.2, 0.5, 0.8, 0.95)
MAX_RULES = 8
MAX_LITERALS = 4
# Rules that may fail on the held part before the search ends; each bars its first literal.
MAX_FAILURES = 6
# A rule needs this share of rejected documents on the pruning part, and so many of them.
PRECISION = 0.85
SUPPORT = 5


def _words(text: Column) -> Column:
    trimmed = F.regexp_replace(text, rf"^[{BLANKS}]++|[{BLANKS}]++\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, rf"[{BLANKS}]++"))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice; windows are compared by 64-bit hashes.

    The windows are sorted by hash, so equal ones are neighbours; then the repeated positions, sorted,
    cover at most three words each. Time is n log n in the words.
    """

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def repeated(v: Column) -> Column:
        found = F.filter(v, lambda x, i: same(x, F.get(v, i - 1)) | same(x, F.get(v, i + 1)))
        return F.transform(found, lambda x: x["i"])

    def covered(p: Column) -> Column:
        own = F.transform(p, lambda x, i: F.coalesce(F.least(F.lit(3), F.get(p, i + 1) - x), F.lit(3)))
        return F.aggregate(own, F.lit(0), lambda acc, x: acc + x)

    def whole(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")),
        )
        return let(F.sort_array(let(F.sort_array(windows), repeated)), covered)

    return F.when(F.size(words) >= 3, let(words, whole)).otherwise(0)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole-text statistics, one row per input row.

    A NULL text has none: all counts are 0. Ids are carried through; other columns are not read. An
    empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda s, pattern: F.char_length(F.regexp_replace(s, pattern, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(rf"[^{BLANKS}]"))

    def counted(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"),
            _repeat_words(w).cast("bigint").alias("n_repeat_words"),
        )

    rows = docs.select(
        "doc_id",
        let(_words(text), counted).alias("w"),
        without(text, rf"[{BLANKS}]++").cast("bigint").alias("word_chars"),
        (F.char_length(text) - without(text, r"[#*$%&|<>]++")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        F.size(F.split(text, "\n")).cast("bigint").alias("n_lines"),
        (F.char_length(text) - without(text, r"[A-Z]++")).cast("bigint").alias("n_upper"),
        (F.char_length(text) - without(text, r"[!?]++")).cast("bigint").alias("n_marks"),
    )
    return rows.select("doc_id", "w.*", *[c for c in rows.columns if c not in ("doc_id", "w")])


def _features() -> list[Column]:
    """The values of ``FEATURES``, from the columns of ``statistics``; shares of nothing are 0."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))

    return [
        F.col("n_words").cast("double"),
        share("word_chars", "n_words"),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        share("n_distinct", "n_words"),
        share("n_upper", "word_chars"),
        share("n_marks", "word_chars"),
    ]


@dataclass(frozen=True)
class Literal:
    feature: int
    above: bool
    limit: float

    def column(self, values: list[Column]) -> Column:
        value = values[self.feature]
        return value > self.limit if self.above else value <= self.limit

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.limit:g}"


Rule = tuple[Literal, ...]


def _holds(rule: Rule, values: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.column(values) for x in rule], F.lit(True))


def verdict(rules: list[Rule], values: list[Column]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    out = F.lit(0)
    for i in reversed(range(len(rules))):
        out = F.when(_holds(rules[i], values), i + 1).otherwise(out)
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for rejection from ``labels.quality`` (0: reject). Without both labels there are none.

    An id counts once, rejected if any of its labels says so; NULL ids and labels are left out.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    table = stored(
        stats.join(known, "doc_id").select(
            (F.col("quality") == 0).cast("int").alias("bad"),
            # two thirds grow the rules, a third cuts them back
            (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).alias("held"),
            F.array(*_features()).alias("x"),
        ),
        "quality-labelled",
    )
    values = [F.col("x")[i] for i in range(len(FEATURES))]
    cuts = [F.percentile_approx(v, list(QUANTILES), 10_000).alias(f"e{i}") for i, v in enumerate(values)]
    cuts += [F.percentile_approx(F.when(F.col("bad") == 1, v), list(BAD_QUANTILES), 2000).alias(f"b{i}") for i, v in enumerate(values)]
    edges_row = table.agg(*cuts).first()
    edges = [sorted({*(edges_row[f"e{i}"] or []), *(edges_row[f"b{i}"] or [])}) for i in range(len(FEATURES))]

    def bins() -> Column:
        # bin k: above k edges
        def one(i: int) -> Column:
            return reduce(lambda a, b: a + b, [(values[i] > e).cast("int") for e in edges[i]], F.lit(0))

        return F.array(*[one(i) for i in range(len(FEATURES))])

    def counts(rows: DataFrame) -> dict[tuple[int, bool], dict[int, list[float]]]:
        """Rejected and kept documents by feature and part, then by bin: at most a few hundred rows."""
        found: dict[tuple[int, bool], dict[int, list[float]]] = defaultdict(lambda: defaultdict(lambda: [0.0, 0.0]))
        grouped = rows.select("bad", "held", F.posexplode(bins()).alias("f", "bin")).groupBy("f", "held", "bin")
        for r in grouped.agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect():
            found[r.f, r.held][r.bin] = [float(r.bad), float(r.good)]
        return found

    def side(bin_counts: dict[int, list[float]], k: int, above: bool) -> tuple[float, float]:
        chosen = [v for b, v in bin_counts.items() if (b > k) == above]
        return sum(v[0] for v in chosen), sum(v[1] for v in chosen)

    rules: list[Rule] = []
    rest = table
    barred: set[tuple[int, int, bool]] = set()
    while len(rules) < MAX_RULES and len(barred) < MAX_FAILURES:
        rule: list[Literal] = []
        on_held: list[tuple[float, float]] = []
        rows, first = rest, None
        while len(rule) < MAX_LITERALS:
            found = counts(rows)
            p0, n0 = side(found[0, False], -1, True)
            if p0 < SUPPORT or n0 == 0:
                break
            best, gain = None, 1e-9
            for f in range(len(FEATURES)):
                for k, edge in enumerate(edges[f]):
                    for above in (False, True):
                        if not rule and (f, k, above) in barred:
                            continue
                        p, n = side(found[f, False], k, above)
                        if p >= SUPPORT and (g := _gain(p, n, p0, n0)) > gain:
                            best, gain = (Literal(f, above, float(edge)), k), g
            if best is None:
                break
            literal, k = best
            first = first or (literal.feature, k, literal.above)
            rule.append(literal)
            on_held.append(side(found[literal.feature, True], k, literal.above))
            rows = rows.filter(literal.column(values))
        if not rule:
            break
        # cut back to the prefix that is worth most on the held part
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in on_held]
        keep = worth.index(max(worth)) + 1
        p, n = on_held[keep - 1]
        if p < SUPPORT / 2 or p < PRECISION * (p + n):
            barred.add(first)  # the next best first literal may still do
            continue
        rules.append(tuple(rule[:keep]))
        rest = rest.filter(~_holds(rules[-1], values))
    forget(table)
    return rules


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``kept`` and ``rule`` (0: none)."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rule = verdict(rules, _features())
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (rule == 0)).alias("kept"), rule.alias("rule"),
    )


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of all ``docs`` in one pass over the texts, rules from ``labels``, and the verdicts."""
    stats = stored(statistics(docs), "quality-stats")
    return judge(stats, learn(stats, labels))
