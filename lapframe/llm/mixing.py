"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens to the power of an exponent between 0 (all alike) and 1
(as they are). The exponent is bisected until the weights meet a target entropy or a repetition limit.
Weights become token budgets; a source spends its budget in passes over its documents, each pass in an
order of its own, the last one cut where the budget ends. The streams of all sources are laid over one
another and cut into blocks: each block holds every source nearly by its weight, in random order.

A running sum over a source, which may hold a third of all rows, is taken in two levels: over about
sqrt(n) buckets of its order, and inside each bucket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapframe.llm.common import stored

# Exponents tried in one aggregate; each round narrows the interval to one step of the grid.
GRID = 64
ROUNDS = 6


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet.

    ``entropy_share``: least entropy of the weights, as a share of that of equal weights; the largest
    exponent that gives it is taken. ``max_repeats``: most passes over a source when the one with the
    fewest is passed over once; the smallest exponent within it is taken. With both, the entropy is
    sought as far as the repetitions allow. With neither, weights are the shares.
    """

    entropy_share: float | None = None
    max_repeats: float | None = None


def token_count(text: Column) -> Column:
    """Words of the whole text; at least 1, so that every document takes a place."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]++")), F.lit(1)).cast("bigint")


def entries(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens`` of each row."""
    return docs.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens"))


def source_tokens(items: DataFrame) -> DataFrame:
    """``source, n_docs, tokens``; a large source is reduced to one row per task before the shuffle."""
    return items.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"))


def _figures(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the entropy of the weights and the most passes, from one grouped aggregate.

    The exponents are rows, so every round has the same plan and compiles nothing new.
    """
    total = float(sources.agg(F.sum("tokens")).first()[0])
    p, a = F.col("tokens") / F.lit(total), F.col("a")
    tried = sources.select("tokens", F.posexplode(F.lit(exponents)).alias("i", "a"))
    passes, weight = F.pow(p, a - 1), F.pow(p, a)
    figures = tried.groupBy("i").agg(
        F.sum(weight).alias("z"), F.sum(weight * F.log(p) * a).alias("l"), (F.max(passes) / F.min(passes)).alias("r")
    )
    found = {row["i"]: (math.log(row["z"]) - row["l"] / row["z"], row["r"]) for row in figures.collect()}
    return [found[i] for i in range(len(exponents))]


def bisect_exponent(sources: DataFrame, target: Target) -> float:
    """The exponent for ``target``; 1 for an empty table or a single source.

    Entropy and passes both fall as the exponent grows from 0 to 1, so each condition has one limit.
    """
    n = sources.count()
    if n < 2:
        return 1.0

    def limit(meets, low_meets: bool) -> float:
        """Where ``meets`` changes, from the side on which it holds."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
            held = [meets(*f) for f in _figures(sources, grid)]
            if all(held):
                return high if low_meets else low
            first = held.index(not low_meets) if low_meets else held.index(True)
            if first == 0:
                return low
            low, high = grid[first - 1], grid[first]
        return low if low_meets else high

    exponent = 1.0
    if target.entropy_share is not None:
        least = target.entropy_share * math.log(n) - 1e-12
        exponent = limit(lambda entropy, _: entropy >= least, low_meets=True)
        if target.max_repeats is None:
            return exponent
    if target.max_repeats is not None:
        most = target.max_repeats * (1 + 1e-12)
        floor = limit(lambda _, repeats: repeats <= most, low_meets=False)
        exponent = floor if target.entropy_share is None else max(exponent, floor)
    return exponent


def budgets(sources: DataFrame, exponent: float, budget_tokens: float | None = None) -> DataFrame:
    """``source, n_docs, tokens, weight, budget, passes``.

    Without ``budget_tokens`` the total is the least with which no source loses a document: the source
    with the fewest passes is passed over once.
    """
    facts = sources.agg(F.sum("tokens").alias("total")).select(F.col("total").cast("double").alias("total"))
    total = facts.first()["total"] or 1.0
    raw = sources.withColumn("raw", F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)))
    z, ratio = raw.agg(F.sum("raw"), F.max(F.col("tokens") / F.col("raw"))).first()
    if z is None:
        z, ratio = 1.0, 1.0
    whole = float(budget_tokens) if budget_tokens is not None else ratio * z
    weighed = raw.withColumn("weight", F.col("raw") / F.lit(z)).withColumn("budget", F.col("weight") * F.lit(whole))
    # passes a rounding error from a whole number are that number
    passes = F.col("budget") / F.col("tokens")
    near = F.abs(passes - F.round(passes)) < 1e-9
    return weighed.withColumn("passes", F.when(near, F.round(passes)).otherwise(passes)).select(
        "source", "n_docs", "tokens", "weight", (F.col("passes") * F.col("tokens")).alias("budget"), "passes"
    )


def _rank(seed: int, turn: Column) -> Column:
    """Place of a document in the order of a pass: 53 bits of a hash of seed, pass and id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), turn, F.col("doc_id")), 11)


def _placed(items: DataFrame, facts: DataFrame, seed: int) -> DataFrame:
    """One row per document and pass: ``start``, the tokens before it in its source's stream.

    Rows of one id share their place in a pass and so their start.
    """
    known = facts.withColumnRenamed("source", "__source")
    rows = (
        items.join(known, F.col("source").eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("passes").cast("int") - 1, F.lit(0)))))
        .withColumn("rank", _rank(seed, F.col("pass")))
        .withColumn("bucket", F.floor(F.col("rank") / F.lit(float(1 << 53)) * F.ceil(F.sqrt("n_docs"))))
    )
    key = ["source", "pass", "bucket"]
    before = Window.partitionBy("source", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy(*key)
        .agg(F.sum("n_tokens").alias("bucket_tokens"))
        .select(F.col("source").alias("__source"), F.col("pass").alias("__pass"), F.col("bucket").alias("__bucket"), F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy(*key).orderBy("rank").rangeBetween(Window.unboundedPreceding, -1)
    on = F.col("source").eqNullSafe(F.col("__source")) & (F.col("pass") == F.col("__pass")) & (F.col("bucket") == F.col("__bucket"))
    return (
        rows.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(bases, on)
        .withColumn("start", F.col("pass") * F.col("tokens") + F.col("base") + F.col("ahead"))
        .filter(F.col("start") < F.col("budget"))
    )


@dataclass(frozen=True)
class Mix:
    """A fitted mixture: the stored entries and per-source budgets, and the exponent."""

    items: DataFrame
    facts: DataFrame
    exponent: float
    seed: int


def fit(docs: DataFrame, target: Target, budget_tokens: float | None = None, seed: int = 17) -> Mix:
    """Count tokens once, find the exponent, and set the budgets.

    A NULL ``source`` is a source of its own; NULL and empty texts count one token; NULL and repeated
    ids are rows like others. An empty table gives an empty mixture. Only ``doc_id``, ``text`` and
    ``source`` are read.
    """
    items = stored(entries(docs), "mixing-entries")
    sources = stored(source_tokens(items), "mixing-sources")
    exponent = bisect_exponent(sources, target)
    return Mix(items, stored(budgets(sources, exponent, budget_tokens), "mixing-budgets"), exponent, seed)


def block_permutations(mix: Mix, block_tokens: int) -> DataFrame:
    """``doc_id, source, pass, n_tokens, weight, block, slot``: the mixed stream.

    A document's block follows from how much of its source's budget lies before it; ``slot`` is its
    place in the block, by a hash.
    """
    whole = mix.facts.agg(F.sum("budget")).first()[0] or 0.0
    blocks = max(1, math.ceil(whole / block_tokens))
    block = F.least(F.floor(F.col("start") / F.col("budget") * blocks), F.lit(blocks - 1)).cast("bigint")
    shuffled = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(mix.seed), "block", "pass", "doc_id"), "doc_id", "pass", "source", "n_tokens")
    return _placed(mix.items, mix.facts, mix.seed).withColumn("block", block).select(
        "doc_id", "source", "pass", "n_tokens", "weight", "block", (F.row_number().over(shuffled) - 1).cast("bigint").alias("slot")
    )


def repeated(docs: DataFrame, mix: Mix) -> DataFrame:
    """Each row of ``docs`` as often as the mixture takes it, all columns unchanged.

    Rows of one id and repeated rows are taken alike, NULL ids too; an empty table gives an empty one. The last pass of a source is cut at one place of its order, so membership needs only that place
    per source; texts are not shuffled.
    """
    last = F.ceil("passes").cast("int") - 1
    ends = (
        _placed(mix.items, mix.facts, mix.seed)
        .filter(F.col("pass") == last)
        .groupBy("source")
        .agg(F.max("rank").alias("__end"))
    )
    ends = mix.facts.join(ends.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")), "left").select(
        F.col("source").alias("__source"), last.alias("__last"), "__end"
    )
    ends = stored(ends, "mixing-ends")
    taken = F.col("__last") + F.when(_rank(mix.seed, F.col("__last")) <= F.col("__end"), 1).otherwise(0)
    return (
        docs.join(ends, docs["source"].eqNullSafe(ends["__source"]))
        .withColumn("__take", F.explode(F.array_repeat(F.lit(1), taken)))
        .select(*docs.columns)
    )
