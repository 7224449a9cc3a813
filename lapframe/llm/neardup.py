"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification.

Documents with equal shingle sets become one node, so copies never form pairs. Nodes that share a
band of their signature are candidates. A pair's sketches are compared in batches; after each batch
the posterior probability that the pair is similar enough decides whether to go on. Survivors are
compared on their full shingle sets, recomputed from the whole texts.

All pairs of a bucket are never listed. First every node is compared with the smallest node of each
of its buckets, and the best candidate is verified; that joins most of a group. A bucket that still
holds several groups is then worked off exactly. Up to ``PAIRED`` nodes are compared in pairs. In a
larger bucket all nodes are compared with one hub, of at most as many shingles as any of them: let N(x)
be the shingles of x that the hub lacks. If N(x) and N(y) share nothing, the common part of x and y lies
inside that of x and the hub, and inside that of y and the hub; as the hub is no larger than x or y, each
of them is then at least as much like the hub as like the other. So two nodes that are alike are both
linked with the hub, or both have shingles that the hub lacks, and these
name the next, smaller buckets. They must share so many that a prefix of each N(x) is enough to meet in,
and that a pair can be dropped by where in the order it first meets. The order is by rarity among the
nodes of one hub: texts that have a passage in common and nothing else post what they have alone.
The smaller of two nodes meets the other in a shorter prefix yet, so a bucket needs such a row to count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapframe.llm.common import checked_broadcast, forget, id_and_text, stored
from lapframe.llm.shingles import limited, mix, shingle_sets


@dataclass(frozen=True)
class Settings:
    """``bands`` bands of ``rows`` hashes; similarity of at least ``percent`` in a hundred links.

    A pair of exactly that similarity shares no band with probability (1 - s**rows)**bands, here
    4e-7, and is pruned wrongly with probability ``miss`` at most per batch of ``batch`` hashes.
    """

    percent: int = 85
    rows: int = 5
    bands: int = 25
    batch: int = 25
    miss: float = 1e-7

    @property
    def hashes(self) -> int:
        return self.rows * self.bands


DEFAULT = Settings()
# Buckets of several groups with at most so many nodes are compared in pairs; larger ones by a hub.
PAIRED = 32
# The same for the buckets that a hub gave, where most pairs are dropped by their places.
FINE_PAIRED = 512


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """For each number of compared hashes, the fewest matches with which a pair goes on.

    Sketches keep one byte of each minimum, so unequal minima match once in 256. The prior over the
    similarity is uniform on a grid; a pair is pruned once the posterior of ``percent`` or more falls
    below ``miss``, and never where even that similarity would show so few matches with more than ``miss``.
    """
    grid = (np.arange(1000) + 0.5) / 1000
    match = grid + (1 - grid) / 256
    enough = grid >= settings.percent / 100
    at = settings.percent / 100 + (1 - settings.percent / 100) / 256
    out = []
    for n in range(settings.batch, settings.hashes + 1, settings.batch):
        k = np.arange(n + 1)
        logs = k[:, None] * np.log(match) + (n - k)[:, None] * np.log1p(-match)
        weight = np.exp(logs - logs.max(1, keepdims=True))
        posterior = weight[:, enough].sum(1) / weight.sum(1)
        log_factorial = np.concatenate([[0], np.cumsum(np.log(np.arange(1, n + 1)))])
        binomial = np.exp(log_factorial[n] - log_factorial[k] - log_factorial[n - k] + k * np.log(at) + (n - k) * np.log1p(-at))
        prune = (posterior < settings.miss) & (np.cumsum(binomial) < settings.miss)
        out.append((n, int(prune.sum())))
    return out


def _signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, sketch, keys``, one row per input row."""
    rng = np.random.default_rng(20240)
    factor = rng.integers(0, 1 << 63, settings.hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, settings.hashes, np.uint64)
    band = mix(np.arange(1, settings.bands + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in limited(batch):
                sizes, first, second, sketches, keys = [], [], [], [], []
                for shingles in shingle_sets(part.column(1)):
                    n = len(shingles)
                    sizes.append(n)
                    first.append(int(shingles.sum(dtype=np.uint64).astype(np.int64)))
                    second.append(int(mix(shingles ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)))
                    if not n:
                        sketches.append(None)
                        keys.append(None)
                        continue
                    low = np.full(settings.hashes, 0xFFFFFFFFFFFFFFFF, np.uint64)
                    for at in range(0, n, 256):
                        np.minimum(low, (shingles[at : at + 256, None] * factor + shift).min(0), out=low)
                    low = mix(low)
                    sketches.append((low >> np.uint64(56)).astype(np.uint8).tobytes())
                    rows = low.reshape(settings.bands, settings.rows)
                    key = band.copy()
                    for k in range(settings.rows):
                        key = mix(key + rows[:, k])
                    keys.append(key.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(first, pa.int64()),
                        pa.array(second, pa.int64()),
                        pa.array(sketches, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "sketch", "keys"],
                )

    return id_and_text(docs).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, sketch binary, keys array<bigint>"
    )


def _likely(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a, b`` that no batch of sketch hashes prunes, with their number of matches."""
    steps = least_matches(settings)
    sketches = nodes.select("node", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = np.arange(batch.num_rows)
            left, right = (
                np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for c in (batch.column(2), batch.column(3))
            )
            matches, done = np.zeros(batch.num_rows, np.int64), 0
            for n, least in steps:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(1)
                alive, done = alive[matches[alive] >= least], n
            keep = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep), pa.array(matches[alive])], ["a", "b", "matches"]
            )

    both = (
        pairs.join(sketches.toDF("b", "sketch_b"), "b")
        .join(sketches.toDF("a", "sketch_a"), "a")
        .select("a", "b", "sketch_a", "sketch_b")
    )
    return both.mapInArrow(run, "a bigint, b bigint, matches bigint")


def _with_texts(pairs: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``a, b, text_a, text_b`` for stored pairs, and the stored texts behind it."""
    involved = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "neardup-involved")
    texts = stored(
        id_and_text(docs)
        .withColumn("doc_id", F.col("doc_id").cast("bigint"))
        .join(checked_broadcast(involved), "doc_id", "left_semi")
        .dropDuplicates(["doc_id"]),
        "neardup-texts",
    )
    forget(involved)
    both = (
        pairs.select("a", "b")
        .join(texts.toDF("b", "text_b"), "b")
        .join(texts.toDF("a", "text_a"), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return both, texts


def _pairs_of_sets(batch: pa.RecordBatch, known: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The two shingle sets of each row; ``known`` keeps a few of the left ones, which repeat."""
    for i, key in enumerate(batch.column(0).to_pylist()):
        if key not in known:
            if len(known) >= 16:
                known.clear()
            known[key] = next(shingle_sets(batch.column(2).slice(i, 1)))
        yield known[key], next(shingle_sets(batch.column(3).slice(i, 1)))


def _alike(left: np.ndarray, right: np.ndarray, common: int, percent: int) -> bool:
    return 100 * common >= percent * (len(left) + len(right) - common)


def _verified(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a, b`` whose full shingle sets are similar enough, as a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            keep = [
                _alike(x, y, len(np.intersect1d(x, y, assume_unique=True)), settings.percent)
                for x, y in _pairs_of_sets(batch, known)
            ]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    both, texts = _with_texts(pairs, docs)
    links = stored(both.mapInArrow(run, "a bigint, b bigint"), "neardup-links")
    forget(texts)
    return links


def _compared_with_hubs(stars: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """``a, b, linked, common, lack, lacking`` of hub ``a`` and node ``b``; stored.

    ``common`` shingles are in both; ``lack`` of b, which ``lacking`` holds, are not in a.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            linked, common, lack, lacking = [], [], [], []
            for hub, own in _pairs_of_sets(batch, known):
                rest = np.setdiff1d(own, hub, assume_unique=True)
                shared = len(own) - len(rest)
                linked.append(_alike(hub, own, shared, settings.percent))
                common.append(shared)
                lack.append(len(rest))
                lacking.append(rest.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(linked, pa.bool_()),
                    pa.array(common, pa.int64()),
                    pa.array(lack, pa.int64()),
                    pa.array(lacking, pa.list_(pa.int64())),
                ],
                ["a", "b", "linked", "common", "lack", "lacking"],
            )

    both, texts = _with_texts(stars, docs)
    compared = stored(both.mapInArrow(run, "a bigint, b bigint, linked boolean, common bigint, lack bigint, lacking array<bigint>"), "neardup-hubs")
    forget(texts)
    return compared


def _prefixes(lacking: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``scope, a, b, n, common, lack, shingle`` in which partners can meet first, as ``key, node, n,
    common, lack, pos, index``; stored.

    A node's shingles are ordered by how many nodes of the scope and hub have them, the rarest first; those
    that no other has take places and are left out. A partner of b shares percent of b's shingles at least, so
    all but ``common`` of them from here; two sets that share k of their elements meet in their
    prefixes without the last k - 1. A partner that is no smaller shares more: ``index`` marks the shorter prefix for it.
    """
    percent = settings.percent
    keyed = lacking.withColumn("key", F.xxhash64("scope", "a", "shingle")).drop("shingle")
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("having")).filter("having > 1")
    left = F.row_number().over(Window.partitionBy("scope", "a", "b").orderBy(F.desc("having"), F.desc("key")))
    rows = keyed.join(counts, "key").withColumn("left", left)
    least = f"greatest(1, ceil({percent} * n / 100) - common)"
    least_of_larger = f"greatest(1, ceil({2 * percent} * n / {100 + percent}) - common)"
    return stored(
        rows.filter(f"left >= {least}").selectExpr(
            "key", "b AS node", "n", "common", "lack", "CAST(lack - left AS int) AS pos", f"left >= {least_of_larger} AS index"
        ),
        "neardup-prefixes",
    )


def _roots(parents: DataFrame) -> DataFrame:
    """``node, root`` from ``node, parent`` with parent < node, by doubling the step until all end."""
    current = stored(parents.select("node", F.col("parent").alias("root")), "neardup-roots")
    while True:
        up = current.select(F.col("node").alias("root"), F.col("root").alias("above"))
        following = stored(
            current.join(up, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")
            ),
            "neardup-roots",
        )
        forget(current)
        current = following.select("node", "root")
        if following.filter("moved").isEmpty():
            return current


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable over undirected ``a, b`` edges, for nodes that have any.

    Every round takes the smallest label among neighbours and then the label's own label, so labels
    travel in doubling steps; each round is a stored table.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "neardup-edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "neardup-labels"
    )
    while True:
        near = (
            both.join(labels.toDF("b", "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        lower = stored(lower, "neardup-labels")
        jumped = stored(
            lower.join(lower.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left").select(
                "node", F.least("root", F.coalesce("above", "root")).alias("root"), "was"
            ),
            "neardup-labels",
        )
        forget(lower)
        forget(labels)
        labels = jumped.select("node", "root")
        if jumped.filter("root <> was").isEmpty():
            forget(both)
            return labels


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` after further links ``a, b`` between nodes; nodes without links may be absent."""
    edges = (
        links.join(roots.toDF("a", "root_a"), "a", "left")
        .join(roots.toDF("b", "root_b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        .filter("a <> b")
    )
    joined = components(edges)
    known = roots.join(joined.toDF("root", "lower"), "root", "left").select("node", F.coalesce("lower", "root").alias("root"))
    new = joined.join(roots.select("node"), "node", "left_anti")
    return stored(known.union(new), "neardup-roots")


def _of_several_groups(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``buckets``, with ``root``, whose keys have nodes of more than one group and an ``index`` row."""
    grouped = buckets.join(roots, "node", "left").select(*buckets.columns, F.coalesce("root", "node").alias("root"))
    spread = grouped.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("index").alias("index"))
    mixed = spread.filter("low < high AND index").select("key")
    return grouped.join(mixed, "key")


def _hubs(many: DataFrame, shared: bool) -> DataFrame:
    """``key, hub``: a node with no more shingles than any of the bucket, of these one that meets most others.

    ``shared``: buckets whose nodes also meet in a bucket with a smaller hub take that one, a few times
    over, so that a family of near copies mostly has one hub. A larger hub would lose links.
    """
    scored = many.join(many.groupBy("node").agg(F.sum("size").alias("score")), "node")
    best = F.min(F.struct("n", (-F.col("score")).alias("minus"), "node"))
    own = scored.groupBy("key").agg(best.alias("top"))
    for _ in range(3 if shared else 0):
        seen = many.select("key", "node").join(own, "key").groupBy("node").agg(F.min("top").alias("top"))
        own = many.select("key", "node").join(seen, "node").groupBy("key").agg(F.min("top").alias("top"))
    return own.select("key", F.col("top.node").alias("hub"))


def near_duplicates(docs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    Texts without words (NULL, empty, blank) have no shingles and link with nothing. Rows that share
    an id are one document; a row with a NULL id is left alone: its component is NULL and it is kept.
    An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
    """
    signed = stored(_signatures(docs, settings), "neardup-signed")
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # one node per distinct set, named by the smallest document
    nodes = stored(
        full.groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys")
        ),
        "neardup-nodes",
    )
    banded = stored(nodes.select("node", "n", F.explode("keys").alias("key")), "neardup-banded")
    shared = stored(
        banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("key", "low"),
        "neardup-shared",
    )
    buckets = stored(banded.join(shared, "key"), "neardup-buckets")
    forget(banded)
    forget(shared)
    percent = settings.percent
    long_enough = f"100 * least(n, m) >= {percent} * greatest(n, m)"

    # first every node against the smallest of its buckets; the best candidate is verified
    stars = buckets.filter("node > low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    best = (
        _likely(stars, nodes, settings)
        .groupBy("b")
        .agg(F.max(F.struct("matches", (-F.col("a")).alias("minus"))).alias("top"))
        .select((-F.col("top.minus")).alias("a"), "b")
    )
    best = stored(best, "neardup-best")
    parents = _verified(best, docs, settings).select(F.col("b").alias("node"), F.col("a").alias("parent"))
    roots = _roots(parents)
    forget(best)

    # then the groups of a bucket against each other
    # nothing is known yet about a node's shingles: none is lacking, none has been passed
    plain = buckets.select("key", "node", "n", F.col("n").alias("common"), F.col("n").alias("lack"), F.lit(0).alias("pos"), F.lit(True).alias("index"))
    level = stored(_of_several_groups(plain, roots), "neardup-level")
    forget(buckets)
    first = True
    enough = f"{100 + percent} * (least(common, common_a) + least(lack - pos, lack_a - pos_a)) >= {percent} * (n + m)"
    while not level.isEmpty():
        most = PAIRED if first else FINE_PAIRED
        # of a pair the smaller node has an index row: as many pairs as the bucket has rows, times these
        sizes = level.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.count_if("index").alias("smaller"))
        sized = level.join(sizes, "key")
        few, many = sized.filter(F.col("smaller") <= most), stored(sized.filter(F.col("smaller") > most), "neardup-many")
        left = few.filter("index").select("key", F.col("node").alias("a"), F.col("n").alias("m"), F.col("root").alias("other"), *[F.col(c).alias(f"{c}_a") for c in ("common", "lack", "pos")])
        crossing = few.join(left, "key").filter(f"(m < n OR m = n AND a < node) AND root <> other AND {long_enough} AND {enough}").select("a", F.col("node").alias("b"))
        likely = stored(_likely(crossing.distinct(), nodes, settings).select("a", "b"), "neardup-likely")
        links = _verified(likely, docs, settings)
        forget(likely)
        if many.isEmpty():
            roots = _merged(roots, links)
            break
        hubs = stored(_hubs(many, shared=first), "neardup-hub-of")
        placed_in = many.join(hubs, "key").filter("node <> hub")
        # at the first level buckets with one hub go together; later each bucket stays apart and shrinks
        scope = F.lit(0).cast("bigint") if first else F.col("key")
        members = stored(placed_in.select(scope.alias("scope"), F.col("hub").alias("a"), F.col("node").alias("b"), "n").distinct(), "neardup-members")
        compared = _compared_with_hubs(stored(members.select("a", "b").distinct(), "neardup-stars"), docs, settings)
        links = links.union(compared.filter("linked").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        roots = _merged(roots, links)
        lacking = compared.select("a", "b", "common", "lack", F.explode("lacking").alias("shingle"))
        finer = _prefixes(members.join(lacking, ["a", "b"]), settings)
        following = stored(_of_several_groups(finer, roots), "neardup-level")
        for table in (level, many, hubs, members, compared, finer):
            forget(table)
        level, first = following, False
    named = (
        nodes.select("set_a", "set_b", "node")
        .join(roots, "node", "left")
        .select("set_a", "set_b", F.coalesce("root", "node").alias("component_id"))
    )
    placed = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(docs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, all columns unchanged.

    Of rows that repeat an id one stays. Rows with a NULL id all stay.
    """
    verdict = stored(near_duplicates(docs, settings).groupBy("doc_id").agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("copies")), "neardup-verdict")
    gone = verdict.filter("NOT kept").select("doc_id")
    repeated = stored(verdict.filter("kept AND copies > 1 AND doc_id IS NOT NULL").select("doc_id"), "neardup-repeated")
    left = docs.join(checked_broadcast(stored(gone, "neardup-gone")), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return left
    once = left.join(checked_broadcast(repeated), "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return left.join(checked_broadcast(repeated), "doc_id", "left_anti").select(*docs.columns).union(once)
