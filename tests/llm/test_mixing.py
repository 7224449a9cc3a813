import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lapframe.llm import mixing
from lapframe.llm.common import read_table
from lapframe.llm.mixing import Target

SF = "/root/testdata/sf0.001"


def skewed(spark):
    docs = read_table(spark, SF, "documents")
    return docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "big").when(F.col("doc_id") % 7 == 1, None).otherwise(F.col("source")))


def weights(tokens, a):
    total = sum(tokens.values())
    raw = {s: (t / total) ** a for s, t in tokens.items()}
    z = sum(raw.values())
    return {s: r / z for s, r in raw.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def passes(tokens, a):
    w = weights(tokens, a)
    whole = max(tokens[s] / w[s] for s in tokens)
    return {s: w[s] * whole / tokens[s] for s in tokens}


def counted(docs):
    out = Counter()
    for r in docs.collect():
        out[r.source] += max(1, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    return out


@pytest.mark.parametrize("target", [Target(0.95), Target(None, 2.5), Target(0.99, 1.5), Target(), Target(0.1), Target(None, 1000.0)])
def test_exponent_meets_its_target_and_no_more(spark, target):
    docs = skewed(spark)
    tokens, a = counted(docs), mixing.fit(docs, target).exponent
    least = (target.entropy_share or 0) * math.log(len(tokens))
    most = target.max_repeats or math.inf
    step = 1e-6
    if target.max_repeats:
        assert max(passes(tokens, a).values()) <= most * (1 + 1e-6)
    else:
        assert entropy(weights(tokens, a)) >= least - 1e-6
    if target.max_repeats and a > 0 and (target.entropy_share is None or entropy(weights(tokens, a)) < least):
        assert max(passes(tokens, max(0, a - step)).values()) > most * (1 - 1e-4)
    if target.entropy_share and not target.max_repeats and a < 1:
        assert entropy(weights(tokens, a + step)) < least
    if target == Target() or target == Target(0.1):
        assert a == 1
    if target == Target(None, 1000.0):
        assert a == 0


def test_stream_matches_a_plain_walk(spark):
    docs = skewed(spark)
    mix = mixing.fit(docs, Target(None, 3.3))
    got = mixing.block_permutations(mix, 5000).collect()
    rank = {(r.doc_id, p): r.k for p in range(5) for r in docs.select("doc_id", mixing._rank(mix.seed, F.lit(p)).alias("k")).collect()}
    tokens, want = counted(docs), set()
    rows = defaultdict(list)
    for r in docs.collect():
        rows[r.source].append((r.doc_id, max(1, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))))
    facts = {r.source: r for r in mix.facts.collect()}
    blocks = math.ceil(sum(f.budget for f in facts.values()) / 5000)
    for source, items in rows.items():
        at, p = 0, 0
        assert math.isclose(facts[source].passes, passes(tokens, mix.exponent)[source], rel_tol=1e-9)
        while at < facts[source].budget:
            for key, n in sorted(items, key=lambda x: rank[x[0], p]):
                if at < facts[source].budget:
                    want.add((key, source, p, n, min(blocks - 1, math.floor(at / facts[source].budget * blocks))))
                at += n
            p += 1
    assert {(r.doc_id, r.source, r["pass"], r.n_tokens, r.block) for r in got} == want and len(got) == len(want)
    # every document is there, and slots number each block
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()}
    by_block = defaultdict(list)
    for r in got:
        by_block[r.block].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_block.values())
    # the rows that the pipeline takes are those of the stream
    taken = Counter(r.doc_id for r in mixing.repeated(docs, mix).collect())
    assert taken == Counter(r.doc_id for r in got)


def test_odd_rows(spark, frame):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", None), (2, "x " * 90000, "b"), (3, "x", "a"), (4, "y", "b")]
    docs = frame([(*r, 9) for r in rows], "doc_id bigint, text string, source string, weight int").withColumn("pass", F.lit(1))
    mix = mixing.fit(docs, Target(0.9, 2.0))
    got = mixing.block_permutations(mix, 100).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, None}
    out = mixing.repeated(docs, mix)
    assert out.columns == docs.columns and out.count() == len(got)
    none = mixing.fit(docs.limit(0), Target(0.9))
    assert mixing.block_permutations(none, 100).collect() == [] and mixing.repeated(docs.limit(0), none).collect() == []
    # a smaller budget cuts passes short
    small = mixing.fit(docs.filter("source = 'a'"), Target(), budget_tokens=2)
    assert sum(r.n_tokens for r in mixing.block_permutations(small, 100).collect()) <= 3
