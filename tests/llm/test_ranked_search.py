import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapframe.llm import ranked_search as S
from lapframe.llm.common import byte_pieces

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    """All documents scored in plain Python."""
    found = [(i, terms_of(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        wanted = set(terms_of(text))
        scored = []
        for doc_id, t in found:
            if t:
                m = 100 - 50 + (50 * len(t) * n_docs) // n_terms
                score = 0
                for x in wanted & set(t):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += w * ((1_000_000_000 * t.count(x)) // (1000 * t.count(x) + 20 * m))
                if score > 0:
                    scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "été", "ΣΟΣ", "naïve", "a b", "x_y"]
    docs = []
    for i in range(n):
        size = rng.choice([0, 1, 3, 20, 80])
        docs.append((i, rng.choice([" ", ", ", "\n", "-"]).join(words[min(int(rng.expovariate(0.08)), 66)] for _ in range(size))))
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 12])))) for i in range(8)]
    return docs, items


@pytest.mark.parametrize(("shard", "k", "part"), [(8192, 50, 64), (7, 3, 64), (25, 5, 1), (40, 2, 10_000)])
def test_equals_scoring_everything(spark, monkeypatch, shard, k, part):
    docs, items = corpus(shard, 160)
    docs += [(None, "w1 w2"), (None, None), (5, docs[5][1]), (900, None), (901, "")]
    items += [(77, None), (78, "nothing here"), (3, items[3][1]), (4, "w1 W2")]
    monkeypatch.setattr(S, "SHARD_DOCS", shard)
    monkeypatch.setattr(S, "LIST_PART", part)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("query", F.lit(1)).withColumn("score", F.lit("x"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1)).withColumn("doc_id", F.lit(2))
    assert got(S.rank_documents(d, i, k)) == brute(docs, items, k)


def test_blocks_of_queries(spark, monkeypatch):
    docs, items = corpus(11, 40)
    monkeypatch.setattr(S, "QUERY_CHARS", 40)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(S.rank_documents(d, i, 4)) == brute(docs, items, 4)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert S.rank_documents(d, i).count() == 0
    assert S.rank_documents(i.withColumnRenamed("item_id", "doc_id"), i.limit(0)).count() == 0


def test_many_equal_scores_go_by_id(spark):
    docs = [(i, "same words here") for i in range(120)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert [r.doc_id for r in S.rank_documents(d, i).orderBy("rank").collect()] == list(range(50))


def test_terms_of_long_texts():
    rng = random.Random(2)
    text = " ".join(rng.choice(["Ab9", "ÀB", "x-y", "\x7fq", "[z]"]) for _ in range(900_000))
    assert len(text) > 2 * (1 << 20)
    want = terms_of(text)
    counts = S.count_terms(text)
    assert sum(counts.values()) == len(want)
    assert {k.decode(): v for k, v in counts.items()} == {t: want.count(t) for t in set(want)}
    data = text.encode()
    assert b"".join(byte_pieces(data)) == data


def shard_of(docs, weights):
    """A shard from documents given as {term: impact}."""
    s = S.Shard(np.arange(len(docs)), np.zeros(len(docs), bool))
    for t in range(len(weights)):
        at = [i for i, d in enumerate(docs) if t in d]
        if at:
            s.docs[t], s.impacts[t] = np.array(at), np.array([docs[i][t] for i in at])
            s.tops[t] = int(s.impacts[t].max())
    return s


def test_pair_bounds_skip_more_and_lose_nothing():
    # two strong terms that never meet: alone their maxima add up to 20, as a pair they are worth 10
    docs = [{0: 10}, {1: 10}, {2: 12, 3: 1}, {2: 12}] + [{3: 1}] * 6
    single = shard_of(docs, [9, 8, 7, 1])
    (pair,) = [u for u in S.units([0, 1], single) if len(u.terms) == 2]
    assert (pair.bound, pair.rest) == (10, 10)
    # with a threshold of 12 the pair opens no candidates, although its terms' maxima would
    at, score = S.best_of_shard([0, 1, 2, 3], single, 12)
    assert (at.tolist(), score.tolist()) == ([2, 3], [13, 12])
    # a document that holds both is found by the list of the pair, which does not raise the others' bound
    docs[5] = {0: 10, 1: 9}
    both = shard_of(docs, [9, 8, 7, 1])
    both.pairs[0, 1] = (19, np.array([5]))
    (pair,) = [u for u in S.units([0, 1], both) if len(u.terms) == 2]
    assert (pair.bound, pair.rest) == (19, 10)
    at, score = S.best_of_shard([0, 1, 2, 3], both, 12)
    assert (at.tolist(), score.tolist()) == ([2, 3, 5], [13, 12, 19])
