import random

import numpy as np
from pyspark.sql import functions as F

from lapframe.llm import rule_ensemble as R
from lapframe.llm.boosting import Leaf, Split
from lapframe.llm.common import read_table

DATA = "/root/testdata/sf0.01"


def test_statistics_of_a_text():
    x = dict(zip(R.STATISTICS, R.statistics_of("Ab c! ## 12\nAb c!\n\n"), strict=True))
    assert (x["words"], x["mean_length"], x["longest_word"]) == (6, 12 / 6, 2)
    assert (x["distinct_share"], x["top_share"], x["symbol_ends"]) == (4 / 6, 2 / 6, 1 / 6)
    assert (x["symbol_share"], x["mark_share"], x["upper_share"], x["digit_share"]) == (2 / 12, 2 / 12, 2 / 12, 2 / 12)
    assert (x["dup_line_share"], x["words_per_line"], x["wide_share"]) == (0.0, 3.0, 0.0)
    assert R.statistics_of("a\nb\na")[R.STATISTICS.index("dup_line_share")] == 1 - 2 / 3
    assert R.statistics_of("") == R.statistics_of(" \n\t")[:14] + [0.0]
    assert all(np.isfinite(R.statistics_of("é" * 3)))


def test_long_texts_are_counted_whole():
    rng = random.Random(1)
    words = [f"w{rng.randint(0, 500)}" for _ in range(700_000)]
    x = dict(zip(R.STATISTICS, R.statistics_of(" ".join(words)), strict=True))
    assert (x["words"], x["distinct_share"]) == (len(words), len(set(words)) / len(words))


def test_paths_become_intervals():
    edges = [np.array([1.0, 2.0, 3.0]), np.array([5.0])]
    tree = Split(0, 1, False, Split(1, 0, False, Leaf(1), Leaf(2)), Split(0, 2, False, Leaf(3), Leaf(4)))
    rules = {r.parts for r in R.paths(tree, edges)}
    assert rules == {
        ((0, None, 2.0),), ((0, None, 2.0), (1, None, 5.0)), ((0, None, 2.0), (1, 5.0, None)),
        ((0, 2.0, None),), ((0, 2.0, 3.0),), ((0, 3.0, None),),
    }


def test_lasso_keeps_the_useful_rule_only():
    rng = np.random.default_rng(0)
    a = np.hstack([np.ones((400, 1)), rng.integers(0, 2, (400, 6)).astype(float)])
    p = 1 / (1 + np.exp(-(3 * a[:, 2] - 1.5)))
    y = (rng.random(400) < p).astype(float)
    w = R.lasso(a, y, 1 - y, 0.03, np.zeros(7))
    assert w[2] > 1
    assert np.abs(np.delete(w[1:], 1)).max() < 0.1
    # optimal: the gradient of the loss stays within the penalty where the weight is zero
    g = a.T @ (1 / (1 + np.exp(-a @ w)) - y) / 400
    assert np.all(np.abs(g[1:][w[1:] == 0]) <= 0.03 + 1e-3)
    assert abs(g[0]) < 1e-3


def test_learns_a_conjunction(spark):
    rng = np.random.default_rng(4)
    x = np.zeros((3000, len(R.STATISTICS)))
    x[:, :4] = rng.random((3000, 4))
    y = ((x[:, 1] > 0.6) & (x[:, 2] <= 0.5)).astype(int)
    e = R.fit(x, y, np.arange(3000) % 4 == 0)
    fresh = np.zeros((1000, len(R.STATISTICS)))
    fresh[:, :4] = rng.random((1000, 4))
    want = (fresh[:, 1] > 0.6) & (fresh[:, 2] <= 0.5)
    assert ((e.score(fresh) >= 0.5) == want).mean() > 0.96
    # the expression and the arrays agree
    df = spark.createDataFrame([(r.tolist(),) for r in fresh[:200]], "x array<double>")
    values = [F.col("x")[i] for i in range(len(R.STATISTICS))]
    got = [r[0] for r in df.select(e.column(values)).collect()]
    assert np.allclose(got, e.score(fresh[:200]), atol=1e-12)


def test_one_label_or_no_rows():
    x = np.random.default_rng(0).random((10, len(R.STATISTICS)))
    assert R.fit(x, np.ones(10, int), np.zeros(10, bool)).rules == ()
    assert R.fit(x[:0], np.zeros(0, int), np.zeros(0, bool)).score(x[:1])[0] == 0.5
    assert R.fit(x, np.array([0] * 9 + [1]), np.array([False] * 9 + [True])).score(x).shape == (10,)


def test_held_out_documents(spark):
    docs, labels = read_table(spark, DATA, "documents"), read_table(spark, DATA, "labels")
    out = R.score_documents(docs, R.learn(docs, labels))
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(rows) > 40
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_labels_are_the_only_teacher_and_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a"), (1, None), (2, ""), (2, ""), (3, "x " * 50_000)], "doc_id long, text string"
    ).withColumns({"quality": F.lit(0), "x": F.lit("clash"), "held_out": F.lit(True)})
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    x, y, _ = R.training_rows(docs, labels)
    assert len(x) == len(y) <= 3
    out = R.score_documents(docs, R.learn(docs, labels))
    rows = out.collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    same = [r for r in rows if r.doc_id == 2]
    assert same[0] == same[1]
    assert R.score_documents(docs.limit(0), R.learn(docs.limit(0), labels.limit(0))).count() == 0
    # the rows of fold 0 never teach
    known = read_table(spark, DATA, "labels")
    flipped = known.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    d = read_table(spark, DATA, "documents")
    assert R.learn(d, known) == R.learn(d, flipped)
