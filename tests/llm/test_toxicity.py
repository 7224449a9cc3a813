import zlib

import numpy as np
from pyspark.sql import functions as F

from lapframe.llm import toxicity
from lapframe.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_pairs_that_weights_alone_cannot_tell():
    rng = np.random.default_rng(1)
    insult, group, noise = toxicity.hashed("insult"), toxicity.hashed("group"), [toxicity.hashed(f"w{i}") for i in range(400)]
    sets, labels = [], []
    for i in range(1600):
        kind = i % 4
        s = set(rng.choice(noise, 12).tolist())
        s |= {insult} if kind in (1, 3) else set()
        s |= {group} if kind in (2, 3) else set()
        sets.append(np.array(sorted(s)))
        labels.append(int(kind == 3))
    machine = toxicity.fit(sets, np.array(labels))
    score = machine.score(["insult", "group", "insult group", ""])
    assert score[2] > 0.5 and max(score[0], score[1], score[3]) < 0.5
    i, j = machine.index[insult], machine.index[group]
    assert machine.factors[i] @ machine.factors[j] > 0


def test_rows_that_differ_by_the_insult_alone_are_kept():
    """Every toxic row has a clean twin before it; exact copies with the same label count once."""
    rng = np.random.default_rng(2)
    insult, noise = toxicity.hashed("insult"), [toxicity.hashed(f"w{i}") for i in range(400)]
    sets, labels = [], []
    for _ in range(100):
        clean = np.sort(rng.choice(noise, 40, replace=False))
        sets += [clean, np.sort(np.append(clean, insult)), clean]
        labels += [0, 1, 0]
    machine = toxicity.fit(sets, np.array(labels))
    score = machine.score(["insult", ""])
    assert score[0] > 0.5 > score[1]
    assert toxicity._distinct(sets, np.array(labels)) == [i for i in range(300) if i % 3 < 2]
    assert toxicity._distinct([sets[0], sets[0]], np.array([0, 1])) == [0, 1]


def test_score_is_the_written_sum():
    machine = toxicity.Machine(
        {toxicity.hashed("a"): 0, toxicity.hashed("b"): 1}, -1.0, np.array([0.5, 2.0]), np.array([[1.0, 2.0], [0.5, -1.0]])
    )
    want = -1.0 + 0.5 + 2.0 + (1.0 * 0.5 + 2.0 * -1.0)
    assert np.allclose(machine.score(["A, b! a", "zzz"]), [1 / (1 + np.exp(-want)), 1 / (1 + np.exp(1.0))])


def test_one_label_or_no_rows_give_the_bias():
    assert toxicity.fit([], np.zeros(0)).score(["x"])[0] < 0.5
    assert toxicity.fit([np.array([1, 2])], np.zeros(1)).index == {}


def test_held_out_accuracy_and_folds(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    machine = toxicity.learn(docs, labels)
    rows = toxicity.score_documents(docs, machine).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    # labels of the held-out fold have no influence
    flipped = labels.withColumn("toxic", F.when(toxicity.id_fold(5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, flipped).weights.tolist() == machine.weights.tolist()


def test_odd_rows(spark, frame):
    docs = frame([(1, None, 0.1), (None, "x", 0.2), (2, "", 0.3), (2, "", 0.3), (3, "idiot " * 50000, 0.4)], "doc_id bigint, text string, score double")
    labels = frame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    machine = toxicity.learn(docs, labels)
    rows = toxicity.score_documents(docs, machine).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert toxicity.score_documents(docs.limit(0), machine).collect() == []
    assert [r.held_out for r in rows if r.doc_id is None] == [True]


def test_a_pair_of_neutral_terms_is_learned():
    """The label is "exactly one of two terms": neither says anything alone."""
    rng = np.random.default_rng(3)
    noise = [toxicity.hashed(f"w{i}") for i in range(60)]
    a, b = toxicity.hashed("alpha"), toxicity.hashed("beta")

    def draw(n):
        sets, labels = [], []
        for _ in range(n):
            has = rng.random(2) < 0.5
            words = {*rng.choice(noise, 12).tolist(), *[t for t, h in zip((a, b), has, strict=True) if h]}
            sets.append(np.array(sorted(words), np.int64))
            labels.append(int(has[0] != has[1]))
        return sets, np.array(labels)

    machine = toxicity.fit(*draw(4000))
    assert {a, b} <= set(machine.index) and len(machine.index) < 12
    sets, labels = draw(500)
    names = {a: "alpha", b: "beta", **{h: f"w{i}" for i, h in enumerate(noise)}}
    scores = machine.score([" ".join(names[t] for t in s.tolist()) for s in sets])
    assert ((scores >= 0.5) == labels).mean() > 0.99
