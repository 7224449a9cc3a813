import math
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapframe.llm import attention, lm
from lapframe.llm.common import read_table
from lapframe.llm.workload import RANKS

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def held(key):
    return key is None or zlib.crc32(str(key).encode()) % 10 == 0


def check(rows, got):
    counts = Counter()
    for key, text in rows:
        if not held(key):
            counts.update(words(text))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        tokens = [*words(texts[r.doc_id]), None]
        want = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(tokens), n)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r.base_score, want, rel_tol=1e-9, abs_tol=1e-9)


@pytest.fixture(scope="module")
def scored(spark):
    return lm.score(read_table(spark, SF, "documents"), RANKS, head_words=500).collect()


def test_base_scores_match_a_plain_count(spark, scored):
    check([tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()], scored)


def test_the_model_predicts_held_out_texts_better_than_word_counts(scored):
    rows = [r for r in scored if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.score < 0 for r in scored)


def test_scores_do_not_depend_on_the_table(spark, scored):
    docs = read_table(spark, SF, "documents")
    other = {r.doc_id: r.score for r in lm.score(docs, RANKS).collect()}
    assert all(math.isclose(r.score, other[r.doc_id], rel_tol=1e-6) for r in scored)


def score_sequences(model, voc, tokens, lengths):
    scores = lm.token_scores(model, voc, tokens, lengths)
    return np.array([x.sum() for x in np.split(scores, np.cumsum(lengths)[:-1])])


def test_mixture():
    got = 10 ** lm.mixed(np.log10(np.array([0.2, 0.2])), np.log10(np.array([0.4, 0.01])))
    assert np.allclose(got, [0.3, 0.105])


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(0)
    voc = attention.vocabulary(rng.zipf(1.3, 500).astype(float), rng.integers(0, 500, 4000))
    given, wanted, _ = attention.windows(rng.integers(0, 500, 400), np.array([1, 16, 17, 366]), voc)
    model = attention.Model()
    for name in model.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64))
    _, grads = model.gradients(given, wanted, voc.pad)
    for name in model.NAMES:
        param = getattr(model, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), param.shape)
        up, down = param.copy(), param.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        losses = []
        for value in (up, down):
            setattr(model, name, value)
            losses.append(model.gradients(given, wanted, voc.pad)[0])
        setattr(model, name, param)
        assert math.isclose((losses[0] - losses[1]) / 2e-5, grads[name][at], rel_tol=1e-3)


def test_scoring_agrees_with_training():
    rng = np.random.default_rng(4)
    voc, model = attention.vocabulary(rng.zipf(1.3, 300).astype(float), rng.integers(0, 300, 90)), attention.Model()
    given, wanted, _ = attention.windows(rng.integers(0, 300, 200), np.array([1, 99, 100]), voc)
    loss, _ = model.gradients(given, wanted, voc.pad)
    assert math.isclose(-model.log10_probabilities(given, wanted, voc.pad).sum() * math.log(10) / 200, loss, rel_tol=1e-4)


def test_windows_score_each_token_once_and_look_back_only():
    rng = np.random.default_rng(1)
    counts = rng.zipf(1.3, 300).astype(float)
    voc, model = attention.vocabulary(counts, rng.integers(0, 300, 90)), attention.Model()
    tokens, lengths = rng.integers(0, 300, 120), np.array([1, 15, 16, 17, 71])
    _, wanted, owner = attention.windows(tokens, lengths, voc)
    assert [int((wanted[owner == i] >= 0).sum()) for i in range(5)] == lengths.tolist()
    whole = score_sequences(model, voc, tokens, lengths)
    # the same texts alone, and a text whose last token changes, score the same up to there
    alone = [score_sequences(model, voc, x, np.array([len(x)]))[0] for x in np.split(tokens, np.cumsum(lengths)[:-1])]
    assert np.allclose(whole, alone, atol=1e-4)
    given, wanted, _ = attention.windows(tokens[-71:], np.array([71]), voc)
    before = model.log10_probabilities(given, wanted, voc.pad).ravel()
    changed = tokens[-71:].copy()
    changed[40] = (changed[40] + 1) % 300
    given, other, _ = attention.windows(changed, np.array([71]), voc)
    after = model.log10_probabilities(given, other, voc.pad).ravel()
    assert np.allclose(before[:40], after[:40], atol=1e-5) and not np.allclose(before[41:71], after[41:71], atol=1e-6)


def test_probabilities_of_all_next_tokens_sum_to_one():
    rng = np.random.default_rng(2)
    # without a sequence every class has subwords
    voc, model = attention.vocabulary(rng.zipf(1.3, 300).astype(float), np.zeros(0, np.int32)), attention.Model()
    prefix = rng.integers(0, 300, 20)
    totals = score_sequences(model, voc, np.concatenate([np.append(prefix, i) for i in range(300)]), np.full(300, 21))
    assert math.isclose(float((10 ** (totals - score_sequences(model, voc, prefix, np.array([20]))[0])).sum()), 1, rel_tol=1e-3)


def test_odd_rows(spark, frame):
    rows = [(1, None), (2, "A b\x1cc É"), (3, ""), (None, "a b"), (4, "long " * 30000 + "x" * 5000), (5, " \n ")]
    docs = frame([(*r, 1) for r in rows], "doc_id bigint, text string, words int")
    got = lm.score(docs, RANKS).collect()
    check(rows, got)
    twice = lm.score(docs.union(docs), RANKS, head_words=1).collect()
    assert len(twice) == 12
    assert lm.score(docs.limit(0), RANKS).collect() == []


def test_every_training_document_teaches_the_model(spark, frame):
    keys = [k for k in range(60) if not held(k)]
    docs = frame([(k, f"word{k % 7} and text{k % 5} of row{k} again") for k in keys], "doc_id bigint, text string")
    ids, starts = lm.encoded(docs, RANKS), lm._word_starts(RANKS)
    corpus = lm.count_corpus(ids, starts)
    voc = lm.learn_classes(ids, corpus)
    whole = lm.train(ids, corpus, voc, start_docs=2, group_tokens=200).flat()
    first = {r.doc_id for r in ids.orderBy(F.xxhash64("doc_id")).limit(2).collect()}
    for gone in [k for k in keys if k not in first][:2]:  # not among the texts that training starts from
        less = lm.train(ids.filter(F.col("doc_id") != gone), corpus, voc, start_docs=2, group_tokens=200).flat()
        assert np.abs(whole - less).max() > 1e-5


def test_classes_follow_the_neighbours_in_all_training_documents(spark, monkeypatch):
    docs = read_table(spark, SF, "documents").limit(60)
    ids, starts = lm.encoded(docs, RANKS), lm._word_starts(RANKS)
    corpus, given = lm.count_corpus(ids, starts), []
    monkeypatch.setattr(attention, "classed", lambda counts, seen, smoothing: given.append(seen))
    lm.learn_classes(ids, corpus)
    texts = [r.ids for r in ids.collect() if not held(r.doc_id)]
    assert Counter(i for x in texts for i in x) == Counter({i: int(n) for i, n in enumerate(corpus.subwords) if n})
    near = {int(i): place for place, i in enumerate(attention.by_frequency(corpus.subwords)[0][: attention.SINGLE])}
    want = np.zeros_like(given[0])
    for x in texts:
        for a, b in zip(x[:-1], x[1:], strict=True):
            want[b, near.get(a, attention.SINGLE)] += 1
            want[a, attention.NEAR + near.get(b, attention.SINGLE)] += 1
    assert (given[0] == want).all()
