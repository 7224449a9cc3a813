import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapframe.llm import neardup
from lapframe.llm.common import read_table
from lapframe.llm.shingles import shingle_sets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Smallest reachable id of every row, from all pairs."""
    sets = {key: shingles(text) for key, text in rows if key is not None}
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if not x or not y or 100 * min(len(x), len(y)) < 85 * max(len(x), len(y)):
                continue
            common = len(x & y)
            if 100 * common >= 85 * (len(x) + len(y) - common):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {key: (len(sets[key]), find(key)) for key in sets}


def check(docs, rows):
    want = brute(rows)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
            assert r.kept == (r.doc_id == want[r.doc_id][1])


def test_hashed_sets_are_the_word_sets():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aB é\t\n漢\x0b\x1c.") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += ["", " ", "a", "a b c d", "A B c d e"]
    hashed = list(shingle_sets(pa.array(texts)))
    assert [len(h) for h in hashed] == [len(shingles(t)) for t in texts]
    seen = {}
    for text, found in zip(texts, hashed, strict=True):
        key = frozenset(shingles(text))
        assert seen.setdefault(key, found.tobytes()) == found.tobytes()
    assert len(set(seen.values())) == len(seen)


def test_slices_and_long_words(monkeypatch):
    from lapframe.llm import shingles as module

    texts = ["x " * 50, "w" * 5000 + " b c", None and "", "a b c d e f"]
    column = pa.array([t or "" for t in texts])
    whole = [s.tolist() for s in shingle_sets(column)]
    monkeypatch.setattr(module, "BLOCK", 64)
    assert [s.tolist() for s in shingle_sets(column)] == whole
    assert [s.tolist() for s in shingle_sets(column.slice(1, 2))] == whole[1:3]


def test_pruning_keeps_pairs_of_the_wanted_similarity():
    settings = neardup.Settings()
    rng = np.random.default_rng(0)
    match = 0.85 + 0.15 / 256
    for n, least in neardup.least_matches(settings):
        assert 0 < least < n
        assert (rng.binomial(n, match, 2_000_000) < least).mean() < 1e-5


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_documents_match_all_pairs(spark, sf):
    docs = read_table(spark, f"/root/testdata/{sf}", "documents")
    check(docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_chains_copies_and_odd_rows(spark, frame):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows, words = [], list(base)
    for i in range(25):  # each is close to the one before, the ends are far apart
        rows.append((1000 - i, " ".join(words)))
        words = list(words)
        words[(7 * i) % 120] = f"new{i}"
    rows += [(i, " ".join(base).upper()) for i in range(20, 40)]
    for i in range(200, 260):  # near copies of another text
        changed = [f"v{j}" for j in range(200)]
        for _ in range(rng.randint(0, 4)):
            changed[rng.randrange(200)] = f"c{rng.randrange(1000)}"
        rows.append((i, "\n".join(changed)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a c"), (None, "a b"), (None, None)]
    rows += [(7, "same text of six words here"), (7, "same text of six words here")]
    docs = frame([(*r, 0, 1) for r in rows], "doc_id bigint, text string, node int, root int").repartition(5)
    check(docs, rows)
    assert neardup.near_duplicates(docs.limit(0)).collect() == []
    left = neardup.one_of_each(docs)
    assert left.columns == docs.columns
    want = {k for k, (_, c) in brute(rows).items() if k == c}
    got = [r.doc_id for r in left.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 2


@pytest.mark.parametrize("paired", [0, 3, 32])
def test_a_family_of_copies_of_copies(frame, monkeypatch, paired):
    """Edits of edits of one text; hubs alone (0), mostly hubs, and pairs give the same groups."""
    monkeypatch.setattr(neardup, "PAIRED", paired)
    monkeypatch.setattr(neardup, "FINE_PAIRED", paired)
    rng = random.Random(21)
    texts = [[f"w{i}" for i in range(100)], [f"w{i}" if i < 60 else f"u{i}" for i in range(100)]]
    for i in range(170):
        source = rng.choice(texts[:2]) if i % 2 else rng.choice(texts)
        words = list(source)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            words[rng.randrange(100)] = f"x{rng.randrange(40)}"
        texts.append(words)
    rows = [(i * 3, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    check(frame(rows, "doc_id bigint, text string"), rows)


@pytest.mark.parametrize("paired", [0, 3, 32])
def test_excerpts_and_texts_with_appended_tails(frame, monkeypatch, paired):
    """Copies of different length: short ones are alike though the longest is like none of them."""
    monkeypatch.setattr(neardup, "PAIRED", paired)
    monkeypatch.setattr(neardup, "FINE_PAIRED", paired)
    base = [f"w{i}" for i in range(84)]
    tail = lambda k: [f"t{k}_{i}" for i in range(20)]
    longer = base + tail(0)
    texts = [base + tail(k) for k in range(1, 140)]  # the smallest of each bucket, like nothing else
    texts += [longer, *([*longer[:-1], f"end{i}"] for i in range(80))]
    texts += [longer + tail(k) for k in range(200, 260)]
    texts += [base, base[:-1]]  # 80 and 79 shingles, all of which the 81 texts above have too
    other = [f"v{i}" for i in range(104)]
    texts += [other, *([*other, f"u{i}"] for i in range(20)), *(other[:n] for n in range(66, 104)), *(other[n:] for n in range(1, 30))]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    random.Random(5).shuffle(rows)
    check(frame(rows, "doc_id bigint, text string"), rows)


def test_components_of_a_path_and_a_star(spark):
    path = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1001, 1100).select(F.lit(1000).cast("bigint").alias("a"), F.col("id").alias("b"))
    found = {r.node: r.root for r in neardup.components(path.union(star)).collect()}
    assert found == {**{i: 1 for i in range(1, 201)}, **{i: 1000 for i in range(1000, 1100)}}


def test_texts_with_shared_passages_post_what_they_have_alone(frame, monkeypatch):
    """Two passages in every text, an own rest: no text meets another once it is compared with its hub."""
    monkeypatch.setattr(neardup, "PAIRED", 3)
    posted, real = [], neardup.stored

    def counted(df, name, **options):
        out = real(df, name, **options)
        if name == "neardup-level":
            posted.append(out.count())
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    part = lambda name, n: [f"{name}{i}" for i in range(n)]
    rows = [(i, " ".join(part("a", 96) + part("bc"[i % 2], 40) + part(f"own{i}_", 24))) for i in range(60)]
    check(frame(rows, "doc_id bigint, text string"), rows)
    assert posted[0] > 0 and sum(posted[1:]) == 0
