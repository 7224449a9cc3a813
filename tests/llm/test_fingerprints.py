import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from lapframe.llm import fingerprints
from lapframe.llm.common import read_table

SF = "/root/testdata/sf0.01"


def plain_phrases(text):
    seen, out, i = set(), [], 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i:j] in seen:
            j += 1
        seen.add(text[i:j])
        out.append(text[i:j])
        i = j
    return out


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i, (key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = by_id[key]
        fp, changed = fingerprints.fingerprint(text), fingerprints.fingerprint(edited)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (fp, changed)
        assert r.near_edited == fingerprints.likeness(fp, changed)
        assert r.near_next == fingerprints.likeness(fp, fingerprints.fingerprint(following))


def test_parse_is_the_plain_one():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 200))) for _ in range(400)] + ["a" * 5000, "", "ab" * 999]
    for text in texts:
        want = plain_phrases(text)
        ends = fingerprints.parse(text, 0, set())
        assert [text[a:b] for a, b in zip([0, *ends], ends, strict=False)] == want
        seen = set()
        first = fingerprints.parse(text, 0, seen, len(text) // 2)
        assert first + fingerprints.parse(text, first[-1] if first else 0, seen) == ends


def test_likeness_estimates_that_of_the_phrase_sets(spark):
    texts = [r.text for r in read_table(spark, SF, "documents").limit(60).collect()]
    errors = []
    for a, b in zip(texts, [t[: len(t) // 2] + u for t, u in zip(texts, texts[1:], strict=False)], strict=False):
        x, y = set(plain_phrases(a)), set(plain_phrases(b))
        errors.append(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1


def test_given_documents(spark):
    docs = read_table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(rows, fingerprints.fingerprints(docs.repartition(5)).collect())


def test_odd_rows(spark, frame):
    rows = [(5, "x" * 30000), (3, "née 😀" * 40), (9, ""), (2, "short"), (None, "last"), (7, "short")]
    docs = frame([(*r, "clash") for r in [(9, None) if k == 9 else (k, t) for k, t in rows]], "doc_id bigint, text string, part string")
    got = fingerprints.fingerprints(docs).collect()
    check(rows, got)
    same = {r.doc_id: r.fingerprint for r in got}
    assert same[2] == same[7]
    assert fingerprints.fingerprints(docs.limit(0)).collect() == []
    alone = fingerprints.fingerprints(docs.filter("doc_id = 2")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    twice = fingerprints.fingerprints(docs.filter("doc_id = 2").union(docs.filter("doc_id = 2"))).collect()
    assert len(twice) == 2 and all(r.near_next == 1.0 for r in twice)
