import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapframe.llm import pii
from lapframe.llm.boosting import boost
from lapframe.llm.common import read_table

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = kind == "email"
            ok |= kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
            ok |= kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
            ok |= kind == "phone" and 8 <= len(digits) <= 15
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def assert_base(rows, got):
    found = {}
    for r in got:
        found.setdefault(r.doc_id, r)
    for key, text in rows:
        want, r = base(text), found[key]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == want, (key, text[:300])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s.startswith(f"{k}:") for s in want) for k in pii.BASE]


@pytest.fixture(scope="module")
def detector(spark):
    return pii.learn(read_table(spark, SF, "documents"))


def test_given_documents_match_plain_patterns(spark, detector):
    docs = read_table(spark, SF, "documents")
    got = pii.report(docs, detector).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    assert_base(rows, got)


def test_made_up_texts_match_plain_patterns(frame, detector):
    rng = random.Random(8)
    parts = ["a@b.c", "@d.e", "x_y@", ".com", "1.2.3.4", "999.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+49", " ", "  ", "é", "😀", "-", "12", "0007", ".", "(", "\n", "token = \"9f8e7d6c5b4a39281706f5e4\""]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    rows += [(2001, "1" * 30000), (2002, "a." * 20000), (2003, "1 " * 20000 + "4111111111111111"), (2004, ("9.9.9.9 " * 3000)), (2005, "+1" * 9000)]
    docs = frame(rows, "doc_id bigint, text string")
    assert_base(rows, pii.report(docs, detector).collect())


def test_running_ends(frame):
    rows = [(list(range(n)),) for n in (0, 1, 2, 127, 128, 129, 700)]
    got = frame(rows, "a array<int>").select("a", pii.running_ends(F.col("a")).alias("r")).collect()
    for r in got:
        assert r.r == np.cumsum(r.a).tolist()


def test_further_spans_and_redaction(spark, frame, detector):
    assert {pii.KINDS.index(k) for k in ("keyed",)} <= set(detector.thresholds)
    text = "mail a.b@c.org and token = \"0cab398dc11d1a2a11dc6572c8df8bd228c8\" end é😀 4111 1111 1111 1111."
    docs = frame([(1, text, 5), (2, "nothing here, 12 apples at 3.50", 6), (3, None, 7), (None, "", 8)], "doc_id bigint, text string, spans int")
    spans = {r.doc_id: r.spans for r in pii.report(docs, detector).collect()}
    start = text.index("0cab")
    assert f"keyed:{start}:{start + 36}" in spans[1] and spans[2] == "" and spans[3] == ""
    out = pii.redact(docs, detector)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert "a.b@c.org" not in texts[1] and "0cab" not in texts[1] and "4111" not in texts[1]
    assert texts[1].startswith("mail [EMAIL] and token = \"[") and "end é😀 [CARD]" in texts[1]
    assert texts[2] == "nothing here, 12 apples at 3.50" and texts[3] is None and texts[None] == ""
    assert pii.report(docs.limit(0), detector).collect() == []
    assert pii.learn(docs.limit(0)).thresholds == {}


def test_trees_learn_an_interaction_and_agree_with_their_expression(spark):
    x = np.array([[a, b] for a in range(4) for b in range(3)])
    want = ((x[:, 0] >= 2) ^ (x[:, 1] == 1)).astype(float)
    trees = boost(x, 50 * want, 50 * (1 - want), unordered=frozenset({1}), rounds=60)
    margin = trees.margin(x)
    assert ((margin > 0) == (want > 0)).all()
    rows = spark.createDataFrame(x.tolist(), "a int, b int").select("a", "b", trees.column([F.col("a"), F.col("b")]).alias("m")).collect()
    assert np.allclose([r.m for r in rows], margin)


def test_no_python_in_the_plan(spark, detector):
    plan = pii.redact(read_table(spark, SF, "documents"), detector)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
