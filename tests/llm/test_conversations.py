import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from lapframe.llm import conversations as C

DDL = "conv_id long, turn long, role string, text string"


def walk(rows):
    """All ways to edit the rows, with at most two insertions at each place: (cost, audit, repaired)."""
    choices = []
    for role, text, fault in rows:
        extra = fault == 3
        own = [] if fault in (1, 2) else [("K", extra, (role, text))] + [("R", 2 + extra, (r, text)) for r in ("user", "assistant")]
        choices.append([("D", 3, None), *own])
    inserts = [()] + [(r,) for r in ("user", "assistant")] + list(itertools.product(("user", "assistant"), repeat=2))
    for picked in itertools.product(*choices):
        for placed in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(p[1] for p in picked) + 2 * sum(map(len, placed))
            audit, out = "", []
            for i, place in enumerate(placed):
                audit += "I" * len(place)
                out += [(r, "") for r in place]
                if i < len(rows):
                    audit += picked[i][0]
                    out += [picked[i][2]] if picked[i][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                yield cost, audit, out


def text_of(repaired):
    return "\n".join(f"{r}:{t}" for r, t in repaired)


def test_lightest_derivation_equals_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(0, 3)
        rows = [C.Row(rng.choice(["user", "assistant", "system", "tool", "", "u"]), rng.choice(["a.", "b", ""]), rng.choice([0, 0, 1, 2, 3])) for _ in range(n)]
        best = min(walk(rows), key=lambda w: w[:2])
        cost, audit = C.block_repairs(rows, C.EMPTY, True)[-1]
        assert (cost, audit) == best[:2], rows
        assert list(C.replay(audit, rows, C.EMPTY)) == best[2], rows


@pytest.mark.parametrize("size", [1, 2, 3])
def test_blocks_do_not_change_the_repair(monkeypatch, size):
    rng = random.Random(size)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["x.", "y"]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 9))]

        def whole():
            c = C._Conversation(1)
            for i, (role, text, fault) in enumerate(rows):
                c.add(i, role, text, fault)
            return c.finished()

        monkeypatch.setattr(C, "BLOCK_ROWS", 256)
        at_once = whole()
        monkeypatch.setattr(C, "BLOCK_ROWS", size)
        assert whole() == at_once


def test_a_long_conversation_streams(spark):
    # 3,000 rows in 12 blocks; all assistants from row 1,000 on, so every second is changed
    n = 3_000
    df = spark.range(n).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when((F.col("id") % 2 == 0) & (F.col("id") < 1_000), "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("row "), "id", F.lit(".")).alias("text"),
    )
    (got,) = C.report(df).collect()
    assert (got.cost, got.audit) == (2 * 1_000, "K" * 1_000 + "RK" * 1_000)
    expected = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:row {i}." for i in range(n))
    assert got.repaired_sha256 == hashlib.sha256(expected.encode()).hexdigest()
    assert got.illegal == 2_000


def test_faults_gaps_and_edge_rows(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi there."), (1, 2, "assistant", "Yes"), (1, 5, "user", " \t\n"),
        (1, 6, "user", "Hi there."), (1, 7, "assistant", "Done! "),
        (2, None, None, None), (2, None, "user", "Ok.\n "),
        (None, 3, "user", "A."), (None, 3, "user", "A."), (None, 4, "assistant", "B."),
        (4, 1, "", "No role."),
    ]
    df = spark.createDataFrame(rows, DDL).withColumn("audit", F.lit("clash")).withColumn("h", F.lit(1))
    got = {r.conv_id: r for r in C.report(df).collect()}
    # U+2028 is no blank, so the text does not end in a mark; the second greeting is seen earlier
    assert (got[1].gaps, got[1].blank, got[1].duplicate, got[1].truncated, got[1].illegal) == (2, 1, 1, 2, 1)
    assert (got[1].cost, got[1].audit) == (1 + 3 + 3 + 3, "KKDDDK")  # of two cheapest repairs the ASCII-least
    assert (got[2].gaps, got[2].blank, got[2].cost, got[2].audit) == (0, 1, 5, "DKI")
    assert (got[None].duplicate, got[None].gaps, got[None].audit) == (1, 0, "KDK")
    assert (got[4].cost, got[4].audit) == (3, "D")
    assert C.report(df.limit(0)).count() == 0


def test_a_dropped_conversation_is_returned(spark):
    df = spark.createDataFrame([(1, 0, "user", "A.")], DDL).withColumn("present", F.lit(False))
    assert [tuple(r) for r in C.report(df).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_texts_and_repeated_tables(spark):
    text = "word " * 400_000 + "end."
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "Fine.")], DDL)
    (once,) = C.report(df).collect()
    assert once.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:Fine.".encode()).hexdigest()
    (twice,) = C.report(df.union(df)).collect()
    assert (twice.duplicate, twice.repaired_sha256, twice.cost) == (2, once.repaired_sha256, 6)


def test_repaired_rows_have_the_hash(spark):
    rng = random.Random(3)
    rows = [(c if c else None, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["a.", "b", "", None, "c."])) for c in range(12) for t in range(rng.randint(1, 8))]
    df = C.damaged(spark.createDataFrame(rows, DDL))
    found = C.report(df)
    texts = {}
    for r in sorted(C.repaired_turns(df, found).collect(), key=lambda r: r.position):
        texts.setdefault(r.conv_id, []).append((r.role, r.text))
    for r in found.collect():
        body = texts.get(r.conv_id, [])
        assert hashlib.sha256(text_of(body).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in body))
