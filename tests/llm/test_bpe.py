import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapframe.llm import bpe
from lapframe.llm.workload import RANKS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as f:
        return bpe.Encoder(f.read(), bpe.code_point_kinds())


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )


def assert_same(encoder, library, texts):
    ids, counts, _, _ = encoder.encode(texts)
    at = 0
    for text, n, back in zip(texts, counts.tolist(), encoder.decode(ids, counts), strict=True):
        assert ids[at : at + n].tolist() == library.encode_ordinary(text)
        assert back == text.encode()
        at += n
    assert at == len(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab's'tmdrevl \n\t 1²é漢!😀\x1c"), max_size=30), max_size=6))
def test_mixed_texts_match_library(encoder, library, texts):
    assert_same(encoder, library, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text_matches_library(encoder, library, texts):
    assert_same(encoder, library, texts)


def test_long_runs_and_a_full_cache(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdéß#") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    assert_same(encoder, library, ["a" * 4000, "'s" * 500, " " * 3000, "!?" * 2000, ""])
    for i in range(0, 3000, 300):
        assert_same(encoder, library, [" ".join(words[i : i + 300])])


def test_query_digests(spark, frame, library):
    rows = [(1, "It's  fine\n", "x"), (2, None, "y"), (2, "", "z"), (None, "né 12", "w"), (1, "It's  fine\n", "x")]
    docs = frame(rows, "doc_id bigint, text string, ids string").withColumn("n_tokens", F.lit(1))
    got = bpe.digests(docs, RANKS).collect()
    want = []
    for key, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append(
            (
                key,
                len(ids),
                hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([tuple(r)[:4] for r in got], key=order) == sorted(want, key=order)
    assert bpe.digests(docs.limit(0), RANKS).collect() == []


def test_offsets_cut_the_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = bpe.encode_documents(docs, RANKS).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert rows
    for r in rows[:50]:
        cuts = [*r.offsets, len(r.text)]
        assert cuts[0] == 0 and all(a < b for a, b in zip(cuts, cuts[1:], strict=False))
