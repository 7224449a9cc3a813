import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapframe.llm import orc_output
from lapframe.llm.common import read_table
from lapframe.llm.workload import WORD_TOKENIZER

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_TOKENIZER)


def expected(library, rows):
    start, out = 0, []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def index_of(docs, path):
    orc_output.write_token_ids(docs, WORD_TOKENIZER, path)
    return [tuple(r) for r in orc_output.document_index(docs.sparkSession, path).orderBy("start").collect()]


def test_words_in_turn_match_the_library(library):
    encoder = orc_output.WordEncoder(library.to_str())
    rng = random.Random(2)
    alphabet = "aB'sé漢ΣσİK1²!?́가\x1c\x85　 \n\t<|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["x <|endoftext|>y", "a" * 300 + " b", " ", "\n\n", "e ́e", "ΟΔΟΣ Σ"]
    for i in range(0, len(texts), 300):
        part = texts[i : i + 300]
        for text, got in zip(part, encoder.encode(part), strict=True):
            assert np.frombuffer(got, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_generations(library, monkeypatch):
    monkeypatch.setattr(orc_output, "CACHE_WORDS", 20)
    encoder = orc_output.WordEncoder(library.to_str())
    for i in range(30):
        text = " ".join(f"w{j}" for j in range(i, i + 15)) + " " + "z" * (60 + i)
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_index_of_the_small_table(spark, library, tmp_path):
    docs = read_table(spark, SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    assert index_of(docs.repartition(7), str(tmp_path / "o")) == expected(library, rows)
    found = orc_output.read_token_ids(spark, str(tmp_path / "o"), [rows[3][0], rows[9][0]])
    assert sorted(r.doc_id for r in found.collect()) == [rows[3][0], rows[9][0]]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()


def test_odd_rows(spark, frame, library, tmp_path):
    rows = [(None, "lost"), (3, None), (3, None), (5, ""), (7, "same same"), (7, "same same"), (9, "b " * 5000)]
    docs = frame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, part int, ids int").repartition(3)
    assert index_of(docs, str(tmp_path / "odd")) == expected(library, rows)
    assert index_of(docs.filter(F.lit(False)), str(tmp_path / "none")) == []
