import re
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from lapframe.llm.common import read_table, stored

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs
        docs = stored(stage(spark, docs, SF), f"test-{name}")
    out["end"] = docs
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns_and_the_order(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "neardup", "pii", "mixing", "encode"]
    for name in names:
        assert stages[name].columns == stages["toxicity"].columns
        assert stages[name].dtypes == stages["toxicity"].dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in read_table(spark, SF, "labels").collect()}
    before, after = ids(stages["toxicity"]), ids(stages["neardup"])
    gone = [k for k in before if k not in after]
    assert sum(labels.get(k) == 0 for k in gone) <= 0.01 * sum(v == 0 for v in labels.values())
    # some labels are noise: documents without any insult; those with one have to go
    insults = ("loser", "idiot", "pathetic", "scum", "worthless", "moron", "trash", "clown", "disgusting", "stupid")
    texts = {r.doc_id: (r.text or "").lower() for r in stages["toxicity"].collect()}
    toxic = [k for k, v in labels.items() if v == 1 and sum(w in texts.get(k, "") for w in insults) > 1]
    assert len(toxic) > 20 and sum(k in gone for k in toxic) >= 0.95 * len(toxic)


def test_one_document_of_each_group_stays(stages):
    from test_neardup import brute

    rows = [tuple(r) for r in stages["neardup"].select("doc_id", "text").collect()]
    want = {k for k, (_, c) in brute(rows).items() if k == c}
    assert set(ids(stages["pii"])) == want


def test_redaction_changes_only_texts_with_personal_data(stages):
    from test_pii import base

    before = {r.doc_id: r.text for r in stages["pii"].collect()}
    after = {r.doc_id: r for r in stages["mixing"].collect()}
    assert before.keys() == after.keys()
    changed = 0
    for key, text in before.items():
        if base(text):
            assert after[key].text != text and not base(re.sub(r"\[[A-Z]+\]", " ", after[key].text))
            changed += 1
        if after[key].text == text:
            continue
        assert "[" in after[key].text and after[key].n_chars == len(after[key].text)
    assert changed


def test_mixing_repeats_and_encoding_is_that_of_the_library(spark, stages):
    import hashlib

    import public_tokenizers

    from lapframe.llm.workload import RANKS
    import base64

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages["mixing"].collect()}
    assert set(ids(stages["encode"])) == set(texts)
    end = stages["end"].collect()
    assert Counter(r.doc_id for r in end) == ids(stages["encode"])
    for r in end[:200]:
        found = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(found) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest()


def test_run_is_the_stages_in_turn_and_empty_tables_pass(spark, stages, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    odd = docs.limit(20).withColumn("text", F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("text")))
    odd = odd.union(odd).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.lit(None).cast("bigint"))
    odd.write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "odd" / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert 0 < len(rows) <= 20
