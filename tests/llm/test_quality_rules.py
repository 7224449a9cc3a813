import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lapframe.llm import quality
from lapframe.llm.common import read_table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def assert_base(rows, got):
    want = {k: base(t) for k, t in rows}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id], r.doc_id
        assert not (r.base_failed and r.kept)


def test_given_documents(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = quality.assess(docs, labels).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    assert_base(rows, got)
    kept = {r.doc_id: r.kept for r in got}
    marks = [(r.quality, kept[r.doc_id]) for r in labels.collect()]
    good = [k for q, k in marks if q == 1]
    bad = [k for q, k in marks if q == 0]
    assert sum(good) >= 0.85 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_made_up_texts(frame):
    rng = random.Random(3)
    parts = ["a", "b", "c", " ", " ", "\n", "\n", "\t", "é", "#", "😀", "\x0b", "\x1c", "a b c", "x y"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(1200)]
    rows += [(5000, None), (5001, ""), (5002, "w " * 20000), (5003, "\n".join(f"line {i % 50} of text" for i in range(2000)))]
    docs = frame([(*r, 7) for r in rows], "doc_id bigint, text string, n_words int")
    assert_base(rows, quality.judge(quality.statistics(docs), []).collect())
    assert quality.judge(quality.statistics(docs.limit(0)), []).collect() == []


def test_rules_are_learned_from_a_threshold(spark):
    n = 3000
    i = F.col("id")
    stats = spark.range(n).select(
        i.alias("doc_id"), F.lit(200).alias("n_words"), (100 + i % 90).alias("n_distinct"), F.lit(0).alias("n_repeat_words"),
        F.lit(1000).alias("word_chars"), (i * 7 % 400).alias("n_symbols"), F.lit(0).alias("n_dup_lines"), F.lit(10).alias("n_lines"),
        F.lit(10).alias("n_upper"), F.lit(0).alias("n_marks"),
    )
    noise = (i * 31 % 100) < 3
    labels = spark.range(n).select(i.alias("doc_id"), F.when(((i * 7 % 400) > 300) != noise, 0).otherwise(1).alias("quality"))
    rules = quality.learn(stats, labels)
    assert rules and rules[0][0].feature == quality.FEATURES.index("symbol_share") and rules[0][0].above
    got = quality.judge(stats, rules).collect()
    assert sum(r.kept == (r.doc_id * 7 % 400 <= 300) for r in got) > 0.95 * n


def test_without_labels_nothing_is_learned(spark, frame):
    docs = read_table(spark, SF, "documents").limit(20)
    stats = quality.statistics(docs)
    assert quality.learn(stats, frame([(None, 0), (1, None)], "doc_id bigint, quality int")) == []
    assert quality.learn(stats, frame([], "doc_id bigint, quality int")) == []


def test_no_python_in_the_plan(spark):
    plan = quality.statistics(read_table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_separators_that_are_no_blanks_end_a_text(spark):
    texts = ["a b \u2028", "x \u2029", "y \u0085", "z\u2028 ", "\u0085", " \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars) for r in quality.statistics(df).collect()}
    assert got == {0: (3, 3), 1: (2, 2), 2: (2, 2), 3: (1, 2), 4: (1, 1), 5: (0, 0)}


def test_rare_junk_is_cut_off(spark):
    """Three in a thousand documents are full of symbols; the other half of the rejected has no sign at all."""
    rng = random.Random(9)

    def text(i):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(80)]
        return " ".join(w + "###" if i % 333 == 0 else w for w in words)

    rows = [(i, text(i), int(i % 333 != 0 and i % 331 != 1)) for i in range(6_000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    gone = {r.doc_id for r in quality.assess(docs, labels).filter("NOT kept").collect()}
    assert gone == {i for i in range(6_000) if i % 333 == 0}
