import random
import re

import pytest
from pyspark.sql import functions as F

from wardflow.functions import text as T
from wardflow.operators.notes import chunk_notes, clean_notes, explode_tokens
from wardflow.registry.text import ENGLISH


def cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, TEXT string")
    return [r.TEXT for r in clean_notes(df).orderBy("id").collect()]


def test_clean_rules(spark):
    pairs = [
        ("[**de-id**] Seen", "seen"),
        ("1. first 3.5 mg", "first 5 mg"),
        ("Dr. X and hydr. M.D.", "doctor x and hydoctor md"),
        ("Admission Date: today discharge date: later", "today later"),
        ("a--b __c ==d -=e", "ab c d -=e"),
        ("-__-", "--"),
        ("a/b\r\nc\n", "a b c"),
        ("\tlead  tab ", " lead tab"),
        (None, ""),
        ("", ""),
    ]
    assert cleaned(spark, [p[0] for p in pairs]) == [p[1] for p in pairs]


def python_chunks(text, size, tail=10):
    words = text.split(" ")
    pieces = [words[i : i + size] for i in range(0, len(words), size)]
    return [" ".join(p) for p in pieces if len(p) == size or len(p) > tail]


@pytest.mark.parametrize("size", [1, 2, 11, 318])
def test_chunks_match_plain_python(spark, size):
    random.seed(size)
    counts = [0, 1, 9, 10, 11, 12, 317, 318, 319, 328, 329, 636, 646, 647]
    texts = [" ".join(f"w{i}" for i in range(n)) for n in counts]
    texts += ["".join(random.choice("ab ") for _ in range(400)) for _ in range(30)]
    texts += [" ", "  ", "a ", " a", "line\nbreak " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, TEXT string")
    got = {}
    for r in chunk_notes(df, size).orderBy("id", "chunk_no").collect():
        got.setdefault(r.id, []).append(r.TEXT)
    want = {i: python_chunks(t, size) for i, t in enumerate(texts)}
    assert got == {i: c for i, c in want.items() if c}


def test_a_very_long_note_is_cut_whole(spark):
    words = 318 * 2000 + 5
    df = spark.range(1).select(F.repeat(F.lit("word "), words).alias("TEXT"))
    assert chunk_notes(df).count() == 2000


def test_tokens(spark):
    raw = "The BP  was 120/80, he's ok"
    row = spark.createDataFrame([(raw,)], "t string").select(
        T.space_tokens(F.col("t")).alias("space"),
        T.word_tokens(F.col("t")).alias("word"),
        T.rule_tokens(F.col("t")).alias("rule"),
        T.letters_only(T.rule_tokens(F.col("t"))).alias("letters"),
        T.without_stop_words(T.word_tokens(F.col("t")), T.CLINICAL_STOP_WORDS).alias("clinical"),
        T.shrink_spaces(F.col("t")).alias("shrunk"),
    )
    got = row.first()
    assert got.space == ["the", "bp", "", "was", "120/80,", "he's", "ok"]
    assert got.word == [w for w in re.split(r"\W", raw.lower()) if w]
    assert got.rule == ["The", "BP", "was", "120", "/", "80", ",", "he", "'", "s", "ok"]
    assert got.letters == ["The", "BP", "was", "he", "s", "ok"]
    assert got.clinical == ["bp", "120", "80", "ok"]
    assert got.shrunk == "The BP was 120/80, he's ok"


def test_stop_word_lists(spark):
    assert sorted(T.default_stop_words()) == sorted(ENGLISH)
    assert len(T.CLINICAL_STOP_WORDS) == 50


def test_the_text_chain_is_not_repeated_below_the_explode(spark):
    df = clean_notes(spark.createDataFrame([(1, "x")], "id int, TEXT string"))
    for out in (chunk_notes(df), explode_tokens(df, ["id"], T.space_tokens(F.col("TEXT")))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("admission date:") == 1
