import math
import zlib
from collections import Counter

import numpy as np
from edge_cases import clashing, documents

from wardflow.llm import suffix_tree


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def base_scores(rows):
    counts = Counter()
    learned = [t for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1]
    for t in learned:
        counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for doc_id, text in rows:
        tokens = [*words(text), None]
        score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        yield doc_id, len(tokens), sum(counts[w] > 0 for w in tokens), n, score


def check(docs, settings=None):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(suffix_tree.fit_and_score(docs, settings).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    expected = sorted(base_scores(rows), key=lambda r: (str(r[0]), r[1]))
    assert len(got) == len(expected)
    for r, e in zip(got, expected):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == e[:4]
        assert math.isclose(r.base_score, e[4], rel_tol=1e-9, abs_tol=1e-9)
        assert r.spelt_score <= r.score + 1e-9 and r.score <= 1e-9 and math.isfinite(r.spelt_score)
    return got


def test_edge_cases(spark):
    check(clashing(documents(spark)))
    assert suffix_tree.fit_and_score(documents(spark, [])).collect() == []
    only_held_out = [(i, "some words", "en", "s", 1) for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    check(documents(spark, only_held_out))


def test_all_documents_with_few_hot_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(docs, suffix_tree.Settings(hot_words=100, first_words=50))
    whole = check(docs)
    assert {r.doc_id: r.base_score for r in got}.keys() == {r.doc_id: r.base_score for r in whole}.keys()


def test_held_out_score_beats_the_base(spark):
    rows = [r for r in check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")) if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 0.5


def test_next_words_sum_to_one(spark):
    text = "a b c a b c a b d b a c " * 30
    docs = spark.createDataFrame([(0, text), (2, text + "e f")], "doc_id long, text string")
    model = suffix_tree.fit(docs, suffix_tree.Settings(least_gain=0.5))
    layer = model.words
    assert all(len(level.keys) for level in layer.levels)
    unknown = model.distinct * suffix_tree.DISCOUNT / model.tokens
    end = (model.ends - suffix_tree.DISCOUNT) / model.tokens
    for before in ([], [0], [1], [0, 1], [1, 0], [2, 0], [1, 2]):
        first = np.arange(len(before) + 1) == 0
        p = sum(10 ** layer.scores(np.array([*before, w]), first)[-1] for w in range(len(layer.hot)))
        left = 10 ** layer.scores(np.array([*before, -1]), first)[-1]
        assert math.isclose(p + left * (unknown + end), 1, rel_tol=1e-6)


def test_spelling_sums_to_one():
    words_ = [b"abc", b"abd", b"bcd", b"ab"]
    counts = {w: 5 + i for i, w in enumerate(words_)}
    word, symbol, before, depth = suffix_tree.positions(words_)
    found = Counter()
    for w, s, b, deep in zip(word, symbol, before, depth):
        for d in range(min(deep, suffix_tree.DEPTH) + 1):
            found[d, int(b) & ((1 << 8 * d) - 1), int(s)] += counts[words_[w]]
    tree = suffix_tree.grow(*np.array([(*k, n) for k, n in found.items()]).T, least_gain=0.1)
    assert sum(len(c) for c in tree.contexts[1:]) > 3
    # all strings of a length over the alphabet seen, and what the unseen symbols get
    prefix = tree.word_scores([b"ab"])[0]
    assert 10 ** prefix > 0.05 and tree.word_scores([b"zzzzzz"])[0] < -10


def test_scores_of_texts_sum_to_one(spark):
    """In every state, the end's part of ``score`` is what the words and the unknown word leave."""
    text = "a b c a b c a b d b a c " * 30
    docs = [(0, text), (2, text + "e f"), *[(i, "a b c a b") for i in range(3, 40)]]
    model = suffix_tree.fit(spark.createDataFrame(docs, "doc_id long, text string"), suffix_tree.Settings(least_gain=0.5))
    layer = model.words
    places = {w.decode(): i for i, w in enumerate(layer.hot)}
    texts = ["", "a", "b", "a b", "b c", "c a b", "a c", "d b", "e f", "f"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in suffix_tree.score(asked, model).collect()}
    unknown = model.distinct * suffix_tree.DISCOUNT / model.tokens
    ends = []
    for i, t in enumerate(texts):
        before = [places[w] for w in t.split()]
        first = np.arange(len(before) + 1) == 0
        p = sum(10 ** layer.scores(np.array([*before, w]), first)[-1] for w in range(len(layer.hot)))
        left = 10 ** layer.scores(np.array([*before, -1]), first)[-1]
        ends.append(10 ** (got[i] - layer.scores(np.array(before, np.int64), first[: len(before)]).sum()))
        assert math.isclose(p + left * unknown + ends[-1], 1, rel_tol=1e-6)
    assert ends[texts.index("a b")] > 2 * ends[texts.index("a")]


def test_seldom_words_are_contexts_too(spark):
    """A pair is found whatever the rank of its words: settings of few words lose none."""
    docs = [(2 * i, " ".join(f"w{(i + j) % 30}" for j in range(12)) + " odd pair") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    few = suffix_tree.fit(frame, suffix_tree.Settings(hot_words=3, first_words=2))
    whole = suffix_tree.fit(frame, suffix_tree.Settings())
    assert {b"odd", b"pair"} <= set(few.words.hot)
    for one, other in zip(few.words.levels, whole.words.levels):
        assert len(one.keys) == len(other.keys) > 25
    a, b = ({r.doc_id: r.score for r in suffix_tree.score(frame, m).collect()} for m in (few, whole))
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9) for k in b)
