"""Block-wise word vectors: planted synonyms, the schedule of cells, pooled texts."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardflow.operators import word_vectors as wv

TOPICS = 5


def corpus(spark, n=600):
    """In each topic ``s`` and ``t`` are used alike: between the same words, never together."""
    draw = random.Random(2)
    texts = []
    for _ in range(n):
        text = []
        for _ in range(4):
            topic = draw.randrange(TOPICS)
            text += [f"l{topic}x{draw.randrange(3)}", f"{draw.choice('st')}{topic}", f"r{topic}x{draw.randrange(3)}", draw.choice(["and", "of"])]
        texts.append(text)
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, []), (n + 2, ["seldom"])], "k int, words array<string>")


SETTINGS = wv.Settings(vector_size=16, window=1, min_count=5, epochs=2, passes=150, learning_rate=0.1, block_words=15, least_blocks=2, seed=3)


@pytest.fixture(scope="module")
def fitted(spark):
    docs = corpus(spark)
    return docs, {r.word: np.array(r.vector) for r in wv.fit(docs, F.col("words"), SETTINGS).collect()}


def test_planted_synonyms_are_neighbours(fitted):
    _, vectors = fitted
    assert "seldom" not in vectors and len(vectors) == TOPICS * 8 + 2
    names = sorted(vectors)
    unit = np.array([vectors[w] / np.linalg.norm(vectors[w]) for w in names])
    for topic in range(TOPICS):
        for one, other in ("st", "ts"):
            like = unit @ unit[names.index(f"{one}{topic}")]
            order = [w for _, w in sorted(zip(-like, names)) if w != f"{one}{topic}"]
            assert order[0] == f"{other}{topic}"


def test_same_vectors_in_any_partitioning(spark):
    few = wv.Settings(vector_size=8, min_count=5, epochs=1, least_blocks=2)
    docs = corpus(spark, 300)
    one, other = (
        {r.word: r.vector for r in wv.fit(d, F.col("words"), few).collect()} for d in (docs.coalesce(1), docs.repartition(7))
    )
    assert one == other and one


def test_pairs_by_brute_force(spark):
    texts = [["a", "b", "a", "c"], ["b"], [], None, ["a", "a"]]
    docs = spark.createDataFrame([(t,) for t in texts], "words array<string>")
    rows = wv.sentences(docs, F.col("words"), 3)
    assert sorted(r.words for r in rows.collect()) == [["a", "a"], ["a", "b", "a"], ["b"], ["c"]]
    expected = Counter()
    for t in filter(None, texts):
        for i in range(len(t)):
            for j in range(i + 1, min(i + 4, len(t))):
                expected[min(t[i], t[j]), max(t[i], t[j])] += 4 - (j - i)
    whole = wv.co_occurrences(wv.sentences(docs, F.col("words"), 100), 3)
    assert {(r.a, r.b): round(3 * r.weight) for r in whole.collect()} == expected
    words = spark.createDataFrame([("a", 1, 0), ("b", 1, 2)], "word string, n int, block int")
    got = wv.cells(whole, words, 3).collect()
    found = {(r.centre, r.context): (round(3 * r.weight), r.block, r["round"]) for r in got}
    both = expected["a", "b"]
    assert found == {("a", "a"): (2 * expected["a", "a"], 0, 0), ("a", "b"): (both, 0, 2), ("b", "a"): (both, 2, 1)}


def test_a_step_by_brute_force():
    """One step over a cell against sums written out pair by pair."""
    draw = np.random.default_rng(0)
    centre, context = (draw.normal(0, 1, (4, 6)).astype(np.float32) for _ in range(2))
    centre[:, -1], context[:, -1] = 0, 0
    x, y, weight = np.array([0, 1, 1, 3]), np.array([2, 2, 0, 1]), np.array([1.0, 2.0, 3.0, 2.0])
    share = np.array([1.0, 2.0, 3.0, 4.0])
    settings = wv.Settings(vector_size=5, negatives=2, learning_rate=0.1)
    u, v = centre[:, :5].astype(float), context[:, :5].astype(float)
    again = np.random.default_rng(9)
    again.permutation(4)
    negative = again.choice(4, 16, p=share / share.sum())
    du, dv = np.zeros_like(u), np.zeros_like(v)
    for a, b, w in zip(x, y, weight / weight.mean()):
        pull = w * (1 / (1 + np.exp(-u[a] @ v[b])) - 1)
        du[a] += pull * v[b]
        dv[b] += pull * u[a]
        for z in negative:
            if z != b:
                push = w * 2 / 16 / (1 + np.exp(-u[a] @ v[z]))
                du[a] += push * v[z]
                dv[z] += push * u[a]
    wv.train_cell(centre, context, share, (x, y, weight), settings, np.random.default_rng(9))
    for before, gradient, after in ((u, du, centre), (v, dv, context)):
        scale = np.sqrt((gradient**2).mean(axis=1, keepdims=True) + wv.DAMPING)
        assert np.allclose(after[:, :5], before - 0.1 * gradient / scale, atol=1e-4)


@pytest.mark.parametrize("words, rows", [(wv.POOLED_WORDS, wv.POOLED_ROWS), (5, 50)])
def test_pooled_texts_by_brute_force(spark, fitted, monkeypatch, words, rows):
    monkeypatch.setattr(wv, "POOLED_WORDS", words)
    monkeypatch.setattr(wv, "POOLED_ROWS", rows)
    docs, vectors = fitted
    docs = docs.where("k % 9 = 0 or k >= 600").withColumn("name", F.when(F.col("k") % 2 == 0, "even"))
    table = spark.createDataFrame([(w, v.tolist()) for w, v in vectors.items()], "word string, vector array<float>")
    got = {r.k: np.array(r.features) for r in wv.mean_vectors(docs, ["k", "name"], F.col("words"), table, 16).collect()}
    assert set(got) == {r.k for r in docs.collect()}
    for r in docs.collect():
        own = [vectors[w] for w in r.words or [] if w in vectors]
        expected = sum(own, np.zeros(16)) / max(1, len(r.words or []))
        assert np.allclose(got[r.k], expected, atol=1e-6)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None)], "k int, words array<string>")
    assert wv.fit(docs, F.col("words"), SETTINGS).collect() == []


def test_no_number_of_the_state_is_converted():
    """Between rounds a vector is one value, not a list of numbers."""
    assert "array" not in wv.STATE
    vectors = np.arange(12, dtype=np.float32).reshape(3, 4)
    assert (wv._unpacked(wv._packed(vectors)) == vectors).all()
    assert len(wv._unpacked(wv._packed(vectors[:0]))) == 0


def test_no_library_word2vec_is_trained_for_scores(spark, monkeypatch, tmp_path):
    """The scores on word vectors come from the vectors trained in blocks; repeated rows are each scored alike."""
    from pyspark.ml.feature import Word2Vec

    from wardflow.registry import models

    def refused(*_):
        raise AssertionError("trained by one task")

    monkeypatch.setattr(Word2Vec, "_fit", refused)
    monkeypatch.setattr(models, "WORD_VECTORS", wv.Settings(vector_size=8, least_blocks=2))
    draw = random.Random(1)
    made = [(i, " ".join(draw.choices("abcdefgh", k=40))) for i in range(60)]
    spark.createDataFrame([*made, *made[:20]], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    query = next(q for q in models.MODELS if q.name == "ml6_logistic_on_word2vec")
    got = query.run(spark, str(tmp_path)).collect()
    assert len(got) == 80 and all(0 <= r.score <= 1 for r in got)
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r.score)
    assert all(len(s) == (2 if i < 20 else 1) and max(s) - min(s) < 1e-6 for i, s in by_doc.items())


def test_each_cell_of_a_round_has_its_own_task(spark):
    """However few partitions a shuffle has, no cell waits behind another; each pair meets its two vectors."""
    blocks, few = 8, wv.Settings(vector_size=4, least_blocks=8)
    vector = wv._packed(np.ones((1, 5), np.float32))[0].as_py()
    state = spark.createDataFrame([(k, b, f"w{b}", 1.0, vector) for b in range(blocks) for k in ("centre", "context")], wv.STATE)
    pairs = spark.createDataFrame(
        [(f"w{b}", f"w{(b + 1) % blocks}", 1.0, b, 1) for b in range(blocks)],
        "centre string, context string, weight double, block int, round int",
    )
    got = wv._round(state, pairs, 1, blocks, 0, few).withColumn("task", F.spark_partition_id()).collect()
    assert len(got) == 2 * blocks and len({r.task for r in got}) == blocks
    assert all(r.vector != vector for r in got)


def test_summed_gradients_by_brute_force():
    draw = np.random.default_rng(1)
    at, gradient = draw.integers(0, 9, 40), draw.normal(0, 1, (40, 3)).astype(np.float32)
    rows, summed = wv._summed(at, gradient)
    assert rows.tolist() == sorted(set(at.tolist()))
    assert np.allclose(summed, [gradient[at == r].sum(axis=0) for r in rows], atol=1e-5)


@pytest.mark.parametrize("pairs, group, at_once", [(wv.SLICE_PAIRS, wv.GROUP_PAIRS, wv.ROWS_AT_ONCE), (60, 40, 3)])
def test_known_pairs_by_brute_force(spark, monkeypatch, pairs, group, at_once):
    """Whatever the slices and groups, each pair of known words comes once, with the blocks of its words."""
    monkeypatch.setattr(wv, "SLICE_PAIRS", pairs)
    monkeypatch.setattr(wv, "GROUP_PAIRS", group)
    monkeypatch.setattr(wv, "ROWS_AT_ONCE", at_once)
    draw = random.Random(4)
    names = ["a", "B", "é", "\U0001f600", "～", "zz", "rare"]
    texts = [draw.choices(names, k=draw.randrange(9)) for _ in range(40)]
    texts += [*texts[:20], None, [], ["a"]]
    words = spark.createDataFrame([(w, 9, i % 3) for i, w in enumerate(names[:-1])], "word string, n int, block int")
    expected = Counter()
    for t in filter(None, texts):
        for i, j in ((i, j) for i in range(len(t)) for j in range(i + 1, min(i + 3, len(t)))):
            if "rare" not in (t[i], t[j]):
                expected[tuple(sorted((t[i], t[j]), key=str.encode))] += 3 - (j - i)
    rows = spark.createDataFrame([(t,) for t in texts], "words array<string>").repartition(3)
    got = wv.co_occurrences(rows, 2, words).collect()
    assert len(got) == len(expected) and {(r.a, r.b): round(2 * r.weight) for r in got} == expected
    assert all((r.a_block, r.b_block) == (names.index(r.a) % 3, names.index(r.b) % 3) for r in got)
    dealt = {(r.centre, r.context): r for r in wv.cells(wv.co_occurrences(rows, 2, words), words, 3).collect()}
    joined = {(r.centre, r.context): r for r in wv.cells(wv.co_occurrences(rows, 2), words, 3).collect()}
    assert dealt == joined


def test_a_slice_moves_as_one_row_per_group(spark):
    """Of the pairs of a slice no row each is shuffled, and copies of a text add nothing to what moves."""
    draw = random.Random(5)
    text = [f"w{draw.randrange(500)}" for _ in range(1000)]
    rows = spark.createDataFrame([(text,)] * 20, "words array<string>").coalesce(1)
    got = wv._counted(rows, 5, 4).collect()
    assert len(got) == len({r["_group"] for r in got}) == 10
    distinct = {tuple(sorted((text[i], text[j]))) for i in range(1000) for j in range(i + 1, min(i + 6, 1000))}
    assert sum(r.n for r in got) == len(distinct)
    assert all(len(r.x) == len(r.y) == r.n for r in got)


def test_a_missing_word_is_no_known_word(spark):
    rows = spark.createDataFrame([(["a", None, "b"],), ([None, None],)], "words array<string>")
    words = spark.createDataFrame([("a", 1, 0), ("b", 1, 1), (None, 3, 0)], "word string, n int, block int")
    got = {(r.a, r.b): r.weight for r in wv.co_occurrences(rows, 2, words).collect()}
    assert got == {("a", "a"): 1.0, ("a", "b"): 0.5, ("b", "b"): 1.0}


def test_tokens_are_made_once_per_row(spark):
    docs = spark.createDataFrame([("a b c d e",), (None,), ("",), ("f",)], "t string")
    tokens = F.filter(F.split("t", " "), lambda w: w != "")
    rows = wv.sentences(docs, tokens, 2)
    assert sorted(r.words for r in rows.collect()) == [["a", "b"], ["c", "d"], ["e"], ["f"]]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_numbers_take_as_few_bytes_as_they_need():
    rows = [np.array(r) for r in ([0], [3, 255], [256, 1], [1 << 16, 0, 7], [1 << 32])]
    blobs = [wv._narrow(r) for r in rows]
    assert [len(b) // len(r) for b, r in zip(blobs, rows)] == [1, 1, 2, 4, 8]
    got = wv._wide(pa.chunked_array([blobs]), pa.chunked_array([[len(r) for r in rows]]))
    assert all((g == r).all() for g, r in zip(got, rows))


def test_no_part_of_a_text_moves_when_texts_are_pooled(spark, fitted):
    """A row's vector is whole where it is first made; nothing is shuffled after that, and equal keys share a sum."""
    docs, vectors = fitted
    table = spark.createDataFrame([(w, v.tolist()) for w, v in vectors.items()], "word string, vector array<float>")
    plan = wv.mean_vectors(docs, ["k"], F.col("words"), table, 16)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("CoGroups")]
    some = docs.where("k < 3")
    one, two = (
        {r.k: r.features for r in wv.mean_vectors(d, ["k"], F.col("words"), table, 16).collect()} for d in (some, some.union(some))
    )
    assert all(np.allclose(2 * np.array(one[k]), two[k]) for k in one) and len(one) == 3


def test_texts_are_pooled_once_for_fit_and_scores(spark, monkeypatch, tmp_path):
    from wardflow.registry import models

    monkeypatch.setattr(models, "WORD_VECTORS", wv.Settings(vector_size=4, least_blocks=1))
    pooled, whole = [], wv.mean_vectors
    monkeypatch.setattr(models.word_vectors, "mean_vectors", lambda *a: pooled.append(a) or whole(*a))
    draw = random.Random(6)
    made = [(i, " ".join(draw.choices("abcdefgh", k=30))) for i in range(40)]
    spark.createDataFrame(made, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    query = next(q for q in models.MODELS if q.name == "ml6_logistic_on_word2vec")
    assert query.run(spark, str(tmp_path)).count() == 40 and len(pooled) == 1


def test_rounds_leave_no_shuffle_files(spark):
    """What a written table has shuffled is gone, so that the rounds of a training do not pile up."""
    import gc
    import time

    from wardflow.sources.shared import CLEANED, materialised

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "/shuffle_" in f}

    gc.disable()
    before = shuffled()
    held = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    table = materialised(held)
    for _ in range(20):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.5)
    gc.enable()
    assert not left and spark.conf.get(CLEANED, None) is None and table.count() == 7
