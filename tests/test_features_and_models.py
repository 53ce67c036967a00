import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from wardflow.functions import labels as L
from wardflow.functions.text import space_tokens
from wardflow.operators import classify, encode, features
from wardflow.registry import models

TEXTS = [
    ("the heart rate was high and the rate rose", 1),
    ("heart failure with high rate", 1),
    ("rate of recovery was high", 0),
    ("heart sounds normal rate normal", 0),
    ("high fever and normal rate", 0),
    ("rate high heart", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id int, TEXT string, Label int").cache()


@pytest.fixture(scope="module")
def terms(docs):
    return encode.document_tokens(docs, ["doc_id", "Label"], space_tokens(F.col("TEXT")))


def vector_terms(model, frame, column):
    words = model.stages[-2].vocabulary
    return {
        (r.doc_id, words[int(i)]): float(v)
        for r in frame.select("doc_id", column).collect()
        for i, v in zip(r[column].indices, r[column].values)
    }


def weighted(docs, terms):
    tokens = space_tokens(F.col("TEXT"))
    idf = features.inverse_document_frequency(
        encode.document_frequencies(docs, tokens), F.lit(len(TEXTS))
    )
    vocabulary = encode.top_vocabulary(encode.token_frequencies(docs, tokens), 100)
    return features.term_weights(terms, idf, vocabulary)


def test_term_tables_equal_the_vectors(docs, terms):
    model = features.tfidf_stages(drop_stop_words=False).fit(docs)
    out = model.transform(docs)
    counts = {(r.doc_id, r.token): r.tf for r in terms.collect()}
    assert counts == vector_terms(model, out, "counts")
    ours = {(r.doc_id, r.token): r.tfidf for r in weighted(docs, terms).collect()}
    theirs = vector_terms(model, out, "features")
    assert all(ours[k] == pytest.approx(v) for k, v in theirs.items())
    assert any(v > 0 for v in theirs.values())


def test_naive_bayes_tables_equal_the_model(docs, terms):
    model = features.tfidf_stages(drop_stop_words=False).fit(docs)
    fitted = NaiveBayes(labelCol="Label", smoothing=1.0).fit(model.transform(docs))
    words = model.stages[-2].vocabulary
    priors, likelihoods = classify.naive_bayes_parameters(weighted(docs, terms), docs)
    for r in priors.collect():
        assert r.log_prior == pytest.approx(fitted.pi[r.Label])
    theta = fitted.theta.toArray()
    for r in likelihoods.collect():
        assert r.log_likelihood == pytest.approx(theta[r.Label][words.index(r.token)])


def test_class_one_stays_class_one(docs):
    skewed = docs.unionByName(docs.where("Label = 1")).unionByName(docs.where("Label = 1"))
    index = features.frequency_index(skewed).select("Label", "label_index").distinct().collect()
    assert {r.Label: r.label_index for r in index} == {1: 0.0, 0: 1.0}
    assert features.label_as_double(skewed).where("Label = 1.0").count() == 9


def test_pair_lengths_against_the_loop(spark):
    rows = [(a, b, m) for a in range(13) for b in range(13) for m in range(15)]
    kept_a, kept_b = encode.pair_lengths(F.col("a"), F.col("b"), F.col("m"))
    df = spark.createDataFrame(rows, "a int, b int, m int")
    for r in df.select("*", kept_a.alias("ka"), kept_b.alias("kb")).collect():
        a, b = r.a, r.b
        while a + b > r.m:
            if a > b:
                a -= 1
            else:
                b -= 1
        assert (r.ka, r.kb) == (a, b), r


def test_sequences(spark):
    length = 6
    rows = [(0, []), (1, ["a"]), (2, list("abca")), (3, list("abcab")), (4, ["zz", "a"]), (5, None)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    vocabulary = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6)], "token string, token_id int")
    out = encode.encode_sequences(df, ["id"], F.col("tokens"), vocabulary, length).collect()
    got = {r.id: r for r in out}
    assert got[0].input_ids == [2, 3, 0, 0, 0, 0] and got[0].input_mask == [1, 1, 0, 0, 0, 0]
    assert got[1].input_ids == [2, 4, 3, 0, 0, 0]
    assert got[2].input_ids == [2, 4, 5, 6, 4, 3]
    assert got[3].input_ids == got[2].input_ids
    assert got[4].input_ids == [2, 1, 4, 3, 0, 0]
    assert got[5].input_ids == got[0].input_ids
    assert all(r.segment_ids == [0] * length for r in out)


def test_sub_words(spark):
    pieces = ["un", "##aff", "##able", "un##", "aff", "é"]
    table = spark.createDataFrame([(p,) for p in pieces], "piece string")
    rows = [("unaffable",), ("affx",), ("u" * 101,), ("",), ("é",), ("affaff",), ("é",)]
    words = spark.createDataFrame(rows, "token string")
    got = {r.token: r.pieces for r in encode.sub_words(words, table).collect()}
    assert got == {
        "unaffable": ["un", "##aff", "##able"],
        "affx": ["[UNK]"],
        "u" * 101: ["[UNK]"],
        "": [],
        "é": ["é"],
        "affaff": ["aff", "##aff"],
    }


def test_sequences_with_repeated_keys_and_tokens(spark):
    df = spark.createDataFrame([(1, ["a"]), (1, ["b", "a"]), (1, ["a"])], "id int, tokens array<string>")
    vocabulary = spark.createDataFrame([("a", 4), ("a", 9), ("b", 5)], "token string, token_id int")
    out = encode.encode_sequences(df, ["id"], F.col("tokens"), vocabulary, 4).collect()
    assert sorted(r.input_ids for r in out) == [[2, 4, 3, 0], [2, 4, 3, 0], [2, 5, 4, 3]]


def test_sub_words_of_any_length(spark):
    table = spark.createDataFrame([("u",), ("##u",)], "piece string")
    words = spark.createDataFrame([("u" * 3000,)], "token string")
    assert encode.sub_words(words, table).first().pieces == ["u"] + ["##u"] * 2999
    assert encode.sub_words(words, table, max_word_chars=100).first().pieces == ["[UNK]"]
    none = spark.createDataFrame([], "piece string")
    assert encode.sub_words(words, none).first().pieces == ["[UNK]"]


def test_mean_pool(spark):
    rows = [(1, ["a", "?", "a", "b", "a"]), (2, ["b", "b"]), (3, ["?"]), (4, []), (5, None)]
    rows += [(6, ["c"]), (7, ["d"]), (8, ["null"]), (9, ["null", "d"])]
    docs = spark.createDataFrame(rows, "doc int, tokens array<string>")
    vectors = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("null", None), ("c", [1.0, 1.0]), ("c", [3.0, 5.0]), ("d", [5.0, 5.0])],
        "token string, vector array<float>",
    )
    out = encode.mean_pool(docs, ["doc"], F.col("tokens"), vectors).collect()
    got = {r.doc: list(r.pooled.toArray()) for r in out}
    assert got == {1: [0.75, 0.5], 2: [0.0, 2.0], 6: [2.0, 3.0], 7: [5.0, 5.0], 9: [5.0, 5.0]}


@pytest.mark.parametrize("least", [encode.LEAST_ROWS, 7])
def test_pooled_documents_by_brute_force(spark, monkeypatch, least):
    """In one slice and in several; a document is pooled in one task and no part of it moves again."""
    monkeypatch.setattr(encode, "LEAST_ROWS", least)
    draw = np.random.default_rng(4)
    rows = [(i if i % 5 else None, f"k{i % 3}", f"w{t}", int(n)) for i in range(20) for t, n in enumerate(draw.integers(1, 4, 9))]
    known = {f"w{t}": draw.random(3) for t in range(7)}
    tokens = spark.createDataFrame(rows, "id long, name string, token string, tf long")
    vectors = spark.createDataFrame([(w, v.tolist()) for w, v in known.items()], "token string, vector array<double>")
    pooled = encode.pool_counts(tokens, vectors, ["id", "name"])
    assert "ObjectHashAggregate" not in pooled._jdf.queryExecution().executedPlan().toString()
    expected = {}
    for i, name, w, n in rows:
        if w in known:
            total, weight = expected.get((i, name), (0, 0))
            expected[i, name] = total + n * known[w], weight + n
    got = {(r.id, r["name"]): r.pooled.toArray() for r in pooled.collect()}
    assert got.keys() == expected.keys()
    assert all(np.allclose(got[k], total / weight) for k, (total, weight) in expected.items())
    assert encode.pool_counts(tokens, vectors.limit(0), ["id", "name"]).count() == 0


def test_rows_without_a_label_keep_a_place(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "Label int")
    got = [tuple(r) for r in features.frequency_index(df).select("Label", "label_index").collect()]
    assert sorted(got, key=str) == [(0, 1.0), (1, 0.0), (1, 0.0), (None, None)]


def test_label_names_and_scores(spark):
    df = spark.createDataFrame([(0, [0.1, 0.9, 0.9], ["7"]), (1, [3.0], [])],
                               "y int, v array<double>, r array<string>")
    got = df.select(
        encode.label_ids(F.col("y")).alias("id"),
        L.argmax(F.col("v")).alias("best"),
        L.first_as_int(F.col("r")).alias("first"),
        L.sigmoid(F.lit(0.0)).alias("half"),
    ).collect()
    assert [tuple(r) for r in got] == [(0, 1, 7, 0.5), (1, 0, None, 0.5)]


def test_full_grid_and_named_models():
    assert len(classify.regression_grid(classify.logistic())) == 42
    assert classify.choose_model("rf").getMaxDepth() == 30
    assert classify.choose_model("gb").getMaxIter() == 10
    with pytest.raises(ValueError):
        classify.choose_model("lg")


def test_nested_chain_trains(docs):
    fitted = features.tfidf_stages(features.SMALL_VOCABULARY).fit(docs)
    model, metrics = classify.train_and_report(
        fitted, classify.logistic(5, 0.01), {"train": docs, "test": docs}, ["doc_id"]
    )
    rows = metrics.collect()
    assert {r.split for r in rows} == {"train", "test"}
    assert all(r.auroc > 0.5 and r.tn + r.tp + r.fn + r.fp == len(TEXTS) for r in rows)
    again = classify.nested(fitted, classify.logistic(5, 0.01)).fit(docs)
    a = classify.score(model, docs, ["doc_id"]).orderBy("doc_id").collect()
    b = classify.score(again, docs, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.score for r in a] == pytest.approx([r.score for r in b])


def test_features_are_fitted_on_the_whole_training_split(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 20)
    seen = []

    def make(rows):
        seen.append(rows.count())
        return models.plain_tfidf(rows)

    scored = models.scored_by(lambda: classify.logistic(2, 0.01), make)(spark, "/root/testdata/sf0.001")
    assert seen == [scored.where("split = 'train'").count()] and seen[0] > 20


def test_one_id_does_not_fill_the_sample(spark, monkeypatch):
    rows = [(i, i, c, c % 2, "some words") for i in range(20) for c in range(30)]
    frame = spark.createDataFrame(rows, "ID int, doc_id int, chunk_no int, Label int, TEXT string")
    monkeypatch.setattr(models, "chunks", lambda spark, d: frame)
    monkeypatch.setattr(models, "FIT_ROWS", 30)
    fit_set = models.parts(spark, "")[-1]
    assert fit_set.count() == 30 and fit_set.select("ID").distinct().count() > 5


def test_tfidf_from_one_count_is_that_of_the_stages(spark):
    texts = ["a b  b The c", "b c d", "", "a a e", "c b a", "b", "b c", "a b c", "f"]
    rows = spark.createDataFrame([(t,) for t in texts], "TEXT string")

    def weights(model):
        words = model.stages[-2].vocabulary
        got = model.transform(rows).select("TEXT", "features").collect()
        return {r.TEXT: {words[i]: round(float(v), 9) for i, v in zip(r.features.indices, r.features.values)} for r in got}

    for drop in (True, False):
        assert weights(features.fit_tfidf(rows, 100, drop)) == weights(features.tfidf_stages(100, drop).fit(rows))
    few = features.fit_tfidf(rows, 100, heard=rows.where("TEXT = 'b c d'"))
    assert few.stages[-2].vocabulary == ["b", "c", "d"]
    assert weights(few)["b c d"] == weights(features.fit_tfidf(rows, 100))["b c d"]


def test_text_is_cleaned_once_for_naive_bayes(spark, monkeypatch, tmp_path):
    from wardflow.registry import models

    made, cleaned = [(i, "a b c " * (1 + i % 3)) for i in range(20)], []
    spark.createDataFrame([*made, made[0]], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    expected = classify.naive_bayes_parameters(models.weights(spark, str(tmp_path)), models.clean_docs(spark, str(tmp_path)))[1]
    whole = models.clean_docs
    monkeypatch.setattr(models, "clean_docs", lambda *a: cleaned.append(a) or whole(*a))
    got = models.nb_tables(spark, str(tmp_path))[1]
    assert len(cleaned) == 1 and "documents.parquet" not in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_classifiers_are_fitted_on_the_whole_training_split(spark, monkeypatch):
    """However many chunks there are, each query gives all of the training split to its classifier or search."""
    rows = [(i, i, c, c % 2, "some words") for i in range(300) for c in range(10)]
    frame = spark.createDataFrame(rows, "ID int, doc_id int, chunk_no int, Label int, TEXT string").cache()
    monkeypatch.setattr(models, "chunks", lambda spark, d: frame)
    whole, train_set, fit_set = models.parts(spark, "")
    assert whole.count() == 3000 and fit_set.count() == train_set.count() > 2000
    seen = []

    class Seen(Exception):
        pass

    def see(at):
        def called(*given, **_):
            seen.append(given[at].count())
            raise Seen

        return called

    monkeypatch.setattr(classify, "train", see(2))
    monkeypatch.setattr(classify, "cross_validate", see(2))
    monkeypatch.setattr(models.folds, "refit_per_fold", see(1))
    names = ["ml12_grid_metrics", "ml14_cross_validation_table", "so4_best_parameters", "ml13_cross_validated_scores"]
    names += ["ml16_chunk_scores", "ml6_elastic_net_scores", "ml6_logistic_scores", "ml8_naive_bayes_scores", "ml9_boosted_tree_leaves"]
    for name in names:
        with pytest.raises(Seen):
            next(q for q in models.MODELS if q.name == name).run(spark, "whole")
    assert seen == [train_set.count()] * len(names)


def test_tokens_of_a_row_are_counted_where_it_lies(spark):
    """No token is shuffled to be counted; the pooled vectors are those of one row per document and token."""
    made = [(1, "a", ["x", "y", "x", None]), (2, None, ["z"]), (2, None, ["x", "z"]), (3, "b", None), (4, "b", []), (5, "c", ["none"])]
    docs = spark.createDataFrame(made, "id int, name string, tokens array<string>").repartition(3)
    counted = encode.row_tokens(docs, ["id", "name"], F.col("tokens"))
    assert "Exchange hashpartitioning" not in counted._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.id, r.n_words, sorted(zip(r.tokens, r.tfs))) for r in counted.collect())
    assert got == [(1, 4, [("x", 2), ("y", 1)]), (2, 1, [("z", 1)]), (2, 2, [("x", 1), ("z", 1)]), (3, 0, []), (4, 0, []), (5, 1, [("none", 1)])]
    vectors = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [4.0, 0.0]), ("z", [0.0, 5.0]), ("z", [2.0, 1.0])], "token string, vector array<float>")
    flat = encode.document_tokens(docs, ["id", "name"], F.col("tokens"))
    packed, expected = (
        {r.id: [round(v, 9) for v in r.pooled] for r in frame.collect()}
        for frame in (encode.mean_pool(docs, ["id", "name"], F.col("tokens"), vectors), encode.pool_counts(flat, vectors, ["id", "name"]))
    )
    assert packed == expected and set(packed) == {1, 2}
    assert packed[1] == [2.0, round(4 / 3, 9)]
