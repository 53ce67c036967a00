"""Evaluation, features, classifiers and composite jobs."""

from __future__ import annotations

import functools
from dataclasses import replace

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from wardflow.functions import text
from wardflow.functions.text import space_tokens
from wardflow.operators import (
    classify,
    encode,
    evaluate,
    external,
    features,
    folds,
    minibatch,
    sampling,
    word_vectors,
)
from wardflow.plans import jobs
from wardflow.registry.profiles import BOX, SUMMARY, box_sql, density_sql, describe_sql
from wardflow.registry.query import Query
from wardflow.registry.relational import (
    COHORT_COLUMNS,
    MONTH_LABEL,
    clean_docs,
    digest,
    doc_terms,
    id_labels,
    src,
    vocabulary,
)
from wardflow.registry.tables import gap_label
from wardflow.registry.text import ENGLISH, stop_list
from wardflow.sources import shared, sinks, standin

KEYS = ["doc_id", "chunk_no"]
SUMMARY_MEASURES, BOX_MEASURES = (" ".join(c.split(":")[0].strip() for c in x.split(",")) for x in (SUMMARY, BOX))
SCORE_COLUMNS = "doc_id:i, chunk_no:i, Label:i, score:d, prediction:i"

# evaluation --------------------------------------------------------------------------

TRAPEZOID = """
    SELECT sum((fpr - fpr0) * (tpr + tpr0) / 2) AS auroc,
           sum((tpr - tpr0) * (prec + prec0) / 2) AS auprc,
           sum((tpr - tpr0) * (prec + CASE WHEN place = 1 THEN prec ELSE prec0 END) / 2)
               AS auprc_flat
    FROM (SELECT *, lag(fpr) OVER w AS fpr0, lag(tpr) OVER w AS tpr0, lag(prec) OVER w AS prec0
          FROM {}_points WINDOW w AS (ORDER BY place))"""

CONFUSION = """
    SELECT count(*) FILTER (prediction = 0 AND "Label" = 0) AS tn,
           count(*) FILTER (prediction = 1 AND "Label" = 1) AS tp,
           count(*) FILTER (prediction = 0 AND "Label" = 1) AS fn,
           count(*) FILTER (prediction = 1 AND "Label" = 0) AS fp FROM scores"""

REPORT = """
    WITH classes AS (
        SELECT c AS cls, count(*) FILTER ("Label" = c) AS support,
               count(*) FILTER (prediction = c) AS predicted,
               count(*) FILTER ("Label" = c AND prediction = c) AS tp
        FROM scores, (VALUES (0), (1)) AS v(c) GROUP BY c),
    rates AS (
        SELECT *, coalesce(tp / nullif(predicted, 0)::DOUBLE, 0) AS precision,
               coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS recall,
               coalesce(2 * tp / nullif(support + predicted, 0)::DOUBLE, 0) AS f1
        FROM classes)
    SELECT cls::VARCHAR AS class, precision, recall, f1, support FROM rates
    UNION ALL
    SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support)::DOUBLE, sum(support) FROM rates
    UNION ALL
    SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rates
    UNION ALL
    SELECT 'weighted avg', sum(precision * support) / sum(support),
           sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
    FROM rates"""


def scores(spark, d):
    return standin.scores(spark, d)


def votes(spark, d):
    return evaluate.vote_scores(scores(spark, d))


def ev12(spark, d):
    ids = id_labels(spark, d)
    parts = sampling.class_balance(ids, 30)
    return sampling.split_audit(parts)


EVALUATION = [
    Query(
        "ev1_auroc",
        "auroc:d",
        lambda s, d: evaluate.curve_metrics(scores(s, d)),
        TRAPEZOID.format("scores"),
        ("scores_points",),
    ),
    Query(
        "ev2_auprc",
        "auprc:d, auprc_flat:d",
        lambda s, d: evaluate.curve_metrics(scores(s, d)),
        TRAPEZOID.format("scores"),
        ("scores_points",),
    ),
    Query(
        "ev3_confusion_pairs",
        "Label:i, prediction:i, n:i",
        lambda s, d: evaluate.confusion_pairs(scores(s, d)),
        'SELECT "Label", prediction, count(*) AS n FROM scores GROUP BY 1, 2',
        ("scores",),
    ),
    Query(
        "ev3_confusion",
        "tn:i, tp:i, fn:i, fp:i",
        lambda s, d: evaluate.confusion(scores(s, d)),
        CONFUSION,
        ("scores",),
    ),
    Query(
        "ev4_binary_metrics",
        "accuracy:d, precision:d, recall:d, f1:d",
        lambda s, d: evaluate.binary_metrics(scores(s, d)),
        f"""SELECT (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy,
                   tp / (tp + fp)::DOUBLE AS precision, tp / (tp + fn)::DOUBLE AS recall,
                   2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1 FROM ({CONFUSION})""",
        ("scores",),
    ),
    Query(
        "ev5_f_measure_by_label",
        "f_measure:d",
        lambda s, d: evaluate.f_measure_by_label(scores(s, d)),
        f"SELECT 2 * tp / (2 * tp + fp + fn)::DOUBLE AS f_measure FROM ({CONFUSION})",
        ("scores",),
    ),
    Query(
        "ev6_roc_points",
        "threshold:d, fpr:d, tpr:d",
        lambda s, d: evaluate.roc_points(scores(s, d)),
        "SELECT * FROM scores_points",
        ("scores_points",),
    ),
    Query(
        "ev7_pr_points",
        "threshold:d, precision:d, recall:d",
        lambda s, d: evaluate.pr_points(scores(s, d)),
        "SELECT threshold, prec AS precision, tpr AS recall FROM scores_points WHERE place > 0",
        ("scores_points",),
    ),
    Query(
        "ev8_chunk_evaluation",
        "eval_loss:d, eval_accuracy:d",
        lambda s, d: evaluate.chunk_evaluation(scores(s, d)),
        """SELECT avg(CASE WHEN prediction = "Label" THEN 1.0 ELSE 0.0 END) AS eval_accuracy,
                  avg(-CASE WHEN "Label" = 1 THEN ln(greatest(score, 1e-12))
                            ELSE ln(1 - least(score, 1 - 1e-12)) END) AS eval_loss FROM scores""",
        ("scores",),
    ),
    Query(
        "ev9_vote_metrics",
        "auroc:d, auprc:d",
        lambda s, d: evaluate.curve_metrics(votes(s, d)),
        TRAPEZOID.format("votes"),
        ("votes_points",),
    ),
    Query(
        "ev9_vote_roc_points",
        "threshold:d, fpr:d, tpr:d",
        lambda s, d: evaluate.roc_points(votes(s, d)),
        "SELECT * FROM votes_points",
        ("votes_points",),
    ),
    Query(
        "ev9_vote_pr_points",
        "threshold:d, precision:d, recall:d",
        lambda s, d: evaluate.pr_points(votes(s, d)),
        "SELECT threshold, prec AS precision, tpr AS recall FROM votes_points WHERE place > 0",
        ("votes_points",),
    ),
    Query(
        "ev10_vote_rp80",
        "rp80:d, rp80_threshold:d",
        lambda s, d: evaluate.curve_metrics(votes(s, d)),
        """SELECT coalesce(arg_min(tpr, threshold), 0) AS rp80, min(threshold) AS rp80_threshold
           FROM votes_points WHERE place > 0 AND prec > 0.799999""",
        ("votes_points",),
    ),
    Query(
        "ev11_classification_report",
        "class:s, precision:d, recall:d, f1:d, support:i",
        lambda s, d: evaluate.classification_report(scores(s, d)),
        REPORT,
        ("scores",),
    ),
    Query(
        "ev12_split_audit",
        "split:s, Label:i, rows:i, ids:i, overlapping_ids:i",
        ev12,
        """WITH used AS (
               SELECT "ID", "Label", CASE WHEN split = 'extra' THEN 'train' ELSE split END AS split
               FROM split_ids WHERE split <> 'unused')
           SELECT split, "Label", count(*) AS rows, count(DISTINCT "ID") AS ids,
                  count(DISTINCT CASE WHEN (SELECT count(DISTINCT o.split) FROM used o
                                            WHERE o."ID" = used."ID") > 1
                                      THEN "ID" END) AS overlapping_ids
           FROM used GROUP BY split, "Label" """,
        ("split_ids",),
    ),
]

# features ----------------------------------------------------------------------------


def ml1(spark, d):
    kept = vocabulary(spark, d).select("token")
    return doc_terms(spark, d).join(kept, "token", "left_semi")


def ml2(spark, d):
    docs = clean_docs(spark, d)
    n_documents = docs.agg(F.count("*")).scalar()
    return features.inverse_document_frequency(
        encode.document_frequencies(docs, space_tokens(F.col("TEXT"))), n_documents
    )


def weights(spark, d):
    return features.term_weights(doc_terms(spark, d), ml2(spark, d), vocabulary(spark, d))


def ml3(spark, d):
    rows = features.frequency_index(standin.labelled_docs(spark, d))
    return features.label_as_double(rows)


def nb_tables(spark, d):
    """From text that is cleaned once; its tokens are counted once for vocabulary and weights."""
    docs = shared.materialised(clean_docs(spark, d))
    tokens = space_tokens(F.col("TEXT"))
    counts = shared.materialised(features.word_counts(docs.select(tokens.alias("words")), "words"))
    kept = encode.top_vocabulary(counts, features.SMALL_VOCABULARY)
    idf = features.inverse_document_frequency(counts, F.lit(docs.count()))
    terms = encode.document_tokens(docs, ["doc_id", "Label"], tokens)
    return classify.naive_bayes_parameters(features.term_weights(terms, idf, kept), docs)


FEATURES = [
    Query(
        "ml1_term_counts",
        "doc_id:i, token:s, tf:i",
        ml1,
        "SELECT doc_id, token, tf FROM doc_terms WHERE token IN (SELECT token FROM vocabulary)",
        ("doc_terms", "vocabulary"),
    ),
    Query("ml2_idf", "token:s, df:i, idf:d", ml2, "SELECT * FROM token_idf", ("token_idf",)),
    Query(
        "ml2_tfidf",
        "doc_id:i, token:s, tf:i, tfidf:d",
        weights,
        """SELECT doc_id, token, tf, tf * idf AS tfidf
           FROM doc_terms JOIN token_idf USING (token)
           WHERE token IN (SELECT token FROM vocabulary)""",
        ("doc_terms", "token_idf", "vocabulary"),
    ),
    Query(
        "ml3_label_index",
        "doc_id:i, Label:d, label_index:d",
        ml3,
        """SELECT doc_id, "Label"::DOUBLE AS "Label", place AS label_index
           FROM docs JOIN (SELECT "Label", row_number() OVER (ORDER BY count(*) DESC, "Label") - 1
                                  AS place FROM docs GROUP BY 1) USING ("Label")""",
        ("docs",),
    ),
    Query(
        "ml8_nb_priors",
        "Label:i, log_prior:d",
        lambda s, d: nb_tables(s, d)[0],
        """SELECT "Label", ln(count(*) + 1.0)
                  - ln((SELECT count(*) FROM docs) + (SELECT count(DISTINCT "Label") FROM docs))
                  AS log_prior FROM docs GROUP BY 1""",
        ("docs",),
    ),
    Query(
        "ml8_nb_likelihoods",
        "Label:i, token:s, log_likelihood:d",
        lambda s, d: nb_tables(s, d)[1],
        """WITH w AS (
               SELECT "Label", token, sum(tf * idf) AS w
               FROM doc_terms JOIN token_idf USING (token)
               WHERE token IN (SELECT token FROM vocabulary) GROUP BY 1, 2)
           SELECT "Label", token,
                  ln(w + 1) - ln(sum(w) OVER (PARTITION BY "Label")
                                 + (SELECT count(DISTINCT token) FROM w)) AS log_likelihood
           FROM w""",
        ("doc_terms", "token_idf", "vocabulary"),
    ),
]

# classifiers, at the sizes of the tuned models ------------------------------------------

#: Labelled chunks that a classifier is fitted on: all of the training split. No query sets a number; with
#: one, a caller asks for those with the smallest hash of their key.
FIT_ROWS: int | None = None


def chunks(spark, d):
    """Cut off from the text chain, since fitting passes over them many times."""
    return shared.materialised(standin.labelled_chunks(spark, d))


def parts(spark, d):
    """All chunks with ``split`` by a hash of the id, the training split, on all of which features
    are fitted, and those of its chunks that a classifier is fitted on: all, unless ``FIT_ROWS`` is set."""
    share = sampling.hash_share(F.col("ID"))
    split = F.when(share < 0.8, "train").when(share < 0.9, "val").otherwise("test")
    rows = chunks(spark, d).withColumn("split", split)
    train_set = rows.where("split = 'train'")
    if FIT_ROWS is None:
        return rows, train_set, train_set
    order = [sampling.seeded_hash(F.concat_ws(":", "ID", *KEYS), 1), F.col("ID"), *map(F.col, KEYS)]
    return rows, train_set, shared.materialised(train_set.orderBy(*order).limit(FIT_ROWS))


def notebook_tfidf(rows):
    return features.fit_tfidf(rows)


def plain_tfidf(rows):
    """The second chain: fewer terms, stop words stay."""
    return features.tfidf_stages(features.SMALL_VOCABULARY, drop_stop_words=False).fit(rows)


def scored_by(classifier, make_features=notebook_tfidf):
    """Fitted on the training split, all splits scored; written once for its two queries."""

    @functools.lru_cache(maxsize=1)
    def frame(spark, d):
        rows, train_set, fit_set = parts(spark, d)
        model = classify.train(make_features(train_set), classifier(), fit_set)
        return shared.materialised(classify.score(model, rows, [*KEYS, "split"]))

    return frame


def report_of(classifier, make_features=plain_tfidf):
    """Every split is reported whole."""

    def frame(spark, d):
        rows, train_set, fit_set = parts(spark, d)
        model = classify.train(make_features(train_set), classifier(), fit_set)
        split = {n: rows.where(F.col("split") == n) for n in ("train", "val", "test")}
        return classify.split_metrics({n: classify.score(model, part, KEYS) for n, part in split.items()})

    return frame


def ml4(spark, d):
    """Scores of the nested chain, and whether the flat chain gives the same."""
    rows, train_set, fit_set = parts(spark, d)
    fitted, classifier = notebook_tfidf(train_set), classify.logistic(10, 0.01)
    nested = classify.score(classify.nested(fitted, classifier).fit(fit_set), rows, [*KEYS, "split"])
    flat = classify.score(classify.train(fitted, classifier, fit_set), rows, KEYS)
    near = F.abs(F.col("score") - F.col("_flat")) < 1e-9
    return nested.join(flat.select(*KEYS, F.col("score").alias("_flat")), KEYS).withColumn(
        "same", near.cast("int")
    )


WORD_VECTORS = word_vectors.Settings()


def clinical_words(rows):
    """Tokens without clinical stop words, in the order of the text."""
    return rows.withColumn("words", text.without_stop_words(text.word_tokens(F.col("TEXT")), text.CLINICAL_STOP_WORDS))


def ml5(spark, d):
    """Vectors of size 1000 trained in blocks on all training chunks, pooled for all chunks."""
    rows, train_set, _ = parts(spark, d)
    vectors = shared.materialised(word_vectors.fit(clinical_words(train_set), F.col("words"), WORD_VECTORS))
    pooled = word_vectors.mean_vectors(clinical_words(rows), KEYS, F.col("words"), vectors, WORD_VECTORS.vector_size)
    return pooled.select(*KEYS, F.posexplode("features").alias("dim", "value"))


def scored_on_vectors(classifier):
    """As ``scored_by``, on the mean word vectors of a chunk; they are trained in blocks on all
    training chunks. Rows are told apart by a number, since keys may repeat."""

    @functools.lru_cache(maxsize=1)
    def frame(spark, d):
        rows, train_set, fit_set = parts(spark, d)
        vectors = shared.materialised(word_vectors.fit(clinical_words(train_set), F.col("words"), WORD_VECTORS))
        keys = ["row", *KEYS, "Label", "split"]

        def pooled(part):
            numbered = clinical_words(part).withColumn("row", F.monotonically_increasing_id())
            return word_vectors.mean_vectors(numbered, keys, F.col("words"), vectors, WORD_VECTORS.vector_size)

        def as_features(mean):
            return mean.withColumn("features", array_to_vector("features"))

        # pooled once, for the fit and for the scores
        every = shared.materialised(pooled(rows))
        fitted = every.where("split = 'train'") if fit_set is train_set else shared.materialised(pooled(fit_set))
        shared.drop_table(vectors)
        model = classify.fit_on_features(classifier(), as_features(fitted), stored=True)
        scored = shared.materialised(classify.score(model, as_features(every), [*KEYS, "split"]))
        shared.drop_table(every)
        return scored

    return frame


def ml5_pairs(spark, d):
    """What the vectors are trained on: each two words of the vocabulary once, with their weight."""
    train_set = parts(spark, d)[1]
    cut = word_vectors.sentences(clinical_words(train_set), F.col("words"), WORD_VECTORS.max_sentence_length)
    rows = shared.materialised(cut)
    words = shared.materialised(word_vectors.vocabulary(rows, WORD_VECTORS))
    pairs = word_vectors.co_occurrences(rows, WORD_VECTORS.window, words)
    dealt = word_vectors.cells(pairs, words, WORD_VECTORS.least_blocks)
    return dealt.where("centre <= context").select("centre", "context", "weight")


def ml9(spark, d):
    rows, train_set, fit_set = parts(spark, d)
    model = classify.train(notebook_tfidf(train_set), classify.boosted_trees(), fit_set)
    leaves = F.array_join(vector_to_array("leafId").cast("array<int>"), ",")
    return model.transform(rows).select(*KEYS, "split", leaves.alias("leaves"), "prediction")


def ml10(spark, d):
    """The named models on the same features, judged on the test split."""
    rows, train_set, fit_set = parts(spark, d)
    fitted = plain_tfidf(train_set)
    out = []
    for name in ("lr", "rf", "gb"):
        model = classify.train(fitted, classify.choose_model(name), fit_set)
        scored = classify.score(model, rows.where("split = 'test'"), KEYS)
        out.append(evaluate.binary_metrics(scored).withColumn("model", F.lit(name)))
    return functools.reduce(lambda a, b: a.unionByName(b), out)


@functools.lru_cache(maxsize=1)
def _search(spark, d):
    """The tuned grid, 42 points on 5 folds, over shared features; one search for its queries.

    All fits and thresholds come from the whole training split.
    """
    _, train_set, fit_set = parts(spark, d)
    rows = features.fit_tfidf(train_set).transform(fit_set).select("Label", "features")
    classifier = classify.logistic()
    grid = classify.regression_grid(classifier)
    return classify.grid_metrics(spark, classify.cross_validate(classifier, grid, rows))


def folded(rows):
    """Chunks with their fold, by a hash of the admission, and words without stop words."""
    words = text.without_stop_words(space_tokens(F.col("TEXT")), text.default_stop_words())
    return folds.with_folds(rows, F.col("ID")).withColumn("words", F.filter(words, lambda w: w != ""))


@functools.lru_cache(maxsize=1)
def ml13(spark, d):
    """Vocabulary, weights and classifier refitted on each fold over the grid, all on the whole
    training split; the best chain scores all splits."""
    rows, train_set, fit_set = parts(spark, d)
    classifier = classify.logistic()
    labelled = shared.materialised(folded(fit_set).withColumn("Label", F.col("Label").cast("double")).select("fold", "words", "Label"))
    grid = classify.regression_grid(classifier)
    # the rows that are fitted are those that are counted: their words are cut once
    counted = labelled if fit_set is train_set else folded(train_set)
    _, best = folds.refit_per_fold(counted, labelled, classifier, grid)
    return shared.materialised(classify.score(best, folded(rows), [*KEYS, "split"]))


def ml13_vocabularies(spark, d):
    """The most frequent terms outside each fold, with the weights that its classifiers see."""
    rows = folded(parts(spark, d)[1])
    return folds.fold_vocabularies(folds.fold_counts(rows, F.col("words")), rows, features.SMALL_VOCABULARY)


def ml15(spark, d):
    tokens = space_tokens(F.col("TEXT"))
    counted = shared.materialised(encode.document_tokens(clean_docs(spark, d), ["doc_id", "Label"], tokens))
    vectors = shared.materialised(standin.vector_table(spark, d, counted))
    pooled = encode.pool_counts(counted, vectors, ["doc_id", "Label"])
    whole = F.lit(0).alias("chunk_no")
    values = vector_to_array("pooled").alias("features")
    rows = shared.materialised(pooled.select("doc_id", whole, "Label", values))
    rows = sampling.hash_split(rows, F.col("doc_id"))
    weights, _ = minibatch.fit(rows.where("split = 'train'"), KEYS)
    scored = rows.withColumn("score", minibatch.score(weights, F.col("features")))
    return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def ml16_exported(spark, d):
    """Scores of the exported weights, by code that knows no Spark ML, and whether they are the model's."""
    rows, train_set, fit_set = parts(spark, d)
    fitted = plain_tfidf(train_set)
    model = classify.train(fitted, classify.logistic(10, 0.01), fit_set)
    path = external.export_linear(spark, model.stages[-1], shared.shared_path(spark, "linear"))
    places, values = external.sparse_pairs(F.col("features"))
    outside = external.scorer(spark.read.parquet(path), places, values)
    scored = classify.score(model, rows, [*KEYS, "split", "features"]).withColumn("_outside", outside)
    return scored.withColumn("same", (F.abs(F.col("score") - F.col("_outside")) < 1e-9).cast("int"))


#: All chunks with their split and a flag that is 1.
SPLIT_CHUNKS = """SELECT doc_id, chunk_no, "Label", 1 AS {},
                  CASE WHEN share < 0.8 THEN 'train' WHEN share < 0.9 THEN 'val' ELSE 'test' END AS split
           FROM (SELECT *, ('0x' || substr(md5("ID"::VARCHAR), 1, 8))::BIGINT
                           / 4294967296.0::DOUBLE AS share FROM doc_chunks)"""


TRAIN_CHUNKS = """(SELECT * FROM doc_chunks
        WHERE ('0x' || substr(md5("ID"::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8)"""

#: Chunks are shorter than the longest sentence.
TRAINING_PAIRS = rf"""
    WITH rows AS (
        SELECT doc_id, chunk_no, list_filter(regexp_split_to_array(lower("TEXT"), '\W'),
               lambda t: t <> '' AND t NOT IN ({stop_list(text.CLINICAL_STOP_WORDS)})) AS w
        FROM {TRAIN_CHUNKS}),
    known AS (SELECT t FROM (SELECT unnest(w) AS t FROM rows) GROUP BY t HAVING count(*) >= 10),
    places AS (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM rows),
    pairs AS (SELECT least(w[i], w[i + d]) AS centre, greatest(w[i], w[i + d]) AS context, 6 - d AS x
              FROM places, (SELECT unnest(range(1, 6)) AS d) WHERE i + d <= len(w))
    SELECT centre, context, CASE WHEN centre = context THEN 2 ELSE 1 END * sum(x) / 5.0::DOUBLE AS weight
    FROM pairs WHERE centre IN (SELECT t FROM known) AND context IN (SELECT t FROM known)
    GROUP BY centre, context"""

FOLD_VOCABULARIES = rf"""
    WITH rows AS (
        SELECT doc_id, chunk_no, ('0x' || substr(md5("ID"::VARCHAR || ':fold'), 1, 8))::BIGINT % 5 AS own,
               list_filter(regexp_split_to_array(lower("TEXT"), '\s'),
               lambda t: t <> '' AND t NOT IN ({stop_list(ENGLISH)})) AS w
        FROM {TRAIN_CHUNKS}),
    folds AS (SELECT unnest(range(0, 5)) AS fold),
    sizes AS (SELECT fold, count(*) AS m FROM folds, rows WHERE own <> fold GROUP BY fold),
    terms AS (SELECT own, t, count(*) AS df, sum(tf) AS freq
              FROM (SELECT own, doc_id, chunk_no, t, count(*) AS tf
                    FROM (SELECT own, doc_id, chunk_no, unnest(w) AS t FROM rows) GROUP BY ALL) GROUP BY own, t),
    outside AS (SELECT fold, t, sum(df) AS df, sum(freq) AS freq FROM folds, terms WHERE own <> fold GROUP BY fold, t),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY freq DESC, encode(t)) AS place FROM outside)
    SELECT ranked.fold, t AS token, freq, df, CASE WHEN df < 5 THEN 0 ELSE ln((m + 1.0::DOUBLE) / (df + 1)) END AS idf
    FROM ranked JOIN sizes ON sizes.fold = ranked.fold WHERE place <= 3000"""


def sound(query):
    """Every chunk is scored once, with its label and split, a score from 0 to 1, and the
    prediction that the score asks for."""

    def frame(spark, d):
        asked = (F.col("score") > 0.5).cast("int")
        good = F.col("score").between(0, 1) & (F.col("prediction") == asked)
        return query.frame(spark, d).withColumn("sound", F.coalesce(good, F.lit(False)).cast("int"))

    name = query.name.replace("_scores", "") + "_sound"
    columns = "doc_id:i, chunk_no:i, Label:i, split:s, sound:i"
    return Query(name, columns, frame, SPLIT_CHUNKS.format("sound"), ("doc_chunks",))


GRID_COLUMNS = "regParam:d, maxIter:d, elasticNetParam:d, fMeasureByLabel:d"
SPLIT_SCORES = SCORE_COLUMNS + ", split:s"

MODELS = [
    Query(
        "ml4_nested_stages",
        "doc_id:i, chunk_no:i, Label:i, split:s, same:i",
        ml4,
        SPLIT_CHUNKS.format("same"),
        ("doc_chunks",),
    ),
    Query("ml5_word2vec_features", "doc_id:i, chunk_no:i, dim:i, value:d", ml5),
    Query("ml5_training_pairs", "centre:s, context:s, weight:d", ml5_pairs, TRAINING_PAIRS, ("doc_chunks",)),
    Query("ml6_logistic_scores", SPLIT_SCORES, scored_by(lambda: classify.logistic(20, 1e-4))),
    Query(
        "ml6_elastic_net_scores",
        SPLIT_SCORES,
        scored_by(lambda: classify.logistic(10, 0.005, 0.5)),
    ),
    Query(
        "ml6_logistic_on_word2vec",
        SPLIT_SCORES,
        scored_on_vectors(lambda: classify.logistic(10, 1e-4)),
    ),
    Query("ml7_forest_scores", SPLIT_SCORES, scored_by(lambda: classify.forest(subsample=0.88))),
    Query("ml8_naive_bayes_scores", SPLIT_SCORES, scored_by(classify.naive_bayes)),
    Query("ml9_boosted_tree_leaves", "doc_id:i, chunk_no:i, split:s, leaves:s, prediction:i", ml9),
    Query("ml10_named_models", "model:s, accuracy:d, precision:d, recall:d, f1:d", ml10),
    Query(
        "ml11_train_and_report",
        "split:s, auroc:d, auprc:d, rp80:d, accuracy:d, precision:d, recall:d, f1:d",
        report_of(lambda: classify.logistic(10, 0.01)),
    ),
    Query("ml12_grid_metrics", GRID_COLUMNS, _search),
    Query("ml13_cross_validated_scores", SPLIT_SCORES, ml13),
    Query(
        "ml13_fold_vocabularies",
        "fold:i, token:s, freq:i, df:i, idf:d",
        ml13_vocabularies,
        FOLD_VOCABULARIES,
        ("doc_chunks",),
    ),
    Query("ml14_cross_validation_table", GRID_COLUMNS, _search),
    Query("so4_best_parameters", GRID_COLUMNS, lambda s, d: classify.best_point(_search(s, d))),
    Query("ml15_pooled_perceptron_scores", SPLIT_SCORES, ml15),
    Query(
        "ml16_exported_scores",
        "doc_id:i, chunk_no:i, Label:i, split:s, same:i",
        ml16_exported,
        SPLIT_CHUNKS.format("same"),
        ("doc_chunks",),
    ),
    Query("ml16_chunk_scores", SPLIT_SCORES, scored_by(lambda: classify.logistic(10, 0.01))),
]

MODELS += [
    sound(q) for q in MODELS if q.columns == SPLIT_SCORES and q.name != "ml15_pooled_perceptron_scores"
]

# composite jobs ----------------------------------------------------------------------


def cohort_query(n_days):
    def frame(spark, d):
        return digest(jobs.extract_readmission(src(spark, d), n_days))

    return Query(
        f"jb1_cohort_{n_days}_days",
        COHORT_COLUMNS + ", OUTPUT_LABEL:i, text_len:i, text_md5:s",
        frame,
        f"""SELECT * REPLACE ({gap_label(n_days)} AS "OUTPUT_LABEL"), note_len AS text_len,
                   md5("TEXT") AS text_md5 FROM cohort""",
        ("cohort",),
    )


def jb4(spark, d):
    """Train on the balanced cohort chunks and report each split."""
    rows = shared.materialised(jobs.training_data(src(spark, d), 180))
    split = {n: rows.where(F.col("split") == n) for n in ("train", "val", "test")}
    fitted = plain_tfidf(split["train"])
    return jobs.train_and_evaluate(fitted, classify.logistic(10, 0.005, 0.5), split, ["ID", "chunk_no"])[1]


def jb6_stored(spark, d):
    """From chunk scores that were written and read again by their key."""
    keys = ["ID", "doc_id", "chunk_no"]
    path = sinks.write_chunk_scores(scores(spark, d), shared.shared_path(spark, "jb6"), keys)
    stored = spark.read.parquet(path).withColumnsRenamed(
        {"logits": "score", "pred_label": "prediction", "label": "Label"}
    )
    return jobs.vote_report(stored)


def jb7(spark, d):
    return jobs.profile_rows(jobs.cohort_profile(src(spark, d), standin.demographics(spark, d)))


def jb8(spark, d):
    vectors = shared.materialised(standin.vector_table(spark, d))
    return jobs.embedding_classifier(src(spark, d), vectors)[1]


def _by(key, values, table):
    return f"SELECT {key}, {values} FROM {table} GROUP BY ALL"


TRANSITIONS = ", ".join(
    f"""count(*) FILTER ("NEXT_ADMISSION_TYPE" = '{t}') AS "{t}" """ for t in jobs.ADMISSION_TYPES
)
# section: measures and SQL of each frame of the profile
JB7_SECTIONS = {
    "type_shares": (
        "n share",
        """SELECT "ADMISSION_TYPE", count(*) AS n,
                  count(*) / (sum(count(*)) OVER ())::DOUBLE AS share FROM source GROUP BY 1""",
    ),
    "gap_summary": (SUMMARY_MEASURES, describe_sql('"DAYS_NEXT_ADMIT"', "cohort")),
    "label_counts": (
        "Count",
        """SELECT 'OUTPUT_LABEL' AS "Target", "OUTPUT_LABEL"::VARCHAR AS "Readmission_label",
                  count(*) AS "Count" FROM cohort GROUP BY 2
           UNION ALL SELECT 'OUTPUT_LABEL_180', "OUTPUT_LABEL_180"::VARCHAR, count(*) FROM cohort
           GROUP BY 2""",
    ),
    "transitions": (
        " ".join([*jobs.ADMISSION_TYPES, "other"]),
        f"""SELECT "ADMISSION_TYPE", {TRANSITIONS},
                   count(*) FILTER ("NEXT_ADMISSION_TYPE" NOT IN {tuple(jobs.ADMISSION_TYPES)}) AS other
            FROM cohort WHERE "ADMISSION_TYPE" IS NOT NULL AND "NEXT_ADMISSION_TYPE" IS NOT NULL
            GROUP BY 1""",
    ),
    "note_length": (SUMMARY_MEASURES, describe_sql("note_len", "cohort")),
    "note_length_by_label": (
        "min_len max_len mean_len",
        _by(
            '"OUTPUT_LABEL"',
            "min(note_len) AS min_len, max(note_len) AS max_len, avg(note_len) AS mean_len",
            "cohort",
        ),
    ),
    "notes_per_admission": (SUMMARY_MEASURES, describe_sql("notecnt", "per_admission")),
    "multi_note_ratio": (
        "ratio",
        """SELECT count(*) FILTER (notecnt > 1) / (SELECT count(*) FROM source)::DOUBLE AS ratio
           FROM per_admission""",
    ),
    "note_length_boxes": (BOX_MEASURES, box_sql("OUTPUT_LABEL", "note_len", "cohort")),
    "note_length_boxes_180": (BOX_MEASURES, box_sql("OUTPUT_LABEL_180", "note_len", "cohort")),
    "note_length_density": ("x density", density_sql("OUTPUT_LABEL", "note_len", "cohort")),
    "age_kept": (
        "kept_share",
        """SELECT count(*) FILTER ("AGE" < 200) / count(*)::DOUBLE AS kept_share FROM aged""",
    ),
    "age_summary": (SUMMARY_MEASURES, describe_sql('"AGE"', "aged")),
    "age_boxes": (BOX_MEASURES, box_sql("OUTPUT_LABEL", '"AGE"', "adults")),
    "age_density": ("x density", density_sql("OUTPUT_LABEL", '"AGE"', "adults")),
    "gender_counts": ("n", _by('"OUTPUT_LABEL", "GENDER"', "count(*) AS n", "adults")),
}


def profile_sql():
    tables = """
        per_admission AS (SELECT count(*) AS notecnt FROM source GROUP BY "SUBJECT_ID", "HADM_ID"),
        aged AS (SELECT cohort."OUTPUT_LABEL", people.* FROM cohort
                 LEFT JOIN people USING ("SUBJECT_ID", "HADM_ID")),
        adults AS (SELECT * FROM aged WHERE "AGE" < 200)"""
    tables += "".join(f", s_{n} AS ({sql})" for n, (_, sql) in JB7_SECTIONS.items())
    parts = []
    for name, (measures, _) in JB7_SECTIONS.items():
        keys = ", ".join(f'"{k}"::VARCHAR' for k in jobs.PROFILE_KEYS[name]) or "''"
        for m in measures.split():
            parts.append(
                f"SELECT '{name}' AS section, concat_ws('|', {keys}) AS key,"
                f" '{m}' AS measure, \"{m}\"::DOUBLE AS value FROM s_{name}"
            )
    return f"WITH {tables} " + " UNION ALL ".join(parts)


JOBS = [
    cohort_query(30),
    cohort_query(180),
    Query(
        "jb2_labelled_clean_notes",
        "SUBJECT_ID:i, HADM_ID:i, LABEL:i, TEXT:s",
        lambda s, d: jobs.readmission_etl(src(s, d), 30),
        "SELECT * FROM clean_cohort",
        ("clean_cohort",),
    ),
    Query(
        "jb3_training_data",
        "split:s, ID:i, Label:i, chunk_no:i, text_len:i, text_md5:s",
        lambda s, d: digest(jobs.training_data(src(s, d), 30)),
        'SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5 FROM chunk_splits',
        ("chunk_splits",),
    ),
    Query(
        "jb4_train_and_evaluate",
        "split:s, auroc:d, auprc:d, accuracy:d, precision:d, recall:d, f1:d",
        jb4,
    ),
    Query(
        "jb5_month_labelled_set",
        "SUBJECT_ID:i, HADM_ID:i, CHARTDATE:t, text_len:i, text_md5:s, readmitted:i",
        lambda s, d: digest(jobs.month_labelled_set(src(s, d)), "text_new"),
        rf"""SELECT "SUBJECT_ID", "HADM_ID", "CHARTDATE", length(t) AS text_len, md5(t) AS text_md5,
                    {MONTH_LABEL} AS readmitted
             FROM (SELECT *, regexp_replace("TEXT", '\W', ' ', 'g') AS t FROM note_rows)""",
        ("note_rows",),
    ),
    Query(
        "jb6_vote_report",
        "key:s, line:s",
        lambda s, d: jobs.vote_report(scores(s, d)),
        f"""WITH c AS (
                SELECT avg(CASE WHEN prediction = "Label" THEN 1.0 ELSE 0.0 END) AS acc,
                       avg(-CASE WHEN "Label" = 1 THEN ln(greatest(score, 1e-12))
                                 ELSE ln(1 - least(score, 1 - 1e-12)) END) AS loss FROM scores),
            v AS ({TRAPEZOID.format("votes")}),
            r AS (SELECT coalesce(arg_min(tpr, threshold), 0) AS rp80 FROM votes_points
                  WHERE place > 0 AND prec > 0.799999)
            SELECT 'eval_loss' AS key, printf('eval_loss = %.6f', loss) AS line FROM c
            UNION ALL SELECT 'eval_accuracy', printf('eval_accuracy = %.6f', acc) FROM c
            UNION ALL SELECT 'auroc', printf('auroc = %.6f', auroc) FROM v
            UNION ALL SELECT 'auprc', printf('auprc = %.6f', auprc) FROM v
            UNION ALL SELECT 'RP80', printf('RP80 = %.6f', rp80) FROM r""",
        ("scores", "votes_points"),
    ),
    Query(
        "jb7_cohort_profile",
        "section:s, key:s, measure:s, value:d",
        jb7,
        profile_sql(),
        ("cohort", "people"),
    ),
    Query(
        "jb8_embedding_classifier",
        "split:s, auroc:d, auprc:d, rp80:d, accuracy:d, precision:d, recall:d, f1:d",
        jb8,
    ),
]

# the report of stored scores is the report of the scores
JOBS.append(
    next(
        replace(q, name="jb6_vote_report_from_store", frame=jb6_stored)
        for q in JOBS
        if q.name == "jb6_vote_report"
    )
)

QUERIES = EVALUATION + FEATURES + MODELS + JOBS
