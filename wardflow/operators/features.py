"""Term weights, embeddings and labels for the classifiers.

``tfidf_stages`` and ``word2vec_stages`` are the Spark ML form that feeds a classifier.
``term_weights`` gives the same counts and weights as a (document, term) table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
    Word2Vec,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.text import CLINICAL_STOP_WORDS
from wardflow.operators.ordering import running_sums
from wardflow.sources.shared import materialised

LARGE_VOCABULARY = 2**16
SMALL_VOCABULARY = 3000
MIN_DOCUMENTS = 5


def tfidf_stages(
    vocabulary_size: int = LARGE_VOCABULARY, drop_stop_words: bool = True, text: str = "TEXT"
) -> Pipeline:
    """Tokens, optional stop-word removal, counts and inverse document frequency."""
    stages = [Tokenizer(inputCol=text, outputCol="tokens")]
    words = "tokens"
    if drop_stop_words:
        stages.append(StopWordsRemover(inputCol="tokens", outputCol="words"))
        words = "words"
    stages += [
        CountVectorizer(inputCol=words, outputCol="counts", vocabSize=vocabulary_size),
        IDF(inputCol="counts", outputCol="features", minDocFreq=MIN_DOCUMENTS),
    ]
    return Pipeline(stages=stages)


def weighting(vocabulary: Sequence, words: str = "words") -> PipelineModel:
    """The fitted chain words -> counts -> features of (token, idf) rows in order."""
    counts = CountVectorizerModel.from_vocabulary([r["token"] for r in vocabulary], inputCol=words, outputCol="counts")
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in vocabulary]), inputCol="counts", outputCol="features"
    )
    return PipelineModel(stages=[counts, scale])


def word_counts(words: DataFrame, column: str) -> DataFrame:
    """token, ``df`` (rows that have it) and ``freq`` (its occurrences), in one pass."""
    once = F.transform(F.array_distinct(column), lambda t: F.struct(t.alias("token"), F.lit(1).alias("df"), F.lit(0).alias("freq")))
    every = F.transform(column, lambda t: F.struct(t.alias("token"), F.lit(0).alias("df"), F.lit(1).alias("freq")))
    counted = words.select(F.explode(F.concat(once, every)).alias("t"))
    return counted.groupBy("t.token").agg(F.sum("t.df").alias("df"), F.sum("t.freq").alias("freq"))


def fit_tfidf(
    rows: DataFrame,
    vocabulary_size: int = LARGE_VOCABULARY,
    drop_stop_words: bool = True,
    text: str = "TEXT",
    heard: DataFrame | None = None,
) -> PipelineModel:
    """What ``tfidf_stages`` gives when fitted, from one count of the text; ties by token.

    Counts and document frequencies come from one grouping, so the text is cut into tokens
    once. With ``heard`` only terms of these rows get a place, for fits that see no others.
    """
    cutting = [Tokenizer(inputCol=text, outputCol="tokens")]
    if drop_stop_words:
        cutting.append(StopWordsRemover(inputCol="tokens", outputCol="words"))
    last = cutting[-1].getOutputCol()

    def cut(part: DataFrame) -> DataFrame:
        return PipelineModel(stages=cutting).transform(part.select(text)).select(last)

    order = [F.desc("freq"), F.asc("token")]
    # written, since a collected limit would send the first terms of every partition to the driver
    top = materialised(word_counts(cut(rows), last).orderBy(*order).limit(vocabulary_size))
    known = inverse_document_frequency(top, F.lit(rows.count()))
    if heard is not None:
        known = known.join(cut(heard).select(F.explode(last).alias("token")).distinct(), "token", "left_semi")
    return PipelineModel(stages=[*cutting, *weighting(known.orderBy(*order).collect(), last).stages])


def word2vec_stages(
    vector_size: int = 1000,
    min_count: int = 10,
    max_sentence_length: int = 1000,
    partitions: int = 1,
    seed: int = 1,
    text: str = "TEXT",
) -> Pipeline:
    """Regex tokens without clinical stop words; a document is its mean word vector.

    ``partitions`` should follow the input, one per few hundred megabytes of text: each is
    trained by one task. The library gathers the vocabulary on the driver, so ``min_count``
    has to bound it.
    """
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"\W"),
            StopWordsRemover(inputCol="tokens", outputCol="words", stopWords=CLINICAL_STOP_WORDS),
            Word2Vec(
                inputCol="words",
                outputCol="features",
                vectorSize=vector_size,
                minCount=min_count,
                maxSentenceLength=max_sentence_length,
                numPartitions=partitions,
                seed=seed,
            ),
        ]
    )


def inverse_document_frequency(
    document_frequencies: DataFrame, n_documents: Column, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """token, df and idf = ln((m + 1) / (df + 1)), which is 0 for rare terms.

    ``n_documents`` (m) counts all documents, those without terms included.
    """
    idf = F.log((n_documents + 1) / (F.col("df") + 1))
    rare = F.col("df") < min_documents
    return document_frequencies.withColumn("idf", F.when(rare, 0.0).otherwise(idf))


def term_weights(term_counts: DataFrame, idf: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Document, token, tf and tfidf for the tokens of the vocabulary."""
    wanted = idf.join(vocabulary.select("token"), "token", "left_semi").select("token", "idf")
    return term_counts.join(wanted, "token").withColumn("tfidf", F.col("tf") * F.col("idf"))


def label_as_double(df: DataFrame, label: str = "Label") -> DataFrame:
    """Class 1 stays 1.0 whichever class is more frequent."""
    return df.withColumn(label, F.col(label).cast("double"))


def frequency_index(df: DataFrame, label: str = "Label") -> DataFrame:
    """``label_index``: 0.0 for the most frequent value, 1.0 for the next; ties by value.

    Rows without a label stay, with a NULL index.
    """
    values = df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("_value")).agg(F.count("*").alias("_n"))
    order = [F.desc("_n"), F.asc("_value")]
    placed = running_sums(values, order, {"label_index": F.lit(1.0)})
    index = placed.select("_value", (F.col("label_index") - 1).alias("label_index"))
    return df.join(index, F.col(label).cast("string") == F.col("_value"), "left").drop("_value")
