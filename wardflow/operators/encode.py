"""Vocabularies, token ids, fixed-length sequences and pooled token vectors.

Frequencies are counted straight from the token arrays and combined before the shuffle.
Tokens meet their ids and vectors in a join, at any size of the tables. The joins carry no
broadcast hint: adaptive execution broadcasts a table that is small at run time and splits
hot tokens otherwise. Pooling moves a vector once per slice of documents that has its token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.operators.notes import explode_tokens
from wardflow.sources.shared import materialised

# fixed values: ids of the special tokens
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_TOKEN_ID = 4
UNKNOWN = "[UNK]"

#: Counted tokens of a slice where documents are pooled, at least (so that small tables keep
#: all cores busy) and at most, and tasks per slice, so that few get two.
LEAST_ROWS, MOST_ROWS, SLICE_TASKS = 1 << 17, 1 << 21, 16
#: Numbers of the vectors of a slice at most, if it had each token once: 512 MB as floats.
MOST_NUMBERS = 1 << 27


def document_tokens(docs: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """One row per document and distinct token with its count ``tf``."""
    return explode_tokens(docs, keys, tokens).groupBy(*keys, "token").agg(F.count("*").alias("tf"))


def row_tokens(docs: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """keys, ``n_words``, and the distinct ``tokens`` of each row with their numbers ``tfs``.

    Rows are counted where they lie: nothing moves, and a row stays one row. A NULL list has
    no words; a NULL among tokens is a word that is not listed.
    """
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", n_words int, tokens array<string>, tfs array<int>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(keys))
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            coded = lists.flatten().dictionary_encode()
            code, size = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False), max(1, len(coded.dictionary))
            row = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)
            pair, tf = np.unique(row[code >= 0] * size + code[code >= 0], return_counts=True)
            ends = pa.array(np.searchsorted(pair, np.arange(len(lists) + 1) * size), pa.int32())
            counted = [coded.dictionary.take(pa.array(pair % size)), pa.array(tf, pa.int32())]
            made = [pa.array(lengths, pa.int32()), *(pa.ListArray.from_arrays(ends, c) for c in counted)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*keys, "n_words", "tokens", "tfs"])

    return docs.select(*keys, tokens.alias("_tokens")).mapInArrow(count, schema)


def unpacked(rows: pa.Table, keys: list[str]) -> pa.Table:
    """keys, token and tf from rows of ``row_tokens``."""
    lists = rows["tokens"].combine_chunks()
    of = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy(zero_copy_only=False))
    flat = rows.select(keys).take(pa.array(of, pa.int64()))
    return flat.append_column("token", lists.flatten()).append_column("tf", rows["tfs"].combine_chunks().flatten())


def token_frequencies(docs: DataFrame, tokens: Column) -> DataFrame:
    """token and ``freq``, its number of occurrences."""
    rows = explode_tokens(docs, [], tokens)
    return rows.groupBy("token").agg(F.count("*").alias("freq"))


def document_frequencies(docs: DataFrame, tokens: Column) -> DataFrame:
    """token and ``df``, the number of rows of ``docs`` that have it."""
    rows = explode_tokens(docs, [], F.array_distinct(tokens))
    return rows.groupBy("token").agg(F.count("*").alias("df"))


def top_vocabulary(frequencies: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent tokens with ``freq``, ties by token, and a token_id.

    The window numbers at most ``size`` rows.
    """
    order = [F.desc("freq"), F.asc("token")]
    top = frequencies.orderBy(*order).limit(size)
    place = F.row_number().over(W.partitionBy().orderBy(*order))
    return top.withColumn("token_id", (place + FIRST_TOKEN_ID - 1).cast("int"))


def token_ids(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    ids = vocabulary.select("token", "token_id")
    return tokens.join(ids, "token", "left").fillna(UNK_ID, subset=["token_id"])


def token_vectors(tokens: DataFrame, vectors: DataFrame) -> DataFrame:
    """Left look-up join; tokens without a vector keep NULL."""
    return tokens.join(vectors, "token", "left")


def mean_pool(docs: DataFrame, keys: list[str], tokens: Column, vectors: DataFrame) -> DataFrame:
    """keys and ``pooled``, the mean vector of the known tokens of each row.

    ``keys`` identify a row. Tokens with a NULL vector count as unknown; a token on several
    rows of ``vectors`` counts with each of them. Rows without a known token are dropped.
    """
    return pool_counts(materialised(row_tokens(docs, keys, tokens)), vectors, keys)


def pool_counts(tokens: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """The same from (document, token, tf) rows or those of ``row_tokens``, which are read three times.

    Documents are dealt to slices by a hash of their keys. A slice gets the vector of each
    token that it has once and pools its documents whole, so what moves follows the tokens
    and not the documents times the tasks of a join.
    """
    packed = "tfs" in tokens.columns
    counted = tokens.select(*keys, *(["tokens", "tfs"] if packed else ["token", "tf"]))
    known = vectors.where(F.col("vector").isNotNull()).select("token", "vector")
    if dict(vectors.dtypes)["vector"] != "array<float>":
        known = known.withColumn("vector", F.col("vector").cast("array<double>"))
    n = counted.agg(F.sum(F.size("tokens"))).first()[0] or 0 if packed else counted.count()
    width = known.select(F.size("vector")).first()
    most = min(MOST_ROWS, max(1, MOST_NUMBERS // max(1, width[0] if width else 1)))
    rows = min(max(-(-n // tokens.sparkSession.sparkContext.defaultParallelism), LEAST_ROWS), most)
    slices = max(1, -(-n // rows))
    asked = counted.withColumn("_slice", F.pmod(F.xxhash64(*keys, F.lit("slice")), F.lit(slices)).cast("int"))
    each = F.explode("tokens") if packed else F.col("token")
    wanted = asked.select(F.col("_slice").alias("_of"), each.alias("_token")).distinct()
    given = wanted.join(known, F.col("_token") == F.col("token")).select("_of", "_token", "vector")
    types = dict(tokens.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", pooled array<double>"

    def pool(left: pa.Table, right: pa.Table) -> pa.Table:
        if packed:
            left = unpacked(left, keys)
        names = pc.unique(right["_token"])
        place = pc.index_in(left["token"], names)
        met = left.filter(pc.is_valid(place))
        place = place.drop_null().to_numpy()
        flat = right["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        table, times = flat.reshape(len(right), len(flat) // max(1, len(right))), np.ones(len(names))
        if len(names) < len(right):
            # a token on several rows counts as the sum of their vectors
            own = pc.index_in(right["_token"], names).to_numpy()
            starts = np.searchsorted(np.sort(own), np.arange(len(names)))
            table = np.add.reduceat(table[np.argsort(own, kind="stable")], starts, axis=0, dtype=np.float64)
            times = np.bincount(own).astype(np.float64)
        owner, firsts = row_numbers(met, keys)
        order = np.argsort(owner, kind="stable")
        place, tf = place[order], met["tf"].to_numpy()[order].astype(np.float64)
        bounds = np.searchsorted(owner[order], np.arange(len(firsts) + 1))
        out = np.zeros((len(firsts), table.shape[1]))
        for row, (start, end) in enumerate(zip(bounds[:-1], bounds[1:])):
            weighted = tf[start:end]
            np.dot(weighted, table[place[start:end]].astype(np.float64), out=out[row])
            out[row] /= weighted @ times[place[start:end]]
        ends = pa.array(np.arange(len(firsts) + 1) * out.shape[1], pa.int32())
        means = pa.ListArray.from_arrays(ends, pa.array(out.ravel()))
        return met.select(keys).take(pa.array(firsts, pa.int64())).append_column("pooled", means)

    dealt = asked.repartition(SLICE_TASKS * slices, "_slice").groupBy("_slice")
    met = given.repartition(SLICE_TASKS * slices, "_of").groupBy("_of")
    return dealt.cogroup(met).applyInArrow(pool, schema).withColumn("pooled", array_to_vector("pooled"))


def row_numbers(rows: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of the row that each line belongs to, and the first line of each."""
    codes = np.zeros(len(rows), np.int64)
    for k in keys:
        code = rows[k].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) + 1
        _, codes = np.unique(codes * (int(code.max(initial=0)) + 1) + code, return_inverse=True)
    _, firsts, owner = np.unique(codes, return_index=True, return_inverse=True)
    return owner, firsts


def pooled_values(pooled: DataFrame, keys: list[str]) -> DataFrame:
    """The pooled vectors as one row per dimension."""
    values = vector_to_array("pooled")
    return pooled.select(*keys, F.posexplode(values).alias("dim", "value"))


def pair_lengths(len_a: Column, len_b: Column, limit: Column | int) -> tuple[Column, Column]:
    """Lengths after cutting the longer one, ties from the second, until both fit."""
    m = limit if isinstance(limit, Column) else F.lit(limit)
    half = F.floor(m / 2)
    kept_a = F.least(len_a, F.greatest(m - len_b, m - half))
    kept_b = F.least(len_b, F.greatest(m - len_a, half))
    return kept_a.cast("int"), kept_b.cast("int")


def cut_pair(a: Column, b: Column, limit: int) -> tuple[Column, Column]:
    kept_a, kept_b = pair_lengths(F.size(a), F.size(b), limit)
    return F.slice(a, F.lit(1), kept_a), F.slice(b, F.lit(1), kept_b)


def padded(values: Column, length: int) -> Column:
    missing = F.greatest(F.lit(length) - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(0), missing))


def encode_sequences(
    docs: DataFrame, keys: list[str], tokens: Column, vocabulary: DataFrame, length: int = 512
) -> DataFrame:
    """keys, input_ids, input_mask and segment_ids of exactly ``length`` integers.

    The tokens of a row are cut to ``length - 2`` before they are looked up, so what is
    gathered per row is that long at most. Rows without tokens and rows with equal keys
    stay. A token on several rows of ``vocabulary`` has the smallest of its ids.
    """
    cut = docs.select(*keys, F.slice(tokens, 1, length - 2).alias("_tokens"))
    placed = cut.withColumn("_row", F.monotonically_increasing_id()).select(
        *keys, "_row", F.posexplode_outer("_tokens").alias("_pos", "token")
    )
    known = vocabulary.groupBy("token").agg(F.min("token_id").alias("token_id"))
    entry = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "token_id"))
    body = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["token_id"])
    gathered = token_ids(placed, known).groupBy(*keys, "_row").agg(body.alias("_ids"))
    framed = gathered.select(
        *keys, F.concat(F.array(F.lit(CLS_ID)), "_ids", F.array(F.lit(SEP_ID))).alias("_seq")
    )
    used = F.size("_seq")
    return framed.select(
        *keys,
        padded(F.col("_seq"), length).alias("input_ids"),
        padded(F.array_repeat(F.lit(1), used), length).alias("input_mask"),
        F.array_repeat(F.lit(0), length).alias("segment_ids"),
    )


def example_ids(rows: DataFrame, set_name: str) -> DataFrame:
    """``guid`` = "{set}-{index}" from an ``index`` column."""
    return rows.withColumn("guid", F.concat_ws("-", F.lit(set_name), F.col("index").cast("string")))


def label_ids(label: Column, names: tuple[str, ...] = ("0", "1")) -> Column:
    """Position of the label's text form in the list of label names."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), label.cast("int").cast("string"))
    return (F.nullif(place, F.lit(0)) - 1).cast("int")


def longest_match(word: str, pieces: set[str]) -> list[str]:
    """Greedy sub-words of one word; continuations start with "##"."""
    longest = max(map(len, pieces), default=0)
    found, start = [], 0
    while start < len(word):
        prefix = "##" if start else ""
        ends = range(min(len(word), start + longest), start, -1)
        end = next((e for e in ends if prefix + word[start:e] in pieces), None)
        if end is None:
            return [UNKNOWN]
        found.append(prefix + word[start:end])
        start = end
    return found


def sub_words(
    tokens: DataFrame, pieces: DataFrame, max_word_chars: int | None = None
) -> DataFrame:
    """``pieces`` (array) per distinct token of ``tokens``; each is cut once.

    Every span of a token that is no longer than the longest piece looks itself up by a
    join. With ``max_word_chars`` longer tokens become one unknown piece; by default all
    are cut.
    """
    words = tokens.select("token").distinct()
    known = pieces.select("piece").where(F.length("piece") > 0).distinct()
    longest = known.agg(F.coalesce(F.max(F.length("piece")), F.lit(0))).scalar()
    size = F.length("token")
    wanted = words.where(size <= max_word_chars) if max_word_chars else words
    last = F.least(size, F.col("_from") + longest - 1)
    spans = (
        wanted.where(size >= 1)
        .select("token", F.explode(F.sequence(F.lit(1), size)).alias("_from"))
        .where(last >= F.col("_from"))
        .select("*", F.explode(F.sequence(F.col("_from"), last)).alias("_to"))
    )
    span = F.substring("token", F.col("_from"), F.col("_to") - F.col("_from") + 1)
    prefix = F.when(F.col("_from") > 1, "##").otherwise("")
    found = (
        spans.select("token", F.concat(prefix, span).alias("piece"))
        .join(known, "piece", "left_semi")
        .groupBy("token")
        .agg(F.collect_set("piece").alias("_known"))
    )

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch, known in batches:
            yield pd.Series(
                [longest_match(w, set() if k is None else set(k)) for w, k in zip(batch, known)]
            )

    return words.join(found, "token", "left").select(
        "token", cut("token", "_known").alias("pieces")
    )
