"""Text, token, array and math functions over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.functions import labels as L
from wardflow.functions import text as T
from wardflow.operators import encode
from wardflow.operators.notes import chunk_notes, clean_notes
from wardflow.registry.query import Query
from wardflow.registry.relational import (
    clean_docs,
    cohort_chunks,
    digest,
    noted_cohort,
    vocabulary,
)
from wardflow.registry.tables import chunk_sql, clean_sql
from wardflow.sources import readers, shared, standin

SEQUENCE_LENGTH = 512
PAIR_LIMIT = SEQUENCE_LENGTH - 3


def documents(spark, d):
    rows = standin.documents(spark, d)
    return rows.select("doc_id", F.col("text").alias("TEXT"))


def stop_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# fixed values: the public English stop-word list of Spark ML, for the SQL side
ENGLISH = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now i'll you'll "
    "he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're "
    "they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't "
    "doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's "
    "how's let's ought that's there's what's when's where's who's why's would"
).split()


def joined(df, tokens):
    """A token array as its size and one string."""
    return df.withColumns({"n": F.size(tokens), "tokens": F.array_join(tokens, "|")})


def tx(tokens):
    """A query frame for a token function over the cleaned documents."""
    return lambda s, d: joined(clean_notes(documents(s, d)), tokens(F.col("TEXT")))


def tx10(spark, d):
    raw = T.rule_tokens(T.shrink_spaces(F.col("TEXT")))
    return joined(documents(spark, d), T.letters_only(raw))


def token_query(name, tokens, sql_list):
    return Query(
        name,
        "doc_id:i, n:i, tokens:s",
        tokens,
        f"""SELECT doc_id, len(toks) AS n, array_to_string(toks, '|') AS tokens
            FROM (SELECT doc_id, {sql_list} AS toks FROM (
                SELECT doc_id, text AS raw, {clean_sql("text")} AS clean FROM documents))""",
    )


RULE = r"regexp_extract_all({}, '(\w+|[^\w\s])')"
SHRUNK = r"trim(regexp_replace(raw, '\s+', ' ', 'g'))"
SPACE = r"regexp_split_to_array(lower(clean), '\s')"
WORD = r"list_filter(regexp_split_to_array(lower(clean), '\W'), lambda t: t <> '')"

TEXTS = [
    Query(
        "tx1_clean_notes",
        "doc_id:i, TEXT:s",
        lambda s, d: clean_notes(documents(s, d)),
        f'SELECT doc_id, {clean_sql("text")} AS "TEXT" FROM documents',
    ),
    Query(
        "tx2_blank_non_words",
        "doc_id:i, text_len:i, text_md5:s",
        lambda s, d: digest(documents(s, d).withColumn("TEXT", T.blank_non_words(F.col("TEXT")))),
        r"""SELECT doc_id, length(t) AS text_len, md5(t) AS text_md5
            FROM (SELECT doc_id, regexp_replace(text, '\W', ' ', 'g') AS t FROM documents)""",
    ),
    Query(
        "tx3_text_length",
        "HADM_ID:i, note_len:i",
        noted_cohort,
        "SELECT * FROM cohort",
        ("cohort",),
    ),
    Query(
        "tx4_word_chunks",
        "doc_id:i, chunk_no:i, text_len:i, text_md5:s",
        lambda s, d: digest(chunk_notes(clean_notes(documents(s, d)))),
        f"""WITH rows AS (SELECT doc_id, {clean_sql("text")} AS "TEXT" FROM documents)
            SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5
            FROM ({chunk_sql("rows", "doc_id")})""",
    ),
    Query(
        "tx5_segmented_notes",
        "SUBJECT_ID:i, ID:i, Label:i, chunk_no:i, text_len:i, text_md5:s",
        lambda s, d: digest(cohort_chunks(s, d)),
        'SELECT *, length("TEXT") AS text_len, md5("TEXT") AS text_md5 FROM cohort_chunks',
        ("cohort_chunks",),
    ),
    Query(
        "tx6_shrink_spaces",
        "doc_id:i, text_len:i, text_md5:s",
        lambda s, d: digest(documents(s, d).withColumn("TEXT", T.shrink_spaces(F.col("TEXT")))),
        r"""SELECT doc_id, length(t) AS text_len, md5(t) AS text_md5 FROM (
                SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)""",
    ),
    token_query("tx7_space_tokens", tx(T.space_tokens), SPACE),
    token_query("tx8_word_tokens", tx(T.word_tokens), WORD),
    token_query("tx9_rule_tokens", tx(T.rule_tokens), RULE.format("clean")),
    token_query(
        "tx10_letters_only",
        tx10,
        f"""list_filter(list_transform({RULE.format(SHRUNK)},
                        lambda t: regexp_replace(t, '[^A-Za-z]', '', 'g')), lambda t: t <> '')""",
    ),
    token_query(
        "tx11_default_stop_words",
        tx(lambda c: T.without_stop_words(T.space_tokens(c), T.default_stop_words())),
        f"list_filter({SPACE}, lambda t: t NOT IN ({stop_list(ENGLISH)}))",
    ),
    token_query(
        "tx12_clinical_stop_words",
        tx(lambda c: T.without_stop_words(T.word_tokens(c), T.CLINICAL_STOP_WORDS)),
        f"list_filter({WORD}, lambda t: t NOT IN ({stop_list(T.CLINICAL_STOP_WORDS)}))",
    ),
]

# math and arrays ---------------------------------------------------------------------


def ma1(spark, d):
    rows = standin.scores(spark, d).withColumn("logit", F.col("score") * 8 - 4)
    probability = L.sigmoid(F.col("logit"))
    return rows.withColumns(
        {"probability": probability, "pred_label": L.at_threshold(probability)}
    )


def ma2(spark, d):
    best = L.argmax(F.col("embedding"))
    rows = standin.table(spark, d, "embeddings").withColumn("best", best)
    return rows.withColumn("right", (F.col("best") == F.col("label")).cast("int"))


def ar1(spark, d):
    chunks = standin.labelled_chunks(spark, d)
    keys = ["doc_id", "chunk_no"]
    rows = encode.encode_sequences(
        chunks, keys, T.space_tokens(F.col("TEXT")), vocabulary(spark, d), SEQUENCE_LENGTH
    )
    return rows.select(*keys, *[F.array_join(c, " ").alias(c) for c in SEQUENCE_COLUMNS])


SEQUENCE_COLUMNS = ["input_ids", "input_mask", "segment_ids"]


def ar2(spark, d):
    """Pieces: the top vocabulary, and every character of the tokens as a continuation."""
    tokens = T.space_tokens(F.col("TEXT"))
    terms = shared.materialised(encode.token_frequencies(clean_docs(spark, d), tokens))
    words = vocabulary(spark, d, terms).select(F.col("token").alias("piece"))
    characters = terms.select(F.explode(F.split("token", "")).alias("c")).distinct()
    starts = characters.select(F.col("c").alias("piece"))
    continued = characters.select(F.concat(F.lit("##"), "c").alias("piece"))
    pieces = readers.union_all([words, starts, continued]).distinct()
    return joined(encode.sub_words(terms, shared.materialised(pieces)), F.col("pieces"))


def _pairs(spark, d):
    tokens = clean_notes(documents(spark, d)).select(
        F.expr("doc_id div 2").alias("pair"),
        (F.col("doc_id") % 2).alias("side"),
        T.space_tokens(F.col("TEXT")).alias("tokens"),
    )
    first = tokens.where(F.col("side") == 0).select("pair", F.col("tokens").alias("a"))
    second = tokens.where(F.col("side") == 1).select("pair", F.col("tokens").alias("b"))
    return first.join(second, "pair")


def ar3(spark, d):
    a, b = encode.cut_pair(F.col("a"), F.col("b"), PAIR_LIMIT)
    cut = _pairs(spark, d).select("pair", a.alias("a"), b.alias("b"))
    return cut.select(
        "pair",
        F.size("a").alias("len_a"),
        F.size("b").alias("len_b"),
        F.md5(F.array_join("a", " ")).alias("a_md5"),
        F.md5(F.array_join("b", " ")).alias("b_md5"),
    )


def ar4(spark, d):
    keys = standin.labelled_chunks(spark, d).select("doc_id", "chunk_no", "Label")
    indexed = readers.with_index(keys, [F.col("doc_id"), F.col("chunk_no")])
    return encode.example_ids(indexed, "train").withColumn(
        "label_id", encode.label_ids(F.col("Label"))
    )


def ar5(spark, d):
    result = F.array(F.col("prediction").cast("string"))
    return standin.scores(spark, d).withColumn("result", L.first_as_int(result))


ARRAYS = [
    Query(
        "ma1_sigmoid_threshold",
        "doc_id:i, chunk_no:i, probability:d, pred_label:i",
        ma1,
        """SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS pred_label
           FROM (SELECT *, 1 / (1 + exp(-(score * 8 - 4))) AS probability FROM scores)""",
        ("scores",),
    ),
    Query(
        "ma2_argmax_accuracy",
        "vec_id:i, best:i, right:i",
        ma2,
        """SELECT *, CASE WHEN best = label THEN 1 ELSE 0 END AS right
           FROM (SELECT *, list_position(embedding, list_max(embedding)) - 1 AS best
                 FROM embeddings)""",
    ),
    Query(
        "ar1_encoded_sequences",
        "doc_id:i, chunk_no:i, input_ids:s, input_mask:s, segment_ids:s",
        ar1,
        f"""
        WITH cut AS (
            SELECT doc_id, chunk_no,
                   regexp_split_to_array(lower("TEXT"), '\\s')[1:{SEQUENCE_LENGTH - 2}] AS toks
            FROM doc_chunks),
        placed AS (
            SELECT doc_id, chunk_no, generate_subscripts(toks, 1) AS pos, unnest(toks) AS token
            FROM cut),
        seqs AS (
            SELECT doc_id, chunk_no,
                   list_concat([2], list(coalesce(token_id, 1) ORDER BY pos), [3]) AS ids
            FROM placed LEFT JOIN vocabulary USING (token) GROUP BY doc_id, chunk_no)
        SELECT doc_id, chunk_no,
               array_to_string(list_resize(ids, {SEQUENCE_LENGTH}, 0), ' ') AS input_ids,
               array_to_string(list_transform(range({SEQUENCE_LENGTH}),
                   lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ' ') AS input_mask,
               array_to_string(list_transform(range({SEQUENCE_LENGTH}), lambda i: 0), ' ')
                   AS segment_ids
        FROM seqs""",
        ("doc_chunks", "vocabulary"),
    ),
    Query(
        "ar2_sub_words",
        "token:s, n:i, tokens:s",
        ar2,
        """
        WITH RECURSIVE words AS (
            SELECT DISTINCT token FROM doc_terms),
        chars AS (
            SELECT DISTINCT c FROM (SELECT unnest(string_split(token, '')) AS c FROM words)
            WHERE c <> ''),
        pieces AS (
            SELECT token AS piece FROM vocabulary
            UNION SELECT c FROM chars UNION SELECT '##' || c FROM chars),
        best AS (
            SELECT token, i, max(j) AS j
            FROM (SELECT token, i, unnest(range(i, length(token) + 1)) AS j
                  FROM (SELECT token, unnest(range(1, length(token) + 1)) AS i FROM words))
            JOIN pieces
              ON piece = CASE WHEN i > 1 THEN '##' ELSE '' END || substr(token, i, j - i + 1)
            GROUP BY token, i),
        walk(token, place, found) AS (
            SELECT token, 1::BIGINT, []::VARCHAR[] FROM words
            UNION ALL
            SELECT walk.token, j + 1, list_append(found,
                CASE WHEN i > 1 THEN '##' ELSE '' END || substr(walk.token, i, j - i + 1))
            FROM walk JOIN best ON walk.token = best.token AND place = i)
        SELECT token, len(found) AS n, array_to_string(found, '|') AS tokens
        FROM walk WHERE place = length(token) + 1""",
        ("doc_terms", "vocabulary"),
    ),
    Query(
        "ar3_pair_truncation",
        "pair:i, len_a:i, len_b:i, a_md5:s, b_md5:s",
        ar3,
        rf"""
        WITH toks AS (
            SELECT doc_id // 2 AS pair, doc_id % 2 AS side,
                   regexp_split_to_array(lower({clean_sql("text")}), '\s') AS t
            FROM documents),
        both_sides AS (
            SELECT a.pair, a.t AS a, b.t AS b, len(a.t) AS la, len(b.t) AS lb
            FROM toks a JOIN toks b ON a.pair = b.pair AND a.side = 0 AND b.side = 1),
        cut AS (
            -- the longer one gives first; when both exceed half, a keeps the odd token
            SELECT *, CASE WHEN la + lb <= {PAIR_LIMIT} THEN la
                           WHEN lb <= {PAIR_LIMIT // 2} THEN {PAIR_LIMIT} - lb
                           WHEN la <= {PAIR_LIMIT - PAIR_LIMIT // 2} THEN la
                           ELSE {PAIR_LIMIT - PAIR_LIMIT // 2} END AS ka
            FROM both_sides),
        kept AS (
            SELECT *, least(lb, {PAIR_LIMIT} - ka) AS kb FROM cut)
        SELECT pair, ka AS len_a, kb AS len_b, md5(array_to_string(a[1:ka], ' ')) AS a_md5,
               md5(array_to_string(b[1:kb], ' ')) AS b_md5
        FROM kept""",
    ),
    Query(
        "ar4_example_ids",
        "doc_id:i, chunk_no:i, guid:s, label_id:i",
        ar4,
        """SELECT doc_id, chunk_no, "Label" AS label_id,
                  'train-' || (row_number() OVER (ORDER BY doc_id, chunk_no) - 1) AS guid
           FROM doc_chunks""",
        ("doc_chunks",),
    ),
    Query(
        "ar5_first_element",
        "doc_id:i, chunk_no:i, result:i",
        ar5,
        "SELECT *, list_extract([prediction::VARCHAR], 1)::INTEGER AS result FROM scores",
        ("scores",),
    ),
]

QUERIES = TEXTS + ARRAYS
