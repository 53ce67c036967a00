"""Note cleaning, chunking and tokens as columns."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_WORDS = 318
MIN_TAIL_WORDS = 10

# fixed values: the clinical stop-word list
CLINICAL_STOP_WORDS = (
    "the and to of was with a on mg in for tablet no is po patient s he blood at daily sig or "
    "as one she day discharge his left history am her were you right by your not pm be had pt "
    "pain this q from p that an"
).split()


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def clean_note(text: Column) -> Column:
    """The note normalisation chain. No word boundaries: "hydr." turns into "hydoctor"."""
    flat = F.regexp_replace(F.coalesce(text, F.lit(" ")), r"[\n\r/]", " ")
    low = F.lower(F.trim(flat))
    low = F.regexp_replace(low, r"\[(.*?)\]", "")
    low = F.regexp_replace(low, r"[0-9]+\.", "")
    low = F.replace(low, F.lit("dr."), F.lit("doctor"))
    low = F.replace(low, F.lit("m.d."), F.lit("md"))
    low = F.replace(low, F.lit("admission date:"), F.lit(""))
    low = F.replace(low, F.lit("discharge date:"), F.lit(""))
    # fixed value: the double marks
    low = F.regexp_replace(low, r"--|__|==", "")
    return F.regexp_replace(F.trim(low), r"\s+", " ")


def blank_non_words(text: Column) -> Column:
    return F.regexp_replace(text, r"\W", " ")


def shrink_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def words_of(text: Column) -> Column:
    return F.split(text, " ", -1)


def word_chunks(text: Column, size: int = CHUNK_WORDS, min_tail: int = MIN_TAIL_WORDS) -> Column:
    """Full chunks of ``size`` words, and the rest when it has more than ``min_tail``.

    Words lie between single spaces and may be empty. One pass over the text cuts it,
    however long it is.
    """
    cut = rf"(?:\A|(?<= ))((?:[^ ]*+ ){{0,{size - 1}}}+[^ ]*+)(?: |\z)"
    pieces = F.regexp_extract_all(text, F.lit(cut), F.lit(1))

    def long_enough(piece: Column) -> Column:
        n_words = F.size(words_of(piece))
        return (n_words == size) | (n_words > min_tail)

    return F.filter(pieces, long_enough)


def space_tokens(text: Column) -> Column:
    return F.split(F.lower(text), r"\s", -1)


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of word characters."""
    return F.filter(F.split(F.lower(text), r"\W", -1), lambda t: t != "")


def rule_tokens(text: Column) -> Column:
    """Words and single punctuation marks; an approximation of a rule-based tokeniser."""
    return F.regexp_extract_all(text, F.lit(r"(\w+|[^\w\s])"), F.lit(1))


def letters_only(tokens: Column) -> Column:
    stripped = F.transform(tokens, lambda t: F.regexp_replace(t, "[^A-Za-z]", ""))
    return F.filter(stripped, lambda t: t != "")


def without_stop_words(tokens: Column, stop_words: list[str]) -> Column:
    """Drop stop words whatever their case; repeated tokens stay."""
    lowered = [w.lower() for w in stop_words]
    return F.filter(tokens, lambda t: ~F.lower(t).isin(lowered))
