import re
from collections import Counter

import numpy as np
import pytest
from edge_cases import clashing, documents, rows_of

from wardflow.llm import collocations


def brute_force(rows, least=10, percent=50, top=2000):
    f = Counter()
    for text, lang in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            w = re.findall("[^ \t]+", piece)
            f.update((lang or "und", *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {}
    for key, a in f.items():
        lang, *w = key
        if len(w) < 2 or a < least:
            continue
        longer = [x for x, b in f.items() if b >= least and len(x) == len(w) + 2 and x[0] == lang] if len(w) == 2 else []
        if any((tuple(w) in (x[1:3], x[2:4])) and 100 * f[x] >= percent * a for x in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    n = Counter()
    for key, a in f.items():
        n[key[0]] += a if len(key) == 2 else 0
    out = []
    for lang, phrases in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=str)


def corpus(n=400, seed=5):
    """Few words and marks, so that all cuts, covers and ties occur."""
    draw = np.random.default_rng(seed)
    words = ["the", "of", "a", "x", "New", "york", "É", "漢", "b c", "zz", "rare", "q\x01"]
    share = np.array([30, 20, 15, 8, 6, 6, 3, 3, 3, 3, 1, 2]) / 100
    marks = [" ", "  ", "\t", ". ", ", ", "\n", "\r\n", "; "]
    texts = []
    for _ in range(n):
        picked = draw.choice(words, draw.integers(0, 60), p=share)
        texts.append("".join(w + draw.choice(marks, p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.04, 0.03, 0.03]) for w in picked))
    return [(i, t, ["en", "fr", None, "und"][i % 4], "s", 1) for i, t in enumerate(texts)]


def test_edge_cases_against_brute_force(spark):
    docs = clashing(documents(spark))
    expected = brute_force([(r.text, r.lang) for r in docs.collect()])
    got = collocations.collocations(docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(got) == expected and expected


@pytest.mark.parametrize("budget", [collocations.BUDGET, 4000, 60])
def test_any_budget_against_brute_force(spark, budget):
    """With small budgets prefixes of one and two words are extended."""
    rows = corpus()
    docs = documents(spark, rows).repartition(7)
    expected = brute_force([(r[1], r[2]) for r in rows], least=5, top=40)
    assert len(expected) > 60
    assert rows_of(collocations.collocations(docs, least=5, top=40, budget=budget)) == expected


def test_all_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = brute_force([tuple(r) for r in docs.select("text", "lang").collect()])
    assert rows_of(collocations.collocations(docs)) == expected and expected


def test_empty_table(spark):
    assert collocations.collocations(documents(spark, [])).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, None, None, None), (2, " \t", "en", "s", 2)])).collect() == []


def test_shared_hashes_draw_another_seed(spark, monkeypatch):
    from pyspark.sql import functions as F

    drawn = collocations.word_hash

    def poor(seed, lang, word):
        return drawn(seed, lang, word) if seed == 2 else F.length(word).cast("bigint")

    monkeypatch.setattr(collocations, "word_hash", poor)
    rows = corpus(100)
    counted, seed = collocations.count_words(collocations.tokens(documents(spark, rows)))
    assert seed == 2
    assert counted.select("h").distinct().count() == counted.count()


def test_blocks_come_back_and_totals_add_up():
    draw = np.random.default_rng(1)
    for values, high in ((5, 3), (70_000, 70_000), (300, 2**40)):
        h = [draw.integers(-values, values, 5000) for _ in range(3)]
        n = draw.integers(1, high + 1, 5000)
        back = collocations.unpack(collocations.pack(*h, n))
        assert all((x == y).all() for x, y in zip(back, (*h, n)))
        tree = collocations.Subtree(*h, n)
        naive = Counter()
        for a, b, c, m in zip(*h, n):
            naive[a, b, c] += m
        assert {tuple(x[:3]): x[3] for x in zip(*tree.leaves())} == naive
        pairs = Counter()
        for (a, b, _), m in naive.items():
            pairs[a, b] += m
        assert {tuple(x[:2]): x[2] for x in zip(*tree.pairs())} == pairs
