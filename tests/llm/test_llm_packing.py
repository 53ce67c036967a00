import zlib
from collections import defaultdict

import numpy as np
import pytest
from edge_cases import clashing, documents

from wardflow.llm import packing
from wardflow.llm.queries import tokenizer_path


def whole_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    return [[*model.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def check(docs, pieces, capacity=1024):
    """A round trip: the pieces give back every document's ids, and windows hold them gapless."""
    expected = defaultdict(int)
    for (doc_id, _), ids in zip(docs, whole_ids([t for _, t in docs])):
        expected[doc_id, tuple(ids)] += 1
    found, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == p.length and p.length > 0
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        found[p.doc_id, p.doc_tokens].append(p)
        windows[p.sequence_id].append(p)
    got = defaultdict(int)
    for (doc_id, _), own in found.items():
        by_start = defaultdict(list)
        for p in own:
            by_start[p.start].append(tuple(p.ids))
        for copy in range(len(by_start[0])):
            got[doc_id, tuple(x for start in sorted(by_start) for x in sorted(by_start[start])[copy])] += 1
    assert got == expected
    for own in windows.values():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= capacity
    return len(windows)


def test_edge_cases(spark):
    docs = clashing(documents(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, packing.pack(docs, tokenizer_path()).collect())
    assert packing.pack(documents(spark, []), tokenizer_path()).collect() == []


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    pieces = packing.pack(docs, tokenizer_path()).collect()
    n = check(rows, pieces)
    assert sum(p.length for p in pieces) > 0.985 * 1024 * n


@pytest.mark.parametrize("text", ["a  b", " a", "a \n b", "it's 12 o'clock", "x  y", "a\x1c b", "  z", "<|endoftext|> x"])
def test_cutting_at_blanks_keeps_the_ids(text):
    got = packing.Tokens(tokenizer_path()).of([text, text])
    assert [list(np.frombuffer(x, "<u4")) for x in got] == [ids[:-1] for ids in whole_ids([text, text])]


def test_differencing():
    # the textbook case: 8 7 6 5 4 into two parts differs by 2 after differencing
    sums = np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])
    assert sorted(sums) == [14, 16]
    sizes = np.random.default_rng(0).integers(1, 257, 600)
    window = packing.differencing(sizes, 75)
    sums = np.bincount(window, sizes)
    assert len(sums) == 75 and sums.max() - sums.min() <= 4
    assert packing.differencing(np.array([5]), 3).tolist() == [0]


def test_window_count_rises():
    window = packing.windows_of(np.array([60, 60, 60]), 100)  # two windows could not hold them
    assert sorted(window) == [0, 1, 2]
    assert len(packing.windows_of(np.empty(0, np.int64), 10)) == 0


@pytest.mark.parametrize("text", ["foo <|endoftext|> bar", "foo <|endoftext|>", "a b<|endoftext|>. c", "x <|endoftext|><|endoftext|>"])
def test_added_tokens_keep_the_ids(text):
    got = packing.Tokens(tokenizer_path()).of([text, "foo bar"])
    assert [list(np.frombuffer(x, "<u4")) for x in got] == [ids[:-1] for ids in whole_ids([text, "foo bar"])]
