import hashlib

import numpy as np
import pytest
from edge_cases import clashing, documents
from pyspark.sql import functions as F

from wardflow.llm import sharding, simhash


def edited_texts(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        q = len(text) // 4
        yield doc_id, text, text[: len(text) - q] + following[:q], following


def fp_of(spark, texts):
    """Fingerprints by voting bit by bit, with hashes from Spark."""
    terms = {}
    for text in texts:
        w = [x for x in text.lower().replace("\x0b", " ").replace("\x0c", " ").split() if x]
        terms[text] = list(zip(w, w[1:])) if len(w) > 1 else [(x, "") for x in w]
    distinct = sorted({t for ts in terms.values() for t in ts})
    df = spark.createDataFrame(distinct or [("", "")], "w string, v string")
    hashes = {(r.w, r.v): r.h & (2**64 - 1) for r in df.select("w", "v", F.xxhash64("w", "v").alias("h")).collect()}
    return {t: sum(1 << i for i in range(64) if 2 * sum(hashes[x] >> i & 1 for x in ts) > len(ts)) for t, ts in terms.items()}


def check(spark, docs):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in simhash.edited_likeness(docs).collect()}
    expected = list(edited_texts(rows))
    fps = fp_of(spark, {t for _, *texts in expected for t in texts})
    assert len(got) == len({r[0] for r in rows})
    for doc_id, text, edited, following in expected:
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (fps[text], fps[edited])
        assert r.near_edited == 1 - bin(fps[text] ^ fps[edited]).count("1") / 64
        assert r.near_next == 1 - bin(fps[text] ^ fps[following]).count("1") / 64


def test_edge_cases(spark):
    docs = clashing(documents(spark).dropDuplicates(["doc_id"]))
    check(spark, docs)
    assert simhash.edited_likeness(documents(spark, [])).collect() == []
    assert simhash.edited_likeness(documents(spark)).count() == documents(spark).count()  # a repeated row
    one = simhash.edited_likeness(documents(spark, [(4, "all alone here", "en", "s", 1)])).collect()
    assert one[0].near_next == 1.0


def test_many_slices(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE_BYTES", 20_000)
    check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_edited_texts_are_nearer_than_next_ones(spark):
    rows = simhash.edited_likeness(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert np.mean([r.near_edited > r.near_next for r in rows if r.n_chars > 100]) > 0.98
    assert np.mean([r.near_edited for r in rows]) > 0.74 and np.mean([r.near_next for r in rows]) < 0.56


@pytest.mark.parametrize("radius,blocks", [(0, 2), (1, 2), (3, 5), (6, 9)])
def test_block_tables_find_all_pairs(spark, radius, blocks):
    rng = np.random.default_rng(radius)
    fps = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 60)]
    for fp in fps[:40]:
        for flips in range(1, 8):
            mask = sum(1 << int(b) for b in rng.choice(63, flips, replace=False))
            fps.append(fp ^ mask)
    df = spark.createDataFrame([(x,) for x in fps + fps[:5]], "fp long")
    queries = df.where("fp % 3 = 0")
    got = {(r.query_fp, r.fp): r.distance for r in simhash.within_radius(queries, df, radius, blocks).collect()}
    far = {(a, b): bin((a ^ b) & (2**64 - 1)).count("1") for a in {r.fp for r in queries.collect()} for b in set(fps)}
    assert got == {k: d for k, d in far.items() if d <= radius}


def test_slices_use_the_splitters(spark):
    keys = spark.createDataFrame([(i, 0, 1) for i in range(100)], "a long, b long, w long")
    cuts, total = sharding.splitters(keys, 4)
    assert cuts == [(25, 0), (50, 0), (75, 0)] and total == 100


def test_two_thousand_slices(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", F.lit("a few words").alias("text"))
    monkeypatch.setattr(simhash, "SLICE_BYTES", 370)
    ordered, place = simhash._with_next(docs)
    rows = ordered.where("not _ghost").select("doc_id", *place, "_next").collect()
    assert len(rows) == docs.count() and all(r["_next"] is not None for r in rows)
    assert len({r["_slice"] for r in rows}) > 1900
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["_slice"], r["_row"]))]
    assert order == sorted(order)
