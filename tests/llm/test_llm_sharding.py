import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from edge_cases import clashing, documents, rows_of

from wardflow.llm import sharding


def brute_force(rows, shards):
    """Exact cuts of the order by hash and id; equal rows share the place of the first."""
    keyed = sorted(
        (int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16), sharding.LEAST if d is None else d, len((t or "").encode()) + 16)
        for d, t in rows
    )
    total, below, out, first = sum(k[2] for k in keyed), 0, [], {}
    for key in keyed:
        first.setdefault(key[:2], below)
        out.append((key[1], key[2], first[key[:2]] * shards // total))
        below += key[2]
    return Counter(out)


def got(df):
    return Counter((sharding.LEAST if r.doc_id is None else r.doc_id, len((r.text or "").encode()) + 16, r.shard) for r in df.collect())


def gapless(rows):
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_edge_cases(spark, shards):
    docs = clashing(documents(spark))
    placed = sharding.shard(docs, shards, tolerance=0)
    assert got(placed) == brute_force([(r.doc_id, r.text) for r in docs.collect()], shards)
    gapless(placed.collect())
    assert rows_of(placed.select(*[c for c in docs.columns if c not in ("shard", "slot")])) == rows_of(docs.drop("shard", "slot"))


def test_empty_table(spark):
    assert sharding.shard(documents(spark, [])).collect() == []


def test_hot_text_and_wide_ids(spark):
    rng = np.random.default_rng(0)
    ids = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 600)]
    rows = [(d, "hot text" if i % 3 else f"text {i} " * int(rng.integers(1, 40)), "en", "s", 1) for i, d in enumerate(ids)]
    docs = documents(spark, rows)
    placed = sharding.shard(docs, 12, tolerance=0)
    assert got(placed) == brute_force([r[:2] for r in rows], 12)


def test_several_cells_per_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    monkeypatch.setattr(sharding, "FIRST", 16)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sharding.shard(docs, 4, tolerance=0).collect()
    gapless(rows)
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    hashes = [int(hashlib.md5(r.text.encode()).hexdigest()[:15], 16) for r in order]
    assert hashes == sorted(hashes)  # the shards, one after the other, are the sorted table


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard_digests(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    sizes = np.zeros(40)
    for r in rows:
        sizes[r.shard] += r.size
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 16
    largest = max(r.size for r in rows)
    assert len(rows) == len(texts) and sizes.max() - sizes.min() <= 2 * largest
    gapless(rows)


@pytest.mark.parametrize("tolerance", [0, 0.1])
def test_ten_thousand_ranges(spark, tolerance):
    """Ends may fall into any range at once; the expression stays flat."""
    n, parts = 60_000, 10_000
    keys = spark.range(n).selectExpr("cast(xxhash64(id div 3) as long) a", "id b", "1 + id % 5 w")
    cuts, total = sharding.splitters(keys, parts, tolerance)
    rows = sorted(tuple(r) for r in keys.collect())
    below = np.cumsum([0, *[r[2] for r in rows]])
    place = {r[:2]: i for i, r in enumerate(rows)} | {None: n}
    assert total == below[-1]
    for j, cut in enumerate(cuts, 1):
        first = np.searchsorted(below, -(-j * total // parts))  # the first key with so much below it
        off = below[place[cut]] - below[first]
        assert off == 0 if tolerance == 0 else abs(off) * parts <= total + 5 * parts
