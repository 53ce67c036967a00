import numpy as np
import pytest
from edge_cases import clashing, documents, rows_of
from pyspark.sql import functions as F

from wardflow.llm import lines


def brute_force(rows, min_docs=3, min_chars=20):
    holders = {}
    for i, (doc_id, text) in enumerate(rows):
        for key in {lines.line_key(x) for x in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders.setdefault(key, []).append((doc_id is not None, doc_id or 0, i))
    out = []
    for doc_id, text in rows:
        own, stay = (text or "").split("\n"), []
        for line in own:
            held = holders.get(lines.line_key(line), [])
            if len(held) < min_docs or (doc_id is not None, doc_id or 0) == max(h[:2] for h in held):
                stay.append(line)
        out.append((doc_id, "\n".join(stay), len(own), len(own) - len(stay)))
    return sorted(out, key=str)


def test_edge_cases_against_brute_force(spark):
    docs = clashing(documents(spark))
    got = lines.dedup_lines(docs).select("doc_id", F.coalesce("text", F.lit("")), "n_lines", "n_dropped")
    assert rows_of(got) == brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert set(docs.columns) < set(lines.dedup_lines(docs).columns)


def test_empty_table(spark):
    assert lines.dedup_lines(documents(spark, [])).collect() == []


def test_all_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = lines.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_dropped")
    assert rows_of(got) == brute_force(rows)


def test_deleting_undoes_inserting(spark):
    docs = documents(spark, [(i, f"a line that all of them hold\nand number {i} of its own kind", "en", "s", 1) for i in range(6)])
    first, more = docs.where("doc_id < 4"), docs.where("doc_id >= 4")
    index = lines.build(first)
    grown = lines.insert(index, more)
    assert rows_of(grown.refs) == rows_of(lines.build(docs).refs)
    assert rows_of(lines.apply(docs, grown)) == rows_of(lines.dedup_lines(docs))
    back = lines.delete(grown, more.select("doc_id"))
    assert rows_of(back.refs) == rows_of(index.refs) and rows_of(back.holders) == rows_of(index.holders)
    none = lines.delete(back, docs.where("doc_id < 2").select("doc_id"))  # two holders are left
    assert none.refs.where("n_docs >= 3").isEmpty()
    common = lines.CuckooFilter.from_bytes(none.filters.collect()[0]["filter"])
    assert not common.buckets.any() and not common.stash


@pytest.mark.parametrize("n", [1, 50, 5000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    k1, k2 = rng.integers(-(2**63), 2**63 - 1, (2, n))
    one = lines.CuckooFilter.sized(max(1, n // 2))  # too small: some keys go to the stash
    one.insert(k1, k2)
    assert one.contains(k1, k2).all()
    other = rng.integers(-(2**63), 2**63 - 1, (2, 20_000))
    assert one.contains(*other).mean() < 0.002
    half = n // 2
    one = lines.CuckooFilter.from_bytes(one.to_bytes())
    one.delete(k1[:half], k2[:half])
    assert one.contains(k1[half:], k2[half:]).all()
    one.delete(k1[half:], k2[half:])
    assert not one.buckets.any() and not one.stash
