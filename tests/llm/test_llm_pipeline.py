import __spark_entry__ as entry_points
import corpus_pipeline
import pytest
from edge_cases import clashing, documents

from wardflow.llm import queries

FOLDER = "/root/testdata/sf0.01"


def test_names():
    names = list(queries.ALL)
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry_points.queries())
    assert set(queries.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_form(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    said = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in said.description]
    expected = sorted(map(tuple, said.fetchall()), key=str)
    got = queries.ALL[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == expected


def test_stages_by_brute_force(spark):
    """Every stage on what the one before kept, held against its operator's rule."""
    from test_llm_lines import brute_force as lines_left
    from test_llm_minhash import brute_force as components

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.materialised(stage(spark, docs, FOLDER))
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append((before.collect(), docs.collect()))
    good = {r.doc_id for r in kept[0][1]}
    assert sum(d in good for d, q in labels.items() if q) / sum(labels.values()) > 0.98
    assert sum(d in good for d, q in labels.items() if not q) / sum(not q for q in labels.values()) < 0.1
    before, after = kept[1]
    expected = [r[:2] for r in lines_left([(r.doc_id, r.text) for r in before])]
    assert sorted(((r.doc_id, r.text) for r in after), key=str) == expected
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = kept[2]
    alive = {r[0] for r in components([(r.doc_id, r.text) for r in before], 5, 80) if r[0] == r[2]}
    assert {r.doc_id for r in after} == alive and len(after) == len(alive)
    before, after = kept[3]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    assert abs(len(after) - len(before)) < 6 * len(before) ** 0.5
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    whole = {}
    for p in pieces:
        whole[p.doc_id] = whole.get(p.doc_id, 0) + p.length
    copies = {}
    for r in after:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert whole == {p.doc_id: p.doc_tokens * copies[p.doc_id] for p in pieces}


def test_packing_tells_copies_apart_and_returns_ids(spark):
    from tokenizers import Tokenizer

    docs = clashing(documents(spark))
    pieces = corpus_pipeline.packed_windows(spark, docs, FOLDER).collect()
    encode = Tokenizer.from_file(queries.tokenizer_path())
    expected = sorted(
        ((r.doc_id, [*encode.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in docs.collect()), key=str
    )
    whole, windows = {}, {}
    for p in sorted(pieces, key=lambda p: p.start):
        assert len(p.ids) == p.length
        whole.setdefault((p.doc_id, p["copy"]), []).extend(p.ids)
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(((d, ids) for (d, _), ids in whole.items()), key=str) == expected
    for parts in windows.values():
        ends = [0, *[at + n for at, n in sorted(parts)]]
        assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024


def test_stages_on_edge_cases(spark):
    from test_llm_lines import brute_force as lines_left

    docs = clashing(documents(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = corpus_pipeline.good_documents(spark, docs, FOLDER)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert {(r.doc_id, r.text) for r in kept.collect()} <= set(rows)
    left = corpus_pipeline.unique_lines(spark, docs, FOLDER)
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str) == [r[:2] for r in lines_left(rows)]
    # 0 and 1 have one text; the two rows of 7 stay together
    distinct = corpus_pipeline.distinct_documents(spark, docs, FOLDER).collect()
    assert sorted((str(r.doc_id) for r in distinct)) == sorted(str(d) for d, _ in rows if d != 1)
    mixed = corpus_pipeline.mixed_sources(spark, docs, FOLDER)
    assert mixed.columns == corpus_pipeline.COLUMNS
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= set(rows)


def test_stages_on_an_empty_table(spark):
    docs = clashing(documents(spark, []))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.columns == corpus_pipeline.COLUMNS or name == "packing"
        assert out.collect() == []
