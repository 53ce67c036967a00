import numpy as np
from edge_cases import clashing, documents, rows_of

from wardflow.llm import minhash


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_force(rows, size=3, percent=85):
    sets = [shingles(text, size) for _, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if not a or not b or rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(rows[i][0]), root(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), root(d)) for (d, _), s in zip(rows, sets)), key=str)


def near_copies(n, seed=0):
    """Variants of one text, some linked through others only, among unrelated ones."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.choice(80, rng.integers(0, 7), replace=False):
            words[at] = f"x{rng.integers(40)}"
        rows.append((1000 - i, " ".join(words)))
    return rows + [(2000 + i, " ".join(f"y{rng.integers(500)}" for _ in range(30))) for i in range(50)]


def test_edge_cases(spark):
    docs = clashing(documents(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(minhash.near_duplicates(docs)) == brute_force(rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []


def test_near_copies_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)  # many tiles per bucket
    monkeypatch.setattr(minhash, "COLUMNS", 50)
    rows = near_copies(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(minhash.near_duplicates(docs))
    assert got == brute_force(rows)
    assert len({r[2] for r in got}) > 51  # several components among the variants


def test_other_settings_against_all_pairs(spark):
    rows = near_copies(120, seed=1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(docs, words=5, percent=80)) == brute_force(rows, 5, 80)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    for n, common in ((3, 2), (40, 30), (4000, 3000)):
        errors = []
        for _ in range(60):
            items = rng.integers(0, 2**63, 2 * n - common).astype(np.uint64)
            a, b = minhash.sketch(items[:n], 160), minhash.sketch(items[n - common :], 160)
            assert a.max() < np.iinfo(np.uint64).max  # every coordinate is filled
            errors.append((a == b).mean() - common / (2 * n - common))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 9)], "a long, b long")
    got = dict(rows_of(minhash.components(edges)))
    assert {got[i] for i in range(100, 161)} == {100} and got[7] == got[9] == 7
