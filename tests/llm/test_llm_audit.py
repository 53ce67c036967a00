from itertools import permutations

import pytest
from edge_cases import LONG, clashing, documents, rows_of

from wardflow.llm import audit

LABELS = [(0, 1, 0), (1, 0, 1), (1, 1, 0), (5, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def mask_of(doc_id, text, firsts):
    blanks = " \t\n\x0b\x0c\r"
    words = [w for w in "".join(" " if c in blanks else c for c in text).split(" ") if w]
    fails = [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        any(c in "#$%&*|" for c in text),
        doc_id is not None and doc_id > firsts[text],
    ]
    return {f for f, failed in zip("ABCDE", fails) if failed}


def brute_force(rows, label_rows):
    """Every order replayed over every document."""
    firsts = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            firsts[text or ""] = min(doc_id, firsts.get(text or "", doc_id))
    good = {d for d, q, _ in label_rows if q == 1 and d is not None}
    toxic = {d for d, _, t in label_rows if t == 1 and d is not None}
    parts = {}
    for doc_id, text, lang in rows:
        parts.setdefault(lang or "", []).append((doc_id, mask_of(doc_id, text or "", firsts)))
    out = []
    for part, docs in parts.items():
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [(d, m) for d, m in left if f in m]
                left = [(d, m) for d, m in left if f not in m]
                fails = sum(f in m for _, m in docs)
                shapley[f] += len(gone)
                found.append(
                    ["".join(order), step, len(left), len(gone), fails - len(gone), sum(m == {f} for _, m in docs)]
                    + [sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), f]
                )
        out += [(part, *row[:-1], shapley[row[-1]]) for row in found]
    return sorted(out, key=str)


def test_edge_cases_against_brute_force(spark):
    docs = clashing(documents(spark))
    expected = brute_force([(r.doc_id, r.text, r.lang) for r in docs.collect()], LABELS)
    got = audit.audit(docs, labels(spark).selectExpr("*", "1 as n", "2 as mask", "3 as part"))
    assert got.columns == ["part", "filter_order", "step", *audit.MEASURES]
    assert rows_of(got) == expected


def test_all_documents_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    assert rows_of(audit.audit(docs, known)) == brute_force(rows, [tuple(r) for r in known.collect()])


def test_every_filter_fails_alone(spark):
    plain = " ".join(f"word{i}" for i in range(250))
    rows = [
        (1, plain, "en", "s", 1),
        (2, "too short", "en", "s", 1),
        (3, LONG, "en", "s", 1),
        (4, plain.replace("word", "WORD"), "en", "s", 1),
        (5, plain + " 50%", "en", "s", 1),
        (6, plain, None, "s", 1),
    ]
    got = audit.audit(documents(spark, rows), labels(spark)).where("filter_order = 'ABCDE'").orderBy("part", "step").collect()
    assert [(r.part, r.removed, r.unique_fails, r.shapley) for r in got] == (
        [("", 0, 0, 0)] * 4 + [("", 1, 1, 120)] + [("en", 1, 1, 120)] * 4 + [("en", 0, 0, 0)]
    )


def test_empty_tables(spark):
    assert audit.audit(documents(spark, []), labels(spark)).collect() == []
    assert audit.audit(documents(spark), labels(spark, [])).where("good_lost + toxic_lost > 0").count() == 0


@pytest.mark.parametrize("n", range(7))
def test_swaps_lead_through_all_orders(n):
    order = list(range(n))
    seen = {tuple(order)}
    for at in audit.plain_changes(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        seen.add(tuple(order))
    assert seen == set(permutations(range(n)))


def test_a_swap_gives_the_diagram_of_the_new_order():
    weights = {m: (m * 7 % 5 + 1,) for m in range(16) if m % 3}
    diagram = audit.Diagram(dict(weights), 4)
    for at in audit.plain_changes(4):
        diagram.swap(at)
        moved = {sum((m >> f & 1) << i for i, f in enumerate(diagram.order)): w for m, w in weights.items()}
        fresh = audit.Diagram(moved, 4)
        assert [len(x) for x in fresh.levels] == [len(x) for x in diagram.levels]
        assert [x[1:] for x in fresh.all_pass()] == [x[1:] for x in diagram.all_pass()]
        assert sum(n for (n,) in weights.values()) == diagram.totals[0][0][0]
