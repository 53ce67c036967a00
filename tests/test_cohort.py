"""Cohort operators on small frames, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardflow.functions import labels as L
from wardflow.operators import cohort
from wardflow.operators.ordering import SLICE, lead_within, running_sums, slice_in_order

SCHEMA = (
    "SUBJECT_ID bigint, HADM_ID bigint, FIRST_ADMITTIME timestamp_ntz, ADMITTIME timestamp_ntz,"
    " DISCHTIME timestamp_ntz, DEATHTIME timestamp_ntz, ADMISSION_TYPE string,"
    " CHARTDATE timestamp_ntz, TEXT string"
)
DAY0 = datetime(2020, 1, 1)


def day(n):
    return DAY0 + timedelta(days=n)


def admission(subject, hadm, start, kind="EMERGENCY", stay=1, died=False, chart=None, text=None):
    end = day(start + stay)
    return (subject, hadm, DAY0, day(start), end, end if died else None, kind, chart, text)


@pytest.fixture
def many_slices(spark):
    """Keep small ranges apart, so that neighbours lie in different slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def expected_gaps(rows):
    """hadm -> (next time, next type) by the rules, one subject after the other."""
    out = {}
    for subject in {r[0] for r in rows}:
        mine = sorted({r[:7] for r in rows if r[0] == subject}, key=lambda r: (r[3], r[1]))
        seen = []
        for i, r in enumerate(mine):
            after = mine[i + 1] if i + 1 < len(mine) else None
            step = (after[3], after[6]) if after else (None, None)
            seen.append((r, (None, None) if step[1] == "ELECTIVE" else step))
        kept = [s for s in seen if s[0][6] not in (None, "NEWBORN") and s[0][5] is None]
        for i, (r, (time, kind)) in enumerate(kept):
            later = kept[i + 1][1] if i + 1 < len(kept) else (None, None)
            out[r[1]] = (time or later[0], kind or later[1])
    return out


def gaps_of(spark, rows):
    found = cohort.admission_gaps(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r.HADM_ID: (r.NEXT_ADMITTIME, r.NEXT_ADMISSION_TYPE) for r in found}


def test_elective_is_skipped_once(spark):
    rows = [
        admission(1, 1, 0),
        admission(1, 2, 10, "ELECTIVE"),
        admission(1, 3, 20),
        admission(2, 4, 0),
        admission(2, 5, 10, "ELECTIVE"),
        admission(2, 6, 20, "ELECTIVE"),
        admission(2, 7, 30),
    ]
    got = gaps_of(spark, rows)
    assert got[1] == (day(20), "EMERGENCY")
    assert got[4] == (None, None)
    assert got[5] == (day(30), "EMERGENCY")
    assert got == expected_gaps(rows)


def test_deaths_newborns_and_unknown_types(spark):
    rows = [
        admission(1, 1, 0, "NEWBORN"),
        admission(1, 2, 10),
        admission(1, 3, 20, died=True),
        admission(1, 4, 30),
        admission(1, 5, 40, None),
    ]
    got = gaps_of(spark, rows)
    assert set(got) == {2, 4}
    # a death is seen by the look-ahead; an unknown type keeps its time
    assert got[2] == (day(20), "EMERGENCY")
    assert got[4] == (day(40), None)


def test_one_subject_with_a_third_of_the_rows(spark, many_slices):
    random.seed(3)
    kinds = ["EMERGENCY", "URGENT", "ELECTIVE", "NEWBORN", None]
    rows = []
    for hadm in range(900):
        subject = 1 if hadm % 3 == 0 else random.randrange(2, 40)
        start = 5 if subject == 1 and hadm % 2 else random.randrange(400)
        rows.append(
            admission(subject, hadm, start, random.choice(kinds), died=random.random() < 0.1)
        )
    ordered = cohort.in_admission_order(
        cohort.distinct_admissions(spark.createDataFrame(rows, SCHEMA))
    )
    hot = ordered.where("SUBJECT_ID = 1")
    assert hot.select(SLICE).distinct().count() > 1
    assert gaps_of(spark, rows) == expected_gaps(rows)


def test_lead_and_running_sums_over_many_slices(spark, many_slices):
    rows = [(i % 4 if i % 3 else 0, i, float(i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, x double")
    got = lead_within(slice_in_order(df, ["k", "t"]), ["k"], ["t"], {"n": F.col("t")}).collect()
    for k in range(4):
        times = sorted(t for kk, t, _ in rows if kk == k)
        assert {r.t: r.n for r in got if r.k == k} == dict(zip(times, [*times[1:], None]))
    sums = running_sums(df, [F.desc("t")], {"s": F.col("x")}, totals=True).collect()
    total = 0.0
    for r in sorted(sums, key=lambda r: -r.t):
        total += float(r.t % 7)
        assert r.s == total
        assert r.total_s == sum(x for _, _, x in rows)


def test_latest_note(spark):
    rows = [
        admission(1, 1, 0, chart=day(1), text="old"),
        admission(1, 1, 0, chart=day(2), text="b"),
        admission(1, 1, 0, chart=day(2), text="a"),
        admission(1, 1, 0, chart=day(2), text="a"),
        admission(1, 1, 0, chart=None, text="undated"),
        admission(1, 2, 5, chart=day(7), text=None),
        admission(1, 2, 5, chart=day(6), text="hidden by a later empty note"),
        admission(1, 3, 9),
    ]
    source = spark.createDataFrame(rows, SCHEMA)
    notes = {r.HADM_ID: r.TEXT for r in cohort.latest_notes(source).collect()}
    assert notes == {1: "a", 2: None, 3: None}
    with_notes = cohort.cohort_with_notes(
        cohort.admission_gaps(source), cohort.latest_notes(source)
    )
    assert [(r.HADM_ID, r.TEXT) for r in with_notes.collect()] == [(1, "a")]


def test_label_bounds(spark):
    gaps = spark.createDataFrame([(29,), (30,), (31,), (-3,), (None,)], "DAYS_NEXT_ADMIT int")
    strict = [r.OUTPUT_LABEL for r in cohort.with_label(gaps, 30).collect()]
    loose = [r.OUTPUT_LABEL for r in cohort.with_label(gaps, 30, inclusive=True).collect()]
    assert strict == [1, 0, 0, 1, 0]
    assert loose == [1, 1, 0, 1, 0]


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [
        (datetime(2020, 1, 31), datetime(2020, 2, 1), 1),
        (datetime(2020, 2, 1), datetime(2020, 2, 28), 0),
        (datetime(2019, 12, 31), datetime(2020, 1, 1), 1),
        (datetime(2020, 1, 15), datetime(2020, 7, 1), 6),
        (datetime(2020, 1, 15), datetime(2020, 8, 1), 7),
    ],
)
def test_month_gap_and_label(spark, start, end, months):
    row = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz").select(
        L.month_gap(F.col("b"), F.col("a")).alias("gap"),
        L.month_label(F.col("b"), F.col("a")).alias("label"),
    )
    assert tuple(row.first()) == (months, int(0 <= months <= 6))


def test_equal_last_note_rows_get_one_follower(spark, monkeypatch, many_slices):
    monkeypatch.setattr(cohort, "COPY_BLOCK", 4)
    copies = [admission(1, 1, 0, chart=day(1), text="same")] * 11
    rows = [
        *copies,
        admission(1, 1, 0, chart=day(0), text="earlier"),
        admission(1, 2, 40, chart=None, text=None),
        admission(1, 3, 300, chart=day(300), text="x"),
        admission(2, 4, 0, chart=day(3), text="y"),
    ]
    out = cohort.with_next_note_row(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    same = sorted(r.next_admission for r in out if r.TEXT == "same")
    assert same == [day(0)] * 10 + [day(40)]
    others = {r.TEXT: r.next_admission for r in out if r.TEXT != "same"}
    assert others == {"earlier": day(0), None: day(300), "x": None, "y": None}
    labelled = cohort.with_month_label(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.readmitted for r in labelled) == 1
