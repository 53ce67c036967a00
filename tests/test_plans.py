"""What the plans must and must not contain."""

import pytest

from wardflow import registry
from wardflow.operators import cohort
from wardflow.sources import standin

FOLDER = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "rows")
    standin.admission_notes(spark, FOLDER).write.parquet(path)
    return spark.read.parquet(path)


def test_gaps_do_not_read_the_text(stored):
    plan = physical(cohort.admission_gaps(stored))
    assert "TEXT" not in plan
    # one subject's rows never meet in one window partition
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_slice" in line for line in windows)


def test_latest_note_is_ranked_before_the_shuffle(stored):
    plan = physical(cohort.latest_notes(stored))
    partial, final = plan.index("row_number(), 1, Partial"), plan.index("row_number(), 1, Final")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_joined_text_is_shuffled_once(spark, stored):
    joined = cohort.cohort_with_notes(cohort.admission_gaps(stored), cohort.latest_notes(stored))
    plan = physical(joined)
    assert "Join Inner" in joined._jdf.queryExecution().optimizedPlan().toString()
    text_side = plan[plan.index("WindowGroupLimit") :]
    assert text_side.count("Exchange") == 1


TRAINING = (
    "snk src2 src3 src5 ml4 ml5 ml6 ml7 ml8_naive ml9 ml10 ml11 ml12 ml13 ml14 ml15 ml16 so4 jb3 jb4 ar2"
)
TRAINING = tuple(TRAINING.split())


@pytest.mark.parametrize("name", [n for n in sorted(registry.ALL) if not n.startswith(TRAINING)])
def test_no_query_joins_all_pairs(spark, name):
    plan = physical(registry.ALL[name].run(spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_sub_words_clean_the_text_once(spark):
    """Vocabulary, characters and words come from one written count of the tokens."""
    assert "documents.parquet" not in physical(registry.ALL["ar2_sub_words"].frame(spark, FOLDER))
