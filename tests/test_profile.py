import numpy as np
import pandas as pd
import pytest

from wardflow.operators import profile


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(4)
    data = pd.DataFrame({"g": rng.integers(0, 2, 400), "x": rng.integers(-20, 60, 400)})
    data.loc[:2, "x"] = 500
    rows = [(int(g), int(x)) for g, x in data.itertuples(index=False)] + [(0, None)]
    return spark.createDataFrame(rows, "g int, x int").cache(), data


def test_describe(values):
    df, data = values
    got = profile.describe(df, "x").first()
    want = data["x"].describe()
    names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    assert list(got) == pytest.approx([want[n] for n in names])
    empty = profile.describe(df.where("x > 1000"), "x").first()
    assert empty["count"] == 0 and empty["mean"] is None


def test_boxes(values):
    df, data = values
    for r in profile.box_stats(df, "g", "x").collect():
        x = data.loc[data.g == r.g, "x"]
        q1, median, q3 = x.quantile([0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        want = [q1, median, q3, inside.min(), inside.max(), len(x) - len(inside)]
        assert list(r)[1:] == pytest.approx(want)


def test_density(values):
    df, data = values
    rows = profile.kernel_density(df, "g", "x", grid_size=50).toPandas()
    for g, part in rows.groupby("g"):
        x = data.loc[data.g == g, "x"].to_numpy(float)
        h = x.std(ddof=1) * len(x) ** -0.2
        grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 50)
        terms = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2)
        want = terms.sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
        part = part.sort_values("point")
        assert np.allclose(part["x"], grid) and np.allclose(part["density"], want)


def test_null_handling(spark):
    rows = [("A", "B"), ("A", None), (None, "B"), ("A", "B")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert profile.key_counts(df, "b").count() == 2
    assert profile.key_counts(df, "b", drop_null=True).count() == 1
    assert [tuple(r) for r in profile.cross_table(df, "a", "b", ["B", "C"]).collect()] == [("A", 2, 0, 0)]
    unlisted = [tuple(r) for r in profile.cross_table(df, "a", "b", ["C"]).collect()]
    assert unlisted == [("A", 0, 2)]
    shares = {r.b: r.share for r in profile.key_shares(df, "b").collect()}
    assert shares == {"B": 1.0}


def test_deviation_of_large_values(spark):
    df = spark.createDataFrame([(1e9 + i,) for i in range(3)], "x double")
    assert profile.describe(df, "x").first()["std"] == 1.0
    assert profile.describe(df.limit(1), "x").first()["std"] is None


def test_quartiles_by_group(spark, values):
    df, data = values
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    for bound in (before, "-1"):  # broadcast, and the join beyond the bound
        spark.conf.set(limit, bound)
        got = {r.g: (r.q25, r.q50, r.q75) for r in profile.describe(df, "x", ["g"]).collect()}
        for g, part in data.groupby("g"):
            assert got[g] == pytest.approx(tuple(part["x"].quantile([0.25, 0.5, 0.75])))
    spark.conf.set(limit, before)


def test_admissions_without_a_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (2, None)], "SUBJECT_ID int, HADM_ID int")
    assert [tuple(r) for r in profile.notes_per_admission(df).collect()] == [(1, 1, 2)]
    assert profile.multi_note_ratio(df).first().ratio == 0.2


def test_estimated_distinct_counts(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    exact = profile.distinct_counts(df, [], {"n": df["k"]}).first().n
    near = profile.distinct_counts(df, [], {"n": df["k"]}, error=0.02).first().n
    assert exact == 20_000 and abs(near - exact) < 0.1 * exact
