import json
import os

import pytest
from pyspark.errors import PySparkException

from wardflow.operators import profile
from wardflow.sources import readers, shared, sinks

AWKWARD = [
    (1, 'say "hi", then\nleave', 0),
    (2, "back\\slash", 1),
    (3, "comma, tab\tand / slash", 1),
    (4, '"', 0),
]


def test_csv_and_tsv_round_trip(spark):
    df = spark.createDataFrame(AWKWARD, "ID bigint, TEXT string, Label int")
    for sep in (",", "\t"):
        path = sinks.write_csv(df, shared.shared_path(spark, "awkward"), sep)
        typed = readers.csv_table(spark, path, schema="ID bigint, TEXT string, Label int", sep=sep)
        assert sorted(map(tuple, typed.collect())) == AWKWARD
        inferred = readers.csv_table(spark, path, sep=sep)
        assert dict(inferred.dtypes) == {"ID": "int", "TEXT": "string", "Label": "int"}
    assert sorted(map(tuple, readers.tsv_table(spark, path).collect())) == AWKWARD


def test_splits_are_read_by_column_name(spark):
    rows = [(i, 1, f"note {i}", s) for i, s in enumerate(["train", "val", "test", "train"])]
    df = spark.createDataFrame(rows, "ID bigint, Label int, TEXT string, split string")
    paths = sinks.write_splits(df, shared.shared_path(spark, "splits"))
    train = readers.chunk_csv(spark, paths["train"])
    assert train.columns == ["ID", "TEXT", "Label"]
    assert sorted(map(tuple, train.collect())) == [(0, "note 0", 1), (3, "note 3", 1)]


def test_labelled_sink_refuses_nulls(spark):
    schema = "SUBJECT_ID bigint, HADM_ID bigint, LABEL int, TEXT string"
    folder = shared.shared_path(spark, "labelled")
    good = spark.createDataFrame([(1, 2, 0, "x")], schema)
    path = sinks.write_labelled_notes(good, folder, 30)
    assert os.path.basename(path) == "readmit_30.parquet"
    assert dict(spark.read.parquet(path).dtypes)["SUBJECT_ID"] == "int"
    bad = spark.createDataFrame([(1, 2, None, "x")], schema)
    with pytest.raises(PySparkException):
        sinks.write_labelled_notes(bad, folder, 60)


def test_report_and_history(spark):
    metrics = spark.createDataFrame([(0.5, 2)], "b double, a int")
    path = sinks.write_report(sinks.report_lines(metrics), shared.shared_path(spark, "report"))
    assert [r.value for r in spark.read.text(path).collect()] == ["a = 2.000000", "b = 0.500000"]
    history = spark.createDataFrame([(0, 0.7), (1, 0.6)], "step int, loss double")
    path = sinks.write_json(history, shared.shared_path(spark, "history"))
    assert sorted(json.loads(r.value)["loss"] for r in spark.read.text(path).collect()) == [0.6, 0.7]


def test_frame_helpers(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert readers.upper_case_columns(df).columns == ["K", "V"]
    indexed = readers.with_index(df, [df["k"]])
    assert sorted((r.k, r["index"]) for r in indexed.collect()) == [(1, 0), (2, 1)]
    assert readers.union_all([df, df, df]).count() == 6
    found = readers.sql_over(spark, "SELECT max(k) AS m FROM {t}", t=df).first().m
    assert found == 2
    shape = {r.column: (r.type, r.non_null, r.rows) for r in profile.schema_and_shape(df).collect()}
    assert shape == {"k": ("int", 2, 2), "v": ("string", 2, 2)}
    cut = shared.materialised(df)
    assert cut.count() == 2


def test_written_tables_can_be_dropped(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    table = shared.materialised(df, str(tmp_path))
    assert table.count() == 2 and len(list(tmp_path.iterdir())) == 1
    shared.drop_table(table)
    assert not list(tmp_path.iterdir())
    key = sinks.write_chunk_scores(
        spark.createDataFrame([(7, 0, 0.4, 0, 1)], "ID int, chunk_no int, score double, prediction int, Label int"),
        str(tmp_path / "scores"),
        ["ID", "chunk_no"],
    )
    assert spark.read.parquet(key).columns == ["ID", "chunk_no", "logits", "pred_label", "label"]


def test_tables_on_a_machines_own_disk_are_refused_on_a_cluster(spark):
    class Cluster:
        """The session as if it had a master elsewhere and no shared folder."""

        _jvm, _jsc = spark._jvm, spark._jsc
        sparkContext = type("Context", (), {"master": "spark://elsewhere:7077"})
        settings = {"spark.sql.warehouse.dir": "/tmp/warehouse"}

        class conf:
            @staticmethod
            def get(name, default=None):
                return Cluster.settings.get(name, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Cluster)
    Cluster.sparkContext.master = "local[2]"
    assert shared.shared_folder(Cluster) == "/tmp/warehouse/wardflow-tables"
    Cluster.settings["spark.checkpoint.dir"] = "hdfs:///shared"
    assert shared.shared_folder(Cluster) == "hdfs:///shared"
