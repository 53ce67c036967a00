"""The splittable CSV reader against the reader that takes a whole file in one task."""

import os
import random

import pytest
from pyspark.sql import functions as F

from wardflow.sources import readers, shared, sinks, split_csv

SCHEMA = "ID bigint, TEXT string, Label int"
FIELDS = [
    "plain", "", "a, b", 'say "hi"', '"', '""', "two\nlines", "\n", "\n\n", 'open "\n" close', "back\\slash", "tab\there",
    "É 漢 \U0001f600", " blanks ", "'", "x" * 300, "line\n" * 30, '"quoted"\n' * 20, "",
]


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def write(spark, name, files, end="\n"):
    folder = shared.shared_path(spark, name).removeprefix("file:")
    os.makedirs(folder)
    for i, rows in enumerate(files):
        lines = ["ID,TEXT,Label", *[",".join([str(a), quoted(b), str(c)]) for a, b, c in rows]]
        with open(f"{folder}/f{i}.csv", "w", newline="", encoding="utf-8") as f:
            f.write("".join(x + end for x in lines))
    return folder


@pytest.fixture
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)
        spark.conf.set(names[2], 1)

    yield use
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [7, 64, 1000])
def test_equal_to_whole_files_with_cuts_anywhere(spark, small_ranges, size, end):
    draw = random.Random(size)
    fields = FIELDS if size > 7 else [f for f in FIELDS if len(f) < 30]
    files = [[(i, draw.choice(fields), draw.randrange(2)) for i in range(n)] for n in (25, 1, 0, 9)]
    folder = write(spark, "cuts", files, end)
    whole = rows_of(readers.whole_csv_table(spark, folder, schema=SCHEMA))
    small_ranges(size)
    got = split_csv.split_csv_table(spark, folder, schema=SCHEMA)
    assert rows_of(got) == whole
    assert whole == sorted(((a, b or None, c) for f in files for a, b, c in f), key=str)  # empty is NULL, quoted or not
    named = split_csv.split_csv_table(spark, folder)
    assert dict(named.dtypes) == {"ID": "int", "TEXT": "string", "Label": "int"}
    assert rows_of(named) == whole
    assert split_csv._lines(spark, folder).rdd.getNumPartitions() > 3 or size == 1000


def test_every_byte_of_a_file_may_be_a_cut(spark, small_ranges):
    rows = [(1, 'a""b\n"c"\n', 0), (22, '"\n"', 1), (3, "", 0)]
    folder = write(spark, "bytes", [rows])
    whole = rows_of(readers.whole_csv_table(spark, folder, schema=SCHEMA))
    assert [r[1] for r in whole] == ['a""b\n"c"\n', '"\n"', None]
    for size in range(3, 40, 3):
        small_ranges(size)
        assert rows_of(split_csv.split_csv_table(spark, folder, schema=SCHEMA)) == whole


def test_odd_files(spark):
    folder = shared.shared_path(spark, "odd").removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write('\n\r\n"first\nname",,b,b\n1,2\n\n3,,"x",4,5\n\n"open, and\nnever closed')
    open(f"{folder}/b.csv", "w").close()
    got = split_csv.split_csv_table(spark, folder, infer=False)
    assert got.columns == ["first\nname", "_c1", "b2", "b3"]
    assert rows_of(got)[:2] == [("1", "2", None, None), ("3", None, "x", "4")]
    assert rows_of(got)[2][0].startswith("open, and\nnever closed")
    assert split_csv.split_csv_table(spark, f"{folder}/b.csv").columns == []
    assert split_csv.split_csv_table(spark, f"{folder}/b.csv", schema=SCHEMA).collect() == []


def test_types(spark):
    folder = shared.shared_path(spark, "types").removeprefix("file:")
    os.makedirs(folder)
    lines = ["i,l,d,day,time,flag,text,none", "1,5000000000,1.5,2020-01-02,2020-01-02 03:04:05,TRUE,1,", "-2,1,1e3,2021-01-01,2020-01-02T03:04:05,false,x,"]
    with open(f"{folder}/a.csv", "w") as f:
        f.write("\n".join(lines))
    kinds = ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string"]
    assert [k for _, k in split_csv.split_csv_table(spark, folder).dtypes] == kinds


def test_one_file_of_documents_is_read_by_many_tasks(spark, small_ranges):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        F.col("doc_id").alias("ID"), F.concat(F.lit('He said "so"\n'), "text").alias("TEXT"), F.lit(1).alias("Label")
    )
    path = sinks.write_csv(docs.coalesce(1), shared.shared_path(spark, "one"))
    small_ranges(64_000)
    got = split_csv.split_csv_table(spark, path, schema=SCHEMA)
    assert split_csv._lines(spark, path).rdd.getNumPartitions() > 30
    assert rows_of(got) == rows_of(docs)
