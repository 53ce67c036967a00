from pyspark.sql import functions as F

from wardflow.operators.notes import chunk_notes, clean_notes


def test_row_level_operators_run_on_a_stream(spark, tmp_path):
    rows = [(i, "Dr. X saw the patient " * n) for i, n in enumerate([1, 3, 100])]
    spark.createDataFrame(rows, "id int, TEXT string").write.parquet(str(tmp_path / "in"))
    batch = chunk_notes(clean_notes(spark.read.parquet(str(tmp_path / "in"))))
    stream = spark.readStream.schema("id int, TEXT string").parquet(str(tmp_path / "in"))
    query = (
        chunk_notes(clean_notes(stream))
        .writeStream.format("memory")
        .queryName("chunks")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    key = F.concat_ws(":", "id", "chunk_no", "TEXT").alias("k")
    got = sorted(r.k for r in spark.table("chunks").select(key).collect())
    assert got == sorted(r.k for r in batch.select(key).collect()) and got
