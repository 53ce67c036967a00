"""CSV with line breaks inside fields, read by many tasks a file.

A line break ends a record if the number of quotes before it in the file is even. Files are
read as lines by byte range, in two passes. The first counts quotes per range: summed over
the ranges before, they tell whether a range starts inside quotes. In the second each range
then knows its records alone and puts them together in the order it reads them; nothing is
shuffled but the ends of ranges. A record that reaches over one or more ends is joined from
its pieces. Records are parsed by ``from_csv``, with the rules of the CSV reader.

Doubled quotes count twice, so they change nothing. As in RFC 4180 a field that holds a
quote, a separator or a line break is quoted as a whole: a single quote inside an unquoted
field is not told from an opening one.

Defined cases: lines end in LF or CRLF; inside a quoted field both stay as they are. Empty
lines between records are no rows. The first record of each file is its header. Files
without any record give no rows. Short records have NULL in the fields that they lack, and
an empty field is NULL, quoted or not. A quote that is never closed makes the rest of its
file one record. Compressed files are one range each. What the driver holds is one short
row per range (``spark.sql.files.maxPartitionBytes``).
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PIECES = "path string, start long, part long, is_first boolean, whole boolean, record string"
#: Types that a column of text may have, the narrowest first, with the form of their values.
FORMS = [
    ("int", r"[+-]?\d{1,10}"),
    ("bigint", r"[+-]?\d{1,19}"),
    ("double", r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"),
    ("date", r"\d{4}-\d{2}-\d{2}"),
    ("timestamp", r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}.*"),
    ("boolean", r"(?i)true|false"),
]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.option("lineSep", "\n").text(path)
    return found.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _ranges(lines: DataFrame, quote: str) -> DataFrame:
    """Per range whether it starts inside quotes, and the start of the range in which the record
    began that is open there."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    counted = lines.select("path", "start", quotes.cast("bigint").alias("q")).groupBy("path", "start")
    # with a line of an odd number the state changes within the range, so a record ends and one begins
    parity = counted.agg((F.sum("q") % 2).alias("odd"), F.max(F.col("q") % 2).alias("turns"))
    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    placed = parity.withColumn("inside", F.coalesce(F.sum("odd").over(before) % 2 == 1, F.lit(False)))
    begins = F.when(~F.col("inside") | (F.col("turns") == 1), F.col("start"))
    return placed.select("path", "start", "inside", F.last(begins, ignorenulls=True).over(before).alias("begun"))


def _join_lines(lines: pa.Array, ends: list[int]) -> pa.Array:
    """Runs of lines that end before each of ``ends``, as one text each."""
    runs = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), lines)
    return pc.binary_join(runs, "\n")


def pieces(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """Whole records, and the parts of those that reach over the end of a range."""
    lines = _lines(spark, path)
    state = {(r["path"], r["start"]): (r["inside"], r["begun"]) for r in _ranges(lines, quote).collect()}
    known = spark.sparkContext.broadcast(state)

    def of_range(place: tuple[str, int], batches: Iterator[pa.Array]) -> Iterator[pa.RecordBatch]:
        """The records of one range from its lines. An open record waits for the next batch."""
        path, start = place
        inside, begun = known.value[place]
        at_start, open_, waiting = inside, int(inside), []
        is_first = start == 0

        def rows(records: pa.Array, whole: bool, began: int, part: int) -> pa.RecordBatch:
            nonlocal is_first
            n = len(records)
            first = [False] * n
            if is_first and n:  # empty lines before the header are no records
                filled = next((i for i, r in enumerate(records) if r.as_py().strip("\r")), None)
                if filled is not None:
                    first[filled], is_first = True, False
            same = [pa.array([x] * n, t) for x, t in ((path, pa.string()), (began, pa.int64()), (part, pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [*same, pa.array(first), pa.array([whole] * n), records],
                ["path", "start", "part", "is_first", "whole", "record"],
            )

        for values in batches:
            lines = pa.concat_arrays([*waiting, values])
            seen = sum(map(len, waiting))
            fresh = pc.count_substring(lines.slice(seen), quote)
            inside_after = pc.bit_wise_and(pc.add(pc.cumulative_sum(fresh), open_), 1)
            if len(inside_after):
                open_ = inside_after[-1].as_py()
            closed = pc.indices_nonzero(pc.equal(inside_after, 0)).to_pylist()
            ends = [seen + i + 1 for i in closed]
            if not ends:
                waiting = [lines]
                continue
            if at_start:  # the end of a record that began in an earlier range
                yield rows(_join_lines(lines.slice(0, ends[0]), [ends[0]]), False, begun, start)
                at_start, lines, ends = False, lines.slice(ends[0]), [e - ends[0] for e in ends[1:]]
            if ends:
                yield rows(_join_lines(lines.slice(0, ends[-1]), ends), True, start, start)
                lines = lines.slice(ends[-1])
            waiting = [lines] if len(lines) else []
        if waiting:
            rest = pa.concat_arrays(waiting)
            yield rows(_join_lines(rest, [len(rest)]), False, begun if at_start else start, start)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches cut where a new range begins."""
        current, held = None, []

        def runs() -> Iterator[tuple[tuple[str, int], pa.Array]]:
            for batch in batches:
                paths, starts = batch.column("path"), batch.column("start")
                at = 0
                while at < batch.num_rows:
                    place = (paths[at].as_py(), starts[at].as_py())
                    same = pc.and_(pc.equal(starts, place[1]), pc.equal(paths, place[0])).slice(at)
                    stop = pc.index(same, False).as_py()
                    end = batch.num_rows if stop < 0 else at + stop
                    yield place, batch.column("value").slice(at, end - at)
                    at = end

        feed = runs()
        following = next(feed, None)
        while following is not None:
            current, held = following[0], following[1]

            def own() -> Iterator[pa.Array]:
                nonlocal following
                yield held
                while True:
                    following = next(feed, None)
                    if following is None or following[0] != current:
                        return
                    yield following[1]

            yield from of_range(current, own())

    return lines.mapInArrow(of_task, PIECES)


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``path``, ``is_first`` (the header of its file) and ``record``, the text of a record."""
    found = pieces(spark, path, quote)
    joined = (
        found.where("not whole")
        .groupBy("path", "start")
        .agg(F.max("is_first").alias("is_first"), F.array_sort(F.collect_list(F.struct("part", "record"))).alias("_parts"))
        .select("path", "is_first", F.array_join("_parts.record", "\n").alias("record"))
    )
    every = found.where("whole").select("path", "is_first", "record").unionByName(joined)
    return every.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")


def header_names(records: DataFrame, sep: str, quote: str) -> list[str]:
    """Column names of the first file by path; one line reaches the driver."""
    first = records.where("is_first").orderBy("path").limit(1).collect()
    if not first:
        return []
    names = next(csv.reader([first[0]["record"]], delimiter=sep, quotechar=quote))
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    return [f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names)]


def narrowest_types(rows: DataFrame) -> dict[str, str]:
    """Per text column the first of FORMS that takes all its values, else string; in one pass."""
    checks = [
        F.count_if(
            F.col(f"`{c}`").isNotNull()
            & ~(F.col(f"`{c}`").rlike(rf"\A({form})\z") & F.expr(f"try_cast(`{c}` as {kind}) is not null"))
        ).alias(f"{i}:{kind}")
        for i, c in enumerate(rows.columns)
        for kind, form in FORMS
    ]
    if not checks:
        return {}
    misses = rows.agg(*checks, *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(rows.columns)]).collect()[0]
    return {
        c: next((k for k, _ in FORMS if misses[f"n{i}"] and not misses[f"{i}:{k}"]), "string")
        for i, c in enumerate(rows.columns)
    }


def split_csv_table(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    sep: str = ",",
    quote: str = '"',
    infer: bool = True,
) -> DataFrame:
    """CSV with a header, doubled quotes and line breaks inside fields, read by byte range.

    With ``schema`` columns go by place. Without, names come from the header; types are the
    narrowest that take all values, at the price of one more pass, or strings with
    ``infer=False``.
    """
    found = records(spark, path, quote)
    rows = found.where("not is_first").select("record")
    if schema is None:
        names = header_names(found, sep, quote)
        if not names:
            return spark.createDataFrame([], StructType())
        form = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    else:
        form = schema
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true"}
    parsed = rows.select(F.from_csv("record", form, options).alias("_row")).select("_row.*")
    if schema is None and infer:
        kinds = narrowest_types(parsed)
        return parsed.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in parsed.columns])
    return parsed
