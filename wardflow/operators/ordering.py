"""Neighbours and running sums in a total order, without one task per group.

A plain window sends all rows of one key to one task, and one key may own a third of
all rows. Here the rows are range partitioned by (keys, order), which cuts a hot key
over many tasks. Each range is worked on alone, then the one edge row per range and
key is stitched to its neighbour. All steps are one lineage, so a cut is never taken
twice with different bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE = "_slice"


def slice_in_order(df: DataFrame, order: list) -> DataFrame:
    """Add a slice number that never decreases along ``order``."""
    return df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id())


def lead_within(
    sliced: DataFrame, keys: list[str], order: list, values: dict[str, Column]
) -> DataFrame:
    """``lead(value) over (partition by keys order by order)`` for each named value.

    ``sliced`` comes from ``slice_in_order(df, [*keys, *order])``, possibly filtered
    since then.
    """
    value = F.struct(*[expr.alias(name) for name, expr in values.items()])
    inside = W.partitionBy(SLICE, *keys).orderBy(*order)
    stepped = (
        sliced.withColumn("_value", value)
        .withColumn("_next", F.lead("_value").over(inside))
        .withColumn("_head", F.first("_value").over(inside))
    )
    # rows still without a neighbour: the last row of each key in each slice
    edge = F.col("_next").isNull()
    across = W.partitionBy(*keys, F.when(edge, -1).otherwise(F.col(SLICE))).orderBy(SLICE)
    stitched = stepped.withColumn("_far", F.lead("_head").over(across)).withColumn(
        "_next", F.when(edge, F.col("_far")).otherwise(F.col("_next"))
    )
    return stitched.withColumns({name: F.col("_next")[name] for name in values}).drop(
        "_value", "_next", "_head", "_far"
    )


def running_sums(
    df: DataFrame, order: list, sums: dict[str, Column], totals: bool = False
) -> DataFrame:
    """Add ``sum(x) over (order by order rows unbounded preceding)`` for each named x.

    With ``totals`` also ``total_{name}``, the sum over all rows.
    """
    sliced = slice_in_order(df, order)
    inside = W.partitionBy(SLICE).orderBy(*order)
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(SLICE)
    edge = F.col("_edge")
    local = sliced.withColumn("_edge", F.lead(F.lit(1)).over(inside).isNull()).withColumns(
        {f"_run_{n}": F.sum(x).over(so_far) for n, x in sums.items()}
    )
    # the edge row of a slice carries the slice total in its running sum
    edges = W.partitionBy(F.when(edge, -1).otherwise(F.col(SLICE))).orderBy(SLICE)
    up_to = edges.rowsBetween(W.unboundedPreceding, W.currentRow)
    overall = edges.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    through = local.withColumns(
        {f"_thru_{n}": F.sum(f"_run_{n}").over(up_to) for n in sums}
        | ({f"_all_{n}": F.sum(f"_run_{n}").over(overall) for n in sums} if totals else {})
    )

    def of_slice(edge_value: Column) -> Column:
        return F.max(F.when(edge, edge_value)).over(whole)

    done = through.withColumns(
        {
            n: F.col(f"_run_{n}") + of_slice(F.col(f"_thru_{n}") - F.col(f"_run_{n}"))
            for n in sums
        }
        | ({f"total_{n}": of_slice(F.col(f"_all_{n}")) for n in sums} if totals else {})
    )
    added = [*sums, *[f"total_{n}" for n in sums if totals]]
    return done.select(*[c for c in df.columns if c not in sums], *added)
