"""Running totals and prefixes of an ordered table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.sources.staging import stage


def running_prefix(rows: DataFrame, order: list[str | Column], weight: Column, target: int,
                   total: str = "running_total") -> DataFrame:
    """Rows in ``order`` up to and with the one whose running total reaches ``target``.

    A target of 0 keeps all rows. ``order`` must be unique. The result has the columns of
    ``rows`` and the running total. ``rows`` are read twice, to sample the ranges and to cut
    them, so they should be narrow, and staged if they are dear to compute.

    One window over all rows would run in one task. Here the rows are cut into ordered,
    evenly filled slices by a range partitioning; a table with one row per slice gives each
    slice the total before it, slices that start past the target are dropped, and the
    running total inside a slice is a window of its own. The cut is staged because every
    later step must see the same slices.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stage(
        rows.withColumn("_weight", weight.cast("bigint"))
        .repartitionByRange(*order)
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    # One row per shuffle partition, so the single-task window and the broadcast are bounded.
    slices = cut.groupBy("_slice").agg(F.sum("_weight").alias("_sum"))
    earlier = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = slices.select("_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    if target > 0:
        starts = starts.where(F.col("_start") < target)
    inside = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    # A slice goes to the partition of its number: no two share a task, and the window needs no other shuffle.
    by_slice = cut.join(F.broadcast(starts), "_slice").repartitionById(n, "_slice")
    totals = by_slice.withColumn(total, F.col("_start") + F.sum("_weight").over(inside))
    if target > 0:
        totals = totals.where(F.col(total) - F.col("_weight") < target)
    return totals.drop("_slice", "_start", "_weight")


# Largest k that is sorted in one task.
SMALL_K = 10_000


def top_k(rows: DataFrame, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows in ``order`` (unique), ranked from 1.

    A small ``k`` is a plain sort and limit, which keeps ``k`` rows per task. A large one
    would send ``k`` rows of every task to one task; it is a prefix with weight 1 instead.
    """
    if k > SMALL_K:
        return running_prefix(rows, order, F.lit(1), k, rank)
    return rows.orderBy(*order).limit(k).withColumn(rank, F.row_number().over(W.orderBy(*order)).cast("bigint"))
