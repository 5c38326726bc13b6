"""Joins that stay balanced when a few keys hold most of the rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.sources.staging import stage

# Most bytes of a table that may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 16


def row_bytes(table: DataFrame) -> Column:
    """Size of a row as text, plus a fixed overhead."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
    return (reduce(lambda a, b: a + b, sizes) + F.lit(ROW_OVERHEAD)).cast("bigint")


def total_bytes(table: DataFrame) -> int:
    """Size of a table by ``row_bytes``."""
    return table.agg(F.sum(row_bytes(table))).first()[0] or 0


def join_on_key(rows: DataFrame, table: DataFrame, key: str, how: str = "inner",
                frequency: str | None = None, size: int | None = None,
                budget: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``rows`` to ``table``, whose ``key`` is unique and not null (``how``: inner or left).

    Unless the caller knows the ``size`` of ``table`` it is measured first, so ``table``
    should be staged or cheap to compute.

    * Up to ``budget`` bytes, ``table`` is broadcast and ``rows`` are not shuffled.
    * Beyond that, the keys that fill ``rows`` are joined by broadcast and only the rest is
      shuffled. With ``w = frequency * row bytes``, a key is hot if its frequency is at
      least ``sum(w) / budget``; the hot part of ``table`` then holds at most
      ``sum(w) / (sum(w) / budget) = budget`` bytes, however the keys are distributed, and
      no key left to the shuffle has more than ``sum(w) / budget`` rows. ``rows`` are staged,
      because both parts read them. Rows with a null key match nothing and are not shuffled.

    ``frequency`` names the column of ``table`` with the number of ``rows`` per key; keys of
    ``rows`` that ``table`` lacks must then be rare. Without it the keys of ``rows`` are
    counted first.
    """
    if size is None:
        size = total_bytes(table)
    if size <= budget:
        return rows.join(F.broadcast(table), key, how)
    rows = stage(rows, "join-rows")
    if frequency is not None:
        weight = F.sum(F.col(frequency) * row_bytes(table))
        hot_from = (table.agg(weight).first()[0] or 0) / budget
        hot_table = table.where(F.col(frequency) >= hot_from)
        cold_table = table.where(F.col(frequency) < hot_from)
        hot = hot_table.select(key)
    else:
        # One row per key on both sides, so this join has no hot key.
        counted = rows.groupBy(key).agg(F.count("*").alias("_rows"))
        sizes = counted.join(table.select(key, row_bytes(table).alias("_bytes")), key, "left")
        # A key that the table lacks is broadcast by itself, if it is hot.
        missing = (F.octet_length(F.col(key).cast("string")) + ROW_OVERHEAD).cast("bigint")
        sizes = stage(sizes.where(F.col(key).isNotNull()).withColumn("_bytes", F.coalesce("_bytes", missing)), "key-sizes")
        hot_from = (sizes.agg(F.sum(F.col("_rows") * F.col("_bytes"))).first()[0] or 0) / budget
        hot = sizes.where(F.col("_rows") >= hot_from).select(key)
        hot_table = table.join(F.broadcast(hot), key, "left_semi")
        cold_table = table.join(F.broadcast(hot), key, "left_anti")
    hot_rows = rows if how == "inner" else rows.join(F.broadcast(hot), key, "left_semi")
    by_broadcast = hot_rows.join(F.broadcast(hot_table), key, how)
    with_key = rows.where(F.col(key).isNotNull())
    by_shuffle = with_key.join(F.broadcast(hot), key, "left_anti").join(cold_table, key, how)
    joined = by_broadcast.unionByName(by_shuffle)
    if how == "left":
        joined = joined.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)
    return joined


def with_df(counts: DataFrame, side_table: DataFrame, word: str = "word", df: str = "df",
            budget: int = BROADCAST_BYTES) -> DataFrame:
    """Attach document frequencies from a side table; words it lacks get 1."""
    joined = join_on_key(counts, side_table.select(word, df), word, "left", budget=budget)
    return joined.withColumn(df, F.coalesce(df, F.lit(1)))


def with_bucketed_df(counts: DataFrame, side_table: DataFrame, word: str = "word", df: str = "df") -> DataFrame:
    """``with_df`` for a side table that is bucketed and sorted by ``word``: a merge join that shuffles ``counts`` alone.

    For side tables beyond a broadcast. ``counts`` has one row a word, so no key is hot.
    """
    joined = counts.join(side_table.select(word, df).hint("merge"), word, "left")
    return joined.withColumn(df, F.coalesce(df, F.lit(1)))
