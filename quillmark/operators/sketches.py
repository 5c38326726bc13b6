"""Counts that are bounded in size: which terms are frequent enough, and how many there are."""

import math
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.sources.staging import stage

# Count-Min: sketches that the terms are dealt over, cells of a row of one, and rows.
PARTS = 16
CELLS = 1 << 16
DEPTH = 2
SEED = 7

# HyperLogLog: 2^LG_K registers, and by how many standard errors an estimate may be off.
LG_K = 12
MOST_ERRORS = 5


def _number(term: Column) -> Column:
    """31 bits of a term, so that products with a hash multiplier fit a long."""
    return F.xxhash64(term).bitwiseAND(F.lit((1 << 31) - 1))


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.hash(term), F.lit(parts))


def _enough(least: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Of each sketch the hash multipliers, and for each row a bit a cell: whether its count is ``least`` or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = {"part": batch["part"], "multipliers": [], "bits": [], "width": []}
            for sketch in batch["sketch"]:
                # Fixed format: version, total, depth, width, a multiplier a row, the rows; big-endian.
                depth, width = (int(v) for v in np.frombuffer(sketch, ">i4", 2, 12))
                made["multipliers"].append(np.frombuffer(sketch, ">i8", depth, 20).astype(np.int64))
                cells = np.frombuffer(sketch, ">i8", depth * width, 20 + 8 * depth).reshape(depth, width)
                full = np.zeros((depth, -(-width // 64) * 64), bool)
                full[:, :width] = cells >= least
                words = np.packbits(full, axis=1, bitorder="little").view("<i8")
                made["bits"].append(words.astype(np.int64).reshape(-1))
                made["width"].append(width)
            yield pd.DataFrame(made)

    return run


def frequent_filter(terms: DataFrame, least: int, term: str = "term", parts: int = PARTS, cells: int = CELLS,
                    depth: int = DEPTH) -> DataFrame:
    """A table of ``parts`` rows by which ``maybe_frequent`` tells terms of fewer than ``least`` rows of ``terms``.

    Count-Min sketches, each over the terms of one part: tasks send ``parts`` rows each instead of one a term,
    and the sketches of a part are merged in a task of their own. What is kept of them is a bit a cell, ``parts *
    depth * cells / 8`` bytes altogether, whatever the input; that bounds the broadcast. Sketches never count too
    low, so no frequent term is lost.
    """
    named = terms.where(F.col(term).isNotNull()).select(_part(F.col(term), parts).alias("part"), _number(F.col(term)).alias("number"))
    confidence = 1 - 0.5**depth
    sketches = named.groupBy("part").agg(
        F.count_min_sketch("number", F.lit(2 / cells), F.lit(confidence), F.lit(SEED)).alias("sketch")
    )
    read = sketches.mapInPandas(_enough(least), "part int, multipliers array<long>, bits array<long>, width int")
    return stage(read, "frequent-terms")


def marked_frequent(rows: DataFrame, known: DataFrame, mark: str, term: str = "term", parts: int = PARTS,
                    depth: int = DEPTH) -> DataFrame:
    """``rows`` with a boolean ``mark``: whether the sketches allow for the term being frequent; true for null terms."""
    prefix = {name: f"_sketch_{name}" for name in known.columns}
    met = rows.join(F.broadcast(known.withColumnsRenamed(prefix)), _part(F.col(term), parts) == F.col("_sketch_part"), "left")
    number, width, bits = _number(F.col(term)), F.col("_sketch_width"), F.col("_sketch_bits")
    words = F.size(bits) / depth

    def full(multiplier: Column, row: Column) -> Column:
        product = multiplier * number
        cell = (product + F.shiftright(product, 32)).bitwiseAND(F.lit((1 << 31) - 1)) % width
        word = F.get(bits, (row * words + F.floor(cell / 64)).cast("int"))
        return F.getbit(word, (cell % 64).cast("int")) == 1

    passes = reduce(and_, [full(F.get("_sketch_multipliers", F.lit(i)), F.lit(i)) for i in range(depth)])
    return met.select(*rows.columns, (F.col(term).isNull() | F.coalesce(passes, F.lit(False))).alias(mark))


def maybe_frequent(rows: DataFrame, known: DataFrame, term: str = "term", parts: int = PARTS, depth: int = DEPTH) -> DataFrame:
    """``rows`` without those whose term is in too few rows by the sketches; null terms stay."""
    return marked_frequent(rows, known, "_frequent", term, parts, depth).where("_frequent").select(*rows.columns)


def distinct_sketches(terms: DataFrame, keys: list[str], term: str = "term", lg_k: int = LG_K) -> DataFrame:
    """``(keys, sketch)``: a HyperLogLog sketch of the terms of each key, to be stored and merged."""
    return terms.groupBy(*keys).agg(F.hll_sketch_agg(term, lg_k).alias("sketch"))


def merged_estimate(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, estimate)`` of the distinct terms of all sketches of each key."""
    merged = sketches.groupBy(*keys) if keys else sketches
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def within_error(exact: Column, estimate: Column, lg_k: int = LG_K) -> Column:
    """Whether an estimate is as near as the documentation of the sketch has it, ``MOST_ERRORS`` standard errors."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1), exact * (MOST_ERRORS * 1.04 / math.sqrt(1 << lg_k)))
