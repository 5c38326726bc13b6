"""Document fingerprints: similarity digests of whole texts, and their comparison with the next document.

A digest takes the byte windows whose entropy is rare in the corpus: which entropies are rare
is counted over all windows of all documents first.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import id_and_text, map_batches, text_bytes
from quillmark.llm.digests import Digests, entropy_counts, likeness, rarity_ranks

# Rows whose digests are made together.
ROWS = 256
_FIRST = -(1 << 63)


def fit_rarity(docs: DataFrame) -> np.ndarray:
    """Ranks of the entropy bins, from all windows of all texts; one sum for each bin reaches the driver."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = entropy_counts(*text_bytes(batch.column("text")))
        met = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["bin", "n"])

    counted = map_batches(id_and_text(docs).select("text"), count, "bin bigint, n bigint")
    counts = np.zeros(1001, np.int64)
    for row in counted.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[row["bin"]] = row["n"]
    return rarity_ranks(counts)


def fingerprint(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """``(doc_id, fingerprint)``, one row for each row of ``docs``; null and empty texts have an empty one."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Digests(*text_bytes(batch.column("text")), ranks)
        texts = [found.text(i) for i in range(batch.num_rows)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "fingerprint"])

    return map_batches(id_and_text(docs), make, f"doc_id {dict(docs.dtypes)['doc_id']}, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """``(slice, ahead, key, doc_id, text)``: the documents in the order of their ids, slice by slice.

    A slice is sorted inside one partition, and behind its last document stands, marked
    ``ahead``, the first one of the next slice (of the first, behind the last). So every
    document meets its successor, and each text is shuffled once. Slices are cut at quantiles
    of the ids; only cuts and first ids, one for each slice, reach the driver. A null id comes
    first; rows with one id are ordered by a hash of the text.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = id_and_text(docs).select(F.coalesce("doc_id", F.lit(_FIRST)).alias("key"), "doc_id", "text")
    shares = [i / n for i in range(1, n)] or [1.0]
    cuts = keyed.agg(F.percentile_approx("key", F.array(*[F.lit(s) for s in shares]), 10000)).first()[0] or []
    cuts = np.unique(np.array(cuts[: n - 1], np.int64))

    def head(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column("key").to_numpy()
        slices = np.searchsorted(cuts, keys, "right")
        order = np.lexsort((keys, slices))
        first = np.ones(len(order), bool)
        first[1:] = slices[order][1:] != slices[order][:-1]
        return pa.RecordBatch.from_arrays(
            [pa.array(slices[order][first].astype(np.int32)), pa.array(keys[order][first])], ["slice", "key"])

    heads = map_batches(keyed.select("key"), head, "slice int, key bigint").groupBy("slice").agg(F.min("key").alias("key"))
    firsts = sorted((r["slice"], r["key"]) for r in heads.collect())
    slice_before = {key: firsts[i - 1][0] for i, (_, key) in enumerate(firsts)}
    schema = "slice int, ahead boolean, " + ", ".join(f"{name} {kind}" for name, kind in keyed.dtypes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            slices = np.searchsorted(cuts, keys, "right").astype(np.int32)
            names = ["slice", "ahead", *batch.schema.names]
            yield pa.RecordBatch.from_arrays([pa.array(slices), pa.array(np.zeros(len(keys), bool)), *batch.columns], names)
            heads_here = np.flatnonzero(np.isin(keys, list(slice_before)))
            if len(heads_here):
                copied = batch.take(pa.array(heads_here))
                before = np.array([slice_before[k] for k in keys[heads_here].tolist()], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before), pa.array(np.ones(len(before), bool)), *copied.columns], names)

    placed = keyed.mapInArrow(place, schema).repartitionById(n, F.col("slice"))
    return placed.sortWithinPartitions("slice", "ahead", "key", F.xxhash64("text"))


def _edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pa.array(texts, pa.large_string()))


def compare_with_next(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprints of each document, of an edited copy, and of the next document, and their likeness.

    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``, one row for each row of ``docs (doc_id, text)``. The edited copy has its last
    half replaced by as many characters from the start of the next document, by ascending
    ``doc_id``; the last document is followed by the first, a single one by itself. Null texts
    are empty, and empty texts have empty fingerprints; whole texts are used.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows of which the last has not met its successor
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("slice", "ahead", "doc_id", "text")]
            waiting.extend(zip(*columns))
            while len(waiting) > ROWS:
                yield _compared(waiting[: ROWS + 1], ranks)
                del waiting[:ROWS]
        if len(waiting) > 1:
            yield _compared(waiting, ranks)

    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return in_order(docs).select("slice", "ahead", "doc_id", "text").mapInArrow(
        lambda batches: (b.cast(_arrow_schema(b, kind)) for b in compare(batches)), schema
    )


def _arrow_schema(batch: pa.RecordBatch, kind: str) -> pa.Schema:
    types = {"bigint": pa.int64(), "int": pa.int32()}
    return batch.schema.set(0, pa.field("doc_id", types.get(kind, batch.schema.field(0).type)))


def _compared(rows: list[tuple], ranks: np.ndarray) -> pa.RecordBatch:
    """Results of all rows but the last, of which no row that is only ahead counts."""
    texts = [text for _, _, _, text in rows]
    edited = [_edited(text, following) for text, following in zip(texts, texts[1:])]
    own, changed = Digests(*_buffer(texts), ranks), Digests(*_buffer(edited), ranks)
    made: list[list] = [[] for _ in range(7)]
    for i, (_, ahead, doc_id, text) in enumerate(rows[:-1]):
        if ahead:
            continue
        chain = own.chain(i)
        values = (
            doc_id, len(text), hashlib.sha256(edited[i].encode()).hexdigest(), own.text(i), changed.text(i),
            likeness(chain, changed.chain(i)), likeness(chain, own.chain(i + 1)),
        )
        for column, value in zip(made, values):
            column.append(value)
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, types)], names)
