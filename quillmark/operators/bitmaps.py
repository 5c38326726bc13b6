"""Document frequency of documents in pieces, by bitmaps of document numbers."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.tokenizers import NOT_EMPTY, Keep
from quillmark.operators.counts import explode_tokens
from quillmark.operators.sketches import frequent_filter, marked_frequent
from quillmark.sources.staging import stage

# A term goes by bitmaps if it has so many rows for each bucket of 32,768 document numbers. A bitmap of
# few bits is mostly zeros, which the shuffle compresses.
LEAST_BITS = 24
# Cells of a row of the sketch that tells these terms.
CELLS = 1 << 12
# A bitmap is so many words of 64 document numbers each. They are numbers in a row of fixed length, which a
# hash aggregate changes in place; Spark's bitmaps are bytes, for which it sorts every row by term first.
WORDS = 32


def _bitmap(number: Column) -> list[Column]:
    """The bits of document numbers as aggregates, a column for each word."""
    word = F.shiftright(number, 6).bitwiseAND(F.lit(WORDS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
    return [F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"_word_{i}") for i in range(WORDS)]


def document_frequency(docs: DataFrame, number: str, tokens: Column, term: str = "term", df: str = "df",
                       keep: Keep = NOT_EMPTY, least_bits: int = LEAST_BITS, cells: int = CELLS) -> DataFrame:
    """Number of documents that hold each term, where rows with equal ``number`` are pieces of one document.

    The same rows as ``counts.document_frequency`` with ``chunks_of``, which sends a row for each document and
    term. Here a frequent term's documents are bits: a task sends one bitmap for each such term and block of
    ``64 * WORDS`` numbers, whatever number of documents they are, and a term that fills the corpus is dealt by
    block. Terms that are rare by a sketch still go as rows. What the sketch says changes only what is sent.

    ``number`` is an integer column, negative ones included; null is one document. It pays where numbers are
    dense, such as those that ``monotonically_increasing_id`` gives before documents are cut into pieces, and
    where a task has documents of few buckets. The fewer documents a bucket has, the fewer terms go by bitmaps;
    with numbers drawn at random none does. The text is tokenized once: the terms of each row are staged, and
    what counts the buckets, sketches the terms and sends them reads them there.
    """
    numbered = docs.withColumn(number, F.col(number).cast("bigint"))
    terms = stage(explode_tokens(numbered, [number], F.array_distinct(tokens), term, keep), "terms")
    buckets = terms.select(F.bitmap_bucket_number(number)).distinct().count()
    known = frequent_filter(terms, least_bits * max(buckets, 1), term, cells=cells)
    marked = marked_frequent(terms, known, "_dense", term).withColumn("_dense", F.col("_dense") & F.col(number).isNotNull())
    block = F.shiftright(number, (64 * WORDS).bit_length() - 1).alias("_block")
    dense = marked.where("_dense").groupBy(term, block).agg(*_bitmap(F.col(number)))
    bits = reduce(add, [F.bit_count(f"_word_{i}") for i in range(WORDS)]).cast("bigint")
    single = marked.where("not _dense").select(number, term).distinct().select(term, F.lit(1).cast("bigint").alias(df))
    return dense.select(term, bits.alias(df)).unionByName(single).groupBy(term).agg(F.sum(df).alias(df))
