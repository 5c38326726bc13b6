"""How far the sources of a language diverge in their words.

Texts are tokenized as bytes: one translation lowers A-Z and blanks every other byte that is no
letter and not part of a character beyond ASCII, a split gives the terms, and a Counter a document's
counts. A batch adds its documents' counts up before they leave the task, so what is shuffled is one
row for each group and term of a batch, and a source that holds most rows is split over the tasks
like any other.

A share is an integer: ``1 + floor(10^9 (count + 5) / (N + 5 V))``, with decimals of 38 digits, so that
every figure is exact at any size. A term that a group lacks has the share of count 0, which depends on
the group alone; so the counts stay sparse, and what two sources differ by over all terms that neither
has is one product.

The distance of all pairs of sources is asked for. It is taken in tiles: the terms of a language are cut
into buckets and its sources into blocks, a tile is a bucket for two blocks, a NumPy matrix of bounded
size, and the tiles' sums are added up. No row meets all others.

Null texts, languages and sources count as empty ones, so rows without a language are a language. A group
without terms takes part with N = 0. Repeated rows count each time. An empty table gives no rows; a
language with one source no pairs; without kept terms every distance is 0. Ties of a rank go to the item
that is first in UTF-8.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.sources.staging import stage

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5

# A tile is at most so many terms for two blocks of so many sources.
TILE_TERMS = 2048
TILE_SOURCES = 128
# Counts that a task holds before it hands them on, by number and by bytes of their terms.
HELD_TERMS = 1 << 17
HELD_BYTES = 1 << 24

_UPPER, _LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_NO_TERM = bytes(b for b in range(0x80) if b not in _UPPER and b not in _LOWER)
TERM_BYTES = bytes.maketrans(_UPPER + _NO_TERM, _LOWER + b" " * len(_NO_TERM))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


class _Held:
    """Counts of terms by group, and in how many documents they are, until there are many of them."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.counts: dict[tuple[str, str], Counter] = {}
        self.documents: dict[tuple[str, str], Counter] = {}
        self.held = self.bytes = 0

    def add(self, group: tuple[str, str], text: bytes) -> None:
        own = Counter(terms(text))
        counts = self.counts.setdefault(group, Counter())
        before = len(counts)
        counts.update(own)
        self.documents.setdefault(group, Counter()).update(own.keys())
        self.held += len(counts) - before
        self.bytes += sum(map(len, own))

    def batch(self) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), counts in self.counts.items():
            documents = self.documents[lang, source]
            for column, values in zip(columns, (
                [lang] * (len(counts) + 1), [source] * (len(counts) + 1), [None, *counts], [0, *counts.values()],
                [0, *(documents[t] for t in counts)],
            ), strict=True):
                column += values
        lang, source, term, n, n_docs = columns
        term = pa.array(term, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()), term, pa.array(n, pa.int64()),
             pa.array(n_docs, pa.int64())], ["lang", "source", "term", "n", "n_docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in batches:
        lang, source = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        text = batch.column(2)
        for i in range(batch.num_rows):
            held.add((lang[i], source[i]), text[i].as_buffer().to_pybytes())
            if held.held > HELD_TERMS or held.bytes > HELD_BYTES:
                yield held.batch()
                held.clear()
    if held.counts:
        yield held.batch()


def group_counts(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` and documents ``n_docs`` of each term in each (lang, source); a null term for the group itself."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = texts.mapInArrow(_count, "lang string, source string, term string, n long, n_docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(n: Column, total: Column, vocabulary: Column) -> Column:
    """The smoothed share of a count in ``total``, in billionths and at least 1; exact. 0 without a vocabulary."""
    above = (n + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + (vocabulary * SMOOTHING).cast("decimal(20,0)")
    return F.when(vocabulary > 0, F.call_function("div", above, below) + 1).otherwise(F.lit(0)).cast("bigint")


def _distances(tile: pd.DataFrame) -> pd.DataFrame:
    """What the sources of a tile differ by, over the terms that some of them have.

    Rows are (source, side, zero, term, p); a row without a term names a source. ``covered`` counts the
    tile's terms. Only pairs of one source of each block are returned, in one direction if the blocks are one.
    """
    sources = tile[["source", "side", "zero"]].drop_duplicates(["source"]).sort_values("source", ignore_index=True)
    number = pd.Series(np.arange(len(sources)), index=sources["source"])
    cells = tile[tile["term"].notna()]
    term, names = pd.factorize(cells["term"])
    shares = np.repeat(sources["zero"].to_numpy(np.int64)[:, None], len(names), axis=1)
    shares[number[cells["source"]].to_numpy(), term] = cells["p"].to_numpy(np.int64)
    side, at = sources["side"].to_numpy(), np.arange(len(sources))
    between = side.min() != side.max()
    first, second, apart = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in at:
        others = np.flatnonzero(side > side[i] if between else at > i)
        first.append(np.full(len(others), i))
        second.append(others)
        apart.append(np.abs(shares[others] - shares[i]).sum(axis=1))
    name = sources["source"].to_numpy()
    return pd.DataFrame({
        "lang": tile["lang"].iloc[0], "source": name[np.concatenate(first)], "item": name[np.concatenate(second)],
        "apart": np.concatenate(apart), "covered": len(names),
    })


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """The distance of every two sources of a language, in both directions.

    ``cells`` have lang, source, term, p for the terms that a group has; ``groups`` lang, source, zero (the
    share of no occurrence) and v, the number of kept terms.
    """
    n_sources = F.count("*").over(W.partitionBy("lang"))
    order = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    numbered = stage(groups.select(
        "lang", "source", "zero", "v", F.floor(order / TILE_SOURCES).alias("part"),
        F.ceil(n_sources / TILE_SOURCES).alias("parts"), F.greatest(F.lit(1), F.ceil(F.col("v") / TILE_TERMS)).alias("buckets"),
    ), "divergence-groups")
    # Each source is named in every bucket, so that a tile knows those that have none of its terms.
    named = numbered.withColumn("bucket", F.explode(F.sequence(F.lit(1), "buckets")))
    dealt = F.pmod(F.xxhash64("term"), F.col("buckets")) + 1
    held = cells.join(numbered, ["lang", "source"]).withColumn("bucket", dealt)
    columns = ["lang", "source", "zero", "part", "parts", "bucket"]
    rows = held.select(*columns, "term", "p").unionByName(
        named.select(*columns, F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("p")))
    # A block meets every block, itself included; alone, if there is one.
    tiles = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "lang", "bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        F.when(F.col("part") > F.col("other"), 1).otherwise(0).alias("side"), "source", "zero", "term", "p")
    apart = tiles.groupBy("lang", "bucket", "low", "high").applyInPandas(
        _distances, "lang string, source string, item string, apart long, covered long")
    sums = apart.groupBy("lang", "source", "item").agg(F.sum("apart").alias("apart"), F.sum("covered").alias("covered"))
    one = numbered.select("lang", "source", F.col("zero").alias("zero_1"), "v")
    two = numbered.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_2"))
    # Terms that no source of the tile has, and languages without terms.
    rest = F.abs(F.col("zero_1") - F.col("zero_2")) * (F.col("v") - F.col("covered"))
    found = sums.join(one, ["lang", "source"]).join(two, ["lang", "item"]).withColumn("value", F.col("apart") + rest)
    both = F.inline(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    return found.select("lang", both, "value")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """The distance of each source to the others of its language, and the terms that it has more of than the language.

    Returns lang, source, part, item, value and rank, from 1 per source and part. Part ``pair``: items are the
    other sources, values the sums of the differences of shares over the terms that ``least_documents``
    documents of the language have. Part ``term``: the ``top_terms`` terms by how far the source's share is
    above that of the language.
    """
    counted = stage(group_counts(docs), "divergence-counts")
    kept = stage(
        counted.where("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs"))
        .where(F.col("n_docs") >= least_documents).drop("n_docs"),
        "divergence-terms",
    )
    cells = stage(counted.drop("n_docs").join(kept, ["lang", "term"]), "divergence-cells")
    languages = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left")
    groups = groups.join(languages, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    groups = groups.withColumn("zero", share(F.lit(0), F.col("total"), F.col("v")))
    shared = cells.join(groups.drop("zero"), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
    )
    above = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = _pairs(shared.drop("q"), groups)
    return _ranked(pairs, "pair").unionByName(_ranked(above, "term").where(F.col("rank") <= top_terms))


_UP, _LOW = _UPPER.decode(), _LOWER.decode()
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
  translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTHING})) // (coalesce(t.total, 0) + {SMOOTHING} * l.v) AS p,
  1 + ({SCALE}::HUGEINT * (k.n + {SMOOTHING})) // (l.total + {SMOOTHING} * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
a AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term)
  WHERE x.source <> y.source GROUP BY ALL),
b AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value FROM g x JOIN g y
  ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM b QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
