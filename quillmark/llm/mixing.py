"""Mixing sources to target weights by hash thresholds.

Each document has a 60-bit hash of its id. A source that may take ``rest`` words takes the
documents whose hash lies below a threshold, and the threshold is found without sorting: a
histogram of the words by source and hash bucket shows the bucket in which the running sum
passes ``rest``, and only the documents of that bucket go into the next, finer histogram,
until the bucket is one hash value.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import free_name
from quillmark.sources.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
# Sources in code point order, null last, weigh these, repeating.
WEIGHTS = (3, 1, 2)
# Words of the mix for each word of the corpus, and most copies of a document.
BUDGET_SHARE = 1.5
MOST_COPIES = 2
HASH_BITS = 60
LEVEL_BITS = 12


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the id's MD5 digest."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget_share: float = BUDGET_SHARE,
                   most_copies: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size, target)`` of ``(source, source_size)``, one row for each source.

    The budget is shared by weight. No target exceeds ``most_copies`` times its source; what
    is too much goes to the others by weight until none is above. In the order of size by
    weight the limited sources come first, so one running sum finds them: a source is limited
    if it would be with all the sources before it limited.

    All windows here are over one row for each source, never over documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    position = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (position % len(weights) + 1).cast("int"))
    weighed = sizes.select("source", "source_size", weight.alias("weight"), position.alias("position"))
    everything = W.partitionBy()
    by_ratio = W.orderBy(F.col("ratio"), F.col("position")).rowsBetween(W.unboundedPreceding, -1)
    most = (F.col("source_size") * most_copies).alias("most")
    shared = weighed.select(
        "*", most, (F.col("source_size") * most_copies / F.col("weight")).alias("ratio"),
        (F.sum("source_size").over(everything) * budget_share).alias("budget"),
        F.sum("weight").over(everything).alias("all_weights"),
    )
    limits = shared.select(
        "*",
        F.coalesce(F.sum("most").over(by_ratio), F.lit(0)).alias("spent"),
        (F.col("all_weights") - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))).alias("open_weight"),
    ).withColumn("limited", F.col("ratio") < (F.col("budget") - F.col("spent")) / F.col("open_weight"))
    open_budget = F.col("budget") - F.coalesce(F.sum(F.when(F.col("limited"), F.col("most"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("limited"), F.col("weight"))).over(everything)
    target = F.when(F.col("limited"), F.col("most").cast("double")).otherwise(
        open_budget / open_weight * F.col("weight")
    )
    return limits.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, source_size, target, full, below)`` from ``sized (source, size, hash)``.

    Every document of the source is taken ``full`` times, and those whose hash is less than
    ``below`` once more. The hash at which the running sum passes what is wanted is taken if
    that comes nearer to it than leaving it out.
    """
    full = F.floor(F.least(F.col("target") / F.greatest("source_size", F.lit(1)), F.lit(1.0))).cast("bigint")
    state = stage(
        targets.withColumn("full", full).select(
            "*", (F.col("target") - F.col("full") * F.col("source_size")).alias("rest"),
            F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before"),
            F.lit(True).alias("open"),
        ),
        "mix-state",
    )
    members = sized
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftright("hash", shift)
        known = state.where("open").select(F.col("source").alias("_source"), "prefix", "rest", "before")
        joined = members.join(known, F.col("source").eqNullSafe(F.col("_source")))
        inside = joined.where(F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix"))
        histogram = inside.groupBy("_source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("before")
        )
        order = W.partitionBy("_source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        running = histogram.withColumn("upto", F.col("before") + F.sum("words").over(order))
        # The bucket in which the sum passes what is wanted; without one, all are taken.
        passing = running.where(F.col("upto") > F.col("rest")).groupBy("_source").agg(
            F.min(F.struct("bucket", "upto", "words")).alias("hit")
        )
        known_state = state.drop("prefix", "before", "open", "boundary")
        state = stage(
            known_state.join(
                passing.select(
                    F.col("_source"), F.col("hit.bucket").alias("prefix"),
                    (F.col("hit.upto") - F.col("hit.words")).alias("before"), F.col("hit.words").alias("boundary"),
                ),
                F.col("source").eqNullSafe(F.col("_source")), "left",
            ).drop("_source").withColumn("open", F.col("prefix").isNotNull()),
            "mix-state",
        )
        if shift:
            cut = state.where("open").select(F.col("source").alias("_source"), "prefix")
            members = stage(
                members.join(
                    cut, F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("hash", shift) == F.col("prefix")),
                    "left_semi",
                ),
                "mix-boundary",
            )
    nearer = (F.col("before") + F.col("boundary") - F.col("rest")) < (F.col("rest") - F.col("before"))
    below = F.when(F.col("open"), F.col("prefix") + nearer.cast("bigint")).otherwise(F.lit(1 << HASH_BITS))
    return state.select("source", "source_size", "target", "full", below.alias("below"))


def size_documents(docs: DataFrame) -> DataFrame:
    """Staged ``(doc_id, source, size, hash)``: the texts are read once."""
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"), id_hash(F.col("doc_id")).alias("hash"))
    return stage(sized, "mix-sizes")


def _plan(sized: DataFrame) -> DataFrame:
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    return thresholds(sized.select("source", "size", "hash"), source_targets(sources))


def _copies() -> Column:
    return F.col("full") + (F.col("hash") < F.col("below")).cast("bigint")


def mix(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row for each row of ``docs (doc_id, source, text)``.

    ``size`` is the number of words (null text: 0), ``taken`` the words that the mix takes,
    each copy counted. Rows with the same id have the same hash and are taken together. A
    null source is a source; a null id is hashed like any other. Documents without words are
    taken 0 words. An empty table gives an empty mix.
    """
    sized = size_documents(docs)
    plan = _plan(sized).withColumnRenamed("source", "_source")
    taken = (F.col("size") * _copies()).alias("taken")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", taken
    )


def mixed_documents(docs: DataFrame, copy_no: str = "copy_no") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, numbered from 1 in ``copy_no``.

    The texts are joined to one row for each source and not shuffled.
    """
    copy_no = free_name(docs, copy_no)
    plan = _plan(size_documents(docs))
    names = {c: free_name(docs, f"mix_{c}") for c in ("source", "full", "below")}
    plan = plan.select(*[F.col(c).alias(name) for c, name in names.items()])
    joined = docs.join(plan, F.col("source").eqNullSafe(F.col(names["source"])))
    extra = (id_hash(F.col("doc_id")) < F.col(names["below"])).cast("bigint")
    copies = (F.col(names["full"]) + extra).cast("int")
    return joined.select(*docs.columns, F.explode(F.slice(F.array(F.lit(1), F.lit(2)), 1, copies)).alias(copy_no))


SQL = f"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
  ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS hash FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS position FROM sources),
shared AS (SELECT *, source_size * 2 AS most, w, source_size * 2 / w AS ratio,
  sum(source_size) OVER ()::DOUBLE * 1.5 AS budget, sum(w) OVER () AS all_weights
  FROM (SELECT *, CASE position % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM weighed)),
limits AS (SELECT *, ratio < (budget - spent) / open_weight AS limited FROM (SELECT *,
  coalesce(sum(most) OVER before, 0) AS spent, all_weights - coalesce(sum(w) OVER before, 0) AS open_weight
  FROM shared WINDOW before AS (ORDER BY ratio, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
targets AS (SELECT source, source_size, CASE WHEN limited THEN most::DOUBLE ELSE
  (budget - coalesce(sum(CASE WHEN limited THEN most END) OVER (), 0)) /
  sum(CASE WHEN NOT limited THEN w END) OVER () * w END AS target FROM limits),
ranked AS (SELECT doc_id, size, source_size, target, sum(size) OVER (PARTITION BY s.source ORDER BY hash) AS upto,
  sum(size) OVER (PARTITION BY s.source, hash) AS same, floor(least(target / greatest(source_size, 1), 1)) AS full_copies
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
rested AS (SELECT *, target - full_copies * source_size AS rest, upto - same AS before FROM ranked)
SELECT doc_id, size, source_size, target, (size * (full_copies + CASE WHEN upto <= rest OR
  (before <= rest AND upto - rest < rest - before) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rested
"""
