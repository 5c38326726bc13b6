"""Sentiment classes from a lexicon."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.counts import term_frequency
from quillmark.operators.joins import BROADCAST_BYTES, join_on_key

POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"


def lexicon_sentiment(docs: DataFrame, key: str, tokens: Column, lexicon: DataFrame,
                      budget: int = BROADCAST_BYTES) -> DataFrame:
    """``(key, score, sentiment)``: the sum of ``tf * polarity``, and its sign as a class.

    ``lexicon`` is ``(term, polarity)`` with unique terms. Documents without a hit score 0
    and are neutral.
    """
    hits = join_on_key(term_frequency(docs, [key], tokens), lexicon, "term", budget=budget).select(
        key, (F.col("tf") * F.col("polarity")).cast("bigint").alias("score")
    )
    # Adding one zero per document keeps those without a hit and needs no join.
    zeros = docs.select(key, F.lit(0).cast("bigint").alias("score"))
    scores = hits.unionByName(zeros).groupBy(key).agg(F.sum("score").alias("score"))
    sentiment = (
        F.when(F.col("score") > 0, POSITIVE).when(F.col("score") < 0, NEGATIVE).otherwise(NEUTRAL)
    )
    return scores.withColumn("sentiment", sentiment)
