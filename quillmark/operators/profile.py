"""One-row and per-stage summaries of a corpus."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.scoring import megabytes, per
from quillmark.functions.tokenizers import NOT_EMPTY, Keep
from quillmark.sources.readers import text_lines


def require_documents(docs: DataFrame) -> DataFrame:
    """``docs``, or an error if it has no row."""
    if docs.isEmpty():
        raise ValueError("no documents found in the input")
    return docs


def corpus_profile(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents, characters, bytes, lines, and size in MB (characters / 1024²)."""
    n_lines = F.when(F.length(text) > 0, F.size(text_lines(F.col(text)))).otherwise(F.lit(0))
    totals = docs.agg(
        F.count("*").alias("n_docs"),
        F.coalesce(F.sum(F.length(text).cast("bigint")), F.lit(0)).alias("total_chars"),
        F.coalesce(F.sum(F.octet_length(text).cast("bigint")), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum(n_lines.cast("bigint")), F.lit(0)).alias("total_lines"),
    )
    return totals.withColumn("total_mb", megabytes(F.col("total_chars")))


def token_profile(docs: DataFrame, tokens: Column, keep: Keep = NOT_EMPTY) -> DataFrame:
    """Documents, tokens, tokens per document and vocabulary size, from one pass.

    Each document gives a null beside its tokens, so their number comes from the same counts.
    """
    no_tokens = F.array().cast("array<string>")
    terms = F.array_append(F.coalesce(tokens, no_tokens), F.lit(None).cast("string"))
    kept = F.col("term").isNull() | keep(F.col("term"))
    stats = docs.select(F.explode(terms).alias("term")).where(kept).groupBy("term").agg(F.count("*").alias("c"))
    n_docs = F.coalesce(F.sum(F.when(F.col("term").isNull(), F.col("c"))), F.lit(0))
    total_tokens = F.coalesce(F.sum(F.when(F.col("term").isNotNull(), F.col("c"))), F.lit(0))
    return stats.agg(
        n_docs.alias("n_docs"),
        total_tokens.alias("total_tokens"),
        per(total_tokens, n_docs).alias("avg_tokens_per_doc"),
        F.count("term").alias("vocab_size"),
    )


class Watch:
    """Figures of the steps of a job, taken while it runs: nothing is written or computed again to be counted.

    ``through`` puts a step's table through an observation; its figures are there once an action has run over
    the table. Spark adds them up task by task. A task that fails and runs again counts once. Where a lost
    executor takes finished shuffle output with it, its tasks run again and count again: figures are exact for
    a run without such a loss and an upper bound otherwise. A table that two actions read is observed in the first.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def through(self, table: DataFrame, name: str, **figures: Column) -> DataFrame:
        """``table``, whose ``figures`` (aggregates) are observed under ``name``."""
        self._seen[name] = Observation()
        return table.observe(self._seen[name], *[figure.alias(label) for label, figure in figures.items()])

    def figures(self, name: str) -> dict[str, int]:
        """What was observed; a sum over no rows is 0."""
        return {label: value or 0 for label, value in self._seen[name].get.items()}


def records_and_bytes(line: Column, n_lines: Column | None = None) -> dict[str, Column]:
    """The figures of text records as a step reads them; a record's line feed counts as a byte."""
    records = F.count("*") if n_lines is None else F.sum(n_lines.cast("bigint"))
    return {"records": records, "n_bytes": F.sum(F.octet_length(line).cast("bigint") + 1)}


def input_profile(spark: SparkSession, steps: dict[str, dict[str, int]]) -> DataFrame:
    """``(stage, records, n_bytes, mb, bytes_per_record)`` of the observed steps, a row each."""
    rows = spark.createDataFrame(
        [(name, seen["records"], seen["n_bytes"]) for name, seen in steps.items()], "stage string, records long, n_bytes long"
    )
    return rows.withColumn("mb", megabytes(F.col("n_bytes"))).withColumn(
        "bytes_per_record", per(F.col("n_bytes"), F.col("records"))
    )
