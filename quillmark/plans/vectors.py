"""TF-IDF as sparse vectors, without a list of terms on the driver.

Spark ML's count vectors keep their vocabulary on the driver and send it to every task. Here the
vocabulary is a table, the term index; a document's (index, weight) pairs come from a join with it and are
gathered into sparse arrays by document. The join is a broadcast while the index is small (``join_on_key``);
beyond that it is a shuffle, with the terms that fill the corpus apart.
"""

from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quillmark.functions.scoring import idf_ml
from quillmark.functions.tokenizers import NOT_EMPTY
from quillmark.operators.counts import term_frequency, term_statistics
from quillmark.operators.joins import BROADCAST_BYTES, join_on_key
from quillmark.plans.tfidf import Idf, TermModel, fit
from quillmark.sources.staging import stage, staging_path


@dataclass(frozen=True)
class TermIndex:
    """Terms numbered from 0 by corpus count and then by term: ``(term, index, df, weight)``, staged.

    ``size`` is the number of terms, which is the length of a vector; ``n_bytes`` bounds the table's size.
    """

    size: int
    table: DataFrame
    n_bytes: int


def index_terms(model: TermModel, formula: Idf = idf_ml) -> TermIndex:
    """The term index of a fitted vocabulary."""
    weight = formula(F.lit(model.n_docs), F.col("df"))
    table = stage(
        model.ranked().select("term", (F.col("rank") - 1).cast("int").alias("index"), "df", weight.alias("weight")), "term-index"
    )
    return TermIndex(model.n_terms, table, model.n_bytes)


def document_vectors(counts: DataFrame, keys: list[str], index: TermIndex, budget: int = BROADCAST_BYTES) -> DataFrame:
    """``(keys, size, indices, values)`` of each document, weights being tf times the index's weight.

    ``counts`` are ``document_terms``: their null-term rows give documents without a known term their empty
    vector. Rows with equal keys are one document. What is shuffled is an int and a double a term.
    """
    # A term that the index lacks is in few documents, or it would be in the index; df is the others' frequency.
    met = join_on_key(counts, index.table, "term", "left", frequency="df", size=index.n_bytes, budget=budget)
    entry = F.struct("index", (F.col("tf") * F.col("weight")).alias("value"))
    known = met.where("index IS NOT NULL OR term IS NULL").select(*keys, F.when(F.col("index").isNotNull(), entry).alias("entry"))
    gathered = known.groupBy(*keys).agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return gathered.select(*keys, F.lit(index.size).alias("size"), F.col("entries.index").alias("indices"),
                           F.col("entries.value").alias("values"))


def as_ml_vectors(parts: DataFrame, vector: str = "tfidf") -> DataFrame:
    """``parts`` with one column of Spark ML sparse vectors in place of size, indices and values, staged.

    A vector is stored as the struct that it is, so the table is written as structs and read as vectors; no
    row passes through Python.
    """
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), "size", "indices", "values").alias(vector)
    rest = parts.drop("size", "indices", "values")
    path = staging_path(parts.sparkSession, "vectors")
    parts.select(*rest.columns, stored).write.parquet(path)
    schema = StructType([*rest.schema.fields, StructField(vector, VectorUDT())])
    return parts.sparkSession.read.schema(schema).parquet(path)


def vector_parts(vectors: DataFrame, keys: list[str], vector: str = "tfidf") -> DataFrame:
    """Sparse vectors as ``(keys, size, indices, values)``."""
    parts = vectors.select(*keys, F.unwrap_udt(vector).alias("_v"))
    return parts.select(*keys, F.col("_v.size").alias("size"), F.col("_v.indices").alias("indices"),
                        F.col("_v.values").alias("values"))


def vector_rows(parts: DataFrame, keys: list[str], index: TermIndex, value: str = "tfidf",
                budget: int = BROADCAST_BYTES) -> DataFrame:
    """Entries of ``(keys, size, indices, values)`` as ``(keys, term, <value>)``; nothing is made dense."""
    entries = parts.select(*keys, F.inline(F.arrays_zip(F.col("indices").alias("index"), F.col("values").alias(value))))
    terms = index.table.select("index", "term", "df")
    return join_on_key(entries, terms, "index", frequency="df", size=index.n_bytes, budget=budget).select(*keys, "term", value)


class _TermVectorizerParams(Params):
    tokensCol = Param(Params._dummy(), "tokensCol", "array of tokens of a document", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "column of sparse vectors", TypeConverters.toString)
    keyCols = Param(Params._dummy(), "keyCols", "columns that identify a document", TypeConverters.toListString)
    minDF = Param(Params._dummy(), "minDF", "documents that a term has to be in", TypeConverters.toInt)
    vocabSize = Param(Params._dummy(), "vocabSize", "most terms of the vocabulary", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(tokensCol="tokens", outputCol="tfidf", minDF=1, vocabSize=1 << 18)

    def _counts(self, docs: DataFrame, keys: list[str]) -> DataFrame:
        """Each use reads the counts once, so they are not staged."""
        return term_frequency(docs, keys, F.col(self.getOrDefault(self.tokensCol)), keep=NOT_EMPTY, document_rows=True)


class TermVectorizer(Estimator, _TermVectorizerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a term index to arrays of tokens: IDF ``ln((N + 1) / (df + 1))``, terms of ``minDF`` documents or more."""

    def __init__(self, keyCols: list[str] | None = None, tokensCol: str = "tokens", outputCol: str = "tfidf", minDF: int = 1,
                 vocabSize: int = 1 << 18) -> None:
        super().__init__()
        self._set(tokensCol=tokensCol, outputCol=outputCol, minDF=minDF, vocabSize=vocabSize, keyCols=keyCols or [])

    def _fit(self, dataset: DataFrame) -> "TermVectorizerModel":
        statistics = term_statistics(self._counts(dataset, []))
        index = index_terms(fit(statistics, self.getOrDefault(self.minDF), self.getOrDefault(self.vocabSize)))
        return self._copyValues(TermVectorizerModel(index))


class _ModelWriter(MLWriter):
    def __init__(self, model: "TermVectorizerModel") -> None:
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        index = self._model.index
        DefaultParamsWriter.saveMetadata(self._model, path, self.sparkSession, {"size": index.size, "nBytes": index.n_bytes})
        index.table.write.parquet(f"{path}/terms")


class _ModelReader(MLReader):
    def load(self, path: str) -> "TermVectorizerModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        table = self.sparkSession.read.parquet(f"{path}/terms")
        model = TermVectorizerModel(TermIndex(metadata["size"], table, metadata["nBytes"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TermVectorizerModel(Model, _TermVectorizerParams, MLReadable, MLWritable):
    """A term index that turns documents into vectors; saved with its table, and loaded, as part of a pipeline too.

    The result has the key columns and the vectors: a document's other columns are joined back by the caller.
    """

    def __init__(self, index: TermIndex | None = None) -> None:
        super().__init__()
        self.index = index

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keys = self.getOrDefault(self.keyCols)
        parts = document_vectors(self._counts(dataset, keys), keys, self.index)
        return as_ml_vectors(parts, self.getOrDefault(self.outputCol))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()
