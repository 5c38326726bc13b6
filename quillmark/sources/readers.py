"""Batch scans of corpora and of tab-separated records."""

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.sources.staging import stage_each


def spread(df: DataFrame, partitions: int = 0) -> DataFrame:
    """Deal the rows out over ``partitions`` tasks if the caller asks for a number of them.

    Only a caller knows that an input is small: a file with one row group keeps all but one
    core idle. Without a number the scan is left alone, and its text is not shuffled.
    """
    return df.repartition(partitions) if partitions > 0 else df


def read_table(spark: SparkSession, path: str, columns: list[str], partitions: int = 0) -> DataFrame:
    """Scan the named columns of a Parquet corpus table."""
    return spread(spark.read.parquet(path).select(*columns), partitions)


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Tasks for each core that list folders.
LISTING_TASKS = 8


@contextmanager
def short_listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core. Spark's default is a task a folder, up to 10,000, and starting them is dearer
    than what they list. Streams list as they run, so they have to end inside."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


_OPENING = "spark.sql.files.openCostInBytes"
# What opening a file counts for when small files are dealt to tasks.
OPENING_BYTES = 64 << 10


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """``short_listing`` for jobs that also read their files inside: a task takes some hundreds of small files.

    Spark reckons four megabytes for opening a file, so a task gets a few files only, and starting tasks is dearer than
    reading the files.
    """
    before = spark.conf.get(_OPENING)
    spark.conf.set(_OPENING, str(min(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before), OPENING_BYTES)))
    try:
        with short_listing(spark):
            yield
    finally:
        spark.conf.set(_OPENING, before)


def _visible(name: str) -> bool:
    """Whether a scan looks at a file or folder of this name."""
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def _literal(path: str) -> str:
    """A path that is no pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def by_folder(spark: SparkSession, path: str, read: Callable[[SparkSession, str | list[str], bool], DataFrame], name: str) -> DataFrame:
    """What ``read`` (``read_lines`` or ``read_whole_files``) gives of ``path`` and all below it, staged folder by folder.

    A scan keeps the list of its files on the driver. Here it is the list of one sub-folder of ``path`` at a time. A
    folder with at most one sub-folder is read as it is, and nothing is staged.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    inside = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    inside = [(_literal(f.getPath().toString()), f.isDirectory()) for f in inside if _visible(f.getPath().getName())]
    folders = sorted(below for below, is_folder in inside if is_folder)
    files = sorted(below for below, is_folder in inside if not is_folder)
    if len(folders) < 2:
        return read(spark, path, True)
    with small_files(spark):
        return stage_each(spark, (read(spark, part, True) for part in [*folders, *([files] if files else [])]), name)


def read_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """One row per line, ``(path, line)``; long files are split over tasks."""
    with short_listing(spark):
        lines = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def read_whole_files(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """One row per file, ``(path, text)``."""
    with short_listing(spark):
        files = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``, ``(path, n_bytes)`` and the columns of ``key=value`` folders.

    The listing is the scan's own, and no file is opened: of the binary source only the length is read. A scan
    leaves out files of no bytes, so an empty file is as good as none.
    """
    with short_listing(spark):
        files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("n_bytes"), *[c for c in files.columns if c not in _BINARY_COLUMNS])


_BINARY_COLUMNS = ("path", "modificationTime", "length", "content")

LINE_BREAK = "\r\n?|\n"


def text_lines(text: Column) -> Column:
    """Lines of a text held in one row, as a line scan of the same file gives them.

    A line break at the end closes the last line and starts no new one. (Empty text has no
    line, but gives one empty element here.)
    """
    return F.split(F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK)


def line_documents(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Lines as documents, keyed by ``keys`` and ``line_no`` instead of a generated id."""
    filled = docs.where(F.length(text) > 0)
    return filled.select(*keys, F.posexplode(text_lines(F.col(text))).alias("line_no", "line"))


def parse_key_values(lines: DataFrame, strict: bool = True, value: str = "value") -> DataFrame:
    """``word<TAB>int`` lines as ``(word, n)``; malformed lines are dropped.

    The strict reader needs a word and a number. The lenient one needs only the tab and
    reads a missing number as 0; in both, text after the number is ignored.
    """
    record = F.col(value)
    tab = F.instr(record, "\t")
    word = F.substring(record, F.lit(1), tab - 1)
    number = F.regexp_extract(F.substring(record, tab + 1, F.length(record)), r"^\s*([+-]?\d+)", 1)
    parsed = lines.where(tab > 0).select(word.alias("word"), number.alias("number"))
    if strict:
        parsed = parsed.where("word <> '' and number <> ''")
    return parsed.select("word", F.coalesce(F.nullif("number", F.lit("")), F.lit("0")).cast("bigint").alias("n"))
