"""Tables written between two jobs.

A staged table cuts lineage: a lost executor costs the tasks that read it, never the shuffle
that made it. The caller names the shared folder; each job has a folder of its own below it,
and what it staged goes when the job ends.
"""

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_job: ContextVar[str | None] = ContextVar("job", default=None)


def staging_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, or the context's checkpoint folder."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    return named.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/quillmark-{spark.sparkContext.applicationId}"


def _staged_folder(spark: SparkSession) -> str:
    return f"{_application_folder(spark)}/staged"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """What is staged inside the block goes at its end, so results have to be written or read inside."""
    folder = f"{_staged_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _job.set(folder)
    try:
        yield folder
    finally:
        _job.reset(token)
        _delete(spark, folder)


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for a table that the job stages."""
    return f"{_job.get() or _staged_folder(spark)}/{name}-{uuid.uuid4().hex}"


def output_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for what a sink or a stream writes; it outlasts the job."""
    return f"{_application_folder(spark)}/written/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write ``df``. The shuffle files go with the write, and not when the driver happens to collect garbage:
    nothing reads them again, because a reader of the written table has no other lineage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def _read(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the staging folder and return the written table."""
    path = staging_path(df.sparkSession, name)
    _write(df, path)
    return _read(df, path)


def restage(df: DataFrame, name: str, before: str | None = None) -> tuple[DataFrame, str]:
    """Stage the next version of a table and delete the folder of the one ``before``; the table and its folder."""
    path = staging_path(df.sparkSession, name)
    _write(df, path)
    if before:
        _delete(df.sparkSession, before)
    return _read(df, path), path


def stage_each(spark: SparkSession, parts: Iterable[DataFrame], name: str) -> DataFrame:
    """One staged table of the rows of all ``parts``, which have the same columns and are made and written one by one."""
    path, part = staging_path(spark, name), None
    for part in parts:
        _write(part, path, "append")
    if part is None:
        raise ValueError("no parts to stage")
    return _read(part, path)


def unstage(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that ``restage`` named, once nothing reads their tables any more."""
    for folder in folders:
        _delete(spark, folder)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged outside of jobs, and nothing that it wrote otherwise."""
    _delete(spark, _staged_folder(spark))
