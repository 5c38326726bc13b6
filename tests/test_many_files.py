"""Folders of more files than one list on the driver should hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quillmark.sources import readers, writers


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["file_line_documents", "file_tfidf_smooth"])
def test_a_scan_lists_one_sub_folder_at_a_time(spark, tiny_dir, monkeypatch, name):
    expected = _rows(entry.queries()[name](spark, tiny_dir))
    monkeypatch.setattr(writers, "FOLDER_FILES", 60)
    listed = []
    for read in ("read_lines", "read_whole_files"):

        def watched(*args, read=getattr(readers, read), **options):
            found = read(*args, **options)
            listed.append(len(found.inputFiles()))
            return found

        monkeypatch.setattr(readers, read, watched)
    result = entry.queries()[name](spark, tiny_dir)
    assert _rows(result) == expected
    assert sum(listed) == 200 and len(listed) == 4 and max(listed) < 100
    assert len(result.inputFiles()) < 200


def test_a_stream_has_the_files_of_one_sub_folder(spark, tiny_dir, monkeypatch):
    name, paths, costs = "stream_text_files", [], []
    expected = _rows(entry.queries()[name](spark, tiny_dir))
    monkeypatch.setattr(writers, "FOLDER_FILES", 90)
    text_file_stream = entry.messages.text_file_stream

    def watched(spark, path, **options):
        paths.append(path)
        costs.append(int(spark.conf.get(readers._OPENING)))
        return text_file_stream(spark, path, **options)

    monkeypatch.setattr(entry.messages, "text_file_stream", watched)
    before = spark.conf.get(readers._OPENING)
    assert _rows(entry.queries()[name](spark, tiny_dir)) == expected
    assert len(paths) == 6 and len(set(paths)) == 3 and max(costs) <= readers.OPENING_BYTES
    assert spark.conf.get(readers._OPENING) == before


def test_by_folder_reads_all_that_a_scan_reads(spark, tmp_path):
    for name in ("a/x.txt", "a/b/y.txt", "c/z.txt", "top.txt", ".hidden/n.txt", "_skipped/n.txt", "d=1/_n.txt", "e/empty.txt",
                 "g[1]/q.txt", "top{2}.txt", "d=1/m.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if "empty" in name else f"{name}\nline\r\n")
    path = f"file:{tmp_path}"
    for read in (readers.read_lines, readers.read_whole_files):
        assert _rows(readers.by_folder(spark, path, read, "all")) == _rows(read(spark, path, recursive=True))
        assert _rows(readers.by_folder(spark, f"{path}/a", read, "all")) == _rows(read(spark, f"{path}/a", recursive=True))


def test_a_task_takes_many_small_files(spark, tmp_path):
    writers.write_documents(spark.range(400).select("id", F.lit("a b").alias("text")), "id", f"file:{tmp_path}/docs", folders=3)
    assert sorted(p.name for p in (tmp_path / "docs").iterdir() if p.is_dir()) == ["folder=0", "folder=1", "folder=2"]
    most = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(most)
    spark.conf.set(most, "16m")
    try:
        with readers.small_files(spark):
            tasks = readers.read_lines(spark, f"file:{tmp_path}/docs", recursive=True).rdd.getNumPartitions()
    finally:
        spark.conf.set(most, before)
    assert tasks <= 2 * spark.sparkContext.defaultParallelism
