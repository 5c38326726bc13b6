import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("quillmark-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.quillmark.partitions", "8")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.01")


@pytest.fixture(scope="session")
def tiny_dir():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def corpus(spark):
    """Three small documents with results worked out by hand."""
    texts = ["The cat, the Dog\nÉTÉ café a", "the dog_1 don't sit", "Cat cat the"]
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
