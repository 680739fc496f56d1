import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])  # for the Python workers
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_rows import CLASHES, EDGE_ROWS  # noqa: E402


@pytest.fixture(scope="session")
def edge_docs(spark):
    from pyspark.sql import functions as F

    rows = [(i, t, lang, "src", len(t or "")) for i, t, lang in EDGE_ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.lit(7).alias(c) for c in CLASHES]).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
