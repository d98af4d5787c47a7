import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from phenolens.session import local_session  # noqa: E402

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=8)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from texts (id, text), with columns whose names an operator might use itself."""
    def make(rows, schema="doc_id long, text string"):
        df = spark.createDataFrame(rows, schema)
        names = ("tokens", "id", "bitmap", "kept", "score", "length", "start", "component")
        from pyspark.sql import functions as F
        return df.withColumns({n: F.lit("clash") for n in names})
    return make
