import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def odd_rows(spark, tmp_path_factory):
    """The odd table as stored files: place in the input is then the same each time it is read."""
    import odd_documents

    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    odd_documents.odd(spark).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_rows(spark):
    import odd_documents

    return odd_documents.none(spark)


@pytest.fixture(scope="session")
def documents(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    return folder
