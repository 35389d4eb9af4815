import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plazalens.sources import read_posts  # noqa: E402
from tests.fixtures import POSTS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("plazalens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def posts_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("posts") / "posts.json"
    path.write_text("\n".join(json.dumps(post) for post in POSTS), encoding="utf-8")
    return str(path)


@pytest.fixture(scope="session")
def posts(spark, posts_path):
    return read_posts(spark, posts_path)


@pytest.fixture
def texts(spark):
    """A one-column DataFrame of texts."""
    return lambda *values: spark.createDataFrame([(value,) for value in values], "text string")
