import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tidewire import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


ARTICLE = (
    "event_id string, source string, event_type string, event_ts timestamp_ntz, title string, "
    "content string, description string, url string, source_name string, language string, published string"
)


@pytest.fixture(scope="session")
def make_articles(spark):
    """Articles from dicts; what is left out is null."""
    import datetime

    names = [part.strip().split()[0] for part in ARTICLE.split(",")]

    def make(*rows):
        out = []
        for i, row in enumerate(rows):
            base = {
                "event_id": str(i), "source": "test", "event_type": "news_article",
                "event_ts": datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i),
            }
            base.update(row)
            out.append(tuple(base.get(n) for n in names))
        return spark.createDataFrame(out, ARTICLE)

    return make
