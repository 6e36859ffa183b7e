import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from profilematch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    """The hand-checked four documents."""
    rows = [(0, "java spring cloud"), (1, "java python data"), (2, "python data ai"), (3, "java java cloud")]
    from profilematch.functions.text import tokens_ws

    return spark.createDataFrame(rows, "id long, t string").withColumn("tokens", tokens_ws("t"))


@pytest.fixture(scope="session")
def indexes(corpus):
    from profilematch import fit_index

    return {m: fit_index(corpus, "id", "tokens", f) for m, f in (("A", "log2"), ("B", "smooth"))}
