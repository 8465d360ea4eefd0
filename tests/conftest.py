import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(memory="5g")  # other tests start a second driver beside it
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture(scope="session")
def column(spark):
    """Values of an expression over a one-column frame of strings named c."""

    def run(values, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, c string")
        return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]

    return run
