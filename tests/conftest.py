import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arrivo.session import local_session, use_local_checkpoints  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    use_local_checkpoints(s)
    yield s


SF_SMALL = "/root/testdata/sf0.001"


def exchanges(df):
    """The columns that each exchange of a plan moves."""
    text = df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [block.split("Input", 1)[1].split("\n", 1)[0] for block in text.split("\n\n")
            if ") Exchange\n" in block and "Input" in block]
