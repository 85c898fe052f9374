import sys
import tempfile

import pytest

from paths import ROOT

sys.path.insert(0, ROOT)

from loamline.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="loamline-tests-")
    yield get_spark(app="loamline-tests", master="local[*]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": shared})


@pytest.fixture
def scratch(spark, tmp_path):
    return str(tmp_path)
