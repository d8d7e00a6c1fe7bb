import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the session's defaults when set there;
    # build_session picks a local folder only when it is unset.
    from eventlens.session import build_session
    s = build_session("local[*]", app_name="eventlens-tests", shuffle_partitions=8,
                      extra={"spark.sql.maxMetadataStringLength": "100000"})  # uncut plan text
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="eventlens-test-")
