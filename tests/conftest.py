"""One local Spark session for the whole test run (checkpoint dir set only because none is configured)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opinio.session import build_session, checkpoint_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(master="local[4]", shuffle_partitions=8, app="opinio-tests",
                      scratch=str(tmp_path_factory.mktemp("scratch")))
    checkpoint_root(s)
    yield s
    s.stop()
