import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from deposit_analytics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    session = build_session("tests", "local[4]", 4, **settings)
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    yield session
    session.stop()
