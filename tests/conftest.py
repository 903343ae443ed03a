import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pitpanel.session import build_session, checkpoint_dir
    s = build_session("local[*]", app="pitpanel-tests", shuffle_partitions=8,
                      conf={"spark.sql.adaptive.enabled": "true"})
    checkpoint_dir(s)   # unset in tests -> a private folder is registered
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="pitpanel-test-", dir="/tmp")


@pytest.fixture(autouse=True)
def reports_only_where_asked_for(request, monkeypatch):
    """Ingestion writes daily reports in tests marked ``reports`` and for the query that reads them back; the
    others are about other things, and a report takes longer than the runs of a test."""
    query = getattr(request.node, "callspec", None) and request.node.callspec.params.get("name")
    if "reports" not in request.keywords and query != "intake_reports":
        monkeypatch.setattr("pitpanel.streaming.intake.write_daily_reports", lambda *args: None)


def pytest_configure(config):
    config.addinivalue_line("markers", "reports: ingestion writes the daily reports")
