"""Settings and monitoring."""

from types import SimpleNamespace

import pytest

from tidebook.config import from_env
from tidebook.streaming.monitor import Monitor


def test_environment_wins(tmp_path):
    (tmp_path / ".env").write_text("# a comment\nMAX_MARKETS=5\nDATA_DIR='x'\nCOLLECT_SPORTS=no\n\nPORT=\nCLOB_BASE_URL=http://b/\n")
    c = from_env(tmp_path / ".env", {"MAX_MARKETS": "7"})
    assert (c.max_markets, c.data_dir, c.collect_sports, c.health_port, c.clob_base_url, c.stale_after_seconds) == (7, "x", False, 8080, "http://b", 180)
    assert from_env(tmp_path / "none", {"PORT": "81"}).health_port == 81 and from_env(None, {"ENV_FILE": str(tmp_path / ".env"), "HEALTH_PORT": "82", "PORT": "81"}).health_port == 82
    assert from_env(tmp_path / "none", {}).max_markets == 75


@pytest.mark.parametrize("name, value", [("MAX_MARKETS", "0"), ("MAX_FILE_MIB", "x"), ("COLLECT_RTDS_CRYPTO", "maybe"), ("ROTATION_SECONDS", "59"), ("STALE_AFTER_SECONDS", "29")])
def test_wrong_values(tmp_path, name, value):
    with pytest.raises(ValueError):
        from_env(tmp_path / "none", {name: value})


def test_monitor():
    m = Monitor(stale_after_seconds=10)
    assert m.state()["reason"] == "no query is running"
    m.onQueryStarted(None)
    assert m.state()["healthy"] and m.state(m.started + 11)["reason"] == "no rows yet"
    m.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(numInputRows=4)))
    assert m.state()["rows"] == 4 and m.state(m.last_rows_at + 11)["reason"] == "no recent rows"
    m.onQueryTerminated(SimpleNamespace(exception="x"))
    assert "tidebook_failures 1\n" in m.prometheus()
