import json

import pytest

from tests.test_engine import WALL, trade, write_raw
from tidemark import cli, config
from tidemark.operators.state import StateStore
from tidemark.streaming import guards


def test_config():
    env = {"TIDEMARK_DATA_DIR": "/d", "TIDEMARK_KEY_ID": "k", "TIDEMARK_KEY_FILE": "f"}
    c = config.load(env)
    assert c.channels == ("ticker", "trade") and c.raw_dir == "/d/raw"
    assert config.load(env | {"TIDEMARK_PREFIXES": "A, B"}).prefixes == ("A", "B")
    for bad in ({}, env | {"TIDEMARK_MIN_FREE_GB": "x"}):
        with pytest.raises(config.ConfigError):
            config.load(bad)


def test_state_versions(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    assert store.count_markets() == 0 and store.requests_s() == (12.0, False)
    store.seed(spark.createDataFrame([("A-1", 5)], "ticker string, volume_fp long"))
    store.record_page("A-1", "c1", 10, False)
    store.record_page("A-1", None, 5, True)
    row = store.get("A-1")
    assert (row["status"], row["trades"], row["cursor"]) == ("complete", 15, None) and store.get("x") is None
    for i in range(4):
        store.set_meta("requests_s", str(i + 0.5))
    assert store.requests_s() == (3.5, True) and len(store._versions("meta")) <= 4
    store.set_discovery("all", "c", 2, False)
    store.set_discovery("all", None, 3, True)
    assert store.discovery("all")["done"] and store.table("discovery").count() == 1


def test_command_line(spark, tmp_path, capsys):
    write_raw(tmp_path / "raw", "2024-01-01", "00", [json.dumps(trade(i)) for i in range(4)])
    assert cli.main(["compact", str(tmp_path), "completed", "--dry-run"]) == 0
    assert cli.main(["compact", str(tmp_path), "completed"]) == 0
    assert cli.main(["retain", str(tmp_path)]) == 0
    said = capsys.readouterr().out
    assert "1 files" in said and "4 lines, 0 refused" in said and "would delete" in said
    assert (tmp_path / "raw/2024-01-01/00.ndjson.zst").exists()
    assert cli.main(["retain", str(tmp_path), "--delete"]) == 0
    assert not (tmp_path / "raw/2024-01-01/00.ndjson.zst").exists()
    assert cli.main(["space", str(tmp_path), "0"]) == 0 and cli.main(["space", str(tmp_path), "1e9"]) == 1
    assert WALL


def test_guards(tmp_path):
    assert guards.disk_check(str(tmp_path), 0)() is None and guards.disk_check(str(tmp_path), 1e9)()
    assert guards.memory_check(1e9)() is None and guards.memory_check(0)()
    assert guards.hours_left(10, 5, 2.5) == 2 and guards.hours_left(10, 5, 0) is None


def test_throughput_projects_the_disk(monkeypatch):
    free, now = iter([100.0] + [99.0] * 9), [0.0]
    monkeypatch.setattr(guards, "free_gb", lambda path: next(free))
    seen = guards.Throughput(path="/", margin_gb=9.0, clock=lambda: now[0])
    now[0] = 1800.0  # half an hour: 2 GB an hour
    assert seen.hours_left == 45.0 and "2.000 GB/h, space for 45.0 h" in seen.report()
    assert guards.Throughput().hours_left is None and "any time" in guards.Throughput().report()
