import json
import time

import pytest

from tests.test_engine import WALL, gap, tick, trade
from tidemark import cli
from tidemark.operators.ingest import Compactor
from tidemark.operators.reader import Reader
from tidemark.sources.raw import raw_lines
from tidemark.sources.socket import Recorder, feed_source, reconnect_wait_s, rows_of
from tidemark.streaming import ingest as S

FEED = [(1, WALL, None), (2, WALL + 1, "a"), (3, WALL + 2, None), (4, WALL + 3, None), (5, WALL + 3_600_000_000_000, "b")]


def test_markers():
    rows = list(rows_of(iter(FEED)))
    assert [r[2] or r[3] for r in rows] == ["a", "gap", "b"]
    assert rows[1][4:] == (3, WALL + 2, 5, WALL + 3_600_000_000_000)
    assert [reconnect_wait_s(i) for i in (0, 3, 9)] == [0.5, 4.0, 30.0]


def test_markers_do_not_depend_on_batches():
    from tidemark.sources.socket import _FeedReader

    feed = [(1, WALL, "a"), (2, WALL + 1, None), (3, WALL + 2, None), (4, WALL + 9, "b"), (5, WALL + 10, None), (6, WALL + 11, True), (7, WALL + 12, "c")]
    whole = list(rows_of(iter(feed)))
    assert [r[2] or r[3:] for r in whole] == ["a", ("gap", 2, WALL + 1, 4, WALL + 9), "b", ("gap", 5, WALL + 10, 6, WALL + 11), "c"]
    for cuts in range(1 << (len(feed) - 1)):  # every way to cut the feed into batches
        offset, rows, again = _FeedReader(None).initialOffset(), [], []
        ends = [i + 1 for i in range(len(feed) - 1) if cuts >> i & 1] + [len(feed)]
        for end in ends:
            reader = _FeedReader(lambda at, end=end: iter(feed[at:end]))
            got, after = reader.read(offset)
            rows += list(got)
            after = json.loads(json.dumps(after))  # as a checkpoint keeps it
            again += list(_FeedReader(lambda at: iter(feed[at:])).readBetweenOffsets(offset, after))
            offset = after
        assert rows == whole == again


def test_recorder_survives_outages():
    """The connection breaks, two attempts fail, messages resume: one marker with a sensible window, messages on both sides."""
    clock = iter(range(1, 10_000))
    waits = []

    def session(n):
        def run(subscription):
            assert json.loads(subscription)["params"]["channels"] == ["trade"]
            if n in (1, 2, 5):
                raise ConnectionError("no network")
            return messages(n)

        return run

    def messages(n):
        yield from (f"m{n}-{i}" for i in range(3))
        if n == 0:
            raise ConnectionError("lost")
        yield b"bytes"

    attempts = iter(range(100))
    recorder = Recorder(lambda s: session(next(attempts))(s), ["trade"], clock=lambda: (t := next(clock), WALL + t * 10**9), sleep=lambda s: waits.append(s) or (len(waits) >= 6 and setattr(recorder, "stopped", True)), jitter=lambda: 0.0)
    recorder.run()
    rows = list(rows_of(recorder(0)))
    gaps, texts = [r for r in rows if r[3] == "gap"], [r for r in rows if r[2]]
    assert all(r[5] < r[7] for r in gaps) and len(gaps) == 2
    assert any(r[1] < gaps[0][5] for r in texts) and any(r[1] > gaps[0][7] for r in texts)
    assert waits[:3] == [0.5, 1.0, 2.0] and waits[3] == 0.5  # a good connection resets the waits
    assert recorder.stats.reconnects == 3 and recorder.stats.messages == len(texts) == 11 and recorder.stats.dropped == 0 and recorder.stats.bytes > 40


def test_recorder_counts_what_it_drops():
    recorder = Recorder(lambda s: iter([f"m{i}" for i in range(10)]), [], most_held=5, sleep=lambda s: setattr(recorder, "stopped", True))
    recorder.run()
    assert recorder.stats.dropped == 6 and [e[2] for e in recorder(0)] == [True, "m0", "m1", "m2", "m3", None]
    recorder.commit(3)
    assert [e[2] for e in recorder(3)] == ["m2", "m3", None]
    with pytest.raises(ValueError):
        recorder(1)


def test_recorder_streams(spark, tmp_path):
    def connect(subscription):
        yield from ('{"type":"x"}', '{"type":"y"}')
        time.sleep(60)

    spark.dataSource.register(feed_source(Recorder(connect, ["trade"])))
    query = S.write_raw(spark.readStream.format("tick_feed").load(), str(tmp_path / "raw"), str(tmp_path / "check"), processingTime="1 second")
    for _ in range(60):
        if (tmp_path / "raw").exists() and list((tmp_path / "raw").glob("*/*.gz")):
            break
        time.sleep(0.5)
    query.stop()
    lines = raw_lines(spark, str(tmp_path / "raw")).collect()
    assert [json.loads(r.line)["raw"] for r in sorted(lines, key=lambda r: r.line_number)] == ['{"type":"x"}', '{"type":"y"}']


def test_record_command(spark, tmp_path, capsys, monkeypatch):
    def connect(subscription):
        yield from ('{"type":"x"}', '{"type":"y"}')
        time.sleep(60)

    for name, value in {"DATA_DIR": str(tmp_path), "KEY_ID": "k", "KEY_FILE": "f", "MIN_FREE_GB": "0.001"}.items():
        monkeypatch.setenv(f"TIDEMARK_{name}", value)
    monkeypatch.setattr(cli, "websocket", lambda url, headers, path: connect)
    monkeypatch.setattr(cli.guards, "memory_check", lambda: lambda: None)
    assert cli.main(["record", "wss://feed.example/ws", "--seconds", "12", "--report-every", "3"]) == 0
    said = capsys.readouterr().out
    assert "stopped: the time is up" in said and "GB/h" in said
    assert sorted(json.loads(r.line)["raw"] for r in raw_lines(spark, str(tmp_path / "raw")).collect()) == ['{"type":"x"}', '{"type":"y"}']


def test_feed_lands_by_hour(spark, tmp_path):
    """Landed files are what compaction reads: messages, and the marker in the hour of the outage's end."""
    feed = [(1, WALL, None), (2, WALL + 1, json.dumps({"type": "subscribed", "id": 1, "msg": {"channel": "c", "sid": 2}})), (3, WALL + 2, None), (5, WALL + 3_600_000_000_000, "{bad")]
    spark.dataSource.register(feed_source(lambda at: iter(feed[at:])))
    messages = spark.readStream.format("tick_feed").load()
    query = S.write_raw(messages, str(tmp_path / "raw"), str(tmp_path / "check"), processingTime="1 second")
    query.processAllAvailable()
    query.stop()
    assert sorted(str(p.relative_to(tmp_path / "raw")) for p in (tmp_path / "raw").glob("*/*.gz")) == ["2024-01-01/00-00000000.ndjson.gz", "2024-01-01/01-00000000.ndjson.gz"]
    result = Compactor(spark, str(tmp_path / "raw"), str(tmp_path / "out")).run()
    assert result.reconciled and result.summary["total_lines"] == 3 and result.summary["rejects"] == 1
    assert {r.part for r in Reader(spark, str(tmp_path / "out")).table("gap").collect()} == {"01-00000000"}
    assert Reader(spark, str(tmp_path / "out")).coverage(WALL, WALL + 5).has_gaps


def test_files_are_ingested_once(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.ndjson").write_text("\n".join(json.dumps(x) for x in [trade(1), tick(2), gap(1, 2)]) + "\n{bad\n")
    for _ in range(2):
        S.ingest(spark, str(raw), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/type=trade")).count() == 1
    assert spark.read.json(str(tmp_path / "out/stream_rejects")).count() == 1
    (raw / "b.ndjson").write_text(json.dumps(trade(5)) + "\n")
    S.ingest(spark, str(raw), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/type=trade")).count() == 2


def test_files_that_grew_are_stored_anew(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    for name, ids in (("a", (1, 2)), ("b", (3,))):
        (raw / f"{name}.ndjson").write_text("".join(json.dumps(trade(i)) + "\n" for i in ids))
    S.ingest(spark, str(raw), out, str(tmp_path / "check")).awaitTermination()
    assert S.changed_files(spark, str(raw), out).count() == 0 and S.reingest(spark, str(raw), out, "1") == 0
    with (raw / "a.ndjson").open("a") as f:
        f.write(json.dumps(trade(4)) + "\n{bad\n")
    S.ingest(spark, str(raw), out, str(tmp_path / "check")).awaitTermination()  # a stream reads a file once
    assert S.reingest(spark, str(raw), out, "2") == 1 and S.reingest(spark, str(raw), out, "3") == 0
    assert sorted(r.seq for r in Reader(spark, out).table("trade").collect()) == [1, 2, 3, 4]
    assert spark.read.json(f"{out}/stream_rejects").count() == 1


def test_prefix_filter_keeps_control_messages(spark):
    rows = spark.createDataFrame([('{"msg":{"market_ticker":"AB-1"}}',), ('{"msg":{"market_ticker":"X"}}',), ('{"type":"ok"}',), (None,)], "raw string")
    assert S.wanted(rows, ["AB"]).count() == 3 and S.wanted(rows, []).count() == 4


def test_first_copies(spark, tmp_path):
    rows = spark.createDataFrame([("a", WALL, 100), ("a", WALL + 1, 100), ("b", WALL, 100)], "trade_id string, ts_wall long, count_fp long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = S.first_copies(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("first_copies").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("first_copies").count() == 2
