"""The live feed as a streaming source: messages with their clocks, and a gap marker after every outage."""

from __future__ import annotations

import json
import random
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

SCHEMA = "ts_ns long, ts_wall long, raw string, marker string, gap_start_ns long, gap_start_wall long, gap_end_ns long, gap_end_wall long"
#: Waits between connections double from the first to the longest, with up to `JITTER_S` more.
FIRST_WAIT_S, LONGEST_WAIT_S, JITTER_S = 0.5, 30.0, 1.0
#: Messages that are held until they are read; more are dropped and counted.
MOST_HELD = 100_000
#: In place of a text: the connection was lost, or (again) made.
LOST, MADE = None, True

#: What happened from an offset on: (ts_ns, ts_wall, text or LOST or MADE).
Event = tuple[int, int, "str | bool | None"]
Feed = Callable[[int], Iterator[Event]]


def reconnect_wait_s(attempt: int, jitter: Callable[[], float] = lambda: 0.0) -> float:
    return min(LONGEST_WAIT_S, FIRST_WAIT_S * 2**attempt) + JITTER_S * jitter()


def subscribe_text(channels: list[str], request_id: int = 1) -> str:
    return json.dumps({"id": request_id, "cmd": "subscribe", "params": {"channels": channels}})


def stamp() -> tuple[int, int]:
    return time.monotonic_ns(), time.time_ns()


@dataclass
class Outage:
    """What must be known across batches to see outages: whether there was a connection or message yet, and since when it is lost."""

    seen: bool = False
    lost: tuple[int, int] | None = None

    def rows_of(self, events: Iterator[Event]) -> Iterator[tuple]:
        """Rows of `SCHEMA`: an outage becomes one marker when the connection is made again, or else with the first message after it; none before the first connection."""
        for ns, wall, text in events:
            if text is LOST:
                self.lost = self.lost or ((ns, wall) if self.seen else None)
                continue
            if self.lost:
                yield (ns, wall, None, "gap", *self.lost, ns, wall)
                self.lost = None
            self.seen = True
            if text is not MADE:
                yield (ns, wall, text, None, None, None, None, None)


def rows_of(events: Iterator[Event]) -> Iterator[tuple]:
    """Rows of a feed that is read from its start in one go."""
    return Outage().rows_of(events)


class _FeedReader(SimpleDataSourceStreamReader):
    """Offsets say how many events were read, and what is known of outages there: a marker doesn't depend on where batches end."""

    def __init__(self, feed: Feed):
        self.feed = feed

    def initialOffset(self) -> dict:
        return {"at": 0, "seen": False, "lost": None}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        events = list(self.feed(start["at"]))
        state = self._state(start)
        rows = list(state.rows_of(iter(events)))
        return iter(rows), {"at": start["at"] + len(events), "seen": state.seen, "lost": list(state.lost) if state.lost else None}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self._state(start).rows_of(islice(self.feed(start["at"]), end["at"] - start["at"]))

    def commit(self, end: dict) -> None:
        if hasattr(self.feed, "commit"):
            self.feed.commit(end["at"])

    @staticmethod
    def _state(offset: dict) -> Outage:
        return Outage(offset["seen"], tuple(offset["lost"]) if offset["lost"] else None)


def feed_source(feed: Feed) -> type[DataSource]:
    """A streaming data source `tick_feed` over a feed that can be read again from an offset."""

    class Ticks(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tick_feed"

        def schema(self) -> str:
            return SCHEMA

        def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
            return _FeedReader(feed)

    return Ticks


@dataclass
class FeedStats:
    messages: int = 0
    bytes: int = 0
    dropped: int = 0
    reconnects: int = 0


class Recorder:
    """A feed over a connection that may break.

    `connect` gets the subscription text and returns the messages of a new connection (texts or bytes); it raises if there is none,
    and its messages end or raise when the connection breaks. A thread keeps connecting, with growing waits that a good
    connection resets, and holds what came until it is committed, at most `most_held` events: beyond that messages are dropped and counted,
    but never the marks of outages. The thread starts with the first read, in the process that reads."""

    def __init__(self, connect: Callable[[str], Iterator[str | bytes]], channels: list[str], most_held: int = MOST_HELD, clock: Callable[[], tuple[int, int]] = stamp, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random):
        self.connect, self.channels, self.most_held, self.clock, self.sleep, self.jitter = connect, channels, most_held, clock, sleep, jitter
        self.stats = FeedStats()
        self.held: deque[Event] = deque()
        self.first = 0  # the offset of the first event that is held
        self.stopped = False
        self._thread: threading.Thread | None = None
        self._lock: threading.Lock | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_thread": None, "_lock": None}

    def _add(self, text: str | bool | None) -> None:
        event = (*self.clock(), text)
        with self._guard():
            if isinstance(text, str):
                self.stats.messages += 1
                self.stats.bytes += len(text.encode())
                if len(self.held) >= self.most_held:
                    self.stats.dropped += 1
                    return
            self.held.append(event)

    def _guard(self) -> threading.Lock:
        self._lock = self._lock or threading.Lock()
        return self._lock

    def run(self) -> None:
        """Connect, receive, and connect again, until stopped."""
        attempt, connected = 0, False
        while not self.stopped:
            lost = False
            try:
                messages = self.connect(subscribe_text(self.channels))
                self._add(MADE)
                attempt, connected, lost = 0, True, True
                for message in messages:
                    self._add(message if isinstance(message, str) else message.decode())
                    if self.stopped:
                        return
            except Exception:  # whatever breaks a connection, the next one is tried
                pass
            if lost and connected:
                self._add(LOST)
                self.stats.reconnects += 1
            if not self.stopped:
                self.sleep(reconnect_wait_s(attempt, self.jitter))
                attempt += 1

    def start(self) -> None:
        if self._thread is None:
            self._guard()
            self._thread = threading.Thread(target=self.run, daemon=True)
            self._thread.start()

    def stop(self) -> None:
        """Receive no more; what is held can still be read."""
        self.stopped = True
        if self._thread is not None:
            self._thread.join(timeout=10)

    def __call__(self, at: int) -> Iterator[Event]:
        if not self.stopped:
            self.start()
        with self._guard():
            if at < self.first:
                raise ValueError(f"events before {self.first} were committed and are gone; {at} is asked for")
            return iter(list(islice(self.held, at - self.first, None)))

    def commit(self, at: int) -> None:
        with self._guard():
            while self.first < at and self.held:
                self.held.popleft()
                self.first += 1


def websocket(url: str, headers: Callable[[str, str], dict[str, str]], path: str) -> Callable[[str], Iterator[str | bytes]]:
    """Connections of a web socket, for `Recorder`, where the `websockets` library is there; `headers` signs each of them."""

    def connect(subscription: str) -> Iterator[str | bytes]:
        from websockets.sync.client import connect as open_socket

        socket = open_socket(url, additional_headers=headers("GET", path), max_size=None, ping_interval=20, ping_timeout=20, close_timeout=5)
        socket.send(subscription)
        return iter(socket)

    return connect
