"""Substring dedup (2): repeated windows of words, found by anchors on a difference cover.

`COVER` is a difference cover modulo `PERIOD`: for any two positions some shift below the period takes both to
cover positions. So two equal windows of `WINDOW` words share an equal anchor of `ANCHOR` = WINDOW - PERIOD + 1 words
that starts at a cover position in either, and only 3 of 7 positions are hashed.

1. Anchors: those in two documents or more are found by a packed shuffle.
2. Extension: windows around such anchors, and no others, are hashed whole (128 bits); a second packed shuffle
   finds for each the smallest document id in which it starts.
3. Words covered by a window that starts in a document with a smaller id go.

What all documents of a map block can settle among themselves never leaves the block: a window that stands
everywhere is one record per block.

Defined results: null and empty texts have no words; null ids come before all others; rows with the same id don't
remove each other's words (none is smaller); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UID, Words, buffers, covered, kept_bytes, keyed, mix, reducers, slices, table, tidy, tune, window_hashes, windows
from tidemark.llm.packed import cut_arrays, groups, repeated

WINDOW, PERIOD, COVER = 13, 7, (1, 2, 4)
ANCHOR = WINDOW - PERIOD + 1
#: Records and documents of one map block.
BLOCK_RECORDS, BLOCK_DOCS = 2_000_000, 60_000
NO_ID = np.iinfo(np.int64).min
ROWS = "slot int, base long, uid long, data binary"
#: A record of the second shuffle: a window's hash, 32 more bits of it, and where it stands.
RECORD = np.dtype([("h", "<u8"), ("g", "<u4"), ("doc", "<i8"), ("uid", "<i8")])
#: Slots of the packed shuffles at least: a document's hits come back in one row per slot, so that few slots for
#: small inputs and many for large ones would change the number of rows per document.
LEAST_SLOTS = 64
MANY = np.uint16(0xFFFF)
LOW48 = np.uint64((1 << 48) - 1)


def _cover_positions(w: Words) -> np.ndarray:
    """Which words stand at cover positions of their text."""
    within = np.arange(len(w)) - np.repeat(w.first[:-1], w.count)
    table = np.zeros(PERIOD, bool)
    table[list(COVER)] = True
    return table[within % PERIOD]


def anchors(w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a batch's anchors."""
    at, a = windows(w, h, ANCHOR)
    on = _cover_positions(w)[at]
    return at[on], a[on]


def _rows(found: list[tuple]) -> pa.RecordBatch:
    slot, base, uid, data = zip(*found) if found else ((), (), (), ())
    return pa.record_batch([pa.array(slot, pa.int32()), pa.array(base, pa.int64()), pa.array(uid, pa.int64()), pa.array(data, pa.binary())], ["slot", "base", "uid", "data"])


def pack_records(r: np.ndarray) -> bytes:
    """Records as columns, high and low halves of the integers apart, so that compression finds what repeats."""
    halves = [r[c].view("<u8") for c in ("doc", "uid")]
    columns = [r["h"], r["g"], *[x.astype("<u4") for v in halves for x in (v & np.uint64(0xFFFFFFFF), v >> np.uint64(32))]]
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpack_records(data: bytes) -> np.ndarray:
    n = len(data) // 28
    out = np.empty(n, RECORD)
    out["h"], out["g"] = np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n)
    for k, c in enumerate(("doc", "uid")):
        low, high = (np.frombuffer(data, "<u4", n, (12 + 8 * k + 4 * j) * n).astype(np.uint64) for j in (0, 1))
        out[c] = (low | high << np.uint64(32)).view(np.int64)
    return out


def pack_anchors(h: np.ndarray, row: np.ndarray) -> bytes:
    """48-bit hashes with their rows (16 bits): hashes in order, as steps of 5 bytes, or of 6 if one of them needs it; the first byte says which."""
    order = np.argsort(h, kind="stable")
    steps = np.diff(h[order], prepend=np.uint64(0)).astype("<u8")
    width = 5 if not len(steps) or steps.max() < 1 << 40 else 6
    return bytes([width]) + steps[:, None].view(np.uint8)[:, :width].tobytes() + row[order].astype("<u2").tobytes()


def unpack_anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = data[0]
    n = (len(data) - 1) // (width + 2)
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8, n * width, 1).reshape(n, width)
    return np.cumsum(raw.view("<u8")[:, 0], dtype=np.uint64), np.frombuffer(data, "<u2", n, 1 + n * width)


def _by_row(uid: np.ndarray, h: np.ndarray, slots: int) -> Iterator[pa.RecordBatch]:
    """Rows that are settled: hashes by row key, passed through the shuffle in any slot."""
    order = np.argsort(uid, kind="stable")
    uid, h = uid[order], h[order]
    starts = groups(uid)
    ends = np.append(starts[1:], len(uid))
    for i in range(0, len(starts), 4096):
        yield _rows([(int(uid[a]) % slots, None, int(uid[a]), h[a:b].tobytes()) for a, b in zip(starts[i : i + 4096], ends[i : i + 4096])])


def _shared_anchors(rows: DataFrame, slots: int) -> DataFrame:
    """(uid, hits): the hashes of each row's anchors that stand in another row too, cut to 48 bits within a slot (a filter: what follows is exact)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        base, last, n = None, None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.concatenate([x for x, _ in held])
            row = np.concatenate([x for _, x in held])
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            one = groups(h, row)  # an anchor once per document
            h, row = h[one], row[one]
            starts = groups(h)
            size = np.diff(np.append(starts, len(h)))
            many = repeated(size > 1, starts, len(h))
            yield from _by_row(row[many] + base, h[many], slots)
            of = np.where(size > 1, MANY, row[starts].astype(np.uint16))
            found = [(s, base, None, pack_anchors(h[starts][at] & LOW48, of[at])) for s, at in cut_arrays(h[starts], np.arange(len(starts)), slots)]
            for i in range(0, len(found), 256):
                yield _rows(found[i : i + 256])

        for batch in batches:
            uid = batch.column(UID).to_numpy()
            data, offsets = buffers(batch.column("text"))
            for i, j in slices(offsets):
                if held and (n >= BLOCK_RECORDS or uid[j - 1] - base >= BLOCK_DOCS or uid[i] != last + 1):
                    yield from flush()
                    held, n = [], 0
                if not held:
                    base = int(uid[i])
                w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                at, a = anchors(w, w.hashes())
                held.append((a, w.owner()[at] + int(uid[i]) - base))
                n, last = n + len(a), int(uid[j - 1])
        if held:
            yield from flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot: dict[int, list] = {}
        for batch in batches:
            settled = batch.filter(pc.is_valid(batch.column("uid")))
            if settled.num_rows:
                yield pa.record_batch([settled.column("uid"), settled.column("data")], ["uid", "hits"])
            open_ = batch.filter(pc.is_null(batch.column("uid")))
            for s, base, data in zip(open_.column("slot").to_pylist(), open_.column("base").to_pylist(), open_.column("data").to_pylist()):
                slot.setdefault(s, []).append((base, *unpack_anchors(data)))
        for parts in slot.values():
            h, row = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
            base = np.repeat(np.array([p[0] for p in parts]), [len(p[1]) for p in parts])
            order = np.argsort(h, kind="stable")
            h, row, base = h[order], row[order], base[order]
            starts = groups(h)
            size = np.diff(np.append(starts, len(h)))
            hit = repeated(size > 1, starts, len(h)) & (row != MANY)
            for b in _by_row(base[hit] + row[hit], h[hit], 1):
                yield pa.record_batch([b.column("uid"), b.column("data")], ["uid", "hits"])

    sent = rows.select(UID, "text").mapInArrow(tidy(send), ROWS)
    return sent.repartitionById(slots, "slot").mapInArrow(tidy(match), "uid long, hits binary")


def _candidates(w: Words, h: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows that hold one of the shared anchors (all of a batch's texts: a filter)."""
    at, a = anchors(w, h)
    hit = at[np.isin(a & LOW48, shared)]
    near = np.zeros(len(w), bool)
    for d in range(PERIOD):
        near[np.maximum(hit - d, 0)] = True
    pos, full = windows(w, h, WINDOW)
    on = near[pos]
    return pos[on], full[on]


def _earlier_windows(rows: DataFrame, hits: DataFrame, slots: int) -> DataFrame:
    """(uid, hits): the hashes of each row's windows that start in a document with a smaller id."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            r = np.concatenate(held)
            r = r[np.lexsort((r["uid"], r["doc"], r["g"], r["h"]))]
            r = r[groups(r["h"], r["g"], r["uid"])]
            starts = groups(r["h"], r["g"])
            least = repeated(r["doc"][starts], starts, len(r))
            later = r["doc"] > least
            yield from _by_row(r["uid"][later], r["h"][later], slots)
            first = r[~later]
            # in order of rows, so that compression finds what a document's records share
            found = [(s, 0, None, pack_records(part[np.argsort(part["uid"], kind="stable")])) for s, part in cut_arrays(first["h"], first, slots)]
            for i in range(0, len(found), 256):
                yield _rows(found[i : i + 256])

        for batch in batches:
            uid, doc = batch.column(UID).to_numpy(), batch.column("doc_id").fill_null(int(NO_ID)).to_numpy()
            data, offsets = buffers(batch.column("text"))
            shared = batch.column("hits").to_pylist()
            for i, j in slices(offsets):
                w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                h = w.hashes()
                pos, full = _candidates(w, h, np.unique(np.frombuffer(b"".join(x for y in shared[i:j] for x in y), "<u8") & LOW48))
                out = np.empty(len(pos), RECORD)
                of = w.owner()[pos] + i
                out["h"], out["doc"], out["uid"] = full, doc[of], uid[of]
                out["g"] = window_hashes(mix(h + np.uint64(0x5851F42D4C957F2D)), WINDOW)[pos] if len(pos) else 0
                held.append(out)
                n += len(out)
                if n >= BLOCK_RECORDS // 4:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot: dict[int, list] = {}
        for batch in batches:
            settled = batch.filter(pc.is_valid(batch.column("uid")))
            if settled.num_rows:
                yield pa.record_batch([settled.column("uid"), settled.column("data")], ["uid", "hits"])
            open_ = batch.filter(pc.is_null(batch.column("uid")))
            for s, data in zip(open_.column("slot").to_pylist(), open_.column("data").to_pylist()):
                slot.setdefault(s, []).append(unpack_records(data))
        for parts in slot.values():
            r = np.concatenate(parts)
            r = r[np.lexsort((r["doc"], r["g"], r["h"]))]
            starts = groups(r["h"], r["g"])
            later = r["doc"] > repeated(r["doc"][starts], starts, len(r))
            for b in _by_row(r["uid"][later], r["h"][later], 1):
                yield pa.record_batch([b.column("uid"), b.column("data")], ["uid", "hits"])

    found = rows.join(_gathered(hits), UID).mapInArrow(tidy(send), ROWS)
    return found.repartitionById(slots, "slot").mapInArrow(tidy(match), "uid long, hits binary")


def _gathered(hits: DataFrame) -> DataFrame:
    """All hits of a row: at most one hash per word of its text."""
    return hits.groupBy(F.col("uid").alias(UID)).agg(F.collect_list("hits").alias("hits"))


OUT = f"{UID} long, doc_id long, n_words long, n_removed long, text string"


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, n_removed, text): texts of kept words, joined by one space."""
    tune(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    slots = max(LEAST_SLOTS, reducers(docs))
    earlier = _earlier_windows(rows, _shared_anchors(rows, slots), slots)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            hits = batch.column("hits").to_pylist()
            for i, j in slices(offsets):
                w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                gone = np.zeros(len(w), bool)
                if any(hits[i:j]):
                    pos, full = windows(w, w.hashes(), WINDOW)
                    first = np.searchsorted(pos, w.first)
                    at = [pos[a:b][np.isin(full[a:b], np.frombuffer(b"".join(x), "<u8"))] for x, a, b in zip(hits[i:j], first[:-1], first[1:]) if x]
                    gone = covered(len(w), np.concatenate(at), WINDOW)
                removed = [int(gone[a:b].sum()) for a, b in zip(w.first[:-1], w.first[1:])]
                text = [kept_bytes(w, k, ~gone) for k in range(j - i)]
                part = batch.slice(i, j - i)
                yield pa.record_batch([part.column(UID), part.column("doc_id"), pa.array(w.count, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())], [UID, "doc_id", "n_words", "n_removed", "text"])

    return rows.join(_gathered(earlier), UID, "left").mapInArrow(tidy(remove), OUT)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: per document, its words, the removed ones, and the digest of what stays."""
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM w),
z AS (SELECT doc_id, i, x, concat_ws(' ', x, lead(x, 1) OVER a, lead(x, 2) OVER a, lead(x, 3) OVER a, lead(x, 4) OVER a, lead(x, 5) OVER a, lead(x, 6) OVER a,
             lead(x, 7) OVER a, lead(x, 8) OVER a, lead(x, 9) OVER a, lead(x, 10) OVER a, lead(x, 11) OVER a, lead(x, 12) OVER a) AS h,
             lead(x, 12) OVER a IS NOT NULL AS whole FROM p WINDOW a AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT doc_id, i, x, whole AND min(doc_id) OVER (PARTITION BY h, whole) < doc_id AS later FROM z),
g AS (SELECT doc_id, i, x, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM m)
SELECT d.doc_id, count(i) AS n_words, count(i) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id) GROUP BY d.doc_id
"""
