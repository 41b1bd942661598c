"""Line deduplication (9): exact reference counts of line keys, sharded, with cuckoo filters in front.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased; `refs` says in how
many documents each key stands. Keys in at least `min_docs` documents lose their lines everywhere.
The reference-count table makes the operation reversible: documents can be inserted or deleted later,
and a key whose count falls below the limit leaves its shard's filter, so its lines come back.

Each shard's cuckoo filter holds the keys at or above the limit. As the shard also has the exact counts
of all other keys, those that the filter would take for members are found when it is built and kept as
exceptions: filter and exceptions together are exact for every key of the table.

Insertions and deletions cost what they change. Their counts are written beside the table as one more part. Old counts
are looked up for their keys alone; keys that reach the limit are inserted into their shards' filters, keys
that fall below it are deleted from them, in place. New exceptions can only be keys of the change itself, or keys
that share a fingerprint with an inserted one: those are found by it. Only a filter that is full is built anew.

Defined results: null and empty texts are one empty line, which has no key and stays; rows with the same
or no id are documents of their own; an empty table gives an empty table. Keys are 128-bit hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, UID, carried, keyed, materialize, mix, plan_bytes, restored, table, tidy, tune, with_fields

MIN_DOCS, MIN_KEY_CHARS = 10, 1
#: Filters of up to this many bytes in all are broadcast; beyond it, line keys are joined to the counts.
FILTER_BROADCAST_BYTES = 64 << 20
BYTES_PER_SHARD = 256 << 20
#: Keys that a task counts before it passes them on.
COUNTED_KEYS = 100_000
HOT_SALTS = 8
REFS = "shard int, key binary, docs long"


class CuckooFilter:
    """A cuckoo filter of 64-bit hashes: buckets of four 32-bit fingerprints, two buckets a key."""

    SLOTS, KICKS = 4, 500

    def __init__(self, keys: int = 0, cells: np.ndarray | None = None):
        if cells is None:
            buckets = 1 << max(1, (int(max(keys, 1) / (self.SLOTS * 0.9))).bit_length())
            cells = np.zeros((buckets, self.SLOTS), np.uint32)
        self.cells = cells

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each hash."""
        last = np.uint64(len(self.cells) - 1)
        mark = (h >> np.uint64(32)).astype(np.uint32)
        mark[mark == 0] = 1
        one = h & last
        return mark, one, one ^ (mix(mark.astype(np.uint64)) & last)

    def has(self, h: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(h)
        return ((self.cells[one] == mark[:, None]) | (self.cells[two] == mark[:, None])).any(axis=1)

    def insert(self, h: int) -> None:
        mark, one, two = (int(x[0]) for x in self.places(np.array([h], np.uint64)))
        at = one
        for kick in range(self.KICKS):
            for b in (one, two) if kick == 0 else (at,):
                free = np.flatnonzero(self.cells[b] == 0)
                if len(free):
                    self.cells[b, free[0]] = mark
                    return
            slot = (mark + kick) % self.SLOTS
            mark, self.cells[at, slot] = int(self.cells[at, slot]), mark
            at ^= int(mix(np.array([mark], np.uint64))[0]) & (len(self.cells) - 1)
        self.grow_error(mark)

    @staticmethod
    def grow_error(mark: int) -> None:
        raise OverflowError(f"the filter is full: {mark:#x} has no place; build it for more keys")

    def delete(self, h: int) -> bool:
        """Take one copy of a key out; False if it isn't there."""
        mark, one, two = (int(x[0]) for x in self.places(np.array([h], np.uint64)))
        for b in (one, two):
            there = np.flatnonzero(self.cells[b] == mark)
            if len(there):
                self.cells[b, there[0]] = 0
                return True
        return False

    @classmethod
    def of(cls, hashes: list[int]) -> CuckooFilter:
        """A filter of these keys, larger if they don't fit at first."""
        size = len(hashes)
        while True:
            out = cls(size)
            try:
                for h in hashes:
                    out.insert(h)
                return out
            except OverflowError:
                size *= 2


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line (empty: no key)."""
    return [x.strip(SPACE).lower() for x in text.split(b"\n")]


def wanted(key: bytes, min_chars: int) -> bool:
    return bool(key) if min_chars <= 1 else len(key.decode("utf-8", "replace")) >= min_chars


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def shard_count(docs: DataFrame) -> int:
    return 1 << max(3, (plan_bytes(docs) // BYTES_PER_SHARD).bit_length())


def count_lines(docs: DataFrame, shards: int, min_key_chars: int = MIN_KEY_CHARS, sign: int = 1) -> DataFrame:
    """Reference counts of the keys of `docs` (columns of `keyed`); tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            keys, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts)) * sign
            shard = (np.frombuffer(b"".join(keys), "<u8")[1::2] & np.uint64(shards - 1)).astype(np.int32)
            return pa.record_batch([pa.array(shard), pa.array(keys, pa.binary()), pa.array(n)], ["shard", "key", "docs"])

        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in texts_of(batch):
                counts.update({xxhash.xxh3_128_digest(k) for k in set(line_keys(text)) if wanted(k, min_key_chars)})
                if len(counts) >= COUNTED_KEYS:
                    yield flush()
                    counts.clear()
        if counts:
            yield flush()

    return docs.select("text").mapInArrow(tidy(run), REFS).groupBy("shard", "key").agg(F.sum("docs").alias("docs"))


FILTERS = "shard int, cells binary, exceptions binary"


def build_filters(refs: DataFrame, shards: int, least: int) -> DataFrame:
    """`FILTERS`: each shard's cuckoo filter, and the rare keys that it wrongly takes for members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, members, found, wrong = -1, [], None, []

        def done() -> pa.RecordBatch:
            return _filter_row(shard, found or CuckooFilter.of(members), wrong)

        for batch in batches:
            of, keys, docs = batch.column("shard").to_numpy(), batch.column("key").to_pylist(), batch.column("docs").to_numpy()
            h = np.frombuffer(b"".join(keys), "<u8")[0::2]
            for s in np.unique(of):
                if s != shard:
                    if shard >= 0:
                        yield done()
                    shard, members, found, wrong = int(s), [], None, []
                here = of == s
                members += h[here & (docs >= least)].tolist()
                if (rest := np.flatnonzero(here & (docs < least))).size:
                    found = found or CuckooFilter.of(members)
                    wrong += [keys[i] for i in rest[found.has(h[rest])]]
        if shard >= 0:
            yield done()

    dealt = refs.repartitionById(shards, "shard").sortWithinPartitions("shard", F.col("docs") < least)
    return dealt.mapInArrow(tidy(run), FILTERS)


def _filter_row(shard: int, found: CuckooFilter | None, exceptions: Iterable[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([shard], pa.int32()), pa.array([found and found.cells.tobytes()], pa.binary()), pa.array([b"".join(exceptions)], pa.binary())], ["shard", "cells", "exceptions"])


def _mark(key: Column) -> Column:
    """The bytes of a key's fingerprint."""
    mark = F.substring(key, 5, 4)
    return F.when(mark == F.lit(b"\0\0\0\0"), F.lit(b"\1\0\0\0")).otherwise(mark)


def update_filters(filters: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """`FILTERS` after changes (shard, key, flip): flip 1 makes a key a member, -1 ends that, 0 is another key that isn't one. Cells are NULL where a filter is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found, wrong, full = -1, None, set(), False

        def done() -> pa.RecordBatch:
            return _filter_row(shard, None if full else found, sorted(wrong))

        for batch in batches:  # in order of shard and kind: the filter, members that go, members that come, other keys
            for s, kind, key, cells, exceptions in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "key", "cells", "exceptions"))):
                if s != shard:
                    if shard >= 0:
                        yield done()
                    shard, found, wrong, full = s, CuckooFilter(1024), set(), False
                if kind == 0:
                    found = CuckooFilter(cells=np.frombuffer(cells, np.uint32).reshape(-1, CuckooFilter.SLOTS).copy())
                    wrong = {exceptions[i : i + 16] for i in range(0, len(exceptions), 16)}
                    continue
                h = int.from_bytes(key[:8], "little")
                if kind == 1:
                    found.delete(h)
                elif kind == 2:
                    wrong.discard(key)
                    try:
                        found.insert(h)
                    except OverflowError:
                        full = True
                elif found.has(np.array([h], np.uint64))[0]:
                    wrong.add(key)
        if shard >= 0:
            yield done()

    nothing = F.lit(None).cast("binary")
    old = filters.select("shard", F.lit(0).alias("kind"), nothing.alias("key"), "cells", "exceptions")
    new = changes.select("shard", F.when(F.col("flip") < 0, 1).when(F.col("flip") > 0, 2).otherwise(3).alias("kind"), "key", nothing.alias("cells"), nothing.alias("exceptions"))
    gone = changes.filter("flip < 0").select("shard", F.lit(3).alias("kind"), "key", nothing.alias("cells"), nothing.alias("exceptions"))
    dealt = old.unionByName(new).unionByName(gone).repartitionById(shards, "shard").sortWithinPartitions("shard", "kind", "key")
    return dealt.mapInArrow(tidy(run), FILTERS)


class LineIndex:
    """The exact reference-count table of a corpus, and each shard's filter. The table is a base and what was inserted or deleted since, in written parts."""

    def __init__(self, parts: list[DataFrame], filters: DataFrame, shards: int, min_docs: int = MIN_DOCS, min_key_chars: int = MIN_KEY_CHARS):
        self.parts, self.filters, self.shards, self.min_docs, self.min_key_chars = parts, filters, shards, min_docs, min_key_chars

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = MIN_DOCS, min_key_chars: int = MIN_KEY_CHARS, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """Index a corpus. The table is written to the shared folder."""
        tune(docs.sparkSession)
        shards = shard_count(docs)
        refs = materialize(count_lines(keyed(docs, id_col, text_col), shards, min_key_chars))
        return cls([refs], materialize(build_filters(refs, shards, min_docs)), shards, min_docs, min_key_chars)

    @property
    def refs(self) -> DataFrame:
        """(shard, key, docs): in how many documents each key stands."""
        return self.parts[0] if len(self.parts) == 1 else _summed(self._rows())

    def _rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)

    def _changed(self, docs: DataFrame, sign: int, id_col: str, text_col: str) -> LineIndex:
        change = materialize(count_lines(keyed(docs, id_col, text_col), self.shards, self.min_key_chars, sign))
        parts = [*self.parts, change]
        before = self._rows().join(change.select("shard", "key"), ["shard", "key"], "left_semi").groupBy("shard", "key").agg(F.sum("docs").alias("was"))
        was = F.coalesce("was", F.lit(0))
        flip = ((was + F.col("docs")) >= self.min_docs).cast("int") - (was >= self.min_docs).cast("int")
        known = change.join(before, ["shard", "key"], "left").select("shard", "key", flip.alias("flip"), (was + F.col("docs")).alias("docs"))
        known = materialize(known)
        own = known.filter((F.col("flip") != 0) | (F.col("docs") < self.min_docs)).select("shard", "key", "flip")
        marks = materialize(known.filter("flip > 0").select("shard", _mark(F.col("key")).alias("mark")).distinct())
        alike = reduce(DataFrame.unionByName, parts).withColumn("mark", _mark(F.col("key"))).join(marks, ["shard", "mark"], "left_semi")
        alike = _summed(alike.select("shard", "key", "docs")).filter(F.col("docs") < self.min_docs).join(own, ["shard", "key"], "left_anti").select("shard", "key", F.lit(0).alias("flip"))
        filters = materialize(update_filters(self.filters, own.unionByName(alike), self.shards))
        if not filters.filter("cells is null").isEmpty():
            refs = materialize(_summed(reduce(DataFrame.unionByName, parts)))
            return LineIndex([refs], materialize(build_filters(refs, self.shards, self.min_docs)), self.shards, self.min_docs, self.min_key_chars)
        return LineIndex(parts, filters, self.shards, self.min_docs, self.min_key_chars)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with more documents."""
        return self._changed(docs, 1, id_col, text_col)

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index without documents that were inserted before: undoes `insert`."""
        return self._changed(docs, -1, id_col, text_col)

    def compacted(self) -> LineIndex:
        """The same index with its parts summed into one."""
        return LineIndex([materialize(self.refs)], self.filters, self.shards, self.min_docs, self.min_key_chars)

    def members(self) -> DataFrame:
        """Keys at or above the limit, with their counts."""
        return self.refs.filter(F.col("docs") >= self.min_docs)

    def drop_lines(self, rows: DataFrame) -> DataFrame:
        """Rows of `keyed` or `carried` with n_lines, n_dropped and the text that stays; the index has counted all their lines."""
        spark = rows.sparkSession
        tune(spark)
        size = self.filters.select(F.sum(F.octet_length("cells") + F.octet_length("exceptions"))).first()[0] or 0
        if size <= FILTER_BROADCAST_BYTES:
            return _dropped(rows, _by_filter(spark, self.filters, self.shards), self.min_key_chars)
        return _dropped_by_join(rows, self)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shard", "key").agg(F.sum("docs").alias("docs")).filter("docs > 0")


def _by_filter(spark: SparkSession, filters: DataFrame, shards: int):
    """A function of digests: which are members, by the broadcast filters."""
    sent = spark.sparkContext.broadcast({r["shard"]: (r["cells"], r["exceptions"]) for r in filters.toLocalIterator()})
    opened: dict[int, tuple[CuckooFilter, set[bytes]]] = {}

    def member(digests: list[bytes]) -> np.ndarray:
        if not opened:
            opened.update({s: (CuckooFilter(cells=np.frombuffer(c, np.uint32).reshape(-1, CuckooFilter.SLOTS)), {x[i : i + 16] for i in range(0, len(x), 16)}) for s, (c, x) in sent.value.items()})
        pair = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        of, out = (pair[:, 1] & np.uint64(shards - 1)).astype(np.int64), np.zeros(len(pair), bool)
        for s in np.unique(of):
            if int(s) in opened:
                found, wrong = opened[int(s)]
                at = np.flatnonzero(of == s)
                at = at[found.has(pair[at, 0])]
                out[[i for i in at if digests[i] not in wrong] if wrong else at] = True
        return out

    return member


ADDED = [("n_lines", "long"), ("n_dropped", "long"), ("text", "string")]


def _kept(batch: pa.RecordBatch, lines: list[list[bytes]], dropped: list[np.ndarray]) -> pa.RecordBatch:
    same = [n for n in batch.schema.names if n not in ("text", "lines")]
    text = [b"\n".join([x for x, d in zip(a, b) if not d]) if any(b) else b"\n".join(a) for a, b in zip(lines, dropped)]
    added = [pa.array([len(a) for a in lines], pa.int64()), pa.array([int(sum(b)) for b in dropped], pa.int64()), pa.array(text, pa.binary()).cast(pa.string())]
    return pa.record_batch([*(batch.column(n) for n in same), *added], [*same, *dict(ADDED)])


def _dropped(rows: DataFrame, member, min_key_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [t.split(b"\n") for t in texts_of(batch)]
            keys = [k for a in lines for k in (x.strip(SPACE).lower() for x in a)]
            some = [i for i, k in enumerate(keys) if wanted(k, min_key_chars)]
            hit = np.zeros(len(keys), bool)
            if some:
                hit[some] = member([xxhash.xxh3_128_digest(keys[i]) for i in some])
            yield _kept(batch, lines, np.split(hit, np.cumsum([len(a) for a in lines])[:-1]))

    return rows.mapInArrow(tidy(run), with_fields(rows.schema, *ADDED))


def _dropped_by_join(rows: DataFrame, index: LineIndex) -> DataFrame:
    """The same without a broadcast: keys go to the counts' shards and line numbers come back."""
    least = index.min_key_chars

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, text in zip(batch.column(UID).to_pylist(), texts_of(batch)):
                found = [(i, xxhash.xxh3_128_digest(k)) for i, k in enumerate(line_keys(text)) if wanted(k, least)]
                yield pa.record_batch([pa.array([uid] * len(found), pa.int64()), pa.array([i for i, _ in found], pa.int64()), pa.array([k for _, k in found], pa.binary()), pa.array([(uid + i) % HOT_SALTS for i, _ in found], pa.int32())], [UID, "line", "key", "salt"])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [t.split(b"\n") for t in texts_of(batch)]
            out = [np.zeros(len(a), bool) for a in lines]
            for o, at in zip(out, batch.column("lines").to_pylist()):
                o[at or []] = True
            yield _kept(batch, lines, out)

    members = index.members().select("key", F.explode(F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).alias("salt"))
    hit = rows.select(UID, "text").mapInArrow(tidy(keys), f"{UID} long, line long, key binary, salt int").join(members, ["key", "salt"]).groupBy(UID).agg(F.collect_list("line").alias("lines"))
    return rows.join(hit, UID, "left").mapInArrow(tidy(drop), with_fields(rows.schema, *ADDED))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_key_chars: int = MIN_KEY_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop lines that stand in at least `min_docs` documents: (row, doc_id, n_lines, n_dropped, text)."""
    return LineIndex.build(docs, min_docs, min_key_chars, id_col, text_col).drop_lines(keyed(docs, id_col, text_col))


def without_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_key_chars: int = MIN_KEY_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the lines gone, and its own columns."""
    found = LineIndex.build(docs, min_docs, min_key_chars, id_col, text_col).drop_lines(carried(docs, id_col, text_col))
    return restored(found, docs, text_col)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: per document, its lines, the dropped ones, and the digest of what stays."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
k AS (SELECT doc_id, i, line,
             translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM d),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY k.doc_id
"""
