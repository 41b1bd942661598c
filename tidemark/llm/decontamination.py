"""Benchmark decontamination (8): suffix arrays over training shards, searched by every benchmark suffix.

A shard is a run of documents of about `SHARD_BYTES`. Its words are 64-bit hashes, with a separator after every
document; the suffix array orders all positions by all the words that follow, to the document's end. Sorting takes
the first word, and doubles the depth only inside groups that are still equal.

Every suffix of every item is searched, all at once: bisection gives its place in the array, and the longer of the
words it shares with both neighbours is its longest verbatim match in the shard, of any length, with its place.
Where that is a window of the item at least, all positions that start with the window are its occurrences; their
words are hit, and a document with too large a share of hit words is removed. Matches that are no tail of a
longer one are reported with their documents (`matches`).

A window is `window` consecutive words of an item; an item with fewer words is one window. Items become packed word
hashes on the executors. Up to `BLOCK_WORDS` of them are broadcast and met in the pass that builds the shards; a
larger benchmark is cut into blocks of that size: then the shards are written once, and each block searches them.

Defined results: null and empty texts have no words and no hits; items without words match nothing; repeated items
count each; items without an id hit as others do, and stand in a document's items as one null, which counts as an item
and has no name; rows with the same or no id are judged each by itself; an empty table gives an empty table; item ids
may be of any type and are kept as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UID, Words, buffers, carried, is_delimiter, keyed, materialize, restored, slices, table, tidy, tune, with_fields

WINDOW = 13
SHARD_BYTES = 2 << 20
#: Benchmark words (8 bytes each) that are broadcast at once, and suffixes that are searched at once in a task.
BLOCK_WORDS, SEARCHED = 1_000_000, 100_000
#: A document is contaminated if its hit words are at least this share (one in so many).
ONE_IN = 20
DELIMITER = is_delimiter(range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80))
SEPARATOR = np.uint64(0)
#: Words compared in the first step, and in each further one; arrays are padded for it.
NEAR, FAR = 4, 64


def word_hashes(w: Words) -> np.ndarray:
    """Hashes of words; none is the separator's."""
    h = w.hashes()
    h[h == SEPARATOR] = 1
    return h


def suffix_array(h: np.ndarray) -> np.ndarray:
    """Positions in order of the words from each to the next separator: one sort, then doubled keys within equal groups.

    Equal suffixes stand in order of their separators, so a key ends with its document and sorting with the longest repeat."""
    n = len(h)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(h, kind="stable")
    rank = np.zeros(n, np.int64)
    sorted_h = h[order]
    start = np.flatnonzero(np.concatenate(([True], (sorted_h[1:] != sorted_h[:-1]) | (sorted_h[1:] == SEPARATOR))))
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    size = np.diff(np.append(start, n))
    at = np.flatnonzero(np.repeat(size > 1, size))  # places in groups of more than one
    step = 1
    while len(at):
        pos = order[at]
        first, second = rank[pos], rank[pos + step]  # a group ends before its separators, so pos + step is a position
        by = np.lexsort((second, first))
        pos, first, second = pos[by], first[by], second[by]
        order[at] = pos
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(pos)))
        rank[pos] = np.repeat(at[start], size)
        at = at[np.repeat(size > 1, size)]
        step *= 2
    return order


class Benchmark:
    """Words of a block of items with a separator after each, and all suffixes of the items."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        words = [np.frombuffer(x, np.uint64) for _, x in items]
        count = np.array([len(w) for w in words], np.int64)
        self.ids = [i for i, _ in items]
        self.h = np.zeros(int(count.sum()) + len(words) + FAR, np.uint64)
        first = np.cumsum(count + 1) - count - 1
        for a, w in zip(first, words):
            self.h[a : a + len(w)] = w
        self.item = np.repeat(np.arange(len(words)), count)
        self.word = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        self.start = first[self.item] + self.word if len(self.item) else np.zeros(0, np.int64)
        self.left = count[self.item] - self.word if len(self.item) else np.zeros(0, np.int64)
        #: Words of the window that each suffix starts, and whether it starts one.
        self.size = np.minimum(count, window)[self.item] if len(self.item) else np.zeros(0, np.int64)
        self.whole = self.left >= self.size


class Shard:
    """Words of some texts with separators, and their suffix array."""

    def __init__(self, h: np.ndarray, counts: np.ndarray, order: np.ndarray | None = None):
        self.counts, self.size = counts, len(h)
        self.first = np.cumsum(counts + 1) - counts - 1
        self.order = suffix_array(h) if order is None else order
        self.h = np.concatenate((h, np.zeros(FAR, np.uint64)))
        self.heads = h[self.order]

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Shard:
        w = Words(data, offsets, DELIMITER, lower=True)
        h = np.zeros(len(w) + len(w.count), np.uint64)
        h[np.arange(len(w)) + w.owner()] = word_hashes(w)
        return cls(h, w.count)

    def shared(self, at: np.ndarray, b: Benchmark, start: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words the suffixes at some positions share with the items' suffixes, up to `most`."""
        out = np.zeros(len(at), np.int64)
        open_, k = np.flatnonzero(most > 0), 0
        while len(open_):
            width = np.arange(k, k + (FAR if k else NEAR))
            differ = (self.h[at[open_, None] + width] != b.h[start[open_, None] + width]) | (width >= most[open_, None])
            found = differ.any(axis=1)
            out[open_] = np.where(found, k + differ.argmax(axis=1), k + len(width))
            open_, k = open_[~found], k + len(width)
        return out

    def bisect(self, b: Benchmark, start: np.ndarray, most: np.ndarray, after: bool) -> np.ndarray:
        """For each item suffix, cut to `most` words: the first place that isn't before it, or is after all that start with it."""
        low, high = np.searchsorted(self.heads, b.h[start], "left"), np.searchsorted(self.heads, b.h[start], "right")
        while len(open_ := np.flatnonzero(low < high)):
            mid = (low[open_] + high[open_]) >> 1
            at, s, m = self.order[mid], start[open_], most[open_]
            n = self.shared(at, b, s, m)
            ended = n >= m
            k = np.where(ended, 0, n)
            left = np.where(ended, after, self.h[at + k] < b.h[s + k])
            low[open_[left]] = mid[left] + 1
            high[open_[~left]] = mid[~left]
        return low

    def longest(self, b: Benchmark, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and position of the longest verbatim match of some suffixes: its neighbours in order share most with it."""
        start, most = b.start[some], b.left[some]
        place = self.bisect(b, start, most, False)
        best, at = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
        for near in (place - 1, place):
            ok = np.flatnonzero((near >= 0) & (near < len(self.order)))
            pos = self.order[near[ok]]
            n = self.shared(pos, b, start[ok], most[ok])
            better = n > best[ok]
            best[ok[better]], at[ok[better]] = n[better], pos[better]
        return best, at

    def doc(self, at: np.ndarray) -> np.ndarray:
        """The text of each position."""
        return np.searchsorted(self.first, at, "right") - 1

    def search(self, b: Benchmark) -> tuple[np.ndarray, dict[int, set], dict[int, list[tuple]]]:
        """Hit words (over all positions), and by text the items that occur in it and the longest matches."""
        known = np.flatnonzero(np.searchsorted(self.heads, b.h[b.start], "left") < np.searchsorted(self.heads, b.h[b.start], "right")) if len(b.start) else np.zeros(0, np.int64)
        length, at = np.zeros(len(b.start) + 1, np.int64), np.zeros(len(b.start) + 1, np.int64)
        for i in range(0, len(known), SEARCHED):
            some = known[i : i + SEARCHED]
            length[some], at[some] = self.longest(b, some)
        matches: dict[int, list[tuple]] = {}
        # a tail of the match before it is one word shorter
        tail = np.zeros(len(b.start), bool)
        tail[1:] = (b.word[1:] > 0) & (length[:-2] > length[1:-1])
        for s in np.flatnonzero((length[:-1] >= b.size) & ~tail):
            d = int(self.doc(at[s]))
            matches.setdefault(d, []).append((b.ids[b.item[s]], int(b.word[s]), int(at[s] - self.first[d]), int(length[s])))
        edge, items = np.zeros(self.size + 1, np.int64), {}
        found = np.flatnonzero((length[:-1] >= b.size) & b.whole)
        for size in np.unique(b.size[found]):
            some = found[b.size[found] == size]
            most = np.full(len(some), size)
            low = self.bisect(b, b.start[some], most, False)
            places, which = np.unique(low, return_inverse=True)  # equal windows share their first place
            one = np.zeros(len(places), np.int64)
            one[which] = some
            n = self.bisect(b, b.start[one], most[: len(one)], True) - places
            window = np.repeat(np.arange(len(places)), n)
            pos = self.order[np.arange(int(n.sum())) + np.repeat(places - (np.cumsum(n) - n), n)]
            np.add.at(edge, pos, 1)
            np.add.at(edge, pos + size, -1)
            owners: list[set] = [set() for _ in places]
            for k, s in zip(which.tolist(), some.tolist()):
                owners[k].add(b.ids[b.item[s]])
            for d, k in np.unique(np.stack([self.doc(pos), window]), axis=1).T.tolist():
                items.setdefault(d, set()).update(owners[k])
        return np.cumsum(edge)[: self.size] > 0, items, matches


MATCH = "item_id string, item_word long, doc_word long, length long"
FOUND = [("n_words", "long"), ("n_hit", "long"), ("items", "array<string>"), ("matches", f"array<struct<{MATCH.replace(' string', ':string').replace(' long', ':long')}>>")]
_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("length", pa.int64())]))]


def _in_order(names: set) -> list:
    return sorted(names, key=lambda x: (x is None, x or ""))


def _columns(counts: np.ndarray | list, n_hit: list[int], items: list, matches: list) -> list[pa.Array]:
    shown = [[dict(zip(("item_id", "item_word", "doc_word", "length"), m)) for m in x] for x in matches]
    return [pa.array(x, t) for x, t in zip((counts, n_hit, items, shown), _TYPES)]


def packed_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(row, item_id, n, words): items as packed word hashes, written to the shared folder; those without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(*buffers(batch.column("text")), DELIMITER, lower=True)
            h = word_hashes(w)
            yield pa.record_batch([batch.column(UID), batch.column("item_id"), pa.array(w.count, pa.int64()), pa.array([h[a:b].tobytes() for a, b in zip(w.first[:-1], w.first[1:])], pa.binary())], [UID, "item_id", "n", "words"])

    rows = benchmark.select(F.monotonically_increasing_id().alias(UID), F.col(f"`{id_col}`").cast("string").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialize(rows.mapInArrow(tidy(run), f"{UID} long, item_id string, n long, words binary").filter("n > 0"))


def blocks(items: DataFrame, most: int = BLOCK_WORDS) -> list[Column]:
    """Conditions that part the items into blocks of at most `most` words (or of one longer item), by hashes of their rows."""
    total = items.agg(F.sum("n")).first()[0] or 0
    if total <= most:
        return [F.lit(True)]
    parts = 2 * -(-total // most)
    while True:
        block = F.pmod(F.xxhash64(UID), F.lit(parts))
        sizes = items.groupBy(block.alias("block")).agg(F.sum("n").alias("n"), F.count("*").alias("items")).collect()  # a row per block
        if all(r["n"] <= most or r["items"] == 1 for r in sizes):
            return [block == r["block"] for r in sizes]
        parts *= 2


def _collected(items: DataFrame, block: Column) -> list[tuple[str | None, bytes]]:
    found = items.filter(block).select("item_id", "words").toArrow()  # at most BLOCK_WORDS words
    return list(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))


def _fused(rows: DataFrame, items: list[tuple[str | None, bytes]], window: int) -> DataFrame:
    """Rows with `FOUND`: each shard is sorted and searched where its texts are read."""
    sent = rows.sparkSession.sparkContext.broadcast(items)
    schema = with_fields(rows.schema, *FOUND)
    passed = [f.name for f in schema if f.name not in dict(FOUND)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Benchmark(sent.value, window)
        for whole in batches:
            data, offsets = buffers(whole.column("text"))
            for i, j in slices(offsets, SHARD_BYTES):
                batch = whole.slice(i, j - i)
                shard = Shard.of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                hit, items, matches = shard.search(b)
                n_hit = [int(hit[a : a + n].sum()) for a, n in zip(shard.first, shard.counts)]
                yield pa.record_batch([*(batch.column(c) for c in passed), *_columns(shard.counts, n_hit, [_in_order(items.get(d, set())) for d in range(j - i)], [matches.get(d, []) for d in range(j - i)])], [*passed, *dict(FOUND)])

    return rows.mapInArrow(tidy(run), schema)


def written_shards(rows: DataFrame) -> DataFrame:
    """(uids, counts, words, places): shards and their suffix arrays, packed, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column(UID).to_numpy()
            data, offsets = buffers(batch.column("text"))
            for i, j in slices(offsets, SHARD_BYTES):
                s = Shard.of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                packed = [uid[i:j].tobytes(), s.counts.astype(np.int64).tobytes(), s.h[: s.size].tobytes(), s.order.astype(np.int64).tobytes()]
                yield pa.record_batch([pa.array([x], pa.binary()) for x in packed], ["uids", "counts", "words", "places"])

    return materialize(rows.select(UID, "text").mapInArrow(tidy(run), "uids binary, counts binary, words binary, places binary"))


def _searched(shards: DataFrame, items: list[tuple[str | None, bytes]], window: int) -> DataFrame:
    """(row, hits, items, matches) of the texts that a block hits; hits: a bit per word."""
    sent = shards.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Benchmark(sent.value, window)
        for batch in batches:
            for uids, counts, words, places in zip(*(batch.column(c).to_pylist() for c in ("uids", "counts", "words", "places"))):
                shard = Shard(np.frombuffer(words, np.uint64), np.frombuffer(counts, np.int64), np.frombuffer(places, np.int64))
                hit, found, matches = shard.search(b)
                docs = sorted(found)
                bits = [np.packbits(hit[shard.first[d] : shard.first[d] + shard.counts[d]]).tobytes() for d in docs]
                shown = _columns([], [], [_in_order(found[d]) for d in docs], [matches.get(d, []) for d in docs])[2:]
                yield pa.record_batch([pa.array(np.frombuffer(uids, np.int64)[docs], pa.int64()), pa.array(bits, pa.binary()), *shown], [UID, "hits", "items", "matches"])

    return shards.mapInArrow(tidy(run), f"{UID} long, hits binary, items {FOUND[2][1]}, matches {FOUND[3][1]}")


def _in_blocks(rows: DataFrame, items: DataFrame, parts: list[Column], window: int) -> DataFrame:
    """Rows with `FOUND`, from shards that are sorted once and searched by each block in turn."""
    shards = written_shards(rows)
    found = None
    for part in parts:
        here = materialize(_searched(shards, _collected(items, part), window))
        found = here if found is None else found.unionByName(here)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uids, counts in zip(batch.column("uids").to_pylist(), batch.column("counts").to_pylist()):
                yield pa.record_batch([pa.array(np.frombuffer(uids, np.int64)), pa.array(np.frombuffer(counts, np.int64))], [UID, "n_words"])

    def ored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(np.bitwise_count(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in parts])).sum()) for parts in batch.column("hits").to_pylist()]
            yield pa.record_batch([batch.column(UID), pa.array(n, pa.int64()), batch.column("items"), batch.column("matches")], [UID, "n_hit", "items", "matches"])

    # of each text one row per block at most
    by_text = found.groupBy(UID).agg(F.collect_list("hits").alias("hits"), F.collect_list("items").alias("i"), F.collect_list("matches").alias("m"))
    by_text = by_text.select(UID, "hits", F.array_sort(F.array_distinct(F.flatten("i"))).alias("items"), F.flatten("m").alias("matches"))
    by_text = by_text.mapInArrow(tidy(ored), f"{UID} long, n_hit long, items {FOUND[2][1]}, matches {FOUND[3][1]}")
    known = shards.select("uids", "counts").mapInArrow(tidy(count), f"{UID} long, n_words long").join(by_text, UID, "left")
    known = known.select(UID, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast(FOUND[2][1])).alias("items"), F.coalesce("matches", F.array().cast(FOUND[3][1])).alias("matches"))
    return rows.join(known, UID)


def search(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows of `keyed` or `carried` with the columns of `FOUND`: words, hit words, items found, and the longest matches that lie in the text."""
    tune(rows.sparkSession)
    items = packed_items(benchmark)
    parts = blocks(items, block_words)
    return _fused(rows, _collected(items, parts[0]), window) if len(parts) == 1 else _in_blocks(rows, items, parts, window)


def contaminated(one_in: int = ONE_IN) -> Column:
    return (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that aren't contaminated, with the columns of `docs`."""
    found = search(carried(docs, id_col, text_col), benchmark, window)
    return restored(found.filter(~contaminated(one_in)), docs, text_col)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, item_word, doc_word, length): the longest verbatim match of each item suffix in each shard, without tails of longer ones."""
    found = search(keyed(docs, id_col, text_col), benchmark, window)
    return found.select("doc_id", F.inline("matches"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: hit words and items of every document."""
    found = search(keyed(table(spark, sf_dir, "documents"), "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.array_join("items", ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), contaminated().alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bp AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM b),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS x FROM bp),
heads AS (SELECT DISTINCT string_split(x, ' ')[1] AS head FROM bw),
dp AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS head FROM d),
dc AS (SELECT doc_id, i, size FROM dp JOIN heads USING (head), (SELECT DISTINCT size FROM bw)),
dw AS (SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS x FROM dc JOIN d USING (doc_id) WHERE i + size - 1 <= len(w)),
o AS (SELECT doc_id, i, size, item_id FROM dw JOIN bw USING (size, x)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM (SELECT DISTINCT doc_id, i, size FROM o)) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM o) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
