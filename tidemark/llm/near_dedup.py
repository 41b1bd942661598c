"""MinHash near-dedup (4): b-bit signatures, banded candidates, links confirmed on full shingle sets.

1. Each document's distinct `SHINGLE`-word shingles give `PERMUTATIONS` minima. Bands of `ROWS` minima become 64-bit
   keys; of each minimum `BITS` low bits are kept and packed. Documents with equal sets are one node from here on.
2. A packed shuffle brings equal band keys together. Every bucket gives links to its hub only (one row per
   member). The packed signatures estimate similarity by counting equal lanes, corrected for chance collisions;
   each node's best hub is confirmed on full sets, and roots are found along the confirmed links.
3. Buckets of at most `CHUNK` nodes that still hold nodes of two components compare estimates across components
   (`linked`). First each node names its best partner only, which is confirmed as before. Then the nodes that
   still have a partner across components bring their full sets to their groups, where all such pairs are confirmed
   in place: what leaves a group is one link per pair of components at most. A pair inside one component can't
   change the result, so none is looked at.
4. Larger mixed buckets would cost the square of their size. Their nodes are grouped anew by the rare shingles of their
   sets (`by_rare_shingles`, a prefix filter, which loses no pair), and those groups are linked as in 3. A
   template that many documents share groups nobody, if what it leaves free differs. Groups that are still large are
   cut into chunks, compared pair by pair of chunks in tasks of their own.

A pair at the threshold is missed with probability (1 - 0.75^4)^40 < 3e-7 by the bands and < 1e-7 by the estimate's margin.

Defined results: null texts and texts without words have an empty set and stand alone; rows with equal texts are
one group whatever their ids; null ids are never smaller than others, and a group of null ids alone has no component id
and is kept; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import K1, UID, Words, buffers, carried, drop_written, keyed, materialize, mix, reducers, restored, slices, table, tidy, tune, windows
from tidemark.llm.components import forest_roots, merged
from tidemark.llm.packed import cut, groups, repeated

SHINGLE, PERCENT = 5, 75
ROWS, BANDS, BITS = 4, 40, 4
PERMUTATIONS = ROWS * BANDS
#: Estimates down to this (93 equal lanes) pass to the exact check: P(Bin(160, 0.765625) <= 92) = 7.8e-8 at the threshold.
LEAST_ESTIMATE = 0.55
#: Nodes of a bucket that are compared pair by pair; the largest set (in shingles) that is brought to a group.
CHUNK, BIG_SET = 512, 1 << 16
#: The largest set whose print has 16 bits of a shingle: few of them then have the print of another by chance.
SHORT_SET = 2048
#: Counters of the sketch that says which shingles are rare (8 bytes each).
SKETCH = 1 << 20
BLOCK_RECORDS = 1_000_000
#: Row keys (8 bytes each) that are broadcast to pick or drop texts; more are joined by a shuffle.
MOST_BROADCAST_NODES = 1_000_000
_SEEDS = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * K1)
XOR, MULTIPLY = _SEEDS[:PERMUTATIONS], _SEEDS[PERMUTATIONS:] | np.uint64(1)
LANES = np.uint64(0x1111111111111111)


def shingle_sets(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order of (text, hash), and each text's first one (n + 1 offsets)."""
    h = w.hashes()
    at, s = windows(w, h, size)
    parts, texts = [s], [w.owner()[at]]
    for n in range(1, size):  # shorter texts: the whole sequence
        if len(short := np.flatnonzero(w.count == n)):
            at, s = windows(w, h, n)
            parts.append(s[np.searchsorted(at, w.first[short])])
            texts.append(short)
    s, text = np.concatenate(parts), np.concatenate(texts)
    order = np.lexsort((s, text))
    s, text = s[order], text[order]
    one = groups(text, s)
    return s[one], np.searchsorted(text[one], np.arange(len(w.count) + 1))


def minima(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minima of non-empty sets under each permutation: sets x permutations."""
    out = np.empty((len(first), PERMUTATIONS), np.uint64)
    # few sets at a time, so that their hashes stay in the processor's cache
    edges = [0, *np.flatnonzero(np.diff(first // 8192)) + 1, len(first)] if len(first) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        part = s[first[a] : first[b] if b < len(first) else len(s)]
        local = first[a:b] - first[a]
        for k in range(PERMUTATIONS):
            out[a:b, k] = np.minimum.reduceat((part ^ XOR[k]) * MULTIPLY[k], local)
    return out >> np.uint64(24)


def band_keys(m: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64) * K1
    for r in range(ROWS):
        key = mix(key * K1 + m[:, r::ROWS])
    return key


def pack_bits(m: np.ndarray) -> np.ndarray:
    """Signatures: low bits of the minima, sixteen to a 64-bit integer."""
    lanes = (m & np.uint64((1 << BITS) - 1)).reshape(len(m), -1, 64 // BITS)
    return (lanes << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (last axis), corrected for lanes that agree by chance."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    equal = 1 - np.bitwise_count(x & LANES).sum(axis=-1, dtype=np.int64) / PERMUTATIONS
    return (equal - 2.0**-BITS) / (1 - 2.0**-BITS)


SIGNED = f"{UID} long, doc_id long, n long, digest binary, sig binary, bands binary"


def signed(rows: DataFrame) -> DataFrame:
    """`SIGNED` rows; the empty set has no digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for i, j in slices(offsets):
                s, first = shingle_sets(Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True))
                n = np.diff(first)
                some = np.flatnonzero(n)
                m = minima(s, first[:-1][some])
                sig, bands = pack_bits(m), band_keys(m)
                digest, sigs, keys = ([None] * (j - i) for _ in range(3))
                for k, t in enumerate(some):
                    digest[t], sigs[t], keys[t] = xxhash.xxh3_128_digest(s[first[t] : first[t + 1]].tobytes()), sig[k].tobytes(), bands[k].tobytes()
                part = batch.slice(i, j - i)
                yield pa.record_batch([part.column(UID), part.column("doc_id"), pa.array(n), *(pa.array(x, pa.binary()) for x in (digest, sigs, keys))], [UID, "doc_id", "n", "digest", "sig", "bands"])

    return rows.mapInArrow(tidy(run), SIGNED)


MEMBERS = "bucket long, node long, hub long, size long"


def buckets(nodes: DataFrame, slots: int) -> DataFrame:
    """`MEMBERS`: each band bucket of two nodes or more, with its smallest node as hub."""
    record = np.dtype([("key", "<u8"), ("node", "<i8")])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            r = np.concatenate(held)
            r = r[np.argsort(r["key"], kind="stable")]
            found = list(cut(r["key"], r, slots))
            for i in range(0, len(found), 256):
                yield pa.record_batch([pa.array([s for s, _ in found[i : i + 256]], pa.int32()), pa.array([d for _, d in found[i : i + 256]], pa.binary())], ["slot", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            r = np.empty((batch.num_rows, BANDS), record)
            r["key"] = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.uint64).reshape(-1, BANDS)
            r["node"] = batch.column("node").to_numpy()[:, None]
            held.append(r.reshape(-1))
            n += r.size
            if n >= BLOCK_RECORDS:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(x, record) for b in batches for x in b.column("data").to_pylist()]
        if not parts:
            return
        r = np.concatenate(parts)
        r = r[np.lexsort((r["node"], r["key"]))]
        starts = groups(r["key"])
        size = np.diff(np.append(starts, len(r)))
        many = repeated(size > 1, starts, len(r))
        out = [r["key"].view(np.int64), r["node"], repeated(r["node"][starts], starts, len(r)), repeated(size, starts, len(r))]
        out = [np.ascontiguousarray(x[many]) for x in out]
        for i in range(0, len(out[0]), 1 << 16):
            yield pa.record_batch([pa.array(x[i : i + (1 << 16)]) for x in out], ["bucket", "node", "hub", "size"])

    sent = nodes.select("node", "bands").mapInArrow(tidy(send), "slot int, data binary")
    return sent.repartitionById(slots, "slot").mapInArrow(tidy(match), MEMBERS)


def _estimated(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v, su, sv) whose signatures pass, with `est`; without the signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("su", "sv"))
            est = estimates(a, b)
            ok = pa.array(est >= LEAST_ESTIMATE)
            yield pa.record_batch([batch.column("u").filter(ok), batch.column("v").filter(ok), pa.array(est).filter(ok)], ["u", "v", "est"])

    return pairs.select("u", "v", "su", "sv").mapInArrow(tidy(run), "u long, v long, est double")


def hub_pairs(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """(u, v): each node with the most similar of its hubs."""
    pairs = members.filter("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    pairs = pairs.join(sigs.select(F.col("node").alias("v"), F.col("sig").alias("sv")), "v").join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("su")), "u")
    return _estimated(pairs).groupBy("u").agg(F.max_by("v", F.struct("est", "v")).alias("v"))


def met(members: DataFrame, roots: DataFrame, sigs: DataFrame) -> DataFrame:
    """Rows (bucket, low, high, own, node, root, sig) of buckets with two components or more, a group for each pair of chunks (of most buckets: one).

    Nodes of a bucket's largest component can only be linked to its other nodes. So these have the first chunks, the largest component has the
    others, and no pair of the latter is made: with few nodes outside, a large bucket costs little more than its size."""
    placed = members.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    alive = placed.join(_mixed(placed), "bucket")
    chunks = lambda n: F.ceil(n / CHUNK).cast("int")
    one, outside = F.col("size") <= CHUNK, F.col("root") != F.col("largest")
    alive = alive.withColumns({"before": F.when(one, 1).otherwise(chunks(F.col("size") - F.col("most"))), "after": F.when(one, 0).otherwise(chunks(F.col("most")))})
    own = F.when(one, 0).when(outside, F.pmod(F.xxhash64("node"), F.col("before"))).otherwise(F.col("before") + F.pmod(F.xxhash64("node"), F.col("after"))).cast("int")
    last = F.when(one, 0).when(outside, F.col("before") + F.col("after") - 1).otherwise(F.col("before") - 1)
    pairs = alive.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return pairs.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "root").join(sigs, "node").select(*GROUP, "own", "node", "root", "sig")


def _mixed(placed: DataFrame) -> DataFrame:
    """(bucket, largest, most, size) of rows (bucket, root): buckets with two components or more, their largest one, its nodes and all nodes, as a written table."""
    counts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    found = counts.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("size"), F.count("*").alias("roots"))
    return materialize(found.filter("roots > 1").drop("roots"), small=True)


GROUP = ["bucket", "low", "high"]


def _grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    """Rows of each group, from batches that are sorted by group."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if held and held[0][:3] != row[:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _crossing(group: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, estimate) of a group's pairs across components whose estimate passes, i before j, a block of i at a time."""
    own, node, root = (np.array([g[k] for g in group]) for k in (3, 4, 5))
    sig = np.frombuffer(b"".join(g[6] for g in group), np.uint64).reshape(len(group), -1)
    between = group[0][1] != group[0][2]
    for i in range(0, len(group), 128):
        a = np.arange(i, min(i + 128, len(group)))
        for k in range(i, len(group), 1024):
            c = np.arange(k, min(k + 1024, len(group)))
            wanted = (root[a, None] != root[c]) & (a[:, None] < c)
            if between:
                wanted &= own[a, None] != own[c]
            if not wanted.any():
                continue
            est = estimates(sig[a, None, :], sig[c][None])
            p, q = np.nonzero(wanted & (est >= LEAST_ESTIMATE))
            if len(p):
                yield a[p], c[q], est[p, q]


def best_partners(groups_: DataFrame) -> DataFrame:
    """(bucket, low, high, node, partner, est): each node of a group with its best partner across components, if any passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, [*GROUP, "own", "node", "root", "sig"]):
            best, partner = np.zeros(len(group)), np.zeros(len(group), np.int64)
            node = np.array([g[4] for g in group])
            for i, j, est in _crossing(group):
                for x, y in ((i, j), (j, i)):
                    order = np.argsort(est)  # the last one put is the best
                    x, y, e = x[order], y[order], est[order]
                    better = e > best[x]
                    best[x[better]], partner[x[better]] = e[better], node[y[better]]
            on = np.flatnonzero(best)
            yield pa.record_batch([*(pa.array([g] * len(on), t) for g, t in zip(group[0][:3], (pa.int64(), pa.int32(), pa.int32()))), pa.array(node[on]), pa.array(partner[on]), pa.array(best[on])], [*GROUP, "node", "partner", "est"])

    dealt = groups_.repartition(*GROUP).sortWithinPartitions(*GROUP, "root")
    return dealt.mapInArrow(tidy(run), "bucket long, low int, high int, node long, partner long, est double")


def prints(sets: DataFrame) -> DataFrame:
    """(node, print) of sets (node, shingles): the shingles' upper bits in order, 16 of each in sets of at most `SHORT_SET`, else 32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
            out = [b"\1" + (x >> np.uint64(48)).astype("<u2").tobytes() if len(x) <= SHORT_SET else b"\2" + (x >> np.uint64(32)).astype("<u4").tobytes() for x in all_]
            yield pa.record_batch([batch.column("node"), pa.array(out, pa.binary())], ["node", "print"])

    return sets.select("node", "shingles").mapInArrow(tidy(run), "node long, print binary")


def hopeful(groups_: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(bucket, low, high, node): nodes of groups with prints that may have a link across components.

    Shingles whose print is in the partner's are at least those that both sets share, so no pair at the threshold is lost.
    A pair with a set that has no print may be one. A node needs one such partner: pairs of two nodes that have one aren't looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, [*GROUP, "own", "node", "root", "sig", "print"]):
            wide = [g[7] is not None and g[7][:1] == b"\2" for g in group]
            sets = [None if g[7] is None else np.frombuffer(g[7], "<u4" if w else "<u2", offset=1) for g, w in zip(group, wide)]
            size, may = np.array([0 if x is None else len(x) for x in sets]), np.array([False] * len(group))
            for i, j, _ in _crossing(group):
                for a in np.unique(i):
                    near = j[i == a]
                    near = near[~(may[near] & may[a])]
                    unknown = np.array([sets[a] is None or sets[b] is None for b in near], bool)
                    if unknown.any():
                        may[a] = may[near[unknown]] = True
                    near = near[~unknown]
                    # an overlap can't be larger than the smaller set
                    near = near[100 * np.minimum(size[near], size[a]) >= percent * np.maximum(size[near], size[a])]
                    for narrow in (False, True):
                        of = [b for b in near if (wide[a] and wide[b]) != narrow]
                        if not of:
                            continue
                        mine, *theirs = (sets[k] >> np.uint32(16) if narrow and wide[k] else sets[k] for k in (a, *of))
                        cat, starts = np.concatenate(theirs), np.concatenate(([0], np.cumsum(size[of])[:-1]))
                        at = np.minimum(np.searchsorted(mine, cat), size[a] - 1)
                        both = np.add.reduceat((mine[at] == cat).astype(np.int64), starts)
                        ok = np.array(of)[100 * both >= percent * (size[a] + size[of] - both)]
                        if len(ok):
                            may[a] = may[ok] = True
            on = np.flatnonzero(may)
            yield pa.record_batch([*(pa.array([g] * len(on), t) for g, t in zip(group[0][:3], (pa.int64(), pa.int32(), pa.int32()))), pa.array([group[k][4] for k in on], pa.int64())], [*GROUP, "node"])

    dealt = groups_.repartition(*GROUP).sortWithinPartitions(*GROUP, "root")
    return dealt.mapInArrow(tidy(run), "bucket long, low int, high int, node long")


def links_in_place(groups_: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(u, v, sure): links across components, from groups with full sets; two components of a group are linked once. Pairs with a set that wasn't brought aren't sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, [*GROUP, "own", "node", "root", "sig", "shingles"]):
            sets = [None if g[7] is None else np.frombuffer(g[7], np.uint64) for g in group]
            size, node = np.array([0 if x is None else len(x) for x in sets]), [g[4] for g in group]
            over: dict[int, int] = {g[5]: g[5] for g in group}

            def top(x: int, over=over) -> int:
                while over[x] != x:
                    over[x] = over[over[x]]
                    x = over[x]
                return x

            found = []
            for i, j, _ in _crossing(group):
                for a in np.unique(i):
                    near = [b for b in j[i == a] if top(group[a][5]) != top(group[b][5])]
                    found += [(node[a], node[b], False) for b in near if sets[a] is None or sets[b] is None]
                    if sets[a] is None or not (near := [b for b in near if sets[b] is not None]):
                        continue
                    cat, starts = np.concatenate([sets[b] for b in near]), np.concatenate(([0], np.cumsum(size[near])[:-1]))
                    at = np.minimum(np.searchsorted(sets[a], cat), size[a] - 1)
                    both = np.add.reduceat((sets[a][at] == cat).astype(np.int64), starts)
                    for b, n in zip(near, both):
                        if 100 * n >= percent * (size[a] + size[b] - n) and (x := top(group[a][5])) != (y := top(group[b][5])):
                            over[x] = y
                            found.append((node[a], node[b], True))
            yield pa.record_batch([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["u", "v", "sure"])

    dealt = groups_.repartition(*GROUP).sortWithinPartitions(*GROUP, "root")
    return dealt.mapInArrow(tidy(run), "u long, v long, sure boolean")


def _rarity(sets: DataFrame, counters: int) -> np.ndarray:
    """How many shingles of all sets fall to each counter: one row per counter is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for x in batch.column("shingles").to_pylist():
                np.add.at(total, _counter(np.frombuffer(x, np.uint64), counters), 1)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])

    rows = sets.select("shingles").mapInArrow(tidy(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(counters, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def _counter(shingles: np.ndarray, counters: int) -> np.ndarray:
    return (shingles & np.uint64(counters - 1)).astype(np.int64)


def by_rare_shingles(sets: DataFrame, roots: DataFrame, percent: int = PERCENT, counters: int = SKETCH) -> DataFrame:
    """`MEMBERS`-like rows (bucket, node, size): nodes grouped by shingles, so that every pair that is similar enough meets in a group.

    In any one order of all shingles, two sets of n and m that are similar enough share one of the first n - ceil(n t) + 1 of the
    one and of the first m - ceil(m t) + 1 of the other (t: the threshold). The order here is from rare to common. At the first one
    that they share, places i and j, at least n - i and m - j shingles are left for the overlap, so the smaller set's
    `reach`, the largest partner that its place allows, covers its own size: a group without such a node holds no pair."""
    sent = sets.sparkSession.sparkContext.broadcast(_rarity(sets, counters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for node, root, x in zip(batch.column("node").to_pylist(), batch.column("root").to_pylist(), batch.column("shingles").to_pylist()):
                s = np.frombuffer(x, np.uint64)
                n, c = len(s), counts[_counter(s, counters)]
                order = np.lexsort((s, c))[: n + percent * -n // 100 + 1]  # n - ceil(n t) + 1
                place = np.arange(len(order))
                able = (n - place) * (100 + percent) // percent - n >= n
                some = c[order] > 1  # a shingle of one set only groups nobody
                for held, values in zip(out, (s[order][some].view(np.int64), np.full(some.sum(), node), np.full(some.sum(), root), able[some])):
                    held.append(values)
            columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
            yield pa.record_batch([*(pa.array(x, pa.int64()) for x in columns[:3]), pa.array(columns[3].astype(bool))], ["bucket", "node", "root", "able"])

    rows = materialize(sets.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "shingles").mapInArrow(tidy(run), "bucket long, node long, root long, able boolean"))
    groups_ = rows.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.max("able").alias("able"), F.count("*").alias("size")).filter("a <> b and able").select("bucket", "size")
    return materialize(rows.select("bucket", "node").join(materialize(groups_), "bucket").select("bucket", "node", "size"))


def _few(rows: DataFrame) -> DataFrame:
    """A written table of row keys, to be broadcast if it has at most `MOST_BROADCAST_NODES` rows."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST_NODES else rows


def full_sets(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of some nodes, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for i, j in slices(offsets):
                s, first = shingle_sets(Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True))
                yield pa.record_batch([batch.column(UID).slice(i, j - i), pa.array([s[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())], ["node", "shingles"])

    needed = materialize(nodes.select(F.col("node").alias(UID)).distinct(), small=True)
    picked = rows.select(UID, "text").join(_few(needed), UID, "left_semi")
    return materialize(picked.mapInArrow(tidy(run), "node long, shingles binary"), "none")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough: one set travels to the other for each pair."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("su").to_pylist(), batch.column("sv").to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(ok, pa.bool_())
            yield pa.record_batch([batch.column("u").filter(mask), batch.column("v").filter(mask)], ["u", "v"])

    out = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
    return out.select("u", "v", "su", "sv").mapInArrow(tidy(compare), "u long, v long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node")))


def linked(members: DataFrame, roots: DataFrame, sigs: DataFrame, rows: DataFrame) -> DataFrame:
    """Roots after all links across components between the members of each bucket."""
    best = materialize(best_partners(met(members, roots, sigs)))
    if best.isEmpty():
        return roots
    pairs = materialize(best.groupBy(F.col("node").alias("u")).agg(F.max_by("partner", F.struct("est", "partner")).alias("v")), small=True)
    sets = full_sets(rows, best.select("node"))  # partners are nodes of the same group, so they are there too
    roots = merged(roots, confirmed(pairs, sets))
    brought = sets.filter(F.octet_length("shingles") <= 8 * BIG_SET)
    # full sets would travel to each of a node's groups; most partners are told apart by a quarter of them
    groups_ = materialize(met(members, roots, sigs).join(best.select(*GROUP, "node"), [*GROUP, "node"], "left_semi"))
    some = materialize(hopeful(groups_.join(prints(brought), "node", "left")), small=True)
    if not some.isEmpty():
        brought = brought.join(_few(materialize(some.select("node").distinct(), small=True)), "node", "left_semi")
        links = materialize(links_in_place(groups_.join(some, [*GROUP, "node"], "left_semi").join(brought, "node", "left")))
        unsure = materialize(links.filter("not sure").select("u", "v").distinct(), small=True)
        sure = links.filter("sure").select("u", "v")
        if not links.isEmpty():  # a join would shuffle all sets for no pair
            roots = merged(roots, sure if unsure.isEmpty() else sure.unionByName(confirmed(unsure, sets)))
    drop_written(sets)
    return roots


def node_roots(nodes: DataFrame, members: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root) of all nodes with links."""
    sigs = nodes.select("node", "sig")
    pairs = materialize(hub_pairs(members, sigs))
    sets = full_sets(rows, _ends(pairs))
    roots = forest_roots(confirmed(pairs, sets))
    drop_written(sets)
    roots = linked(members.filter(F.col("size") <= CHUNK), roots, sigs, rows)
    large = members.filter(F.col("size") > CHUNK).select("bucket", "node")
    placed = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = materialize(placed.join(_mixed(placed), "bucket", "left_semi").select("node").distinct(), small=True)
    if left.isEmpty():
        return roots
    sets = full_sets(rows, left)
    regrouped = by_rare_shingles(sets, roots)
    drop_written(sets)
    return linked(regrouped, roots, sigs, rows)


def near_groups(rows: DataFrame, slots: int) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, head) for rows of `keyed`: head is the row key of the group's first document."""
    tune(rows.sparkSession)
    all_ = materialize(signed(rows.select(UID, "doc_id", "text")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", UID)).alias("first")
    same = materialize(all_.filter("digest is not null").groupBy("digest").agg(F.min(UID).alias("node"), first))
    nodes = materialize(all_.join(same.select(F.col("node").alias(UID)), UID, "left_semi").select(F.col(UID).alias("node"), "sig", "bands"))
    members = materialize(buckets(nodes, slots))
    roots = node_roots(nodes, members, rows)
    # tables are written before they meet a key that many rows share: Spark splits such a join where both sides are plain
    sets = materialize(same.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), "first"))
    heads = materialize(sets.groupBy("root").agg(F.min("first").alias("first")))
    groups_ = materialize(sets.select("digest", "root").join(heads, "root").select("digest", F.col("first.doc_id").alias("component_id"), F.col(f"first.{UID}").alias("head")))
    member = all_.select(UID, "doc_id", F.col("n").alias("n_shingles"), "digest").join(groups_, "digest", "left")
    return member.select(UID, "doc_id", "n_shingles", F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("head", UID).alias("head"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that come first in their group of near duplicates, with the columns of `docs`."""
    found = near_groups(keyed(docs, id_col, text_col), reducers(docs))
    dropped = materialize(found.filter(F.col("head") != F.col(UID)).select(UID))
    return restored(carried(docs, id_col, text_col).join(_few(dropped), UID, "left_anti"), docs, text_col)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document's group of near duplicates."""
    docs = table(spark, sf_dir, "documents")
    found = near_groups(keyed(docs, "doc_id", "text"), reducers(docs))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
ORACLE = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
             ELSE [array_to_string(w[i : i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {SHINGLE - 2})] END) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {PERCENT} * (na.n + nb.n - c)),
t AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, t.b FROM r JOIN t ON r.c = t.a)
SELECT doc_id, any_value(n) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept FROM r JOIN n USING (doc_id) GROUP BY doc_id
"""
