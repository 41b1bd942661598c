"""Packing (6): documents in order of a space-filling curve, cut into sequences of a fixed length.

A document's vector is the mean of its token ids' hashed +-1 vectors, in `DIMS` dimensions; its place is
the Hilbert key of that point on a grid. Documents that lie near each other on the curve are packed side
by side: laid end to end along the curve and cut every `length` tokens, so that only the very last
sequence of the corpus has padding.

The curve is cut into buckets at quantiles of the keys, weighted by tokens and rows, so that buckets are about as much work
each, however long or short documents crowd in places. A light pass over (key, length) sums the tokens of each bucket, so
a bucket knows its first position and is packed on its own. Low bits of the sort key come from a hash of the
row, so a large group of equal texts spreads over buckets.

Defined results: a null text is an empty one (its end id only); rows with the same or no id are documents of
their own; an empty table gives an empty table. A sequence is padded to `length`, or not at all where its
own length is a power of two.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UID, keyed, materialize, mix, reducers, table, tidy, tune
from tidemark.llm.line_dedup import texts_of
from tidemark.llm.token_files import END_ID
from tidemark.llm.tokens import path, pieces_of

LENGTH = 2048
#: 3 x 14 bits of Hilbert key and 11 bits of row hash: 53 bits, which quantiles in doubles keep exactly.
DIMS, BITS, SPREAD = 3, 14, 11
#: Tokens that are as much work as a row itself.
ROW_TOKENS = 100


def hilbert_keys(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of points (dims x n integers below 2^bits): Gray-code transposition, then interleaved bits."""
    x = axes.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


#: Bits of a field in a packed sum of signs; longer documents are summed in parts.
FIELD = 21


def signs(ids: int, dims: int = DIMS) -> np.ndarray:
    """For each token id, which of its hashed +-1 entries are +1: a field of a 64-bit integer each."""
    h = mix(np.arange(ids, dtype=np.uint64) + np.uint64(1))
    return sum((((h >> np.uint64(7 * d)) & np.uint64(1)) << np.uint64(FIELD * d)).astype(np.int64) for d in range(dims))


def means(table: np.ndarray, flat: np.ndarray, n: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Mean vectors (dims x documents) of documents of n > 0 ids each, laid end to end in `flat`."""
    first, most = np.cumsum(n) - n, (1 << FIELD) - 1
    if n.max() > most:  # cut at `most` ids, then add the parts up
        parts = -(-n // most)
        of = np.repeat(np.arange(len(n)), parts)
        first = first[of] + (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * most
    sums = np.add.reduceat(table[flat], first)
    plus = np.stack([(sums >> (FIELD * d)) & most for d in range(dims)])
    if len(first) > len(n):
        plus = np.stack([np.bincount(of, p, len(n)) for p in plus])
    return (2 * plus - n) / n


def placed(rows: DataFrame, vocabulary: str, kind: str, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, n, width, ids, key): every text's ids and its place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(vocabulary, kind)
        width, end = pieces.dtype.itemsize, np.array([end_id], pieces.dtype).tobytes()
        vectors = signs(max(end_id + 1, pieces.tokenizer.get_vocab_size(with_added_tokens=True)))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [x + end for x in pieces.encode(texts_of(batch))]
            n = np.array([len(x) // width for x in ids], np.int64)
            mean = means(vectors, np.frombuffer(b"".join(ids), pieces.dtype), n)
            curve = hilbert_keys(np.minimum(((mean + 1) * (1 << (BITS - 1))).astype(np.int64), (1 << BITS) - 1))
            spread = (mix(batch.column(UID).to_numpy().astype(np.uint64)) >> np.uint64(64 - SPREAD)).astype(np.int64)
            yield pa.record_batch([batch.column(UID), batch.column("doc_id"), pa.array(n), pa.array([width] * len(n), pa.int32()), pa.array(ids, pa.binary()), pa.array((curve << SPREAD) | spread)], [UID, "doc_id", "n", "width", "ids", "key"])

    return rows.mapInArrow(tidy(run, pieces=True), f"{UID} long, doc_id long, n long, width int, ids binary, key long")


PIECES = f"{UID} long, doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary: str, kind: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in their sequences: columns of `PIECES`; ids are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    tune(spark)
    all_ids = materialize(placed(keyed(docs, id_col, text_col), vocabulary, kind, end_id))
    buckets = reducers(all_ids)
    all_ids = all_ids.withColumn("bucket", bucket_of(F.col("key"), token_cuts(all_ids, buckets)))
    first, total = {}, 0
    for b, n in sorted(map(tuple, all_ids.groupBy("bucket").agg(F.sum("n")).collect())):  # one row per bucket
        first[b], total = total, total + n
    sent = spark.sparkContext.broadcast(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = 0, None
        for batch in batches:
            out: list[tuple] = []
            for b, u, d, n, w, ids in zip(*(batch.column(c).to_pylist() for c in ("bucket", UID, "doc_id", "n", "width", "ids"))):
                if b != last:
                    at, last = sent.value[b], b
                data = np.frombuffer(ids, f"<u{w}").astype("<u4").tobytes()
                done = 0
                while done < n:
                    size = min(n - done, length - at % length)
                    out.append((u, d, done, size, data[4 * done : 4 * (done + size)], n, at // length, at % length))
                    done, at = done + size, at + size
            if out:
                types = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in PIECES.split(", ")])

    dealt = all_ids.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "key", "doc_id", UID)
    return dealt.mapInArrow(tidy(run), PIECES)


def token_cuts(ids: DataFrame, buckets: int) -> list[int]:
    """Keys that part the curve into `buckets` parts of about as much weight (tokens, and `ROW_TOKENS` for the row itself), in order.

    A row counts once for every `unit` of its weight, the rest by a chance that its row key decides, so the counts add up to the weight."""
    if buckets <= 1:
        return []
    weight = F.col("n") + ROW_TOKENS
    total = ids.agg(F.sum(weight)).first()[0] or 0
    unit = max(1, min(1024, total // (64 * buckets)))
    times = F.floor(weight / unit + F.pmod(F.xxhash64(UID), F.lit(4096)) / 4096.0).cast("int")
    weighted = ids.select("key", F.explode(F.array_repeat(F.lit(0), times)))
    return sorted({int(k) for k in weighted.approxQuantile("key", [i / buckets for i in range(1, buckets)], 0.25 / buckets)})


def bucket_of(key: Column, cuts: list[int]) -> Column:
    """How many of the cuts lie at or below a key: first among every so many cuts, then among those in between."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    at_most = lambda array: F.size(F.filter(array, lambda x: x <= key))
    parts = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    before = at_most(longs([p[0] for p in parts]))
    return F.when(before == 0, 0).otherwise((before - 1) * step + at_most(F.get(F.array(*map(longs, parts)), before - 1)))


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, input_ids): the packed sequences themselves, each gathered from its pieces."""
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    data = F.aggregate("p", F.lit("").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    n = F.col("n_tokens")
    padding = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(F.lit(length) - n).cast("int")
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), padding))
    return whole.select("sequence_id", "n_tokens", F.concat(data, pad).alias("input_ids"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: where every document's pieces lie in sequences of 2048 tokens."""
    return described(pack(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), "byte"))


def described(pieces: DataFrame) -> DataFrame:
    """Pieces with a digest in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
