"""Token-id output (5): canonical length-limited Huffman code over global id counts, in independent blocks.

Texts are tokenized once; ids are counted over the whole corpus; package-merge gives code lengths of at
most `MAX_BITS`, and canonical order gives the codes, so a file needs the lengths only. Documents are
range-partitioned by id and coded in blocks of about `BLOCK_IDS` ids.

Output folder (written by Spark, so any store and its commit protocol serve): `codebook` holds the lengths,
`blocks` one row per block: part, number in its part, ids before it in its part, and the block's bytes:

    magic "TDB1" | u4 interval | u4 documents | u8 ids | u8 bits | i8 doc id, u8 ids (per document; null id: the
    least i8) | u8 bit offset of every `interval`-th id | code bits, high bit first, zero-padded

A block decodes by itself; its checkpoints decode independently of each other, all at once, by table lookup.

Defined results: a null text is an empty one (its end id only); rows with the same id are documents in the order
of their rows; null ids come first; an empty table gives empty files.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UID, drop_written, keyed, materialize, reducers, shared_dir, table, tidy, tune
from tidemark.llm.line_dedup import texts_of
from tidemark.llm.tokens import path, pieces_of

END_ID = 1
MAX_BITS, BLOCK_IDS, INTERVAL = 16, 1 << 19, 128
NO_ID = -(1 << 63)
HEAD = struct.Struct("<4sIIQQ")


def tokenized(rows: DataFrame, vocabulary: str, kind: str, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, n, width, ids): every text's packed ids with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(vocabulary, kind)
        end, width = np.array([end_id], pieces.dtype).tobytes(), pieces.dtype.itemsize
        for batch in batches:
            ids = [x + end for x in pieces.encode(texts_of(batch))]
            n = [len(x) // width for x in ids]
            yield pa.record_batch([batch.column(UID), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array([width] * len(n), pa.int32()), pa.array(ids, pa.binary())], [UID, "doc_id", "n", "width", "ids"])

    return rows.mapInArrow(tidy(run, pieces=True), f"{UID} long, doc_id long, n long, width int, ids binary")


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often each id stands in the corpus: one row per id and task at most is shuffled, one per id collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{batch.column('width')[0].as_py()}"))
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    rows = ids.select("width", "ids").mapInArrow(tidy(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    at, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    out = np.zeros(int(at.max()) + 1 if len(at) else 1, np.int64)
    out[at] = n
    return out


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `most` bits (package-merge); 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    if n > 1 << most:
        raise ValueError(f"{n} ids don't fit codes of {most} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.float64)
    leaf_first: list[np.ndarray] = []  # of each level: is the i-th lightest item a leaf?
    packages = np.zeros(0)
    for _ in range(most):
        items = np.concatenate((weight, packages))
        order = np.argsort(items, kind="stable")
        leaf_first.append(order < n)
        items = items[order]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * n - 2
    bits = np.zeros(n, np.uint8)
    for leaves in reversed(leaf_first):
        k = int(leaves[:take].sum())
        bits[:k] += 1
        take = 2 * (take - k)
    out[used] = bits
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    out, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    used = np.flatnonzero(lengths)
    for i in used[np.argsort(lengths[used], kind="stable")]:
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        out[i] = code
        code += 1
    return out


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """For each run of `bits` bits, the id that it starts with and that id's length."""
    used = np.flatnonzero(lengths)
    bits = int(lengths.max(initial=1))
    order = used[np.argsort(lengths[used], kind="stable")]
    span = 1 << (bits - lengths[order].astype(np.int64))
    ids = np.zeros(1 << bits, np.uint32)
    filled = np.repeat(order, span)
    ids[: len(filled)] = filled
    return bits, ids, lengths[ids].astype(np.int64)


def encode_block(doc_ids: list[int], sizes: list[int], ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, interval: int = INTERVAL) -> bytes:
    """The bytes of one block."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    start, bits = end - size, int(end[-1]) if len(end) else 0
    shifted = codes[ids] << (64 - (start & 31) - size).astype(np.uint64)
    word, n = start >> 5, (bits + 31 >> 5) + 1
    packed = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[:n]
    head = HEAD.pack(b"TDB1", interval, len(doc_ids), len(ids), bits)
    docs = np.array([[NO_ID if d is None else d for d in doc_ids], sizes], "<i8").T.tobytes()
    return head + docs + start[::interval].astype("<u8").tobytes() + packed.astype(">u4").tobytes()[: bits + 7 >> 3]


def decode_block(block: bytes, table: tuple[int, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Doc ids, sizes, and all ids of a block: its checkpoints advance side by side, a lookup each."""
    magic, interval, docs, n, bits = HEAD.unpack_from(block)
    if magic != b"TDB1":
        raise ValueError("not a block")
    pairs = np.frombuffer(block, "<i8", 2 * docs, HEAD.size).reshape(-1, 2)
    at = HEAD.size + 16 * docs
    lanes = -(-n // interval)
    pos = np.frombuffer(block, "<u8", lanes, at).astype(np.int64)
    body = np.frombuffer(block, np.uint8, offset=at + 8 * lanes)
    padded = np.zeros(len(body) + 8, np.uint8)
    padded[: len(body)] = body
    four = np.ndarray((len(body) + 4,), ">u4", padded, strides=(1,))
    wide, ids, sizes = table
    out = np.empty((interval, lanes), np.uint32)
    for step in range(interval):
        window = four[np.minimum(pos >> 3, len(body))].astype(np.int64)
        key = (window >> (32 - wide - (pos & 7))) & ((1 << wide) - 1)
        out[step] = ids[key]
        pos += sizes[key]
    return pairs[:, 0], pairs[:, 1], out.T.reshape(-1)[:n]


BLOCKS = "part int, number int, ids_before long, n_ids long, block binary"


def encoded(ids: DataFrame, lengths: np.ndarray, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of a table of `tokenized`, in ascending order of document ids."""
    spark = ids.sparkSession
    sent = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, codes = sent.value
        part, number, before = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        sizes: list[int] = []
        held: list[bytes] = []
        width, n = 2, 0

        def block() -> pa.RecordBatch:
            data = encode_block(docs, sizes, np.frombuffer(b"".join(held), f"<u{width}"), lengths, codes)
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([n], pa.int64()), pa.array([data], pa.binary())], ["part", "number", "ids_before", "n_ids", "block"])

        for batch in batches:
            for d, k, w, x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "width", "ids"))):
                if n and n + k > block_ids:
                    yield block()
                    number, before, n = number + 1, before + n, 0
                    docs, sizes, held = [], [], []
                docs.append(d), sizes.append(k), held.append(x)
                width, n = w, n + k
        if n:
            yield block()

    return ids.repartitionByRange(reducers(ids), F.asc_nulls_first("doc_id"), F.asc(UID)).sortWithinPartitions(F.asc_nulls_first("doc_id"), UID).mapInArrow(tidy(run), BLOCKS)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, kind: str, end_id: int = END_ID, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the corpus' ids to `folder` (`codebook` and `blocks`)."""
    spark = docs.sparkSession
    tune(spark)
    ids = materialize(tokenized(keyed(docs, id_col, text_col), vocabulary, kind, end_id))
    counts = id_counts(ids)
    lengths = code_lengths(counts, max(max_bits, int(np.count_nonzero(counts)).bit_length()))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/codebook")
    encoded(ids, lengths).write.option("compression", "none").parquet(f"{folder}/blocks")
    drop_written(ids)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): documents of a folder in their order; ids are little-endian unsigned 32-bit integers."""
    tune(spark)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    lengths = spark.read.schema("lengths binary").parquet(f"{folder}/codebook").first()[0]
    first, total = {}, 0
    for part, n in sorted(map(tuple, blocks.groupBy("part").agg(F.sum("n_ids")).collect())):  # one row per part
        first[part], total = total, total + n
    sent = spark.sparkContext.broadcast((np.frombuffer(bytes(lengths), np.uint8), first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, first = sent.value
        table = decode_table(lengths)
        for batch in batches:
            for part, before, block in zip(*(batch.column(c).to_pylist() for c in ("part", "ids_before", "block"))):
                docs, sizes, ids = decode_block(block, table)
                ends = np.cumsum(sizes)
                data = ids.astype("<u4").tobytes()
                yield pa.record_batch(
                    [
                        pa.array([None if d == NO_ID else d for d in docs.tolist()], pa.int64()),
                        pa.array(ends - sizes + first[part] + before, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([data[4 * (e - s) : 4 * e] for s, e in zip(sizes.tolist(), ends.tolist())], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids binary")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: write every document's ids to files, read them back, and describe each document by them."""
    folder = shared_dir(spark)
    write_token_files(table(spark, sf_dir, "documents"), folder, path("word_bpe_49k.json"), "word")
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
