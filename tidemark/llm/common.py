"""Shared pieces of the corpus operators: table access, shared folders, and numpy text kernels.

The kernels work on whole Arrow batches: a batch's UTF-8 bytes are one array, words are found
by byte classes, and words and word windows get 64-bit hashes without a Python loop per word.
"""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Name of the internal row key; operators never let it reach their results.
UID = "__row"
#: Rows and bytes of one Arrow batch sent to Python: bounds a worker's memory whatever the texts' lengths.
BATCH_ROWS, BATCH_BYTES = 512, 2 << 20
#: Text bytes that one kernel call works on at a time (a single longer text is one call).
SLICE_BYTES = 2 << 20
#: Input bytes per reducer of the packed shuffles.
BYTES_PER_REDUCER = 32 << 20
#: Parts of a table's files at least, however small they are.
LEAST_SPLITS = 16
#: Bytes that a writer of a table between steps holds before it writes them.
ROW_GROUP_BYTES = 32 << 20
#: ASCII white space of the word contracts: space and \x09-\x0D.
SPACE = bytes([32, 9, 10, 11, 12, 13])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark (the folder may be in any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, and pin how files are split.

    Row keys number rows by partition. Spark splits files by the cores that it has at the moment, unless a number of partitions
    is set; with it, a lost executor doesn't change the splits, so a row keeps its key whenever its table is read.
    """
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(max(LEAST_SPLITS, spark.sparkContext.defaultParallelism)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def application_dir(spark: SparkSession) -> str:
    """This application's folder below the cluster's shared folder, as `spark.checkpoint.dir` names it.

    Only a local session, whose driver and executors are one process, may leave it unset; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: operators need a folder that the driver and all executors share")
        base = "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession) -> str:
    """A new folder of this application in the shared folder."""
    return f"{application_dir(spark)}/{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_written(spark: SparkSession) -> None:
    """Delete all tables that this application's operators wrote between their steps; results that aren't read yet go with them."""
    _delete(spark, application_dir(spark))


def materialize(df: DataFrame, codec: str = "zstd", small: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, and survives lost executors. A `small` table (links, numbers) goes to an eighth as many files as a shuffle has partitions."""
    spark = df.sparkSession
    path = shared_dir(spark)
    if small:
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    df.write.option("compression", codec).option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def _give_back() -> None:
    """Return this process' freed memory to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def _drop_pieces() -> None:
    """Forget the piece table that another operator left in this worker."""
    if tokens := sys.modules.get("tidemark.llm.tokens"):
        tokens.pieces_of.cache_clear()


def tidy(run: Callable[[Iterator], Iterator], pieces: bool = False) -> Callable[[Iterator], Iterator]:
    """A partition function that gives memory back when its partition ends. Workers serve one operator after another: unless it needs it (`pieces`), it drops the piece table first."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not pieces:
            _drop_pieces()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table that `materialize` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if "/tidemark-" in folder:
            _delete(spark, folder)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a plan's size; for a file scan, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def reducers(df: DataFrame, per: int = BYTES_PER_REDUCER) -> int:
    """Number of reducers of a packed shuffle over `df`: in proportion to its bytes, never below the session's setting."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(100_000, -(-plan_bytes(df) // per)))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row key, id, text) of `docs`: other columns never enter an operator, so their names can't clash.

    The row key numbers rows by partition and position, so repeated and null ids stay apart;
    `docs` has to be a scan or a written table, whose rows come in the same order if read again.
    """
    return docs.select(
        F.monotonically_increasing_id().alias(UID),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def carried(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`keyed` rows that carry the other columns of `docs` along in a struct, whatever their names."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(
        F.monotonically_increasing_id().alias(UID),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.struct(*rest).alias("rest"),
    )


def restored(rows: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of `docs` from rows of `carried`."""
    rest = rows.schema["rest"].dataType.names
    of = iter(range(len(rest)))
    return rows.select(*[F.col("text").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col(f"rest.`{rest[next(of)]}`").alias(c) for c in docs.columns])


def with_fields(schema: StructType, *more: tuple[str, str]) -> StructType:
    """A schema with fields (name, type) added, or put in place of those of the same name."""
    names = {n for n, _ in more}
    return StructType([f for f in schema if f.name not in names] + list(StructType.fromDDL(", ".join(f"{n} {t}" for n, t in more)))) if more else schema


# --- texts as bytes -------------------------------------------------------------------------


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string array's bytes and its n + 1 offsets (nulls: empty texts)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n, wide = len(col), pa.types.is_large_string(col.type)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes, or of one row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def is_delimiter(*codes: int | range) -> np.ndarray:
    """A table of 256 booleans: which bytes end words."""
    out = np.zeros(256, bool)
    for c in codes:
        out[list(c) if isinstance(c, range) else c] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = is_delimiter(*SPACE)


class Words:
    """Words of some texts: byte range of each, and the words' range of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, delimiter: np.ndarray = WHITE, lower: bool = False):
        self.data = LOWER[data] if lower else data
        n = len(data)
        word = ~delimiter[self.data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[inner], after[inner - 1] = False, False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)  # of each text's words, and the end of the last
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.data, self.start, self.end)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)


U = np.uint64
K1, K2, K3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit depends on every other."""
    x = x ^ (x >> U(30))
    x = x * K2
    x ^= x >> U(27)
    x *= K3
    x ^= x >> U(31)
    return x


LONG = 2048


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, taken 8 bytes at a time over all ranges at once."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = end - start
    h = mix((eight[start] & MASKS[np.minimum(size, 8)]) + size.astype(np.uint64) * K1)
    rest, at = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(rest):
        left = size[rest] - at
        h[rest] = mix((h[rest] * K1) ^ (eight[start[rest] + at] & MASKS[np.minimum(left, 8)]))
        rest, at = rest[left > 8], at + 8
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return h


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of `size` consecutive word hashes (also of those that cross texts)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = {1: h}
    step, c = 1, int(K1)
    while step * 2 <= size:
        a = powers[step]
        powers[step * 2] = a[: len(a) - step] + a[step:] * U(pow(c, step, 1 << 64))
        step *= 2
    out, at = np.zeros(n, np.uint64), 0
    for step in sorted(powers, reverse=True):
        while size - at >= step:
            out += powers[step][at : at + n] * U(pow(c, at, 1 << 64))
            at += step
    return mix(out + U(size))


def windows(words: Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words that start a window within their text, and the windows' hashes."""
    w = window_hashes(h, size)
    if not len(w):
        return np.zeros(0, np.int64), w
    last = np.repeat(words.first[1:], words.count)[: len(w)]
    at = np.flatnonzero(np.arange(len(w)) + size <= last)
    return at, w[at]


def covered(n: int, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Which of n words lie in [at, at + size) for some of these ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return np.cumsum(edge[:n]) > 0


def kept_bytes(words: Words, text: int, keep: np.ndarray) -> bytes:
    """A text's kept words joined by one space; `keep` is over all words of the batch."""
    a, b = words.first[text], words.first[text + 1]
    take = np.flatnonzero(keep[a:b]) + a
    if not len(take):
        return b""
    start, end = words.start[take], words.end[take]
    size = end - start
    out = np.full(int(size.sum()) + len(take) - 1, 32, np.uint8)
    to = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    index = np.repeat(start - to, size) + (np.arange(int(size.sum())) + np.repeat(np.arange(len(take)), size))
    where = np.arange(int(size.sum())) + np.repeat(np.arange(len(take)), size)
    out[where] = words.data[index]
    return out.tobytes()
