"""Token counts (10): pieces are counted once per distinct pre-token and joined to per-document frequencies.

1. Tasks count their pre-tokens (text between ASCII white space); a shuffle adds the counts up.
2. The tokenizer runs over the distinct pre-tokens only, each once, and keeps the number of pieces.
3. Per document, pre-token frequencies meet those numbers. The commonest pre-tokens, `HEAD` of them and
   `HEAD_BYTES` bytes each at most, come as a broadcast table and are summed where the text is read, so no hot
   key is shuffled; all others, long ones too, are exploded, joined and summed. No token ids are made for documents.

Defined results: null and empty texts have 0 tokens and 0 bytes; rows with the same or no id are counted
on their own; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UID, keyed, materialize, table, tidy, tune
from tidemark.llm.line_dedup import texts_of
from tidemark.llm.tokens import path, pieces_of

LIMIT = 2048
#: Pre-tokens that are broadcast with their number of pieces, and the bytes of the longest: under 40 MB, whatever the corpus.
HEAD, HEAD_BYTES = 400_000, 64
#: Distinct pre-tokens that a task holds before it passes their counts on.
HELD = 400_000


def pre_token_counts(rows: DataFrame) -> DataFrame:
    """(pre_token, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["pre_token", "n"])

        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in texts_of(batch):
                counts.update(text.split())
                if len(counts) >= HELD:
                    yield flush()
                    counts.clear()
        if counts:
            yield flush()

    return rows.select("text").mapInArrow(tidy(run), "pre_token binary, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))


def with_pieces(counts: DataFrame, file: str) -> DataFrame:
    """(pre_token, n, pieces): the library's number of pieces of each distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = pieces_of(file, "word").tokenizer
        for batch in batches:
            texts = [x.decode("utf-8", "replace") for x in batch.column("pre_token").to_pylist()]
            n = [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            yield pa.record_batch([batch.column("pre_token"), batch.column("n"), pa.array(n, pa.int64())], ["pre_token", "n", "pieces"])

    return counts.mapInArrow(tidy(run, pieces=True), "pre_token binary, n long, pieces long")


def common_pre_tokens(pieces: DataFrame, head: int) -> dict[bytes, int]:
    """The commonest pre-tokens of at most `HEAD_BYTES` bytes with their pieces: at most `head`, cut where a histogram of counts says so."""
    step = F.floor(F.log2("n") * 16).cast("int")
    pieces = pieces.filter(F.octet_length("pre_token") <= HEAD_BYTES)
    total, least = 0, None
    for b, n in sorted(map(tuple, pieces.groupBy(step.alias("b")).count().collect()), reverse=True):  # 1,024 rows at most
        if total + n > head:
            break
        total, least = total + n, b
    if least is None:
        return {}
    found = pieces.filter(step >= least).select("pre_token", "pieces").toArrow()
    return dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, head: int = HEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_bytes, n_tokens, over_limit) of every text, for a vocabulary that drops white space."""
    spark = docs.sparkSession
    tune(spark)
    rows = keyed(docs, id_col, text_col)
    pieces = materialize(with_pieces(pre_token_counts(rows), vocabulary))
    common = spark.sparkContext.broadcast(common_pre_tokens(pieces, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in batches:
            owner, keys, counts, sums, sizes, ids = [], [], [], [], [], []
            for u, d, text in zip(batch.column(UID).to_pylist(), batch.column("doc_id").to_pylist(), texts_of(batch)):
                parts = text.split()
                found = list(map(known.get, parts))
                rest: Counter[bytes] = Counter()
                if None in found:
                    rest.update([p for p, n in zip(parts, found) if n is None])
                # a document's own row has a key with a space, which no pre-token has
                owner += [u] * (1 + len(rest))
                keys += [b" %d" % u, *rest]
                counts += [None, *rest.values()]
                sums += [sum(filter(None, found))] + [None] * len(rest)
                sizes += [len(text)] + [None] * len(rest)
                ids += [d] + [None] * len(rest)
            yield pa.record_batch([pa.array(owner, pa.int64()), pa.array(keys, pa.binary()), *(pa.array(x, pa.int64()) for x in (counts, sums, sizes, ids))], [UID, "pre_token", "n", "known", "n_bytes", "doc_id"])

    read = rows.mapInArrow(tidy(run), f"{UID} long, pre_token binary, n long, known long, n_bytes long, doc_id long")
    joined = read.join(pieces.select("pre_token", "pieces"), "pre_token", "left")
    tokens = F.coalesce("known", F.col("n") * F.col("pieces"))
    total = joined.groupBy(UID).agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
    return total.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: tokens of every document under the lower-casing word vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), path("word_bpe_49k.json")).drop(UID)
