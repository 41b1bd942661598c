"""Raw lines to typed rows: strict classification, rejects with reasons, reconciled and repeatable writes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scaled import parse_scaled
from tidemark.plans.datasets import DATASETS, DECIMALS, LAYOUT, LIVE, Dataset, Field
from tidemark.sources.raw import raw_files, raw_lines, with_partition
from tidemark.sources.store import delete, exists, folder_of, write_parts, written

REJECT_TEXT = 2000
MANIFEST = "path string, size long, mtime_ns long, processed_at timestamp, total_lines long, rows_by_type map<string,long>, rejects long"
#: Raw files that are compacted at once, and their bytes.
BATCH_FILES, BATCH_BYTES = 1000, 64 << 30
#: Bytes that a writer of classified lines holds at most before it writes them.
GROUP_BYTES = 16 << 20
#: What is read back of the stored datasets: no column but where rows lie.
STORED = "ts_wall long, date string, part string"
#: Output bytes expected of a raw byte, before anything is read.
DRY_RUN_RATIO = 0.85


def _typed(json: Column, kind: str) -> Column:
    """A JSON value of exactly this kind, or NULL: no number passes as text, no `5.0` or `true` as an integer."""
    of = F.schema_of_variant(json)
    text = F.when(of == "STRING", F.try_variant_get(json, "$", "string"))
    if kind == "int":
        return F.when(of == "BIGINT", F.try_variant_get(json, "$", "bigint"))
    if kind == "bool":
        return F.when(of == "BOOLEAN", F.try_variant_get(json, "$", "boolean"))
    return text if kind == "str" else parse_scaled(text, DECIMALS[kind])


def _value(f: Field) -> Column:
    if f.place == "const":
        return F.lit(LIVE)
    path = {"outer": ("outer", "$"), "inner": ("inner", "$"), "msg": ("inner", "$.msg")}[f.place]
    return _typed(F.try_variant_get(F.col(path[0]), f"{path[1]}.{f.name}", "variant"), f.kind)


def classify(lines: DataFrame) -> DataFrame:
    """Lines with `type` (NULL: rejected), `reason` (NULL: accepted) and a struct of fields per dataset.

    The first of these that holds decides: the line is no JSON object, it is a gap marker, it has no `raw`, `raw`
    is no JSON text, its type is unknown, a field of the type is missing or mistyped.
    """
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    out = lines.withColumn("outer", F.try_parse_json("line"))
    raw = F.try_variant_get("outer", "$.raw", "variant")
    marker = _typed(F.try_variant_get("outer", "$.marker", "variant"), "str")
    out = out.withColumns({"is_gap": F.coalesce(is_object(F.col("outer")) & (marker == "gap"), F.lit(False)), "inner": F.try_parse_json(_typed(raw, "str"))})
    kind = F.when(F.col("is_gap"), "gap").when(is_object(F.col("inner")), _typed(F.try_variant_get("inner", "$.type", "variant"), "str"))
    out = out.withColumn("kind", kind)
    out = out.withColumns({f"as_{d.name}": F.when(F.col("kind") == d.name, F.struct(*[_value(f).alias(f.name) for f in d.fields])) for d in DATASETS.values()})
    whole = F.lit(False)
    for d in DATASETS.values():
        fits = F.lit(True)
        for f in d.fields:
            fits = fits & F.col(f"as_{d.name}.{f.name}").isNotNull()
        whole = F.when(F.col("kind") == d.name, fits).otherwise(whole)
    reason = (
        F.when(~is_object(F.col("outer")), "bad_outer_json")
        .when(F.col("is_gap"), F.when(~whole, "schema_violation"))
        .when(raw.isNull(), "missing_field")
        .when(F.col("inner").isNull(), "bad_inner_json")
        .when(F.col("kind").isNull() | ~F.col("kind").isin(*DATASETS), "unhandled_type")
        .when(~whole, "schema_violation")
    )
    # a generator keeps filters on its outputs above it, so that none repeats the whole classification
    names = ["reason", "kind", *[f"as_{name}" for name in DATASETS]]
    out = out.withColumn("reason", reason).select(*lines.columns, F.inline(F.array(F.struct(*names))))
    return out.select(*lines.columns, F.when(F.col("reason").isNull(), F.col("kind")).alias("type"), "reason", *[f"as_{name}" for name in DATASETS])


def rows_of(classified: DataFrame, dataset: Dataset, *keep: str) -> DataFrame:
    """The typed rows of one dataset, with scales in the columns' metadata."""
    fields = [F.col(f"as_{dataset.name}.{f.name}").alias(f.name, metadata=f.stored.metadata) for f in dataset.fields]
    return classified.filter(F.col("type") == dataset.name).select(*fields, *keep)


def rejects_of(classified: DataFrame) -> DataFrame:
    """(source, line_number, reason, line) of refused lines; long lines are cut."""
    return classified.filter("reason is not null").select(F.col("path").alias("source"), "line_number", "reason", F.left("line", F.lit(REJECT_TEXT)).alias("line"))


def line_counts(lines: DataFrame) -> DataFrame:
    """(path, total_lines) of lines as they are read, whatever becomes of them."""
    return lines.groupBy("path").agg(F.count("*").alias("total_lines"))


def reconcile(lines: DataFrame, stored: DataFrame) -> DataFrame:
    """(path, total_lines, one count per type, rejects, reconciled) of each file, from its lines (path, total_lines) and what was stored of it (path, type, n; refused lines: type `rejects`)."""
    found = stored.groupBy("path").pivot("type", [*DATASETS, "rejects"]).agg(F.sum("n"))
    names = {**{f"n_{t}": t for t in DATASETS}, "rejects": "rejects"}
    out = lines.join(found, "path", "full_outer").select("path", F.coalesce("total_lines", F.lit(0)).alias("total_lines"), *[F.coalesce(t, F.lit(0)).alias(n) for n, t in names.items()])
    return out.withColumn("reconciled", reduce(lambda a, b: a + b, [F.col(n) for n in names]) == F.col("total_lines"))


def stored_counts(classified: DataFrame) -> DataFrame:
    """(path, type, n) of classified lines, as `reconcile` wants them, before anything is stored."""
    return classified.groupBy("path", F.coalesce("type", F.lit("rejects")).alias("type")).agg(F.count("*").alias("n"))


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest doesn't have as they are now (path, size and time of change)."""
    return files.join(manifest.select("path", "size", "mtime_ns"), ["path", "size", "mtime_ns"], "left_anti")


def processed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    return files.join(manifest.select("path", "size", "mtime_ns"), ["path", "size", "mtime_ns"], "left_semi")


def dry_run(files: DataFrame) -> DataFrame:
    """(files, input_bytes, est_output_bytes) of what a run would read."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("input_bytes"), (F.coalesce(F.sum("size"), F.lit(0)) * DRY_RUN_RATIO).cast("long").alias("est_output_bytes"))


def latest(manifest: DataFrame) -> DataFrame:
    """One entry per path, the newest."""
    newest = F.max_by(F.struct(*[c for c in manifest.columns if c != "path"]), F.struct("processed_at", "mtime_ns")).alias("e")
    return manifest.groupBy("path").agg(newest).select("path", "e.*")


@dataclass(frozen=True)
class CompactionResult:
    """Counts of a run, per file."""

    files: list[dict]

    @property
    def reconciled(self) -> bool:
        return all(f["reconciled"] for f in self.files)

    @property
    def summary(self) -> dict:
        """Sums over the files that add up: files, lines, rows, refused lines and their share in %, bytes in and out and their ratio; and how many files don't add up."""
        whole = [f for f in self.files if f["reconciled"]]
        total = lambda name: sum(f[name] for f in whole)
        out = {"files": len(whole), "mismatched": len(self.files) - len(whole), "total_lines": total("total_lines"), "rows": sum(total(f"n_{t}") for t in DATASETS), "rejects": total("rejects")}
        out |= {"input_bytes": total("size"), "output_bytes": total("output_bytes")}
        return out | {"ratio": out["output_bytes"] / max(1, out["input_bytes"]), "reject_percent": 100 * out["rejects"] / max(1, out["total_lines"])}


class Compactor:
    """Turns raw files into the parts `<out>/type=<t>/date=<d>/part=<file's name>`, rejects and manifest entries, some files at a time (`BATCH_FILES`, `BATCH_BYTES`).

    A file's part is replaced as a whole, also by nothing. What was written is read back and counted against the lines read;
    the manifest is written last and only for files whose lines add up, so a run that breaks off is repeated
    by the next one with the same result.
    """

    def __init__(self, spark: SparkSession, raw_root: str, out_root: str):
        self.spark, self.raw_root, self.out_root = spark, raw_root, out_root

    def manifest(self) -> DataFrame:
        if not exists(self.spark, f"{self.out_root}/manifest"):
            return self.spark.createDataFrame([], MANIFEST)
        return latest(self.spark.read.schema(MANIFEST).parquet(f"{self.out_root}/manifest"))

    def run(self, mode: str = "all", target: str | None = None, files: DataFrame | None = None) -> CompactionResult:
        """Compact what is pending; sizes and times are taken before the files are read."""
        files = raw_files(self.spark, self.raw_root, mode, target) if files is None else files
        todo = pending(files.filter("date is not null"), self.manifest()).orderBy("path").select("path", "date", "part", "size", "mtime_ns")
        done, held, size = [], [], 0
        for r in materialized_rows(todo):
            if held and (len(held) >= BATCH_FILES or size + r["size"] > BATCH_BYTES):
                done += self._compact(held)
                held, size = [], 0
            held.append(r)
            size += r["size"]
        return CompactionResult(done + (self._compact(held) if held else []))

    def _compact(self, todo: list[dict]) -> list[dict]:
        # a table rather than a cache: blocks of a cache that go to disk are held a hundred at a time (400 MB) by the stream that writes them
        held = f"{self.out_root}/_classified-{uuid.uuid4().hex}"
        try:
            with_partition(classify(raw_lines(self.spark, [r["path"] for r in todo]))).write.option("parquet.block.size", str(GROUP_BYTES)).parquet(f"{held}/rows")
            rows = self.spark.read.parquet(f"{held}/rows")
            for d in DATASETS.values():
                self._emptied(f"{self.out_root}/type={d.name}", todo)
                write_parts(rows_of(rows, d, *LAYOUT), self.out_root, d.name)
            self._emptied(f"{self.out_root}/rejects", todo)
            rejects = with_partition(rejects_of(rows).withColumn("path", F.col("source"))).drop("path", "hour")
            rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).json(f"{self.out_root}/rejects")
            lines = line_counts(rows)
            found = {r["path"]: r.asDict() for r in reconcile(lines, self.stored(todo)).collect()}
        finally:
            delete(self.spark, held)
        sizes = {(r["date"], r["part"]): r["bytes"] for r in self._written(todo).groupBy("date", "part").agg(F.sum("bytes").alias("bytes")).collect()}
        empty = {"total_lines": 0, "rejects": 0, "reconciled": True, **{f"n_{t}": 0 for t in DATASETS}}
        result = [{**r, **empty, **found.get(r["path"], {}), "output_bytes": sizes.get((r["date"], r["part"]), 0)} for r in todo]
        entries = [(r["path"], r["size"], r["mtime_ns"], datetime.now(UTC), r["total_lines"], {t: r[f"n_{t}"] for t in DATASETS}, r["rejects"]) for r in result if r["reconciled"]]
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.out_root}/manifest")
        return result

    def _emptied(self, folder: str, todo: list[dict]) -> None:
        """Delete the parts of some files: dynamic overwriting leaves alone what nothing is written to."""
        for r in todo:
            delete(self.spark, f"{folder}/date={r['date']}/part={r['part']}")

    def _dates(self, folder: str, todo: list[dict]) -> list[str]:
        return [f for f in (f"{folder}/date={d}" for d in sorted({r["date"] for r in todo})) if exists(self.spark, f)]

    def _written(self, todo: list[dict]) -> DataFrame:
        """(date, part, n, bytes, type) of the datasets' parts of some files, read back."""
        here = self.spark.createDataFrame([(r["date"], r["part"]) for r in todo], "date string, part string")
        out = self.spark.createDataFrame([], "date string, part string, n long, bytes long, type string")
        for name in DATASETS:
            folder = folder_of(self.out_root, name)
            if dates := self._dates(folder, todo):
                out = out.unionByName(written(self.spark.read.option("basePath", folder).option("pathGlobFilter", "*.parquet").schema(STORED).parquet(*dates)).withColumn("type", F.lit(name)))
        return out.join(F.broadcast(here), list(LAYOUT), "left_semi")

    def stored(self, todo: list[dict]) -> DataFrame:
        """(path, type, n) of what was written of some files, refused lines too, read back."""
        paths = self.spark.createDataFrame([(r["date"], r["part"], r["path"]) for r in todo], "date string, part string, path string")
        out = self._written(todo).select("date", "part", "type", "n")
        if dates := self._dates(f"{self.out_root}/rejects", todo):
            rejects = self.spark.read.schema("source string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(dates)
            found = lambda name: F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]+)/", 1).alias(name)
            out = out.unionByName(rejects.groupBy(found("date"), found("part")).agg(F.count("*").alias("n")).withColumn("type", F.lit("rejects")))
        return out.join(F.broadcast(paths), list(LAYOUT)).select("path", "type", "n")


def materialized_rows(rows: DataFrame) -> Iterator[dict]:
    """Rows as dictionaries, a partition at a time."""
    return (r.asDict() for r in rows.toLocalIterator())
