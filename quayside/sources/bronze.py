"""Bronze: text files in, partitioned Parquet with lineage columns out."""

from __future__ import annotations

import csv
import hashlib
import io
import re
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import LINEAGE_COLUMNS, Dataset
from quayside.session import new_folder
from quayside.sources import files
from quayside.sources.quoted import CSV_GLOB, read_quoted
from quayside.sources.snapshots import Snapshots

MALFORMED = "_malformed"
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def feed_schema(columns: Sequence[str], malformed: bool = False) -> T.StructType:
    names = [*columns, MALFORMED] if malformed else list(columns)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def column_names(header: str) -> list[str]:
    """Names of a header line: a repeated name gets a number, an empty one its position."""
    found: list[str] = []
    for place, name in enumerate(next(csv.reader(io.StringIO(header)), [])):
        name = name or f"Unnamed: {place}"
        known, k = name, 0
        while name in found:
            k += 1
            name = f"{known}.{k}"
        found.append(name)
    return found


def read_files(
    spark: SparkSession, path: str, dataset: Dataset, columns: Sequence[str], paths: Sequence[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """All-text rows of the files that have this header, the raw text of rows that do not fit it, and `_file`.

    `multi_line` is for files whose quoted fields hold line breaks. `paths` picks files; the filter on the hidden path column prunes
    the file listing, so the others are not opened.
    """
    if multi_line:
        rows = read_quoted(spark, path, dataset.encoding, columns, MALFORMED, paths)
        return rows.withColumn("_file", relative_file(path, "_file"))
    reader = (
        spark.read.schema(feed_schema(columns, malformed=True))
        .option("header", True)
        .option("encoding", dataset.encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", CSV_GLOB)
        # Every column is parsed: with pruning a short line would pass unnoticed.
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
    )
    rows = reader.csv(path)
    if paths is not None:
        rows = rows.filter(F.col("_metadata.file_path").isin(list(paths)))
    return rows.select("*", relative_file(path).alias("_file"))


def relative_file(folder: str, path: str = "_metadata.file_path") -> Column:
    """Path of the row's file below `folder`: what identifies a source file."""
    # The hidden path column is percent-encoded, a plus sign excepted.
    decoded = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    below = re.escape(urlsplit(folder).path.rstrip("/"))
    return F.regexp_replace(decoded, f"^.*?{below}/+", "")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, file, length and time of change of every file (the last and first NULL for an empty one); contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    seen = F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified")
    sizes = found.select(*seen, relative_file(folder).alias("file"))
    # A scan leaves empty files out; the listing behind it, which the driver holds anyway, has them.
    names = spark.createDataFrame([(p,) for p in found.inputFiles()], "name string")
    listed = names.select(relative_file(folder, "name").alias("file")).join(sizes, "file", "left")
    return listed.select("path", "file", F.coalesce("length", F.lit(0)).alias("length"), "modified")


def validate_files(spark: SparkSession, folder: str, expected: Sequence[str] = ()) -> DataFrame:
    """One row per file, and per expected file that is missing: path, file, length, modified, valid, reason."""
    found = list_files(spark, folder)
    if expected:
        names = spark.createDataFrame([(n,) for n in expected], "file string")
        found = found.join(names, "file", "full")
    reason = (
        F.when(F.col("length").isNull(), "missing")
        .when(~F.lower("file").endswith(".csv"), "not a .csv file")
        .when(F.col("length") == 0, "empty")
    )
    return found.select("path", "file", "length", "modified", reason.isNull().alias("valid"), reason.alias("reason"))


def _fold_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split: lines, a polynomial in the lines' hashes for each of two bases, and the header where it begins a file."""
    held: tuple | None = None  # path, start, lines, sums, lines with an open quote, header

    def packed() -> pa.RecordBatch:
        path, start, lines, sums, odd, header = held
        values = ([path], [start], [lines], [int(sums[0].view(np.int64)[0])], [int(sums[1].view(np.int64)[0])], [odd], [header])
        kinds = (pa.string(), *[pa.int64()] * 5, pa.binary())
        names = ["path", "start", "lines", "p0", "p1", "odd", "header"]
        return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    for batch in batches:
        paths, starts = batch.column("path"), batch.column("start").to_numpy()
        hashes = [batch.column(c).to_numpy().view(np.uint64) for c in ("h0", "h1")]
        odd = batch.column("odd").to_numpy()
        coded = paths.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(coded) != 0) | (np.diff(starts) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if lo == hi:
                continue
            path, start = paths[int(lo)].as_py(), int(starts[lo])
            if held is None or held[:2] != (path, start):
                if held is not None:
                    yield packed()
                header = batch.column("value")[int(lo)].as_py() if start == 0 else None
                held = (path, start, 0, [np.zeros(1, np.uint64), np.zeros(1, np.uint64)], 0, header)
            sums = held[3]
            for k, base in enumerate(_BASES):
                powers = np.cumprod(np.full(hi - lo, base, dtype=np.uint64))
                sums[k] += np.sum(hashes[k][lo:hi] * powers) * np.uint64(pow(base, held[2], 1 << 64))
            held = (*held[:2], held[2] + int(hi - lo), sums, held[4] + int(odd[lo:hi].sum()), held[5])
    if held is not None:
        yield packed()


def _fold_splits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of a file from its length and its splits in order, wherever it was cut."""
    for batch in batches:
        marks = []
        for length, splits in zip(batch.column("length").to_pylist(), batch.column("splits").to_pylist()):
            lines, sums = 0, [0, 0]
            for split in splits:
                for k, base in enumerate(_BASES):
                    sums[k] = (sums[k] + split[f"p{k}"] * pow(base, lines, 1 << 64)) % (1 << 64)
                lines += split["lines"]
            marks.append(hashlib.md5(f"{length}|{lines}|{sums[0]}|{sums[1]}".encode()).hexdigest())
        yield pa.record_batch(
            [batch.column("path"), batch.column("length"), pa.array(marks, pa.string()), batch.column("odd"), batch.column("header")],
            names=["path", "length", "file_hash", "odd", "header"],
        )


def file_marks(spark: SparkSession, folder: str, encoding: str = "UTF-8", paths: Sequence[str] | None = None) -> DataFrame:
    """path, length, file, file_hash, header, multi_line of every feed file (or of `paths`) that is not empty, from one scan.

    One rule for files of any size: the hash covers the length and every line at its place. A split's part is
    a polynomial in its lines' hashes; parts of consecutive splits combine, so the result does not depend
    on how files are cut, and a long file is hashed by many tasks.
    """
    chosen = F.lit(True) if paths is None else F.col("_metadata.file_path").isin(list(paths))
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", CSV_GLOB)
        .text(folder)
        .filter(chosen)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.input_file_block_start().alias("start"),
            F.xxhash64("value").alias("h0"),
            F.xxhash64(F.lit(1), "value").alias("h1"),
            ((F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("odd"),
            # The first line of a file is in the split that starts it.
            F.when(F.input_file_block_start() == 0, F.col("value").cast("binary")).alias("value"),
        )
    )
    parts = lines.mapInArrow(_fold_lines, "path string, start bigint, lines bigint, p0 bigint, p1 bigint, odd bigint, header binary")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB)
    lengths = listed.load(folder).filter(chosen).select(F.col("_metadata.file_path").alias("path"), "length")
    joined = (
        parts.groupBy("path")
        # A row per split of the file.
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "lines", "p0", "p1"))).alias("splits"),
            F.sum("odd").alias("odd"),
            F.max("header").alias("header"),
        )
        .join(lengths, "path")
        .select("path", "length", "splits", "odd", "header")
    )
    hashed = joined.mapInArrow(_fold_splits, "path string, length bigint, file_hash string, odd bigint, header binary")
    header = F.regexp_replace(F.decode("header", encoding), "^﻿|\r$", "")
    return hashed.select("path", "length", relative_file(folder, "path").alias("file"), "file_hash", header.alias("header"), (F.col("odd") > 0).alias("multi_line"))


def no_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "path string, length bigint, file string, file_hash string, header string, multi_line boolean")


def changed_files(fingerprints: DataFrame, state: DataFrame) -> DataFrame:
    """Files whose (dataset, file, hash) is not in the stored state."""
    return fingerprints.join(
        state.select("dataset_name", F.col("source_file").alias("file"), "file_hash"),
        ["dataset_name", "file", "file_hash"],
        "left_anti",
    )


def read_feed(spark: SparkSession, folder: str, dataset: Dataset, marks: DataFrame | None = None) -> DataFrame:
    """All-text rows of the marked files (all by default), `_file` and `_malformed`; columns by name from each file's header.

    Files are read together per header, so their order of columns may differ, and a file may have more or fewer.
    """
    every = marks is None
    marks = file_marks(spark, folder, dataset.encoding) if every else marks
    # As many paths as the file listing on the driver holds anyway; one entry per distinct header.
    headers = marks.groupBy("header", "multi_line").agg(F.collect_list("path").alias("paths")).collect()
    parts = []
    for row in sorted(headers, key=lambda r: (r["header"], r["multi_line"])):
        columns = column_names(row["header"])
        chosen = None if every and len(headers) == 1 else row["paths"]
        parts.append(read_files(spark, folder, dataset, columns, chosen, row["multi_line"]))
    if not parts:
        return spark.createDataFrame([], feed_schema([*dataset.columns, MALFORMED, "_file"]))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for c in merged.columns if c not in (MALFORMED, "_file")]
    return merged.select(*[F.col(f"`{c}`") for c in names], MALFORMED, "_file")


def read_csv(spark: SparkSession, folder: str, dataset: Dataset) -> DataFrame:
    """Rows of all feed files of a folder that fit their header; `read_rejected` gives the others."""
    rows = read_feed(spark, folder, dataset)
    return rows.filter(F.col(MALFORMED).isNull()).drop(MALFORMED, "_file")


def read_rejected(spark: SparkSession, folder: str, dataset: Dataset) -> DataFrame:
    """file and raw text of the rows that do not fit their file's header."""
    rows = read_feed(spark, folder, dataset)
    return rows.filter(F.col(MALFORMED).isNotNull() & _parsed(rows)).select(F.col("_file").alias("file"), F.col(MALFORMED).alias("line"))


def _parsed(rows: DataFrame) -> Column:
    """Always true, but keeps a parsed column in the scan: the reader refuses the raw text alone."""
    return F.length(F.coalesce(F.col(f"`{rows.columns[0]}`"), F.lit(""))) >= 0


def malformed_counts(spark: SparkSession, folder: str, dataset: Dataset) -> DataFrame:
    """Rows and malformed rows per file."""
    rows = read_feed(spark, folder, dataset)
    return rows.groupBy(F.col("_file").alias("file")).agg(
        F.count_if(_parsed(rows)).alias("row_count"), F.count(MALFORMED).alias("malformed_count")
    )


def new_run_id() -> str:
    return str(uuid.uuid4())


def with_lineage(
    df: DataFrame, source_file: Column | str, dataset_name: str, run_id: str, loaded_at: datetime | None = None
) -> DataFrame:
    """Lineage columns; `loaded_at` is one time for all rows of a run, however many jobs write them."""
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    now = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    values = (now, source, F.lit(dataset_name), F.lit(run_id), F.lit("ACTIVE"))
    return df.withColumns(dict(zip(LINEAGE_COLUMNS, values)))


#: Folder level below the day: the load that wrote the rows.
LOAD = "_load"
#: Folder of loads that are being written.
WRITING = "_writing"
#: Buffer of an open data file: a task has one per day.
ROW_GROUP_BYTES = 32 << 20


def write_bronze(df: DataFrame, root: str, ingested_date: Column | str | None = None) -> DataFrame:
    """Add rows below `root/ingested_date=D/`; returns what was added, as stored.

    A file that is loaded again on a day replaces its rows of that day: their places (data file and row number) are written beside
    the data, and readers leave them out. Rows and places become visible together, by one small manifest, so a reader
    sees the old rows or the new ones, and a load writes as much as it adds. Rows are parsed and written once, into folders of their
    own; what the load needs to know of them it reads back from there.
    """
    spark = df.sparkSession
    if "ingested_date" not in df.columns:
        day = F.current_date() if ingested_date is None else F.to_date(F.lit(ingested_date))
        df = df.withColumn("ingested_date", day)
    load = f"load-{uuid.uuid4().hex}"
    # No state names the load yet, so nobody reads its rows before the manifest.
    added = _stored_rows(spark, root, _write_load(df, root, load), df.schema)
    # Files and days of this load: few rows per file.
    loads = added.select("ingested_date", "_source_file").distinct().checkpoint()
    history = Snapshots(spark, root)

    def change(number: int, state: dict) -> dict:
        """The last state with this load, and without the rows it replaces there."""
        present = _placed_rows(spark, root, state)
        dirty = dict(state.get("dirty", {}))
        if present is not None:
            path = f"{root.rstrip('/')}/_deletes/{load}-{number}"
            again = present.select("ingested_date", "_source_file", LOAD, "_place").join(loads, ["ingested_date", "_source_file"], "left_semi")
            again.select(LOAD, "_place.*").write.mode("overwrite").parquet(path)
            hit = [r[0] for r in spark.read.parquet(path).select(LOAD).distinct().collect()]  # loads, not rows
            dirty |= {old: [*dirty.get(old, []), path] for old in hit}
        return {"loads": [*state.get("loads", []), load], "dirty": dirty}

    history.commit(change)
    return added


def _write_load(rows: DataFrame, root: str, load: str) -> list[str]:
    """Add rows as a load, written once; returns its folders, one per day.

    The job has an output folder of its own, so jobs that end at the same time do not clear each other's; its folders are then moved
    to their places. A task keeps a file open per day, so rows are not sorted by day.
    """
    spark, root = rows.sparkSession, root.rstrip("/")
    beside = f"{root}/{WRITING}/{load}"
    writer = rows.withColumn(LOAD, F.lit(load)).write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
    writer.partitionBy("ingested_date", LOAD).parquet(beside)
    folders = [f"{day}/{LOAD}={load}" for day in files.names(spark, beside) if day.startswith("ingested_date=")]
    for folder in folders:
        files.move(spark, f"{beside}/{folder}", f"{root}/{folder}")
    files.delete(spark, beside)
    return [f"{root}/{folder}" for folder in folders]


def _stored_rows(spark: SparkSession, root: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows of a load's folders, visible or not, with the columns they were written with."""
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", root).parquet(*folders)
    return rows.select(*[F.col(f"`{c}`") for c in schema.names])


def _placed_rows(spark: SparkSession, root: str, state: dict) -> DataFrame | None:
    """Visible rows of a state with their load and place; None before the first load."""
    if not state.get("loads"):
        return None
    dirty = state.get("dirty", {})
    rows = spark.read.option("mergeSchema", True).parquet(root)
    # The part of the path that names the file within the table.
    file = F.substring_index(F.col("_metadata.file_path"), "/ingested_date=", -1)
    rows = rows.select("*", F.struct(file.alias("file"), F.col("_metadata.row_index").alias("row")).alias("_place"))
    # Both filters prune folders.
    clean = rows.filter(F.col(LOAD).isin([x for x in state["loads"] if x not in dirty]))
    if not dirty:
        return clean
    gone = spark.read.parquet(*sorted({p for paths in dirty.values() for p in paths})).select(F.struct("file", "row").alias("_place"))
    return clean.unionByName(rows.filter(F.col(LOAD).isin(sorted(dirty))).join(gone, "_place", "left_anti"))


def read_bronze(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """All rows of the last state, or of a numbered one; `ingested_date` is a date column, filters on it prune folders.

    Loads may differ in columns, so the schemas of the files are merged. A folder without states is read as it is.
    """
    rows = _placed_rows(spark, root, Snapshots(spark, root).read(number)[1])
    return rows.drop(LOAD, "_place") if rows is not None else spark.read.option("mergeSchema", True).parquet(root)


def compact_bronze(spark: SparkSession, root: str) -> int:
    """Write the rows that are left of loads with replaced rows into one new load; returns how many loads that were.

    A load that comes in between makes the compaction start anew.
    """
    history, done = Snapshots(spark, root), 0

    def change(_: int, state: dict) -> dict:
        nonlocal done
        old = sorted(state.get("dirty", {}))
        done = len(old)
        if not old:
            return state
        load = f"load-{uuid.uuid4().hex}"
        _write_load(_placed_rows(spark, root, state).filter(F.col(LOAD).isin(old)).drop("_place"), root, load)
        return {"loads": [x for x in state["loads"] if x not in old] + [load], "dirty": {}}

    history.commit(change)
    return done


def vacuum_bronze(spark: SparkSession, root: str, keep: int = 10, unused_after: float = 86_400) -> list[str]:
    """Forget all but the last `keep` states and delete loads that none of them has; returns those loads.

    A load that is in no state yet may still be being written: it goes after `unused_after` seconds.
    """
    history = Snapshots(spark, root)
    old = {x for state in history.forget(keep) for x in state.get("loads", [])}
    states = [history.read(n)[1] for n in history.numbers()]
    used = {x for state in states for x in state.get("loads", [])}
    deletes = {p.rsplit("/", 1)[1] for state in states for paths in state.get("dirty", {}).values() for p in paths}
    root, gone = root.rstrip("/"), set()

    def stale(path: str, known: bool) -> bool:
        return known or time.time() - files.modified(spark, path) > unused_after

    for day in files.names(spark, root):
        if not day.startswith("ingested_date="):
            continue
        for folder in files.names(spark, f"{root}/{day}"):
            load, path = folder.removeprefix(f"{LOAD}="), f"{root}/{day}/{folder}"
            if folder.startswith(f"{LOAD}=") and load not in used and stale(path, load in old):
                files.delete(spark, path)
                gone.add(load)
    for load in files.names(spark, f"{root}/{WRITING}"):
        path = f"{root}/{WRITING}/{load}"
        if stale(path, False):
            files.delete(spark, path)
            gone.add(load)
    for name in files.names(spark, f"{root}/_deletes"):
        path = f"{root}/_deletes/{name}"
        if name not in deletes and stale(path, any(name.startswith(x) for x in old)):
            files.delete(spark, path)
    return sorted(gone)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", compression: str = "none") -> None:
    (
        df.write.mode("overwrite")
        .option("compression", compression)
        .option("header", True)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        # Blanks belong to the data.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
