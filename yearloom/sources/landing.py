"""Landing: raw files as a table of byte ranges, and a look at datasets.

A file is cut into ranges of bounded size, so that one that holds most of the
bytes is read by many tasks and never held whole in memory.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.sources.readers import raw_files

NESTED = ("struct", "array", "map", "variant")
RANGE_BYTES = 8 * 1024 * 1024
TASK_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 1024 * 1024

_RANGES = (
    "dataset string, path string, file_name string, modification_time timestamp, "
    "length bigint, range_no int, offset bigint, content binary"
)


def raw_manifest(spark: SparkSession, globs: dict[str, str]) -> DataFrame:
    """One row per file of each dataset: where it is, how long, when changed.

    Spark's file scans leave out files without any byte; those are added from its list of
    files, without a time.
    """
    parts = [_files_of(spark, dataset, glob) for dataset, glob in globs.items()]
    return reduce(DataFrame.unionByName, parts)


def _files_of(spark: SparkSession, dataset: str, glob: str) -> DataFrame:
    files = raw_files(spark, glob)
    # Spark's driver holds the list of files in any case; their bytes are not looked at.
    listed = spark.createDataFrame([(unquote(p),) for p in files.inputFiles()], "listed string")
    place = lambda path: F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
    empty = listed.join(files, place(F.col("listed")) == place(F.col("path")), "left_anti").select(
        F.col("listed").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.lit(0).cast("long").alias("length"),
    )
    return files.unionByName(empty).select(
        F.lit(dataset).alias("dataset"),
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("modificationTime").alias("modification_time"),
        "length",
    )


def raw_ranges(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The bytes of the files, one row per range, with the digest of each range.

    A file without bytes has one empty range.  The number of tasks follows from the number
    of bytes.  It is set, because adaptive execution would judge the ranges by the size of
    their descriptions.
    """
    total = manifest.agg(F.sum("length")).first()[0] or 0
    step = F.lit(range_bytes).cast("long")
    last = F.greatest(F.col("length") - 1, F.lit(0).cast("long"))
    ranges = manifest.select(
        "*", F.posexplode(F.sequence(F.lit(0).cast("long"), last, step)).alias("range_no", "offset")
    ).withColumn("size", F.least(F.lit(range_bytes), F.col("length") - F.col("offset")))
    tasks = max(1, -(-total // TASK_BYTES))
    spread = ranges.repartition(tasks, "path", "range_no").sortWithinPartitions("path", "range_no")
    return spread.mapInArrow(_read_ranges, _RANGES).withColumn(
        "sha256", F.sha2("content", 256)
    )


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of a file stand together, so a task opens each file once."""
    for batch in batches:
        names = [name for name in batch.schema.names if name != "size"]
        rows = zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "size")), strict=True)
        for path, own in groupby(enumerate(rows), key=lambda row: row[1][0]):
            system, place = _file_system(path)
            with system.open_input_file(place) as file:
                for i, (_, offset, size) in own:
                    columns = [batch.slice(i, 1).column(name) for name in names]
                    content = pa.array([file.read_at(size, offset)], pa.binary())
                    yield pa.RecordBatch.from_arrays([*columns, content], [*names, "content"])


@functools.cache
def _system_of(start: str) -> pyarrow.fs.FileSystem:
    """Made once per worker process.

    Works for file, hdfs, s3 (s3a), gs and abfs paths, with the credentials that the
    executors' environment gives; ``s3a`` settings of the Spark session do not count here.
    """
    return pyarrow.fs.FileSystem.from_uri(start)[0]


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    scheme = {"s3a": "s3"}.get(scheme, scheme)
    host, _, inside = rest.lstrip("/").partition("/")
    place = f"{host}/{inside}" if scheme in ("s3", "gs", "gcs") else f"/{inside}"
    return _system_of(f"{scheme}://{quote(host)}/"), place


def file_digests(manifest: DataFrame) -> DataFrame:
    """The SHA-256 digest of each whole file (``sha256``), as publishers give it.

    A digest runs through its file from start to end, so each file is one task's work, read
    in blocks; files are spread over tasks.
    """
    total = manifest.agg(F.sum("length")).first()[0] or 0
    spread = manifest.repartition(max(1, -(-total // TASK_BYTES)), "path")
    kinds = {f.name: f.dataType.simpleString() for f in manifest.schema.fields}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + ", sha256 string"
    return spread.mapInArrow(_digest_files, schema)


def _digest_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            system, place = _file_system(path)
            digest = hashlib.sha256()
            with system.open_input_stream(place) as file:
                while block := file.read(BLOCK_BYTES):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(digests)], [*batch.schema.names, "sha256"]
        )


def restore_files(ranges: DataFrame, target: str) -> DataFrame:
    """Write landed ranges back as files ``<target>/<dataset>/<file_name>``; gives a row per file.

    ``target`` is a folder that all executors reach.  A file is written by one task, range
    after range, so only one range is in memory.  A task that runs again writes the same
    file anew.  Files of one dataset that share a name are an error.  On a file system with times that
    can be set (paths of a shared mount), files keep their ``modification_time``, if the ranges have it.
    """
    clash = ranges.where("range_no = 0").groupBy("dataset", "file_name").count().where("count > 1")
    if not clash.isEmpty():
        raise ValueError("files of one dataset share a name")
    total = ranges.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    time = F.col("modification_time") if "modification_time" in ranges.columns else F.lit(None)
    seconds = time.cast("timestamp").cast("double").alias("seconds")
    placed = ranges.select("dataset", "file_name", "range_no", "content", seconds).repartition(
        max(1, -(-total // TASK_BYTES)), "dataset", "file_name"
    )
    ordered = placed.sortWithinPartitions("dataset", "file_name", "range_no")
    return ordered.mapInArrow(
        lambda batches: _write_files(batches, target), "dataset string, path string, length bigint"
    )


def _write_files(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    at, stream, done, length, system, place, changed = None, None, [], 0, None, "", None

    def finish() -> None:
        if stream is not None:
            stream.close()
            if changed is not None and isinstance(system, pyarrow.fs.LocalFileSystem):
                os.utime(place, (changed, changed))
            done.append((at[0], "/".join((target, *at)), length))

    for batch in batches:
        names = zip(batch.column("dataset").to_pylist(), batch.column("file_name").to_pylist(), strict=True)
        times = batch.column("seconds").to_pylist()
        for own, content, seconds in zip(names, batch.column("content"), times, strict=True):
            if own != at:
                finish()
                at, length, changed = own, 0, seconds
                system, folder = _file_system(f"{target}/{own[0]}" if ":" in target else f"file:{target}/{own[0]}")
                system.create_dir(folder, recursive=True)
                place = f"{folder}/{own[1]}"
                stream = system.open_output_stream(place)
            stream.write(content.as_buffer())
            length += len(content.as_buffer())
    finish()
    for row in done:
        yield pa.RecordBatch.from_pylist([dict(zip(("dataset", "path", "length"), row, strict=True))])


def ingest_raw(
    spark: SparkSession, globs: dict[str, str], landing_base: str, overwrite: bool = False
) -> None:
    """Store each dataset's files under ``<landing_base>/<dataset>/raw``; see ``restore_files``."""
    mode = "overwrite" if overwrite else "errorifexists"
    for dataset, glob in globs.items():
        ranges = raw_ranges(raw_manifest(spark, {dataset: glob}))
        ranges.write.mode(mode).parquet(f"{landing_base}/{dataset}/raw")


def profile(df: DataFrame, distinct: bool = True) -> DataFrame:
    """One row per column: type, rows, nulls, smallest, largest, about how many values.

    One aggregate over the table.  Nested columns have no smallest and largest.  See
    ``exact_distinct`` for exact numbers of values.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    entries = []
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        ordered = field.dataType.typeName() not in NESTED
        hashed = column if ordered else F.to_json(F.struct(column))
        ends = [F.min(column), F.max(column)] if ordered else [F.lit(None), F.lit(None)]
        if field.dataType.typeName() in ("float", "double"):
            ends = [F.when(end == 0, F.lit(0.0)).otherwise(end) for end in ends]  # no -0.0
        aggregates += [
            F.count_if(column.isNull()).alias(f"n{i}"),
            ends[0].cast("string").alias(f"l{i}"),
            ends[1].cast("string").alias(f"h{i}"),
        ]
        if distinct:
            values = F.when(column.isNotNull(), hashed)
            aggregates.append(F.approx_count_distinct(values).alias(f"d{i}"))
        entry = [
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("row_count"),
            F.col(f"n{i}").alias("null_count"),
            F.col(f"l{i}").alias("min_value"),
            F.col(f"h{i}").alias("max_value"),
        ]
        if distinct:
            entry.append(F.col(f"d{i}").alias("approx_distinct"))
        entries.append(F.struct(*entry))
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def exact_distinct(df: DataFrame) -> DataFrame:
    """The number of different values of each column (``column_name``, ``n_distinct``).

    Columns are turned into rows of a number and a 64-bit hash, which are made distinct within
    tasks before they are shuffled, so no value is too frequent.  Nulls don't count.
    """
    values = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("float", "double"):
            column = F.when(column == 0, F.lit(0.0)).otherwise(column)
        elif field.dataType.typeName() in NESTED:
            column = F.to_json(F.struct(column))
        hashed = F.when(F.col(f"`{field.name}`").isNotNull(), F.xxhash64(column))
        values.append(F.struct(F.lit(field.name).alias("column_name"), hashed.alias("value")))
    rows = df.select(F.inline(F.array(*values))).distinct()
    return rows.groupBy("column_name").agg(F.count("value").alias("n_distinct"))


def preview(df: DataFrame, rows: int = 5, order_by: Iterable[str] = ()) -> DataFrame:
    """A few example rows; the first ones if an order is given."""
    keys = list(order_by)
    return (df.orderBy(*keys) if keys else df).limit(rows)
