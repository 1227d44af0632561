"""Small helpers that the operators share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

# Words of lower-cased text: runs of a-z, 0-9 and everything beyond ASCII.  On UTF-8 bytes
# the pattern finds the same words as on code points, and bytes.lower() changes A-Z only.
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
# Words between ASCII white space.
TOKENS = re.compile(rb"[^\x20\x09-\x0D]+").findall

PIECE_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of ``folder``, whatever store the folder is in."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def add_columns(
    df: DataFrame, source: str, added: dict[str, DataType], call: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """``df`` with columns that Python makes of the text in ``source``.

    For columns as large as the text: rows come back in batches of about ``PIECE_BYTES`` of
    text, so neither side holds more of them at a time.  Columns of the same names are
    replaced.
    """
    others = [f for f in df.schema.fields if f.name not in added]
    schema = StructType([*others, *(StructField(name, kind) for name, kind in added.items())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, count in spans(texts, PIECE_BYTES):
                part = batch.slice(start, count)
                columns = [*part.columns[:-1], *call(texts.slice(start, count))]
                yield pa.RecordBatch.from_arrays(columns, names)

    hidden = f"__text_{uuid.uuid4().hex}"
    text = F.col(f"`{source}`").cast("string").alias(hidden)
    rows = df.select(*[f"`{f.name}`" for f in others], text).mapInArrow(run, schema)
    return rows.select(*[f"`{c}`" for c in [*df.columns, *(n for n in added if n not in df.columns)]])


def spans(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """First row and number of rows of slices with about ``most`` bytes, or a single row."""
    start, size = 0, 0
    for i, length in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if size and size + length > most:
            yield start, i - start
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts) - start


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes (null: empty), in slices of about ``most`` bytes each.

    Keeps what is unpacked at one time small however large an Arrow batch is; a
    slice holds at least one text.
    """
    for start, count in spans(texts, most):
        part = texts.slice(start, count)
        kind = pa.large_binary() if pa.types.is_large_string(part.type) else pa.binary()
        yield start, [x or b"" for x in part.cast(kind).to_pylist()]


def id_text(column: str) -> Column:
    return F.col(column).cast("string")


def held_out(id_column: str) -> Column:
    """The fifth of the rows that no model learns from; rows without an id are held out."""
    return F.coalesce(F.crc32(id_text(id_column)) % 5 == 0, F.lit(True))
