"""Token counts with a cache of digests.

Each text is brought to a normal form that has as many tokens, and its digest and the
tokenizer's version are joined to the counts stored before.  Only digests that no run has
seen are encoded, once each, and their counts are appended to the cache.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

import pyarrow as pa
import sentencepiece
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm import bpe
from yearloom.llm.common import pieces

CACHE = "digest binary, version string, n_tokens bigint"


def version(path: str) -> str:
    """Digest of the tokenizer file: another file never finds this one's counts."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


@functools.cache
def counter(path: str) -> Callable[[str], int]:
    """Tokens of a whole text, without added ones; made once per worker process."""
    if path.endswith(".json"):
        coder = bpe.encoder(path)
        return lambda text: sum(map(len, coder.ids(text))) // 4
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    raise ValueError(f"no counter for {path}")


def normal_form(text: Column, path: str) -> Column:
    """A text of as many tokens that differently spaced texts share.

    The word vocabulary drops white space, so each run of it is one space.  Letters stay as
    they are: lower-casing could turn other text into a special string.  Other
    vocabularies keep the text.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")) if path.endswith(".json") else text


def _counts(texts: pa.Array, path: str) -> pa.Array:
    count = counter(path)
    return pa.array([count(t.decode()) for _, part in pieces(texts) for t in part], pa.int64())


def stored(spark: SparkSession, cache: str) -> DataFrame:
    """The counts of earlier runs; none where the cache does not exist yet."""
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count(df: DataFrame, path: str, cache: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text.

    ``cache`` is a Parquet folder that all executors reach; it is made if missing.  Null and
    empty texts have no tokens.  Every row is kept, repeated ones too; other columns are
    untouched and a column of the name ``out`` is replaced.  A run that breaks off appends
    nothing or all; a digest that two runs append at the same time counts once.
    """
    spark = df.sparkSession
    known = F.lit(version(path))
    normal = normal_form(F.col(f"`{text}`"), path)
    digest = F.unhex(F.sha2(normal, 256))

    seen = stored(spark, cache).where(F.col("version") == known)
    misses = df.select(digest.alias("digest"), normal.alias("normal"))
    misses = misses.join(seen.select("digest"), "digest", "left_anti")
    # One text for each digest; copies within a task are dropped before rows are shuffled.
    distinct = misses.groupBy("digest").agg(F.first("normal").alias("normal"))
    call = F.arrow_udf(lambda texts: _counts(texts, path), "bigint")
    new = distinct.select("digest", known.alias("version"), call("normal").alias("n_tokens"))
    new.write.mode("append").parquet(cache)

    counts = stored(spark, cache).where(F.col("version") == known)
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("__n_tokens"))
    counts = counts.withColumnRenamed("digest", "__seen")
    rows = df.withColumn("__digest", digest).join(counts, F.col("__digest") == F.col("__seen"), "left")
    return rows.withColumn(out, F.col("__n_tokens")).drop("__digest", "__seen", "__n_tokens")
