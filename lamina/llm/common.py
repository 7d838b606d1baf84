"""Shared pieces of the training-data operators: tables, words, hashes, checkpoints, size-checked joins."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.runtime import cut as cut
from lamina.runtime import shared_folder as shared_folder
from lamina.runtime import ship as ship

#: ASCII white space: what ``[^\x20\x09-\x0D]+`` leaves out of words.
SPACE = " \t\n\x0b\f\r"
SPACE_RUN = r"[ \t-\r]+"
#: A side of a join is broadcast only after it was measured and takes no more bytes than this.
BROADCAST_BYTES = 32_000_000
#: What a row of a broadcast side takes besides its texts and arrays: the row, its columns, its place in the hash table.
ROW_BYTES = 96


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bytes_of(held: DataFrame) -> int:
    """About the bytes that the rows take in memory."""
    sizes = []
    for field in held.schema.fields:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            sizes.append(F.octet_length(column))
        elif kind == "array":
            sizes.append(F.when(column.isNotNull(), F.size(column)) * 8)
    each = [F.coalesce(F.sum(x.cast("long")), F.lit(0)) for x in sizes]
    found = held.agg(F.count("*").alias("n"), *[x.alias(f"s{i}") for i, x in enumerate(each)]).first()
    return found[0] * ROW_BYTES + sum(found[1:])


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, cut and measured; with a broadcast hint if it takes at most ``most`` bytes.

    Beyond the bound the frame is returned without a hint and the join shuffles: the exchange then stands
    directly below the join, so adaptive execution can split a hot key.
    """
    held = cut(df)
    return F.broadcast(held) if bytes_of(held) <= most else held


def cut_unsized(df: DataFrame) -> DataFrame:
    """df, cut, without the size that its plan was estimated to have, for what is cut and joined again in rounds.

    A checkpoint keeps that estimate, and a join's is the product of its sides'. Over rounds its digits double each
    time, until the driver spends seconds, then minutes, and hundreds of MB on multiplying one number.
    """
    held, spark = cut(df), df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(held._jdf.rdd(), held._jdf.schema()), spark)


def hash_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, cut and measured, to be the hash table of a shuffled join; without the hint if a task's share is too large.

    Where each row's key is unique, as here, the shares are even; beyond the bound the join sorts, and may spill.
    """
    held = cut(df)
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return held.hint("shuffle_hash") if bytes_of(held) <= most * tasks else held


def tidy() -> None:
    """Give freed memory of a Python worker back at the end of a task; the worker lives on and serves others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def where_fenced(df: DataFrame, condition: Column) -> DataFrame:
    """df.where(condition), evaluated on the columns of df as they stand.

    The optimizer moves a plain filter below projections by copying their expressions into it, so costly ones
    are taken twice, or once per element where a lambda reads them. It moves none past a projection with a
    non-deterministic column that the filter uses.
    """
    fence = blank("fence")
    return df.withColumn(fence, F.spark_partition_id()).where(condition & (F.col(fence) >= 0)).drop(fence)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def hashes_of(words: Column) -> Column:
    """A 64-bit hash of each word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def window_hashes(word_hashes: Column, size: int) -> Column:
    """A 64-bit hash of each run of ``size`` neighbouring words, in order; fewer words have none.

    ``word_hashes`` must be a column, not an expression, as each window reads it ``size`` times.
    """
    n = F.size(word_hashes)
    starts = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(word_hashes, i + j) for j in range(size)]))


def blank(name: str) -> str:
    """A name for a column of the operators' own that no input is likely to have."""
    return f"__lamina_{name}"
