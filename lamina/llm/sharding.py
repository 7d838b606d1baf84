"""Sharding (op 2): a two-pass external shuffle.

Pass one scatters the records uniformly into buckets by a seeded hash; pass two shuffles each bucket in
memory with Fisher-Yates draws from a generator seeded with (seed, bucket). Buckets in order are one random
order of all records; shard s takes the places from ceil(s * n / shards) on, so counts differ by one at most
(law ``rows``).

Defined results: a null text has no bytes (size 1, checksum 0); empty and very long texts are records like any
other; repeated rows are records of their own, told apart by their place; ties do not arise, as places are
unique; an empty table gives an empty result; all columns stay, in a struct, so no name can clash.

Scale: the input is evaluated once, with a number for each row, and written to the checkpoint folder; all later
steps read that, so neither a shuffled input nor a lost executor can change a number between them. The number
of buckets follows from the bytes of all texts, so a bucket is bounded whatever the corpus; no key decides a
bucket, so no hot key, source or group of copies can fill one. What is permuted in Python are the numbers of
the rows (8 bytes each), not the rows; texts stay in the JVM and meet their places in one sort-merge join on
the number, which is unique. Every place is found by an aggregate, never by a window over all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import blank, cut, ship, small, table

SHARDS = 16
SEED = 20240229
BUCKET_BYTES = 64_000_000
#: Buckets whose counts are summed up in one window; the sums of these spans are few.
SPAN = 4096

ROW, NUMBER, BUCKET, PLACE = (blank(x) for x in ("row", "number", "bucket", "place"))


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of n places: from the last place down, each is swapped with one drawn from those up to it."""
    draws = np.random.Generator(np.random.PCG64([seed, bucket])).integers(0, np.arange(n, 0, -1))
    order = list(range(n))
    for at, draw in zip(range(n - 1, -1, -1), draws.tolist(), strict=True):
        order[at], order[draw] = order[draw], order[at]
    return np.array(order, dtype=np.int64)


def firsts(counts: DataFrame) -> DataFrame:
    """(bucket, first): the records in the buckets before each, from (bucket, n)."""
    spans = counts.withColumn("span", F.floor(F.col(BUCKET) / SPAN))
    before = lambda by: F.sum("n").over(by) - F.col("n")
    tops = spans.groupBy("span").agg(F.sum("n").alias("n")).select("span", before(Window.orderBy("span")).alias("base"))
    inside = spans.select("span", BUCKET, before(Window.partitionBy("span").orderBy(BUCKET)).alias("inside"))
    return inside.join(tops, "span").select(BUCKET, (F.col("base") + F.col("inside")).alias("first"))


def shuffle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs as one struct column, with shard and slot (from 0 without gaps in each shard).

    ``doc_id`` may be of any type; the order does not depend on it.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = cut(docs.select(F.struct("*").alias(ROW), F.monotonically_increasing_id().alias(NUMBER)))
    size = F.coalesce(F.octet_length(F.col(ROW)[text]), F.lit(0)).cast("long") + 1
    n, total = rows.agg(F.count("*"), F.sum(size)).first()
    buckets = max(-(-(total or 0) // bucket_bytes), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(key: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
        numbers = np.sort(bucket.column(NUMBER).to_numpy())[fisher_yates(bucket.num_rows, seed, key[0].as_py())]
        return pa.table([pa.array(numbers), pa.array(np.full(len(numbers), key[0].as_py())), pa.array(np.arange(len(numbers)))], names=[NUMBER, BUCKET, PLACE])

    scattered = rows.select(NUMBER, F.pmod(F.xxhash64(F.lit(seed), NUMBER), F.lit(buckets).cast("long")).alias(BUCKET))
    mixed = cut(scattered.groupBy(BUCKET).applyInArrow(run, f"`{NUMBER}` long, `{BUCKET}` long, `{PLACE}` long"))
    first = small(firsts(mixed.groupBy(BUCKET).agg(F.count("*").alias("n"))))
    places = mixed.join(first, BUCKET).select(NUMBER, (F.col("first") + F.col(PLACE)).alias("at"))
    numbered = rows.join(places.hint("merge"), NUMBER).select(ROW, "at")
    sharded = numbered.select(ROW, "at", F.expr(f"at * {shards} div {max(n, 1)}").alias("shard"))
    slot = F.col("at") - F.expr(f"(shard * {max(n, 1)} + {shards - 1}) div {shards}")
    return sharded.select(ROW, F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write each shard as Parquet files under ``path/shard=<s>``, rows in slot order; texts move once more for it."""
    rows = shuffled.select("shard", "slot", f"{ROW}.*")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op2_sharding(spark, sf_dir) -> DataFrame:
    shuffled = shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.col(ROW)["text"]
    return shuffled.select(
        F.col(ROW)["doc_id"].alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
