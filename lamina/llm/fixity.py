"""WARC fixity audit (op 1) with Merkle trees over ordered offset ranges.

Records lie in archives, one after the other; a replica is a relation of (archive, offset, payload), stored or
read (``read_warc``) on its own. A leaf is the SHA-256 of a record's bytes at its offset. The first level covers
ranges of ``RANGE_BYTES`` of an archive: the hash of the offsets and hashes of the records that begin there, in
order. A node above covers ``FANOUT`` neighbouring ranges, then ``FANOUT`` neighbouring archives, to one root. As
ranges follow from offsets alone, a record that one replica has lost or has besides moves no other range. Two
replicas are compared from the root: only branches whose hashes differ are descended, down to the records that
are corrupt, cut short, lost, or extra.

Defined results: null urls and pages are empty fields of a record; a record with a null payload is one that the
replica has lost; a record that only one replica has gets a null hash for the other; records of equal archive,
offset and bytes count once, of equal place but other bytes each; very long records are hashed whole and lie in
the range where they begin; equal replicas and empty tables give an empty result; further columns are not read,
so their names cannot clash.

Scale: bytes are hashed where they are read; what is shuffled is a row of a hash and a place for each record.
Archives are of bounded size, so are ranges, and every other level is an aggregation of at most FANOUT rows a
group, with no window over the whole. The descent joins each level with the branches that differ, whose number
follows from the damage, not from the archive.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.common import blank, cut, ship, small, table

FANOUT = 16
ARCHIVE_BYTES = 64_000_000
RANGE_BYTES = 262_144


def record_of(url: Column, payload: Column) -> Column:
    """The text of a WARC resource record."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def records_in(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the records of a WARC file, plain or gzip; places are those of the unpacked file.

    What does not begin as a record, or has no length, is one record to the next that does, so damage stays local.
    """
    stream = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = 0
    while at < len(stream):
        head = stream.find(b"\r\n\r\n", at)
        length = None
        if stream.startswith(b"WARC/", at) and head >= 0:
            for line in stream[at:head].split(b"\r\n")[1:]:
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length" and value.strip().isdigit():
                    length = int(value)
        end = head + 4 + length + 4 if length is not None else -1
        if length is None or end > len(stream) or (end < len(stream) and not stream.startswith(b"WARC/", end)):
            end = stream.find(b"\r\n\r\nWARC/", at)
            end = end + 4 if end >= 0 else len(stream)
        yield at, stream[at:end]
        at = end


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(archive, offset, payload) of the records of WARC files; ``archive`` is a file's name, the unit of memory a file."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held, size = [], 0
                for offset, payload in records_in(data.as_py()):
                    held.append((name, offset, payload))
                    size += len(payload)
                    if size > 16_000_000:
                        yield rows(held)
                        held, size = [], 0
                if held:
                    yield rows(held)

    def rows(held: list[tuple]) -> pa.RecordBatch:
        a, b, c = zip(*held, strict=True)
        return pa.record_batch([pa.array(a), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["archive", "offset", "payload"])

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    return files.mapInArrow(run, "archive string, offset long, payload binary")


def layout(records: DataFrame, length: Column, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """records as one struct column ``record``, with the archive and offset at which each is written.

    Records are dealt to archives of bounded size by a hash of their place in the input, which the caller must
    have fixed (a plain scan, or rows that were cut), so no key can fill an archive.
    """
    spark, place = records.sparkSession, blank("place")
    total = records.agg(F.sum(length.cast("long"))).first()[0] or 0
    archives = max(-(-total // archive_bytes), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = records.select(F.struct("*").alias("record"), length.cast("long").alias("length"), F.monotonically_increasing_id().alias(place))
    dealt = dealt.withColumn("archive", F.pmod(F.xxhash64(place), F.lit(archives)))
    order = Window.partitionBy("archive").orderBy(place)
    before = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.select("record", "archive", before.alias("offset"), "length")


def leaves(replica: DataFrame, archive: str = "archive", offset: str = "offset", payload: str = "payload") -> DataFrame:
    """(archive, offset, stop, hash) of the records that a replica has."""
    held = replica.where(F.col(payload).isNotNull())
    found = held.select(F.col(archive).cast("string").alias("archive"), F.col(offset).cast("long").alias("offset"), F.octet_length(payload).cast("long").alias("size"), F.sha2(F.col(payload).cast("binary"), 256).alias("hash"))
    return found.select("archive", "offset", (F.col("offset") + F.col("size")).alias("stop"), "hash")


def over(*parts: str) -> Column:
    """A hash of the rows of a group, in the order of the columns; the last is a hash."""
    listed = F.array_sort(F.collect_set(F.struct(*parts)))
    return F.sha2(F.array_join(F.transform(listed, lambda x: F.concat_ws(":", *[x[p].cast("string") for p in parts])), "\n"), 256)


def tree(records: DataFrame, tops: dict[str, int]) -> list[DataFrame]:
    """Levels above the leaves, from the ranges to the root, each (up, a, at, hash): a node and its place among its parent's.

    A node's name is (``a``, ``at``): an archive and the number of a span of its offsets, above these a bucket
    of archives and 0. ``tops`` has the heights, which the trees that are compared must share.
    """
    own = records.select("archive", F.floor(F.col("offset") / RANGE_BYTES).alias("at"), "offset", "hash")
    level = own.groupBy(F.col("archive").alias("a"), "at").agg(over("offset", "hash").alias("hash"))
    levels = [cut(level)]
    for _ in range(tops["ranges"]):
        up = F.floor(F.col("at") / FANOUT)
        levels.append(cut(levels[-1].groupBy("a", up.alias("up")).agg(over("at", "hash").alias("hash")).select("a", F.col("up").alias("at"), "hash")))
    for step in range(tops["archives"], -1, -1):
        # Archives have names of any kind, so a bucket of them is the first digits of the hash of a name.
        up = F.substring(F.sha2(F.col("a"), 256), 1, step) if step == tops["archives"] else F.substring("a", 1, step)
        levels.append(cut(levels[-1].groupBy(up.alias("up")).agg(over("a", "hash").alias("hash")).select(F.col("up").alias("a"), F.lit(0).cast("long").alias("at"), "hash")))
    return levels


def heights(*replicas: DataFrame) -> dict[str, int]:
    """How many levels join the ranges of an archive, and the archives by hexadecimal digits of their names' hashes."""
    farthest, most = 0, 0
    for records in replicas:
        found = records.agg(F.max("offset"), F.approx_count_distinct("archive")).first()
        farthest, most = max(farthest, found[0] or 0), max(most, found[1] or 0)
    ranges, archives, reach = 0, 0, farthest // RANGE_BYTES
    while reach:
        ranges, reach = ranges + 1, reach // FANOUT
    while most > FANOUT:
        archives, most = archives + 1, most // FANOUT
    return {"ranges": ranges, "archives": archives}


def audit(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(archive, offset, stop, expected, found): the records that differ between two replicas' leaves, by descent."""
    tops = heights(expected, found)
    a, b = tree(expected, tops), tree(found, tops)
    wrong = None
    for k in range(len(a) - 1, -1, -1):
        mine, other = a[k], b[k]
        if wrong is not None:
            keys = wrong.select(F.col("a").alias("up_a"), F.col("at").alias("up_at"))
            mine, other = (x.join(keys, parent(k, tops), "left_semi") for x in (mine, other))
        met = mine.select("a", "at", F.col("hash").alias("x")).join(other.select("a", "at", F.col("hash").alias("y")), ["a", "at"], "full")
        wrong = small(met.where(~F.col("x").eqNullSafe(F.col("y"))).select("a", "at"))
    ranges = wrong.select(F.col("a").alias("archive"), F.col("at").alias("range"))
    inside = lambda x: x.withColumn("range", F.floor(F.col("offset") / RANGE_BYTES)).join(ranges, ["archive", "range"], "left_semi").select("archive", "offset", "stop", "hash").distinct()
    one, two = inside(expected), inside(found)
    # Records of one place meet by their bytes first; what is left on either side differs.
    only = lambda x, y: x.join(y.select("archive", "offset", "hash"), ["archive", "offset", "hash"], "left_anti")
    left = only(one, two).select("archive", "offset", "stop", F.col("hash").alias("expected"))
    right = only(two, one).select("archive", "offset", F.col("stop").alias("other_stop"), F.col("hash").alias("found"))
    met = left.join(right, ["archive", "offset"], "full")
    return met.select("archive", "offset", F.coalesce("stop", "other_stop").alias("stop"), "expected", "found")


def parent(k: int, tops: dict[str, int]) -> Column:
    """Whether a node of level k lies under (up_a, up_at) of the level above."""
    if k < tops["ranges"]:
        return (F.col("a") == F.col("up_a")) & (F.floor(F.col("at") / FANOUT) == F.col("up_at"))
    step = tops["archives"] - (k - tops["ranges"])
    up = F.substring(F.sha2(F.col("a"), 256), 1, step) if k == tops["ranges"] else F.substring("a", 1, step)
    return up == F.col("up_a")


def op1_fixity(spark, sf_dir) -> DataFrame:
    """Pages as WARC records, and a replica in which some are changed, cut short or lost, and some are there besides."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    size = F.octet_length(record_of(F.col("url"), F.col("html")))
    index = cut(layout(pages, size))
    page = F.col("record")["page_id"]
    written = record_of(F.col("record")["url"], F.col("record")["html"])
    fault, middle = page % 97, (F.length(written) / 2).cast("int")
    stored = (
        F.when(fault == 5, F.concat(F.substring(written, F.lit(1), middle), F.lit("\x01"), F.substring(written, middle + 2, F.length(written))))
        .when(fault == 6, F.substring(written, F.lit(1), middle))
        .when(fault == 7, F.lit(None).cast("string"))
        .otherwise(written)
    )
    # A record that only the replica has begins at the second byte of the one it repeats.
    places = F.array_compact(F.array(F.struct(F.col("offset"), stored.alias("payload")), F.when(fault == 8, F.struct((F.col("offset") + 1).alias("offset"), written.alias("payload")))))
    first = leaves(index.select("archive", "offset", written.alias("payload")))
    second = leaves(index.select("archive", F.explode(places).alias("x")).select("archive", "x.offset", "x.payload"))
    wrong = audit(cut(first), cut(second))
    by_place = index.select(F.col("archive").cast("string").alias("archive"), "offset", "length", page.alias("page_id"))
    own, extra = wrong.where("expected IS NOT NULL"), wrong.where("expected IS NULL").withColumn("offset", F.col("offset") - 1)
    named = own.unionByName(extra).join(by_place, ["archive", "offset"])
    return named.select("page_id", "length", "expected", "found")


OP1_SQL = """
WITH r AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS w
  FROM pages),
s AS (
  SELECT page_id, w, CASE page_id % 97
    WHEN 5 THEN substring(w, 1, length(w) // 2) || chr(1) || substring(w, length(w) // 2 + 2)
    WHEN 6 THEN substring(w, 1, length(w) // 2)
    WHEN 7 THEN NULL ELSE w END AS x
  FROM r)
SELECT page_id, CAST(strlen(w) AS BIGINT) AS length, sha256(w) AS expected, sha256(x) AS found FROM s WHERE x IS DISTINCT FROM w
UNION ALL SELECT page_id, CAST(strlen(w) AS BIGINT), NULL, sha256(w) FROM s WHERE page_id % 97 = 8
"""
