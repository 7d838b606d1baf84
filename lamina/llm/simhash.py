"""SimHash near-dedup (op 7) by anchor-point covering.

A document's fingerprint has a bit for each bit that is set in over half of the XXH64 hashes (seed 42) of its
three-word shingles. Two fingerprints link if they differ in at most three of 64 bits; documents are grouped
by the components of these links.

Anchors. If two fingerprints differ in at most three bits, one of their two 32-bit halves differs in at most
one. For a half, the anchors are the words of a covering code: the Hamming code of length 31 (covering radius
1) times the free 32nd bit, 2^27 anchors. Each half has one home anchor, within the covering radius 1, and is
replicated to every anchor within radius + threshold = 2 of it, 17 at most. If two halves differ in one bit
at most, the home anchor of one is within 2 of the other, so both meet there: no link is lost. Within an
anchor the whole fingerprints are compared, and only the edges of a spanning forest are emitted.

Groups. Each distinct fingerprint takes part once, however many copies it has. Anchors with more rows than
``split`` are cut into buckets by a hash of the fingerprint, and every pair of buckets is compared in a group
of its own: exact, and bounded in memory. The spanning edges are contracted by alternating large-star and
small-star rounds, with joins that adaptive execution can split; nothing is collected to the driver.

Defined results: null and blank texts have no words and fingerprint zero, which is linked like any other;
very long texts are hashed whole; the group's id is the smallest doc_id in it (nulls do not count; null if
there is no other), of whatever type the ids are; repeated rows are rows of one group; an empty table gives an
empty result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import blank, cut, cut_unsized, hash_side, ship, small, table

SHINGLE = 3
THRESHOLD = 3
SEED = 42
#: Rows of an anchor beyond which it is cut into buckets.
SPLIT = 2048
#: A side that grows with the linked rows is broadcast up to this many bytes only: the driver builds each one, and
#: every round of the contraction has two.
NODE_BYTES = 2_000_000
BITS = np.array([[b >> i & 1 for i in range(8)] for b in range(256)], dtype=np.int64)


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of a text's shingles, repeats included; of all words if they are fewer; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return np.fromiter((digest(run, SEED) for run in runs), dtype=np.uint64, count=len(words) - shingle + 1)


def bits_of(hashes: np.ndarray) -> int:
    """The bits that are set in over half of some hashes; 0 without any."""
    if len(hashes) > 1500:
        octets = hashes.view(np.uint8).reshape(-1, 8)
        counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ BITS for i in range(8)])
    else:
        counts = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; 0 without words."""
    return bits_of(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, body, fp): the id, a hash of the text and the fingerprint (as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(values.view(np.int64))], names=["id", "body", "fp"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("body"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, body long, fp long")


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, fp, home) for every anchor that each fingerprint is replicated to."""
    anchors, owners, homes = [], [], []
    index = np.arange(len(fps))
    for half in (0, 1):
        x = fps >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)
        low, top = x & np.uint64(0x7FFFFFFF), x & np.uint64(0x80000000)
        side = np.uint64(half << 32)
        syndrome = np.zeros(len(fps), dtype=np.uint64)
        for j in range(5):
            mask = np.uint64(sum(1 << i for i in range(31) if i + 1 >> j & 1))
            syndrome |= (np.bitwise_count(low & mask).astype(np.uint64) & np.uint64(1)) << np.uint64(j)
        flip = lambda s: np.where(s == 0, np.uint64(0), np.uint64(1) << (np.maximum(s, np.uint64(1)) - np.uint64(1)))
        code = low ^ flip(syndrome)
        for word, home, rows in ((code | top, True, index), (code | (top ^ np.uint64(0x80000000)), False, index)):
            anchors.append(word | side)
            owners.append(rows)
            homes.append(np.full(len(rows), home))
        for a in range(1, 32):
            b = syndrome ^ np.uint64(a)
            at = np.flatnonzero((syndrome != 0) & (b > a))
            anchors.append((low[at] ^ flip(np.full(len(at), a, dtype=np.uint64)) ^ flip(b[at])) | top[at] | side)
            owners.append(at)
            homes.append(np.zeros(len(at), dtype=bool))
    return np.concatenate(anchors), fps[np.concatenate(owners)], np.concatenate(homes)


def replicate(fps: DataFrame) -> DataFrame:
    """(anchor, fp, home): each fingerprint at every anchor within covering radius plus threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, fp, home = anchors_of(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.record_batch([pa.array(anchor.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(home)], names=["anchor", "fp", "home"])

    # Dealt out first: a few thousand fingerprints are few bytes, which adaptive execution would leave in one task.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fps.select("fp").repartition(tasks, "fp").mapInArrow(run, "anchor long, fp long, home boolean")


def spanning(fps: np.ndarray, threshold: int = THRESHOLD) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges of a spanning forest of the links among some fingerprints, found by breadth-first search."""
    rest, heads, tails = np.unique(fps), [], []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            near = np.bitwise_count(rest ^ one) <= threshold
            if near.any():
                found, rest = rest[near], rest[~near]
                heads.append(np.full(len(found), one))
                tails.append(found)
                front.extend(found)
    return heads, tails


def linked(key: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) from the rows of whole groups, equal keys standing together."""
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[first, len(key)])
    good = (sizes > 1) & np.logical_or.reduceat(home, first)
    heads, tails = [], []
    few = np.repeat(good & (sizes <= 16), sizes)
    fp_few, key_few = fp[few], key[few]
    for step in range(1, 16):
        if len(fp_few) <= step:
            break
        same = np.flatnonzero(key_few[step:] == key_few[:-step])
        near = same[np.bitwise_count(fp_few[same] ^ fp_few[same + step]) <= threshold]
        heads.append(fp_few[near])
        tails.append(fp_few[near + step])
    for at in np.flatnonzero(good & (sizes > 16)):
        a, b = spanning(fp[first[at] : first[at] + sizes[at]], threshold)
        heads += a
        tails += b
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *heads]), np.concatenate([none, *tails])


def links(fps: DataFrame, split: int = SPLIT) -> DataFrame:
    """(a, b): edges that connect all distinct fingerprints within the threshold of one another."""
    spark = fps.sparkSession
    rows = replicate(fps)
    hot = small(rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > split))
    parts = F.ceil(F.col("n") * 2 / split).cast("int")
    dealt = rows.join(hot, "anchor", "left").withColumn("parts", F.coalesce(parts, F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pair = lambda j: F.least(own, j) * F.col("parts") + F.greatest(own, j)
    salted = dealt.select("anchor", "fp", "home", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), pair)).alias("part"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = salted.select(F.xxhash64("anchor", "part").alias("key"), "fp", "home").repartition(tasks, "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp, home = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.view(np.uint64)
            if held is not None:
                key, fp, home = (np.concatenate(x) for x in zip(held, (key, fp, home), strict=True))
            last = int(np.searchsorted(key, key[-1]))  # the last group may go on in the next batch
            held = key[last:].copy(), fp[last:].copy(), home[last:].copy()
            if last:
                yield edges(key[:last], fp[:last], home[:last])
        if held is not None:
            yield edges(*held)

    def edges(key, fp, home):
        a, b = linked(key, fp, home)
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return placed.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component of each node that has an edge.

    The rounds go on until nothing changes; their number grows with the logarithm of the longest chain.
    """
    star = cut_unsized(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    state = None
    while True:
        both = star.unionByName(star.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = small(both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("node"), F.least("v", "m").alias("m")), NODE_BYTES)
        # Large star: each larger neighbour of a node moves to the smallest neighbour of the node.
        large = both.where("u > v").join(least, F.col("v") == F.col("node")).select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = cut(large)
        lower = small(large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("node"), "m"), NODE_BYTES)
        # Small star: each smaller neighbour of a node, and the node, move to the smallest of them.
        met = large.join(lower, F.col("v") == F.col("node"))
        ends = met.select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u")))).alias("e"))
        star = cut_unsized(ends.select("e.*").where("u <> v").distinct())
        now = star.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == state:
            return star.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(star.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct())
        state = now


def group(marked: DataFrame) -> DataFrame:
    """marked (id, body, fp) with label, a fingerprint that names the group, and component_id, its smallest id."""
    copies = cut(marked.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    labels = cut(components(links(copies)))
    named = copies.join(labels, copies["fp"] == labels["node"], "left").select("fp", "least", "n", F.col("label"))
    lowest = cut(named.where("label is not null").groupBy("label").agg(F.min("least").alias("lowest")))
    grouped = named.join(lowest, "label", "left").where("n > 1 or label is not null")
    lowest_id = F.when(F.col("label").isNull(), F.col("least")).otherwise(F.col("lowest"))
    known = small(grouped.select("fp", F.coalesce("label", "fp").alias("label"), lowest_id.alias("lowest")))
    component = F.when(F.col("label").isNotNull(), F.col("lowest")).otherwise(F.col("id"))
    return marked.join(known, "fp", "left").select("id", "body", "fp", F.coalesce("label", "fp").alias("label"), component.alias("component_id"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, body, fp, label, component_id) of each row."""
    return group(cut(fingerprints(docs, doc_id, text)))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near_groups, with its own columns."""
    return pick_one(docs, near_groups(docs, doc_id, text), doc_id, text)


def pick_one(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group (id, body, label): the smallest doc_id (null last), then the smallest text hash."""
    groups = cut(groups)
    best = groups.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "body")).alias("best"))
    again = groups.groupBy("id", "body").agg(F.count("*").alias(blank("d_n"))).withColumnsRenamed({"id": blank("d_id"), "body": blank("d_body")})
    pick = best.select("best.id", "best.body")
    chosen = pick.join(again, pick["id"].eqNullSafe(again[blank("d_id")]) & (pick["body"] == again[blank("d_body")])).drop("id", "body")
    names = {n: blank(f"d_{n}") for n in ("id", "body", "n")}
    chosen = hash_side(chosen)
    found = docs.withColumn(blank("body"), F.xxhash64(F.col(text)))
    kept = found.join(chosen, (found[blank("body")] == chosen[names["body"]]) & found[doc_id].eqNullSafe(chosen[names["id"]]))
    once = kept.where(F.col(names["n"]) == 1)
    if chosen.where(F.col(names["n"]) > 1).isEmpty():
        return once.select(*docs.columns)
    return once.unionByName(kept.where(F.col(names["n"]) > 1).dropDuplicates([doc_id, blank("body")])).select(*docs.columns)


def op7_simhash(spark, sf_dir) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
