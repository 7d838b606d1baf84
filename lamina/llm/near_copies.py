"""Near copies by word shingles: SimHash near-dedup (op 7) with an exact Jaccard similarity of 0.8 or more.

The distance of two SimHash fingerprints says little about a similarity near 0.8 (some ten of 64 bits differ,
which no covering code of short radius finds), so here the operator's links are candidates only, others join
them, and all are verified.

Candidates. (1) Fingerprints of five-word shingles that op 7 links through its anchors, equal ones included.
(2) Each distinct text has 25 MinHash bands of 5 values; two texts of similarity s share a band with
probability 1 - (1 - s^5)^25, which is 0.99995 at 0.8. Texts that share a band are tied to the smallest text of
the band, so ties grow with the rows, not with pairs.

Verification. A cluster's texts meet in a task, where a breadth-first search links those whose exact similarity
reaches the threshold. Clusters of over ``split`` texts or four million shingles are cut into buckets and every pair of buckets is
compared in a group of its own: no pair is left out, and memory is bounded, but such a cluster costs the square
of its buckets. Groups are the components of the verified links.

Defined results: texts of equal words are one text, blank and null ones among them; fewer words than a shingle
make one shingle; very long texts are shingled whole; repeated rows are one text; an empty table gives an empty
result; ids may be of any type; other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import cut, ship, small, tidy, words_of
from lamina.llm import simhash
from lamina.llm.simhash import NODE_BYTES, SEED, components, pick_one

SHINGLE = 5
SIMILAR = 0.8
BANDS, VALUES = 25, 5
#: Texts and shingles of a cluster beyond which it is cut into buckets.
SPLIT = 2048
SPLIT_SHINGLES = 4_000_000
#: The clusters' texts are found by a broadcast up to this many bytes; it is one alone, and spares a shuffle of all texts.
PLACED_BYTES = 8_000_000
FACTORS = np.random.default_rng(SEED).integers(0, 2**64, BANDS * VALUES, dtype=np.uint64) | np.uint64(1)
MIXERS = np.random.default_rng(SEED + 1).integers(0, 2**64, (BANDS, VALUES), dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles; none without words."""
    return np.unique(simhash.shingle_hashes(text, size))


def bands(own: np.ndarray) -> np.ndarray:
    """The values of the MinHash bands of a text with shingles."""
    least = np.full(BANDS * VALUES, np.iinfo(np.uint64).max)
    for at in range(0, len(own), 4096):
        mixed = own[at : at + 4096, None] * FACTORS
        least = np.minimum(least, ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)).min(axis=0))
    return (least.reshape(BANDS, VALUES) * MIXERS).sum(axis=1, dtype=np.uint64)


def verified(nodes: np.ndarray, sets: list[np.ndarray], similar: float = SIMILAR) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the exact links among some texts, found by breadth-first search."""
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    mark, rest, heads, tails = np.zeros(len(names), dtype=bool), np.arange(len(sets)), [], []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            mark[parts[one]] = True
            able = np.flatnonzero(np.minimum(sizes[rest], sizes[one]) >= similar * np.maximum(sizes[rest], sizes[one]))
            near = np.zeros(len(rest), dtype=bool)
            for at in range(0, len(able), 256):
                some = able[at : at + 256]
                n = sizes[rest[some]]
                both = np.add.reduceat(mark[np.concatenate([parts[i] for i in rest[some]])], np.r_[0, np.cumsum(n)[:-1]], dtype=np.int64)
                near[some] = both >= similar * (sizes[one] + n - both)
            mark[parts[one]] = False
            found, rest = rest[near], rest[~near]
            heads += [int(nodes[one])] * len(found)
            tails += nodes[found].tolist()
            front.extend(found)
    return heads, tails


def links(texts: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR, split: int = SPLIT) -> DataFrame:
    """(a, b): verified edges that connect the near copies among texts (node, text)."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                nodes, fps, sizes, found = [], [], [], [np.zeros(0, dtype=np.uint64)]
                for node, text in zip(batch.column(0)[at : at + 1000].to_pylist(), batch.column(1)[at : at + 1000], strict=True):
                    own = simhash.shingle_hashes(text.as_py(), shingle)
                    if len(own):
                        nodes.append(node)
                        fps.append(simhash.bits_of(own))
                        sizes.append(len(own))
                        found.append(bands(np.unique(own)))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1) * BANDS, pa.int32()), pa.array(np.concatenate(found).view(np.int64)))
                yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), listed], names=["node", "fp", "size", "bands"])
        tidy()

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []
        for batch in batches:
            for k, node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if k != key:
                    if len(nodes) > 1:
                        yield forest(nodes, sets)
                    key, nodes, sets = k, [], []
                nodes.append(node)
                sets.append(shingles(text.as_py(), shingle))
        if len(nodes) > 1:
            yield forest(nodes, sets)
        tidy()

    def forest(nodes, sets):
        heads, tails = verified(np.array(nodes, dtype=np.int64), sets, similar)
        return pa.record_batch([pa.array(heads, pa.int64()), pa.array(tails, pa.int64())], names=["a", "b"])

    spark = texts.sparkSession
    ship(spark)
    rows = cut(texts.mapInArrow(signed, "node long, fp long, size long, bands array<bigint>").dropDuplicates(["node"]))
    # Texts that share a band are tied to the smallest of them.
    each = rows.select("node", F.explode("bands").alias("band"))
    least = each.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1").select("band", "least")
    ties = each.join(small(least, NODE_BYTES), "band").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    # Texts of one fingerprint are tied to the smallest of them, those of linked ones to one another.
    heads = cut(rows.groupBy("fp").agg(F.min("node").alias("head")))
    same = rows.join(heads, "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    linked = simhash.links(heads)
    for end in "ab":
        linked = linked.join(heads.select(F.col("fp").alias(end), F.col("head").alias(f"{end}{end}")), end)
    ties = ties.unionByName(same).unionByName(linked.select(F.col("aa").alias("a"), F.col("bb").alias("b")))
    clusters = cut(components(ties))
    sized = clusters.join(rows.select("node", "size"), "node").groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    need = F.ceil(F.greatest(F.col("n") / split, F.col("size") / SPLIT_SHINGLES) * 2).cast("int")
    parts = sized.select("label", F.when(need > 2, need).otherwise(1).alias("parts"))
    placed = small(clusters.join(small(parts, NODE_BYTES), "label"), PLACED_BYTES)
    one = texts.join(placed, "node").groupBy("node", "label", "parts").agg(F.first("text").alias("text"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    pair = lambda j: F.least(own, j) * F.col("parts") + F.greatest(own, j)
    salted = one.select("node", "text", F.col("label"), F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), pair)).alias("part"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = salted.select(F.xxhash64("label", "part").alias("key"), "node", "text").repartition(tasks, "key").sortWithinPartitions("key")
    return keyed.mapInArrow(edges, "a long, b long")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """(id, body, label) of each row: its id, a hash of its text, and a name of its group."""
    node = F.xxhash64(F.array_join(words_of(F.col(text)), " "))
    final = small(components(links(docs.select(node.alias("node"), F.col(text).alias("text")), **limits)), NODE_BYTES)
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("body"), node.alias("node"))
    return rows.join(final, "node", "left").select("id", "body", F.coalesce("label", "node").alias("label"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row of each group of near copies, with its own columns, chosen as ``simhash.pick_one`` does."""
    return pick_one(docs, groups(docs, doc_id, text, **limits), doc_id, text)
