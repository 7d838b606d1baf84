"""Best-fit packing (op 5) by hierarchical residual packing.

Documents become token ids and an end id; only longer ones are cut, into pieces of the sequence length. Each
partition packs its pieces best-fit (longest first, into the fullest bin that has room) and emits nearly full
bins. Underfull bins are the items of the next round: they are dealt into fewer groups, best-fitted again as
whole items, and so on up the tree until one group holds all that is left or a round gains nothing.

Defined results: a null text is an empty one, of the end id alone; repeated rows are packed as rows of their
own; an empty table gives an empty result. Bin ids are (partition, running number), so they are unique.

Scale: documents are read and tokenized once, without a shuffle; what moves is a row of a few numbers per
piece or bin. A group of a round has ``group_rows`` rows on average, so no task holds all bins of a large
corpus: where more than one group is left at the end, each has thousands of bins to choose from and another
round would gain nothing. The way from a bin to its sequence is joined once, on unique keys.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import cut, ship, small, table, tidy

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096
END = 1
#: A bin with no more room than this share is nearly full.
SLACK = 0.01
SHARD_PIECES = 100_000
GROUP_ROWS = 20_000
#: Pieces of text whose ids a worker remembers.
REMEMBER = 200_000
#: Bytes of text that a worker encodes at a time; a piece of text met twice in them is looked at once.
SLICE_BYTES = 4_000_000

#: Texts of these characters only are split here; others by the tokenizer itself.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: The pieces of words.
PIECES = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+)"
#: The steps of a tokenizer file before its model, for which PIECES gives the same pieces.
STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class Remembered(dict):
    """Numbers pieces of text in the order of their first appearance."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Token ids of texts by any tokenizer file.

    If the file's steps before its model are STEPS, plain text is split here, and its pieces are encoded once
    each and remembered, within a bound. All other text, and all text of other files, goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        steps = json.loads(Path(path).read_text())
        self.marks = [x["content"] for x in steps.get("added_tokens") or []]
        self.splits = all(steps.get(k) == v for k, v in STEPS.items()) and steps["model"].get("type") == "BPE" and not steps["model"].get("dropout")
        self.model = Tokenizer(self.whole.model)
        # Byte-level alphabet: visible bytes stand for themselves, the others for the code points from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in seen]
        self.letters = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}

        # The first known piece is the empty one, which has no ids.
        self.known, self.hits = Remembered({"": 0}), np.zeros(1, np.int64)
        self.known.new = []
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def forget(self) -> None:
        """Keep only the pieces that were met most often, half of the bound at most."""
        self.hits[0] = np.iinfo(np.int64).max
        names, keep = list(self.known), np.argsort(-self.hits, kind="stable")[: REMEMBER // 2]
        keep = keep[self.hits[keep] > 0]
        self.flat, self.sizes = gather(self.flat, self.starts[keep], self.sizes[keep]), self.sizes[keep]
        self.starts, self.hits = np.cumsum(self.sizes) - self.sizes, np.zeros(len(keep), np.int64)
        self.known = Remembered((names[k], i) for i, k in enumerate(keep.tolist()))
        self.known.new = []

    def learn(self) -> None:
        new, self.known.new = self.known.new, []
        if not new:
            return
        letters = self.letters
        # The characters of a plain ASCII piece are visible, so they are their own letters.
        spelled = [p if p.isascii() else "".join([letters[b] for b in p.encode()]) for p in new]
        ids = [x.ids for x in self.model.encode_batch_fast(spelled, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(sizes.sum()))])

    def plain(self, text: str | None) -> bool:
        return self.splits and text is not None and PLAIN.fullmatch(text) is not None and not any(m in text for m in self.marks)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, the end id last; views of one array that holds them all."""
        plain = [self.plain(text) for text in texts]
        words = pc.utf8_split_whitespace(pc.utf8_lower(pa.array([t if p else "" for t, p in zip(texts, plain, strict=True)], pa.large_string())))
        bounds = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        del words
        if len(self.known) > REMEMBER:
            self.forget()
        # Pieces of each distinct word, then ids of each distinct word, then ids of the words as they stand.
        spaced = pc.utf8_rtrim(pc.replace_substring_regex(coded.dictionary, pattern=PIECES, replacement=r"\1 "), characters=" ")
        listed = pc.split_pattern(spaced, pattern=" ")
        parts = listed.flatten().dictionary_encode()
        number = np.fromiter(map(self.known.__getitem__, parts.dictionary.to_pylist()), dtype=np.int64, count=len(parts.dictionary))[parts.indices.to_numpy()]
        n_parts = np.diff(listed.offsets.to_numpy())
        del spaced, listed, parts
        self.learn()
        self.hits = np.bincount(number, minlength=len(self.known)) + np.r_[self.hits, np.zeros(len(self.known) - len(self.hits), np.int64)]
        # One more word, the last, has the end id alone; it follows the words of each text.
        word_ids = np.append(gather(self.flat, self.starts[number], self.sizes[number]), np.uint32(END))
        ends = np.append(np.r_[0, np.cumsum(self.sizes[number])][np.cumsum(n_parts)], len(word_ids))
        sizes = np.diff(ends, prepend=0)
        index = np.insert(coded.indices.to_numpy(), bounds[1:], len(sizes) - 1)
        n_ids = sizes[index]
        ids = gather(word_ids, (ends - sizes)[index], n_ids)
        stops = np.r_[0, np.cumsum(n_ids)][bounds + np.arange(len(bounds))]
        for text, own, first, last in zip(texts, plain, stops[:-1].tolist(), stops[1:].tolist(), strict=True):
            yield ids[first:last] if own else np.array([*self.whole.encode(text or "", add_special_tokens=False).ids, END], dtype=np.uint32)


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of flat that begin at starts, one after the other."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(n, len(flat)) < 2**31 else np.int64  # the places are the largest arrays here
    places = np.repeat((starts - ends + sizes).astype(kind), sizes)
    places += np.arange(n, dtype=kind)
    return flat[places]


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin, offset) of each item and the fill of each bin: longest first, into the fullest bin with room."""
    bins, offsets, fills = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: a bin has room r
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, own = capacity, len(fills)
            fills.append(0)
        bins[at], offsets[at] = own, fills[own]
        fills[own] += size
        if room > size:
            with_room.setdefault(room - size, []).append(own)
            rooms |= 1 << room - size
    return bins, offsets, fills


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces packed within their partition: id, piece, start, length, ids_crc32, bin, offset, fill (and ids)."""
    ship(docs.sparkSession)
    names = ["id", "piece", "start", "length", "ids_crc32", "bin", "offset", "fill", *["ids"] * with_ids]
    most = SHARD_PIECES if not with_ids else SHARD_PIECES // 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, owners, number, crc32 = (TaskContext.get().partitionId() + 1) << 40, [], [], 0, zlib.crc32
        encoder = None  # of this task only: the worker goes on to other stages, which need the memory
        for batch in batches:
            owner, texts = batch.column(0), batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for first, last in zip(cuts, cuts[1:]):
                counts, encoder = [], encoder or Encoder(path)
                for tokens in encoder.encode(texts.slice(first, last - first).to_pylist()):
                    for start in range(0, len(tokens), capacity):
                        part = tokens[start : start + capacity]
                        held.append((start // capacity, start, len(part), crc32(part), *([part.astype(np.int32)] if with_ids else [])))
                    counts.append(-(-len(tokens) // capacity))
                owners.append(owner.take(pa.array(np.repeat(np.arange(first, last), counts))))
                if len(held) >= most:
                    out, number = packed(held, owners, base, number)
                    held, owners = [], []
                    yield out
        if held:
            yield packed(held, owners, base, number)[0]
        del encoder
        tidy()

    def packed(held: list[tuple], owners: list[pa.Array], base: int, number: int) -> tuple[pa.RecordBatch, int]:
        columns = [list(x) for x in zip(*held, strict=True)]
        bins, offsets, fills = best_fit(np.array(columns[2]), capacity)
        found = [pa.concat_arrays(owners), pa.array(columns[0], pa.int32()), *(pa.array(x, pa.int64()) for x in columns[1:4])]
        found += [pa.array(bins + (base + number)), pa.array(offsets), pa.array(np.array(fills)[bins])]
        if with_ids:
            found.append(pa.array(columns[4], pa.list_(pa.int32())))
        return pa.record_batch(found, names=names), number + len(fills)

    own = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"id {own.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long" + ", ids array<int>" * with_ids
    return own.mapInArrow(run, schema)


def merge_round(bins: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    """(bin, parent, shift, fill): underfull bins, best-fitted as whole items in each group."""

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(ids := group.column("bin").to_numpy())
        ids, fill = ids[order], group.column("fill").to_numpy()[order]
        own, offsets, fills = best_fit(fill, capacity)
        names = np.full(len(fills), np.iinfo(np.int64).max)
        np.minimum.at(names, own, ids)
        return pa.table({"bin": ids, "parent": names[own], "shift": offsets, "fill": np.array(fills)[own]})

    dealt = bins.select("bin", "fill", F.pmod(F.xxhash64("bin", F.lit(number)), F.lit(groups)).alias("dealt"))
    return dealt.groupBy("dealt").applyInArrow(run, "bin long, parent long, shift long, fill long")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of each piece."""
    placed = cut(pieces(docs, doc_id, text, path, capacity, with_ids))
    full = capacity - int(capacity * SLACK)
    bins = cut(placed.where(F.col("fill") < full).groupBy("bin").agg(F.max("fill").alias("fill")))
    way, left, number = None, bins.count(), 0
    while left > 1:
        number, groups = number + 1, -(-left // group_rows)
        moved = cut(merge_round(bins, groups, number, capacity))
        if way is None:
            way = moved.select("bin", "parent", "shift")
        else:
            step = moved.select(F.col("bin").alias("parent"), F.col("parent").alias("next"), F.col("shift").alias("more"))
            way = cut(way.join(step, "parent", "left").select("bin", F.coalesce("next", "parent").alias("parent"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")))
        if groups == 1:
            break
        bins = cut(moved.where(F.col("fill") < full).groupBy(F.col("parent").alias("bin")).agg(F.max("fill").alias("fill")))
        before, left = left, bins.count()
        if left > before * 0.98:
            break
    if way is None:
        found = placed.withColumn("parent", F.lit(None).cast("long")).withColumn("shift", F.lit(0).cast("long"))
    else:
        found = placed.join(small(way), "bin", "left")
    return found.select(
        "id", "piece", "start", "length", "ids_crc32", F.coalesce("parent", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"), *["ids"] * with_ids
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, docs): the token ids of each sequence, from pack(with_ids=True)."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "id", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"), F.transform("parts", lambda x: x["id"]).alias("docs"))


def op5_packing(spark, sf_dir) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
