"""Benchmark decontamination (op 6) with suffix arrays of the training text.

Each task takes its documents in shards of a bounded number of words and builds a suffix array of each: the
places of all its words, sorted by the words that follow, as deep as the longest test item. The array does not
depend on the items; those come in blocks, and every block is searched in it. Every test suffix that is long
enough to hold a window is binary-searched: the range found has all its occurrences and their places. An
occurrence that does not go on to the left is extended by the words that both sides have in common, which gives
the longest verbatim matches.

A window is ten consecutive words of an item, or the whole item if it has fewer. Words are
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined results: a null text or item has no words; an item without words matches nothing; rows with equal
item_ids are one item; items of equal words are searched once and reported each. Of the longest matches, each
place of a document where one begins is given once (the longest there; of equal ones the first item) and each
item of a document once (its longest; of equal ones the first in the item, then in the text); of a window that
an item has twice the first counts. Very long texts are shards of their own; repeated documents get equal
results; empty tables give empty or clean results; all columns of the input stay, in a struct, so no name can
clash; ids may be of any type.

Scale: documents are read once, in one stage, and never shuffled, however large the benchmark: the items are
sent in blocks of at most ``block_bytes`` of text (one longer item is a block of its own), one block is on the
driver at a time, and a worker holds one beside its shard. Spans are unions, and matches are one for each place
and one for each document and item, so neither grows with the product of occurrences and items that share them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lamina.llm.common import blank, ship, table, tidy

WINDOW = 10
BLOCK_BYTES = 4_000_000
SHARD_WORDS = 1_000_000
#: Pairs of an occurrence and a text that are looked at together.
MOST_PAIRS = 2_000_000

#: Lower case for A-Z; what is no word byte becomes a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

ROW, N_WORDS, SPANS, MATCHES = (blank(x) for x in ("row", "n_words", "spans", "matches"))
SPAN_TYPE = "array<struct<start:bigint,stop:bigint>>"


def words_of(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts as bytes, the number of words of each)."""
    plain = [(t or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES) for t in texts]
    split = pc.ascii_split_whitespace(pa.array(plain, pa.large_binary()).cast(pa.large_string(), safe=False))
    flat, ends = split.values.cast(pa.large_binary()), split.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(full)), np.diff(np.r_[0, np.cumsum(full)][ends])


class Probe:
    """A block of test items: their distinct texts as codes of the block's words, and the windows of these."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        flat, counts = words_of([text for _, text in items])
        coded = flat.dictionary_encode()
        self.words = coded.dictionary
        ends, codes = np.cumsum(counts), coded.indices.to_numpy().astype(np.int64) + 1
        known: dict[bytes, int] = {}
        self.ids: list[list] = []  # of the items of each distinct text
        self.texts: list[np.ndarray] = []
        for (item_id, _), end, n in zip(items, ends.tolist(), counts.tolist(), strict=True):
            own = codes[end - n : end]
            if n:
                at = known.setdefault(own.tobytes(), len(known))
                if at == len(self.ids):
                    self.ids.append([])
                    self.texts.append(own)
                if item_id not in self.ids[at]:
                    self.ids[at].append(item_id)
        self.sizes = np.array([len(x) for x in self.texts], dtype=np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([*self.texts, np.zeros(1, np.int64)])
        # A row for each window of each text; shorter texts are one window.
        n = np.where(self.sizes > window, self.sizes - window + 1, 1)
        text = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        width = np.minimum(self.sizes, window)[text]
        inside = np.arange(window) < width[:, None]
        rows = np.where(inside, self.flat[np.minimum((self.firsts[text] + at)[:, None] + np.arange(window), len(self.flat) - 1)], 0)
        self.windows, of = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        self.width = (self.windows > 0).sum(axis=1)
        # (window, text, place): the first place of a window in each text that has it.
        order = np.lexsort((at, text, of))
        w, t = of[order], text[order]
        new = np.r_[True, (w[1:] != w[:-1]) | (t[1:] != t[:-1])][: len(order)]
        self.owner_text, self.owner_at = t[new], at[order][new]
        self.owners = np.searchsorted(w[new], np.arange(len(self.windows) + 1))
        self.longest = int(self.sizes.max(initial=0))


class Shard:
    """The suffix array of some texts over all their words, sorted to a depth or deeper."""

    def __init__(self, texts: list[str | None], depth: int):
        flat, self.counts = words_of(texts)
        coded = flat.dictionary_encode()
        self.words = coded.dictionary
        self.bits = max(1, len(self.words).bit_length())
        self.per = 63 // self.bits
        self.starts = np.cumsum(self.counts + 1) - self.counts - 1
        # Codes from 1 on; a 0 ends each text, and as many follow the last as are ever looked at.
        self.codes = np.zeros(int((self.counts + 1).sum()) + 2 * depth + 2 * self.per + 64, dtype=np.int64)
        place = np.arange(len(flat)) + np.repeat(np.arange(len(self.counts)), self.counts)
        self.codes[place] = coded.indices.to_numpy() + 1
        self.key = np.zeros(len(self.codes) - self.per + 1, dtype=np.int64)
        for j in range(self.per):
            self.key = self.key << self.bits | self.codes[j : len(self.key) + j]
        self.sort(place, depth)

    def sort(self, place: np.ndarray, depth: int) -> None:
        """Sort by the first words, then the ties by the rank of what follows, twice as deep each time."""
        self.suffixes = place[np.argsort(self.key[place], kind="stable")]
        run, sorted_to = self.key[self.suffixes], self.per
        new = np.r_[True, run[1:] != run[:-1]][: len(run)]
        rank = None
        while sorted_to < depth and not new.all():
            if rank is None:
                rank = np.zeros(len(self.codes), dtype=np.int64)
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            rank[self.suffixes] = first + 1  # a group's rank is the place of its first
            tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
            group, follow = first[tied], rank[np.minimum(self.suffixes[tied] + sorted_to, len(rank) - 1)]
            order = np.lexsort((follow, group))
            self.suffixes[tied] = self.suffixes[tied][order]
            follow = follow[order]
            new[tied] = np.r_[True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])]
            sorted_to *= 2

    def packed(self, codes: np.ndarray) -> np.ndarray:
        """Rows of codes as ``per`` codes to a number, level by level."""
        levels = -(-codes.shape[1] // self.per)
        wide = np.pad(codes, ((0, 0), (0, levels * self.per - codes.shape[1])), mode="edge")
        out = np.zeros((len(codes), levels), dtype=np.int64)
        for level in range(levels):
            for j in range(self.per):
                out[:, level] = out[:, level] << self.bits | wide[:, level * self.per + j]
        return out

    def bound(self, wanted: np.ndarray, right: bool) -> np.ndarray:
        """For each wanted row the number of suffixes below it (right: or equal to it), by binary search."""
        low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(self.suffixes), dtype=np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            suffix = self.suffixes[np.minimum(middle, len(self.suffixes) - 1)]
            below, equal = np.zeros(len(wanted), dtype=bool), np.ones(len(wanted), dtype=bool)
            for level in range(wanted.shape[1]):
                own = self.key[suffix + level * self.per]
                below |= equal & (own < wanted[:, level])
                equal &= own == wanted[:, level]
            below |= equal & right
            low = np.where(open_ & below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low

    def occurrences(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of windows, place) of every occurrence; windows are rows of codes, 0 behind their end."""
        if not len(self.suffixes) or not len(windows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        width = windows.shape[1]
        levels = -(-width // self.per) * self.per
        padded = np.pad(windows, ((0, 0), (0, levels - width)))
        low = self.bound(self.packed(padded), False)
        high = self.bound(self.packed(np.where(padded > 0, padded, (1 << self.bits) - 1)), True)
        n = np.maximum(0, high - low)
        row = np.repeat(np.arange(len(n)), n)
        return row, self.suffixes[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]

    def search(self, probe: Probe) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Of a block's items: spans (document, start, stop), and matches (document, text, place in it, start, words)."""
        none = (np.zeros(0, np.int64),)
        mine = np.r_[0, pc.fill_null(pc.index_in(probe.words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1]
        lacking = np.r_[False, mine[1:] == 0]
        whole = np.flatnonzero(~lacking[probe.windows].any(axis=1))
        row, place = self.occurrences(mine[probe.windows[whole]])
        if not len(row):
            return none * 3, none * 5
        window = whole[row]
        doc = np.searchsorted(self.starts, place, side="right") - 1
        start = place - self.starts[doc]
        spans = union(doc, start, start + probe.width[window])

        # Occurrences times the texts that have the window, a bounded number at a time.
        n = np.diff(probe.owners)[window]
        item = np.append(np.r_[mine, 0][probe.flat[:-1]], 0)  # the words of the texts as codes of the shard; 0 is no word
        parts = np.flatnonzero(np.diff(np.cumsum(n) // MOST_PAIRS, prepend=0, append=-1))
        best, first = [], 0
        for last in np.unique(np.r_[parts, len(n)]).tolist():
            if last > first:
                best.append(self.longest(probe, item, window[first:last], doc[first:last], place[first:last], n[first:last]))
                first = last
        return spans, reduced(*(np.concatenate(x) for x in zip(*best, strict=True)))

    def longest(self, probe: Probe, item: np.ndarray, window: np.ndarray, doc: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, text, place in it, start, words) of the longest matches that begin with these occurrences."""
        each = np.repeat(np.arange(len(window)), n)
        owner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(probe.owners[window], n)
        text, at, p, d = probe.owner_text[owner], probe.owner_at[owner], place[each], doc[each]
        here = probe.firsts[text] + at
        # What goes on to the left is part of the match that begins there.
        begins = np.flatnonzero((at == 0) | (p == 0) | (self.codes[p - 1] != item[here - 1]) | (item[here - 1] == 0))
        text, at, p, d, here, size = text[begins], at[begins], p[begins], d[begins], here[begins], probe.width[window][each[begins]]
        alive = np.arange(len(begins))
        while len(alive):
            alive = alive[(at[alive] + size[alive] < probe.sizes[text[alive]]) & (self.codes[p[alive] + size[alive]] > 0)]
            alive = alive[self.codes[p[alive] + size[alive]] == item[here[alive] + size[alive]]]
            size[alive] += 1
        return reduced(d, text, at, p - self.starts[d], size)


def reduced(doc: np.ndarray, text: np.ndarray, at: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of some matches the longest of each text in each document, and the longest from each place of a document."""
    if len(doc):
        by_text, by_place = np.lexsort((start, at, -size, text, doc)), np.lexsort((at, text, -size, start, doc))
        new = lambda order, x: np.r_[True, (doc[order][1:] != doc[order][:-1]) | (x[order][1:] != x[order][:-1])]
        stays = np.union1d(by_text[new(by_text, text)], by_place[new(by_place, start)])
        doc, text, at, start, size = (x[stays] for x in (doc, text, at, start, size))
    return doc, text, at, start, size


def union(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of documents, merged where they touch or overlap, in order."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    step = int(stop.max()) + 2  # documents one after the other, with a gap
    far = np.maximum.accumulate(doc * step + stop)
    first = np.flatnonzero(np.r_[True, (doc * step + start)[1:] > far[:-1]])
    return doc[first], start[first], np.maximum.reduceat(stop, first)


def search(texts: list[str | None], probes: Probe | list, depth: int | None = None) -> list[tuple[int, list, list]]:
    """(words, spans, matches) of each text of a shard.

    ``probes`` is a block of items, or a list of functions that open one each, with the longest item's words as depth.
    """
    probes, depth = ([lambda own=probes: own], probes.longest) if isinstance(probes, Probe) else (probes, depth)
    shard, spans, matches = Shard(texts, depth or WINDOW), [], []
    for opened in probes:
        probe = opened()
        own, best = shard.search(probe)
        spans.append(own)
        told = set()  # of items of equal words the first gets all matches, the others the longest
        for d, text, at, start, n in sorted(zip(*(x.tolist() for x in best), strict=True), key=lambda m: (m[0], m[1], -m[4], m[2], m[3])):
            ids = probe.ids[text][: 1 if (d, text) in told else None]
            told.add((d, text))
            matches += [(d, (i, at, start, n)) for i in ids]
        del probe
    found = [(n, [], []) for n in shard.counts.tolist()]
    if spans:
        for d, start, stop in zip(*(x.tolist() for x in union(*(np.concatenate(x) for x in zip(*spans, strict=True)))), strict=True):
            found[d][1].append((start, stop))
    for d, match in matches:
        found[d][2].append(match)
    return found


def blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of bounded text, one block on the driver at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col(item_id), F.col(text)).where(F.col(text).isNotNull()).toLocalIterator():
        if held and size + len(row[1]) > block_bytes:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += len(row[1])
    if held:
        yield held


def locate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs as one struct column, with the number of words, the hit spans (in words) and each item's longest match."""
    spark = docs.sparkSession
    ship(spark)
    sent, depth = [], window
    for block in blocks(benchmark, item_id, item_text, block_bytes):
        probe = Probe(block, window)
        depth = max(depth, probe.longest)
        sent.append(spark.sparkContext.broadcast(probe))
        del probe
    kind = benchmark.select(item_id).schema[0].dataType.simpleString()
    match_type = f"array<struct<item_id:{kind},item_word:int,start:bigint,words:int>>"
    rows = docs.select(F.struct("*").alias(ROW))
    schema = rows.select(ROW, F.lit(0).cast("long").alias(N_WORDS), F.expr("array()").cast(SPAN_TYPE).alias(SPANS), F.expr("array()").cast(match_type).alias(MATCHES)).schema
    field = docs.columns.index(text)

    def opener(block):
        def opened():
            probe = block.value
            if len(sent) > 1:  # a worker keeps what it has opened, which would be all blocks in the end
                vars(block).pop("_value", None)
            return probe

        return opened

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = [opener(b) for b in sent]
        id_type = to_arrow_type(schema[MATCHES].dataType.elementType["item_id"].dataType)
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        match = pa.list_(pa.struct([("item_id", id_type), ("item_word", pa.int32()), ("start", pa.int64()), ("words", pa.int32())]))
        for batch in batches:
            texts = batch.column(0).field(field).to_pylist()
            out, at = [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= 6 * SHARD_WORDS):
                    size += len(texts[end] or "")
                    end += 1
                out += search(texts[at:end], probes, depth)
                at = end
            spans = pa.array([[{"start": a, "stop": b} for a, b in x[1]] for x in out], span)
            matches = pa.array([[dict(zip(("item_id", "item_word", "start", "words"), m, strict=True)) for m in x[2]] for x in out], match)
            yield pa.record_batch([batch.column(0), pa.array([x[0] for x in out], pa.int64()), spans, matches], names=[ROW, N_WORDS, SPANS, MATCHES])
        tidy()

    return rows.mapInArrow(run, schema)


def figures(found: DataFrame) -> DataFrame:
    """The located rows with n_words, n_hit, n_items, items_sha256 and contaminated."""
    n_hit = F.aggregate(SPANS, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    items = F.array_distinct(F.transform(MATCHES, lambda m: m["item_id"]))
    joined = F.array_join(F.sort_array(F.transform(items, lambda x: x.cast("string"))), ",")
    return found.select(
        ROW,
        F.col(N_WORDS).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"),
        (F.size(SPANS) > 0).alias("contaminated"),
        F.col(MATCHES).alias("matches"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any window of the benchmark, with their own columns."""
    return locate(docs, benchmark, text).where(F.size(SPANS) == 0).select(f"{ROW}.*")


def op6_decontaminate(spark, sf_dir) -> DataFrame:
    found = locate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return figures(found).select(F.col(ROW)["doc_id"].alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP6_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(lower_text, '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM documents)),
iw AS (
  SELECT item_id, regexp_extract_all(lower_text, '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM benchmark)),
sizes AS (SELECT DISTINCT least(len(w), 10) AS n FROM iw WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS body
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM iw WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS body
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, t.item_id FROM doc_windows d JOIN item_windows t ON t.n = d.n AND t.body = d.body),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(coalesce(len(dw.w), 0) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items t USING (doc_id)
"""
