"""Quality classifier (op 3): attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded (character classes, word shapes,
repetition and hashed byte pairs, through a learned layer); gated attention, learned from document labels
alone, weighs the passages; the score is the logistic value of the weighted representation. All weights are
trained together by gradient descent on the log loss.

Learning uses labelled rows whose crc32(doc_id as text) mod 5 is not 0, and at most ``SAMPLE`` of them, those
with the smallest hashes of their doc_id; that bound is what the driver holds in memory. Labels, language,
source and doc_id are inputs of no score. Scoring covers every passage of every document.

Defined results: null and blank texts are one passage without words and get a score from the same model; rows
with a null doc_id are never held out nor learned from; repeated rows get equal scores, very long texts have
as many passages as they need; a tie of the hash that picks the sample is broken by doc_id, then label; without
any label (empty tables) all scores are 0.5; an empty table gives an empty result; ids may be of any type, and
columns other than id and text are not read.

Scale: the sample's features are gathered once; one row of each sampled id counts (that of the smallest text hash),
and a document of over ``SAMPLE_PASSAGES`` passages is learned from that many of them, evenly spaced, so the driver
holds at most SAMPLE * SAMPLE_PASSAGES passages of 576 bytes. Scores are of all passages. The weights, some 100 kB,
go to the tasks with the function, and documents are scored in place without a shuffle, in slices of bounded text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import blank, ship, table

PASSAGE = 128
SAMPLE = 6000
#: Passages of a sampled document that are learned from at most.
SAMPLE_PASSAGES = 64
HASHED = 128
HIDDEN = 24
ATTENTION = 12
EPOCHS = 30
THRESHOLD = 0.3
#: Bytes of text that a worker holds the features' work arrays of at a time.
SLICE_BYTES = 4_000_000

#: Classes of bytes: white space, lower case, upper case, digits, bytes beyond ASCII, and marks.
CLASSES = [b" \t\n\x0b\x0c\r", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", bytes(range(128, 256)), b".,;:'\"()-", b"!?", b"#*$%&|<>", b"@/\\_=+~^`[]{}", b"\n"]
FEATURES = len(CLASSES) + 6 + HASHED
#: A large odd number for each byte.
MIXED = np.array([(b + 1) ** 5 * 0x9E3779B97F4A7C15 % 2**64 for b in range(256)], dtype=np.uint64)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, number of passages of each text); each text has one passage at least."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    space = np.zeros(256, dtype=bool)
    space[list(CLASSES[0])] = True
    blank_at = space[data]
    starts = np.flatnonzero(~blank_at & np.r_[True, blank_at[:-1]]) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(~blank_at & np.r_[blank_at[1:], True]) + 1 if len(data) else np.zeros(0, np.int64)
    doc = np.searchsorted(begins, starts, side="right") - 1
    n_words = np.bincount(doc, minlength=len(raw))
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    base = np.cumsum(n_passages) - n_passages
    place = np.arange(len(starts)) - (np.cumsum(n_words) - n_words)[doc]
    passage = base[doc] + place // PASSAGE
    total = int(n_passages.sum())
    # Each byte belongs to the passage of the last word begun at or before it; a text's lead to its first.
    owner = np.repeat(base, sizes + 1)
    if len(starts):
        first = np.r_[True, passage[1:] != passage[:-1]] & (place > 0)
        step = np.zeros(len(data) + 1, dtype=np.int64)
        step[starts[first]] = 1
        step = np.cumsum(step[:-1])
        owner = owner + step - step[begins].repeat(sizes + 1)
    out = np.zeros((total, FEATURES), dtype=np.float32)
    length = np.maximum(1, np.bincount(owner, minlength=total))[:, None]
    kinds = np.zeros((256, len(CLASSES)), dtype=np.float32)
    for k, members in enumerate(CLASSES):
        kinds[list(members), k] = 1
    histogram = np.bincount(owner * 256 + data, minlength=total * 256).reshape(total, 256)
    out[:, : len(CLASSES)] = histogram @ kinds / length
    at = len(CLASSES)
    if len(data) > 1:
        pair = (data[:-1].astype(np.int64) * 1031 + data[1:]) * 40503 % 65521 % HASHED
        cell = owner[:-1] * HASHED + pair
        counts = np.bincount(cell, minlength=total * HASHED)
        np.subtract.at(counts, cell[begins[1:] - 1], 1)  # pairs with the next text's first byte
        out[:, at + 6 :] = np.sqrt(counts.reshape(total, HASHED) / length)
    if len(starts):
        words = np.maximum(1, np.bincount(passage, minlength=total))
        width = (ends - starts).astype(np.float64)
        mean = np.bincount(passage, width, total) / words
        out[:, at] = mean / 10
        out[:, at + 1] = np.sqrt(np.maximum(0, np.bincount(passage, width**2, total) / words - mean**2)) / 10
        # A word's hash: the running sum of mixed bytes over the word, its length and its ends.
        mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(MIXED[data])])
        code = (mixed[ends] - mixed[starts]) ^ (data[starts].astype(np.uint64) << np.uint64(8)) ^ data[ends - 1]
        order = np.lexsort((code, passage))
        p, c = passage[order], code[order]
        new = np.r_[True, (p[1:] != p[:-1]) | (c[1:] != c[:-1])]
        out[:, at + 2] = np.bincount(p[new], minlength=total) / words
        run = np.diff(np.r_[np.flatnonzero(new), len(p)])
        most = np.zeros(total)
        np.maximum.at(most, p[new], run)
        out[:, at + 3] = most / words
        again = np.r_[False, (code[1:] == code[:-1]) & (passage[1:] == passage[:-1])]
        out[:, at + 4] = np.bincount(passage[again], minlength=total) / words
        out[:, at + 5] = np.bincount(passage, minlength=total) / PASSAGE
    return out, n_passages


class Model:
    """Gated attention over encoded passages, in numpy."""

    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed).normal
        d, h, a = FEATURES, HIDDEN, ATTENTION
        self.mean, self.scale = np.zeros(d, np.float32), np.ones(d, np.float32)
        shapes = {"w": (d, h), "b": (h,), "v": (h, a), "u": (h, a), "q": (a,), "c": (h,), "c0": (1,)}
        self.p = {k: (draw(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "qc" else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
        self.trained = False

    def forward(self, x: np.ndarray, n: np.ndarray) -> dict:
        """x: the passages of all bags, standardised; n: their number in each bag."""
        p, first = self.p, np.cumsum(n) - n
        bag = np.repeat(np.arange(len(n)), n)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["q"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": y, "bag": bag, "first": first}

    def score(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.forward((x - self.mean) / self.scale, n)["y"] if self.trained else np.full(len(n), 0.5)

    def fit(self, x: np.ndarray, n: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.004, decay: float = 1e-4, seed: int = 5) -> None:
        if not len(n) or labels.min() == labels.max():
            return
        self.mean, self.scale, self.trained = x.mean(axis=0), x.std(axis=0) + 1e-3, True
        x = (x - self.mean) / self.scale
        first, p, rng = np.cumsum(n) - n, self.p, np.random.default_rng(seed)
        m, s, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
        for _ in range(epochs):
            order = rng.permutation(len(n))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                rows = np.concatenate([np.arange(first[i], first[i] + n[i]) for i in own])
                grads = self.gradients(x[rows], n[own], labels[own])
                step += 1
                for k, g in grads.items():
                    g = g + decay * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g**2
                    p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)

    def gradients(self, x: np.ndarray, n: np.ndarray, labels: np.ndarray) -> dict:
        p, f = self.p, self.forward(x, n)
        h, t, g, a, bag, first = (f[k] for k in ("h", "t", "g", "a", "bag", "first"))
        dy = ((f["y"] - labels) / len(n)).astype(np.float32)
        dz = dy[:, None] * p["c"]
        da = (dz[bag] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first)[bag])
        dt, dg = de[:, None] * p["q"] * g * (1 - t**2), de[:, None] * p["q"] * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ p["v"].T + dg @ p["u"].T) * (1 - h**2)
        return {"w": x.T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "q": (t * g).T @ de, "c": f["z"].T @ dy, "c0": dy.sum(keepdims=True)}


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of slices of texts with a bounded size together."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= SLICE_BYTES):
            size += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """The model learned from at most ``sample`` labelled rows that are not held out."""
    ship(docs.sparkSession)
    usable = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    few = usable.orderBy(F.xxhash64(doc_id), doc_id, label).limit(sample).select(F.col(doc_id).alias(blank("id")), F.col(label).cast("int").alias("label"))
    rows = docs.select(F.col(doc_id).alias(blank("id")), F.col(text).alias("text")).join(F.broadcast(few), blank("id"))
    rows = rows.groupBy(blank("id")).agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("label").alias("label")).select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts):
                x, n = features(texts[a:b])
                parts = []
                for end, k in zip(np.cumsum(n).tolist(), n.tolist(), strict=True):
                    own = np.arange(end - k, end)
                    parts.append(x[own if k <= SAMPLE_PASSAGES else own[np.linspace(0, k - 1, SAMPLE_PASSAGES).astype(np.int64)]].tobytes())
                yield pa.record_batch([pa.array(parts, pa.binary()), batch.column(1).slice(a, b - a)], names=["x", "label"])

    bags = [(bytes(x), y) for x, y in rows.mapInArrow(run, "x binary, label int").collect()]
    bags.sort()  # the same model, however the rows arrive
    model = Model()
    parts = [np.frombuffer(x, dtype=np.float32).reshape(-1, FEATURES) for x, _ in bags]
    if parts:
        model.fit(np.concatenate(parts), np.array([len(x) for x in parts]), np.array([y for _, y in bags], dtype=np.float64))
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = [model.score(*features(texts[a:b])) for a, b in slices(texts)]
            yield pa.record_batch([batch.column(0), pa.array(np.concatenate([np.zeros(0), *out]), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def op3_quality_mil(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
