"""Near copies against brute force on exact shingle sets."""

from __future__ import annotations

import random

import corpus_pipeline
from lamina.llm import common, near_copies, simhash


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_labels(texts, similar=0.8):
    sets, label = [shingle_set(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if (not a and not b) or (a and b and len(a & b) >= similar * len(a | b)):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def near_texts():
    """Pairs and chains with one to eight changed words of 150: similarity from 0.97 to 0.57."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    texts = [None, "", " \n", "one two", "One  two"]
    for i in range(60):
        words = [word() for _ in range(150)]
        texts.append(" ".join(words))
        for _ in range(1 + i % 3):
            for at in rng.sample(range(150), 1 + i % 8):
                words[at] = word()
            texts.append(" ".join(words))
    return texts


def partition(labels):
    found = {}
    for i, x in enumerate(labels):
        found.setdefault(x, []).append(i)
    return sorted(found.values())


def test_groups_as_brute_force_also_when_clusters_are_split(spark):
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = partition(brute_labels(texts))
    for split in (2048, 2):
        got = {r.id: r.label for r in near_copies.groups(docs, split=split).collect()}
        assert partition([got[i] for i in range(len(texts))]) == want


def test_the_stage_links_what_three_bits_do_not(spark):
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert kept == {x[0] for x in partition(brute_labels(texts))}
    assert len(simhash.one_of_each(docs).collect()) > len(kept)


def test_the_driver_builds_no_side_that_grows_with_the_links(spark, monkeypatch):
    hinted, plain = [], common.F.broadcast
    monkeypatch.setattr(common.F, "broadcast", lambda df: hinted.append(common.bytes_of(df)) or plain(df))
    n = 60_000
    pairs = spark.range(0, n, 2).selectExpr("id + 1 as a", "id as b")
    found = simhash.components(pairs).selectExpr("count(*)", "count(distinct node)", "count_if(label = node - node % 2)")
    assert tuple(found.first()) == (n, n, n)
    assert max(hinted, default=0) <= 2_000_000
    hinted.clear()
    texts = [f"{i} {i + 1} {i + 2} {i + 3} {i + 4} {c}" for i in range(0, 48_000, 2) for c in ("a", "a b")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near_copies.groups(docs, shingle=1, similar=0.8).write.format("noop").mode("overwrite").save()
    assert sum(x > 2_000_000 for x in hinted) <= 1 and max(hinted, default=0) <= 8_000_000
