from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from lamina.llm import simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprints(odd_rows):
    for _, text, *_ in odd_rows:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_anchors_cover_all_links():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 2**64, 300, dtype=np.uint64)
    two = one.copy()
    for _ in range(3):
        two ^= np.uint64(1) << rng.integers(0, 64, len(one)).astype(np.uint64)
    a, fa, home = simhash.anchors_of(one)
    b, fb, _ = simhash.anchors_of(two)
    assert home.sum() == 2 * len(one) and np.bincount(np.searchsorted(np.unique(fa), fa)).max() <= 34
    homes = {(int(x), int(f)) for x, f, h in zip(a, fa, home, strict=True) if h}
    of = {}
    for x, f in zip(b, fb, strict=True):
        of.setdefault(int(f), set()).add(int(x))
    near = {}
    for x, f in homes:
        near.setdefault(f, set()).add(x)
    assert all(near[int(f)] & of[int(g)] for f, g in zip(one, two, strict=True))


def clustered(n, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            out.append(base)
            base ^= 1 << rng.randrange(64) if rng.random() < 0.8 else rng.getrandbits(5)
    return out


def test_groups_as_brute_force_also_when_anchors_are_split(spark):
    fps = clustered(40)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    marked = spark.createDataFrame([(i, 0, f) for i, f in enumerate(signed)], "id long, body long, fp long")
    want = brute_groups(fps)
    got = {r.id: r.component_id for r in simhash.group(marked).collect()}
    assert [got[i] for i in range(len(fps))] == want
    distinct = marked.select("fp").distinct()
    labels = {r.node: r.label for r in simhash.components(simhash.links(distinct, split=8)).collect()}
    for i, f in enumerate(signed):
        for j, g in enumerate(signed[:i]):
            if f != g:
                assert (want[i] == want[j]) == (f in labels and labels[f] == labels.get(g))


def test_long_chain_settles(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    labels = {r.node: r.label for r in simhash.components(edges).collect()}
    assert labels == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


def test_rounds_do_not_swell_the_size_estimate(spark):
    found = simhash.components(spark.range(200).selectExpr("id as a", "id + 1 as b"))
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 512
    assert found.selectExpr("count(*)", "count(distinct node)", "max(label)").first() == (201, 201, 0)


def test_odd_rows_and_one_of_each(spark, odd_docs, odd_rows, no_docs):
    rows = simhash.near_groups(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    blanks = {r.id: r.component_id for r in rows if r.fp == 0}
    assert blanks == {0: 0, 1: 0, 2: 0, None: 0}
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 2 and ids.count(0) == 1 and 1 not in ids and 5 not in ids and len(ids) == len(set(ids)) + 1
    assert simhash.near_groups(no_docs).collect() == [] and simhash.one_of_each(no_docs).collect() == []
