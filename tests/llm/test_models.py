"""Quality classifier, packing and decontamination."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from lamina.llm import decontaminate, packing, quality_mil
from lamina.llm.common import blank
from tokenizers import Tokenizer

ROW = blank("row")


def labelled(n=400):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(n):
        good = " ".join(word() for _ in range(rng.randint(20, 500)))
        bad = rng.choice([lambda: " ".join([word()] * 90), lambda: " ".join(word().upper() + "!!" for _ in range(70)), lambda: " | ".join(word() for _ in range(120))])()
        rows.append((i, good if i % 4 else f"{bad}\n{good[:60]}", int(i % 4 > 0)))
    return rows


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = quality_mil.Model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, n, y = rng.normal(size=(9, quality_mil.FEATURES)), np.array([2, 3, 4]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(y * np.log(model.forward(x, n)["y"]) + (1 - y) * np.log(1 - model.forward(x, n)["y"]))
    for name, grad in model.gradients(x, n, y).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        model.p[name][at] += 1e-5
        up = loss()
        model.p[name][at] -= 2e-5
        down = loss()
        model.p[name][at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(grad[at], rel=2e-2, abs=1e-6)


def test_features_do_not_depend_on_the_company():
    texts = [r[1] for r in labelled(12)] + [None, "", " \n\t ", "x", "  lead and tail  "]
    x, n = quality_mil.features(texts)
    assert len(x) == n.sum() and (n >= 1).all()
    at = 0
    for text, k in zip(texts, n, strict=True):
        alone, one = quality_mil.features([text])
        assert one[0] == k and np.allclose(alone, x[at : at + k], atol=1e-5)
        at += k


def test_classifier_separates_held_out_rows(spark, odd_docs, no_docs):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    model = quality_mil.train(docs, labels)
    scored = {r.doc_id: r.score for r in quality_mil.score(docs, model).collect()}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    good, bad = [scored[r[0]] for r in out if r[2]], [scored[r[0]] for r in out if not r[2]]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    few = quality_mil.train(docs, labels, sample=50)
    assert few.trained and few.p["w"].tolist() != model.p["w"].tolist()
    odd = quality_mil.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality_mil.score(no_docs, model).collect() == []
    untrained = quality_mil.train(docs, labels.limit(0))
    assert {r.score for r in quality_mil.score(odd_docs, untrained).collect()} == {0.5}


def check_packing(rows, docs, capacity, tokenizer):
    by_doc, places = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    for doc, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert sorted(by_doc[doc]) == [(k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(ids[k : k + capacity].tobytes())) for k in range(0, len(ids), capacity)]
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packing_through_rounds(spark, odd_docs, no_docs):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    rows = [(r[0], r[1]) for r in labelled(200)] + [(1000, None), (1001, ""), (1002, "x " * 900), (1003, "漢字 🙂 <|endoftext|> it's")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    whole = check_packing(packing.pack(docs, capacity=512).collect(), rows, 512, tokenizer)
    split = check_packing(packing.pack(docs, capacity=512, group_rows=5).collect(), rows, 512, tokenizer)
    bound = -(-total // 512)
    assert bound <= whole <= 1.12 * bound and whole <= split <= 1.2 * bound
    sizes = [min(512, n - k) for _, t in rows for n in [len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1] for k in range(0, n, 512)]
    assert whole <= 1.03 * len(packing.best_fit(np.array(sizes), 512)[2])
    assert packing.pack(odd_docs).count() >= odd_docs.count() and packing.pack(no_docs).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(30)], "doc_id long, text string")
    rows = packing.sequences(packing.pack(docs, capacity=64, with_ids=True)).collect()
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    for r in rows:
        assert r.ids == [i for d in r.docs for i in [*tokenizer.encode(f"text number {d}", add_special_tokens=False).ids, 1]] and len(r.ids) <= 64
    assert sorted(d for r in rows for d in r.docs) == list(range(30))


def test_encoder_as_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBER", 300)
    rng, tokenizer, encoder = random.Random(9), Tokenizer.from_file(packing.TOKENIZER), packing.Encoder(packing.TOKENIZER)
    letters = [*"abcDEF'stre mdvl09.,!?<|>\t\n\x0bßÄéÿÀ×÷ªº²½  ́éİſK漢字🙂\x00\x1c-_", "<|endoftext|>", "'ll", "'S"]
    for _ in range(12):
        texts = ["".join(rng.choice(letters[: rng.choice([12, 40, 60])]) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, ""]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def brute_hits(texts, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    own = {k: words(t) for k, t in items}
    out = []
    for doc, text in texts:
        w, hit, found = words(text), set(), set()
        for item, x in own.items():
            n = min(window, len(x))
            wanted = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
            for i in range(len(w) - n + 1) if n else ():
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found.add(item)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def test_decontaminate(spark, odd_docs, no_docs):
    rng = random.Random(10)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 4, 9, 10, 11, 15, 40])))) for i in range(30)] + [(50, "..."), (51, None), (52, ""), (7, "alpha Beta, gamma!")]
    items = list(dict(items).items())
    texts = [(i, " ".join((word() if rng.random() < 0.9 else f"w{rng.randint(0, 9)}") for _ in range(rng.randint(0, 80)))) for i in range(150)]
    texts += [(1000 + i, f"x {t}, and {t} y") for i, t in items[:10]] + [(2000, None), (2001, "")] + [(2002, items[0][1])] * 3
    docs, benchmark = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 200):
        rows = decontaminate.figures(decontaminate.locate(docs, benchmark, block_bytes=block)).collect()
        assert Counter((r[ROW].doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) == brute_hits(texts, items)
    assert decontaminate.clean(odd_docs, benchmark).columns == odd_docs.columns
    assert decontaminate.clean(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    assert decontaminate.clean(no_docs, benchmark).collect() == []


def test_longest_matches(spark):
    item = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "a b " + " ".join(f"W{i}" for i in range(5, 31)) + " c " + " ".join(f"w{i}" for i in range(12)))], "doc_id long, text string")
    found = decontaminate.figures(decontaminate.locate(docs, spark.createDataFrame([(9, item)], "item_id long, text string"))).first()
    assert [(m.item_id, m.item_word, m.start, m.words) for m in sorted(found.matches, key=lambda m: m.start)] == [(9, 5, 2, 26), (9, 0, 29, 12)]
    assert found.n_hit == 38


def test_texts_without_a_word_of_any_item():
    probe = decontaminate.Probe([(1, " ".join(f"w{i}" for i in range(20))), (2, "lone")])
    assert decontaminate.search(["a b c", None, "", "lone"], probe) == [(3, [], []), (0, [], []), (0, [], []), (1, [(0, 1)], [(2, 0, 0, 1)])]
    assert decontaminate.search(["a b c"], probe) == [(3, [], [])] and decontaminate.search([], probe) == []


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3, n)) for n in (0, 1, 900, 2000, 40)] * 2
    shard = decontaminate.Shard(texts, 50)
    place = [int(s) + i for s, n in zip(shard.starts, shard.counts, strict=True) for i in range(n)]
    assert sorted(shard.suffixes.tolist()) == place and shard.counts.tolist() == [0, 1, 900, 2000, 40] * 2
    # What follows the end of a text, a 0, is no part of its suffixes.
    suffixes = [tuple(own[: own.index(0)] if 0 in own else own) for own in (shard.codes[p : p + 50].tolist() for p in shard.suffixes)]
    assert all(a <= b for a, b in zip(suffixes, suffixes[1:]))


def test_matches_of_shared_windows_do_not_multiply():
    preamble = " ".join(f"p{i}" for i in range(10))
    items = [(i, f"{preamble} own{i}") for i in range(300)] + [(1000 + i, "word") for i in range(300)]
    words, spans, matches = decontaminate.search([" ".join([preamble, "x"] * 50 + ["word"] * 200)], decontaminate.Probe(items))[0]
    assert words == 750 and len(matches) <= 50 + 200 + 600
    assert {m[0] for m in matches} == {i for i, _ in items} and sum(b - a for a, b in spans) == 700


def test_items_and_texts_with_ids_of_any_type(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([("a", f"x {item} y", 1), ("b", None, 2)], "doc_id string, text string, item_id long")
    found = decontaminate.figures(decontaminate.locate(docs, spark.createDataFrame([("q", item), (None, None)], "item_id string, text string"))).collect()
    assert sorted((r[ROW].doc_id, r[ROW].item_id, r.n_hit, [tuple(m) for m in r.matches]) for r in found) == [("a", 1, 12, [("q", 0, 1, 12)]), ("b", 2, 0, [])]
