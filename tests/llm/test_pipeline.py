"""The pipeline against a brute-force version of its stages, and the entry module without the subpackage."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from conftest_llm import prose
from lamina.llm import packing
from test_models import brute_hits
from test_native import brute_lines, brute_stats
from test_near_copies import brute_labels
from tokenizers import Tokenizer


NOTICE = "all readers of this site agree to its terms and to the use of cookies by its partners"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(21)
    passage = [prose(rng, 14) for _ in range(4)]
    items = [(i, prose(rng, 25)) for i in range(5)]
    rows = []
    for i in range(80):
        lines = [prose(rng, rng.randint(8, 30)) for _ in range(rng.randint(2, 7))]
        if i % 9 == 0:
            lines += passage
        if i % 13 == 0:
            lines.append(f"{prose(rng, 3)} {items[i % 5][1]} {prose(rng, 3)}")
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}"))
    rows += [(100 + i, rows[i][1], "en", "s1") for i in range(8)] + [(200 + i, rows[20 + i][1] + "\n" + "x", "en", "s0") for i in range(6)]
    # A line of over 30 documents of a host: it goes, and documents of hardly anything else go with it.
    rows += [(400 + i, f"{prose(rng, 40)}\n{NOTICE}\n{prose(rng, 12)}", "en", "s9") for i in range(36)] + [(450 + i, f"{NOTICE}\n{prose(rng, 2)}", "en", "s9") for i in range(3)] + [(460, f"{NOTICE}\n{prose(rng, 30)}", "en", "s8")]
    rows += [(300, "junk " * 50, "en", "s0"), (301, None, None, None), (302, "", "en", "s0"), (303, "too short", "en", None), (304, prose(rng, 2500), "en", "s2")]
    return rows, items


@pytest.fixture(scope="module")
def sf_dir(spark, corpus, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    rows, items = corpus
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def brute_rules(rows):
    """Documents that pass the rules, without the lines that over 30 distinct texts and over 1 % of those of a host have."""
    texts, own = {}, lambda line: " ".join(line.lower().split())
    for _, t, _, host in rows:
        texts.setdefault(host, set()).add(t)
    count = Counter((host, line) for host, known in texts.items() for t in known for line in {own(x) for x in (t or "").split("\n")} - {""})
    above = {k for k, n in count.items() if n > 30 and n > 0.01 * len(texts[k[0]])}
    kept = []
    for i, t, _, host in rows:
        words, *_, repeated = brute_stats(t)
        lines = (t or "").split("\n")
        gone = sum(len(own(x).split()) for x in lines if (host, own(x)) in above)
        if words >= 10 and 100 * repeated <= 20 * words and not (gone and words - gone < 0.25 * words):
            kept.append((i, "\n".join(x for x in lines if (host, own(x)) not in above)))
    return kept


def brute(corpus):
    rows, items = corpus
    kept = brute_rules(rows)
    texts = brute_lines(kept)
    kept = [(i, texts[i]) for i, _ in kept]
    first = {}
    groups = brute_labels([t for _, t in kept])
    for (i, _), g in zip(kept, groups, strict=True):
        first[g] = min(i, first.get(g, i))
    kept = [(i, t) for i, t in kept if i in first.values()]
    hit = {r[0] for r in brute_hits(kept, items) if r[5]}
    return [(i, t) for i, t in kept if i not in hit]


def test_run_as_brute_force(spark, corpus, sf_dir):
    kept, tokenizer, wanted = brute(corpus), Tokenizer.from_file(packing.TOKENIZER), Counter()
    assert 80 < len(kept) < 120
    assert not any(NOTICE in t for i, t in kept if i != 460) and not {450, 451, 452} & {i for i, _ in kept}
    for i, text in kept:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        wanted.update((i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())) for k in range(0, len(ids), 4096))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        docs = out
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_pipeline_of_nothing_and_of_odd_rows(spark, odd_docs, no_docs, tmp_path, sf_dir):
    for name, docs in (("none", no_docs), ("odd", odd_docs.select("doc_id", "text", "lang", "source", "n_chars"))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()} <= {3, 4, 6, 7, 9, None}


def test_nothing_else_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in (root / "lamina").rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"lamina\.llm|corpus_pipeline", path.read_text()), path
