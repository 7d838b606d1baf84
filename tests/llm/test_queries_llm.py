"""The queries of the operators over whole small tables, against their SQL; ids of any type, and the classifier's accuracy."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest
from lamina.llm import common, near_copies, packing, quality_mil, queries, simhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "pages", "labels")

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_as_its_sql(spark, name):
    found = queries.QUERIES[name](spark, SF)
    names = sorted(found.columns)
    rows = Counter(tuple(plain(r[c]) for c in names) for r in found.collect())
    assert rows
    if name not in queries.ORACLES:
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    order = [x[0] for x in cursor.description]
    assert sorted(order) == names
    assert rows == Counter(tuple(plain(r[order.index(c)]) for c in names) for r in cursor.fetchall())


@needs_tables
def test_the_classifier_ranks_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.QUERIES["op3_quality_mil"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out AND quality IS NOT NULL").collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    pairs = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert len(good) > 20 and len(bad) > 3 and pairs >= 0.97 * len(good) * len(bad)


def test_ids_of_any_type(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([("b", text, 1), ("a", text, 2), ("c", None, 3), (None, "other words", 4)], "doc_id string, text string, id long")
    groups = {(r.id, r.component_id) for r in simhash.near_groups(docs).collect()}
    assert groups == {("b", "a"), ("a", "a"), ("c", "c"), (None, None)}
    assert {r.doc_id for r in near_copies.one_of_each(docs).collect()} == {"a", "c", None}
    assert Counter(r.id for r in packing.pack(docs).collect()) == Counter(["a", "b", "c", None])
    assert {r.doc_id for r in quality_mil.score(docs, quality_mil.Model()).collect()} == {"a", "b", "c", None}


def test_any_tokenizer_file(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Plain Latin text, it's 42 words.", "ÀÉ   x\tY\n", "漢字 🙂", "", None]
    tokenizer = Tokenizer.from_file(path)
    encoder = packing.Encoder(path)
    assert not encoder.splits and packing.Encoder(packing.TOKENIZER).splits
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def test_sides_of_joins_are_measured_in_bytes(spark):
    rows = spark.range(1000).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array_repeat(F.lit(1), 10).alias("list"))
    held = common.cut(rows)
    assert common.bytes_of(held) == 1000 * (common.ROW_BYTES + 1000 + 80)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(common.small(rows, 2_000_000)) and not hinted(common.small(rows, 1_000_000))
