from __future__ import annotations

import zlib
from collections import Counter

from lamina.llm import sharding
from lamina.llm.sharding import ROW


def test_fisher_yates_is_a_seeded_permutation():
    one = sharding.fisher_yates(500, 1, 2)
    assert sorted(one.tolist()) == list(range(500))
    assert one.tolist() == sharding.fisher_yates(500, 1, 2).tolist() != sharding.fisher_yates(500, 1, 3).tolist()


def test_rows_law_and_round_trip(odd_docs, odd_rows):
    rows = sharding.shuffle(odd_docs, shards=4, bucket_bytes=2000).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[s] for s in range(4)) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert Counter((r[ROW].doc_id, r[ROW].text) for r in rows) == Counter(x[:2] for x in odd_rows)
    assert rows[0][ROW].asDict().keys() == set(odd_docs.columns)


def test_order_differs_by_seed_only(odd_docs):
    order = lambda seed: [(r[ROW].doc_id, r.shard, r.slot) for r in sorted(sharding.shuffle(odd_docs, seed=seed).collect(), key=lambda r: (r.shard, r.slot))]
    assert order(1) == order(1) != order(2)


def test_empty_and_write(spark, odd_docs, no_docs, tmp_path):
    assert sharding.shuffle(no_docs).collect() == []
    sharding.write_shards(sharding.shuffle(odd_docs.select("doc_id", "text"), shards=4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd_docs.count()


def test_query_digest(spark, tmp_path, odd_docs):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    for r in sharding.op2_sharding(spark, str(tmp_path)).collect():
        assert r.law == "rows" and r.grown_shard is None
    texts = Counter((r.doc_id, r.size, r.text_crc32) for r in sharding.op2_sharding(spark, str(tmp_path)).collect())
    assert texts == Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in odd_docs.collect())


def test_nothing_is_lost_from_inputs_that_are_no_plain_scan(spark):
    docs = spark.range(1200).selectExpr("id % 1000 as doc_id", "repeat(concat('w', id % 1000, ' '), cast(id % 40 as int)) as text")
    for source in (docs.repartition(7), docs.where("doc_id % 3 > 0").repartition(5, "doc_id"), docs.dropDuplicates(["doc_id"])):
        source = source.withColumn("x", source["doc_id"] * 2)
        rows = sharding.shuffle(source, shards=16, bucket_bytes=500).collect()
        assert Counter(r[ROW].doc_id for r in rows) == Counter(r.doc_id for r in source.select("doc_id").collect())
        sizes = Counter(r.shard for r in rows)
        assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
        for s in sizes:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", None), ("b", None)], "doc_id string, text string")
    assert Counter(r[ROW].doc_id for r in sharding.shuffle(docs, shards=2).collect()) == {"a": 1, "b": 2}
