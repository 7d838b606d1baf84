"""Contents entries are met in the documents of all sources."""

from __future__ import annotations

from lamina.plans import registry


def test_toc_match_reads_every_document(spark, tmp_path):
    rows = [(i, f"Opening line\nChapter of part {i}\nClosing line", source) for i, source in enumerate(("src0", "src1", None))]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.QUERIES["toc_match"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.entry, r.ord, r.method) for r in found} == {(i, 1, 1, "exact") for i in range(3)}
