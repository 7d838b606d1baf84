"""The filtered model, its checks, payloads, hashes and the command line."""

from __future__ import annotations

import json

from lamina.operators import model
from lamina.plans import product
from pyspark.sql import functions as F
from test_engine import analysis  # noqa: F401


def test_a_sound_model_and_a_broken_one(analysis):  # noqa: F811
    assert product.verify(analysis).collect() == []
    broken = product.Analysis(dict(analysis.relations))
    broken["blocks"] = analysis["blocks"].withColumn("depth", F.when(F.col("ord") == 1, None).otherwise(F.col("depth"))).where("ord <> 3")
    broken["labels"] = analysis["labels"].limit(1)
    assert {"block_incomplete", "block_lost", "label_lost"} <= {r["check"] for r in product.verify(broken).collect()}


def test_the_filter_leaves_places(analysis):  # noqa: F811
    left_out = {r.table_id for r in model.gone(analysis["labels"]).collect()}
    after = product.filtered(analysis)
    for name in ("tables", "cells", "records", "linking"):
        assert not left_out & {r.table_id for r in after[name].select("table_id").distinct().collect()}
    assert not left_out & {x for r in after["linking"].collect() for x in r.child_ids}
    assert after["blocks"].count() == analysis["blocks"].count()
    for r in after["blocks"].where("excluded_reason <> ''").collect():
        assert r.table_id in left_out and r.text == ""
    again = product.filtered(after)
    assert product.compared(after["tables"], again["tables"]).collect() == []
    assert product.compared(analysis["tables"].limit(0), analysis["tables"]).first().side == "right"


def test_payload_summary_and_hashes(analysis):  # noqa: F811
    row = product.debug_payload(analysis).first()
    found = json.loads(row.payload)
    assert found["summary"]["n_blocks"] == len(found["blocks"]) == analysis["blocks"].count()
    assert {t["label"] for t in found["tables"]} == {r.label for r in analysis["labels"].collect()}
    one = {r.part: (r.n, r.hash) for r in product.hashes(analysis).collect()}
    again = product.Analysis(dict(analysis.relations))
    again["cells"] = analysis["cells"].repartition(3)
    again["records"] = analysis["records"].withColumn("value", F.concat("value", F.lit("!")))
    two = {r.part: (r.n, r.hash) for r in product.hashes(again).collect()}
    assert {k for k in one if one[k] != two[k]} == {"records"}
    assert "First part" in product.embedding_text(analysis).first().text
    assert product.warnings(analysis).where("code = 'nested_table_present'").first().n == 1


def test_command_line(spark, tmp_path):
    import zipfile

    from test_engine import BODY, HEAD

    with zipfile.ZipFile(tmp_path / "one.hwpx", "w") as out:
        out.writestr("Contents/section0.xml", f'<s:sec xmlns:s="urn:s" xmlns:p="urn:p">{BODY}</s:sec>')
        out.writestr("Contents/header.xml", HEAD)
        out.writestr("Contents/content.hpf", "<o:package xmlns:o='urn:o'/>")
    assert product.main([str(tmp_path), f"{tmp_path}/out", "--debug"]) == 0
    assert spark.read.parquet(f"{tmp_path}/out/summary").count() == 1
    assert spark.read.json(f"{tmp_path}/out/debug").count() == 1
    assert spark.read.json(f"{tmp_path}/out/model").count() == 1
