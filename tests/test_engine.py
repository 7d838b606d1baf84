"""Packages through the whole engine, and the operators that only it uses."""

from __future__ import annotations

import json
import zipfile

import pytest
from lamina.operators import contents, structure
from lamina.plans import engine
from lamina.sources import package

HEAD = '<h:head xmlns:h="urn:h"><h:paraPr id="0"/><h:paraPr id="1"><h:heading type="OUTLINE" level="0"/></h:paraPr><h:charPr id="0" height="1000"/><h:charPr id="1" height="1600"><h:bold/></h:charPr></h:head>'


def p(text, para=0, char=0):
    return f'<p:p paraPrIDRef="{para}"><p:run charPrIDRef="{char}"><p:t>{text}</p:t></p:run></p:p>'


def table(ident, rows, spans=None):
    spans = spans or {}
    trs = "".join(
        "<p:tr>" + "".join(f'<p:tc><p:subList>{p(t) if not t.startswith("<") else "<p:p><p:run>" + t + "</p:run></p:p>"}</p:subList><p:cellAddr rowAddr="{r}" colAddr="{c}"/><p:cellSpan rowSpan="{spans.get((r, c), 1)}" colSpan="1"/></p:tc>' for c, t in enumerate(row) if t is not None) + "</p:tr>"
        for r, row in enumerate(rows)
    )
    return f'<p:tbl id="{ident}" rowCnt="{len(rows)}" colCnt="{max(map(len, rows))}">{trs}</p:tbl>'


DATA = table(2, [["구분", "목표", "실적"], ["north", "1,200", "900"], [None, "800", "750"], ["south", "10", "20"]], {(1, 0): 2})
BODY = (
    p("목 차") + p("1 First part ..... 3") + p("1.1 Detail ..... 4") + p("2 Second part ..... 9")
    + p("First part", 1, 1) + p("some text of the first part that goes on for a while and then some more") + p("Detail", 1, 1) + p("다. more text")
    + f"<p:p><p:run>{DATA}</p:run></p:p>" + p("Second part", 1, 1)
    + "<p:p><p:run>" + table(3, [["a box", table(4, [["nested", "x"]])]]) + "</p:run></p:p>" + p("- last words")
)


@pytest.fixture(scope="module")
def analysis(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("engine")
    with zipfile.ZipFile(at / "one.hwpx", "w") as out:
        out.writestr("Contents/section0.xml", f'<s:sec xmlns:s="urn:s" xmlns:p="urn:p">{BODY}</s:sec>')
        out.writestr("Contents/header.xml", HEAD)
        out.writestr("Contents/content.hpf", "<o:package xmlns:o='urn:o'/>")
    return engine.analyze(package.read(spark, str(at)))


def test_records_and_types(analysis):
    ids = {r.table_id: r.xml_id for r in analysis["tables"].collect()}
    kinds = {ids[r.table_id]: r.table_type for r in analysis["types"].collect()}
    assert kinds["2"] == "data_table"
    rows = {(r.record, r.key): (r.value, r.inherited) for r in analysis["records"].collect() if ids[r.table_id] == "2"}
    assert rows[0, "목표"] == ("1,200", False) and rows[1, "구분"] == ("north", True) and rows[2, "실적"] == ("20", False)
    assert {ids[r.table_id]: r.verdict for r in analysis["numeric"].collect()}["2"] == "numeric"
    assert {ids[r.table_id]: r.label for r in analysis["labels"].collect()}["2"] == "keep_records"
    assert analysis["issues"].where("severity = 'ERROR'").collect() == []


def test_contents_anchor_depths(analysis):
    assert [(r.numbering, r.page) for r in analysis["toc_entries"].orderBy("i").collect()] == [("1", "3"), ("1.1", "4"), ("2", "9")]
    depths = {r.text: (r.depth, r.anchored) for r in analysis["blocks"].collect() if r.text}
    assert depths["First part"] == (0, True) and depths["Detail"] == (1, True) and depths["Second part"] == (0, True)
    assert depths["다. more text"][0] == 2 and depths["- last words"][0] == 1


def test_renderings_lose_no_text(analysis):
    text = analysis["context"].first().text
    for piece in ("목 차", "First part", "some text of the first part", "1,200", "nested", "- last words"):
        assert piece in text


def test_model_and_sinks(spark, analysis, tmp_path):
    engine.write(analysis, str(tmp_path))
    row = json.loads(spark.read.text(f"{tmp_path}/model").first().value)
    assert [b["ord"] for b in row["blocks"]] == list(range(len(row["blocks"])))
    detail = next(b for b in row["blocks"] if b.get("text") == "Detail")
    assert detail["heading_path"] == ["First part", "Detail"]
    assert any("| 구분 | 목표 | 실적 |" in t["markdown"] for t in row["tables"])
    assert spark.read.parquet(f"{tmp_path}/records").count() == analysis["records"].count()


def test_structural_issues(spark):
    tables = spark.createDataFrame([("t", 2, 2)], "table_id string, n_rows long, n_cols long")
    rows = [("t", "a", 0, 0, 0, 0, 1, 1), ("t", "b", 1, 0, 0, 1, 3, 1), ("t", "c", 2, 1, None, 0, 1, 1), ("t", "d", 3, 1, 0, 0, 0, 1), ("t", "e", 4, 2, 0, 0, 1, 1)]
    cells = spark.createDataFrame(rows, "table_id string, cell_id string, cell_ord long, xml_row long, r long, c long, row_span long, col_span long")
    got = {(r.code, r.cell_id) for r in structure.issues(tables, cells).collect()}
    assert got == {("ROW_COUNT_MISMATCH", None), ("ROW_ORDER_MISMATCH", None), ("ROW_OUT_OF_RANGE", "b"), ("MISSING_CELL_ADDR", "c"), ("INVALID_CELL_SPAN", "d"), ("DUPLICATED_GRID_SLOT", None), ("EMPTY_GRID_SLOT", None)}


def test_form_sections(spark):
    rows = [(0, 0, 1, 4, "Form"), (1, 0, 2, 1, "대    학"), (1, 1, 1, 1, "k"), (1, 2, 1, 2, "v"), (2, 1, 1, 1, "k2"), (2, 2, 1, 2, ""), (3, 0, 1, 4, "wide"), (4, 0, 1, 1, "a"), (4, 1, 1, 1, "b"), (4, 2, 1, 1, "c"), (5, 0, 1, 1, "only")]
    cells = spark.createDataFrame([(1, *r) for r in rows], "table_id long, r long, c long, row_span long, col_span long, text string")
    got = [(r.name, r.kind, r.key, r.value) for r in structure.form_sections(cells).orderBy("r").collect()]
    assert got == [("문서 제목", "item", "제목", "Form"), ("대학", "item", "k", "v"), ("대학", "item", "k2", ""), ("대학", "wide", "", "wide"), ("기본 정보", "raw", "", "a | b | c"), ("기본 정보", "item", "only", "")]


def test_order_in_groups(spark):
    rows = [(1, "p", 10, 12, 2), (1, "p", 10, 13, 1), (1, "q", 20, 21, 1), (1, "q", 20, 22, 2)]
    got = {(r.anchor, r.xml_ord): (r.place, r.moved) for r in structure.order_in_groups(spark.createDataFrame(rows, "doc_id long, anchor string, anchor_ord long, ord long, xml_ord long")).collect()}
    assert got == {("p", 1): (10.001, True), ("p", 2): (10.002, True), ("q", 1): (21.0, False), ("q", 2): (22.0, False)}


def test_entries_end_after_three_misses(spark):
    lines = ["목차", "x", "y", "z", "1 a", "no", "no", "2 b", "no", "no", "no", "3 c"]
    blocks = spark.createDataFrame([(1, 0, i, "paragraph", t) for i, t in enumerate(lines)], "doc_id long, section long, ord long, block_type string, text string")
    none = spark.createDataFrame([], "doc_id long, section long, ord long, table_id string, n long, text string")
    anchor = contents.find_anchor(blocks, none)
    assert [r.title for r in contents.entries(anchor, blocks, none).orderBy("i").collect()] == ["a", "b"]
