"""Packages from bytes to relations: two namespaces prefixes, spans, nesting, controls, captions, drawn objects."""

from __future__ import annotations

import zipfile

import pytest
from lamina.operators import audits
from lamina.sources import package
from lamina.streaming import packages

HEAD = """<hh:head xmlns:hh="urn:head"><hh:paraPr id="1"><hh:align horizontal="CENTER"/><hh:heading type="OUTLINE" idRef="0" level="2"/><hh:margin><hh:intent value="10"/><hh:left value="600"/></hh:margin></hh:paraPr>
<hh:charPr id="7" height="1400"><hh:bold/></hh:charPr><hh:charPr id="8" height="1000"/><hh:style id="3" engName="Body" paraPrIDRef="1" charPrIDRef="8"/><hh:bullet id="2" char="•"/>
<hh:numbering id="4"><hh:paraHead level="1" numFormat="DIGIT" start="1">^1.</hh:paraHead></hh:numbering></hh:head>"""
CELL = '<hp:tc header="1"><hp:subList vertAlign="CENTER"><hp:p paraPrIDRef="1"><hp:run charPrIDRef="7">{run}</hp:run></hp:p></hp:subList><hp:cellAddr rowAddr="{r}" colAddr="{c}"/><hp:cellSpan rowSpan="{rs}" colSpan="1"/></hp:tc>'
NESTED = '<hp:tbl id="55" rowCnt="1" colCnt="1"><hp:tr>' + CELL.format(run="<hp:t>inner</hp:t>", r=0, c=0, rs=1) + "</hp:tr></hp:tbl>"
DRAWN = '<hp:rect><hp:offset x="0" y="900"/><hp:drawText><hp:t>below</hp:t></hp:drawText></hp:rect><hp:rect><hp:offset x="0" y="4294967253"/><hp:drawText><hp:t>above</hp:t></hp:drawText></hp:rect>'
TABLE = (
    '<hp:tbl id="44" rowCnt="2" colCnt="2" pageBreak="CELL" repeatHeader="1"><hp:sz width="100" height="50"/><hp:pos treatAsChar="1" vertOffset="30"/><hp:caption><hp:t>a  caption</hp:t></hp:caption><hp:tr>'
    + CELL.format(run="<hp:t>one<hp:tab/>two</hp:t>", r=0, c=0, rs=2)
    + CELL.format(run="<hp:t>up</hp:t>" + DRAWN, r=0, c=1, rs=1)
    + "</hp:tr><hp:tr>"
    + CELL.format(run="<hp:t>see</hp:t>" + NESTED + '<hp:pic><hc:img xmlns:hc="urn:core" binaryItemIDRef="img1"/><hp:caption><hp:t>fig</hp:t></hp:caption></hp:pic>', r=1, c=1, rs=1)
    + "</hp:tr></hp:tbl>"
)
ONE = (
    '<hs:sec xmlns:hs="urn:sec" xmlns:hp="urn:para"><hp:p paraPrIDRef="1" styleIDRef="3"><hp:run charPrIDRef="7"><hp:secPr><hp:pagePr width="59528" height="84188"><hp:margin left="8504"/></hp:pagePr></hp:secPr><hp:t>Title<hp:lineBreak/>second</hp:t></hp:run>'
    '<hp:run charPrIDRef="8"><hp:t> part</hp:t><hp:compose composeText="①"/></hp:run></hp:p>'
    "<hp:p><hp:run><hp:t>Table 1 prices</hp:t></hp:run></hp:p>"
    f"<hp:p><hp:run>{TABLE}</hp:run></hp:p><hp:p><hp:run><hp:t>※ a note</hp:t></hp:run></hp:p><hp:p><hp:run><hp:t>자료: us</hp:t></hp:run></hp:p>"
    '<hp:p><hp:run><hp:ctrl><hp:footNote><hp:t>foot  note</hp:t></hp:footNote><hp:colPr/></hp:ctrl><hp:ellipse><hp:curSz width="5" height="6"/><hp:t>round</hp:t></hp:ellipse><hp:container zOrder="3"><hp:rect><hp:pos treatAsChar="1"/></hp:rect><hp:rect/><hp:pic/></hp:container></hp:run></hp:p></hs:sec>'
)
TWO = '<x:sec xmlns:x="urn:sec" xmlns:y="urn:para"><y:p><y:run><y:t>other prefix</y:t></y:run></y:p></x:sec>'
MANIFEST = '<opf:package xmlns:opf="urn:opf"><opf:title>A title</opf:title><opf:meta name="creator">me</opf:meta><opf:item id="img1" href="BinData/i.png" media-type="image/png"/></opf:package>'


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("packages")
    for name in ("a", "b"):
        with zipfile.ZipFile(at / f"{name}.hwpx", "w") as out:
            out.writestr("Contents/section10.xml", TWO)
            out.writestr("Contents/section2.xml", ONE)
            out.writestr("Contents/header.xml", HEAD)
            out.writestr("Contents/content.hpf", MANIFEST)
            out.writestr("version.xml", '<v:version xmlns:v="urn:v" application="App" appVersion="1, 2"/>')
            out.writestr("BinData/i.png", b"12345")
    return str(at)


@pytest.fixture(scope="module")
def parsed(spark, folder):
    return package.sections(package.read(spark, folder)).cache()


def one(df):
    return df.where("path LIKE '%a.hwpx'")


def test_nodes(parsed):
    rows = one(package.nodes(parsed)).orderBy("ord").collect()
    kinds = ["paragraph", "section_control", "paragraph", "paragraph", "table", "caption", "paragraph", "paragraph", "paragraph", "footnote", "control", "shape", "shape_group", "paragraph"]
    assert [r.node_type for r in rows] == kinds and [r.ord for r in rows] == list(range(14)) and [r.section for r in rows] == [0] * 13 + [1]
    assert rows[0].text == "Title\nsecond part①" and rows[0].lines == 2 and rows[0].line_variation == 1.0 and rows[0].has_sec_pr
    assert [(x.char_pr, x.text) for x in rows[0].runs] == [("7", "Title\nsecond"), ("8", " part①")]
    assert rows[4].xml_id == "44" and rows[4].table_index == 0 and rows[4].inline and rows[5].text == "a caption"
    assert rows[9].text == "foot note" and rows[10].object_type == "colPr" and (rows[11].text, rows[11].width) == ("round", "5")
    assert rows[4].source_path == "Contents/section2.xml#hp:p[2]/hp:tbl" and rows[13].text == "other prefix"
    assert rows[1].page_info == {"width": "59528", "height": "84188", "margin.left": "8504"} and rows[4].anchor_info == {"vertOffset": "30"}
    # The place of an object inside a group is not that of the group.
    assert rows[12].inner_objects == {"rect": 2, "pic": 1} and rows[12].inline is None and rows[12].anchor_info == {"zOrder": "3"}


def test_tables_and_cells(parsed):
    tables = {r.table_id: r for r in one(package.tables(parsed)).collect()}
    assert set(tables) == {"section0_tbl0_44", "section0_tbl0_44_r1_c1_nested_tbl0_55"}
    top, inner = tables["section0_tbl0_44"], tables["section0_tbl0_44_r1_c1_nested_tbl0_55"]
    assert (top.n_rows, top.n_cols, top.repeat_header, top.page_break, top.width, top.treat_as_char) == (2, 2, True, True, 100, True)
    assert (top.caption_candidate, top.note_candidate, top.source_candidate) == ("Table 1 prices", "※ a note", "자료: us")
    assert (inner.parent_table_id, inner.parent_cell_id) == ("section0_tbl0_44", "section0_tbl0_44_r1_c1")
    cells = {r.cell_id: r for r in one(package.cells(parsed)).collect()}
    assert cells["section0_tbl0_44_r0_c0"].text == "one\ttwo" and cells["section0_tbl0_44_r0_c0"].row_span == 2 and cells["section0_tbl0_44_r0_c0"].header
    assert cells["section0_tbl0_44_r0_c1"].text == "up above below" and cells["section0_tbl0_44_r0_c1"].has_shape
    nested = cells["section0_tbl0_44_r1_c1"]
    assert nested.text == "see" and nested.nested == ["section0_tbl0_44_r1_c1_nested_tbl0_55"] and nested.has_image
    assert [(x.kind, x.ref, x.text) for x in nested.extras] == [("image", "img1", None), ("caption", "img1", "fig")]
    assert [r.cell_ord for r in sorted(cells.values(), key=lambda r: r.cell_ord) if r.table_id == "section0_tbl0_44"] == [0, 1, 2]


def test_styles_and_info(spark, folder):
    parts = package.read(spark, folder)
    rows = {(r.kind, r.id): r for r in one(package.styles(parts)).collect()}
    assert (rows["para_pr", "1"].heading_type, rows["para_pr", "1"].level, rows["para_pr", "1"].align, rows["para_pr", "1"].indent, rows["para_pr", "1"].margin_left) == ("OUTLINE", 2, "CENTER", 10, 600)
    assert (rows["char_pr", "7"].height, rows["char_pr", "7"].bold, rows["char_pr", "8"].bold) == (1400, True, False)
    assert (rows["style", "3"].name, rows["style", "3"].para_pr) == ("Body", "1") and rows["bullet", "2"].text == "•" and rows["numbering", "4"].format == "DIGIT"
    facts = {(r.kind, r.name): (r.value, r.size) for r in one(package.info(parts)).collect()}
    assert facts["image", "img1"] == ("BinData/i.png", 5) and facts["title", "title"][0] == "A title" and facts["meta", "creator"][0] == "me" and facts["application", "appVersion"][0] == "1, 2"


def test_stream_of_packages(spark, folder, tmp_path):
    query = packages.write_sections(packages.read_stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/nodes")).count() == 28
    assert spark.read.parquet(str(tmp_path / "out/cells")).count() == 8


def test_dictionaries_whole(spark, folder):
    rows = one(package.elements(package.read(spark, folder)))
    own = rows.where("kind = 'para_pr'").orderBy("place").collect()
    assert [(r.place, r.above, r.tag) for r in own] == [(0, None, "paraPr"), (1, 0, "align"), (2, 0, "heading"), (3, 0, "margin"), (4, 3, "intent"), (5, 3, "left")]
    assert own[2].attrs == {"type": "OUTLINE", "idRef": "0", "level": "2"}
    assert rows.where("kind = 'numbering' AND tag = 'paraHead'").first().text == "^1."


def test_dangling_references(spark, folder):
    parts = package.read(spark, folder)
    uses = audits.style_uses(package.nodes(package.sections(parts)))
    assert audits.dangling(uses, package.styles(parts)).collect() == []
    found = audits.dangling(uses, package.styles(parts).where("id <> '7'"))
    assert {(r.kind, r.id) for r in found.collect()} == {("char_pr", "7")}


def test_packages_that_lack_parts(spark, folder, tmp_path):
    assert package.problems(package.read(spark, folder)).collect() == []
    for name, entries in {"bare": ["readme.xml"], "empty": ["Contents/content.hpf", "Contents/header.xml"]}.items():
        with zipfile.ZipFile(tmp_path / f"{name}.hwpx", "w") as out:
            for entry in entries:
                out.writestr(entry, "<a/>")
    found = {(r.path.split("/")[-1], r.problem) for r in package.problems(package.read(spark, str(tmp_path))).collect()}
    assert found == {("bare.hwpx", "no_manifest"), ("bare.hwpx", "no_sections"), ("empty.hwpx", "no_sections")}


def test_analysis_as_a_stream(spark, folder, tmp_path):
    packages.write_analysis(packages.read_stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/batch=0/blocks")).count() == 28
    assert spark.read.json(str(tmp_path / "out/batch=0/model")).count() == 2
