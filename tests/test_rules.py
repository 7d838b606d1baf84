"""Hand-made cases of the scalar rules, headers, folds and checks."""

from __future__ import annotations

import pytest
from lamina.functions import text as T
from lamina.operators import blocks, checks, classify, folds, grid, headers, nested
from pyspark.sql import functions as F


def values(spark, rule, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", rule(F.col("t")).alias("v")).orderBy("i").collect()]


def test_scalar_rules(spark):
    assert values(spark, T.collapse, ["  a　 b c ", None]) == ["a b c", ""]
    assert values(spark, T.title_key, ["‘A’ • B‧C – ～"]) == ["A·B·C-~"]
    assert [tuple(v) for v in values(spark, T.split_numbering, ["1. 제목", "3.1 x", "2024년", "Ⅱ-1 y", "①", "", "3S", "1..", None])] == [
        ("1", "제목"), ("3.1", "x"), (None, "2024년"), ("Ⅱ-1", "y"), ("①", ""), (None, ""), (None, "3S"), ("1", ""), (None, "")
    ]
    assert values(spark, T.anchor_level, ["1", "3.1", "2-1-1", "Ⅱ-1", "", None]) == [0, 1, 2, None, None, None]
    assert [tuple(v) for v in values(spark, T.strip_page, ["a\tb\t12", "x ... 7", "x 3", "2024", "……5"])] == [("a\tb", "12"), ("x", "7"), ("x 3", None), ("2024", None), ("", "5")]
    assert [tuple(v) for v in values(spark, T.outline, ["Ⅱ - 1 a", "3.1.1 b", "3x", "2-1."])] == [("roman_dash", "Ⅱ-1", 1), ("numeric", "3.1.1", 3), (None, None, None), ("numeric", "2-1", 2)]
    assert [tuple(v) for v in values(spark, T.ordinal, ["나. x", "12) y", "③ z", "걍. x", "x", ""])] == [("hangul", 1), ("digit", 12), ("circled", 2), (None, None), (None, None), (None, None)]
    assert values(spark, T.marker_class, [" - a", "※ b", "· c", "d", ""]) == ["dash", "annotation", "dot", None, None]
    assert values(spark, T.leading_units, ["  a", "\t　b", "c"]) == [200, 600, 0]
    assert values(spark, T.is_numeric_value, ["1,234", "3 개", "(12.5%)", "2-1", "-", "", "1a", "5 kg"]) == [True, True, True, False, False, False, False, True]


@pytest.mark.parametrize(("texts", "serial"), [(["1", "2", "3"], True), (["0", "1"], True), (["2", "3"], False), (["1"], False), (["1", "x"], False), (["1", "3"], False)])
def test_serial(spark, texts, serial):
    rows = spark.createDataFrame([(texts,)], "v array<string>")
    assert rows.select(T.is_serial(F.col("v"))).first()[0] is serial


def cells(spark, *rows):
    return spark.createDataFrame([(1, *r) for r in rows], "table_id long, r long, c long, row_span long, col_span long, text string")


def test_slots_clip_and_overlap(spark):
    own = cells(spark, (0, 0, 2, 1, "a"), (0, 1, 1, 2, "b"), (1, 0, 1, 1, "late"))
    size = spark.createDataFrame([(1, 2, 2)], "table_id long, n_rows long, n_cols long")
    assert {(r.pr, r.pc): (r.kind, r.text) for r in grid.slots(own, size).collect()} == {(0, 0): ("origin", "a"), (0, 1): ("origin", "b"), (1, 0): ("covered", "a"), (1, 1): ("empty", None)}
    assert {(r.code, r.n) for r in grid.issues(own, size).collect()} == {("out_of_bounds", 1), ("overlap", 1), ("missing_grid_cell", 1)}


def test_two_level_header(spark):
    body = [(r, c, 1, 1, f"{r}{c},000") for r in range(2, 6) for c in range(4)]
    own = cells(spark, (0, 0, 2, 1, "구분"), (0, 1, 1, 3, "실적"), (1, 1, 1, 1, "목표"), (1, 2, 1, 1, "결과"), (1, 3, 1, 1, "비고"), *body)
    scores = headers.header_row_scores(own)
    heads = headers.header_rows(scores)
    assert heads.first().n_header == 2
    assert [(r.c, r.name) for r in headers.columns(own, heads).orderBy("c").collect()] == [(0, "구분"), (1, "실적 목표"), (2, "실적 결과"), (3, "실적 비고")]
    assert headers.numeric_verdict(own, heads).first().verdict == "numeric"


def test_literal_pair_header(spark):
    own = cells(spark, (0, 0, 1, 1, "항목"), (0, 1, 1, 1, "내용"), (1, 0, 1, 1, "name"), (1, 1, 1, 1, "someone"), (2, 0, 1, 1, "city"), (2, 1, 1, 1, "somewhere"))
    kinds = classify.types(own)
    assert kinds.first().orientation == "row_pairs"
    assert [(r.key, r.header) for r in classify.pair_records(own, kinds).orderBy("i").collect()] == [("항목", True), ("name", False), ("city", False)]


def folded(spark, rows, *passes):
    names = "doc_id long, ord long, section long, block_type string, band string, role string, depth long, text string, title_box boolean, margin_left long"
    plain = [(1, i, s, kind, "body", role, depth, text, box, margin) for i, (s, kind, role, depth, text, box, margin) in enumerate(rows)]
    deep = spark.createDataFrame(plain, names).withColumns({"native_level": F.lit(None).cast("int"), "numbering_level": F.lit(None).cast("int"), "anchored": F.lit(False)})
    return [(r.depth, r.reason) for r in folds.correct_depths(deep, passes).orderBy("ord").collect()]


def test_ordinals_align_and_carry_flow(spark):
    p = lambda depth, text, role="body_text": (0, "paragraph", role, depth, text, False, 0)
    got = folded(spark, [p(2, "가. a"), p(3, "x"), p(4, "나. b"), p(5, "under b"), p(1, "end"), p(3, "다. c"), p(2, "h", "section_heading"), p(5, "라. d")], "align_ordinals")
    assert got == [(2, ""), (3, ""), (2, "ordinal_sibling"), (3, "ordinal_flow"), (1, ""), (2, "ordinal_sibling"), (2, ""), (5, "")]


def test_markers_nest_by_indent(spark):
    p = lambda text, margin, depth=3: (0, "paragraph", "body_text", depth, text, False, margin)
    got = folded(spark, [p("- a", 0), p("· b", 200), p("· c", 240), p("- d", 40), p("※ n", 0), p("- e", 0)], "nest_markers")
    assert [d for d, _ in got] == [3, 4, 4, 3, 4, 3]


def test_title_scopes(spark):
    box = lambda text, depth, s=0: (s, "table", "table", depth, text, True, 0)
    head = lambda text, depth, s=0: (s, "paragraph", "section_heading", depth, text, False, 0)
    flow = lambda depth, s=0: (s, "paragraph", "body_text", depth, "flow", False, 0)
    got = folded(spark, [flow(5), box("1 root", 2), flow(2), box("1.1 sub", 2), head("□ mark", 1), flow(1), head("□ next", 1, 1), flow(4, 1), flow(4, 2), head("plain", 9, 2)], "scope_titles", "reanchor")
    assert [d for d, _ in got] == [5, 2, 3, 3, 4, 5, 4, 7, 4, 9]


def test_contents_match_keeps_its_place(spark):
    entries = spark.createDataFrame([(1, 0, "alpha"), (1, 1, "missing"), (1, 2, "beta12"), (1, 3, "alpha")], "doc_id long, entry long, title_key string")
    lines = spark.createDataFrame([(1, 0, "alpha"), (1, 1, "beta"), (1, 2, "zzz")], "doc_id long, ord long, title_key string")
    assert {(r.entry, r.ord, r.method) for r in folds.match_entries(entries, lines).collect()} == {(0, 0, "exact"), (2, 1, "without_digits")}


def test_heading_paths(spark):
    deep = spark.createDataFrame([(1, i, d, d, f"h{i}") for i, d in enumerate([1, 3, 2, 2, 4])], "doc_id long, ord long, depth long, heading_depth long, text string")
    assert [r.path for r in blocks.heading_paths(deep).orderBy("ord").collect()] == [["h0"], ["h0", "h1"], ["h0", "h2"], ["h0", "h3"], ["h0", "h3", "h4"]]


def test_tree_of_tables_leaves_cycles_out(spark):
    tables = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "table_id string, parent_id string")
    assert {(r.table_id, r.root_id, r.base_depth) for r in nested.tree(tables).collect()} == {("a", "a", 0), ("b", "a", 3), ("c", "a", 6)}


def test_mapping_grade(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (1, "a")], "s int, t string")
    got = checks.mapping_grade(rows, "s", "t").first()
    assert (got.n_source, got.is_function, got.n_target, got.is_injective) == (2, True, 1, False)


def test_deep_chains_and_cycles_of_tables(spark):
    chain = [("t0", None)] + [(f"t{i}", f"t{i - 1}") for i in range(1, 81)]
    tables = spark.createDataFrame(chain + [("x", "y"), ("y", "x")], "table_id string, parent_id string")
    assert {(r.table_id, r.base_depth) for r in nested.tree(tables).collect()} == {(f"t{i}", 3 * i) for i in range(81)}
    tops = spark.createDataFrame([("t0",), ("x",)], "table_id string")
    assert {r.table_id for r in nested.below(tables.where("parent_id IS NOT NULL"), tops).collect()} == {f"t{i}" for i in range(1, 81)} | {"x", "y"}


def test_spans_of_any_size_are_clipped(spark):
    cells = spark.createDataFrame([("t", 0, 0, 10**9, 10**9, "a"), ("t", 1, 1, 1, 1, "b"), ("t", 5, 0, 1, 2, "c")], "table_id string, r long, c long, row_span long, col_span long, text string")
    declared = spark.createDataFrame([("t", 2, 2)], "table_id string, n_rows long, n_cols long")
    assert {(r.pr, r.pc, r.text) for r in grid.slots(cells, declared).collect()} == {(0, 0, "a"), (0, 1, "a"), (1, 0, "a"), (1, 1, "a")}
    assert {(r.code, r.n) for r in grid.issues(cells, declared).collect()} == {("out_of_bounds", 10**18 - 4 + 2), ("overlap", 1)}
