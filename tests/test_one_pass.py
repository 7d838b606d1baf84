"""Queries that must not read, shuffle or work out their input again and again."""

from __future__ import annotations

import re

import pytest
from lamina.operators import headers
from lamina.plans import registry

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "scans"), [("header_cols", 1), ("header_col_scores", 1), ("header_rows", 1), ("header_row_scores", 1), ("numeric_table_verdict", 2), ("numeric_verdict_beside_labels", 2)])
def test_scans_of_header_queries(spark, name, scans):
    """Each pass over the cells is one scan and one exchange of the lines; it was 4 to 28 scans."""
    found = plan(registry.QUERIES[name](spark, DATA))
    assert len(re.findall(r"FileScan parquet", found)) == scans
    assert len(re.findall(r"Exchange hashpartitioning", found)) <= scans


def test_one_pass_as_step_by_step(spark):
    """found_headers, over all cells at once, is what the separate steps give; column 0 has a running number, a twin text and no text."""
    rows = []
    for table in range(1, 7):
        n = table + 2
        rows += [(table, 0, c, 1, 1, x) for c, x in enumerate(("번호" if table % 2 else "name", "목표", "실적"))]
        for r in range(1, n):
            first = {0: str(r), 1: "group", 2: "" if r == 2 else f"group {'abcdefgh'[r]}"}[table % 3]
            rows += [(table, r, 0, 1, 1, first), (table, r, 1, 1, 1, f"{r},000"), (table, r, 2, 1, 1, f"{r * 7} 건")]
    rows += [(9, r, 0, 1, 1, f"line {r}") for r in range(4)]
    cells = spark.createDataFrame(rows, "table_id long, r long, c long, row_span long, col_span long, text string")
    heads = headers.header_rows(headers.header_row_scores(cells))
    facts = headers.header_col_facts(cells, heads)
    steps = heads.select("table_id", "n_header").join(headers.header_cols(facts), "table_id")
    found = headers.found_headers(cells)
    assert sorted(map(tuple, steps.select("table_id", "n_header", "n_header_cols", "reason").collect())) == sorted(map(tuple, found.select("table_id", "n_header", "n_header_cols", "reason").collect()))
    reasons = {r.table_id: r.reason for r in found.collect()}
    assert reasons[3] == "INDEX_LIKE_FIRST_COLUMN" and reasons[9] == "SINGLE_COLUMN_TABLE"


@pytest.mark.parametrize("name", ["form_sections", "toc_match", "title_scope_depth", "corrected_depths"])
def test_groups_come_in_batches(spark, name):
    """A grouped pandas function costs milliseconds for each small group; groups are worked off many to a batch."""
    found = plan(registry.QUERIES[name](spark, DATA))
    assert "InPandas" not in found and "MapInArrow" in found
