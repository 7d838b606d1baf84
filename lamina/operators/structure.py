"""Structural validation of parsed tables, projections of tables and cells, and form sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T
from lamina.operators import grid
from lamina.runtime import by_group


def issues(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """(table_id, code, severity, cell_id): what is wrong with rows, addresses, spans and slots.

    ``tables`` is (table_id, n_rows, n_cols), ``cells`` (table_id, cell_id, xml_row, r, c, row_span, col_span).
    """
    row = lambda code, severity="ERROR": [F.lit(code).alias("code"), F.lit(severity).alias("severity")]
    none = F.lit(None).cast("string").alias("cell_id")
    counts = cells.groupBy("table_id").agg((F.max("xml_row") + 1).alias("found"))
    rows = tables.join(counts, "table_id", "left").where(F.coalesce("found", F.lit(0)) != F.col("n_rows")).select("table_id", *row("ROW_COUNT_MISMATCH"), none)
    first = cells.groupBy("table_id", "xml_row").agg(F.min_by("r", "cell_ord").alias("declared")).where("declared IS NOT NULL AND declared <> xml_row")
    order = first.select("table_id", *row("ROW_ORDER_MISMATCH", "WARNING"), none)
    met = cells.join(tables.select("table_id", "n_rows", "n_cols"), "table_id")
    lacking = F.col("r").isNull() | F.col("c").isNull()
    test = lambda condition, code: F.when(~lacking & condition, F.lit(code))
    codes = F.array_compact(
        F.array(
            F.when(lacking, F.lit("MISSING_CELL_ADDR")),
            test((F.col("r") < 0) | (F.col("c") < 0), "INVALID_CELL_ADDR"),
            test((F.col("row_span") < 1) | (F.col("col_span") < 1), "INVALID_CELL_SPAN"),
            test(F.col("r") + F.col("row_span") > F.col("n_rows"), "ROW_OUT_OF_RANGE"),
            test(F.col("c") + F.col("col_span") > F.col("n_cols"), "COL_OUT_OF_RANGE"),
        )
    )
    addressed = met.select("table_id", F.explode(codes).alias("code"), F.lit("ERROR").alias("severity"), "cell_id")
    good = met.where(~lacking & (F.col("r") >= 0) & (F.col("c") >= 0) & (F.col("r") + F.col("row_span") <= F.col("n_rows")) & (F.col("c") + F.col("col_span") <= F.col("n_cols")))
    taken = grid.expanded(good).groupBy("table_id", "pr", "pc").agg((F.count("*") - 1).alias("again"))
    twice = taken.where("again > 0").select("table_id", *row("DUPLICATED_GRID_SLOT"), none)
    places = tables.where("n_rows > 0 AND n_cols > 0").select("table_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1)).alias("pr"), "n_cols").select("table_id", "pr", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_cols") - 1)).alias("pc"))
    empty = places.join(taken, ["table_id", "pr", "pc"], "left_anti").select("table_id", *row("EMPTY_GRID_SLOT", "WARNING"), none)
    found = rows
    for more in (order, addressed, twice, empty):
        found = found.unionByName(more)
    return found


def missing_refs(cells: DataFrame, styles: DataFrame) -> DataFrame:
    """(path, kind, id): references of cell paragraphs and runs to no entry of their document's dictionaries."""
    p = cells.select("path", F.explode("paragraphs").alias("p"))
    para = p.select("path", F.lit("para_pr").alias("kind"), F.col("p.para_pr").alias("id"))
    style = p.select("path", F.lit("style").alias("kind"), F.col("p.style_id").alias("id"))
    char = p.select("path", F.explode("p.runs").alias("x")).select("path", F.lit("char_pr").alias("kind"), F.col("x.char_pr").alias("id"))
    used = para.unionByName(style).unionByName(char).where("id IS NOT NULL").distinct()
    return used.join(styles.select("path", "kind", "id"), ["path", "kind", "id"], "left_anti")


def cell_facts(cells: DataFrame, chars: DataFrame) -> DataFrame:
    """One row per cell: text figures, distinct references in the order of first use, bold and largest size, centring."""
    own = cells.withColumn("refs", F.array_distinct(F.array_compact(F.transform(F.flatten(F.transform("paragraphs", lambda p: p["runs"])), lambda r: r["char_pr"]))))
    runs = own.select("path", "cell_id", F.explode_outer("refs").alias("id")).join(chars.select("path", "id", "height", "bold"), ["path", "id"], "left")
    style = runs.groupBy("path", "cell_id").agg(F.coalesce(F.max("bold"), F.lit(False)).alias("has_bold"), F.bround(F.max(F.when(F.col("height") > 0, F.col("height") / 100)), 1).alias("max_size"))
    facts = own.select(
        "path", "table_id", "cell_id", "r", "c", "row_span", "col_span", F.size("paragraphs").alias("n_paragraphs"), F.length("text").alias("n_chars"), (F.instr("text", "\n") > 0).alias("multiline"), "refs", (F.col("vert_align") == "CENTER").alias("centred"),
        F.size("nested").alias("n_nested"), F.size(F.filter("extras", lambda x: x["kind"] == "image")).alias("n_images"),
    )
    return facts.join(style, ["path", "cell_id"], "left")


def label_text(c):
    """A form's label: the wide spaces between Hangul letters that pad it are dropped."""
    return T.collapse(F.regexp_replace(T.text_of(c), r"(?U)(?<=[가-힣])\s{2,}(?=[가-힣])", ""))


SECTIONS = "table_id string, section long, name string, kind string, r long, key string, value string"


def form_sections(cells: DataFrame) -> DataFrame:
    """(table_id, section, name, kind, r, key, value): items, wide texts and raw rows of forms with label spans.

    A first row that is one cell of full width is the title; a label that spans rows opens a section; equal
    neighbouring names are one. Two cells are a pair, an even number inside a label's rows are pairs unless
    their columns repeat more than twice there, one is a key, anything else stays raw.
    """
    size = grid.sizes(cells).select("table_id", "n_cols")
    own = cells.select(F.col("table_id").cast("string").alias("table_id"), "r", "c", "row_span", "col_span", T.collapse(F.col("text")).alias("text"), label_text(F.col("text")).alias("label"))
    wide = own.join(size.select(F.col("table_id").cast("string").alias("table_id"), "n_cols"), "table_id")

    def run(table_id: str, rows: list[dict]) -> list[tuple]:
        n_cols, out, names, by_row = rows[0]["n_cols"], [], [], {}
        for cell in rows:
            by_row.setdefault(cell["r"], []).append(cell)
        first, until, is_open = min(by_row), -1, False
        repeats = {}
        for r, own in by_row.items():
            if r not in repeats and own[0]["c"] == 0 and own[0]["row_span"] > 1:
                spanned = {x: tuple(c["c"] for c in by_row[x][x == r :] if c["text"]) for x in by_row if r <= x < r + own[0]["row_span"]}
                repeats |= {x: sum(s == v for v in spanned.values()) for x, s in spanned.items()}

        def use(name: str) -> None:
            if not names or names[-1] != name:
                names.append(name)

        def add(kind: str, r: int, key: str, value: str) -> None:
            out.append((table_id, len(names) - 1, names[-1] if names else "", kind, r, key, value))

        for r, own in by_row.items():
            if len(own) == 1 and own[0]["c"] == 0 and own[0]["col_span"] >= n_cols:
                if r != first:
                    add("wide", r, "", own[0]["text"])
                elif own[0]["text"]:
                    use("문서 제목")
                    is_open = True
                    add("item", r, "제목", own[0]["text"])
                continue
            labelled = own[0]["c"] == 0 and own[0]["row_span"] > 1
            inside = labelled or (is_open and r <= until)
            if labelled:
                use(own[0]["label"] or "기본 정보")
                until, own = r + own[0]["row_span"] - 1, own[1:]
            elif not is_open or r > until:
                use("기본 정보")
                until = -1
            is_open = True
            if len(own) >= 3 and not (inside and len(own) % 2 == 0 and repeats.get(r, 1) <= 2):
                add("raw", r, "", " | ".join(c["text"] for c in own))
            elif len(own) == 1:
                if own[0]["label"]:
                    add("item", r, own[0]["label"], "")
            else:
                for k, v in zip(own[::2], own[1::2]):
                    if k["label"] or v["text"]:
                        add("item", r, k["label"], v["text"])
        return out

    return by_group(wide, "table_id", ["r", "c"], run, SECTIONS)


def order_in_groups(floating: DataFrame) -> DataFrame:
    """Floating objects (doc_id, anchor, anchor_ord, ord, xml_ord) with the place that keeps their source order.

    Where reading order and source order of a group differ, its members follow the anchor in source order.
    """
    group = Window.partitionBy("doc_id", "anchor")
    k = F.row_number().over(group.orderBy("xml_ord", "ord"))
    ranked = floating.withColumns({"k": k, "seen": F.row_number().over(group.orderBy("ord", "xml_ord"))})
    same = F.min(F.col("k") == F.col("seen")).over(group)
    place = F.when(same | F.col("anchor_ord").isNull(), F.col("ord").cast("double")).otherwise(F.col("anchor_ord") + F.col("k") * 0.001)
    return ranked.withColumn("place", place).withColumn("moved", F.col("place") != F.col("ord")).drop("k", "seen")
