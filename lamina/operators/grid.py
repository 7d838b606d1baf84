"""Grids of tables: slots, issues, merged areas, gridness, structure figures, texts, markdown.

Cells are (table_id, r, c, row_span, col_span, text) with an optional ``ord`` for the order of the source. Spans
are expanded by two explodes and met by equality, never by a range join; all groups are those of one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T


def sizes(cells: DataFrame) -> DataFrame:
    """(table_id, n_rows, n_cols): as far as the cells reach."""
    return cells.groupBy("table_id").agg(F.max(F.col("r") + F.col("row_span")).alias("n_rows"), F.max(F.col("c") + F.col("col_span")).alias("n_cols"))


def clipped(cells: DataFrame, declared: DataFrame) -> DataFrame:
    """cells with spans that end where their table does; ``declared`` is (table_id, n_rows, n_cols).

    Spans come from files, so they are cut before anything is made of them; a cell that begins outside keeps a span of one.
    """
    met = cells.join(declared.select("table_id", "n_rows", "n_cols"), "table_id", "left")
    end = lambda span, at, size: F.when(F.col(size).isNull(), F.col(span)).otherwise(F.greatest(F.least(F.col(span), F.col(size) - F.col(at)), F.lit(1))).cast(cells.schema[span].dataType).alias(span)
    spans = {"row_span": end("row_span", "r", "n_rows"), "col_span": end("col_span", "c", "n_cols")}
    return met.select(*[spans.get(c, F.col(c)) for c in cells.columns])


def expanded(cells: DataFrame) -> DataFrame:
    """A row for each place that a cell covers: (cell columns, pr, pc)."""
    down = cells.withColumn("pr", F.explode(F.sequence(F.col("r"), F.col("r") + F.greatest("row_span", F.lit(1)) - 1)))
    return down.withColumn("pc", F.explode(F.sequence(F.col("c"), F.col("c") + F.greatest("col_span", F.lit(1)) - 1)))


def slots(cells: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """(table_id, pr, pc, kind, r, c, text): each place of a table as origin, covered or empty.

    Places beyond the table's size are clipped; where cells overlap, the first in order has the place.
    """
    size = sizes(cells) if declared is None else declared
    first = Window.partitionBy("table_id", "pr", "pc").orderBy("r", "c")
    own = cells if declared is None else clipped(cells, declared)
    taken = expanded(own).withColumn("nth", F.row_number().over(first)).where("nth = 1")
    kind = F.when((F.col("r") == F.col("pr")) & (F.col("c") == F.col("pc")), "origin").otherwise("covered")
    held = taken.select("table_id", "pr", "pc", kind.alias("kind"), "r", "c", "text")
    places = size.select("table_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1)).alias("pr"), "n_cols").select("table_id", "pr", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_cols") - 1)).alias("pc"))
    return places.join(held, ["table_id", "pr", "pc"], "left").withColumn("kind", F.coalesce("kind", F.lit("empty")))


def issues(cells: DataFrame, declared: DataFrame) -> DataFrame:
    """(table_id, code, n): places out of bounds, places claimed again, and places without a cell.

    Places out of bounds are reckoned from the spans, not listed.
    """
    met = cells.join(declared, "table_id").withColumns({"row_span": F.greatest("row_span", F.lit(1)), "col_span": F.greatest("col_span", F.lit(1))})
    part = lambda at, span, size: F.greatest(F.least(F.col(at) + F.col(span), F.col(size)) - F.least(F.col(at), F.col(size)), F.lit(0))
    outside = (F.col("row_span") * F.col("col_span") - part("r", "row_span", "n_rows") * part("c", "col_span", "n_cols")).cast("long")
    beyond = met.select("table_id", F.lit("out_of_bounds").alias("code"), outside.alias("n")).where("n > 0")
    placed = expanded(clipped(cells, declared)).join(declared, "table_id")
    inside = placed.where("pr < n_rows AND pc < n_cols").groupBy("table_id", "pr", "pc").agg((F.count("*") - 1).alias("n")).where("n > 0")
    again = inside.select("table_id", F.lit("overlap").alias("code"), "n")
    missing = slots(cells, declared).where("kind = 'empty'").select("table_id", F.lit("missing_grid_cell").alias("code"), F.lit(1).alias("n"))
    return beyond.unionByName(again).unionByName(missing).groupBy("table_id", "code").agg(F.sum("n").cast("long").alias("n"))


def merge_cover(cells: DataFrame) -> DataFrame:
    """(table_id, r, c, text): places that a merged cell covers beside its own, with its text."""
    merged = expanded(cells.where("row_span > 1 OR col_span > 1")).where("pr <> r OR pc <> c")
    return merged.select("table_id", F.col("pr").alias("r"), F.col("pc").alias("c"), T.collapse(F.col("text")).alias("text"))


def gridness(cells: DataFrame) -> DataFrame:
    """(table_id, gridness): empty, degenerate, or grid if two rows have two filled columns each."""
    filled = cells.withColumn("filled", T.strip(F.col("text")) != "")
    rows = filled.groupBy("table_id", "r").agg(F.collect_set(F.when(F.col("filled"), F.col("c"))).alias("cs"))
    found = rows.groupBy("table_id").agg(F.count_if(F.size("cs") > 0).alias("n_rows"), F.count_if(F.size("cs") > 1).alias("n_wide"), F.size(F.array_distinct(F.flatten(F.collect_set("cs")))).alias("n_cols"))
    kind = F.when(F.col("n_rows") == 0, "empty").when((F.col("n_rows") < 2) | (F.col("n_cols") < 2) | (F.col("n_wide") < 2), "degenerate").otherwise("grid")
    return found.select("table_id", kind.alias("gridness"))


def structure(cells: DataFrame) -> DataFrame:
    """Counts of empty, filled, spanning and merged cells and the largest spans of each table."""
    text = T.strip(F.col("text"))
    return cells.groupBy("table_id").agg(
        F.count("*").alias("n_cells"),
        F.count_if(text == "").alias("n_empty"),
        F.count_if(F.col("row_span") > 1).alias("n_row_span"),
        F.count_if(F.col("col_span") > 1).alias("n_col_span"),
        F.count_if((F.col("row_span") > 1) | (F.col("col_span") > 1)).alias("n_merged"),
        F.max("row_span").alias("max_row_span"),
        F.max("col_span").alias("max_col_span"),
        F.sum(F.length("text")).alias("n_chars"),
    )


def rollup_text(cells: DataFrame) -> DataFrame:
    """(table_id, text): filled texts in the order of rows and columns, joined by a space."""
    filled = cells.select("table_id", "r", "c", T.collapse(F.col("text")).alias("text")).where("text <> ''")
    parts = filled.groupBy("table_id").agg(F.sort_array(F.collect_list(F.struct("r", "c", "text"))).alias("parts"))
    return parts.select("table_id", F.array_join(F.transform("parts", lambda x: x["text"]), " ").alias("text"))


def markdown(cells: DataFrame, header_rows: int = 1) -> DataFrame:
    """(table_id, markdown): the dense grid with merged texts filled in, pipes escaped."""
    cover = merge_cover(cells)
    own = cells.select("table_id", "r", "c", T.collapse(F.col("text")).alias("text"), F.lit(0).alias("late")).unionByName(cover.withColumn("late", F.lit(1)))
    best = own.groupBy("table_id", "r", "c").agg(F.min_by("text", "late").alias("text"))
    size = sizes(cells)
    places = size.select("table_id", "n_cols", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1)).alias("r")).select("table_id", "n_cols", "r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_cols") - 1)).alias("c"))
    dense = places.join(best, ["table_id", "r", "c"], "left").withColumn("text", F.replace(T.text_of(F.col("text")), F.lit("|"), F.lit("\\|")))
    rows = dense.groupBy("table_id", "n_cols", "r").agg(F.sort_array(F.collect_list(F.struct("c", "text"))).alias("parts"))
    line = F.concat(F.lit("| "), F.array_join(F.transform("parts", lambda x: x["text"]), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.col("n_cols").cast("int")))
    lines = rows.select("table_id", "r", F.when(F.col("r") == max(header_rows, 1) - 1, F.concat(line, F.lit("\n"), rule)).otherwise(line).alias("line"))
    return lines.groupBy("table_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "line"))), lambda x: x["line"]), "\n").alias("markdown"))
