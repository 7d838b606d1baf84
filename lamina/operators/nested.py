"""Nested tables: depths of the tree, flattening to typed rows, counts per root."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T
from lamina.runtime import cut


def tree(tables: DataFrame) -> DataFrame:
    """(table_id, parent_id, root_id, base_depth): the root of each table and the depth its rows start from.

    ``tables`` is (table_id, parent_id); a nested table's rows begin three levels below those of its parent
    (row, cell, reference). The tree is walked a level at a time to its end, each level a join that is cut, so
    neither rows nor levels meet the limits of a recursive query. A table that was found before, as an id that
    comes again below itself is, ends its branch; tables in a cycle without a root are left out.
    """
    level = cut(tables.where("parent_id IS NULL").select("table_id", "parent_id", F.col("table_id").alias("root_id"), F.lit(0).cast("long").alias("base_depth")))
    found, inner = level, cut(tables.where("parent_id IS NOT NULL").select("table_id", "parent_id"))
    while not level.isEmpty():
        above = level.select(F.col("table_id").alias("parent_id"), "root_id", (F.col("base_depth") + 3).alias("base_depth"))
        below_them = inner.join(above, "parent_id").select("table_id", "parent_id", "root_id", "base_depth")
        level = cut(below_them.join(found.select("table_id", "root_id"), ["table_id", "root_id"], "left_anti"))
        found = found.unionByName(level)
    return found


def below(parents: DataFrame, tops: DataFrame) -> DataFrame:
    """(table_id): the tables that lie somewhere below any of ``tops`` (table_id); ``parents`` is (table_id, parent_id)."""
    inner, level = cut(parents), tops.select("table_id")
    found = None
    while True:
        level = inner.join(level.select(F.col("table_id").alias("parent_id")), "parent_id").select("table_id").distinct()
        level = cut(level if found is None else level.join(found, "table_id", "left_anti"))
        found = level if found is None else found.unionByName(level)
        if level.isEmpty():
            return found


def flatten(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """(root_id, table_id, kind, r, c, local_depth, local_order, text): row groups, cells, texts and references.

    ``cells`` is (table_id, r, c, text, child_id); the order starts anew in each table: a row, its cells, each
    with its text and the reference to a nested table.
    """
    placed = cells.join(tree(tables).select("table_id", "root_id", "base_depth"), "table_id")
    rows = placed.select("table_id", "root_id", "base_depth", "r").distinct().select("*", F.lit(-1).cast("long").alias("c"), F.lit("row_group").alias("kind"), F.lit(0).alias("step"), F.lit(None).cast("string").alias("text"))
    kinds = F.array_compact(
        F.array(
            F.struct(F.lit("cell_group").alias("kind"), F.lit(1).alias("step"), F.lit(None).cast("string").alias("text")),
            F.when(T.strip(F.col("text")) != "", F.struct(F.lit("cell_text").alias("kind"), F.lit(2).alias("step"), F.col("text").alias("text"))),
            F.when(F.col("child_id").isNotNull(), F.struct(F.lit("nested_table_ref").alias("kind"), F.lit(3).alias("step"), F.col("child_id").cast("string").alias("text"))),
        )
    )
    own = placed.select("table_id", "root_id", "base_depth", "r", "c", F.explode(kinds).alias("x")).select("table_id", "root_id", "base_depth", "r", "c", "x.kind", "x.step", "x.text")
    depth = F.col("base_depth") + F.when(F.col("kind") == "row_group", 1).when(F.col("kind") == "cell_group", 2).otherwise(3)
    order = F.row_number().over(Window.partitionBy("table_id").orderBy("r", "c", "step")) - 1
    return rows.unionByName(own).select("root_id", "table_id", "kind", "r", "c", depth.alias("local_depth"), order.cast("long").alias("local_order"), F.coalesce("text", F.lit("")).alias("text"))


def counts(flat: DataFrame) -> DataFrame:
    """Counts of each kind and the largest depth per root."""
    kinds = ("row_group", "cell_group", "cell_text", "nested_table_ref")
    return flat.groupBy("root_id").agg(F.count_distinct("table_id").alias("n_tables"), F.max("local_depth").alias("deepest"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds])
