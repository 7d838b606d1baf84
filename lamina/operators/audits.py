"""Audits of relations against each other: depths and references of inner rows, warnings by code, owners, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.operators import report
from lamina.runtime import cut


def inner_depths(flat: DataFrame, blocks: DataFrame) -> DataFrame:
    """(root_id, local_depth, absolute_depth, code): inner rows whose depth is none, or not that of their block and their own.

    ``flat`` has (root_id, local_depth, absolute_depth), ``blocks`` (root_id, depth).
    """
    met = flat.join(blocks, "root_id", "left")
    code = F.when(F.coalesce(F.col("local_depth") < 1, F.lit(True)), "invalid_local_depth").when(
        F.col("depth").isNotNull() & ~F.col("absolute_depth").eqNullSafe(F.col("depth") + F.col("local_depth")), "invalid_absolute_depth"
    )
    return met.select("root_id", "local_depth", "absolute_depth", code.alias("code")).where("code IS NOT NULL")


def nested_presence(refs: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_id, problem): nested tables that no inner row refers to, and references to no nested table.

    ``refs`` is (table_id, child) of the inner rows, ``tables`` (table_id, parent_id); a reference from another table
    than the parent is a problem of its own.
    """
    named = refs.groupBy(F.col("child").alias("table_id")).agg(F.collect_set("table_id").alias("holders"))
    own = tables.where("parent_id IS NOT NULL").select("table_id", "parent_id")
    met = own.join(named, "table_id", "full")
    problem = (
        F.when(F.col("parent_id").isNull(), "unknown_reference")
        .when(F.col("holders").isNull(), "without_reference")
        .when(~F.array_contains("holders", F.col("parent_id")), "reference_elsewhere")
    )
    return met.select("table_id", problem.alias("problem")).where("problem IS NOT NULL")


def repeated(warnings: DataFrame, owner: str, least: int = 2) -> DataFrame:
    """(owner, code, n): codes that several records of an owner have; ``warnings`` has (owner, code)."""
    return warnings.groupBy(owner, "code").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def normalized(warnings: DataFrame, owner: str) -> DataFrame:
    """(owner, place, code, severity): of each normalised code the first warning of an owner, in order of ``place``."""
    code = F.lower(F.trim("code"))
    first = Window.partitionBy(owner, "code").orderBy("place")
    rows = warnings.select(owner, "place", code.alias("code")).where("code <> ''")
    return rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").select(owner, "place", "code", report.severity(F.col("code")).alias("severity"))


def owned(tables: DataFrame) -> DataFrame:
    """(table_id, owner): tables of a header, footer or note, by their own sign or that of the nearest table above.

    ``tables`` is (table_id, parent_id, owner). The tree is walked down from the owned ones, a level at a time; a table
    with an owner of its own is never reached twice, so a cycle ends there.
    """
    rows = cut(tables)
    level = found = rows.where("owner IS NOT NULL").select("table_id", "owner")
    below = rows.where("owner IS NULL AND parent_id IS NOT NULL").select("table_id", "parent_id")
    while not level.isEmpty():
        level = cut(below.join(level.select(F.col("table_id").alias("parent_id"), "owner"), "parent_id").select("table_id", "owner"))
        found = found.unionByName(level)
    return found


def dangling(uses: DataFrame, known: DataFrame, scope: str = "path") -> DataFrame:
    """(scope, kind, id, n): style ids that are used, and how often, but are in no dictionary of their document."""
    counted = uses.where("id IS NOT NULL").groupBy(scope, "kind", "id").agg(F.count("*").alias("n"))
    return counted.join(known.select(scope, "kind", "id"), [scope, "kind", "id"], "left_anti")


def style_uses(nodes: DataFrame) -> DataFrame:
    """(path, kind, id): every paragraph, style and character reference of nodes."""
    plain = F.array(F.struct(F.lit("para_pr").alias("kind"), F.col("para_pr").alias("id")), F.struct(F.lit("style").alias("kind"), F.col("style_id").alias("id")))
    runs = F.transform("runs", lambda x: F.struct(F.lit("char_pr").alias("kind"), x["char_pr"].alias("id")))
    listed = F.concat(plain, F.coalesce(runs, F.expr("array()").cast("array<struct<kind:string,id:string>>")))
    return nodes.select("path", F.explode(listed).alias("x")).select("path", "x.kind", "x.id")


def anchor_warnings(objects: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, ord, code, severity): objects without an anchor, and captions and notes with several.

    ``objects`` has (doc_id, ord, block_type), ``anchors`` (doc_id, ord, status) as ``blocks.floating_anchors`` gives it.
    """
    name = F.when(F.col("block_type").isin("footnote", "endnote"), "footnote").when(F.col("block_type") == "caption", "caption")
    code = F.when(F.col("status") == "unresolved", F.coalesce(F.concat(F.lit("orphan_"), name, F.lit("_unresolved")), F.lit("floating_anchor_unresolved"))).when(
        F.col("status") == "ambiguous", F.concat(F.lit("orphan_"), name, F.lit("_uncertain"))
    )
    met = objects.select("doc_id", "ord", "block_type").join(anchors.select("doc_id", "ord", "status"), ["doc_id", "ord"])
    return met.select("doc_id", "ord", code.alias("code")).where("code IS NOT NULL").withColumn("severity", report.severity(F.col("code")))


def two_ways(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(check, side, n): rows that one of two ways to a relation gives and the other does not, by name of the check.

    Rows are counted on both sides in one shuffle, equal rows as often as they occur.
    """
    found = None
    for name, (one, two) in pairs.items():
        columns = one.columns
        sided = one.withColumn("_side", F.lit(1)).unionByName(two.select(*columns).withColumn("_side", F.lit(-1)))
        over = sided.groupBy(*columns).agg(F.sum("_side").alias("_over")).where("_over <> 0")
        own = over.select(F.lit(name).alias("check"), F.when(F.col("_over") > 0, "left").otherwise("right").alias("side"), F.abs("_over").alias("n"))
        found = own if found is None else found.unionByName(own)
    return found.groupBy("check", "side").agg(F.sum("n").alias("n"))
