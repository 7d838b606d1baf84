"""What is made of an analysis: the filtered model, its checks, the debug payload, snapshots, and a command line."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import checks, grid, model, render, report
from lamina.plans import engine
from lamina.plans.engine import Analysis
from lamina.runtime import cut
from lamina.sources import package

#: Relations that know tables, and so lose those that the filter leaves out.
TABLED = ("tables", "raw_cells", "cells", "issues", "types", "headers", "header_cols", "columns", "records", "pairs", "numeric", "markdown", "linking")


def linking(a: Analysis) -> DataFrame:
    """The light projection of every table that links it with the body."""
    return model.linking(a["cells"].select("table_id", "r", "c", "row_span", "col_span", "text"), a["tables"].select("table_id", "parent_id"), a["types"])


def filtered(a: Analysis) -> Analysis:
    """The analysis without excluded and contents tables; their blocks stay as places, with the reason or the entries.

    Filtering twice is filtering once: what is left out has no label that would leave out more.
    """
    left_out = cut(model.gone(a["labels"]))
    out = Analysis(dict(a.relations))
    if "linking" not in out.relations:
        out["linking"] = linking(a)
    for name in TABLED:
        if name in out.relations:
            out[name] = model.prune(out[name], left_out)
    # References to children that went are dropped from the lists of those that stay.
    each = out["linking"].select("table_id", F.posexplode("child_ids").alias("k", "child")).join(left_out.select(F.col("table_id").alias("child")), "child", "left_anti")
    lists = each.groupBy("table_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "child"))), lambda x: x["child"]).alias("kept_ids"))
    met = out["linking"].join(lists, "table_id", "left")
    out["linking"] = met.withColumn("child_ids", F.coalesce("kept_ids", F.expr("array()").cast(met.schema["child_ids"].dataType))).drop("kept_ids")
    root = left_out.select(F.col("table_id").alias("root_id"))
    out["inner"] = model.prune(a["inner"], left_out).join(root, "root_id", "left_anti")
    entries = render.entry_levels(a["toc_entries"].withColumnRenamed("i", "ord")).select("doc_id", F.col("ord").alias("i"), F.col("title").alias("text"), "level")
    out["blocks"] = model.filtered_blocks(a["blocks"], left_out, entries)
    out["labels"] = a["labels"]
    out["filter_counts"] = model.filter_counts(a["labels"], a["types"], a["numeric"])
    return out


def verify(a: Analysis) -> DataFrame:
    """(check, n): what is wrong with a model, by check; no rows for a sound one.

    Blocks, tables, cells and orders are unique and complete, references resolve, heading paths grow deeper, markdown
    has the size of its table, verdicts and labels are there for every table, and no record was lost on the way.
    """
    kept = model.kept_tables(a["tables"], a["labels"])
    sizes = grid.sizes(a["cells"])
    every = a["cells"].select("table_id").distinct()
    depths = a["blocks"].select("doc_id", "ord", F.col("depth").alias("own"))
    known = {"exclude_empty", "special_toc", "keep_title", "keep_prose", "keep_records", "keep_pairs", "exclude_unreadable", "exclude_with_parent"}
    return model.collected(
        [
            model.twice("block_twice", a["blocks"], "doc_id", "ord"),
            model.twice("table_twice", a["tables"], "table_id"),
            model.twice("cell_twice", a["cells"], "table_id", "r", "c"),
            model.lacking("block_incomplete", a["blocks"], "ord", "depth", "section", "role", "band"),
            model.lost("block_lost", a["linked"].select(F.concat_ws(":", "doc_id", "ord").alias("k")), a["blocks"].select(F.concat_ws(":", "doc_id", "ord").alias("k")), "k"),
            model.wrong("depth_negative", depths.where("own < 0"), "ord"),
            model.lost("verdict_lost", every, a["numeric"], "table_id"),
            model.lost("label_lost", every, a["labels"], "table_id"),
            model.wrong("label_unknown", a["labels"].where(~F.col("label").isin(*sorted(known))), "table_id"),
            model.drawn("markdown_size", a["markdown"], sizes),
            model.unknown("parent_unknown", kept, "parent_id", a["tables"], "table_id"),
            model.unknown("parent_excluded", kept, "parent_id", kept, "table_id"),
            model.unknown("record_without_header", a["records"], "table_id", a["headers"].where("n_header > 0"), "table_id"),
            model.unknown("column_without_header", a["columns"], "table_id", a["headers"].where("n_header > 0"), "table_id"),
        ]
    )


def warnings(a: Analysis) -> DataFrame:
    """(code, severity, n) of tables: structural issues, and irregular grids, low confidence, nested tables, missing headers."""
    found = a["issues"].select(F.lower("code").alias("code"), "severity")
    low = a["columns"].where("confidence = 'low'").select("table_id").distinct().select(F.lit("low_record_confidence").alias("code"))
    irregular = a["issues"].where("code IN ('EMPTY_GRID_SLOT', 'DUPLICATED_GRID_SLOT', 'ROW_OUT_OF_RANGE', 'COL_OUT_OF_RANGE')").select("table_id").distinct().select(F.lit("irregular_grid").alias("code"))
    nested = a["tables"].where("parent_id IS NOT NULL").select("parent_id").distinct().select(F.lit("nested_table_present").alias("code"))
    missing = a["types"].where("table_type = 'data_table'").join(a["headers"].where("n_header = 0"), "table_id", "left_semi").select(F.lit("missing_header_rows").alias("code"))
    raw = a["record_status"].where("record_status = 'raw_only'").select(F.lit("raw_only_table").alias("code"))
    own = low.unionByName(irregular).unionByName(nested).unionByName(missing).unionByName(raw)
    rows = own.select("code", report.severity(F.col("code")).alias("severity")).unionByName(found.select("code", F.lower("severity").alias("severity")))
    return rows.groupBy("code", "severity").agg(F.count("*").alias("n"))


def summary(a: Analysis) -> DataFrame:
    """(doc_id, path, n_blocks, n_headings, n_tables, n_kept, n_numeric, n_records, n_entries): one row per document."""
    blocks = a["blocks"].groupBy("doc_id", "path").agg(F.count("*").alias("n_blocks"), F.count_if(F.col("role") == "section_heading").alias("n_headings"))
    tables = a["tables"].select("doc_id", "table_id").join(a["labels"], "table_id", "left").join(a["numeric"], "table_id", "left")
    counted = tables.groupBy("doc_id").agg(F.count("*").alias("n_tables"), F.count_if(F.col("label").startswith("keep")).alias("n_kept"), F.count_if(F.col("verdict") == "numeric").alias("n_numeric"))
    records = a["records"].select("table_id", "record").distinct().join(a["tables"].select("doc_id", "table_id"), "table_id").groupBy("doc_id").agg(F.count("*").alias("n_records"))
    entries = a["toc_entries"].groupBy("doc_id").agg(F.count("*").alias("n_entries"))
    met = blocks.join(counted, "doc_id", "left").join(records, "doc_id", "left").join(entries, "doc_id", "left")
    return met.select("doc_id", "path", "n_blocks", "n_headings", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_tables", "n_kept", "n_numeric", "n_records", "n_entries")])


def debug_payload(a: Analysis) -> DataFrame:
    """(doc_id, payload): the sections summary, tables, blocks, inner rows and labels of a document, as one JSON text."""
    tables = a["tables"].select("doc_id", "table_id", "parent_id").join(a["types"], "table_id", "left").join(a["labels"], "table_id", "left").join(a["numeric"], "table_id", "left").join(a["markdown"], "table_id", "left")
    listed = lambda rows, order, name: rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*order, *[c for c in rows.columns if c not in (*order, "doc_id")]))).alias(name))
    blocks = a["blocks"].select("doc_id", "ord", "block_type", "role", "band", "depth", "reason", "text", "table_id", "shown", "hidden_reason")
    inner = a["inner"].join(a["tables"].select("doc_id", "table_id"), "table_id")
    parts = listed(blocks, ["ord"], "blocks").join(listed(tables, ["table_id"], "tables"), "doc_id", "left").join(listed(inner, ["root_id", "table_id", "local_order"], "table_internal_blocks"), "doc_id", "left")
    shape = summary(a)
    met = parts.join(shape.select("doc_id", F.struct(*[c for c in shape.columns if c != "doc_id"]).alias("summary")), "doc_id")
    return met.select("doc_id", F.to_json(F.struct("summary", "tables", "blocks", "table_internal_blocks")).alias("payload"))


def embedding_text(a: Analysis) -> DataFrame:
    """(doc_id, text): the preview of the filtered blocks, with the entries of contents tables in their places."""
    after = filtered(a)
    entries = F.array_join(F.transform("toc_entries", lambda x: F.concat(F.repeat(F.lit("  "), F.coalesce(x["level"], F.lit(0)).cast("int")), x["text"])), "\n")
    blocks = after["blocks"].withColumn("text", F.when(F.size("toc_entries") > 0, entries).otherwise(F.col("text")))
    lines = render.preview(blocks)
    parts = lines.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", "line"))).alias("parts"))
    return parts.select("doc_id", F.array_join(F.transform("parts", lambda x: x["line"]), "\n").alias("text"))


def compared(one: DataFrame, two: DataFrame) -> DataFrame:
    """(side, n): rows of one relation that the other lacks, each as often as it is lacking; equal relations give none."""
    names = one.columns
    only = lambda x, y, side: x.select(*names).exceptAll(y.select(*names)).agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return only(one, two, "left").unionByName(only(two, one, "right")).where("n > 0")


def hashes(a: Analysis, names: tuple[str, ...] = ("blocks", "tables", "cells", "types", "columns", "records", "pairs", "labels", "toc_entries", "inner")) -> DataFrame:
    """(part, n, hash): a hash of each relation that does not depend on the order of its rows."""
    found = None
    for name in names:
        rows = a[name]
        own = rows.select(checks.canonical_hash(rows.columns).alias("own"))
        # Rows are added up by the first 60 bits of their hashes, so equal rows count as often as they occur.
        total = F.sum(F.conv(F.substring("own", 1, 15), 16, 10).cast("decimal(38,0)"))
        one = own.agg(F.count("*").alias("n"), F.coalesce(total, F.lit(0)).cast("string").alias("hash")).select(F.lit(name).alias("part"), "n", "hash")
        found = one if found is None else found.unionByName(one)
    return found


def main(argv: list[str] | None = None) -> int:
    """Packages at a path to relations, model, renderings and a summary in a folder; 1 if the model is not sound."""
    args = argparse.ArgumentParser(description="Analyze packaged documents.")
    args.add_argument("packages", help="a folder, file or pattern of packages")
    args.add_argument("out", help="the folder to write to")
    args.add_argument("--debug", action="store_true", help="write the debug payload as well")
    args.add_argument("--keep-all", action="store_true", help="do not leave out any table")
    args.add_argument("--summary", action="store_true", help="show a row for each document")
    given = args.parse_args(argv)
    spark = SparkSession.builder.appName("lamina").getOrCreate()
    parts = cut(package.read(spark, given.packages))
    bare = package.problems(parts)
    for row in bare.collect():
        print(f"{row['path']}: {row['problem']}", file=sys.stderr)
    if not bare.isEmpty():
        return 1
    a = engine.analyze(parts)
    bad = verify(a).collect()
    for row in bad:
        print(f"{row['check']}: {row['n']}", file=sys.stderr)
    if bad:
        return 1
    engine.write(a if given.keep_all else filtered(a), given.out)
    summary(a).write.mode("overwrite").parquet(f"{given.out}/summary")
    if given.debug:
        debug_payload(a).write.mode("overwrite").json(f"{given.out}/debug")
    if given.summary:
        summary(a).show(truncate=False)
    return 0
