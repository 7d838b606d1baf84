"""Text renderings of documents: the lossless indented text and the short preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T

PREVIEW = 120
PLACEHOLDERS = {"table": "[table]", "image": "[image]"}
TAGS = {"peripheral": "[P] ", "annotation": "[A] "}
PREFIXES = {"cell_text": "cell", "caption": "caption", "control": "control"}


def indented(depth: Column, text: Column) -> Column:
    return F.concat(F.repeat(F.lit("  "), depth.cast("int")), text)


def shorten(c: Column) -> Column:
    text = T.collapse(c)
    return F.when(F.length(text) > PREVIEW, F.concat(F.substring(text, 1, PREVIEW), F.lit("…"))).otherwise(text)


def context_lines(deep: DataFrame, inner: DataFrame | None = None) -> DataFrame:
    """(doc_id, ord, step, line): a line per block that has text or is a table or an image, and per inner text.

    ``inner`` is (doc_id, ord, step, kind, local_depth, text): the rows of a table block in their order.
    """
    text = T.collapse(F.col("text"))
    body = F.when(text != "", text)
    for kind, shown in PLACEHOLDERS.items():
        body = F.coalesce(body, F.when(F.col("block_type") == kind, F.lit(shown)))
    tag = F.lit("")
    for band, shown in TAGS.items():
        tag = F.when(F.col("band") == band, shown).otherwise(tag)
    lines = deep.select("doc_id", "ord", F.lit(0).cast("long").alias("step"), indented(F.col("depth"), F.concat(tag, body)).alias("line")).where("line IS NOT NULL")
    if inner is None:
        return lines
    prefix = F.create_map(*[F.lit(x) for pair in PREFIXES.items() for x in pair])[F.col("kind")]
    tables = deep.where("block_type = 'table'").select("doc_id", "ord", "depth")
    met = inner.join(tables, ["doc_id", "ord"]).where(prefix.isNotNull() & (T.strip(F.col("text")) != ""))
    return lines.unionByName(met.select("doc_id", "ord", "step", indented(F.col("depth") + F.col("local_depth"), F.concat(F.lit("("), prefix, F.lit(") "), T.collapse(F.col("text")))).alias("line")))


def context(lines: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, text): the lines of a document in order, a banner where a new section begins."""
    met = lines.join(sections, ["doc_id", "ord"])
    w = Window.partitionBy("doc_id").orderBy("ord", "step")
    new = ~F.lag("section").over(w).eqNullSafe(F.col("section"))
    banner = F.concat(F.lit("== section "), F.col("section").cast("string"), F.lit(" ==\n"))
    whole = met.withColumn("line", F.when(new, F.concat(banner, "line")).otherwise(F.col("line")))
    parts = whole.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", "step", "line"))).alias("parts"))
    return parts.select("doc_id", F.array_join(F.transform("parts", lambda x: x["line"]), "\n").alias("text"))


def preview(deep: DataFrame) -> DataFrame:
    """(doc_id, ord, line): the depth, the type and a shortened text of each block that is shown."""
    shown = (T.strip(F.col("text")) != "") & (F.col("band") != "peripheral")
    line = F.concat(F.lit("["), F.col("depth").cast("string"), F.lit("] "), F.repeat(F.lit("  "), F.col("depth").cast("int")), F.col("block_type"), F.lit(": "), shorten(F.col("text")))
    return deep.where(shown).select("doc_id", "ord", line.alias("line"))


def entry_levels(entries: DataFrame) -> DataFrame:
    """Entries (doc_id, ord, numbering) with the level of their number, else of the last number before, at first 0."""
    own = entries.withColumn("own", T.anchor_level(F.col("numbering")))
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return own.withColumn("level", F.coalesce(F.last("own", ignorenulls=True).over(before), F.lit(0)).cast("long")).drop("own")
