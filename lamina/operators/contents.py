"""Tables of contents: the anchor, its entries, the entries that anchor depths, and the depths they give."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T
from lamina.operators import folds

# The anchor's text and sections, and what makes a table one of contents.
ANCHOR = "목차"
SECTIONS = (0, 1)
PAGE_LINES = 2
PAGE_SHARE = 0.4
MISSES = 3


def entry_lines(lines: DataFrame) -> DataFrame:
    """Lines with page, numbering, title and title_key; blank lines are left out."""
    raw = lines.withColumn("raw", T.strip(F.col("text"))).where("raw <> ''").withColumn("p", T.strip_page(F.col("raw")))
    split = raw.withColumn("page", F.col("p.page")).withColumn("s", T.split_numbering(F.col("p.title")))
    return split.withColumns({"numbering": F.col("s.numbering"), "title": F.col("s.title"), "title_key": T.title_key(F.col("s.title"))}).drop("p", "s")


def find_anchor(blocks: DataFrame, cell_lines: DataFrame) -> DataFrame:
    """(doc_id, section, ord, table_id): the first paragraph of the first sections that is the anchor's text, else the first table with such a line.

    ``cell_lines`` is (doc_id, section, ord, table_id, n, text), ord being that of the table's block.
    """
    here = lambda df: df.where(F.col("section").isin(*SECTIONS) & (T.without_space(F.col("text")) == ANCHOR))
    paragraphs = here(blocks.where("block_type = 'paragraph'")).select("doc_id", F.struct(F.lit(0).alias("rank"), "ord", "section", F.lit(None).cast("string").alias("table_id")).alias("a"))
    tables = here(cell_lines).select("doc_id", F.struct(F.lit(1).alias("rank"), "ord", "section", "table_id").alias("a"))
    return paragraphs.unionByName(tables).groupBy("doc_id").agg(F.min("a").alias("a")).select("doc_id", "a.section", "a.ord", "a.table_id")


def table_entries(anchor: DataFrame, cell_lines: DataFrame) -> DataFrame:
    """Entries (doc_id, table_id, i, page, numbering, title, title_key) of the first unbroken run of contents tables after the anchor."""
    own = entry_lines(cell_lines.join(anchor.select("doc_id", "section", F.col("ord").alias("anchor_ord"), F.col("table_id").alias("anchor_table")), ["doc_id", "section"]))
    after = own.where(F.col("anchor_table").isNull() | (F.col("ord") > F.col("anchor_ord")))
    per = after.groupBy("doc_id", "table_id").agg(F.min("ord").alias("ord"), F.count("*").alias("n"), F.count("page").alias("pages"))
    like = (F.col("pages") >= PAGE_LINES) & (F.col("pages") >= PAGE_SHARE * F.col("n"))
    w = Window.partitionBy("doc_id").orderBy("ord")
    seen = per.withColumn("like", like).withColumn("run", F.sum(F.when(F.col("like"), 0).otherwise(1)).over(w))
    first = seen.where("like").withColumn("first", F.min("run").over(Window.partitionBy("doc_id"))).where("run = first").select("doc_id", "table_id")
    found = after.join(first, ["doc_id", "table_id"])
    i = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord", "n")) - 1
    return found.select("doc_id", "table_id", i.cast("long").alias("i"), "page", "numbering", "title", "title_key")


def paragraph_entries(anchor: DataFrame, blocks: DataFrame) -> DataFrame:
    """Entries among the anchor section's paragraphs after it, to the third miss in a row once an entry was found."""
    own = entry_lines(blocks.where("block_type = 'paragraph'").join(anchor.select("doc_id", "section", F.col("ord").alias("anchor_ord")), ["doc_id", "section"]).where("ord > anchor_ord"))
    w = Window.partitionBy("doc_id").orderBy("ord")
    hit = F.col("page").isNotNull() | F.col("numbering").isNotNull()
    # Misses in a row: the rows since the last hit; the first run of three after an entry ends the list.
    seen = own.withColumn("hit", hit).withColumn("hits", F.sum(F.when(F.col("hit"), 1).otherwise(0)).over(w))
    misses = F.count("*").over(Window.partitionBy("doc_id", "hits").orderBy("ord")) - F.when(F.col("hits") > 0, 1).otherwise(0)
    ended = seen.withColumn("stop", (F.col("hits") > 0) & (misses >= MISSES))
    early = ended.withColumn("stopped", F.max(F.when(F.col("stop"), 1).otherwise(0)).over(w))
    i = F.row_number().over(w) - 1
    return early.where("hit AND stopped = 0").select("doc_id", F.lit(None).cast("string").alias("table_id"), i.cast("long").alias("i"), "page", "numbering", "title", "title_key")


def entries(anchor: DataFrame, blocks: DataFrame, cell_lines: DataFrame) -> DataFrame:
    """Entries of tables where a document has such, else of paragraphs."""
    listed = table_entries(anchor, cell_lines)
    rest = anchor.join(listed.select("doc_id").distinct(), "doc_id", "left_anti")
    return listed.unionByName(paragraph_entries(rest, blocks))


def anchor_entries(found: DataFrame) -> DataFrame:
    """Entries whose number is all digits, with its level and their place among those of the level."""
    own = found.withColumn("level", T.anchor_level(F.col("numbering")).cast("long")).where("level IS NOT NULL AND title_key <> ''")
    return own.withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "level").orderBy("i")).cast("long") - 1)


def anchored_depths(blocks: DataFrame, anchor: DataFrame, found: DataFrame, titles: DataFrame) -> DataFrame:
    """Blocks with anchored, and the entry's level as depth where one meets them.

    ``titles`` (doc_id, ord, text) has the text of each block that can be a title. Anchors hold only in documents
    in which an entry of level 0 is met.
    """
    wanted = anchor_entries(found)
    sources = found.where("table_id IS NOT NULL").select("doc_id", "table_id").distinct()
    after = titles.join(anchor.select("doc_id", F.col("ord").alias("anchor_ord")), "doc_id").where("ord > anchor_ord")
    if "table_id" in titles.columns:
        after = after.join(sources, ["doc_id", "table_id"], "left_anti")
    keyed = after.select("doc_id", "ord", T.title_key(T.split_numbering(T.collapse(F.col("text")))["title"]).alias("title_key"))
    met = folds.match_entries(wanted.select("doc_id", F.col("i").alias("entry"), "title_key"), keyed)
    levels = met.join(wanted.select("doc_id", F.col("i").alias("entry"), "level"), ["doc_id", "entry"])
    active = levels.where("level = 0").select("doc_id").distinct()
    hits = levels.join(active, "doc_id", "left_semi").select("doc_id", "ord", F.col("level").alias("entry_level"))
    return blocks.join(hits, ["doc_id", "ord"], "left").withColumns({"anchored": F.col("entry_level").isNotNull(), "depth": F.coalesce("entry_level", "depth")}).drop("entry_level")
