"""Queries of audits, over ordinary tables with faults planted by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.operators import audits
from lamina.operators import blocks as B
from lamina.sources.adapters import KIND_PARENTS_SQL, LINE_BLOCKS_SQL, kind_parents, line_blocks, read


def inner_depths(spark, sf_dir):
    """Order lines as inner rows of their order's block; some have no depth, some a wrong one, some blocks are absent."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("root_id"), (F.col("o_custkey") % 5).alias("depth"))
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("root_id"), (F.col("l_linenumber") % 4).cast("long").alias("local_depth"), (F.col("l_partkey") % 37 == 0).cast("long").alias("off"))
    flat = lines.join(orders, "root_id").select("root_id", "local_depth", (F.col("depth") + F.col("local_depth") + F.col("off")).alias("absolute_depth"))
    return audits.inner_depths(flat, orders.where("root_id % 19 <> 0"))


def nested_presence(spark, sf_dir):
    """The small tables' tree, with references lost, moved and made up."""
    inner = kind_parents(spark, sf_dir).select("table_id", "parent_id")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"))
    holder = F.when(F.col("table_id") % 17 == 0, F.col("parent_id") + 1).otherwise(F.col("parent_id"))
    refs = inner.where("table_id % 13 <> 0").select(holder.alias("table_id"), F.col("table_id").alias("child"))
    made_up = orders.where("table_id % 11 = 0").select("table_id", (F.col("table_id") + 10_000_000_000).alias("child"))
    return audits.nested_presence(refs.unionByName(made_up), orders.join(inner, "table_id", "left"))


def repeated_warnings(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.concat("l_returnflag", "l_linestatus").alias("code"))
    return audits.repeated(lines, "table_id")


def first_warnings(spark, sf_dir):
    codes = F.array(*[F.lit(x) for x in (" Irregular_Grid ", "irregular_grid", "MISSING_HEADER_ROWS", " ", "raw_only_table")])
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").cast("long").alias("place"), F.get(codes, (F.col("l_partkey") % 5).cast("int")).alias("code"))
    return audits.normalized(lines, "table_id")


def owned_tables(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"))
    owner = F.when(F.col("table_id") % 12 == 0, "header").when(F.col("table_id") % 12 == 6, "footnote")
    return audits.owned(orders.join(kind_parents(spark, sf_dir), "table_id", "left").select("table_id", "parent_id", owner.alias("owner")))


def dangling_styles(spark, sf_dir):
    """The customers of orders as styles that documents, one per status, use; the dictionary has those of even orders."""
    uses = read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("path"), F.lit("style").alias("kind"), F.col("o_custkey").cast("string").alias("id"), "o_orderkey")
    return audits.dangling(uses, uses.where("o_orderkey % 2 = 0").select("path", "kind", "id").distinct())


def anchor_warnings(spark, sf_dir):
    blocks = line_blocks(spark, sf_dir).withColumn("paragraph_index", F.col("ord") % 4)
    objects = blocks.where("block_type IN ('image', 'shape', 'caption', 'footnote')")
    return audits.anchor_warnings(objects, B.floating_anchors(objects, blocks.where("block_type = 'paragraph'")))


def two_ways(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("q"))
    some = lines.where("l_partkey % 53 <> 0").withColumn("q", F.when(F.col("l_partkey") % 59 == 0, F.col("q") + 1).otherwise(F.col("q")))
    sums = lambda x: x.groupBy("l_orderkey").agg(F.sum("q").alias("q"))
    return audits.two_ways({"lines": (lines, some), "sums": (sums(lines), sums(some)), "equal": (lines, lines.where("true"))})


QUERIES = {
    "inner_depths": inner_depths, "nested_presence": nested_presence, "repeated_warnings": repeated_warnings, "first_warnings": first_warnings,
    "owned_tables": owned_tables, "dangling_styles": dangling_styles, "anchor_warnings": anchor_warnings, "two_ways": two_ways,
}
ORACLES = {
    "inner_depths": """WITH f AS (SELECT l_orderkey AS root_id, CAST(l_linenumber % 4 AS BIGINT) AS local_depth, CAST(o_custkey % 5 + l_linenumber % 4 + CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END AS BIGINT) AS absolute_depth,
  l_partkey % 37 = 0 AND l_orderkey % 19 <> 0 AS wrong FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT root_id, local_depth, absolute_depth, CASE WHEN local_depth = 0 THEN 'invalid_local_depth' ELSE 'invalid_absolute_depth' END AS code FROM f WHERE local_depth = 0 OR wrong""",
    "nested_presence": f"""WITH k AS ({KIND_PARENTS_SQL})
SELECT table_id, CASE WHEN table_id % 13 = 0 THEN 'without_reference' ELSE 'reference_elsewhere' END AS problem FROM k WHERE table_id % 13 = 0 OR table_id % 17 = 0
UNION ALL SELECT o_orderkey + 10000000000, 'unknown_reference' FROM orders WHERE o_orderkey % 11 = 0""",
    "repeated_warnings": "SELECT l_orderkey AS table_id, l_returnflag || l_linestatus AS code, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) >= 2",
    "first_warnings": """WITH w AS (SELECT l_orderkey AS table_id, CAST(l_linenumber AS BIGINT) AS place, ['irregular_grid', 'irregular_grid', 'missing_header_rows', '', 'raw_only_table'][l_partkey % 5 + 1] AS code FROM lineitem)
SELECT table_id, min(place) AS place, code, CASE code WHEN 'irregular_grid' THEN 'info' ELSE 'warning' END AS severity FROM w WHERE code <> '' GROUP BY table_id, code""",
    "owned_tables": f"""WITH RECURSIVE t AS (SELECT o_orderkey AS table_id, parent_id, CASE o_orderkey % 12 WHEN 0 THEN 'header' WHEN 6 THEN 'footnote' END AS owner FROM orders LEFT JOIN ({KIND_PARENTS_SQL}) k ON k.table_id = o_orderkey),
w AS (SELECT table_id, owner FROM t WHERE owner IS NOT NULL UNION ALL SELECT t.table_id, w.owner FROM t JOIN w ON t.parent_id = w.table_id WHERE t.owner IS NULL)
SELECT table_id, owner FROM w""",
    "dangling_styles": """SELECT o_orderstatus AS path, 'style' AS kind, CAST(o_custkey AS VARCHAR) AS id, count(*) AS n FROM orders GROUP BY o_orderstatus, o_custkey HAVING count(*) FILTER (o_orderkey % 2 = 0) = 0""",
    "anchor_warnings": f"""WITH b AS ({LINE_BLOCKS_SQL}), p AS (SELECT doc_id, section, ord % 4 AS i, count(*) AS n FROM b WHERE block_type = 'paragraph' GROUP BY ALL),
m AS (SELECT b.doc_id, b.ord, block_type, coalesce(n, 0) AS n FROM b LEFT JOIN p ON p.doc_id = b.doc_id AND p.section = b.section AND p.i = b.ord % 4 WHERE block_type IN ('image', 'shape', 'caption', 'footnote'))
SELECT doc_id, ord, CASE WHEN block_type IN ('image', 'shape') THEN 'floating_anchor_unresolved' WHEN n = 0 THEN 'orphan_' || block_type || '_unresolved' ELSE 'orphan_' || block_type || '_uncertain' END AS code,
  CASE WHEN n = 0 THEN 'warning' ELSE 'info' END AS severity FROM m WHERE n = 0 OR (n > 1 AND block_type IN ('caption', 'footnote'))""",
    "two_ways": """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc(l_quantity) AS BIGINT) AS q FROM lineitem),
b AS (SELECT l_orderkey, l_linenumber, l_partkey, q + CASE WHEN l_partkey % 59 = 0 THEN 1 ELSE 0 END AS q FROM a WHERE l_partkey % 53 <> 0),
sa AS (SELECT l_orderkey, sum(q) AS q FROM a GROUP BY ALL), sb AS (SELECT l_orderkey, sum(q) AS q FROM b GROUP BY ALL),
x AS (SELECT 'lines' AS "check", 'left' AS side, count(*) AS n FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT 'lines', 'right', count(*) FROM (FROM b EXCEPT ALL FROM a)
  UNION ALL SELECT 'sums', 'left', count(*) FROM (FROM sa EXCEPT ALL FROM sb) UNION ALL SELECT 'sums', 'right', count(*) FROM (FROM sb EXCEPT ALL FROM sa))
SELECT * FROM x WHERE n > 0""",
}
