"""Relations of the engine made from ordinary tables: order tables, document lines, page nodes, turns, nesting.

Each adapter has the SQL of the same relation beside it, for the queries' counterparts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.runtime import spread

#: What the lines of documents get in front and behind, by place, so that numbering and marker rules meet cases.
PREFIXES = ["1. ", "3.1 ", "2-1-4 ", "Ⅱ-1 ", "가. ", "① ", "- ", "· ", "※ ", "□ ", " \t ", "", "2) ", "나) ", "12.3.4. ", "3S "]
SUFFIXES = ["", "\t12", " ..... 7", " 3", "…… 41"]

#: Header texts of the order tables, by column.
ORDER_HEADER = ["번호", "수량", "구분", "현황", "일자"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, text): the non-blank lines of documents with a prefix and a suffix."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.trim("line") != "")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))
    key = F.col("doc_id") * 7 + F.col("pos")
    return lines.select("doc_id", F.col("pos").cast("long").alias("pos"), F.concat(pick(PREFIXES, key), F.col("line"), pick(SUFFIXES, key)).alias("text"))


def quoted(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''").replace("\t", "'||chr(9)||'") + "'" for v in values) + "]"


MARKED_LINES_SQL = f"""
SELECT doc_id, pos, {quoted(PREFIXES)}[(doc_id * 7 + pos) % {len(PREFIXES)} + 1] || line || {quoted(SUFFIXES)}[(doc_id * 7 + pos) % {len(SUFFIXES)} + 1] AS text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
WHERE trim(line) <> ''"""


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_id, r, c, row_span, col_span, text): a header row, then the order's lines; equal flags in a run are one cell.

    Lines are dealt out by their order once; one sort gives rows and runs, and a run's cell is made where it ends.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    lines = spread(read(spark, sf_dir, "lineitem").select("l_orderkey", *order), "l_orderkey")
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    flag = F.col("l_returnflag")
    rows = lines.withColumns({"r": F.row_number().over(w).cast("long"), "before": F.lag(flag).over(w), "after": F.lead(flag).over(w)})
    # The first row of the run so far: no flag equals a null, so those stand alone.
    starts = F.when(F.coalesce(F.col("before") == flag, F.lit(False)), None).otherwise(F.col("r"))
    runs = rows.withColumn("start", F.max(starts).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # Places below 0 are the header's, in the first row only; the cell of a run stands at its last row.
    places = F.explode(F.sequence(F.when(F.col("r") == 1, -len(ORDER_HEADER)).otherwise(0), F.lit(len(ORDER_HEADER) - 1)))
    ended = ~F.coalesce(F.col("after") == flag, F.lit(False))
    cells = runs.withColumn("ended", ended).withColumn("k", places).where("k <> 2 OR ended")
    k, one = F.col("k"), F.lit(1).cast("long")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    unit = F.when(F.col("l_partkey") % 5 == 0, F.concat(quantity, F.lit(" 개"))).when(F.col("l_partkey") % 11 == 0, F.lit("-")).otherwise(quantity)
    status = F.when(F.col("l_suppkey") % 13 == 0, "").otherwise(F.col("l_linestatus"))
    text = F.when(k == 0, F.col("r").cast("string")).when(k == 1, unit).when(k == 2, flag).when(k == 3, status).when(k == 4, F.date_format("l_shipdate", "yyyy-MM-dd"))
    for c, name in enumerate(ORDER_HEADER):
        text = text.when(k == c - len(ORDER_HEADER), name)
    return cells.select(
        F.col("l_orderkey").alias("table_id"),
        F.when(k < 0, 0).when(k == 2, F.col("start")).otherwise(F.col("r")).cast("long").alias("r"),
        F.when(k < 0, k + len(ORDER_HEADER)).otherwise(k).cast("long").alias("c"),
        F.when(k == 2, F.col("r") - F.col("start") + 1).otherwise(1).cast("long").alias("row_span"),
        one.alias("col_span"),
        text.alias("text"),
    )


ORDER_ROWS_SQL = """
SELECT l_orderkey AS table_id, r, [CAST(r AS VARCHAR),
    CASE WHEN l_partkey % 5 = 0 THEN q || ' 개' WHEN l_partkey % 11 = 0 THEN '-' ELSE q END,
    l_returnflag, CASE WHEN l_suppkey % 13 = 0 THEN '' ELSE l_linestatus END, strftime(l_shipdate, '%Y-%m-%d')] AS texts
FROM (SELECT *, CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS r FROM lineitem)"""
ORDER_CELLS_SQL = f"""
SELECT table_id, r, c, CASE WHEN c = 2 THEN span ELSE 1 END AS row_span, 1 AS col_span, text FROM (
  SELECT table_id, r, span, nth, unnest(range(5)) AS c, unnest(texts) AS text FROM (
    SELECT *, count(*) OVER (PARTITION BY table_id, run) AS span, row_number() OVER (PARTITION BY table_id, run ORDER BY r) AS nth FROM (
      SELECT *, sum(new) OVER (PARTITION BY table_id ORDER BY r) AS run FROM (
        SELECT *, CASE WHEN lag(texts[3]) OVER (PARTITION BY table_id ORDER BY r) = texts[3] THEN 0 ELSE 1 END AS new FROM ({ORDER_ROWS_SQL})))))
WHERE c <> 2 OR nth = 1
UNION ALL
SELECT table_id, 0, unnest(range(5)), 1, 1, unnest({quoted(ORDER_HEADER)}) FROM ({ORDER_ROWS_SQL}) WHERE r = 1"""




#: Types of line blocks by place, beside paragraphs.
BLOCK_TYPES = {0: "header", 5: "table", 6: "image", 7: "footnote", 8: "caption", 11: "shape", 17: "control"}


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks made from the lines of documents, with styles by length and place."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    pos, n = F.col("pos"), F.length("line")
    key = F.col("doc_id") * 7 + pos
    kind = F.lit("paragraph")
    for place, name in BLOCK_TYPES.items():
        kind = F.when(key % 23 == place, name).otherwise(kind)
    return lines.select(
        "doc_id",
        pos.cast("long").alias("ord"),
        F.floor(pos / 6).cast("long").alias("section"),
        kind.alias("block_type"),
        F.col("line").alias("text"),
        F.concat(F.lit("s"), (key % 3).cast("string")).alias("style_id"),
        F.concat(F.lit("p"), F.when(n < 120, 0).otherwise(1).cast("string")).alias("para_id"),
        F.when(n < 40, 16.0).when(n < 120, 14.0).when(n < 300, 12.0).otherwise(10.0).alias("font_size"),
        F.when(n < 90, 1.0).otherwise(0.25).alias("bold_ratio"),
        F.when(n < 60, "CENTER").otherwise("LEFT").alias("alignment"),
        (key % 5 * 300).cast("long").alias("indent"),
        F.when(key % 19 == 1, (key % 4).cast("int")).alias("native_level"),
        F.when(key % 13 == 2, (key % 3 + 1).cast("int")).alias("numbering_level"),
    )


LINE_BLOCKS_SQL = f"""
SELECT doc_id, pos AS ord, pos // 6 AS section, CASE key % 23 {" ".join(f"WHEN {k} THEN '{v}'" for k, v in BLOCK_TYPES.items())} ELSE 'paragraph' END AS block_type, line AS text,
  's' || (key % 3) AS style_id, 'p' || CASE WHEN n < 120 THEN 0 ELSE 1 END AS para_id, CAST(CASE WHEN n < 40 THEN 16 WHEN n < 120 THEN 14 WHEN n < 300 THEN 12 ELSE 10 END AS DOUBLE) AS font_size,
  CASE WHEN n < 90 THEN 1.0 ELSE 0.25 END AS bold_ratio, CASE WHEN n < 60 THEN 'CENTER' ELSE 'LEFT' END AS alignment, key % 5 * 300 AS indent,
  CASE WHEN key % 19 = 1 THEN key % 4 END AS native_level, CASE WHEN key % 13 = 2 THEN key % 3 + 1 END AS numbering_level
FROM (SELECT *, doc_id * 7 + pos AS key, length(line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents))"""


#: Small tables of each kind by place of the order, as (r, c, row_span, col_span, text); texts are SQL of both dialects.
KINDS = {
    0: [(0, 0, 1, 1, "concat(o_orderkey % 90, '. ', o_orderpriority)")],
    1: [(0, 0, 1, 1, "concat('A', o_orderkey % 10)"), (0, 1, 1, 1, "concat('order ', o_orderpriority, ' of customer ', o_custkey)")],
    2: [(0, 0, 1, 1, "'status'"), (0, 1, 1, 1, "concat(o_orderstatus, ' as recorded')"), (1, 0, 1, 1, "'priority'"), (1, 1, 1, 1, "concat('now ', o_orderpriority)"), (2, 0, 1, 1, "'customer'"), (2, 1, 1, 1, "concat('number ', o_custkey)")],
    3: [(0, 0, 1, 1, "concat('Table ', o_orderkey, ' totals')")],
    4: [(0, 0, 1, 1, "'state'"), (0, 1, 1, 1, "'prio'"), (0, 2, 1, 1, "'cust'"), (1, 0, 1, 1, "concat('recorded as ', o_orderstatus)"), (1, 1, 1, 1, "concat('priority ', o_orderpriority)"), (1, 2, 1, 1, "concat('customer ', o_custkey)")],
    5: [(0, 0, 1, 1, "' '"), (0, 1, 1, 1, "concat(o_orderpriority, ' heading text')"), (1, 0, 1, 1, "''"), (1, 1, 1, 1, "''")],
    6: [(r, c, 1, 1, f"concat('v', o_orderkey % {r + c + 3})") for r in range(3) for c in range(5)],
    7: [(0, 0, 2, 1, "'group'"), (0, 1, 1, 1, "'name'"), (0, 2, 1, 2, "o_orderpriority"), (1, 1, 1, 1, "'state'"), (1, 2, 1, 2, "o_orderstatus"), (2, 0, 1, 1, "'customer'"), (2, 1, 1, 3, "concat('c', o_custkey)"), (3, 0, 1, 4, "' '")],
    8: [(0, 0, 1, 1, "''"), (0, 1, 1, 1, "' '")],
}


def kind_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_id, r, c, row_span, col_span, text): a small table per order, of a kind by its key."""
    listed = None
    for kind, cells in KINDS.items():
        own = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(("r", "c", "row_span", "col_span"), cell)], F.expr(cell[4]).alias("text")) for cell in cells])
        at = F.col("o_orderkey") % len(KINDS) == kind
        listed = F.when(at, own) if listed is None else listed.when(at, own)
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"), F.explode(listed).alias("x")).select("table_id", "x.*")


def kind_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_id, parent_id): every table whose key mod 4 is not 0 lies in the table with the next lower key."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"))
    return orders.where("table_id % 4 <> 0").select("table_id", (F.col("table_id") - 1).alias("parent_id")).join(orders.select(F.col("table_id").alias("parent_id")), "parent_id", "left_semi")


KIND_CELLS_SQL = " UNION ALL ".join(
    f"SELECT o_orderkey AS table_id, {r} AS r, {c} AS c, {rs} AS row_span, {cs} AS col_span, {text} AS text FROM orders WHERE o_orderkey % {len(KINDS)} = {kind}" for kind, cells in KINDS.items() for r, c, rs, cs, text in cells
)
KIND_PARENTS_SQL = "SELECT o_orderkey AS table_id, o_orderkey - 1 AS parent_id FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey - 1 IN (SELECT o_orderkey FROM orders)"
