"""Queries of row headers, the filter, projections, checks and hashes of the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import text as T
from lamina.operators import blocks as B
from lamina.operators import classify, grid, headers, model
from lamina.plans.block_queries import DEEP, ROLES, deep, roles
from lamina.plans.kind_queries import TYPE_OF, cascade
from lamina.plans.kind_queries import ORACLES as KIND_ORACLES
from lamina.plans.table_queries import ORACLES as TABLE_ORACLES
from lamina.plans.table_queries import CELLS, SCORES, numeric_sql, strip_sql
from lamina.sources.adapters import KIND_CELLS_SQL, KIND_PARENTS_SQL, kind_cells, kind_parents, order_cells, read


def labelled_cells(spark, sf_dir):
    """Order tables with the flags as first column, so that some have row headers; the running number goes last."""
    cells = order_cells(spark, sf_dir)
    place = F.when(F.col("c") == 0, 4).when(F.col("c") == 2, 0).when(F.col("c") == 4, 2).otherwise(F.col("c")).cast("long")
    named = F.when((F.col("c") == 2) & (F.col("r") > 0), F.concat(F.lit("group "), "text")).otherwise(F.col("text"))
    return cells.withColumn("text", named).withColumn("c", place)


def header_cols(spark, sf_dir):
    return headers.found_headers(labelled_cells(spark, sf_dir)).select("table_id", "n_header_cols", "reason")


def verdict_beside_labels(spark, sf_dir):
    """The numeric verdict with the columns of row headers left out of it."""
    cells = labelled_cells(spark, sf_dir)
    return headers.numeric_verdict(cells, headers.found_headers(cells))


def header_audit(spark, sf_dir):
    """Header rows as found, against one declared row, or two where three divides the key."""
    cells = order_cells(spark, sf_dir)
    found = headers.found_rows(cells).where("n_header > 0").select("table_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_header") - 1)).alias("r"))
    declared = cells.select("table_id").distinct().select("table_id", F.explode(F.when(F.col("table_id") % 3 == 0, F.expr("array(0L, 1L)")).otherwise(F.expr("array(0L)"))).alias("r"))
    return model.header_audit(declared, found)


def table_blocks(spark, sf_dir):
    """The small tables as blocks of their customers, with the text of their cells; some blocks are of no table."""
    texts = grid.rollup_text(kind_cells(spark, sf_dir))
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderkey") % 10 != 9, F.col("o_orderkey")).alias("table_id"))
    return orders.join(texts.withColumnRenamed("table_id", "ord"), "ord", "left").select("doc_id", "ord", "table_id", F.coalesce("text", F.lit("")).alias("text"))


def model_filter(spark, sf_dir):
    """The blocks after the filter: excluded tables are empty places with the reason."""
    found = model.filtered_blocks(table_blocks(spark, sf_dir), model.gone(cascade(spark, sf_dir)))
    return found.select("doc_id", "ord", "text", "excluded_reason", F.size("toc_entries").cast("long").alias("n_entries"))


def pruned_cells(spark, sf_dir):
    """How many cells the filter leaves of each kept table."""
    left = model.prune(kind_cells(spark, sf_dir), model.gone(cascade(spark, sf_dir)))
    return left.groupBy("table_id").agg(F.count("*").alias("n"))


def filter_counts(spark, sf_dir):
    cells = kind_cells(spark, sf_dir)
    verdicts = cells.select("table_id").distinct().select("table_id", F.when(F.col("table_id") % 2 == 0, "numeric").otherwise("undecidable").alias("verdict"))
    return model.filter_counts(cascade(spark, sf_dir), classify.types(cells), verdicts)


def kept_tables(spark, sf_dir):
    return model.kept_tables(kind_cells(spark, sf_dir).select("table_id").distinct(), cascade(spark, sf_dir))


def sensitivity(spark, sf_dir):
    cells = kind_cells(spark, sf_dir)
    facts = grid.gridness(cells).join(classify.types(cells), "table_id").select("table_id", "gridness", "table_type", (F.col("table_id") % 5 == 0).alias("complete"), (F.col("table_id") % 7 == 0).alias("pairs"))
    return model.sensitivity(facts)


def body_linking(spark, sf_dir):
    cells = kind_cells(spark, sf_dir)
    tables = cells.select("table_id").distinct().join(kind_parents(spark, sf_dir), "table_id", "left")
    found = model.linking(cells, tables, classify.types(cells))
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "|").alias(c)
    return found.select("table_id", F.coalesce("parent_id", F.lit(-1)).alias("parent_id"), "table_type", "text", listed("own_texts"), "n_cells", "n_empty", "n_merged", "n_multiline", listed("child_ids"))


def first_texts(spark, sf_dir):
    rows = order_cells(spark, sf_dir).select("table_id", (F.col("r") * 10 + F.col("c")).alias("place"), "text")
    return model.first_texts(rows, "table_id")


def searchable_blocks(spark, sf_dir):
    found = model.searchable_blocks(B.visibility(roles(spark, sf_dir)))
    return found.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("ord").alias("places"))


def block_snapshot(spark, sf_dir):
    return model.snapshot(deep(spark, sf_dir))


def model_checks(spark, sf_dir):
    """Order lines as a model with faults planted by key, and what each check finds of them."""
    lines = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 31 == 0, None).otherwise(F.col("o_orderstatus")).alias("status"), (F.col("o_orderkey") % 7).alias("depth"))
    paths = lines.select("o_orderkey", F.array(F.col("depth"), F.col("depth") + 1, F.col("o_orderkey") % 11).alias("depths"))
    cells = kind_cells(spark, sf_dir)
    sizes = grid.sizes(cells).withColumn("n_rows", F.when(F.col("table_id") % 13 == 0, F.col("n_rows") + 1).otherwise(F.col("n_rows")))
    refs = lines.select(F.when(F.col("o_orderkey") % 17 == 0, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey")).alias("c_custkey"))
    return model.collected(
        [
            model.twice("duplicate_id", lines.select((F.col("o_orderkey") - F.when(F.col("o_orderkey") % 29 == 1, 1).otherwise(0)).alias("id")), "id"),
            model.lacking("missing_value", lines, "o_orderkey", "status"),
            model.rising("path_not_rising", paths, "o_orderkey", "depths"),
            model.drawn("markdown_size", grid.markdown(cells), sizes),
            model.unknown("unknown_reference", refs, "c_custkey", read(spark, sf_dir, "customer"), "c_custkey"),
            model.lost("lost_key", lines, lines.where("o_orderkey % 23 <> 5"), "o_orderkey"),
        ]
    )


def json_paths(spark, sf_dir):
    """Paths of the events' properties and of a nested object made around them."""
    events = read(spark, sf_dir, "events")
    made = events.select(F.concat(F.lit('{"props": '), F.coalesce("props", F.lit("null")), F.lit(', "kind": "'), "event_type", F.lit('", "list": [{"a": 1}, {"a": "", "b": []}], "ok": true}')).alias("j"))
    return model.json_paths(made, "j")


def dynamic_paths(spark, sf_dir):
    """Objects with one key of a hundred, and fixed ones: only the first are maps."""
    events = read(spark, sf_dir, "events")
    made = events.select(F.concat(F.lit('{"by_user": {"u'), (F.col("event_id") % 100).cast("string"), F.lit('": 1}, "fixed": {"x": 1, "y": 2}}')).alias("j"))
    return model.dynamic_paths(model.json_paths(made, "j"))


def evidence(spark, sf_dir):
    """Which names, and digits of keys, are evidence where they are found, and which have characters of private use."""
    part = read(spark, sf_dir, "part")
    value = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey").cast("string")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("\ue000"), "p_name")).otherwise(F.substring("p_name", 1, 1))
    return part.select("p_partkey", model.is_evidence(value).alias("evidence"), model.has_private_use(value).alias("private_use"))


QUERIES = {
    "header_cols": header_cols,
    "numeric_verdict_beside_labels": verdict_beside_labels,
    "header_audit": header_audit,
    "model_filter": model_filter,
    "pruned_cells": pruned_cells,
    "filter_counts": filter_counts,
    "kept_tables": kept_tables,
    "filter_sensitivity": sensitivity,
    "body_linking": body_linking,
    "first_texts": first_texts,
    "searchable_blocks": searchable_blocks,
    "block_snapshot": block_snapshot,
    "model_checks": model_checks,
    "json_paths": json_paths,
    "dynamic_paths": dynamic_paths,
    "evidence": evidence,
}

#: The cells of SCORES replaced by those with the flags in front.
LABELLED = SCORES.replace(
    "\nt AS (SELECT table_id, r, c, row_span, col_span, trim(",
    "\ncells2 AS (SELECT table_id, r, CASE c WHEN 0 THEN 4 WHEN 2 THEN 0 WHEN 4 THEN 2 ELSE c END AS c, row_span, col_span, CASE WHEN c = 2 AND r > 0 THEN 'group ' || text ELSE text END AS text FROM cells),\nt AS (SELECT table_id, r, c, row_span, col_span, trim(",
).replace("AS text FROM cells),\nsize AS", "AS text FROM cells2),\nsize AS")
_CTES, _SCORE = TABLE_ORACLES["header_col_scores"].replace(SCORES, LABELLED).split("\nSELECT table_id, n, CAST(", 1)
HEADER_COLS = f"""{_CTES},
hs AS (SELECT table_id, n, n_data, kv, is_index, is_code, is_date, n = 2 AND n_data > 0 AND hier * 10 >= 6 * n_data AND right_values * 2 >= rights AND rights > 0 AS both_, CAST({_SCORE.replace(" AS score FROM cc", " AS score FROM cc)")},
hx AS (SELECT hs.*, n_cols, n_data > 1 AND score >= CASE WHEN n_cols = 2 THEN 5 ELSE 4 END AS acc FROM hs JOIN size USING (table_id)),
ht AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY score DESC, n) AS k FROM hx WHERE acc) WHERE k = 1),
h1 AS (SELECT table_id, score FROM hx WHERE acc AND n = 1),
hb AS (SELECT table_id, any_value(n_data) AS n_data, any_value(kv) AS kv, any_value(is_index) AS is_index, any_value(is_code) AS is_code, any_value(is_date) AS is_date, any_value(n_cols) AS n_cols, max(score) AS best FROM hx GROUP BY table_id),
hc_ AS (SELECT s.table_id, CAST(CASE WHEN t.n IS NULL THEN 0 WHEN t.n > 1 AND NOT t.both_ AND coalesce(t.score - h1.score <= 1, false) THEN 1 ELSE t.n END AS BIGINT) AS n_header_cols,
  CASE WHEN size.n_cols <= 1 THEN 'SINGLE_COLUMN_TABLE' WHEN hb.n_data <= 1 THEN 'TOO_FEW_DATA_ROWS_FOR_HEADER_COLS' WHEN t.n IS NOT NULL THEN '' WHEN hb.kv THEN 'KEY_VALUE_LIKE_TABLE' WHEN hb.is_index THEN 'INDEX_LIKE_FIRST_COLUMN'
    WHEN hb.is_code THEN 'CODE_LIKE_FIRST_COLUMN' WHEN hb.is_date THEN 'DATE_LIKE_FIRST_COLUMN' WHEN best >= CASE WHEN hb.n_cols = 2 THEN 3 ELSE 2 END THEN 'UNSTABLE_HEADER_COLS' ELSE '' END AS reason
  FROM (SELECT DISTINCT table_id FROM heads) s JOIN size USING (table_id) LEFT JOIN ht t USING (table_id) LEFT JOIN h1 USING (table_id) LEFT JOIN hb USING (table_id))"""
LABEL_SQL = KIND_ORACLES["table_cascade"].replace("\nSELECT table_id, CASE WHEN label LIKE", ",\nlabels AS (SELECT table_id, CASE WHEN label LIKE") + ")"
ORACLES = {
    "header_cols": f"{HEADER_COLS} SELECT table_id, n_header_cols, reason FROM hc_",
    "numeric_verdict_beside_labels": f"""{HEADER_COLS},
body AS (SELECT t.table_id, t.c, t.r, {strip_sql("t.text")} AS v FROM t JOIN g USING (table_id, r) JOIN heads h USING (table_id) JOIN hc_ USING (table_id) WHERE h.n_header > 0 AND g.i >= h.n_header AND t.c >= n_header_cols AND NOT regexp_matches({strip_sql("t.text")}, '{T.NEUTRAL}')),
per AS (SELECT table_id, c, bool_and({numeric_sql("v")}) AS num, list(v ORDER BY r) AS vs FROM body GROUP BY table_id, c),
ser AS (SELECT *, len(vs) >= 2 AND coalesce(vs[1] IN ('0', '1'), false) AND vs = list_transform(range(len(vs)), lambda x: CAST(x + TRY_CAST(replace(vs[1], ',', '') AS BIGINT) AS VARCHAR)) AS serial FROM per),
v AS (SELECT table_id, bool_or(num AND NOT serial) AS num FROM ser GROUP BY table_id)
SELECT h.table_id, CASE WHEN n_header = 0 THEN 'undecidable' WHEN num THEN 'numeric' ELSE 'not_numeric' END AS verdict FROM heads h LEFT JOIN v USING (table_id)""",
    "header_audit": f"""{SCORES}, every AS (SELECT DISTINCT table_id FROM cells)
SELECT table_id, CASE WHEN coalesce(n_header, 0) = 0 THEN 'missed' WHEN n_header = want THEN 'exact' WHEN n_header < want THEN 'subset' ELSE 'superset' END AS verdict
FROM (SELECT table_id, n_header, CASE WHEN table_id % 3 = 0 THEN 2 ELSE 1 END AS want FROM every LEFT JOIN heads USING (table_id))""",
    "model_filter": f"""{LABEL_SQL}, txt AS (SELECT table_id, string_agg(trim(text), ' ' ORDER BY r, c) AS text FROM ({KIND_CELLS_SQL}) WHERE trim(text) <> '' GROUP BY table_id)
SELECT o_custkey AS doc_id, o_orderkey AS ord, CASE WHEN o_orderkey % 10 <> 9 AND label LIKE 'exclude%' THEN '' ELSE coalesce(txt.text, '') END AS text,
  CASE WHEN o_orderkey % 10 <> 9 AND label LIKE 'exclude%' THEN label ELSE '' END AS excluded_reason, 0 AS n_entries
FROM orders LEFT JOIN labels l ON l.table_id = o_orderkey LEFT JOIN txt ON txt.table_id = o_orderkey""",
    "pruned_cells": f"{LABEL_SQL} SELECT c.table_id, count(*) AS n FROM ({KIND_CELLS_SQL}) c JOIN labels l ON l.table_id = c.table_id WHERE label NOT LIKE 'exclude%' GROUP BY c.table_id",
    "filter_counts": f"""{LABEL_SQL}, x AS (SELECT label, o_orderkey, {TYPE_OF} AS kind FROM labels JOIN orders ON o_orderkey = table_id)
SELECT 'label' AS measure, label AS value, count(*) AS n FROM x GROUP BY ALL UNION ALL SELECT 'table_type', kind, count(*) FROM x WHERE label LIKE 'keep%' GROUP BY ALL
UNION ALL SELECT 'verdict', CASE WHEN o_orderkey % 2 = 0 THEN 'numeric' ELSE 'undecidable' END, count(*) FROM x WHERE label LIKE 'keep%' GROUP BY ALL""",
    "kept_tables": f"{LABEL_SQL} SELECT table_id, replace(label, 'keep_', '') AS kept_as FROM labels WHERE label LIKE 'keep%'",
    "filter_sensitivity": f"""WITH cells AS ({KIND_CELLS_SQL}), x AS (SELECT table_id, r, count(DISTINCT c) FILTER (trim(text) <> '') AS n FROM cells GROUP BY ALL), y AS (SELECT table_id, count(DISTINCT c) FILTER (trim(text) <> '') AS n_cols FROM cells GROUP BY ALL),
z AS (SELECT table_id, count(*) FILTER (n > 0) >= 2 AND count(*) FILTER (n > 1) >= 2 AND any_value(n_cols) >= 2 AS is_grid FROM x JOIN y USING (table_id) GROUP BY table_id),
f AS (SELECT table_id, is_grid, {TYPE_OF} AS kind FROM z JOIN orders ON o_orderkey = table_id)
SELECT 'no_grid_but_records' AS conflict, table_id FROM f WHERE NOT is_grid AND table_id % 5 = 0 UNION ALL SELECT 'title_box_but_grid', table_id FROM f WHERE is_grid AND kind = 'title_box'
UNION ALL SELECT 'no_grid_but_pairs', table_id FROM f WHERE NOT is_grid AND table_id % 7 = 0""",
    "body_linking": f"""WITH cells AS ({KIND_CELLS_SQL}), p AS ({KIND_PARENTS_SQL}), kids AS (SELECT parent_id, string_agg(CAST(table_id AS VARCHAR), '|' ORDER BY table_id) AS ids FROM p GROUP BY parent_id),
s AS (SELECT table_id, coalesce(string_agg(trim(text), ' ' ORDER BY r, c) FILTER (trim(text) <> ''), '') AS text, coalesce(string_agg(trim(text), '|' ORDER BY r, c) FILTER (trim(text) <> ''), '') AS own_texts, count(*) AS n_cells,
  count(*) FILTER (trim(text) = '') AS n_empty, count(*) FILTER (row_span > 1 OR col_span > 1) AS n_merged FROM cells GROUP BY table_id)
SELECT s.table_id, coalesce(p.parent_id, -1) AS parent_id, {TYPE_OF} AS table_type, s.text, own_texts, n_cells, n_empty, n_merged, 0 AS n_multiline, coalesce(kids.ids, '') AS child_ids
FROM s JOIN orders ON o_orderkey = s.table_id LEFT JOIN p ON p.table_id = s.table_id LEFT JOIN kids ON kids.parent_id = s.table_id""",
    "first_texts": f"{CELLS} SELECT table_id, string_agg(trim(text), ' ' ORDER BY nth) AS text FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY r, c) AS nth FROM cells WHERE trim(text) <> '') WHERE nth <= 5 GROUP BY table_id",
    "searchable_blocks": f"{ROLES} SELECT doc_id, count(*) AS n, CAST(sum(ord) AS BIGINT) AS places FROM roles WHERE role <> 'empty_paragraph' AND block_type <> 'control' AND band <> 'peripheral' GROUP BY doc_id",
    "block_snapshot": f"""{DEEP} SELECT doc_id, count(*) AS n_blocks, sha256(string_agg(own, '' ORDER BY ord)) AS sha256 FROM (
  SELECT doc_id, ord, sha256(block_type || chr(31) || role || chr(31) || CAST(depth AS VARCHAR) || chr(31) || text) AS own FROM deep) GROUP BY doc_id""",
    "model_checks": f"""WITH cells AS ({KIND_CELLS_SQL}), ids AS (SELECT o_orderkey - CASE WHEN o_orderkey % 29 = 1 THEN 1 ELSE 0 END AS id FROM orders)
SELECT 'duplicate_id' AS "check", count(*) AS n FROM (SELECT id FROM ids GROUP BY id HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'missing_value', count(*) FROM orders WHERE o_orderkey % 31 = 0 OR o_orderstatus IS NULL HAVING count(*) > 0
UNION ALL SELECT 'path_not_rising', count(*) FROM orders WHERE NOT (o_orderkey % 11 > o_orderkey % 7 + 1) HAVING count(*) > 0
UNION ALL SELECT 'markdown_size', count(DISTINCT table_id) FROM cells WHERE table_id % 13 = 0 HAVING count(*) > 0
UNION ALL SELECT 'unknown_reference', count(*) FROM orders WHERE o_orderkey % 17 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer) HAVING count(*) > 0
UNION ALL SELECT 'lost_key', count(*) FROM orders WHERE o_orderkey % 23 = 5 HAVING count(*) > 0""",
    "json_paths": """WITH e AS (SELECT event_type, props, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events), n AS (SELECT count(*) AS n FROM e)
SELECT '$' AS path, 'object' AS kind, n, 0 AS n_empty, (SELECT max(length('{"kind":"' || event_type || '","list":[{"a":1},{"a":"","b":[]}],"ok":true,"props":{"k":' || k || '}}')) FROM e) AS longest FROM n
UNION ALL SELECT '$.kind', 'string', n, 0, (SELECT max(length(event_type)) FROM e) FROM n UNION ALL SELECT '$.ok', 'boolean', n, 0, 4 FROM n
UNION ALL SELECT '$.list', 'array', n, 0, length('[{"a":1},{"a":"","b":[]}]') FROM n UNION ALL SELECT '$.list[]', 'object', 2 * n, 0, 15 FROM n
UNION ALL SELECT '$.list[].a', 'number', n, 0, 1 FROM n UNION ALL SELECT '$.list[].a', 'string', n, n, 0 FROM n UNION ALL SELECT '$.list[].b', 'array', n, n, 2 FROM n
UNION ALL SELECT '$.props', 'object', n, 0, (SELECT max(length('{"k":' || k || '}')) FROM e) FROM n UNION ALL SELECT '$.props.k', 'number', n, 0, (SELECT max(length(k)) FROM e) FROM n""",
    "dynamic_paths": "SELECT '$.by_user' AS path FROM events HAVING count(DISTINCT event_id % 100) > 30",
    "evidence": """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN length(CAST(p_partkey AS VARCHAR)) >= 6 WHEN p_partkey % 3 = 1 THEN true ELSE false END AS evidence, p_partkey % 3 = 1 AS private_use FROM part""",
}
