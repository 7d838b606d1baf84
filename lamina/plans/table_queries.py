"""Queries of the grid, header and record rules over order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.config import DEFAULT
from lamina.functions import text as T
from lamina.operators import grid, headers
from lamina.sources.adapters import ORDER_CELLS_SQL, ORDER_HEADER, order_cells, quoted

CELLS = f"WITH cells AS ({ORDER_CELLS_SQL})"
S = r"[\s\p{Z}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


def odd_cells(spark, sf_dir):
    """Order tables in which some cells reach too far: flags of every seventh table are two rows and a column larger."""
    cells = order_cells(spark, sf_dir)
    odd = (F.col("table_id") % 7 == 0) & (F.col("c") == 2) & (F.col("r") > 0)
    return cells.withColumn("row_span", F.when(odd, F.col("row_span") + 2).otherwise(F.col("row_span"))).withColumn("col_span", F.when(odd, 2).otherwise(F.col("col_span")).cast("long"))


def declared(spark, sf_dir):
    return grid.sizes(order_cells(spark, sf_dir))


ODD = f"""{CELLS},
declared AS (SELECT table_id, max(r + row_span) AS n_rows, max(c + col_span) AS n_cols FROM cells GROUP BY table_id),
odd AS (SELECT table_id, r, c, CASE WHEN table_id % 7 = 0 AND c = 2 AND r > 0 THEN row_span + 2 ELSE row_span END AS row_span,
  CASE WHEN table_id % 7 = 0 AND c = 2 AND r > 0 THEN 2 ELSE col_span END AS col_span, text FROM cells),
placed AS (SELECT *, unnest(range(c, c + col_span)) AS pc FROM (SELECT *, unnest(range(r, r + row_span)) AS pr FROM odd)),
taken AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id, pr, pc ORDER BY r, c) AS nth FROM placed) WHERE nth = 1),
places AS (SELECT table_id, pr, unnest(range(n_cols)) AS pc FROM (SELECT *, unnest(range(n_rows)) AS pr FROM declared)),
slots AS (SELECT p.table_id, p.pr, p.pc, CASE WHEN t.r IS NULL THEN 'empty' WHEN t.r = p.pr AND t.c = p.pc THEN 'origin' ELSE 'covered' END AS kind, t.text
  FROM places p LEFT JOIN taken t ON t.table_id = p.table_id AND t.pr = p.pr AND t.pc = p.pc)"""


def grid_slots(spark, sf_dir):
    found = grid.slots(odd_cells(spark, sf_dir), declared(spark, sf_dir))
    return found.groupBy("table_id", "kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars")).select("table_id", "kind", "n", F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_chars"))


def grid_issues(spark, sf_dir):
    return grid.issues(odd_cells(spark, sf_dir), declared(spark, sf_dir))


def merge_cover(spark, sf_dir):
    return grid.merge_cover(order_cells(spark, sf_dir))


def gridness(spark, sf_dir):
    """Gridness with the cells of some tables blanked."""
    cells = order_cells(spark, sf_dir)
    key = F.col("table_id") % 6
    gone = ((key == 1) & (F.col("r") > 0)) | ((key == 2) & (F.col("c") > 0)) | (key == 3)
    return grid.gridness(cells.withColumn("text", F.when(gone, " ").otherwise(F.col("text"))))


def structure(spark, sf_dir):
    return grid.structure(order_cells(spark, sf_dir))


def rollup(spark, sf_dir):
    return grid.rollup_text(order_cells(spark, sf_dir))


def markdown(spark, sf_dir):
    return grid.markdown(order_cells(spark, sf_dir))


def _words(words) -> str:
    return quoted(list(words))


def label_sql(x: str) -> str:
    return f"({x} <> '' AND length({x}) <= 12 AND (len(list_filter({_words(DEFAULT.labels)}, lambda k: contains({x}, k))) > 0 OR (length({x}) <= 6 AND NOT contains({x}, ' ') AND NOT regexp_matches({x}, '[{T.DIGITS}]'))))"


def numeric_like_sql(x: str) -> str:
    return f"(replace({x}, ' ', '') NOT IN ('', '-') AND regexp_matches(replace({x}, ' ', ''), '{T.NUMERIC}'))"


def data_sql(x: str) -> str:
    return f"(regexp_matches({x}, '{T.DATA}') OR {numeric_like_sql(x)} OR length({x}) > 20)"


def value_sql(x: str) -> str:
    return f"({x} <> '' AND ({x} IN ({', '.join(repr(m) for m in T.VALUE_MARKS)}) OR {numeric_like_sql(x)} OR regexp_matches({x}, '{T.DATA}') OR regexp_matches({x}, '{T.UNIT_VALUE}')))"


def column_label_sql(x: str) -> str:
    return f"({x} <> '' AND length({x}) <= 15 AND NOT {value_sql(x)} AND (len(list_filter({_words(DEFAULT.column_labels)}, lambda k: contains({x}, k))) > 0 OR (NOT regexp_matches({x}, '[{T.DIGITS}]') AND length({x}) <= 12)))"


def numeric_sql(x: str) -> str:
    return f"(NOT regexp_matches({x}, '{T.NEUTRAL}') AND NOT regexp_matches({x}, '{T.ITEM_NUMBER}') AND (regexp_matches({x}, '{T.PURE_NUMBER}') OR regexp_matches({x}, '{T.NUMBER_WITH_UNIT}') OR regexp_matches({x}, '{T.PERCENT}')))"


def value_classes(spark, sf_dir):
    cells = order_cells(spark, sf_dir).select("c", T.collapse(F.col("text")).alias("text"))
    kinds = {"numeric": T.is_numeric_value, "neutral": T.is_neutral, "numeric_like": T.is_numeric_like, "data": T.is_data_text, "value": T.is_value, "label": T.is_label, "column_label": T.is_column_label}
    return cells.groupBy("c").agg(F.count("*").alias("n"), *[F.count_if(rule(F.col("text"))).alias(f"n_{name}") for name, rule in kinds.items()])


SCORES = f"""{CELLS},
t AS (SELECT table_id, r, c, row_span, col_span, trim(regexp_replace(text, '{S}+', ' ', 'g')) AS text FROM cells),
size AS (SELECT table_id, max(c + col_span) AS n_cols FROM t GROUP BY table_id),
f AS (SELECT table_id, r, row_number() OVER (PARTITION BY table_id ORDER BY r) - 1 AS i, count(*) AS n_cells, count(*) FILTER (text <> '') AS n_texts,
    count(*) FILTER ({label_sql("text")}) AS n_labels, count(*) FILTER (text <> '' AND {data_sql("text")}) AS n_data, sum(length(text)) AS n_chars, count(*) FILTER (length(text) > 20) AS n_long,
    max(col_span) AS widest, list(text ORDER BY c) AS texts FROM t GROUP BY table_id, r),
g AS (SELECT f.*, n_texts > 0 AND n_data >= greatest(1, n_texts // 2) AS data_like, n_cells = 2 AS pair,
    n_cells = 2 AND {label_sql("texts[1]")} AND length(texts[2]) > length(texts[1]) AS key_value,
    n_cells = 1 AND widest >= n_cols AND (length(texts[1]) > 15 OR contains(texts[1], ' ')) AS full_width FROM f JOIN size USING (table_id)),
tt AS (SELECT table_id, count(*) AS total, count(*) FILTER (pair) AS pairs, count(*) FILTER (key_value) AS kvs FROM g GROUP BY table_id),
k AS (SELECT table_id, total, total >= 2 AND pairs > 0 AND pairs >= 0.7 * total AND kvs >= 0.7 * pairs AS kv FROM tt),
cand AS (SELECT g.*, total, kv, unnest(range(1, least(3, total - 1) + 1)) AS n FROM g JOIN k USING (table_id) WHERE total > 1),
a AS (SELECT table_id, n, any_value(total) AS total, any_value(kv) AS kv, sum(n_texts) FILTER (i < n) AS texts, sum(n_labels) FILTER (i < n) AS labels, sum(n_chars) FILTER (i < n) AS chars,
    sum(n_long) FILTER (i < n) AS long_, bool_or(i < n AND full_width) AS full_width, bool_or(i = 0 AND data_like) AS first_data,
    bool_or(i = 0 AND widest > 1) AND coalesce(max(n_cells) FILTER (i = 1 AND i < n) > max(n_cells) FILTER (i = 0), false) AND NOT bool_or(i = 1 AND data_like) AS nat,
    count(*) FILTER (i >= n) AS n_below, count(*) FILTER (i >= n AND data_like) AS data_below, count(DISTINCT n_cells) FILTER (i >= n AND i < n + 5) AS shapes FROM cand GROUP BY table_id, n),
scores AS (SELECT table_id, n, total, nat AS natural_,
    CAST((CASE WHEN texts > 0 AND labels * 2 >= texts THEN 2 ELSE 0 END) + (CASE WHEN n_below > 0 AND data_below >= greatest(1, n_below // 2) THEN 2 ELSE 0 END)
    + (CASE WHEN texts > 0 AND chars <= 8 * texts AND labels > 0 THEN 1 ELSE 0 END) + (CASE WHEN nat THEN 1 ELSE 0 END) + (CASE WHEN n_below > 0 AND shapes <= 1 THEN 1 ELSE 0 END)
    - (CASE WHEN texts > 0 AND long_ * 10 > 3 * texts THEN 2 ELSE 0 END) - (CASE WHEN full_width THEN 3 ELSE 0 END) - (CASE WHEN total <= 2 THEN 2 ELSE 0 END) - (CASE WHEN kv THEN 3 ELSE 0 END)
    - (CASE WHEN first_data THEN 3 ELSE 0 END) - (CASE WHEN n_below <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS score FROM a),
acc AS (SELECT * FROM scores WHERE score >= CASE WHEN total = 2 THEN 5 ELSE 4 END),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY score DESC, n) AS k FROM acc) WHERE k = 1),
heads AS (SELECT s.table_id, CASE WHEN t.table_id IS NULL THEN 0 WHEN t.n > 1 AND NOT t.natural_ AND coalesce(t.score - o.score <= 1, false) THEN 1 ELSE t.n END AS n_header,
    CASE WHEN t.n > 1 AND NOT t.natural_ AND coalesce(t.score - o.score <= 1, false) THEN o.score ELSE coalesce(t.score, -99) END AS score
  FROM (SELECT DISTINCT table_id FROM scores) s LEFT JOIN top t USING (table_id) LEFT JOIN (SELECT * FROM acc WHERE n = 1) o ON o.table_id = s.table_id)"""


def header_row_scores(spark, sf_dir):
    return headers.header_row_scores(order_cells(spark, sf_dir)).select("table_id", "n", "score")


def header_rows(spark, sf_dir):
    return headers.found_rows(order_cells(spark, sf_dir)).select("table_id", "n_header", "score")


def header_col_scores(spark, sf_dir):
    return headers.found_column_facts(order_cells(spark, sf_dir)).where("n IS NOT NULL").select("table_id", "n", "score")


def numeric_table_verdict(spark, sf_dir):
    """The flagship: for each table, whether any column of its body is numeric and no running number."""
    cells = order_cells(spark, sf_dir)
    return headers.numeric_verdict(cells, headers.found_rows(cells))


def twin_cells(spark, sf_dir):
    """Order tables with two header texts alike and one blank, for names that need a fallback or a suffix."""
    cells = order_cells(spark, sf_dir)
    return cells.withColumn("text", F.when((F.col("r") == 0) & (F.col("c") == 3), "구분").when((F.col("r") == 0) & (F.col("c") == 4) & (F.col("table_id") % 3 == 0), " ").otherwise(F.col("text")))


def one_header(cells):
    return cells.groupBy("table_id").agg(F.lit(1).cast("long").alias("n_header"))


def column_names(spark, sf_dir):
    cells = twin_cells(spark, sf_dir)
    return headers.columns(cells, one_header(cells))


def structured_records(spark, sf_dir):
    cells = twin_cells(spark, sf_dir)
    heads = one_header(cells)
    return headers.records(cells, heads, headers.columns(cells, heads))


TWIN = f"""{CELLS},
twin AS (SELECT table_id, r, c, row_span, col_span, CASE WHEN r = 0 AND c = 3 THEN '구분' WHEN r = 0 AND c = 4 AND table_id % 3 = 0 THEN ' ' ELSE text END AS text FROM cells),
names AS (SELECT table_id, c, CASE WHEN trim(text) = '' THEN 'column_' || c ELSE trim(text) END AS name, CASE WHEN trim(text) = '' THEN 'medium' ELSE 'high' END AS confidence FROM twin WHERE r = 0),
cols AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN name ELSE name || '__' || row_number() OVER w END AS key FROM names WINDOW w AS (PARTITION BY table_id, name ORDER BY c))"""

QUERIES = {
    "numeric_table_verdict": numeric_table_verdict,
    "value_class_counts": value_classes,
    "grid_slots": grid_slots,
    "grid_issues": grid_issues,
    "merge_cover": merge_cover,
    "gridness": gridness,
    "table_structure_stats": structure,
    "table_text_rollup": rollup,
    "table_markdown": markdown,
    "header_row_scores": header_row_scores,
    "header_rows": header_rows,
    "header_col_scores": header_col_scores,
    "column_names": column_names,
    "structured_records": structured_records,
}
ORACLES = {
    "numeric_table_verdict": f"""{SCORES},
body AS (SELECT t.table_id, t.c, t.r, {strip_sql("t.text")} AS v FROM t JOIN g USING (table_id, r) JOIN heads h USING (table_id) WHERE h.n_header > 0 AND g.i >= h.n_header AND NOT regexp_matches({strip_sql("t.text")}, '{T.NEUTRAL}')),
per AS (SELECT table_id, c, bool_and({numeric_sql("v")}) AS num, list(v ORDER BY r) AS vs FROM body GROUP BY table_id, c),
ser AS (SELECT *, len(vs) >= 2 AND coalesce(vs[1] IN ('0', '1'), false) AND vs = list_transform(range(len(vs)), lambda x: CAST(x + TRY_CAST(replace(vs[1], ',', '') AS BIGINT) AS VARCHAR)) AS serial FROM per),
v AS (SELECT table_id, bool_or(num AND NOT serial) AS num FROM ser GROUP BY table_id)
SELECT h.table_id, CASE WHEN n_header = 0 THEN 'undecidable' WHEN num THEN 'numeric' ELSE 'not_numeric' END AS verdict FROM heads h LEFT JOIN v USING (table_id)""",
    "value_class_counts": f"""{CELLS}, t AS (SELECT c, trim(regexp_replace(text, '{S}+', ' ', 'g')) AS text FROM cells)
SELECT c, count(*) AS n, count(*) FILTER ({numeric_sql("text")}) AS n_numeric, count(*) FILTER (regexp_matches(text, '{T.NEUTRAL}')) AS n_neutral, count(*) FILTER ({numeric_like_sql("text")}) AS n_numeric_like,
  count(*) FILTER ({data_sql("text")}) AS n_data, count(*) FILTER ({value_sql("text")}) AS n_value, count(*) FILTER ({label_sql("text")}) AS n_label, count(*) FILTER ({column_label_sql("text")}) AS n_column_label FROM t GROUP BY c""",
    "grid_slots": f"{ODD} SELECT table_id, kind, count(*) AS n, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars FROM slots GROUP BY table_id, kind",
    "grid_issues": f"""{ODD}
SELECT table_id, code, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT table_id, 'out_of_bounds' AS code, 1 AS n FROM placed JOIN declared USING (table_id) WHERE pr >= n_rows OR pc >= n_cols
  UNION ALL SELECT table_id, 'overlap', count(*) - 1 FROM placed JOIN declared USING (table_id) WHERE pr < n_rows AND pc < n_cols GROUP BY table_id, pr, pc HAVING count(*) > 1
  UNION ALL SELECT table_id, 'missing_grid_cell', 1 FROM slots WHERE kind = 'empty') GROUP BY table_id, code""",
    "merge_cover": f"{CELLS} SELECT table_id, pr AS r, c, trim(text) AS text FROM (SELECT *, unnest(range(r, r + row_span)) AS pr FROM cells) WHERE pr <> r",
    "gridness": f"""{CELLS},
b AS (SELECT table_id, r, c, CASE WHEN (table_id % 6 = 1 AND r > 0) OR (table_id % 6 = 2 AND c > 0) OR table_id % 6 = 3 THEN '' ELSE trim(text) END AS text FROM cells),
x AS (SELECT table_id, r, count(DISTINCT c) FILTER (text <> '') AS n FROM b GROUP BY table_id, r),
y AS (SELECT table_id, count(DISTINCT c) FILTER (text <> '') AS n_cols FROM b GROUP BY table_id),
z AS (SELECT table_id, count(*) FILTER (n > 0) AS n_rows, count(*) FILTER (n > 1) AS n_wide FROM x GROUP BY table_id)
SELECT table_id, CASE WHEN n_rows = 0 THEN 'empty' WHEN n_rows < 2 OR n_cols < 2 OR n_wide < 2 THEN 'degenerate' ELSE 'grid' END AS gridness FROM z JOIN y USING (table_id)""",
    "table_structure_stats": f"""{CELLS}
SELECT table_id, count(*) AS n_cells, count(*) FILTER (trim(text) = '') AS n_empty, count(*) FILTER (row_span > 1) AS n_row_span, count(*) FILTER (col_span > 1) AS n_col_span,
  count(*) FILTER (row_span > 1 OR col_span > 1) AS n_merged, CAST(max(row_span) AS BIGINT) AS max_row_span, CAST(max(col_span) AS BIGINT) AS max_col_span, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM cells GROUP BY table_id""",
    "table_text_rollup": f"{CELLS} SELECT table_id, string_agg(trim(text), ' ' ORDER BY r, c) AS text FROM cells WHERE trim(text) <> '' GROUP BY table_id",
    "table_markdown": f"""{CELLS},
dense AS (SELECT table_id, pr, c, trim(text) AS text FROM (SELECT *, unnest(range(r, r + row_span)) AS pr FROM cells)),
lines AS (SELECT table_id, pr, '| ' || string_agg(replace(text, '|', '\\|'), ' | ' ORDER BY c) || ' |' || CASE WHEN pr = 0 THEN chr(10) || '|' || repeat(' --- |', 5) ELSE '' END AS line FROM dense GROUP BY table_id, pr)
SELECT table_id, string_agg(line, chr(10) ORDER BY pr) AS markdown FROM lines GROUP BY table_id""",
    "header_row_scores": f"{SCORES} SELECT table_id, n, score FROM scores",
    "header_rows": f"{SCORES} SELECT table_id, CAST(n_header AS BIGINT) AS n_header, CAST(score AS BIGINT) AS score FROM heads",
    "column_names": f"{TWIN} SELECT table_id, c, name, key, confidence, false AS is_row_header FROM cols",
    "structured_records": f"""{TWIN},
dense AS (SELECT table_id, pr AS r, c, trim(text) AS value, pr <> r AND trim(text) <> '' AS inherited FROM (SELECT *, unnest(range(r, r + row_span)) AS pr FROM twin) WHERE pr > 0)
SELECT d.table_id, CAST(dense_rank() OVER (PARTITION BY d.table_id ORDER BY d.r) - 1 AS BIGINT) AS record, d.r, k.key, d.value, d.inherited FROM dense d JOIN cols k ON k.table_id = d.table_id AND k.c = d.c""",
    "header_col_scores": rf"""{SCORES},
hc AS (SELECT t.*, g.i, h.n_header, unnest(range(1, least(2, size.n_cols - 1) + 1)) AS n FROM t JOIN g USING (table_id, r) JOIN heads h USING (table_id) JOIN size USING (table_id) WHERE size.n_cols > 1),
hk AS (SELECT *, i < n_header AS head, c < n AS lft, text <> '' AS ful, {column_label_sql("text")} AS lab, {value_sql("text")} AS val, c <= 0 AND c + col_span > 0 AS zero FROM hc),
pr AS (SELECT table_id, n, i, any_value(head) AS head, count(*) FILTER (lft) >= 2 AS two, coalesce(bool_and(lab OR NOT ful) FILTER (lft AND c < 2), false) AS only_labels FROM hk GROUP BY table_id, n, i),
pa AS (SELECT table_id, n, count(*) FILTER (NOT head) AS n_data, count(*) FILTER (NOT head AND two AND only_labels) AS hier FROM pr GROUP BY table_id, n),
ca AS (SELECT table_id, n, count(*) FILTER (NOT head AND lft AND ful) AS lefts, count(*) FILTER (NOT head AND lft AND ful AND lab) AS left_labels, coalesce(sum(length(text)) FILTER (NOT head AND lft AND ful), 0) AS left_chars,
    count(DISTINCT text) FILTER (NOT head AND lft AND ful) AS different, count(*) FILTER (NOT head AND NOT lft AND ful) AS rights, count(*) FILTER (NOT head AND NOT lft AND ful AND val) AS right_values,
    count(*) FILTER (NOT head AND NOT lft AND length(text) > 20) AS right_long, coalesce(bool_or(NOT head AND lft AND row_span > 1), false) AS grouped,
    coalesce(bool_or(head AND lft AND len(list_filter({_words(DEFAULT.header_name)}, lambda k: contains(text, k))) > 0), false) AS descriptor,
    coalesce(list(text ORDER BY i) FILTER (zero AND NOT head), []) AS zeros, coalesce(string_agg(text, ' ' ORDER BY i) FILTER (zero AND head), '') AS zero_head FROM hk GROUP BY table_id, n),
cb AS (SELECT *, list_filter(zeros, lambda x: x <> '') AS fz FROM ca JOIN pa USING (table_id, n) JOIN k USING (table_id)),
cc AS (SELECT *, len(list_filter({_words(T.INDEX_HEADERS)}, lambda w: contains(zero_head, w))) > 0
      OR (len(zeros) >= 2 AND len(list_filter(zeros, lambda x: NOT regexp_full_match(x, '[0-9]+'))) = 0 AND zeros[1] IN ('0', '1') AND list_transform(zeros, lambda x: TRY_CAST(x AS BIGINT)) = range(TRY_CAST(zeros[1] AS BIGINT), TRY_CAST(zeros[1] AS BIGINT) + len(zeros))) AS is_index,
    len(list_filter({_words(T.CODE_HEADERS)}, lambda w: contains(zero_head, w))) > 0 OR (len(fz) > 0 AND len(list_filter(fz, lambda x: regexp_matches(x, '{T.CODE}'))) * 10 >= len(fz) * 6) AS is_code,
    len(list_filter({_words(T.DATE_HEADERS)}, lambda w: contains(zero_head, w))) > 0 OR (len(fz) > 0 AND len(list_filter(fz, lambda x: regexp_matches(x, '{T.DATE}'))) * 10 >= len(fz) * 6) AS is_date FROM cb)
SELECT table_id, n, CAST((CASE WHEN lefts > 0 AND left_labels * 10 >= 6 * lefts THEN 2 ELSE 0 END) + (CASE WHEN rights > 0 AND right_values * 10 >= 6 * rights THEN 2 ELSE 0 END) + (CASE WHEN descriptor THEN 1 ELSE 0 END)
  + (CASE WHEN lefts > 0 AND left_chars <= 8 * lefts THEN 1 ELSE 0 END) + (CASE WHEN lefts > 0 AND different * 10 >= 8 * lefts THEN 1 ELSE 0 END) + (CASE WHEN grouped THEN 1 ELSE 0 END)
  + (CASE WHEN n = 2 AND n_data > 0 AND hier * 10 >= 6 * n_data AND right_values * 2 >= rights AND rights > 0 THEN 1 ELSE 0 END) - (CASE WHEN is_index THEN 4 ELSE 0 END) - (CASE WHEN is_code THEN 3 ELSE 0 END) - (CASE WHEN is_date THEN 2 ELSE 0 END)
  - (CASE WHEN kv THEN 3 ELSE 0 END) - (CASE WHEN rights > 0 AND right_long * 2 > rights AND right_values * 10 < 3 * rights THEN 2 ELSE 0 END) - (CASE WHEN n_data <= 1 THEN 2 ELSE 0 END) AS BIGINT) AS score FROM cc""",
}
