"""Queries of folds, nesting, styles, renderings and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import text as T
from lamina.operators import checks, folds, nested, render, styles
from lamina.plans.block_queries import DEEP, deep
from lamina.plans.text_queries import LINES, NUMBERED
from lamina.sources.adapters import PREFIXES, marked_lines, quoted, read

S = r"[\s\p{Z}]"


def renamed(ctes: str) -> str:
    """The CTEs n, m, s and k under doubled names."""
    for name in "nmsk":
        ctes = ctes.replace(f"\n{name} AS (", f"\n{2 * name} AS (").replace(f"FROM {name})", f"FROM {2 * name})")
    return ctes


def marked_deep(spark, sf_dir):
    """Blocks with depths, their texts behind the prefixes, some tables as title boxes."""
    blocks = deep(spark, sf_dir)
    key = F.col("doc_id") * 7 + F.col("ord")
    prefix = F.element_at(F.array(*[F.lit(p) for p in PREFIXES]), (key % len(PREFIXES) + 1).cast("int"))
    return blocks.withColumns({"text": F.concat(prefix, "text"), "title_box": (F.col("block_type") == "table") & (key % 2 == 1), "anchored": F.lit(False), "margin_left": key % 3 * 60})


def corrected(*passes):
    def query(spark, sf_dir):
        return folds.correct_depths(marked_deep(spark, sf_dir), passes)

    return query


def toc_match(spark, sf_dir):
    """Every fifth line of each document as a contents entry, met with the lines of the same document."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    blocks = lines.select("doc_id", F.col("ord").cast("long").alias("ord"), T.title_key(F.col("line")).alias("title_key"))
    heads = blocks.where("ord % 5 = 1").select("doc_id", F.col("ord").alias("entry"), "title_key")
    return folds.match_entries(heads, blocks)


def geography(spark, sf_dir):
    """Tables of regions, in their cells tables of nations, in theirs tables of suppliers."""
    region, nation, supplier = (read(spark, sf_dir, n) for n in ("region", "nation", "supplier"))
    table = lambda prefix, key: F.concat(F.lit(prefix), F.col(key).cast("string"))
    tables = region.select(table("R", "r_regionkey").alias("table_id"), F.lit(None).cast("string").alias("parent_id")).unionByName(nation.select(table("N", "n_nationkey").alias("table_id"), table("R", "n_regionkey").alias("parent_id")))
    own = nation.select(table("R", "n_regionkey").alias("table_id"), F.col("n_nationkey").cast("long").alias("r"), F.lit(0).cast("long").alias("c"), F.col("n_name").alias("text"), table("N", "n_nationkey").alias("child_id"))
    cell = lambda c, text: supplier.select(table("N", "s_nationkey").alias("table_id"), F.col("s_suppkey").alias("r"), F.lit(c).cast("long").alias("c"), text.alias("text"), F.lit(None).cast("string").alias("child_id"))
    return tables, own.unionByName(cell(0, F.col("s_name"))).unionByName(cell(1, F.when(F.col("s_acctbal") < 0, " ").otherwise(F.col("s_acctbal").cast("bigint").cast("string"))))


GEO = """WITH tables AS (SELECT 'R' || r_regionkey AS table_id, NULL AS parent_id, 'R' || r_regionkey AS root_id, 0 AS base FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 'R' || n_regionkey, 3 FROM nation),
cells AS (SELECT 'R' || n_regionkey AS table_id, CAST(n_nationkey AS BIGINT) AS r, 0 AS c, n_name AS text, 'N' || n_nationkey AS child_id FROM nation
  UNION ALL SELECT 'N' || s_nationkey, s_suppkey, 0, s_name, NULL FROM supplier
  UNION ALL SELECT 'N' || s_nationkey, s_suppkey, 1, CASE WHEN s_acctbal < 0 THEN ' ' ELSE CAST(CAST(trunc(s_acctbal) AS BIGINT) AS VARCHAR) END, NULL FROM supplier),
rows AS (SELECT DISTINCT table_id, r, -1 AS c, 0 AS step, 'row_group' AS kind, '' AS text FROM cells
  UNION ALL SELECT table_id, r, c, 1, 'cell_group', '' FROM cells
  UNION ALL SELECT table_id, r, c, 2, 'cell_text', text FROM cells WHERE trim(text) <> ''
  UNION ALL SELECT table_id, r, c, 3, 'nested_table_ref', child_id FROM cells WHERE child_id IS NOT NULL),
flat AS (SELECT root_id, rows.table_id, kind, r, CAST(c AS BIGINT) AS c, CAST(base + CASE step WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS BIGINT) AS local_depth,
  row_number() OVER (PARTITION BY rows.table_id ORDER BY r, c, step) - 1 AS local_order, text FROM rows JOIN tables USING (table_id))"""


def nested_flatten(spark, sf_dir):
    return nested.flatten(*geography(spark, sf_dir))


def nested_counts(spark, sf_dir):
    return nested.counts(nested_flatten(spark, sf_dir))


def style_tables(spark, sf_dir):
    """Parts as paragraphs with styles by brand, properties by type and size."""
    part = read(spark, sf_dir, "part")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("OUTLINE", "NUMBER", "BULLET", "NONE")]), (F.col("p_size") % 4 + 1).cast("int"))
    paragraphs = part.select("p_partkey", F.col("p_brand").alias("style_id"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("q"), (F.col("p_size") % 10).cast("string"))).alias("para_pr"))
    brands = part.groupBy(F.col("p_brand").alias("style_id")).agg(F.concat(F.lit("q"), (F.min("p_size") % 10).cast("string")).alias("para_pr"))
    props = part.select((F.col("p_size") % 10).alias("k"), kind.alias("kind")).groupBy("k").agg(F.min("kind").alias("heading_type"))
    props = props.select(F.concat(F.lit("q"), F.col("k").cast("string")).alias("para_pr"), "heading_type", (F.col("k") % 3).cast("long").alias("level"), (F.col("k") % 4).cast("long").alias("id_ref"))
    return paragraphs, brands, props


STYLES = """WITH para AS (SELECT p_partkey, p_brand AS style_id, CASE WHEN p_partkey % 3 = 0 THEN 'q' || (p_size % 10) END AS para_pr FROM part),
brands AS (SELECT p_brand AS style_id, 'q' || (min(p_size) % 10) AS style_para FROM part GROUP BY p_brand),
props AS (SELECT 'q' || k AS resolved, heading_type, k % 3 AS level, k % 4 AS id_ref FROM (SELECT p_size % 10 AS k, min(['OUTLINE', 'NUMBER', 'BULLET', 'NONE'][p_size % 4 + 1]) AS heading_type FROM part GROUP BY p_size % 10)),
styled AS (SELECT p_partkey, resolved, heading_type, level, id_ref FROM (SELECT p_partkey, coalesce(para_pr, style_para) AS resolved FROM para LEFT JOIN brands USING (style_id)) LEFT JOIN props USING (resolved))"""


def style_resolution(spark, sf_dir):
    found = styles.paragraph_styles(*style_tables(spark, sf_dir))
    return found.select("p_partkey", "resolved", "heading_type", F.coalesce("native_level", F.lit(-1)).alias("native_level"), F.coalesce("numbering_level", F.lit(-1)).alias("numbering_level"))


def auto_label(spark, sf_dir):
    styled = styles.paragraph_styles(*style_tables(spark, sf_dir))
    bullets = spark.createDataFrame([(0, "•"), (1, "-"), (2, "※")], "id long, char string")
    numberings = spark.createDataFrame([(i, level, f"^{i}.{level}") for i in range(3) for level in range(3)], "id long, level long, format string")
    return styles.auto_labels(styled, bullets, numberings).select("p_partkey", "auto_label")


def char_styles(spark, sf_dir):
    """Turns as runs of a conversation's paragraph, character styles by role and turn."""
    runs = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.floor(F.col("turn") / 3).alias("paragraph"), F.concat("role", (F.col("turn") % 2).cast("string")).alias("char_pr"), F.coalesce("text", F.lit("")).alias("text"))
    chars = spark.createDataFrame([("user0", 1000, False), ("user1", 1200, True), ("assistant0", 1400, False), ("assistant1", 900, True)], "char_pr string, height long, bold boolean")
    found = styles.char_styles(runs, chars)
    return found.select("doc_id", "paragraph", *[F.round(F.coalesce(c, F.lit(-1.0)), 6).alias(c) for c in ("max_size", "mean_size", "bold_ratio")])


def inner_rows(spark, sf_dir):
    """Two inner texts for each table block."""
    tables = deep(spark, sf_dir).where("block_type = 'table'")
    listed = F.array(F.struct(F.lit(1).alias("step"), F.lit("cell_text").alias("kind"), F.lit(3).alias("local_depth"), F.concat(F.lit("cell of "), F.col("ord").cast("string")).alias("text")), F.struct(F.lit(2).alias("step"), F.lit("object_ref").alias("kind"), F.lit(3).alias("local_depth"), F.lit("no line").alias("text")))
    return tables.select("doc_id", "ord", F.explode(listed).alias("x")).select("doc_id", "ord", F.col("x.step").cast("long").alias("step"), "x.kind", F.col("x.local_depth").cast("long").alias("local_depth"), "x.text")


def llm_context(spark, sf_dir):
    blocks = deep(spark, sf_dir)
    return render.context(render.context_lines(blocks, inner_rows(spark, sf_dir)), blocks.select("doc_id", "ord", "section"))


def preview(spark, sf_dir):
    return render.preview(deep(spark, sf_dir))


def text_coverage(spark, sf_dir):
    return checks.text_coverage(deep(spark, sf_dir).select("doc_id", "text"), llm_context(spark, sf_dir))


def toc_entry_levels(spark, sf_dir):
    found = marked_lines(spark, sf_dir).select("doc_id", F.col("pos").alias("ord"), T.split_numbering(F.col("text")).alias("s")).select("doc_id", "ord", "s.numbering")
    return render.entry_levels(found).select("doc_id", "ord", "level")


def orphan_check(spark, sf_dir):
    """Orders whose customer key, moved on for some, has no customer."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey")).alias("c_custkey"))
    return checks.orphans(orders, read(spark, sf_dir, "customer"), ["c_custkey"])


def id_integrity(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.when(F.col("event_id") % 97 == 0, None).when(F.col("event_id") % 89 == 0, F.col("event_id") - 1).otherwise(F.col("event_id")).alias("id"), "event_type")
    return checks.id_integrity(rows, "id", "event_type", ("click", "view", "purchase"))


def parent_refs(spark, sf_dir):
    flat = nested_flatten(spark, sf_dir)
    key = lambda kind: F.concat_ws(":", "table_id", "r", F.lit(kind))
    rows = flat.where("kind IN ('row_group', 'cell_text')").select(F.concat_ws(":", "table_id", "r", "kind", "c").alias("id"), "kind", F.when(F.col("kind") == "cell_text", F.when(F.col("r") % 10 == 0, key("none")).otherwise(F.concat_ws(":", "table_id", "r", F.lit("row_group"), F.lit("-1")))).alias("parent_id"))
    return checks.parent_refs(rows, {"cell_text": "cell_group"})


def count_parity(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return checks.count_parity(lines, read(spark, sf_dir, "lineitem").where("l_suppkey % 31 <> 0").select(F.col("l_orderkey").alias("k")), "k")


def baseline_diff(spark, sf_dir):
    """Blocks before and after an edit: some dropped, some changed, some moved behind the end."""
    lines = marked_lines(spark, sf_dir).select("doc_id", F.col("pos").alias("ord"), "text", (F.col("pos") % 3).alias("meta"))
    key = F.col("doc_id") + F.col("ord")
    after = lines.where(key % 11 != 0).select("doc_id", F.when(key % 13 == 0, F.col("ord") + 100_000).otherwise(F.col("ord")).alias("ord"), F.when(key % 17 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"), F.when(key % 19 == 0, 9).otherwise(F.col("meta")).alias("meta"))
    return checks.baseline_diff(lines, after)


def depth_anomalies(spark, sf_dir):
    return checks.depth_anomalies(deep(spark, sf_dir))


def numbering_agreement(spark, sf_dir):
    return checks.numbering_agreement(marked_deep(spark, sf_dir))


def path_inventory(spark, sf_dir):
    return checks.path_inventory(read(spark, sf_dir, "events"), "props")


def mapping_grade(spark, sf_dir):
    return checks.mapping_grade(read(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


QUERIES = {
    "title_scope_depth": corrected("scope_titles", "reanchor"),
    "ordinal_align": corrected("align_ordinals"),
    "marker_nesting": corrected("nest_markers"),
    "corrected_depths": corrected("scope_titles", "reanchor", "align_ordinals", "nest_markers"),
    "toc_match": toc_match,
    "toc_entry_levels": toc_entry_levels,
    "nested_flatten": nested_flatten,
    "nested_counts": nested_counts,
    "style_resolution": style_resolution,
    "auto_label": auto_label,
    "char_styles": char_styles,
    "llm_context": llm_context,
    "text_preview": preview,
    "text_coverage": text_coverage,
    "orphan_check": orphan_check,
    "id_integrity": id_integrity,
    "parent_refs": parent_refs,
    "count_parity": count_parity,
    "baseline_diff": baseline_diff,
    "depth_anomalies": depth_anomalies,
    "numbering_agreement": numbering_agreement,
    "path_inventory": path_inventory,
    "mapping_grade": mapping_grade,
}
COLLAPSED = f"trim(regexp_replace(text, '{S}+', ' ', 'g'))"
CONTEXT = f"""{DEEP},
c0 AS (SELECT doc_id, ord, 0 AS step, section, repeat('  ', CAST(depth AS INT)) || CASE band WHEN 'peripheral' THEN '[P] ' WHEN 'annotation' THEN '[A] ' ELSE '' END
    || CASE WHEN {COLLAPSED} <> '' THEN {COLLAPSED} WHEN block_type = 'table' THEN '[table]' WHEN block_type = 'image' THEN '[image]' END AS line FROM deep),
c1 AS (SELECT * FROM c0 WHERE line IS NOT NULL UNION ALL SELECT doc_id, ord, 1, section, repeat('  ', CAST(depth + 3 AS INT)) || '(cell) cell of ' || ord FROM deep WHERE block_type = 'table'),
c2 AS (SELECT *, lag(section) OVER (PARTITION BY doc_id ORDER BY ord, step) IS DISTINCT FROM section AS new FROM c1),
ctx AS (SELECT doc_id, string_agg(CASE WHEN new THEN '== section ' || section || ' ==' || chr(10) ELSE '' END || line, chr(10) ORDER BY ord, step) AS text FROM c2 GROUP BY doc_id)"""
ORACLES = {
    "toc_entry_levels": rf"""{LINES}, {NUMBERED},
a AS (SELECT doc_id, pos AS ord, CASE WHEN numbering IS NOT NULL AND len(list_filter(string_split(replace(numbering, '-', '.'), '.'), lambda x: x <> '')) > 0
    AND len(list_filter(list_filter(string_split(replace(numbering, '-', '.'), '.'), lambda x: x <> ''), lambda x: NOT regexp_full_match(x, '[{T.DIGITS}]+'))) = 0
    THEN len(list_filter(string_split(replace(numbering, '-', '.'), '.'), lambda x: x <> '')) - 1 END AS own FROM k)
SELECT doc_id, ord, CAST(coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS level FROM a""",
    "nested_flatten": f"{GEO} SELECT root_id, table_id, kind, r, c, local_depth, local_order, text FROM flat",
    "nested_counts": f"""{GEO} SELECT root_id, count(DISTINCT table_id) AS n_tables, max(local_depth) AS deepest, count(*) FILTER (kind = 'row_group') AS n_row_group, count(*) FILTER (kind = 'cell_group') AS n_cell_group,
  count(*) FILTER (kind = 'cell_text') AS n_cell_text, count(*) FILTER (kind = 'nested_table_ref') AS n_nested_table_ref FROM flat GROUP BY root_id""",
    "style_resolution": f"{STYLES} SELECT p_partkey, resolved, heading_type, CAST(CASE WHEN heading_type = 'OUTLINE' THEN level ELSE -1 END AS BIGINT) AS native_level, CAST(CASE WHEN heading_type IN ('NUMBER', 'BULLET') THEN level ELSE -1 END AS BIGINT) AS numbering_level FROM styled",
    "auto_label": f"""{STYLES} SELECT p_partkey, CASE WHEN heading_type = 'BULLET' THEN CASE id_ref WHEN 0 THEN '•' WHEN 1 THEN '-' WHEN 2 THEN '※' END
  WHEN heading_type IN ('OUTLINE', 'NUMBER') AND id_ref < 3 THEN '^' || id_ref || '.' || level END AS auto_label FROM styled""",
    "char_styles": """WITH r AS (SELECT conv_id AS doc_id, turn // 3 AS paragraph, length(coalesce(text, '')) AS n, CASE role || (turn % 2) WHEN 'user0' THEN 10.0 WHEN 'user1' THEN 12.0 WHEN 'assistant0' THEN 14.0 WHEN 'assistant1' THEN 9.0 END AS size,
  CASE WHEN role IN ('user', 'assistant') THEN turn % 2 = 1 END AS bold FROM conversations)
SELECT doc_id, paragraph, CAST(coalesce(max(size), -1) AS DOUBLE) AS max_size, round(CAST(coalesce(sum(CAST(size AS DOUBLE) * n) / nullif(sum(n) FILTER (size IS NOT NULL), 0), -1) AS DOUBLE), 6) AS mean_size,
  round(CAST(coalesce(CAST(sum(n) FILTER (bold) AS DOUBLE) / nullif(sum(n), 0), 0) AS DOUBLE), 6) AS bold_ratio FROM r GROUP BY doc_id, paragraph""",
    "llm_context": f"{CONTEXT} SELECT doc_id, text FROM ctx",
    "text_preview": f"""{DEEP} SELECT doc_id, ord, '[' || depth || '] ' || repeat('  ', CAST(depth AS INT)) || block_type || ': ' || CASE WHEN length({COLLAPSED}) > 120 THEN substring({COLLAPSED}, 1, 120) || '…' ELSE {COLLAPSED} END AS line
FROM deep WHERE {COLLAPSED} <> '' AND band <> 'peripheral'""",
    "text_coverage": f"""{CONTEXT}, w AS (SELECT doc_id, regexp_replace(text, '{S}+', '', 'g') AS whole FROM ctx), nodes AS (SELECT doc_id, regexp_replace(text, '{S}+', '', 'g') AS node FROM deep)
SELECT doc_id, count(*) AS n_nodes, count(*) FILTER (NOT coalesce(contains(whole, node), false)) AS n_missing FROM nodes LEFT JOIN w USING (doc_id) WHERE node <> '' GROUP BY doc_id""",
    "orphan_check": "SELECT o_orderkey, c_custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS c_custkey FROM orders) WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)",
    "id_integrity": """WITH r AS (SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN event_id - 1 ELSE event_id END AS id, event_type FROM events)
SELECT 'missing_id' AS code, '' AS subject, count(*) AS n FROM r WHERE id IS NULL HAVING count(*) > 0
UNION ALL SELECT 'duplicate_id', CAST(id AS VARCHAR), 1 FROM r WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'unknown_kind', event_type, count(*) FROM r WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY event_type""",
    "parent_refs": f"{GEO} SELECT table_id || ':' || r || ':cell_text:' || c AS id, kind, CASE WHEN r % 10 = 0 THEN 'no_parent' ELSE 'wrong_kind' END AS problem FROM flat WHERE kind = 'cell_text'",
    "count_parity": "SELECT l_orderkey AS k, count(*) AS expected, count(*) FILTER (l_suppkey % 31 <> 0) AS found FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_suppkey % 31 = 0) > 0",
    "baseline_diff": f"""{LINES}, a AS (SELECT doc_id, pos AS ord, text, pos % 3 AS meta, doc_id + pos AS key FROM l),
b AS (SELECT doc_id, CASE WHEN key % 13 = 0 THEN ord + 100000 ELSE ord END AS ord, CASE WHEN key % 17 = 0 THEN text || '!' ELSE text END AS text, CASE WHEN key % 19 = 0 THEN 9 ELSE meta END AS meta FROM a WHERE key % 11 <> 0),
j AS (SELECT doc_id, ord, a.text AS at_, b.text AS bt, a.meta AS am, b.meta AS bm, a.ord IS NOT NULL AS in_a, b.ord IS NOT NULL AS in_b FROM (SELECT doc_id, ord, text, meta FROM a) a FULL JOIN b USING (doc_id, ord)),
k AS (SELECT *, in_a AND (NOT in_b OR at_ IS DISTINCT FROM bt) AS lost, EXISTS (SELECT 1 FROM b WHERE b.doc_id = j.doc_id AND b.text = j.at_ AND j.at_ <> '') AS there FROM j)
SELECT doc_id, ord, CASE WHEN NOT in_a THEN 'added' WHEN lost AND there THEN 'relocated' WHEN NOT in_b THEN 'removed' WHEN at_ IS DISTINCT FROM bt THEN 'text_changed' ELSE 'meta_changed' END AS change
FROM k WHERE NOT in_a OR NOT in_b OR at_ IS DISTINCT FROM bt OR am IS DISTINCT FROM bm""",
    "depth_anomalies": f"""{DEEP},
heads AS (SELECT *, lag(depth) OVER w AS ld, lag(font_size) OVER w AS ls FROM deep WHERE is_h WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
hh AS (SELECT doc_id, count(*) AS n_headings, count(*) FILTER (depth > ld + 1) AS jumps, count(*) FILTER (depth > ld AND font_size > ls) AS size_reversals FROM heads GROUP BY doc_id),
bb AS (SELECT doc_id, count(*) FILTER (depth > d AND indent < i) AS indent_reversals FROM (SELECT doc_id, depth, indent, lag(depth) OVER w AS d, lag(indent) OVER w AS i FROM deep WHERE band = 'body' WINDOW w AS (PARTITION BY doc_id ORDER BY ord)) GROUP BY doc_id),
ss AS (SELECT doc_id, count(*) FILTER (k > 1) AS scattered FROM (SELECT doc_id, cluster_id, count(DISTINCT depth) AS k FROM heads WHERE cluster_id IS NOT NULL GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, coalesce(n_headings, 0) AS n_headings, coalesce(jumps, 0) AS jumps, coalesce(size_reversals, 0) AS size_reversals, indent_reversals, coalesce(scattered, 0) AS scattered FROM bb LEFT JOIN hh USING (doc_id) LEFT JOIN ss USING (doc_id)""",
    "path_inventory": """SELECT path, count(*) AS n, count(*) FILTER (coalesce(v, '') = '') AS n_empty, count(DISTINCT v) AS n_distinct, CAST(max(length(v)) AS BIGINT) AS longest
FROM (SELECT path, json_extract_string(props, '$."' || path || '"') AS v FROM (SELECT props, unnest(json_keys(props)) AS path FROM events)) GROUP BY path""",
    "mapping_grade": """WITH p AS (SELECT DISTINCT l_returnflag AS a, l_linestatus AS b FROM lineitem)
SELECT count(DISTINCT a) AS n_source, count(DISTINCT a) = count(*) AS is_function, count(DISTINCT b) AS n_target, count(DISTINCT b) = count(*) AS is_injective FROM p""",
    "numbering_agreement": rf"""{DEEP},
l AS (SELECT doc_id, ord AS pos, depth, {quoted(PREFIXES)}[(doc_id * 7 + ord) % {len(PREFIXES)} + 1] || text AS text FROM deep), {renamed(NUMBERED)},
q AS (SELECT kk.doc_id, kk.pos, l.depth, w[1] AS m, w, CASE WHEN numbering IS NOT NULL THEN list_filter(string_split(replace(numbering, '-', '.'), '.'), lambda x: x <> '') END AS parts
  FROM kk JOIN l USING (doc_id, pos) JOIN (SELECT doc_id, pos, w FROM nn) USING (doc_id, pos)),
u AS (SELECT *, len(parts) > 0 AND len(list_filter(parts, lambda x: NOT regexp_full_match(x, '[{T.DIGITS}]+'))) = 0 AS num FROM q),
v AS (SELECT doc_id, pos, depth, CASE WHEN num THEN 'number' ELSE 'marker' END AS system, CASE WHEN num THEN len(parts) ELSE CASE m {" ".join(f"WHEN '{m}' THEN {level}" for m, level in T.MARKER_LEVELS)} ELSE CASE WHEN regexp_matches(w, '^[가-힣]\.\s') THEN 2 END END END AS level FROM u),
x AS (SELECT *, lag(system) OVER o AS ls, lag(level) OVER o AS ll, lag(depth) OVER o AS ld FROM v WHERE level IS NOT NULL WINDOW o AS (PARTITION BY doc_id ORDER BY pos))
SELECT system, count(*) FILTER (sign(level - ll) = sign(depth - ld)) AS agree, count(*) FILTER (sign(level - ll) <> sign(depth - ld)) AS differ FROM x WHERE ls = system GROUP BY system""",
}
