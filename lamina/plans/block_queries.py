"""Queries of the block rules over line blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.operators import blocks as B
from lamina.sources.adapters import LINE_BLOCKS_SQL, line_blocks

S = r"[\s\p{Z}]"
CAPTION, NOTE, SOURCE, IGNORE = r"^(The|Th)", r"^(An|In)", r"^(Of|Es|En)", r"^$"


def roles(spark, sf_dir):
    blocks = line_blocks(spark, sf_dir)
    return B.with_roles(blocks, B.style_clusters(blocks))


def deep(spark, sf_dir):
    return B.first_pass_depth(roles(spark, sf_dir))


def style_clusters(spark, sf_dir):
    found = B.style_clusters(line_blocks(spark, sf_dir))
    return found.select("doc_id", "cluster_id", "style_id", "para_id", "size", "bold", "n", "chars", F.round("score", 4).alias("score"), "role", "style_rank", "depth_rank")


def block_roles(spark, sf_dir):
    return roles(spark, sf_dir).select("doc_id", "ord", "role", F.round("confidence", 4).alias("confidence"), "band")


def first_pass(spark, sf_dir):
    return deep(spark, sf_dir).select("doc_id", "ord", "depth", "jump")


def candidates(spark, sf_dir):
    return B.depth_candidates(deep(spark, sf_dir)).select("doc_id", "ord", "depth", F.round("score", 2).alias("score"), "kind", "selected")


def constraints(spark, sf_dir):
    return B.adopt_relaxed(deep(spark, sf_dir)).select("doc_id", "ord", "depth", "adopted")


def cluster_depths(spark, sf_dir):
    return B.cluster_depths(deep(spark, sf_dir)).select("doc_id", "cluster_id", "members", "depth", F.round("share", 4).alias("share"), "preferred")


def paths(spark, sf_dir):
    return B.heading_paths(deep(spark, sf_dir)).select("doc_id", "ord", F.array_join("path", " > ").alias("path"))


def anchors(spark, sf_dir):
    found = deep(spark, sf_dir).withColumn("anchored", (F.col("ord") % 9 == 4) & (F.col("band") == "body"))
    return B.propagate_anchors(found).select("doc_id", "ord", F.col("new_depth").alias("depth"))


def visibility_counts(spark, sf_dir):
    return B.visibility(roles(spark, sf_dir)).groupBy("shown", "hidden_reason").agg(F.count("*").alias("n"))


def role_distribution(spark, sf_dir):
    return roles(spark, sf_dir).groupBy("role", "band", "block_type").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


def floating(spark, sf_dir):
    blocks = line_blocks(spark, sf_dir).withColumn("paragraph_index", F.col("ord") % 4)
    return B.floating_anchors(blocks.where("block_type IN ('image', 'shape')"), blocks.where("block_type = 'paragraph'"))


def neighbours(spark, sf_dir):
    blocks = line_blocks(spark, sf_dir).select("doc_id", "ord", "section", "block_type", "text")
    return B.neighbour_texts(blocks.where("block_type = 'paragraph'"), blocks.where("block_type = 'table'"), CAPTION, NOTE, SOURCE, IGNORE)


CLUSTERS = rf"""WITH b AS ({LINE_BLOCKS_SQL}),
s AS (SELECT *, round_even(font_size * 2, 0) / 2 AS size, bold_ratio >= 0.5 AS bold, length(regexp_replace(text, '^{S}+|{S}+$', '', 'g')) AS chars FROM b),
m AS (SELECT *, {{'a': style_id, 'b': para_id, 'c': size, 'd': bold}} AS k FROM s WHERE (block_type = 'paragraph' AND chars > 0) OR block_type IN ('table', 'image', 'shape', 'shape_group')),
f AS (SELECT *, lead(block_type) OVER w AS next_type, lead(k) OVER w AS next_k FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
c AS (SELECT doc_id, style_id, para_id, size, bold, count(*) AS n, sum(chars) AS chars, min(ord) AS first_ord, arg_min(alignment, ord) AS alignment, avg(indent) AS indent,
    count(next_type) AS followed, count(*) FILTER (next_type IS NOT NULL AND (next_type <> 'paragraph' OR next_k <> k)) AS other FROM f WHERE block_type = 'paragraph' GROUP BY ALL),
d AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, first_ord) = 1 AS is_body, sum(n) OVER (PARTITION BY doc_id) AS total FROM c),
e AS (SELECT *, max(size) FILTER (is_body) OVER p AS bsize, max(alignment) FILTER (is_body) OVER p AS balign, max(indent) FILTER (is_body) OVER p AS bindent FROM d WINDOW p AS (PARTITION BY doc_id)),
g AS (SELECT *, CASE WHEN NOT is_body THEN (CASE WHEN size > bsize + 0.1 THEN least(2.0, 1 + (size - bsize) / 4) ELSE 0 END) + (CASE WHEN bold THEN 1.0 ELSE 0 END)
    + (CASE WHEN chars / n <= 40 THEN 1.0 WHEN chars / n <= 80 THEN 0.5 ELSE 0 END) + (CASE WHEN n >= 2 AND n / total <= 0.3 THEN 0.5 ELSE 0 END)
    + (CASE WHEN followed > 0 AND other * 10 >= followed * 7 THEN 1.0 ELSE 0 END) + (CASE WHEN alignment IS DISTINCT FROM balign OR abs(indent - bindent) > 500 THEN 0.5 ELSE 0 END)
    - (CASE WHEN n / total > 0.3 THEN 2.0 ELSE 0 END) - (CASE WHEN chars / n > 100 THEN 2.0 ELSE 0 END) END AS score FROM e),
h AS (SELECT *, coalesce(score >= 3.0, false) AS is_heading FROM g),
r AS (SELECT *, CASE WHEN is_heading THEN row_number() OVER (PARTITION BY doc_id, is_heading ORDER BY size DESC, bold DESC, chars / n, first_ord) ELSE 0 END AS style_rank,
    'C' || lpad(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, n DESC, first_ord) AS VARCHAR), 2, '0') AS cluster_id FROM h),
band(doc_id, style_rank, size, bold, depth_rank) AS (
  SELECT doc_id, style_rank, size, bold, 1 FROM r WHERE style_rank = 1),
bands AS (WITH RECURSIVE w(doc_id, style_rank, bsize, bbold, depth_rank) AS (
    SELECT doc_id, style_rank, size, bold, 1 FROM r WHERE style_rank = 1
    UNION ALL SELECT r.doc_id, r.style_rank, CASE WHEN w.bsize - r.size > 0.9 OR w.bbold <> r.bold THEN r.size ELSE w.bsize END, CASE WHEN w.bsize - r.size > 0.9 OR w.bbold <> r.bold THEN r.bold ELSE w.bbold END,
      CASE WHEN w.bsize - r.size > 0.9 OR w.bbold <> r.bold THEN w.depth_rank + 1 ELSE w.depth_rank END FROM w JOIN r ON r.doc_id = w.doc_id AND r.style_rank = w.style_rank + 1 AND r.is_heading)
  SELECT doc_id, style_rank, depth_rank FROM w),
clusters AS (SELECT r.*, CASE WHEN is_body THEN 'body_baseline' WHEN is_heading THEN 'section_heading' ELSE 'body' END AS role,
    CASE WHEN is_body THEN 0.9 WHEN is_heading THEN round_even(least(0.9, 0.45 + 0.08 * score), 2) ELSE 0.7 END AS confidence, coalesce(bands.depth_rank, 0) AS depth_rank
  FROM r LEFT JOIN bands ON bands.doc_id = r.doc_id AND bands.style_rank = r.style_rank AND r.is_heading)""".replace(
    "band(doc_id, style_rank, size, bold, depth_rank) AS (\n  SELECT doc_id, style_rank, size, bold, 1 FROM r WHERE style_rank = 1),\n", ""
)
ROLES = rf"""{CLUSTERS},
j AS (SELECT s.*, k.cluster_id, k.role AS cluster_role, k.confidence AS cluster_confidence, k.depth_rank FROM s LEFT JOIN clusters k
  ON k.doc_id = s.doc_id AND k.style_id = s.style_id AND k.para_id = s.para_id AND k.size = s.size AND k.bold = s.bold),
roles AS (SELECT *, CASE block_type WHEN 'paragraph' THEN CASE WHEN chars = 0 THEN 'empty_paragraph' WHEN native_level IS NOT NULL THEN 'section_heading' WHEN numbering_level IS NOT NULL THEN 'list_item'
      WHEN cluster_role = 'section_heading' THEN 'section_heading' ELSE 'body_text' END
    WHEN 'header' THEN 'page_header' WHEN 'footnote' THEN 'footnote' WHEN 'caption' THEN 'caption' WHEN 'table' THEN 'table' WHEN 'image' THEN 'figure'
    WHEN 'shape' THEN CASE WHEN chars > 0 THEN 'figure' ELSE 'decorative_shape_candidate' END ELSE 'document_control' END AS role,
  CASE block_type WHEN 'paragraph' THEN CASE WHEN chars = 0 THEN 0.9 WHEN native_level IS NOT NULL THEN 0.9 WHEN numbering_level IS NOT NULL THEN 0.75
      WHEN cluster_role = 'section_heading' THEN cluster_confidence ELSE 0.8 END
    WHEN 'caption' THEN 0.85 WHEN 'table' THEN 0.95 WHEN 'shape' THEN 0.6 ELSE 0.9 END AS confidence,
  CASE WHEN block_type IN ('header', 'control') THEN 'peripheral' WHEN block_type IN ('caption', 'footnote') THEN 'annotation' ELSE 'body' END AS band FROM j)"""
DEEP = f"""{ROLES},
d1 AS (SELECT *, band = 'body' AND role = 'section_heading' AS is_h, CASE WHEN band = 'body' AND role = 'section_heading' THEN native_level + 1 END AS native FROM roles),
d2 AS (SELECT *, CASE WHEN is_h THEN coalesce(native, coalesce(max(native) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + greatest(coalesce(depth_rank, 1), 1)) END AS hd FROM d1),
d3 AS (SELECT *, coalesce(last_value(hd IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cur FROM d2),
d4 AS (SELECT *, CASE WHEN band = 'peripheral' THEN 0 WHEN is_h THEN hd WHEN band = 'body' THEN cur + 1 + CASE WHEN role = 'list_item' THEN greatest(numbering_level - 1, 0) ELSE 0 END END AS d FROM d3),
deep AS (SELECT *, CAST(coalesce(d, coalesce(last_value(CASE WHEN block_type IN ('table', 'image', 'shape') THEN d END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) + 1) AS BIGINT) AS depth,
    is_h AND cur > 0 AND coalesce(hd > cur + 1, false) AS jump FROM d4)"""
STATS = f"""{DEEP},
cd AS (SELECT doc_id, cluster_id, depth, count(*) AS n, min(ord) AS first_ord FROM deep WHERE is_h AND cluster_id IS NOT NULL GROUP BY ALL),
stats AS (SELECT doc_id, cluster_id, CAST(members AS BIGINT) AS members, depth, n / members AS share, n / members >= 0.8 AS preferred FROM (
  SELECT *, sum(n) OVER (PARTITION BY doc_id, cluster_id) AS members, row_number() OVER (PARTITION BY doc_id, cluster_id ORDER BY n DESC, first_ord) AS k FROM cd) WHERE k = 1)"""

QUERIES = {
    "style_clusters": style_clusters,
    "block_roles": block_roles,
    "first_pass_depth": first_pass,
    "depth_candidates": candidates,
    "depth_constraints": constraints,
    "cluster_depths": cluster_depths,
    "heading_path": paths,
    "anchor_propagation": anchors,
    "visibility_counts": visibility_counts,
    "role_distribution": role_distribution,
    "floating_anchor": floating,
    "neighbour_captions": neighbours,
}
ORACLES = {
    "style_clusters": f"{CLUSTERS} SELECT doc_id, cluster_id, style_id, para_id, size, bold, n, CAST(chars AS BIGINT) AS chars, round(CAST(coalesce(score, 0) AS DOUBLE), 4) AS score, role, CAST(style_rank AS BIGINT) AS style_rank, CAST(depth_rank AS BIGINT) AS depth_rank FROM clusters",
    "block_roles": f"{ROLES} SELECT doc_id, ord, role, round(CAST(confidence AS DOUBLE), 4) AS confidence, band FROM roles",
    "first_pass_depth": f"{DEEP} SELECT doc_id, ord, depth, jump FROM deep",
    "depth_candidates": f"""{DEEP},
x AS (SELECT *, CAST(CASE WHEN is_h THEN coalesce(cluster_confidence, confidence) ELSE confidence END AS DOUBLE) AS base FROM deep),
y AS (SELECT doc_id, ord, depth, depth AS own, base AS score, 'own' AS kind FROM x
  UNION ALL SELECT doc_id, ord, cur + 1, depth, greatest(0.3, base - 0.2), 'relaxed' FROM x WHERE is_h AND cur > 0 AND hd - cur >= 2
  UNION ALL SELECT doc_id, ord, cur + 1, depth, greatest(0.3, base - 0.2), 'stacked' FROM x WHERE NOT is_h AND band = 'body' AND cur + 1 <> depth)
SELECT doc_id, ord, CAST(depth AS BIGINT) AS depth, round(score, 2) AS score, kind, depth = own AS selected FROM y""",
    "depth_constraints": f"""{STATS},
n1 AS (SELECT d.*, s.members, CASE WHEN s.preferred THEN s.depth END AS pref, first_value(hd IGNORE NULLS) OVER (PARTITION BY d.doc_id ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM deep d LEFT JOIN stats s ON s.doc_id = d.doc_id AND s.cluster_id = d.cluster_id),
n2 AS (SELECT *, coalesce(is_h AND cur > 0 AND hd - cur >= 2 AND coalesce(members, 0) >= 2 AND (pref IS NULL OR pref = cur + 1) AND (nxt IS NULL OR nxt <= hd), false) AS adopted FROM n1),
n3 AS (SELECT *, last_value(CASE WHEN is_h THEN CASE WHEN adopted THEN cur + 1 ELSE -1 END END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM n2)
SELECT doc_id, ord, CAST(CASE WHEN adopted THEN cur + 1 WHEN band = 'body' AND role IN ('body_text', 'list_item', 'empty_paragraph', 'table', 'figure', 'decorative_shape_candidate') AND coalesce(above, -1) > 0 THEN above + 1 ELSE depth END AS BIGINT) AS depth, adopted FROM n3""",
    "cluster_depths": f"{STATS} SELECT doc_id, cluster_id, members, depth, round(share, 4) AS share, preferred FROM stats",
    "heading_path": rf"""{DEEP},
hs AS (SELECT doc_id, ord, depth, trim(regexp_replace(text, '{S}+', ' ', 'g')) AS text FROM deep WHERE is_h),
pairs AS (SELECT g.doc_id, g.ord AS g, h.ord AS h, g.text, g.depth AS gd, m.depth AS md FROM hs g JOIN hs h ON h.doc_id = g.doc_id AND h.ord >= g.ord LEFT JOIN hs m ON m.doc_id = g.doc_id AND m.ord > g.ord AND m.ord <= h.ord),
anc AS (SELECT doc_id, g, h, text FROM pairs GROUP BY ALL HAVING coalesce(bool_and(md > gd), true)),
paths AS (SELECT doc_id, h, string_agg(text, ' > ' ORDER BY g) AS path FROM anc GROUP BY doc_id, h)
SELECT d.doc_id, d.ord, coalesce(p.path, '') AS path FROM (SELECT doc_id, ord, max(CASE WHEN is_h THEN ord END) OVER (PARTITION BY doc_id ORDER BY ord) AS h FROM deep) d LEFT JOIN paths p ON p.doc_id = d.doc_id AND p.h = d.h""",
    "anchor_propagation": f"""{DEEP},
a1 AS (SELECT *, ord % 9 = 4 AND band = 'body' AS anc FROM deep),
a2 AS (SELECT *, anc OR role = 'section_heading' AS stop FROM a1),
a3 AS (SELECT *, last_value(CASE WHEN stop THEN CASE WHEN anc THEN depth ELSE -1 END END IGNORE NULLS) OVER (PARTITION BY doc_id, section ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM a2)
SELECT doc_id, ord, CAST(CASE WHEN NOT stop AND band <> 'peripheral' AND coalesce(above, -1) >= 0 THEN above + 1 ELSE depth END AS BIGINT) AS depth FROM a3""",
    "visibility_counts": f"""{ROLES}, v AS (SELECT CASE WHEN role = 'empty_paragraph' THEN 'empty_paragraph' WHEN block_type = 'control' THEN 'control' WHEN band = 'peripheral' THEN 'peripheral' ELSE '' END AS hidden_reason FROM roles)
SELECT hidden_reason = '' AS shown, hidden_reason, count(*) AS n FROM v GROUP BY ALL""",
    "role_distribution": f"{ROLES} SELECT role, band, block_type, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM roles GROUP BY ALL",
    "floating_anchor": f"""WITH b AS ({LINE_BLOCKS_SQL}), p AS (SELECT doc_id, section, ord % 4 AS i, count(*) AS n FROM b WHERE block_type = 'paragraph' GROUP BY ALL),
o AS (SELECT b.doc_id, ord, coalesce(p.n, 0) AS n FROM b LEFT JOIN p ON p.doc_id = b.doc_id AND p.section = b.section AND p.i = b.ord % 4 WHERE block_type IN ('image', 'shape'))
SELECT doc_id, ord, CASE n WHEN 1 THEN 'resolved' WHEN 0 THEN 'unresolved' ELSE 'ambiguous' END AS status, CAST(CASE n WHEN 1 THEN 0.9 WHEN 0 THEN 0.0 ELSE 0.5 END AS DOUBLE) AS confidence, n FROM o""",
    "neighbour_captions": f"""WITH b AS ({LINE_BLOCKS_SQL}), t AS (SELECT doc_id, ord, section, block_type, CASE WHEN NOT regexp_matches(text, '{IGNORE}') THEN text END AS text FROM b WHERE block_type IN ('paragraph', 'table')),
n AS (SELECT *, lag(text) OVER w AS bef, lead(text) OVER w AS aft, lead(text, 2) OVER w AS sec FROM t WINDOW w AS (PARTITION BY doc_id, section ORDER BY ord))
SELECT doc_id, ord, CASE WHEN regexp_matches(bef, '{CAPTION}') THEN bef END AS caption, CASE WHEN regexp_matches(aft, '{NOTE}') THEN aft END AS note,
  coalesce(CASE WHEN NOT regexp_matches(aft, '{NOTE}') AND regexp_matches(aft, '{SOURCE}') THEN aft END, CASE WHEN regexp_matches(sec, '{SOURCE}') THEN sec END) AS source FROM n WHERE block_type = 'table'""",
}
