"""Document blocks: style clusters, roles, first-pass depths, candidates, constraints, paths, visibility.

Blocks are (doc_id, ord, section, block_type, text, style_id, para_id, font_size, bold_ratio, alignment, indent,
native_level, numbering_level). Every order is the order of ``ord`` in a document; passes that the rules state as
running state are window frames partitioned by document, so a document is the unit of work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T

PERIPHERAL = ("header", "footer", "section_control", "control")
ANNOTATION = ("caption", "footnote", "endnote")
OBJECTS = ("table", "image", "shape", "shape_group")
FLOW_ROLES = ("body_text", "list_item", "empty_paragraph", "table", "figure", "decorative_shape_candidate")
HEADING_SCORE = 3.0
BAND = 0.9
SIGNATURE = ["style_id", "para_id", "size", "bold"]


def by_doc(*order: str) -> Window:
    return Window.partitionBy("doc_id").orderBy(*(order or ("ord",)))


def signed(blocks: DataFrame) -> DataFrame:
    """Blocks with the parts of their style signature: the size to the nearest half, and mostly bold or not."""
    return blocks.withColumn("size", F.bround(F.col("font_size") * 2) / 2).withColumn("bold", F.coalesce("bold_ratio", F.lit(0.0)) >= 0.5)


def style_clusters(blocks: DataFrame) -> DataFrame:
    """One row per document and style signature of its text paragraphs, with heading score and ranks.

    The cluster of most characters (of equal ones the first seen) is the body. Others score for size, weight,
    brevity, rarity, what follows them and alignment; from HEADING_SCORE on they are headings, ranked by size,
    weight and length. depth_rank starts a new band where the size falls by over BAND or the weight changes.
    """
    own = signed(blocks).withColumn("chars", F.length(T.strip(F.col("text"))))
    some = own.where(((F.col("block_type") == "paragraph") & (F.col("chars") > 0)) | F.col("block_type").isin(*OBJECTS))
    key = F.struct(*SIGNATURE)
    after = F.lead(F.struct(F.col("block_type").alias("t"), key.alias("k"))).over(by_doc())
    seen = some.withColumn("after", after).where("block_type = 'paragraph'")
    other = F.col("after").isNotNull() & ((F.col("after.t") != "paragraph") | ~F.col("after.k").eqNullSafe(key))
    clusters = seen.groupBy("doc_id", *SIGNATURE).agg(
        F.count("*").alias("n"),
        F.sum("chars").alias("chars"),
        F.min("ord").alias("first"),
        F.min_by("alignment", "ord").alias("alignment"),
        F.coalesce(F.avg("indent"), F.lit(0.0)).alias("indent"),
        F.count_if(F.col("after").isNotNull()).alias("followed"),
        F.count_if(other).alias("followed_by_other"),
    )
    best = Window.partitionBy("doc_id").orderBy(F.desc("chars"), "first")
    whole = Window.partitionBy("doc_id")
    marked = clusters.withColumn("is_body", F.row_number().over(best) == 1).withColumn("total", F.sum("n").over(whole))
    body = lambda c: F.max(F.when(F.col("is_body"), F.col(c))).over(whole)
    with_body = marked.withColumns({"body_size": body("size"), "body_alignment": body("alignment"), "body_indent": body("indent")})
    mean, share = F.col("chars") / F.col("n"), F.col("n") / F.col("total")
    point = lambda condition, value: F.when(condition, value).otherwise(0.0)
    score = (
        point(F.col("size") > F.col("body_size") + 0.1, F.least(F.lit(2.0), 1 + (F.col("size") - F.col("body_size")) / 4))
        + point(F.col("bold"), 1.0)
        + F.when(mean <= 40, 1.0).when(mean <= 80, 0.5).otherwise(0.0)
        + point((F.col("n") >= 2) & (share <= 0.3), 0.5)
        + point((F.col("followed") > 0) & (F.col("followed_by_other") * 10 >= F.col("followed") * 7), 1.0)
        + point(~F.col("alignment").eqNullSafe(F.col("body_alignment")) | (F.abs(F.col("indent") - F.col("body_indent")) > 500), 0.5)
        - point(share > 0.3, 2.0)
        - point(mean > 100, 2.0)
    )
    scored = with_body.withColumn("score", F.when(~F.col("is_body"), score)).withColumn("is_heading", F.coalesce(F.col("score") >= HEADING_SCORE, F.lit(False)))
    size = F.coalesce("size", F.lit(0.0))
    rank = F.row_number().over(Window.partitionBy("doc_id", "is_heading").orderBy(F.desc(size), F.desc("bold"), mean, "first"))
    ids = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("chars"), F.desc("n"), "first"))
    ranked = scored.withColumn("style_rank", F.when(F.col("is_heading"), rank).otherwise(0).cast("long")).withColumn("cluster_id", F.format_string("C%02d", ids))
    # Bands: a fold over the few headings of a document, as a band's size is that of its first cluster.
    heads = ranked.where("is_heading").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("style_rank", size.alias("size"), "bold", "cluster_id"))).alias("heads"))
    start = F.struct(F.lit(0).alias("rank"), F.lit(None).cast("double").alias("size"), F.lit(None).cast("boolean").alias("bold"), F.expr("array()").cast("array<struct<cluster_id:string,depth_rank:int>>").alias("out"))

    def step(acc, x):
        new = acc["size"].isNull() | (acc["size"] - x["size"] > BAND) | (acc["bold"] != x["bold"])
        at = F.when(new, acc["rank"] + 1).otherwise(acc["rank"])
        out = F.concat(acc["out"], F.array(F.struct(x["cluster_id"].alias("cluster_id"), at.alias("depth_rank"))))
        return F.struct(at.alias("rank"), F.when(new, x["size"]).otherwise(acc["size"]).alias("size"), F.when(new, x["bold"]).otherwise(acc["bold"]).alias("bold"), out.alias("out"))

    bands = heads.select("doc_id", F.explode(F.aggregate("heads", start, step)["out"]).alias("b")).select("doc_id", "b.*")
    role = F.when(F.col("is_body"), "body_baseline").when(F.col("is_heading"), "section_heading").otherwise("body")
    confidence = F.when(F.col("is_body"), 0.9).when(F.col("is_heading"), F.bround(F.least(F.lit(0.9), 0.45 + 0.08 * F.col("score")), 2)).otherwise(0.7)
    joined = ranked.join(bands, ["doc_id", "cluster_id"], "left")
    return joined.select("doc_id", "cluster_id", *SIGNATURE, "n", "chars", F.coalesce("score", F.lit(0.0)).alias("score"), role.alias("role"), confidence.alias("confidence"), "style_rank", F.coalesce("depth_rank", F.lit(0)).cast("long").alias("depth_rank"))


def with_roles(blocks: DataFrame, clusters: DataFrame) -> DataFrame:
    """Blocks with role, confidence, band, cluster_id and depth_rank."""
    own, k = signed(blocks), clusters.select("doc_id", *SIGNATURE, "cluster_id", F.col("role").alias("cluster_role"), F.col("confidence").alias("cluster_confidence"), "depth_rank").alias("k")
    same = [own[c].eqNullSafe(F.col(f"k.{c}")) for c in ("doc_id", *SIGNATURE)]
    met = own.join(k, same[0] & same[1] & same[2] & same[3] & same[4], "left").select(own["*"], "k.cluster_id", "k.cluster_role", "k.cluster_confidence", "k.depth_rank")
    kind, full = F.col("block_type"), T.strip(F.col("text")) != ""
    heading = F.col("cluster_role") == "section_heading"
    of = lambda role, confidence: F.struct(F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"), (F.lit(confidence) if isinstance(confidence, float) else confidence).alias("confidence"))
    paragraph = (
        F.when(~full, of("empty_paragraph", 0.9))
        .when(F.col("native_level").isNotNull(), of("section_heading", 0.9))
        .when(F.col("numbering_level").isNotNull(), of("list_item", 0.75))
        .when(heading, of("section_heading", F.col("cluster_confidence")))
        .otherwise(of("body_text", 0.8))
    )
    fixed = {"header": ("page_header", 0.9), "footer": ("page_footer", 0.9), "footnote": ("footnote", 0.9), "endnote": ("endnote", 0.9), "caption": ("caption", 0.85), "table": ("table", 0.95), "image": ("figure", 0.9)}
    chosen = F.when(kind == "paragraph", paragraph)
    for name, value in fixed.items():
        chosen = chosen.when(kind == name, of(*value))
    shape = F.when(full, "figure").otherwise("decorative_shape_candidate")
    chosen = chosen.when(kind.isin("shape", "shape_group"), of(shape, 0.6)).when(kind.isin("section_control", "control"), of("document_control", 0.9)).otherwise(of("unknown", 0.3))
    band = F.when(kind.isin(*PERIPHERAL), "peripheral").when(kind.isin(*ANNOTATION), "annotation").otherwise("body")
    return met.withColumn("chosen", chosen).withColumns({"role": F.col("chosen.role"), "confidence": F.col("chosen.confidence"), "band": band}).drop("chosen", "cluster_role")


def first_pass_depth(roles: DataFrame) -> DataFrame:
    """Blocks with depth, heading_depth (of headings) and jump (over the heading before by two or more)."""
    before = by_doc().rowsBetween(Window.unboundedPreceding, -1)
    heading = (F.col("band") == "body") & (F.col("role") == "section_heading")
    native = F.when(heading & F.col("native_level").isNotNull(), F.col("native_level") + 1)
    a = roles.withColumn("native", native)
    ranked = F.coalesce(F.max("native").over(before), F.lit(0)) + F.greatest(F.coalesce("depth_rank", F.lit(1)), F.lit(1))
    b = a.withColumn("heading_depth", F.when(heading, F.coalesce("native", ranked)).cast("long")).drop("native")
    current = F.coalesce(F.last("heading_depth", ignorenulls=True).over(before), F.lit(0))
    listed = F.when(F.col("role") == "list_item", F.greatest(F.coalesce("numbering_level", F.lit(0)) - 1, F.lit(0))).otherwise(0)
    c = b.withColumn("current", current).withColumn("depth", F.when(F.col("band") == "peripheral", 0).when(heading, F.col("heading_depth")).when(F.col("band") == "body", F.col("current") + 1 + listed))
    objects = F.last(F.when(F.col("block_type").isin(*OBJECTS), F.col("depth")), ignorenulls=True).over(before)
    d = c.withColumn("depth", F.coalesce("depth", F.coalesce(objects, F.lit(1)) + 1).cast("long"))
    return d.withColumn("jump", heading & (F.col("current") > 0) & (F.col("heading_depth") > F.col("current") + 1))


def depth_candidates(deep: DataFrame) -> DataFrame:
    """(doc_id, ord, depth, score, selected): candidates of each block, the best first.

    Headings that jump by two or more get the depth below the heading before as a relaxed candidate; flow
    blocks get the depth below the last heading where theirs differs.
    """
    heading = F.col("heading_depth").isNotNull()
    base = F.when(heading, F.coalesce("cluster_confidence", "confidence")).otherwise(F.col("confidence"))
    relaxed = F.when(heading & (F.col("current") > 0) & (F.col("heading_depth") - F.col("current") >= 2), F.col("current") + 1)
    stacked = F.when(~heading & (F.col("band") == "body") & (F.col("current") + 1 != F.col("depth")), F.col("current") + 1)
    one = lambda depth, score, kind: F.struct(depth.cast("long").alias("depth"), F.bround(score, 2).alias("score"), F.lit(kind).alias("kind"))
    less = F.greatest(F.lit(0.3), base - 0.2)
    listed = F.array_compact(F.array(one(F.col("depth"), base, "own"), F.when(relaxed.isNotNull(), one(relaxed, less, "relaxed")), F.when(stacked.isNotNull(), one(stacked, less, "stacked"))))
    return deep.select("doc_id", "ord", F.col("depth").alias("own"), F.explode(listed).alias("x")).select("doc_id", "ord", "x.depth", "x.score", "x.kind", (F.col("own") == F.col("x.depth")).alias("selected"))


def cluster_depths(deep: DataFrame) -> DataFrame:
    """(doc_id, cluster_id, members, depth, share, preferred): the most frequent depth of each heading cluster."""
    counts = deep.where("heading_depth IS NOT NULL AND cluster_id IS NOT NULL").groupBy("doc_id", "cluster_id", "depth").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    w = Window.partitionBy("doc_id", "cluster_id")
    top = counts.withColumn("members", F.sum("n").over(w)).withColumn("k", F.row_number().over(w.orderBy(F.desc("n"), "first"))).where("k = 1")
    share = F.col("n") / F.col("members")
    return top.select("doc_id", "cluster_id", "members", "depth", share.alias("share"), (share >= 0.8).alias("preferred"))


def adopt_relaxed(deep: DataFrame) -> DataFrame:
    """Blocks with depth after constraints, and adopted: relaxed headings whose cluster and successors allow it.

    A relaxed depth is adopted if the heading's cluster has two members or more, prefers no other depth, and
    the next heading of the document is not deeper; flow blocks up to the next heading follow.
    """
    stats = cluster_depths(deep).select("doc_id", "cluster_id", "members", F.when(F.col("preferred"), F.col("depth")).alias("preferred"))
    after = by_doc().rowsBetween(1, Window.unboundedFollowing)
    before = by_doc().rowsBetween(Window.unboundedPreceding, -1)
    met = deep.join(stats, ["doc_id", "cluster_id"], "left").withColumn("next", F.first("heading_depth", ignorenulls=True).over(after))
    relaxed = F.when((F.col("current") > 0) & (F.col("heading_depth") - F.col("current") >= 2), F.col("current") + 1)
    good = relaxed.isNotNull() & (F.coalesce("members", F.lit(0)) >= 2) & (F.col("preferred").isNull() | (F.col("preferred") == relaxed)) & (F.col("next").isNull() | (F.col("next") <= F.col("heading_depth")))
    judged = met.withColumn("adopted", F.coalesce(good, F.lit(False))).withColumn("to", F.when(F.col("adopted"), relaxed).otherwise(F.col("heading_depth")))
    follows = F.last(F.when(F.col("heading_depth").isNotNull(), F.struct("adopted", "to")), ignorenulls=True).over(before)
    moved = judged.withColumn("follows", follows)
    flow = (F.col("band") == "body") & F.col("role").isin(*FLOW_ROLES) & F.coalesce(F.col("follows.adopted"), F.lit(False))
    depth = F.when(F.col("adopted"), F.col("to")).when(flow, F.col("follows.to") + 1).otherwise(F.col("depth"))
    return moved.withColumn("depth", depth.cast("long")).drop("members", "preferred", "next", "to", "follows")


def heading_paths(deep: DataFrame) -> DataFrame:
    """(doc_id, ord, path): texts of the headings above each block, its own last if it is a heading.

    The stack of open headings is folded over the headings of a document; other blocks take that of the last
    heading before them.
    """
    heads = deep.where("heading_depth IS NOT NULL").select("doc_id", F.struct("ord", F.col("depth").alias("depth"), T.collapse(F.col("text")).alias("text")).alias("h"))
    lists = heads.groupBy("doc_id").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    stack = "array<struct<ord:bigint,depth:bigint,text:string>>"
    start = F.struct(F.expr("array()").cast(stack).alias("stack"), F.expr("array()").cast("array<struct<ord:bigint,path:array<string>>>").alias("out"))

    def step(acc, h):
        held = F.concat(F.filter(acc["stack"], lambda s: s["depth"] < h["depth"]), F.array(h))
        return F.struct(held.cast(stack).alias("stack"), F.concat(acc["out"], F.array(F.struct(h["ord"].alias("ord"), F.transform(held, lambda s: s["text"]).alias("path")))).alias("out"))

    paths = lists.select("doc_id", F.explode(F.aggregate("hs", start, step)["out"]).alias("p")).select("doc_id", F.col("p.ord").alias("ord"), F.col("p.path").alias("own"))
    at = by_doc().rowsBetween(Window.unboundedPreceding, 0)
    joined = deep.select("doc_id", "ord").join(paths, ["doc_id", "ord"], "left")
    return joined.select("doc_id", "ord", F.coalesce(F.last("own", ignorenulls=True).over(at), F.expr("array()").cast("array<string>")).alias("path"))


def propagate_anchors(blocks: DataFrame) -> DataFrame:
    """Blocks (doc_id, ord, section, band, role, depth, anchored) with depth after anchors.

    Behind an anchor of a section, up to the next heading or anchor, non-peripheral blocks are one deeper than
    it; elsewhere blocks no deeper than allowed by the last anchor or heading seen keep their depth.
    """
    order = Window.partitionBy("doc_id", "section").orderBy("ord")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("anchored") | (F.col("role") == "section_heading")
    mark = F.when(stop, F.struct("anchored", "depth"))
    last = F.last(mark, ignorenulls=True).over(before)
    seen = blocks.withColumn("last", last)
    under = ~stop & (F.col("band") != "peripheral") & F.coalesce(F.col("last.anchored"), F.lit(False))
    return seen.withColumn("new_depth", F.when(under, F.col("last.depth") + 1).otherwise(F.col("depth")).cast("long")).drop("last")


def visibility(roles: DataFrame) -> DataFrame:
    """Blocks with shown and the reason why not: empty, control, or peripheral, in that order."""
    reason = F.when(F.col("role") == "empty_paragraph", "empty_paragraph").when(F.col("block_type").isin("control", "section_control"), "control").when(F.col("band") == "peripheral", "peripheral")
    return roles.withColumn("hidden_reason", F.coalesce(reason, F.lit(""))).withColumn("shown", reason.isNull())


def floating_anchors(objects: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(doc_id, ord, status, confidence, n): each floating object and the paragraphs of its section and place."""
    counts = paragraphs.groupBy("doc_id", "section", "paragraph_index").agg(F.count("*").alias("n"))
    met = objects.join(counts, ["doc_id", "section", "paragraph_index"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("n") == 1, "resolved").when(F.col("n") == 0, "unresolved").otherwise("ambiguous")
    return met.select("doc_id", "ord", status.alias("status"), F.when(F.col("n") == 1, 0.9).when(F.col("n") == 0, 0.0).otherwise(0.5).alias("confidence"), F.col("n").cast("long").alias("n"))


def neighbour_texts(paragraphs: DataFrame, tables: DataFrame, caption: str, note: str, source: str, ignore: str) -> DataFrame:
    """Caption, note and source candidates of each table among its neighbour paragraphs.

    The paragraph before may be a caption, the one after a note or else a source, the second after a source.
    """
    w = Window.partitionBy("doc_id", "section").orderBy("ord")
    text = F.when(~F.col("text").rlike(ignore), F.col("text"))
    near = paragraphs.unionByName(tables, allowMissingColumns=True).withColumn("text", text)
    near = near.withColumns({"before": F.lag("text").over(w), "after": F.lead("text").over(w), "second": F.lead("text", 2).over(w)})
    is_note = F.coalesce(F.col("after").rlike(note), F.lit(False))
    direct = F.when(~is_note & F.col("after").rlike(source), F.col("after"))
    return near.where("block_type = 'table'").select(
        "doc_id", "ord", F.when(F.col("before").rlike(caption), F.col("before")).alias("caption"), F.when(is_note, F.col("after")).alias("note"), F.coalesce(direct, F.when(F.col("second").rlike(source), F.col("second"))).alias("source")
    )
