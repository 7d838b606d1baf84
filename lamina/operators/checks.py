"""Checks and audits as queries: a sound relation gives no rows, or a few figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T


def orphans(children: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """Children whose reference has no parent."""
    return children.join(parents.select(*on).distinct(), on, "left_anti")


def id_integrity(rows: DataFrame, id_column: str, kind: str, kinds: tuple[str, ...]) -> DataFrame:
    """(code, subject, n): missing ids, ids used again (once each), and kinds not in the vocabulary."""
    missing = rows.where(F.col(id_column).isNull()).select(F.lit("missing_id").alias("code"), F.lit("").alias("subject"))
    again = rows.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("string").alias("subject")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_id").alias("code"), "subject")
    unknown = rows.where(~F.col(kind).isin(*kinds)).select(F.lit("unknown_kind").alias("code"), F.col(kind).alias("subject"))
    return missing.unionByName(again).unionByName(unknown).groupBy("code", "subject").agg(F.count("*").alias("n"))


def parent_refs(rows: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """(id, kind, problem): references to no row, or to a row of a kind other than ``wanted`` for it."""
    above = rows.select(F.col("id").alias("parent_id"), F.col("kind").alias("parent_kind"))
    met = rows.where("parent_id IS NOT NULL").join(above, "parent_id", "left")
    need = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])[F.col("kind")]
    problem = F.when(F.col("parent_kind").isNull(), "no_parent").when(need.isNotNull() & (need != F.col("parent_kind")), "wrong_kind")
    return met.select("id", "kind", problem.alias("problem")).where("problem IS NOT NULL")


def count_parity(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys whose numbers of rows differ between two relations."""
    a, b = expected.groupBy(key).agg(F.count("*").alias("expected")), found.groupBy(key).agg(F.count("*").alias("found"))
    met = a.join(b, key, "full").select(key, F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("found", F.lit(0)).alias("found"))
    return met.where("expected <> found")


def text_coverage(nodes: DataFrame, rendered: DataFrame) -> DataFrame:
    """(doc_id, n_nodes, n_missing): source texts, white space aside, that the rendering of their document lacks."""
    whole = rendered.select("doc_id", T.without_space(F.col("text")).alias("whole"))
    met = nodes.select("doc_id", T.without_space(F.col("text")).alias("node")).where("node <> ''").join(whole, "doc_id", "left")
    return met.groupBy("doc_id").agg(F.count("*").alias("n_nodes"), F.count_if(~F.coalesce(F.contains("whole", "node"), F.lit(False))).alias("n_missing"))


def baseline_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(doc_id, ord, change): added, removed, relocated, text_changed or meta_changed blocks.

    Blocks meet by key; one without a partner whose text stands elsewhere in the document is relocated.
    """
    a = before.select("doc_id", "ord", F.col("text").alias("a_text"), F.col("meta").alias("a_meta"), F.lit(True).alias("in_a"))
    b = after.select("doc_id", "ord", F.col("text").alias("b_text"), F.col("meta").alias("b_meta"), F.lit(True).alias("in_b"))
    met = a.join(b, ["doc_id", "ord"], "full")
    there = after.select("doc_id", F.col("text").alias("a_text")).where("a_text <> ''").distinct().withColumn("there", F.lit(True))
    met = met.join(there, ["doc_id", "a_text"], "left")
    lost = F.col("in_b").isNull() | (F.col("in_a") & ~F.col("a_text").eqNullSafe(F.col("b_text")))
    change = (
        F.when(F.col("in_a").isNull(), "added")
        .when(lost & F.coalesce("there", F.lit(False)), "relocated")
        .when(F.col("in_b").isNull(), "removed")
        .when(~F.col("a_text").eqNullSafe(F.col("b_text")), "text_changed")
        .when(~F.col("a_meta").eqNullSafe(F.col("b_meta")), "meta_changed")
    )
    return met.select("doc_id", "ord", change.alias("change")).where("change IS NOT NULL")


def depth_anomalies(deep: DataFrame) -> DataFrame:
    """Counters per document: jumps, reversals of indent and size, and clusters scattered over depths."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    heads = deep.where("heading_depth IS NOT NULL").withColumns({"last_depth": F.lag("depth").over(w), "last_size": F.lag("font_size").over(w)})
    by_head = heads.groupBy("doc_id").agg(
        F.count("*").alias("n_headings"),
        F.count_if(F.col("depth") > F.col("last_depth") + 1).alias("jumps"),
        F.count_if((F.col("depth") > F.col("last_depth")) & (F.col("font_size") > F.col("last_size"))).alias("size_reversals"),
    )
    body = deep.where("band = 'body'").withColumns({"d": F.lag("depth").over(w), "i": F.lag("indent").over(w)})
    by_body = body.groupBy("doc_id").agg(F.count_if((F.col("depth") > F.col("d")) & (F.col("indent") < F.col("i"))).alias("indent_reversals"))
    scattered = heads.where("cluster_id IS NOT NULL").groupBy("doc_id", "cluster_id").agg(F.count_distinct("depth").alias("k")).groupBy("doc_id").agg(F.count_if(F.col("k") > 1).alias("scattered"))
    met = by_body.join(by_head, "doc_id", "left").join(scattered, "doc_id", "left")
    return met.select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_headings", "jumps", "size_reversals", "indent_reversals", "scattered")])


def numbering_agreement(deep: DataFrame) -> DataFrame:
    """(system, agree, differ): neighbours with the same system of numbers or marks, by whether depth follows level."""
    numbered = T.split_numbering(F.col("text"))["numbering"]
    level = T.anchor_level(numbered) + 1
    signal = F.when(level.isNotNull(), F.struct(F.lit("number").alias("system"), level.cast("long").alias("level"))).otherwise(F.struct(F.lit("marker").alias("system"), T.marker_level(F.col("text")).cast("long").alias("level")))
    w = Window.partitionBy("doc_id").orderBy("ord")
    own = deep.withColumn("s", signal).where("s.level IS NOT NULL").withColumns({"last": F.lag("s").over(w), "last_depth": F.lag("depth").over(w)})
    pairs = own.where("last.system = s.system")
    same = F.signum(F.col("s.level") - F.col("last.level")) == F.signum(F.col("depth") - F.col("last_depth"))
    return pairs.groupBy("s.system").agg(F.count_if(same).alias("agree"), F.count_if(~same).alias("differ"))


def path_inventory(values: DataFrame, column: str) -> DataFrame:
    """(path, n, n_empty, n_distinct, longest) of the leaves of JSON objects, array places folded to []."""
    return values.select(F.explode(F.from_json(column, "map<string,string>")).alias("path", "value")).groupBy("path").agg(
        F.count("*").alias("n"), F.count_if(T.text_of(F.col("value")) == "").alias("n_empty"), F.count_distinct("value").alias("n_distinct"), F.max(F.length("value")).cast("long").alias("longest")
    )


def mapping_grade(rows: DataFrame, source: str, target: str) -> DataFrame:
    """(n_source, n_target, is_function, is_injective): whether one column's values decide another's."""
    pairs = rows.select(F.col(source).alias("a"), F.col(target).alias("b")).distinct()
    a, b = pairs.groupBy("a").agg(F.count("*").alias("n")), pairs.groupBy("b").agg(F.count("*").alias("n"))
    left = a.agg(F.count("*").alias("n_source"), (F.max("n") <= 1).alias("is_function"))
    right = b.agg(F.count("*").alias("n_target"), (F.max("n") <= 1).alias("is_injective"))
    return left.join(right)


def canonical_hash(columns: list[str]) -> Column:
    """SHA-256 of a row's columns as JSON, nulls included, in the order given."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
