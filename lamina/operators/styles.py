"""Lookups in the style dictionaries of a document: paragraph styles, labels, character styles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paragraph_styles(paragraphs: DataFrame, styles: DataFrame, para_props: DataFrame) -> DataFrame:
    """Paragraphs with the properties of their own reference, else of their style's.

    An OUTLINE heading gives a native level, NUMBER and BULLET give a numbering level.
    """
    met = paragraphs.join(styles.select("style_id", F.col("para_pr").alias("style_para_pr")), "style_id", "left").withColumn("resolved", F.coalesce("para_pr", "style_para_pr"))
    props = para_props.withColumnRenamed("para_pr", "resolved")
    found = met.join(props, "resolved", "left")
    kind, level = F.col("heading_type"), F.col("level")
    return found.withColumn("native_level", F.when(kind == "OUTLINE", level)).withColumn("numbering_level", F.when(kind.isin("NUMBER", "BULLET"), level)).drop("style_para_pr")


def auto_labels(styled: DataFrame, bullets: DataFrame, numberings: DataFrame) -> DataFrame:
    """Paragraphs with auto_label: a bullet's character, or the numbering's format of the level."""
    met = styled.join(bullets.select(F.col("id").alias("id_ref"), "char"), "id_ref", "left").join(numberings.select(F.col("id").alias("id_ref"), "level", "format"), ["id_ref", "level"], "left")
    return met.withColumn("auto_label", F.when(F.col("heading_type") == "BULLET", F.col("char")).when(F.col("heading_type").isin("OUTLINE", "NUMBER"), F.col("format"))).drop("char", "format")


def char_styles(runs: DataFrame, chars: DataFrame) -> DataFrame:
    """(doc_id, paragraph, max_size, mean_size, bold_ratio): sizes of a paragraph's runs, weighted by their length."""
    met = runs.join(chars.select("char_pr", (F.col("height") / 100).alias("size"), "bold"), "char_pr", "left")
    weight = F.length("text")
    return met.groupBy("doc_id", "paragraph").agg(
        F.max("size").alias("max_size"),
        (F.sum(F.col("size") * weight) / F.nullif(F.sum(F.when(F.col("size").isNotNull(), weight)), F.lit(0))).alias("mean_size"),
        F.coalesce(F.sum(F.when(F.col("bold"), weight)) / F.nullif(F.sum(weight), F.lit(0)), F.lit(0.0)).alias("bold_ratio"),
    )
