"""The document model: what the filter leaves of it, views, light projections, checks against its sources, and hashes.

Excluded tables go from every relation that knows tables; their blocks stay as empty places with the reason. All of it
is anti joins on (table_id, reason), a relation that grows with the excluded tables only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import text as T
from lamina.operators import grid

EXCLUDED, CONTENTS = "exclude", "special_toc"


def gone(labels: DataFrame) -> DataFrame:
    """(table_id, reason): the tables that the filter leaves out, contents among them."""
    return labels.where(F.col("label").startswith(EXCLUDED) | (F.col("label") == CONTENTS)).select("table_id", F.col("label").alias("reason"))


def prune(rows: DataFrame, left_out: DataFrame, key: str = "table_id") -> DataFrame:
    """rows without those of tables that are left out; rows of no table stay."""
    return rows.join(left_out.select(F.col("table_id").alias(key)), key, "left_anti")


def filtered_blocks(blocks: DataFrame, left_out: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    """blocks with excluded_reason and toc_entries; the place of an excluded table has no text.

    The place of a contents table has instead the entries of its document, (doc_id, i, text, level) in order.
    """
    blocks = blocks.drop("excluded_reason", "toc_entries")  # of a former filter
    met = blocks.join(left_out.select("table_id", F.col("reason").alias("left_out_as")), "table_id", "left")
    contents = F.coalesce(F.col("left_out_as") == CONTENTS, F.lit(False))
    out = F.col("left_out_as").isNotNull() & ~contents
    found = met.withColumn("text", F.when(out, "").otherwise(F.col("text"))).withColumn("excluded_reason", F.when(out, F.col("left_out_as")).otherwise(""))
    kind = "array<struct<text:string,level:bigint>>"
    if entries is None:
        listed = found.withColumn("toc_entries", F.expr("array()").cast(kind))
    else:
        lists = entries.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "text", "level"))), lambda x: F.struct(x["text"].alias("text"), x["level"].cast("long").alias("level"))).alias("entries"))
        listed = found.join(lists, "doc_id", "left").withColumn("toc_entries", F.coalesce(F.when(contents, F.col("entries")), F.expr("array()").cast(kind))).drop("entries")
    return listed.select(*blocks.columns, "excluded_reason", "toc_entries")


def filter_counts(labels: DataFrame, types: DataFrame, numeric: DataFrame) -> DataFrame:
    """(measure, value, n): how many tables have each label, and of the kept ones each type and numeric verdict."""
    met = labels.join(types.select("table_id", "table_type"), "table_id", "left").join(numeric, "table_id", "left")
    kept = F.col("label").startswith("keep")
    pair = lambda name, value: F.struct(F.lit(name).alias("measure"), F.coalesce(value, F.lit("")).alias("value"))
    rows = F.array_compact(F.array(pair("label", F.col("label")), F.when(kept, pair("table_type", F.col("table_type"))), F.when(kept, pair("verdict", F.col("verdict")))))
    return met.select(F.explode(rows).alias("x")).groupBy("x.measure", "x.value").agg(F.count("*").alias("n"))


def sensitivity(facts: DataFrame) -> DataFrame:
    """(conflict, table_id): tables on which the filter's signs disagree; ``facts`` as for the cascade."""
    signs = F.array_compact(
        F.array(
            F.when((F.col("gridness") != "grid") & F.col("complete"), F.lit("no_grid_but_records")),
            F.when((F.col("gridness") == "grid") & (F.col("table_type") == "title_box"), F.lit("title_box_but_grid")),
            F.when((F.col("gridness") != "grid") & F.col("pairs"), F.lit("no_grid_but_pairs")),
        )
    )
    return facts.select(F.explode(signs).alias("conflict"), "table_id")


def kept_tables(tables: DataFrame, labels: DataFrame) -> DataFrame:
    """All tables of the model, nested ones too, with kept_as."""
    return tables.join(labels.where("label LIKE 'keep%'").select("table_id", F.regexp_replace("label", "^keep_", "").alias("kept_as")), "table_id")


def numeric_tables(tables: DataFrame, numeric: DataFrame) -> DataFrame:
    return tables.join(numeric.where("verdict = 'numeric'").select("table_id"), "table_id", "left_semi")


def searchable_blocks(blocks: DataFrame) -> DataFrame:
    """The blocks that a search looks at: those that are shown."""
    return blocks.where("shown")


def linking(cells: DataFrame, tables: DataFrame, types: DataFrame) -> DataFrame:
    """The light projection of each table that links it with the body's text.

    (table_id, parent_id, table_type, text, own_texts, n_cells, n_empty, n_merged, n_multiline, child_ids)
    """
    texts = grid.rollup_text(cells)
    facts = cells.groupBy("table_id").agg(
        F.count("*").alias("n_cells"),
        F.count_if(T.strip(F.col("text")) == "").alias("n_empty"),
        F.count_if((F.col("row_span") > 1) | (F.col("col_span") > 1)).alias("n_merged"),
        F.count_if(F.contains("text", F.lit("\n"))).alias("n_multiline"),
        F.transform(F.sort_array(F.collect_list(F.when(T.strip(F.col("text")) != "", F.struct("r", "c", T.collapse(F.col("text")).alias("text"))))), lambda x: x["text"]).alias("own_texts"),
    )
    children = tables.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("table_id")).agg(F.sort_array(F.collect_set(F.col("table_id"))).alias("child_ids"))
    met = tables.select("table_id", "parent_id").join(facts, "table_id", "left").join(texts, "table_id", "left").join(types.select("table_id", "table_type"), "table_id", "left").join(children, "table_id", "left")
    empty = lambda c: F.coalesce(c, F.expr("array()").cast(met.schema[c].dataType)).alias(c)
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_cells", "n_empty", "n_merged", "n_multiline")]
    return met.select("table_id", "parent_id", F.coalesce("table_type", F.lit("")).alias("table_type"), F.coalesce("text", F.lit("")).alias("text"), empty("own_texts"), *counts, empty("child_ids"))


def first_texts(rows: DataFrame, key: str = "root_id", most: int = 5) -> DataFrame:
    """(key, text): the first texts of a root's inner rows (key, place, text), joined: the preview's own limit of five."""
    order = Window.partitionBy(key).orderBy("place")
    full = rows.select(key, "place", T.collapse(F.col("text")).alias("text")).where("text <> ''").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    parts = full.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("nth", "text"))).alias("parts"))
    return parts.select(key, F.array_join(F.transform("parts", lambda x: x["text"]), " ").alias("text"))


# Checks of a model: each gives (check, subject), a row for whatever is wrong.


def wrong(check: str, rows: DataFrame, subject: str | Column) -> DataFrame:
    named = F.col(subject) if isinstance(subject, str) else subject
    return rows.select(F.lit(check).alias("check"), named.cast("string").alias("subject"))


def twice(check: str, rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has."""
    again = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return wrong(check, again, F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))


def lacking(check: str, rows: DataFrame, subject: str, *columns: str) -> DataFrame:
    """Rows without a value in one of some columns."""
    none = F.lit(False)
    for c in columns:
        none = none | F.col(c).isNull()
    return wrong(check, rows.where(none), subject)


def rising(check: str, paths: DataFrame, subject: str, depths: str) -> DataFrame:
    """Paths whose depths, an array, do not grow from one to the next."""
    steps = F.transform(depths, lambda x, i: (i == 0) | (x > F.get(F.col(depths), i - 1)))
    return wrong(check, paths.where(~F.forall(steps, lambda ok: F.coalesce(ok, F.lit(False)))), subject)


def drawn(check: str, rendered: DataFrame, sizes: DataFrame) -> DataFrame:
    """Tables whose markdown has other rows or columns than the table."""
    lines = F.filter(F.split("markdown", "\n"), lambda x: ~x.rlike(r"^\|( --- \|)+$"))
    bare = F.transform(lines, lambda x: F.replace(x, F.lit("\\|"), F.lit("")))
    wide = F.array_max(F.transform(bare, lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) - 1))
    met = rendered.join(sizes, "table_id").where((F.size(lines) != F.col("n_rows")) | (wide != F.col("n_cols")))
    return wrong(check, met, "table_id")


def unknown(check: str, rows: DataFrame, key: str, known: DataFrame, of: str) -> DataFrame:
    """References that are not null and name nothing known."""
    return wrong(check, rows.where(F.col(key).isNotNull()).join(known.select(F.col(of).alias(key)).distinct(), key, "left_anti"), key)


def lost(check: str, before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys that a relation had before and has no more."""
    return wrong(check, before.select(key).distinct().join(after.select(key), key, "left_anti"), key)


def collected(found: list[DataFrame]) -> DataFrame:
    """(check, n): how many rows are wrong by each check; a sound model gives none."""
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("check").agg(F.count("*").alias("n"))


def header_audit(declared: DataFrame, found: DataFrame) -> DataFrame:
    """(table_id, verdict): header rows (table_id, r) found, against those that the author declared.

    missed (none found), exact, subset, superset, disjoint or overlap; tables without declared rows are left out.
    """
    rows = lambda df, name: df.groupBy("table_id").agg(F.collect_set("r").alias(name))
    met = rows(declared, "a").join(rows(found, "b"), "table_id", "left")
    both = F.size(F.array_intersect("a", "b"))
    verdict = (
        F.when(F.col("b").isNull(), "missed")
        .when((both == F.size("a")) & (both == F.size("b")), "exact")
        .when(both == F.size("b"), "subset")
        .when(both == F.size("a"), "superset")
        .when(both == 0, "disjoint")
        .otherwise("overlap")
    )
    return met.select("table_id", verdict.alias("verdict"))


def snapshot(blocks: DataFrame, columns: tuple[str, ...] = ("block_type", "role", "depth", "text")) -> DataFrame:
    """(doc_id, n_blocks, sha256): the number of a document's blocks and a hash of some columns of them, in order."""
    row = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    parts = blocks.select("doc_id", "ord", F.sha2(row, 256).alias("own")).groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.sort_array(F.collect_list(F.struct("ord", "own"))).alias("parts"))
    return parts.select("doc_id", "n_blocks", F.sha2(F.array_join(F.transform("parts", lambda x: x["own"]), ""), 256).alias("sha256"))


def json_paths(values: DataFrame, column: str) -> DataFrame:
    """(path, kind, n, n_empty, longest) of every value in JSON texts, places of arrays as [].

    The texts are walked a level at a time, to the deepest; ``n_empty`` counts empty texts, lists and objects.
    """
    spark = values.sparkSession
    level = values.select(F.lit("$").alias("path"), F.try_parse_json(F.col(column)).alias("v")).where("v IS NOT NULL")
    found, deeper = None, True
    while deeper:
        kind = F.schema_of_variant("v")
        name = (
            F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")
        )
        text = F.try_variant_get(F.col("v"), "$", "string")
        shown = F.when(name.isin("object", "array"), F.to_json("v")).otherwise(text)
        own = level.select("path", "v", name.alias("kind"), shown.alias("shown"))
        counts = own.groupBy("path", "kind").agg(F.count("*").alias("n"), F.count_if(F.coalesce("shown", F.lit("")).isin("", "{}", "[]")).alias("n_empty"), F.coalesce(F.max(F.length("shown")), F.lit(0)).cast("long").alias("longest"))
        found = counts if found is None else found.unionByName(counts)
        inner = own.where("kind IN ('object', 'array')").select("path", "v")
        deeper = not inner.isEmpty()
        if deeper:
            each = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
            level = each.select(F.concat("path", F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), F.col("key")))).alias("path"), F.col("value").alias("v"))
    return found


def dynamic_paths(paths: DataFrame, most: int = 30, rate: float = 0.2) -> DataFrame:
    """(path): objects whose keys are data, not names: over ``most`` keys, of which the median one is in under ``rate`` of the objects."""
    parent = F.regexp_replace("path", r"\.[^.\[\]]*$", "")
    keys = paths.where(~F.col("path").endswith("[]") & (F.col("path") != "$")).groupBy("path").agg(F.sum("n").alias("n")).withColumn("parent", parent)
    objects = paths.where("kind = 'object'").select(F.col("path").alias("parent"), F.col("n").alias("of"))
    rates = keys.join(objects, "parent").groupBy("parent").agg(F.count("*").alias("keys"), F.median(F.col("n") / F.col("of")).alias("rate"))
    return rates.where((F.col("keys") > most) & (F.col("rate") < rate)).select(F.col("parent").alias("path"))


def has_private_use(c: Column) -> Column:
    return F.coalesce(c.rlike("[\\x{E000}-\\x{F8FF}]"), F.lit(False))


def is_evidence(c: Column) -> Column:
    """Whether a value found in a source proves anything: two characters, of digits alone six."""
    text = T.strip(c)
    return (F.length(text) >= 2) & (~text.rlike("^[0-9]+$") | (F.length(text) >= 6))
