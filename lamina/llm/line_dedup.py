"""Line dedup (op 8): overlapping three-line windows, repeated anywhere in the corpus, are kept once.

Lines with a word are normalised (lower case, white space collapsed) and hashed; each run of three neighbours
is a window with two 64-bit hashes over the lines' 64-bit hashes. The first occurrence of a window is the one with the smallest (doc_id, text
hash, place); every later one covers its three lines, and all covered lines of a document are removed
together, so overlapping windows merge. Blank lines and documents of under three lines stay as they are.

Defined results: a null text stays null; null ids come first; rows equal in doc_id and text count as one
document and keep the same lines; very long texts are windows like any other; a document that loses all lines
stays with an empty text; an empty table gives an empty result; all columns of the input stay, in a struct, so
no name can clash; ids may be of any type.

Scale: windows are counted with map-side aggregation, only repeated ones are kept, and the join back to the
windows has an exchange directly on either side, so a hot window is split by adaptive execution. Texts are
shuffled once, by document, to meet the positions to remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import SPACE, blank, cut, hash_side, table, where_fenced

WINDOW = 3

ROW, ID, KEY, LINES, GONE = (blank(x) for x in ("row", "id", "key", "lines", "gone"))


def full_lines(text: Column) -> Column:
    """(i, h): the place and the hash of each line with a word."""
    flat = F.regexp_replace(F.lower(text), r"[ \t\x0b\f\r]{2,}|[\t\x0b\f\r]", " ")
    lines = F.transform(F.split(flat, "\n"), lambda line, i: F.struct(i.alias("i"), F.btrim(line, F.lit(SPACE)).alias("line")))
    return F.transform(F.filter(lines, lambda x: x["line"] != ""), lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["line"]).alias("h")))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.struct("*").alias(ROW), F.col(doc_id).alias(ID), F.xxhash64(F.col(doc_id), F.col(text)).alias(KEY), F.col(text).alias(blank("text")))


def windows_of(docs: DataFrame, doc_id: str, text: str, window: int) -> DataFrame:
    """(id, key, place, lines, a, b): each window of each document; ``lines`` are the places of its lines."""
    lines = where_fenced(keyed(docs, doc_id, text).select(ID, KEY, full_lines(F.col(blank("text"))).alias(LINES)), F.size(LINES) >= window)
    x = F.col(LINES)
    run = lambda i: [F.get(x, i + j) for j in range(window)]
    each = F.transform(
        F.sequence(F.lit(0), F.size(LINES) - window),
        lambda i: F.struct(
            i.alias("place"),
            F.array(*[v["i"] for v in run(i)]).alias("lines"),
            F.xxhash64(*[v["h"] for v in run(i)]).alias("a"),
            F.xxhash64(F.lit(1), *[v["h"] for v in run(i)]).alias("b"),
        ),
    )
    return lines.select(ID, KEY, F.explode(each).alias("w")).select(F.col(ID).alias("id"), F.col(KEY).alias("key"), "w.*")


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, key, gone): for each document with a later occurrence, the places of the lines to remove."""
    windows = windows_of(docs, doc_id, text, window)
    place = F.struct("id", "key", "place")
    repeated = cut(windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = windows.join(repeated, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("id", "key", F.explode("lines").alias("line")).groupBy("id", "key").agg(F.collect_set("line").alias("gone"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs as one struct column, with n_lines, n_removed and kept_text."""
    gone = hash_side(removals(docs, doc_id, text, window))
    left = keyed(docs, doc_id, text)
    found = left.join(gone, (left[KEY] == gone["key"]) & left[ID].eqNullSafe(gone["id"]), "left")
    lines = F.split(blank("text"), "\n")
    split = found.select(ROW, blank("text"), F.col("gone").alias(GONE), F.when(F.col("gone").isNotNull(), lines).alias(LINES), F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(LINES) - 1), GONE), lambda i: F.get(F.col(LINES), i))
    return split.select(
        ROW,
        F.when(F.col(blank("text")).isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col(GONE).isNotNull(), F.size(GONE)), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col(GONE).isNull(), F.col(blank("text"))).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def rewrite(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their own columns, the text without the removed lines."""
    found = dedup(docs, text=text)
    return found.select(*[(F.col("kept_text") if name == text else F.col(ROW)[name]).alias(name) for name in docs.columns])


def op8_line_dedup(spark, sf_dir) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col(ROW)["doc_id"].alias("doc_id"), "n_lines", "n_removed", F.col("kept_text").alias("text"))


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents),
norm AS (
  SELECT doc_id, i, trim(regexp_replace(lower(line), '[ \t\x0b\f\r]+', ' ', 'g')) AS line FROM lines),
full_lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM norm WHERE line <> ''),
win AS (
  SELECT doc_id, k, i AS i0, lead(i, 1) OVER w AS i1, lead(i, 2) OVER w AS i2,
         line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS body
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
occ AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS nth FROM win WHERE i2 IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest([i0, i1, i2]) AS i FROM occ WHERE nth > 1),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         string_agg(CASE WHEN g.i IS NULL THEN l.line END, chr(10) ORDER BY l.i) AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
