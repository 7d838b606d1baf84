"""Quality rules (op 10): text rules per document, and lines that too many documents of a host share.

Cross-document line frequency. Lines are normalised (lower case, white space collapsed) and hashed. For each
host (``source``) and line the distinct documents are counted, by a hash of the whole text, so exact copies
count once; the documents of the host are counted alike. A line is removed if it is in more than ``max_docs``
documents of the host and in more than ``max_share`` of them. A document is rejected if the rules of its own
text fail, or if it is depleted: under ``min_left`` of its words remain after the removal. Kept documents go on
without the removed lines.

Defined results: a null text has no words and fails the rules; null hosts are one host; equal rows get equal
verdicts; an empty table gives an empty result; all columns of the input stay, whatever their names.

Scale: one pass hashes lines and counts them with two pre-aggregated shuffles of 24-byte rows; hot lines and
hot hosts are combined on the map side. At most lines / (max_share * documents) lines of a host pass the
share, so the table of removed lines is about 1 / max_share * (lines per document) hashes a host; it is
counted and broadcast, or joined by shuffle beyond the bound. Texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import SPACE, blank, hashes_of, small, table, where_fenced, window_hashes, words_of

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_DOCS = 30
MAX_SHARE = 0.01
MIN_LEFT = 0.25

ROW, WORDS, HASHES, WINDOWS, LINES, HOST = (blank(x) for x in ("row", "words", "hashes", "windows", "lines", "host"))


def normal_lines(text: Column) -> Column:
    """Lines of a text in lower case, with white space collapsed; lines without a word are left out."""
    return F.filter(all_lines(text), lambda line: line != "")


def all_lines(text: Column) -> Column:
    """normal_lines with the lines without a word, in the places of the text's own lines."""
    flat = F.regexp_replace(F.lower(text), r"[ \t\x0b\f\r]{2,}|[\t\x0b\f\r]", " ")
    return F.transform(F.split(flat, "\n"), lambda line: F.btrim(line))


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs as one struct column, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    raw = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(raw, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    a = docs.select(F.struct("*").alias(ROW), raw.alias(blank("text")), words_of(F.col(text)).alias(WORDS), lines.alias(LINES))
    b = a.select(
        ROW,
        F.size(WORDS).cast("long").alias("n_words"),
        F.length(F.array_join(WORDS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(blank("text"), r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(LINES) - F.size(F.array_distinct(LINES))).cast("long").alias("n_dup_lines"),
        hashes_of(F.col(WORDS)).alias(HASHES),
    )
    c = b.withColumn(WINDOWS, window_hashes(F.col(HASHES), WINDOW)).drop(HASHES)
    # Only documents in which a window repeats need the positions.
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = F.sort_array(F.transform(F.col(WINDOWS), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = c.withColumn(blank("ordered"), F.when(F.size(F.array_distinct(WINDOWS)) < F.size(WINDOWS), ordered).otherwise(none)).drop(WINDOWS)
    o = F.col(blank("ordered"))
    same = lambda x, i: F.coalesce(F.get(o, i)["h"] == x["h"], F.lit(False))
    e = d.withColumn(
        blank("starts"),
        F.sort_array(F.transform(F.filter(o, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])),
    ).drop(blank("ordered"))
    s = F.col(blank("starts"))
    steps = F.transform(s, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - p, F.lit(WINDOW))))
    n_repeat = F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)
    f = e.withColumn("n_repeat_words", n_repeat).drop(blank("starts"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return f.withColumn("base_failed", failed)


def frequent_lines(docs: DataFrame, text: str, source: str, max_docs: int, max_share: float) -> DataFrame:
    """(host, lines): the hashes of the lines above the limits of each host that has any."""
    hosts = docs.select(F.xxhash64(F.col(source)).alias("host"), F.xxhash64(F.col(text)).alias("body"), F.transform(normal_lines(F.col(text)), lambda x: F.xxhash64(x)).alias("lines"))
    per_host = hosts.select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("n_docs"))
    rows = hosts.select("host", "body", F.explode(F.array_distinct("lines")).alias("line"))
    counted = rows.distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    above = counted.where(F.col("n") > max_docs).join(small(per_host), "host").where(F.col("n") > F.col("n_docs") * max_share)
    return above.groupBy("host").agg(F.collect_set("line").alias("lines"))


def judge(
    docs: DataFrame, text: str = "text", source: str = "source", max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT
) -> DataFrame:
    """docs as one struct column, with the figures of text_stats, n_removed_words, kept_text, and kept."""
    removed = small(frequent_lines(docs, text, source, max_docs, max_share))
    stats = text_stats(docs, text)
    row = F.col(ROW)
    joined = stats.withColumn(HOST, F.xxhash64(row[source])).join(removed.select(F.col("host").alias(HOST), F.col("lines").alias(LINES)), HOST, "left").drop(HOST)
    line_words = F.transform(
        normal_lines(row[text]),
        lambda x: F.struct(F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1).alias("n")),
    )
    gone = F.aggregate(
        F.when(F.col(LINES).isNull(), F.array().cast("array<struct<h:bigint,n:int>>")).otherwise(F.filter(line_words, lambda x: F.array_contains(F.col(LINES), x["h"]))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x["n"],
    )
    left_lines = F.zip_with(F.split(row[text], "\n"), all_lines(row[text]), lambda x, y: F.when(~F.array_contains(F.col(LINES), F.xxhash64(y)), x))
    kept_text = F.when(F.col(LINES).isNull(), row[text]).otherwise(F.array_join(left_lines, "\n"))
    counted = joined.withColumn("n_removed_words", gone).withColumn("kept_text", kept_text).drop(LINES)
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & (left < F.col("n_words") * min_left)
    return counted.withColumn("kept", ~F.col("base_failed") & ~depleted)


def keep(docs: DataFrame, **limits) -> DataFrame:
    """The documents that the rules keep, with their own columns, the text without the lines above the limits."""
    text = limits.get("text", "text")
    kept = where_fenced(judge(docs, **limits), F.col("kept"))
    return kept.select(*[(F.col("kept_text") if n == text else F.col(ROW)[n]).alias(n) for n in docs.columns])


def op10_quality_rules(spark, sf_dir) -> DataFrame:
    verdicts = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return verdicts.select(F.col(ROW)["doc_id"].alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce('t' || text, '') AS orig, coalesce(source, chr(0)) AS host, row_number() OVER () AS row_no FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines FROM d),
win AS (SELECT row_no, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS body FROM (SELECT row_no, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW})),
again AS (SELECT row_no, i FROM (SELECT *, count(*) OVER (PARTITION BY row_no, body) AS n FROM win) WHERE n > 1),
rep AS (SELECT row_no, count(DISTINCT p) AS n_repeat_words FROM (SELECT row_no, unnest(range(i, i + {WINDOW})) AS p FROM again) GROUP BY row_no),
l AS (SELECT row_no, host, unnest(list_filter(list_transform(string_split(regexp_replace(lower(text), '[ \t\x0b\f\r]+', ' ', 'g'), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')) AS line FROM w),
bodies AS (SELECT row_no, host, sha256(orig) AS body FROM d),
hosts AS (SELECT host, count(DISTINCT body) AS n_docs FROM bodies GROUP BY host),
above AS (SELECT l.host, l.line FROM l JOIN bodies b USING (row_no) JOIN hosts h ON h.host = l.host GROUP BY l.host, l.line, h.n_docs HAVING count(DISTINCT b.body) > {MAX_DOCS} AND count(DISTINCT b.body) > h.n_docs * {MAX_SHARE}),
gone AS (SELECT l.row_no, sum(len(string_split(l.line, ' '))) AS n FROM l JOIN above a ON a.host = l.host AND a.line = l.line GROUP BY l.row_no),
f AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN rep USING (row_no) LEFT JOIN gone USING (row_no)),
g AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND NOT (n_removed_words > 0 AND n_words - n_removed_words < n_words * {MIN_LEFT}) AS kept FROM g
"""
