"""Queries of the scalar rules over marked document lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import text as T
from lamina.sources.adapters import MARKED_LINES_SQL, marked_lines

LINES = f"WITH l AS ({MARKED_LINES_SQL})"
S = r"[\s\p{Z}]"


def _over_lines(**columns):
    def query(spark, sf_dir):
        return marked_lines(spark, sf_dir).select("doc_id", "pos", *[make(F.col("text")).alias(name) for name, make in columns.items()])

    return query


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


def sql_key(x: str) -> str:
    source, target = T.DOTS + T.DASHES + T.TILDES + T.QUOTES, "·" * len(T.DOTS) + "-" * len(T.DASHES) + "~" * len(T.TILDES)
    return f"translate(regexp_replace({x}, '{S}+', '', 'g'), '{source.replace(chr(39), chr(39) * 2)}', '{target}')"


def split_numbering(spark, sf_dir):
    found = marked_lines(spark, sf_dir).select("doc_id", "pos", T.split_numbering(F.col("text")).alias("s"))
    return found.select("doc_id", "pos", "s.numbering", "s.title")


NUMBERED = rf"""
n AS (SELECT *, {sql_strip("text")} AS w, regexp_extract({sql_strip("text")}, '^[{T.DIGITS}{T.ROMANS}.\-·]+') AS p FROM l),
m AS (SELECT *, substring(w, length(p) + 1) AS rest FROM n),
s AS (SELECT *, p <> '' AND regexp_matches(p, '[{T.DIGITS}{T.ROMANS}]') AND (rest = '' OR regexp_matches(rest, '^{S}') OR suffix(p, '.')) AS good FROM m),
k AS (SELECT doc_id, pos, text, CASE WHEN good THEN nullif(rtrim(p, '.'), '') END AS numbering, CASE WHEN good THEN {sql_strip("rest")} ELSE w END AS title FROM s)"""


def anchor_levels(spark, sf_dir):
    found = split_numbering(spark, sf_dir).select("doc_id", "pos", "numbering", F.coalesce(T.anchor_level(F.col("numbering")), F.lit(-1)).cast("long").alias("level"))
    return found.where("numbering is not null")


def strip_page(spark, sf_dir):
    return marked_lines(spark, sf_dir).select("doc_id", "pos", T.strip_page(F.col("text")).alias("s")).select("doc_id", "pos", "s.title", "s.page")


PAGE = rf"^(.*[^{T.LEADERS}])?([{T.LEADERS}]{{2,}})([{T.DIGITS}]+)$"


def toc_lines(spark, sf_dir):
    """Page, numbering, title and key of each line read as a line of a table of contents."""
    paged = marked_lines(spark, sf_dir).select("doc_id", "pos", T.strip_page(F.col("text")).alias("p"))
    split = paged.select("doc_id", "pos", "p.page", T.split_numbering(F.col("p.title")).alias("s"))
    return split.select("doc_id", "pos", "page", "s.numbering", "s.title", T.title_key(F.col("s.title")).alias("title_key"))


def outlines(spark, sf_dir):
    return marked_lines(spark, sf_dir).select("doc_id", "pos", T.outline(F.col("text")).alias("o")).where("o.family is not null").select("doc_id", "pos", "o.family", "o.key", F.col("o.level").cast("long").alias("level"))


ROMAN, NUMBER = rf"^[{T.OUTLINE_ROMANS}]+\s*-\s*[0-9]+", r"^([0-9]+(?:[.\-][0-9]+)*)\.?(?:\s|$)"


def ordinals(spark, sf_dir):
    return marked_lines(spark, sf_dir).select("doc_id", "pos", T.ordinal(F.col("text")).alias("o")).where("o.family is not null").select("doc_id", "pos", "o.family", F.col("o.place").cast("long").alias("place"))


def marks(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


PAGED = rf"""
p0 AS (SELECT *, regexp_replace(text, '{S}+$', '') AS plain, contains(text, chr(9)) AS tabbed FROM l),
p AS (SELECT doc_id, pos,
  CASE WHEN tabbed THEN regexp_replace(regexp_replace(text, '\t[^\t]*$', ''), '{S}+$', '') WHEN regexp_matches(plain, '{PAGE}') THEN regexp_replace(regexp_extract(plain, '{PAGE}', 1), '{S}+$', '') ELSE plain END AS title,
  CASE WHEN tabbed THEN nullif({sql_strip("regexp_extract(text, '" + chr(92) + "t([^" + chr(92) + "t]*)$', 1)")}, '') WHEN regexp_matches(plain, '{PAGE}') THEN regexp_extract(plain, '{PAGE}', 3) END AS page
FROM p0)"""

QUERIES = {
    "normalize_text": _over_lines(normal=T.collapse, bare=T.without_space),
    "title_key": _over_lines(title_key=T.title_key, without_digits=lambda c: T.without_digits(T.title_key(c))),
    "split_numbering": split_numbering,
    "anchor_levels": anchor_levels,
    "strip_page": strip_page,
    "toc_lines": toc_lines,
    "outline_parse": outlines,
    "ordinal_parse": ordinals,
    "marker_class": _over_lines(marker=T.marker_class, level=lambda c: F.coalesce(T.marker_level(c), F.lit(-1)).cast("long")),
    "indent_units": _over_lines(units=lambda c: T.leading_units(c).cast("long")),
}
ORACLES = {
    "normalize_text": f"{LINES} SELECT doc_id, pos, trim(regexp_replace(text, '{S}+', ' ', 'g')) AS normal, regexp_replace(text, '{S}+', '', 'g') AS bare FROM l",
    "title_key": f"{LINES} SELECT doc_id, pos, {sql_key('text')} AS title_key, regexp_replace({sql_key('text')}, '[{T.DIGITS}]', '', 'g') AS without_digits FROM l",
    "split_numbering": f"{LINES}, {NUMBERED} SELECT doc_id, pos, numbering, title FROM k",
    "anchor_levels": rf"""{LINES}, {NUMBERED},
a AS (SELECT *, list_filter(string_split(replace(numbering, '-', '.'), '.'), lambda x: x <> '') AS parts FROM k WHERE numbering IS NOT NULL)
SELECT doc_id, pos, numbering, CASE WHEN len(parts) > 0 AND len(list_filter(parts, lambda x: NOT regexp_full_match(x, '[{T.DIGITS}]+'))) = 0 THEN len(parts) - 1 ELSE -1 END AS level FROM a""",
    "strip_page": f"{LINES}, {PAGED} SELECT doc_id, pos, title, page FROM p",
    "toc_lines": f"""{LINES}, {PAGED}, {NUMBERED.replace("FROM l)", "FROM (SELECT doc_id, pos, page, title AS text FROM p))").replace("SELECT doc_id, pos, text, CASE", "SELECT doc_id, pos, page, CASE")}
SELECT doc_id, pos, page, numbering, title, {sql_key("title")} AS title_key FROM k""",
    "outline_parse": rf"""{LINES}, w AS (SELECT *, {sql_strip("text")} AS w FROM l), f AS (SELECT *, regexp_matches(w, '{ROMAN}') AS is_roman, regexp_matches(w, '{NUMBER}') AS is_number FROM w)
SELECT doc_id, pos, CASE WHEN is_roman THEN 'roman_dash' ELSE 'numeric' END AS family,
  CASE WHEN is_roman THEN replace(regexp_extract(w, '{ROMAN}'), ' ', '') ELSE regexp_extract(w, '{NUMBER}', 1) END AS key,
  CAST(CASE WHEN is_roman THEN 1 ELSE len(string_split_regex(regexp_extract(w, '{NUMBER}', 1), '[.\-]')) END AS BIGINT) AS level
FROM f WHERE is_roman OR is_number""",
    "ordinal_parse": rf"""{LINES}, w AS (SELECT *, {sql_strip("text")} AS w FROM l),
o AS (SELECT doc_id, pos, CASE WHEN regexp_matches(w, '^([가-하])[.)]\s') THEN CASE WHEN instr('{T.HANGUL_ORDINALS}', w[1]) > 0 THEN 'hangul' END
    WHEN regexp_matches(w, '^([0-9]{{1,2}})[.)]\s') THEN 'digit' WHEN w <> '' AND instr('{T.CIRCLED_ORDINALS}', w[1]) > 0 THEN 'circled' END AS family, w FROM w)
SELECT doc_id, pos, family, CAST(CASE family WHEN 'hangul' THEN instr('{T.HANGUL_ORDINALS}', w[1]) - 1 WHEN 'digit' THEN CAST(regexp_extract(w, '^([0-9]+)', 1) AS INT)
  ELSE instr('{T.CIRCLED_ORDINALS}', w[1]) - 1 END AS BIGINT) AS place FROM o WHERE family IS NOT NULL""",
    "marker_class": rf"""{LINES}, w AS (SELECT *, {sql_strip("text")} AS w FROM l)
SELECT doc_id, pos, CASE WHEN w[1] IN {marks(T.ANNOTATION_MARKS)} THEN 'annotation' WHEN w[1] IN {marks(T.DASH_MARKS)} THEN 'dash' WHEN w[1] IN {marks(T.DOT_MARKS)} THEN 'dot' END AS marker,
  CAST(CASE w[1] {" ".join(f"WHEN '{m}' THEN {n}" for m, n in T.MARKER_LEVELS)} ELSE CASE WHEN regexp_matches(w, '^[가-힣]\.\s') THEN 2 ELSE -1 END END AS BIGINT) AS level FROM w""",
    "indent_units": f"""{LINES}, w AS (SELECT *, regexp_extract(text, '^[ \t　]*') AS lead FROM l)
SELECT doc_id, pos, CAST((length(lead) - length(replace(lead, ' ', '')) + 4 * (length(lead) - length(replace(lead, chr(9), ''))) + 2 * (length(lead) - length(replace(lead, '　', '')))) * {T.LEADING_UNIT} AS BIGINT) AS units FROM w""",
}
