"""Scalar rules on texts as Column expressions: white space, numbering, outlines, ordinals, markers, values.

White space is Unicode white space throughout (``(?U)\\s``). Null texts count as empty unless said otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.config import DEFAULT, Keywords

# Character classes and patterns of the rules.
QUOTES = "'‘’‚‛“”`´ʻʼ′″\""
DOTS = "․‧ㆍ•∙⋅・"
DASHES = "‐‑‒–—―⁃"
TILDES = "～∼〜"
LEADERS = " .…⋯·․‧"
ROMANS = "ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫIVX"
OUTLINE_ROMANS = "ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩIVX"
HANGUL_ORDINALS = "가나다라마바사아자차카타파하"
CIRCLED_ORDINALS = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮"
ANNOTATION_MARKS = ("*", "※")
DASH_MARKS = ("-", "–", "―", "—")
DOT_MARKS = ("·", "ㆍ", "‧", "•", "◦")
MARKER_LEVELS = (("□", 1), ("■", 1), ("○", 2), ("◦", 2), ("●", 2), ("-", 3), ("·", 3), ("ㆍ", 3))
LEADING_UNIT = 100
UNITS = r"(명|건|개|원|점|시간|회|위|억원|백만원|천원|%|％|배|일|년|월|주|시|분|초|㎡|km|kg|톤|권|매|팀|과목|학점|주차)"
PURE_NUMBER = r"^[0-9][0-9.,]*$"
NUMBER_WITH_UNIT = r"^[0-9][0-9.,]*\s*" + UNITS + "$"
PERCENT = r"^\(?[0-9][0-9.,]*\s*%\)?$"
ITEM_NUMBER = r"^[0-9Ⅰ-Ⅻ]+\s*[-·.]\s*[0-9]+([-·.][0-9]+)*$"
NEUTRAL = r"^[-–—.\s]*$"
NUMERIC = r"^[+-]?[0-9]{1,3}(,[0-9]{3})*(\.[0-9]+)?$|^[+-]?[0-9]+(\.[0-9]+)?$"
DATA = r"([0-9]{4}\s*[.\-/년]\s*[0-9]{1,2}|[0-9]{1,4}[.\-/][0-9]{1,2}([.\-/][0-9]{1,4})?|[0-9]+(\.[0-9]+)?\s*%|[0-9]+\s*(원|건|명|개))"
UNIT_VALUE = r"[0-9]+\s*(건|명|점|원|천원|만원|개|회|년|월|일)"
VALUE_MARKS = ("-", "O", "X", "o", "x", "△", "▲", "✓", "ㅇ", "ㅁ")
CODE = r"^[A-Za-z]{1,4}-?[0-9]{1,6}$"
DATE = r"^[0-9]{4}(\s*년)?$|^[0-9]{4}[.\-/][0-9]{1,2}([.\-/][0-9]{1,2})?$"
INDEX_HEADERS = ("번호", "순번", "No.", "No", "NO", "연번")
CODE_HEADERS = ("코드", "ID", "Code", "기호")
DATE_HEADERS = ("연도", "년도", "날짜", "일자", "기간")

#: Digits as a number in a heading may have them: decimal digits, and circled, raised and dotted ones.
DIGITS = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐"


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(text_of(c), r"(?U)^\s+|\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(text_of(c), r"(?U)\s+$", "")


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def collapse(c: Column) -> Column:
    """White space runs to one space, without any at the ends; texts of plain characters only, as most cells are, stand as they are."""
    text = text_of(c)
    spaced = ~is_ascii(text)
    for space in " \t\n\x0b\f\r":
        spaced = spaced | text.contains(space)
    return F.when(spaced, F.trim(F.regexp_replace(text, r"(?U)\s+", " "))).otherwise(text)


def without_space(c: Column) -> Column:
    return F.regexp_replace(text_of(c), r"(?U)\s+", "")


def or_null(c: Column) -> Column:
    return F.when(c != "", c)


def title_key(c: Column) -> Column:
    """A title for comparison: no white space or quotes; dots, dashes and tildes of one form."""
    source = DOTS + DASHES + TILDES + QUOTES
    return F.translate(without_space(c), source, "·" * len(DOTS) + "-" * len(DASHES) + "~" * len(TILDES))


def without_digits(key: Column) -> Column:
    return F.regexp_replace(text_of(key), f"[{DIGITS}]", "")


def split_numbering(c: Column) -> Column:
    """struct(numbering, title): a leading number of digits, roman digits and separators, and what follows."""
    whole = strip(c)
    prefix = F.regexp_extract(whole, rf"^[{DIGITS}{ROMANS}.\-·]+", 0)
    rest = F.substring(whole, F.length(prefix) + 1, F.length(whole))
    bounded = (rest == "") | rest.rlike(r"(?U)^\s") | prefix.endswith(".")
    good = (prefix != "") & prefix.rlike(f"[{DIGITS}{ROMANS}]") & bounded
    number = or_null(F.regexp_replace(prefix, r"\.+$", ""))
    return F.struct(F.when(good, number).alias("numbering"), F.when(good, strip(rest)).otherwise(whole).alias("title"))


def anchor_level(numbering: Column) -> Column:
    """Components of an all-digit number less one, or null."""
    parts = F.filter(F.split(F.regexp_replace(numbering, "-", "."), r"\."), lambda x: x != "")
    return F.when((F.size(parts) > 0) & F.forall(parts, lambda x: x.rlike(f"^[{DIGITS}]+$")), F.size(parts) - 1)


def strip_page(line: Column) -> Column:
    """struct(title, page): what follows the last tab, or end digits after two leaders or more."""
    text = text_of(line)
    tabbed = text.contains("\t")
    plain = rstrip(text)
    pattern = rf"^(.*[^{LEADERS}])?([{LEADERS}]{{2,}})([{DIGITS}]+)$"
    paged = plain.rlike(pattern)
    title = F.when(tabbed, rstrip(F.regexp_replace(text, r"\t[^\t]*$", ""))).when(paged, rstrip(F.regexp_extract(plain, pattern, 1))).otherwise(plain)
    page = F.when(tabbed, or_null(strip(F.regexp_extract(text, r"\t([^\t]*)$", 1)))).when(paged, F.regexp_extract(plain, pattern, 3))
    return F.struct(title.alias("title"), page.alias("page"))


def outline(c: Column) -> Column:
    """struct(family, key, level) of a numbered title, or a null family."""
    whole = strip(c)
    roman = rf"^[{OUTLINE_ROMANS}]+\s*-\s*[0-9]+"
    number = r"^([0-9]+(?:[.\-][0-9]+)*)\.?(?:\s|$)"
    is_roman, is_number = whole.rlike(roman), whole.rlike(number)
    key = F.when(is_roman, F.replace(F.regexp_extract(whole, roman, 0), F.lit(" "), F.lit(""))).when(is_number, F.regexp_extract(whole, number, 1))
    level = F.when(is_roman, 1).when(is_number, F.size(F.split(key, r"[.\-]")))
    return F.struct(F.when(is_roman, "roman_dash").when(is_number, "numeric").alias("family"), key.alias("key"), level.cast("int").alias("level"))


def ordinal(c: Column) -> Column:
    """struct(family, place) of a leading ordinal: Hangul letter, one or two digits, or a circled digit."""
    whole = strip(c)
    hangul, digit = r"^([가-하])[.)]\s", r"^([0-9]{1,2})[.)]\s"
    letter = F.instr(F.lit(HANGUL_ORDINALS), F.regexp_extract(whole, hangul, 1)) - 1
    circled = F.when(whole != "", F.instr(F.lit(CIRCLED_ORDINALS), F.substring(whole, 1, 1)) - 1).otherwise(-1)
    is_hangul, is_digit = whole.rlike(hangul), whole.rlike(digit)
    family = F.when(is_hangul, F.when(letter >= 0, "hangul")).when(is_digit, "digit").when(circled >= 0, "circled")
    place = F.when(is_hangul, F.when(letter >= 0, letter)).when(is_digit, F.regexp_extract(whole, digit, 1).cast("int")).when(circled >= 0, circled)
    return F.struct(family.alias("family"), place.cast("int").alias("place"))


def marker_class(c: Column) -> Column:
    first = F.substring(F.regexp_replace(text_of(c), r"(?U)^\s+", ""), 1, 1)
    return F.when(first.isin(*ANNOTATION_MARKS), "annotation").when(first.isin(*DASH_MARKS), "dash").when(first.isin(*DOT_MARKS), "dot")


def marker_level(c: Column) -> Column:
    """The level that a leading marker or Hangul item gives below its title, or null."""
    whole = strip(c)
    found = F.lit(None).cast("int")
    for mark, level in reversed(MARKER_LEVELS):
        found = F.when(whole.startswith(mark), level).otherwise(found)
    return F.coalesce(found, F.when(whole.rlike(r"^[가-힣]\.\s"), 2))


def leading_units(c: Column) -> Column:
    """Indent of leading white space: a space 1, a tab 4, an ideographic space 2 units."""
    lead = F.regexp_extract(text_of(c), "^[ \t　]*", 0)
    count = lambda ch: F.length(lead) - F.length(F.replace(lead, F.lit(ch), F.lit("")))
    return (count(" ") + 4 * count("\t") + 2 * count("　")) * LEADING_UNIT


def is_numeric_value(c: Column, clean: bool = False) -> Column:
    text = c if clean else strip(c)
    return ~text.rlike(NEUTRAL) & ~text.rlike(ITEM_NUMBER) & (text.rlike(PURE_NUMBER) | text.rlike(NUMBER_WITH_UNIT) | text.rlike(PERCENT))


def is_neutral(c: Column, clean: bool = False) -> Column:
    return (c if clean else strip(c)).rlike(NEUTRAL)


def is_serial(values: Column) -> Column:
    """Whether an array of texts is whole numbers from 0 or 1 on, each one more."""
    numbers = F.transform(values, lambda v: F.regexp_replace(v, ",", "").try_cast("bigint"))
    first = F.get(numbers, F.lit(0))
    steps = F.transform(numbers, lambda v, i: v == first + i)
    return (F.size(values) >= 2) & F.coalesce(first.isin(0, 1), F.lit(False)) & F.forall(steps, lambda x: F.coalesce(x, F.lit(False)))


# Rules of cell texts take them as they stand, or collapsed already (``clean``), so that a pass over many cells
# does not collapse each text once per rule.


def is_numeric_like(c: Column, clean: bool = False) -> Column:
    text = F.replace(c if clean else collapse(c), F.lit(" "), F.lit(""))
    return (text != "") & (text != "-") & text.rlike(NUMERIC)


def has_any(c: Column, words: tuple[str, ...]) -> Column:
    """Whether a text contains any of some words, as one alternation."""
    if not words:
        return F.lit(False)
    found = c.rlike("|".join(re.escape(w) for w in words))
    return found if any(w.isascii() for w in words) else ~is_ascii(c) & found


def is_label(c: Column, keywords: Keywords = DEFAULT, clean: bool = False) -> Column:
    """A short text with a label keyword, or of six characters at most without a space or a digit."""
    text = c if clean else collapse(c)
    return (text != "") & (F.length(text) <= 12) & (has_any(text, keywords.labels) | ((F.length(text) <= 6) & ~text.contains(" ") & ~text.rlike(f"[{DIGITS}]")))


def is_data_text(c: Column, clean: bool = False) -> Column:
    return (F.length(c) > 20) | c.rlike(DATA) | is_numeric_like(c, clean)


def is_value(c: Column, clean: bool = False) -> Column:
    text = c if clean else collapse(c)
    return (text != "") & (text.isin(*VALUE_MARKS) | text.rlike(DATA) | is_numeric_like(text, True) | text.rlike(UNIT_VALUE))


def is_column_label(c: Column, keywords: Keywords = DEFAULT, clean: bool = False) -> Column:
    text = c if clean else collapse(c)
    return (text != "") & (F.length(text) <= 15) & ~is_value(text, True) & (has_any(text, keywords.column_labels) | (~text.rlike(f"[{DIGITS}]") & (F.length(text) <= 12)))
