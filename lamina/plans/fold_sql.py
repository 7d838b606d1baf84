"""The passes over blocks as recursive SQL: each takes the blocks of all documents one place at a time, with a state.

The operators state the same rules as relations; here they are walked through block by block.
"""

from __future__ import annotations

from lamina.functions import text as T
from lamina.operators.folds import FAMILIES, LOOSE_KEY, TOLERANCE
from lamina.plans.block_queries import DEEP
from lamina.plans.text_queries import NUMBER, ROMAN, marks, sql_key, sql_strip
from lamina.sources.adapters import PREFIXES, quoted

PREPARED = rf"""{DEEP.replace("WITH b AS", "WITH RECURSIVE b AS", 1)},
md AS (SELECT *, {quoted(PREFIXES)}[(doc_id * 7 + ord) % {len(PREFIXES)} + 1] || text AS t, doc_id * 7 + ord AS key7 FROM deep),
mw AS (SELECT *, {sql_strip("t")} AS w, regexp_extract(t, '^[ \t　]*') AS lead_ FROM md),
p0 AS MATERIALIZED (SELECT doc_id, ord, section, block_type, band, role, depth, '' AS reason, block_type = 'table' AND key7 % 2 = 1 AS box,
  block_type NOT IN ('control', 'section_control') AND band <> 'peripheral' AS flow, role = 'section_heading' AS head,
  CASE WHEN regexp_matches(w, '{ROMAN}') THEN 'roman_dash' WHEN regexp_matches(w, '{NUMBER}') THEN 'numeric' END AS ofam,
  CASE WHEN regexp_matches(w, '{ROMAN}') THEN 1 WHEN regexp_matches(w, '{NUMBER}') THEN len(string_split_regex(regexp_extract(w, '{NUMBER}', 1), '[.\-]')) END AS olev,
  coalesce(CASE WHEN numbering_level >= 1 THEN numbering_level END, CASE WHEN native_level >= 1 THEN native_level END,
    CASE w[1] {" ".join(f"WHEN '{m}' THEN {n}" for m, n in T.MARKER_LEVELS)} ELSE CASE WHEN regexp_matches(w, '^[가-힣]\.\s') THEN 2 END END) AS rel,
  CASE WHEN regexp_matches(w, '^([가-하])[.)]\s') THEN CASE WHEN instr('{T.HANGUL_ORDINALS}', w[1]) > 0 THEN 'hangul' END
    WHEN regexp_matches(w, '^([0-9]{{1,2}})[.)]\s') THEN 'digit' WHEN w <> '' AND instr('{T.CIRCLED_ORDINALS}', w[1]) > 0 THEN 'circled' END AS fam,
  CASE WHEN regexp_matches(w, '^([가-하])[.)]\s') THEN instr('{T.HANGUL_ORDINALS}', w[1]) - 1 WHEN regexp_matches(w, '^([0-9]{{1,2}})[.)]\s') THEN CAST(regexp_extract(w, '^([0-9]+)', 1) AS INT)
    WHEN w <> '' THEN instr('{T.CIRCLED_ORDINALS}', w[1]) - 1 END AS place,
  CASE WHEN block_type <> 'paragraph' THEN NULL WHEN w[1] IN {marks(T.ANNOTATION_MARKS)} THEN 'annotation' WHEN w[1] IN {marks(T.DASH_MARKS)} THEN 'dash' WHEN w[1] IN {marks(T.DOT_MARKS)} THEN 'dot' END AS mark,
  key7 % 3 * 60 + (length(lead_) - length(replace(lead_, ' ', '')) + 4 * (length(lead_) - length(replace(lead_, chr(9), ''))) + 2 * (length(lead_) - length(replace(lead_, '　', '')))) * {T.LEADING_UNIT} AS indent,
  row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS n FROM mw)"""
#: What a pass hands on besides depth and reason.
KEPT = "doc_id, n, ord, section, block_type, band, role, box, flow, head, ofam, olev, rel, fam, place, mark, indent"


def walk(name: str, source: str, state: dict[str, tuple[str, str]], depth: str, reason: str, steps: list[str]) -> str:
    """A pass: ``state`` is, by column, the value before the first block and after each; ``s`` holds the former, ``r`` the block.

    ``steps`` are columns, as SQL, each of which may read those before it; depth, reason and the states read all of them.
    """
    nested = "SELECT r.*, " + ", ".join(f"s.{c} AS s_{c}" for c in state) + f" FROM {name}_w s JOIN {source} r ON r.doc_id = s.doc_id AND r.n = s.n + 1"
    for step in steps:
        nested = f"SELECT *, {step} FROM ({nested})"
    after = ", ".join(f"{new} AS {c}" for c, (_, new) in state.items())
    first = ", ".join(f"{old} AS {c}" for c, (old, _) in state.items())
    return f""",
{name}_w AS (SELECT {KEPT.replace(" n,", " CAST(0 AS BIGINT) AS n,", 1)}, depth, reason, {first} FROM {source} WHERE n = 1
  UNION ALL SELECT {KEPT}, CAST({depth} AS BIGINT), {reason}, {after} FROM ({nested})),
{name} AS MATERIALIZED (SELECT {KEPT}, depth, reason FROM {name}_w WHERE n > 0)"""


NONE = "CAST(NULL AS BIGINT)"


def titles(name: str, source: str) -> str:
    """Numeric and roman outline depths of title boxes, learned from the first roots; no block is anchored here."""
    roman = "box AND ofam = 'roman_dash'"
    numeric = "box AND ofam = 'numeric' AND (s_num IS NOT NULL OR olev = 1)"
    return walk(
        name, source,
        {"num": (NONE, "CAST(num2 AS BIGINT)"), "rom": (NONE, "CAST(rom2 AS BIGINT)"), "delta": (NONE, "CAST(coalesce(new, depth) - depth AS BIGINT)")},
        "coalesce(new, depth)", "CASE WHEN new <> depth THEN 'title_outline' ELSE reason END",
        [
            f"CASE WHEN {roman} AND s_rom IS NULL THEN CASE WHEN s_num IS NULL THEN depth ELSE greatest(s_num - 1, 1) END ELSE s_rom END AS rom2",
            f"CASE WHEN {roman} THEN rom2 + 1 WHEN {numeric} THEN coalesce(s_num, depth) ELSE s_num END AS num2",
            f"CASE WHEN {roman} THEN rom2 WHEN {numeric} THEN num2 + olev - 1 END AS new",
        ],
    ).replace(f"SELECT {KEPT}, depth, reason FROM {name}_w", f"SELECT {KEPT}, depth, reason, delta FROM {name}_w")


def scopes(name: str, source: str) -> str:
    """Headings below the title of their scope, flow with its anchor; a scope outlives a section only before a marked heading."""
    return walk(
        name, source,
        {"sec": (NONE, "section"), "wait": ("false", "wait2"), "scope": (NONE, "CASE WHEN box THEN depth ELSE scope2 END"), "anchor": (NONE, "CAST(anchor3 AS BIGINT)"), "gap": ("CAST(0 AS BIGINT)", "CAST(gap3 AS BIGINT)")},
        "new", "CASE WHEN new = depth THEN reason WHEN head THEN 'heading_in_scope' WHEN depth + gap2 < anchor2 + 1 THEN 'flow_clamp' ELSE 'flow_shift' END",
        [
            "s_sec IS DISTINCT FROM section AS fresh, block_type NOT IN ('control', 'section_control', 'footer') AND role <> 'empty_paragraph' AND band <> 'peripheral' AS means",
            "(fresh OR s_wait) AND NOT means AS wait2, CASE WHEN fresh THEN NULL ELSE s_anchor END AS anchor2, CASE WHEN fresh THEN 0 ELSE s_gap END AS gap2",
            "CASE WHEN (fresh OR s_wait) AND means AND NOT box AND NOT (s_scope IS NOT NULL AND head AND rel IS NOT NULL) THEN NULL ELSE s_scope END AS scope2",
            "CASE WHEN box OR scope2 IS NULL THEN depth WHEN head THEN scope2 + coalesce(rel, 1) WHEN anchor2 IS NOT NULL AND flow THEN greatest(depth + gap2, anchor2 + 1) ELSE depth END AS new",
            "CASE WHEN box THEN depth WHEN scope2 IS NOT NULL AND head THEN new ELSE anchor2 END AS anchor3, CASE WHEN box THEN coalesce(delta, 0) WHEN scope2 IS NOT NULL AND head THEN new - depth ELSE gap2 END AS gap3",
        ],
    )


def ordinals(name: str, source: str) -> str:
    """The last place and the depth of each family's group, and what the flow below a moved ordinal goes with."""
    state = {}
    for f in FAMILIES:
        state[f"{f}_place"] = (NONE, f"CASE WHEN box THEN NULL WHEN joins AND fam = '{f}' THEN place WHEN shuts AND depth <= s_{f}_depth THEN NULL ELSE s_{f}_place END")
        state[f"{f}_depth"] = (NONE, f"CASE WHEN box THEN NULL WHEN joins AND fam = '{f}' THEN own WHEN shuts AND depth <= s_{f}_depth THEN NULL ELSE s_{f}_depth END")
    state |= {"old": (NONE, "CASE WHEN NOT flow THEN s_old WHEN joins THEN CASE WHEN own <> depth THEN depth END WHEN stops THEN NULL WHEN depth > s_old THEN s_old END"), "new": (NONE, "CASE WHEN NOT flow THEN s_new WHEN joins THEN own WHEN stops THEN NULL ELSE s_new END")}
    of = lambda what: "CASE fam " + " ".join(f"WHEN '{f}' THEN s_{f}_{what}" for f in FAMILIES) + " END"
    return walk(
        name, source, {k: (a, f"CAST({b} AS BIGINT)") for k, (a, b) in state.items()},
        "CASE WHEN joins THEN own WHEN below THEN greatest(depth + s_new - s_old, s_new + 1) ELSE depth END",
        "CASE WHEN joins AND own <> depth THEN 'ordinal_sibling' WHEN below AND greatest(depth + s_new - s_old, s_new + 1) <> depth THEN 'ordinal_flow' ELSE reason END",
        [
            "flow AND NOT box AND block_type = 'paragraph' AND fam IS NOT NULL AS joins, flow AND (box OR head OR fam IS NOT NULL) AS stops",
            "flow AND NOT box AND NOT joins AND head AS shuts, coalesce(flow AND NOT stops AND depth > s_old, false) AS below",
            f"CASE WHEN joins AND {of('place')} + 1 = place THEN {of('depth')} ELSE depth END AS own",
        ],
    )


def markers(name: str, source: str) -> str:
    """A stack of (indent, depth) of the markers of a part; what unmarked flow goes with."""
    stack = "CAST([] AS STRUCT(i BIGINT, d BIGINT)[])"
    return walk(
        name, source,
        {
            "sec": (NONE, "section"),
            "stack": (stack, f"CASE WHEN ends THEN {stack} WHEN is_mark AND NOT near THEN list_append(open_, {{'i': CAST(indent AS BIGINT), 'd': CAST(own AS BIGINT)}}) WHEN is_mark THEN open_ ELSE stack2 END"),
            "last": (NONE, "CAST(CASE WHEN ends THEN NULL WHEN is_mark THEN own ELSE last2 END AS BIGINT)"),
            "old": (NONE, "CAST(CASE WHEN ends THEN NULL WHEN is_mark OR is_note THEN CASE WHEN own <> depth THEN depth END WHEN NOT flow THEN old2 WHEN depth > old2 THEN old2 END AS BIGINT)"),
            "new": (NONE, "CAST(CASE WHEN is_mark OR is_note THEN own ELSE s_new END AS BIGINT)"),
        },
        "coalesce(own, below, depth)", "CASE WHEN coalesce(own, below, depth) = depth THEN reason WHEN is_mark THEN 'marker_indent' WHEN is_note THEN 'note_under_marker' ELSE 'marker_flow' END",
        [
            "s_sec IS DISTINCT FROM section AS fresh, flow AND (box OR head) AS ends",
            f"CASE WHEN fresh THEN {stack} ELSE s_stack END AS stack2, CASE WHEN fresh THEN NULL ELSE s_last END AS last2, CASE WHEN fresh THEN NULL ELSE s_old END AS old2, coalesce(flow AND NOT ends AND mark IN ('dash', 'dot'), false) AS is_mark",
            f"list_filter(stack2, lambda x: x.i <= indent + {TOLERANCE}) AS open_, coalesce(flow AND NOT ends AND mark = 'annotation', false) AND last2 IS NOT NULL AS is_note",
            f"coalesce(indent - open_[-1].i <= {TOLERANCE}, false) AS near",
            "CASE WHEN is_mark THEN CASE WHEN len(open_) = 0 THEN depth WHEN near THEN open_[-1].d ELSE open_[-1].d + 1 END WHEN is_note THEN last2 + 1 END AS own, CASE WHEN flow AND NOT ends AND mark IS NULL AND depth > old2 THEN greatest(depth + s_new - old2, s_new + 1) END AS below",
        ],
    )


def chained(*passes) -> str:
    sql, source = PREPARED, "p0"
    for k, one in enumerate(passes):
        sql += one(f"q{k}", source)
        source = f"q{k}"
    return f"{sql} SELECT doc_id, ord, depth, reason FROM {source}"


#: Contents entries, an entry at a time, with the place behind the last match.
MATCHED = rf"""WITH RECURSIVE lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS ord FROM documents),
b AS MATERIALIZED (SELECT doc_id, ord, key, regexp_replace(key, '[{T.DIGITS}]', '', 'g') AS loose FROM (SELECT doc_id, ord, {sql_key("line")} AS key FROM lines)),
e AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS n FROM b WHERE ord % 5 = 1),
w AS (SELECT DISTINCT doc_id, CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS entry, CAST(-1 AS BIGINT) AS cursor, CAST(NULL AS BIGINT) AS hit, '' AS method FROM e
  UNION ALL SELECT doc_id, n, entry, coalesce(exact, loosely, cursor), coalesce(exact, loosely), CASE WHEN exact IS NOT NULL THEN 'exact' ELSE 'without_digits' END FROM (
    SELECT w.doc_id, e.n, e.ord AS entry, w.cursor, min(CASE WHEN b.key = e.key THEN b.ord END) AS exact, min(CASE WHEN b.loose = e.loose AND length(e.loose) >= {LOOSE_KEY} THEN b.ord END) AS loosely
    FROM w JOIN e ON e.doc_id = w.doc_id AND e.n = w.n + 1 LEFT JOIN b ON b.doc_id = w.doc_id AND b.ord > w.cursor AND (b.key = e.key OR b.loose = e.loose) GROUP BY w.doc_id, e.n, e.ord, w.cursor))
SELECT doc_id, entry, hit AS ord, method FROM w WHERE hit IS NOT NULL"""

ORACLES = {
    "title_scope_depth": chained(titles, scopes),
    "ordinal_align": chained(ordinals),
    "marker_nesting": chained(markers),
    "corrected_depths": chained(titles, scopes, ordinals, markers),
    "toc_match": MATCHED,
}
