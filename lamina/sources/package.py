"""Packaged office documents (a zip of XML parts) as flat relations.

``read`` lists the parts of each package; ``sections`` parses every section once, in the workers, and yields
nodes, tables and cells in document order; ``styles`` gives the style dictionaries, ``info`` metadata and images.
Namespaces do not count, only local names. A package is the unit of memory. Nothing is unpacked to disk, so a
changed file can never be mistaken for an earlier one of the same name.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import PurePosixPath
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.runtime import ship

# Element names of the format.
SHAPES = frozenset({"rect", "ellipse", "polygon", "line", "arc", "curve", "connectLine", "textart"})
OBJECTS = frozenset({"tbl", "pic", "container", "ole", "equation", "chart", "video", "compose"})
PROMOTED = {"header": "header", "footer": "footer", "footNote": "footnote", "endNote": "endnote"}
INLINE = frozenset({"t", "compose", "tab", "lineBreak", "fwSpace"})
BOUNDARY = (OBJECTS | SHAPES | {"ctrl", "secPr"}) - {"compose"}
SPECIAL = {"lineBreak": "\n", "tab": "\t", "fwSpace": " "}
DRAWN = SHAPES | {"container", "pic", "ole", "equation", "chart", "video"}
CAPTION = r"^(표|그림|Figure|Table)\s*[\d\.\-]|^【.+】$|^\[.+\]$"
NOTE = r"^(주[):\s]|주석|※|\*\s)"
SOURCE = r"^(자료|출처|자료원)\s*[:：]"
IGNORE = r"^그림입니다\.|^원본 그림의|^묶음 개체"

RUNS = pa.list_(pa.struct([("char_pr", pa.string()), ("text", pa.string())]))
NODE = pa.struct(
    [
        ("ord", pa.int64()), ("paragraph_index", pa.int64()), ("node_type", pa.string()), ("object_type", pa.string()), ("source_path", pa.string()), ("anchor_path", pa.string()), ("text", pa.string()),
        ("para_pr", pa.string()), ("style_id", pa.string()), ("runs", RUNS), ("lines", pa.int64()), ("line_variation", pa.float64()), ("n_objects", pa.int64()), ("has_sec_pr", pa.bool_()),
        ("table_index", pa.int64()), ("xml_id", pa.string()), ("image_ref", pa.string()), ("width", pa.string()), ("height", pa.string()), ("inline", pa.bool_()), ("attrs", pa.map_(pa.string(), pa.string())),
        ("anchor_info", pa.map_(pa.string(), pa.string())), ("page_info", pa.map_(pa.string(), pa.string())), ("inner_objects", pa.map_(pa.string(), pa.int64())),
    ]
)
TABLE = pa.struct(
    [
        ("table_id", pa.string()), ("xml_id", pa.string()), ("table_index", pa.int64()), ("n_rows", pa.int64()), ("n_cols", pa.int64()), ("cell_spacing", pa.int64()), ("repeat_header", pa.bool_()), ("page_break", pa.bool_()),
        ("width", pa.int64()), ("height", pa.int64()), ("treat_as_char", pa.bool_()), ("parent_table_id", pa.string()), ("parent_cell_id", pa.string()), ("owner_control", pa.string()),
        ("caption_candidate", pa.string()), ("note_candidate", pa.string()), ("source_candidate", pa.string()),
    ]
)
PARAGRAPHS = pa.list_(pa.struct([("para_pr", pa.string()), ("style_id", pa.string()), ("text", pa.string()), ("runs", RUNS)]))
EXTRAS = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("text", pa.string())]))
CELL = pa.struct(
    [
        ("table_id", pa.string()), ("cell_id", pa.string()), ("cell_ord", pa.int64()), ("xml_row", pa.int64()), ("r", pa.int64()), ("c", pa.int64()), ("row_span", pa.int64()), ("col_span", pa.int64()),
        ("text", pa.string()), ("is_empty", pa.bool_()), ("header", pa.bool_()), ("vert_align", pa.string()), ("width", pa.int64()), ("height", pa.int64()), ("paragraphs", PARAGRAPHS),
        ("has_image", pa.bool_()), ("has_field", pa.bool_()), ("has_shape", pa.bool_()), ("extras", EXTRAS), ("nested", pa.list_(pa.string())),
    ]
)
PARSED = pa.schema([("path", pa.string()), ("section", pa.int64()), ("node", NODE), ("tbl", TABLE), ("cell", CELL)])
RUNS_SQL = "array<struct<char_pr:string,text:string>>"
NODE_SQL = (
    "struct<ord:bigint,paragraph_index:bigint,node_type:string,object_type:string,source_path:string,anchor_path:string,text:string,para_pr:string,style_id:string,"
    f"runs:{RUNS_SQL},lines:bigint,line_variation:double,n_objects:bigint,has_sec_pr:boolean,table_index:bigint,xml_id:string,image_ref:string,width:string,height:string,inline:boolean,attrs:map<string,string>,"
    "anchor_info:map<string,string>,page_info:map<string,string>,inner_objects:map<string,bigint>>"
)
TABLE_SQL = (
    "struct<table_id:string,xml_id:string,table_index:bigint,n_rows:bigint,n_cols:bigint,cell_spacing:bigint,repeat_header:boolean,page_break:boolean,width:bigint,height:bigint,treat_as_char:boolean,"
    "parent_table_id:string,parent_cell_id:string,owner_control:string,caption_candidate:string,note_candidate:string,source_candidate:string>"
)
CELL_SQL = (
    "struct<table_id:string,cell_id:string,cell_ord:bigint,xml_row:bigint,r:bigint,c:bigint,row_span:bigint,col_span:bigint,text:string,is_empty:boolean,header:boolean,vert_align:string,width:bigint,height:bigint,"
    f"paragraphs:array<struct<para_pr:string,style_id:string,text:string,runs:{RUNS_SQL}>>,has_image:boolean,has_field:boolean,has_shape:boolean,extras:array<struct<kind:string,ref:string,text:string>>,nested:array<string>>"
)
PARSED_SQL = f"path string, section bigint, node {NODE_SQL}, tbl {TABLE_SQL}, cell {CELL_SQL}"


def name_of(e) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def attrs_of(e) -> dict[str, str]:
    return {k.rpartition("}")[2]: v for k, v in e.attrib.items()} if e is not None else {}


def child(e, name: str):
    return next((x for x in e if name_of(x) == name), None)


def descendants(e, name: str, stop: frozenset = frozenset()) -> Iterator:
    for x in e:
        own = name_of(x)
        if own in stop:
            continue
        if own == name:
            yield x
        yield from descendants(x, name, stop)


def whole(value: str | None, default: int | None = None) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return default


def flag(value: str | None) -> bool:
    return value in ("1", "true", "True", "TRUE")


def collapse(text: str) -> str:
    return " ".join(text.split())


def inline_text(e) -> str:
    """Text of an inline element in order, breaks and tabs as characters, without that of objects in it."""
    name = name_of(e)
    if name in BOUNDARY:
        return ""
    if name == "compose":
        return attrs_of(e).get("composeText") or ""
    if name in SPECIAL:
        return SPECIAL[name]
    return (e.text or "") + "".join(inline_text(x) + (x.tail or "") for x in e)


def object_text(e) -> str:
    """Text of an object, without that of tables in it, its pieces joined by a space."""

    def pieces(x) -> Iterator[str]:
        name = name_of(x)
        if name == "compose":
            yield attrs_of(x).get("composeText") or ""
        elif name == "t":
            yield inline_text(x)
        elif name != "tbl":
            for y in x:
                yield from pieces(y)

    found = [attrs_of(e).get("composeText") or ""] if name_of(e) == "compose" else []
    return collapse(" ".join(p for p in [*found, *(p for x in e for p in pieces(x))] if p))


def placing(e) -> dict:
    """Whether an object stands in the line (null if it does not say), and its order, wrapping and offsets."""
    attrs, pos = attrs_of(e), attrs_of(child(e, "pos"))
    treat = pos.get("treatAsChar")
    own = {k: attrs.get(k) for k in ("zOrder", "textWrap", "textFlow")} | {k: pos.get(k) for k in ("horzOffset", "vertOffset")}
    return {"inline": None if treat is None else flag(treat), "anchor_info": [(k, v) for k, v in own.items() if v is not None]}


def page_of(page) -> list[tuple[str, str]]:
    """All properties of a page, those of its margin with ``margin.`` in front."""
    margin = child(page, "margin") if page is not None else None
    return [*attrs_of(page).items(), *((f"margin.{k}", v) for k, v in attrs_of(margin).items())]


def signed(value: str | None) -> int:
    v = whole(value, 0)
    return v - 2**32 if v >= 2**31 else v


def cell_text(e) -> str:
    """Text of a run in a cell; two or more drawn objects side by side are read by their place, top to bottom."""
    name = name_of(e)
    if name in ("tbl", "caption") or name in PROMOTED:
        return ""
    if name == "compose":
        return attrs_of(e).get("composeText") or ""
    out = (e.text or "") if name == "t" else SPECIAL.get(name, "")
    drawn = [x for x in e if name_of(x) in DRAWN]
    if len(drawn) < 2:
        return out + "".join(cell_text(x) + (x.tail or "") for x in e)
    place = lambda x: (lambda a: (signed(a.get("y")), signed(a.get("x"))))(attrs_of(child(x, "offset")))
    joined = " ".join(t for t in (cell_text(x).strip() for x in sorted(drawn, key=place)) if t)
    placed = False
    for x in e:
        if name_of(x) not in DRAWN:
            out += cell_text(x)
        elif not placed and joined:
            out += (" " if out and not out[-1].isspace() else "") + joined
            placed = True
        out += x.tail or ""
    return out


@dataclass
class Section:
    """The relations of one section's XML."""

    path: str
    index: int
    file: str
    nodes: list[dict] = field(default_factory=list)
    tables: list[dict] = field(default_factory=list)
    cells: list[dict] = field(default_factory=list)

    def parse(self, xml: bytes) -> Section:
        root = ElementTree.fromstring(xml)
        self.order_tables(root)
        at = -1
        for e in root:
            if name_of(e) != "p":
                self.node("unknown_object", e, None, object_type=name_of(e))
                continue
            at += 1
            self.paragraph(e, at)
        return self

    # Nodes in reading order.

    def node(self, kind: str, e, at: int | None, **columns) -> str:
        where = f"Contents/{self.file}#" + (f"hp:p[{at}]" if at is not None else "root") + (f"/hp:{name_of(e)}" if kind != "paragraph" else "")
        self.nodes.append({"ord": len(self.nodes), "paragraph_index": at, "node_type": kind, "source_path": where, "attrs": list(attrs_of(e).items())} | columns)
        return where

    def paragraph(self, p, at: int) -> None:
        attrs, runs, objects, lines = attrs_of(p), [], [], [set()]
        text = ""
        full = [False]
        for run in (x for x in p if name_of(x) == "run"):
            char, own = attrs_of(run).get("charPrIDRef"), ""
            for x in run:
                if name_of(x) in INLINE:
                    piece = inline_text(x)
                    for i, part in enumerate(piece.split("\n")):
                        if i:
                            lines.append(set())
                            full.append(False)
                        if part.strip():
                            full[-1] = True
                            if char is not None:
                                lines[-1].add(char)
                    own += piece
                elif name_of(x) in BOUNDARY:
                    objects.append(x)
            text += own
            if char is not None:
                runs.append({"char_pr": char, "text": own})
        filled = [frozenset(s) for s, f in zip(lines, full, strict=True) if f]
        variation = round((len(set(filled)) - 1) / (len(filled) - 1), 2) if len(lines) > 1 and len(filled) > 1 else None
        where = self.node(
            "paragraph", p, at, text=text, para_pr=attrs.get("paraPrIDRef"), style_id=attrs.get("styleIDRef"), runs=runs, lines=len(lines), line_variation=variation, n_objects=len(objects), has_sec_pr=any(name_of(o) == "secPr" for o in objects)
        )
        for o in objects:
            self.object(o, at, where)

    def object(self, e, at: int, above: str) -> None:
        name, attrs = name_of(e), attrs_of(e)
        base = {"anchor_path": above} | placing(e)
        size = next((s for tag in ("sz", "curSz", "orgSz") if (s := child(e, tag)) is not None), None)
        sized = {"width": attrs_of(size).get("width"), "height": attrs_of(size).get("height")}
        if name == "ctrl":
            for x in e:
                kind, own = PROMOTED.get(name_of(x)), {"anchor_path": above} | placing(x)
                if kind:
                    self.node(kind, x, at, text=collapse("".join(x.itertext())), **own)
                else:
                    self.node("control", x, at, object_type=name_of(x), **own)
            return
        if name == "secPr":
            page = next(descendants(e, "pagePr"), None)
            self.node("section_control", e, at, **base, width=attrs_of(page).get("width"), height=attrs_of(page).get("height"), page_info=page_of(page))
        elif name == "tbl":
            self.node("table", e, at, **base, xml_id=attrs.get("id"), table_index=self.table_index.get(e))
        elif name == "pic":
            image = next((a for x in descendants(e, "img", frozenset({"tbl"})) if (a := attrs_of(x).get("binaryItemIDRef"))), None)
            self.node("image", e, at, **base, **sized, image_ref=image)
        elif name == "container":
            inner = Counter(n for x in e.iter() if x is not e and (n := name_of(x)) in OBJECTS | SHAPES)
            self.node("shape_group", e, at, **base, text=object_text(e), inner_objects=list(inner.items()))
        elif name in SHAPES:
            self.node("shape", e, at, **base, **sized, object_type=name, text=object_text(e))
        else:
            self.node("unknown_object", e, at, **base, object_type=name, text=object_text(e) if name in OBJECTS else None)
            return
        for caption in (x for x in e if name_of(x) == "caption"):
            self.node("caption", caption, at, text=collapse("".join(caption.itertext())), anchor_path=above)

    # Tables and cells.

    def order_tables(self, root) -> None:
        self.table_index: dict = {}
        siblings = list(root)

        def walk(e, owner: str | None, top: int) -> None:
            for x in e:
                name = name_of(x)
                if name == "tbl":
                    self.table_index[x] = len(self.table_index)
                    self.table(x, self.table_index[x], None, None, owner, self.near(siblings, top))
                else:
                    walk(x, PROMOTED.get(name, owner), top)

        for i, e in enumerate(siblings):
            if name_of(e) == "tbl":
                self.table_index[e] = len(self.table_index)
                self.table(e, self.table_index[e], None, None, None, {})
            else:
                walk(e, None, i)

    def near(self, siblings: list, at: int) -> dict[str, str]:
        """Caption, note and source candidates among the neighbours of the paragraph that holds a table."""
        if name_of(siblings[at]) != "p":
            return {}
        text = lambda i: " ".join(t for x in siblings[i].iter() if (t := (x.text or "").strip())) if 0 <= i < len(siblings) else ""
        before, after, second = text(at - 1), text(at + 1), text(at + 2)
        before, after = ("" if re.match(IGNORE, t) else t for t in (before, after))
        found = {}
        if re.match(CAPTION, before):
            found["caption_candidate"] = before
        if re.match(NOTE, after):
            found["note_candidate"] = after
        elif re.match(SOURCE, after):
            found["source_candidate"] = after
        if re.match(SOURCE, second):
            found.setdefault("source_candidate", second)
        return found

    def table(self, e, index: int, parent: str | None, cell: str | None, owner: str | None, near: dict) -> str:
        attrs, size, pos = attrs_of(e), attrs_of(child(e, "sz")), attrs_of(child(e, "pos"))
        tail = f"_{attrs['id']}" if attrs.get("id") else ""
        table_id = f"section{self.index}_tbl{index}{tail}" if cell is None else f"{cell}_nested_tbl{index}{tail}"
        self.tables.append(
            {
                "table_id": table_id, "xml_id": attrs.get("id"), "table_index": index, "n_rows": whole(attrs.get("rowCnt"), 0), "n_cols": whole(attrs.get("colCnt"), 0), "cell_spacing": whole(attrs.get("cellSpacing")),
                "repeat_header": flag(attrs.get("repeatHeader")), "page_break": attrs.get("pageBreak") not in (None, "0", "NONE", "None"), "width": whole(size.get("width")), "height": whole(size.get("height")),
                "treat_as_char": flag(pos["treatAsChar"]) if "treatAsChar" in pos else None, "parent_table_id": parent, "parent_cell_id": cell, "owner_control": owner,
            } | near
        )
        ord_ = 0
        for row, tr in enumerate(x for x in e if name_of(x) == "tr"):
            for i, tc in enumerate(x for x in tr if name_of(x) == "tc"):
                self.cell(tc, table_id, row, i, ord_)
                ord_ += 1
        return table_id

    def cell(self, tc, table_id: str, row: int, index: int, ord_: int) -> None:
        attrs, addr, span, size, sub = attrs_of(tc), attrs_of(child(tc, "cellAddr")), attrs_of(child(tc, "cellSpan")), attrs_of(child(tc, "cellSz")), child(tc, "subList")
        r, c = whole(addr.get("rowAddr")), whole(addr.get("colAddr"))
        cell_id = f"{table_id}_r{r}_c{c}" if r is not None and c is not None else f"{table_id}_cell{index}"
        paragraphs, kinds = [], set()
        for p in (x for x in (sub if sub is not None else ()) if name_of(x) == "p"):
            runs = [{"char_pr": attrs_of(x).get("charPrIDRef"), "text": cell_text(x)} for x in p if name_of(x) == "run"]
            kinds |= {name_of(y) for x in p if name_of(x) == "run" for y in x.iter()}
            own = attrs_of(p)
            paragraphs.append({"para_pr": own.get("paraPrIDRef"), "style_id": own.get("styleIDRef"), "text": "".join(x["text"] for x in runs), "runs": runs})
        text = "\n".join(p["text"] for p in paragraphs if p["text"])
        extras, nested = [], []
        self.inside(tc, None, None, extras, nested)
        images = {x["ref"]: x for x in extras if x["kind"] == "image" and x["ref"] is not None}
        extras = [x for x in extras if x["kind"] != "image" or x["ref"] is None or images.pop(x["ref"], None) is not None]
        at = len(self.cells)
        self.cells.append({})
        ids = [self.table(x, i, table_id, cell_id, owner, {}) for i, (x, owner) in enumerate(nested)]
        self.cells[at] = {
            "table_id": table_id, "cell_id": cell_id, "cell_ord": ord_, "xml_row": row, "r": r, "c": c, "row_span": whole(span.get("rowSpan"), 1), "col_span": whole(span.get("colSpan"), 1), "text": text, "is_empty": not text.strip(),
            "header": flag(attrs.get("header")), "vert_align": attrs_of(sub).get("vertAlign"), "width": whole(size.get("width")), "height": whole(size.get("height")), "paragraphs": paragraphs,
            "has_image": any(x["kind"] == "image" for x in extras), "has_field": bool(kinds & {"fieldBegin", "fieldEnd"}), "has_shape": bool(kinds & {"rect", "ellipse", "container"}), "extras": extras, "nested": ids,
        }

    def inside(self, e, owner: str | None, image: str | None, extras: list, nested: list) -> None:
        """Images, drawn objects, captions, controls and nested tables of a cell, none of them inside a nested table."""
        for x in e:
            name = name_of(x)
            if name == "tbl":
                nested.append((x, owner))
            elif name == "caption":
                extras.append({"kind": "caption", "ref": image, "text": collapse(cell_words(x))})
            elif name in PROMOTED:
                extras.append({"kind": PROMOTED[name], "ref": None, "text": collapse("".join(x.itertext()))})
                self.inside(x, PROMOTED[name], image, [], nested)
            elif name == "pic":
                ref = next((a for y in descendants(x, "img", frozenset({"tbl"})) if (a := attrs_of(y).get("binaryItemIDRef"))), None)
                extras.append({"kind": "image", "ref": ref, "text": None})
                self.inside(x, owner, ref, extras, nested)
            else:
                if name in DRAWN:
                    extras.append({"kind": name, "ref": None, "text": object_text(x)})
                self.inside(x, owner, image, extras, nested)

    def rows(self) -> list[dict]:
        base = {"path": self.path, "section": self.index, "node": None, "tbl": None, "cell": None}
        return [base | {"node": n} for n in self.nodes] + [base | {"tbl": t} for t in self.tables] + [base | {"cell": c} for c in self.cells]


def cell_words(e) -> str:
    return " ".join("".join(x.itertext()) for x in e) or (e.text or "")


# Parts of packages.


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = []
            with zipfile.ZipFile(io.BytesIO(content)) as package:
                for entry in package.infolist():
                    if not entry.is_dir():
                        body = package.read(entry) if entry.filename.lower().endswith((".xml", ".hpf")) else None
                        rows.append({"path": path, "part": entry.filename, "size": entry.file_size, "content": body})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("part", pa.string()), ("size", pa.int64()), ("content", pa.binary())]))


PARTS_SQL = "path string, part string, size bigint, content binary"


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, part, size, content): the parts of all packages under a path; the content of XML parts."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{hwpx,zip}").load(path)
    return parts_of(files)


def parts_of(files: DataFrame) -> DataFrame:
    ship(files.sparkSession)
    return files.select("path", "content").mapInArrow(_parts, PARTS_SQL)


def section_parts(parts: DataFrame) -> DataFrame:
    """(path, part, section, content): the section parts beside the topmost content.hpf, numbered by the digits in their names."""
    depth = F.size(F.split("part", "/"))
    homes = parts.where("part LIKE '%content.hpf'").groupBy("path").agg(F.min_by(F.regexp_replace("part", "[^/]*$", ""), depth).alias("home"))
    stem = F.regexp_extract("part", r"(section[^/]*)\.xml$", 1)
    digits = F.regexp_replace(stem, r"\D", "")
    own = parts.where(F.col("part").rlike(r"(^|/)section[^/]*\.xml$")).join(homes, "path", "left").where("home IS NULL OR startswith(part, home)")
    order = Window.partitionBy("path").orderBy(F.when(digits == "", F.lit(10**9)).otherwise(digits.cast("bigint")), stem)
    return own.select("path", "part", (F.row_number().over(order) - 1).cast("long").alias("section"), "content")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            parsed = Section(row["path"], row["section"], PurePosixPath(row["part"]).name).parse(row["content"])
            yield pa.RecordBatch.from_pylist(parsed.rows(), schema=PARSED)


def sections(parts: DataFrame) -> DataFrame:
    """Rows of nodes, tables and cells of every section, one of the three columns filled; parse once, then select."""
    return section_parts(parts).select("path", "part", "section", "content").mapInArrow(_parse, PARSED_SQL)


def nodes(parsed: DataFrame) -> DataFrame:
    """Nodes with ``ord`` over the whole document."""
    own = parsed.where("node IS NOT NULL").select("path", "section", "node.*")
    return own.withColumn("ord", F.row_number().over(Window.partitionBy("path").orderBy("section", "ord")).cast("long") - 1)


def tables(parsed: DataFrame) -> DataFrame:
    return parsed.where("tbl IS NOT NULL").select("path", "section", "tbl.*")


def cells(parsed: DataFrame) -> DataFrame:
    return parsed.where("cell IS NOT NULL").select("path", "section", "cell.*")


STYLE = pa.schema([(n, pa.string()) for n in ("path", "kind", "id", "name", "heading_type", "id_ref", "para_pr", "char_pr", "align", "text", "format")] + [(n, pa.int64()) for n in ("level", "height", "indent", "margin_left", "start")] + [("bold", pa.bool_())])
STYLE_SQL = ", ".join(f"{f.name} {'bigint' if f.type == pa.int64() else 'boolean' if f.type == pa.bool_() else 'string'}" for f in STYLE)


#: The entries of the style dictionaries by the names of their elements.
ENTRIES = {"paraPr": "para_pr", "charPr": "char_pr", "style": "style", "bullet": "bullet", "numbering": "numbering"}


def header_rows(path: str, xml: bytes) -> list[dict]:
    """Rows of the style dictionaries: para_pr, char_pr, style, bullet, numbering."""
    out = []
    for e in ElementTree.fromstring(xml).iter():
        name, attrs = name_of(e), attrs_of(e)
        if attrs.get("id") is None:
            continue
        row = {"path": path, "id": attrs["id"]}
        first = lambda tag, e=e: attrs_of(next(descendants(e, tag), None))
        if name == "paraPr":
            heads = [attrs_of(x) for x in e.iter() if name_of(x) in ("heading", "headingInfo", "outline") and x is not e]
            level = next((whole(h["level"]) for h in heads if "level" in h), None)
            head = heads[0] if heads else {}
            out.append(row | {"kind": "para_pr", "heading_type": head.get("type"), "id_ref": head.get("idRef"), "level": level, "align": first("align").get("horizontal"), "indent": whole(first("intent").get("value")), "margin_left": whole(first("left").get("value"))})
        elif name == "charPr":
            out.append(row | {"kind": "char_pr", "height": whole(attrs.get("height")), "bold": child(e, "bold") is not None})
        elif name == "style":
            out.append(row | {"kind": "style", "name": attrs.get("name") or attrs.get("engName"), "para_pr": attrs.get("paraPrIDRef"), "char_pr": attrs.get("charPrIDRef")})
        elif name == "bullet":
            out.append(row | {"kind": "bullet", "text": attrs.get("char")})
        elif name == "numbering":
            out += [row | {"kind": "numbering", "level": whole(a.get("level")), "format": a.get("numFormat"), "start": whole(a.get("start")), "text": x.text} for x in e if name_of(x) == "paraHead" for a in [attrs_of(x)]]
    return out


def _styles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_pylist(header_rows(row["path"], row["content"]), schema=STYLE)


def styles(parts: DataFrame) -> DataFrame:
    """The style dictionaries of all packages, a row per entry, by ``kind``."""
    return parts.where(F.col("part").rlike(r"(^|/)header\.xml$")).select("path", "content").mapInArrow(_styles, STYLE_SQL)


ELEMENT = pa.schema([(n, pa.string()) for n in ("path", "kind", "id")] + [("place", pa.int64()), ("above", pa.int64()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string())])
ELEMENT_SQL = "path string, kind string, id string, place bigint, above bigint, tag string, attrs map<string,string>, text string"


def element_rows(path: str, xml: bytes) -> list[dict]:
    """The elements of each entry of the style dictionaries, depth first, with the place of the element above."""
    out = []
    for e in ElementTree.fromstring(xml).iter():
        kind = ENTRIES.get(name_of(e))
        if kind is None or e.get("id") is None:
            continue
        stack, place = [(e, None)], 0
        while stack:
            x, above = stack.pop()
            out.append({"path": path, "kind": kind, "id": e.get("id"), "place": place, "above": above, "tag": name_of(x), "attrs": list(attrs_of(x).items()), "text": (x.text or "").strip() or None})
            stack += [(y, place) for y in reversed(list(x))]
            place += 1
    return out


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_pylist(element_rows(row["path"], row["content"]), schema=ELEMENT)


def elements(parts: DataFrame) -> DataFrame:
    """(path, kind, id, place, above, tag, attrs, text): the style dictionaries whole, a row per XML element of an entry."""
    return parts.where(F.col("part").rlike(r"(^|/)header\.xml$")).select("path", "content").mapInArrow(_elements, ELEMENT_SQL)


def problems(parts: DataFrame) -> DataFrame:
    """(path, problem): packages without a manifest or header at its place, or without sections; sound ones give no row."""
    has = lambda pattern: F.max(F.col("part").rlike(pattern))
    facts = parts.groupBy("path").agg(has(r"(^|/)content\.hpf$").alias("manifest"), has(r"^Contents/header\.xml$").alias("header"))
    found = facts.join(section_parts(parts).select("path").distinct().withColumn("sections", F.lit(True)), "path", "left")
    listed = F.array_compact(F.array(F.when(~F.col("manifest") & ~F.col("header"), F.lit("no_manifest")), F.when(F.col("sections").isNull(), F.lit("no_sections"))))
    return found.select("path", F.explode(listed).alias("problem"))


def info(parts: DataFrame) -> DataFrame:
    """(path, kind, name, value, media_type, size): title, language, metadata and images of the manifest, and the application."""
    sizes = parts.select("path", F.col("part").alias("value"), "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                root = ElementTree.fromstring(row["content"])
                if row["part"].endswith("version.xml"):
                    rows += [{"path": row["path"], "kind": "application", "name": n, "value": attrs_of(root).get(n)} for n in ("application", "appVersion")]
                    continue
                for e in root.iter():
                    name, attrs = name_of(e), attrs_of(e)
                    if name == "meta" and attrs.get("name"):
                        rows.append({"path": row["path"], "kind": "meta", "name": attrs["name"], "value": (e.text or "").strip()})
                    elif name in ("title", "language"):
                        rows.append({"path": row["path"], "kind": name, "name": name, "value": (e.text or "").strip()})
                    elif name == "item" and (attrs.get("href") or "").startswith("BinData/"):
                        rows.append({"path": row["path"], "kind": "image", "name": attrs.get("id"), "value": attrs["href"], "media_type": attrs.get("media-type")})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, pa.string()) for n in ("path", "kind", "name", "value", "media_type")]))

    found = parts.where(F.col("part").rlike(r"(^|/)(content\.hpf|version\.xml)$")).select("path", "part", "content").mapInArrow(run, "path string, kind string, name string, value string, media_type string")
    return found.join(sizes, ["path", "value"], "left").select("path", "kind", "name", "value", "media_type", "size")
