"""HTML pages to ordered DOM rows, one Python crossing per page.

One clock a page, dom_order, ticks for every start tag, text, comment that is
not blank, and unknown declaration.  End tags never tick: what is wrong with
them is a row of kind ``issue`` at the last node's place.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the HTML standard, section "Optional tags": an open element
# on the left may lack its end tag before a start tag on the right.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_AFTER_P = "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul"
_ROW_GROUPS = "tbody tfoot thead"
OMITTED = {
    "p": _AFTER_P, "li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option optgroup", "optgroup": "optgroup",
    "td": f"td th tr {_ROW_GROUPS}", "th": f"td th tr {_ROW_GROUPS}", "tr": f"tr {_ROW_GROUPS}", "tbody": _ROW_GROUPS, "tfoot": _ROW_GROUPS, "thead": _ROW_GROUPS,
}
OMITTED = {k: frozenset(v.split()) for k, v in OMITTED.items()}
#: A start tag ends nothing outside the nearest of these, unless that one may be ended itself.
SCOPES = frozenset("body button caption dl html ol select table td th ul".split())

DOM = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("dom_order", T.IntegerType()), T.StructField("parent_order", T.IntegerType()), T.StructField("child_index", T.IntegerType()),
    T.StructField("depth", T.IntegerType()), T.StructField("last_order", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("tag", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())), T.StructField("raw_attrs", T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())]))), T.StructField("text", T.StringType()), T.StructField("line", T.IntegerType()), T.StructField("col", T.IntegerType()),
    T.StructField("issue", T.StringType()),
])


class TreeRows(HTMLParser):
    """Collects one row per node; ``issues`` hang on the node they concern."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.issues: list[dict] = []
        self.open: list[int] = []
        self.children: dict[int, int] = {}

    def _add(self, kind: str, tag: str | None, attrs: list | None, text: str | None, issue: str | None = None) -> int:
        order, (line, col) = len(self.rows), self.getpos()
        raw = None if attrs is None else [{"k": k, "v": v} for k, v in attrs]
        attrs = None if attrs is None else {k: v or "" for k, v in attrs}
        parent = self.open[-1] if self.open else -1
        index = self.children.get(parent, 0)
        self.children[parent] = index + 1
        self.rows.append({"dom_order": order, "parent_order": parent, "child_index": index, "depth": len(self.open), "last_order": order, "kind": kind, "tag": tag, "attrs": attrs, "raw_attrs": raw, "text": text, "line": line, "col": col, "issue": issue})
        return order

    def _close_to(self, at: int, issue: str | None = None) -> None:
        while len(self.open) > at:
            node = self.rows[self.open.pop()]
            node["last_order"] = len(self.rows) - 1
            if issue and len(self.open) > at:
                node["issue"] = node["issue"] or ("implied_end" if node["tag"] in OMITTED else issue)

    def _report(self, tag: str, issue: str) -> None:
        line, col = self.getpos()
        at = max(len(self.rows) - 1, 0)
        self.issues.append({"dom_order": at, "parent_order": self.open[-1] if self.open else -1, "child_index": 0, "depth": len(self.open), "last_order": at, "kind": "issue", "tag": tag, "attrs": None, "raw_attrs": None, "text": None, "line": line, "col": col, "issue": issue})

    def _imply(self, tag: str) -> None:
        """End the outermost element of the scope whose end tag may be left out before ``tag``."""
        ended = None
        for depth in reversed(range(len(self.open))):
            name = self.rows[self.open[depth]]["tag"]
            if tag in OMITTED.get(name, ()):
                ended = depth
            elif name in SCOPES:
                break
        if ended is not None:
            node = self.rows[self.open[ended]]
            node["issue"] = node["issue"] or "implied_end"
            self._close_to(ended)

    def handle_starttag(self, tag, attrs):
        self._imply(tag)
        if tag == "body" and any(r["tag"] == "body" for r in self.rows):
            self._report(tag, "multiple_bodies")
        names = [k for k, _ in attrs]
        order = self._add("element", tag, attrs, None, "duplicate_attribute" if len(set(names)) < len(names) else None)
        if tag not in VOID:
            self.open.append(order)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[i]]["tag"] == tag:
                self._close_to(i, "misnested_end")
                return
        self._report(tag, "unmatched_end")

    def handle_data(self, data):
        self._add("text", None, None, data)

    def handle_comment(self, data):
        if data.strip():
            self._add("comment", None, None, data)

    def unknown_decl(self, data):
        self._add("cdata", None, None, data)

    def finish(self) -> list[dict]:
        self.close()
        for i in self.open:
            self.rows[i]["issue"] = self.rows[i]["issue"] or ("implied_end" if self.rows[i]["tag"] in OMITTED else "unclosed")
        self._close_to(0)
        return self.rows + self.issues


def parse_html(text: str | None) -> list[dict]:
    tree = TreeRows()
    tree.feed(text or "")
    return tree.finish()


def dom_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per DOM node; null and empty pages give none."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("page_id", pa.int64()), ("dom_order", pa.int32()), ("parent_order", pa.int32()), ("child_index", pa.int32()), ("depth", pa.int32()), ("last_order", pa.int32()), ("kind", pa.string()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("raw_attrs", pa.list_(pa.struct([("k", pa.string()), ("v", pa.string())]))), ("text", pa.string()), ("line", pa.int32()), ("col", pa.int32()), ("issue", pa.string())])
        for b in batches:
            rows: list[dict] = []
            for page, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows += [r | {"page_id": page, "attrs": None if r["attrs"] is None else list(r["attrs"].items())} for r in parse_html(text)]
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return pages.select(key, html).mapInArrow(parse, DOM)
