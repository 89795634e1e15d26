"""DOM rows of a page to its ordered stream of display blocks.

Inline content between blocks forms one unit; lists, tables, separators and
media are units of their own.  Every text leaf outside head, script, style and
template ends up in exactly one block, so source and output can be compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import parse_qsl, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.sources.html_dom import parse_html

HIDDEN = frozenset("head script style template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form header html main nav p pre section tbody td tfoot th thead tr".split()) | HEADINGS
LISTS = frozenset(("ol", "ul", "menu"))
MEDIA = frozenset("audio canvas embed iframe img object picture svg video".split())
BREAKS = (CONTAINERS | LISTS | frozenset(("li", "table", "hr", "caption"))) - frozenset(("td", "th"))
_ROOM = re.compile(r"[\s ]+")

_LINK = pa.struct([("href", pa.string()), ("url", pa.string()), ("identifiers", pa.list_(pa.string()))])
_SPAN = pa.struct([("type", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
ARROW = pa.schema([
    ("page_id", pa.int64()), ("block_order", pa.int32()), ("anchor", pa.int32()), ("parent_block", pa.int32()), ("type", pa.string()), ("tag", pa.string()), ("level", pa.int32()), ("text", pa.string()),
    ("align", pa.string()), ("bold", pa.bool_()), ("ordinal", pa.int32()), ("links", pa.list_(_LINK)), ("annotations", pa.list_(_SPAN)),
])
SCHEMA = "page_id bigint, block_order int, anchor int, parent_block int, type string, tag string, level int, text string, align string, bold boolean, ordinal int, links array<struct<href:string,url:string,identifiers:array<string>>>, annotations array<struct<type:string,start:int,end:int>>"


class Tree:
    """Children and texts of the DOM rows of one page."""

    def __init__(self, rows: list[dict]):
        self.rows = [r for r in rows if r["kind"] != "issue"]
        self.below: dict[int, list[int]] = {}
        for r in self.rows:
            self.below.setdefault(r["parent_order"], []).append(r["dom_order"])

    def children(self, i: int) -> list[int]:
        return self.below.get(i, [])

    def root(self) -> int:
        """The only body, else the whole tree (-1)."""
        bodies = [r["dom_order"] for r in self.rows if r["tag"] == "body"]
        return bodies[0] if len(bodies) == 1 else -1

    def has_block(self, i: int) -> bool:
        r = self.rows[i]
        return any(x["tag"] in BREAKS or x["tag"] in MEDIA or x["tag"] in ("td", "th") for x in self.rows[i : r["last_order"] + 1])

    def pieces(self, nodes: list[int]) -> Iterator[tuple[str, int | None]]:
        """Texts and breaks below some nodes, in order, with the order of the text leaf."""
        for i in nodes:
            r = self.rows[i]
            if r["kind"] == "text" or r["kind"] == "cdata":
                yield _ROOM.sub(" ", r["text"]), i
            elif r["tag"] == "br":
                yield "\n", None
            elif r["kind"] == "element" and r["tag"] not in HIDDEN:
                edge = "\n" if r["tag"] in BREAKS else " " if r["tag"] in ("td", "th") else ""
                if edge:
                    yield edge, None
                yield from self.pieces(self.children(i))
                if edge:
                    yield edge, None

    def text(self, nodes: list[int]) -> str:
        return tidy("".join(t for t, _ in self.pieces(nodes)))


def tidy(text: str) -> str:
    """White space, no-break spaces included, collapsed in every line; empty lines go."""
    return "\n".join(x for x in (_ROOM.sub(" ", line).strip() for line in text.split("\n")) if x)


def rendered_text(html: str | None) -> str:
    """Displayed text of a page: blocks and br break lines, cells are set apart by spaces."""
    t = Tree(parse_html(html))
    return t.text([t.root()] if t.root() >= 0 else t.children(-1))


def link_record(href: str, base: str | None, attrs: dict) -> dict:
    """href as written, its absolute form if that is http or https, and identifiers from attributes, path tail and query keys that end in id."""
    try:
        url = urljoin(base or "", href)
        parts = urlsplit(url)
    except ValueError:
        return {"href": href, "url": None, "identifiers": []}
    found = [v for k, v in attrs.items() if v and (k == "data-id" or k.endswith("-id"))]
    tail = re.search(r"--([^/]+)$|/(\d+)$", parts.path)
    found += [x for x in (tail.groups() if tail else ()) if x]
    found += [v for k, v in parse_qsl(parts.query) if k.lower().endswith("id") and v]
    return {"href": href, "url": url if parts.scheme in ("http", "https") and parts.netloc else None, "identifiers": list(dict.fromkeys(found))}


def _emphasis(tree: Tree, nodes: list[int], inside: bool = False) -> bool | None:
    """Whether all text below is bold, raised and lowered marks left aside; None without text."""
    seen = None
    for i in nodes:
        r = tree.rows[i]
        if r["kind"] == "text":
            if r["text"].strip("  \t\r\n\f"):
                if not inside:
                    return False
                seen = True
        elif r["kind"] == "element" and r["tag"] not in HIDDEN and r["tag"] not in ("sup", "sub"):
            heavy = inside or r["tag"] in ("b", "strong") or r["tag"] in HEADINGS or bool(re.search(r"font-weight\s*:\s*(bold|[6-9]00)", (r["attrs"] or {}).get("style", "")))
            got = _emphasis(tree, tree.children(i), heavy)
            if got is False:
                return False
            seen = seen or got
    return seen


def _scripts(tree: Tree, nodes: list[int], text: str) -> list[dict]:
    """Offsets of raised and lowered text in the block's text, found in order."""
    out, at = [], 0
    for i in nodes:
        for r in tree.rows[i : tree.rows[i]["last_order"] + 1]:
            if r["tag"] in ("sup", "sub"):
                own = tree.text(tree.children(r["dom_order"]))
                s = text.find(own, at) if own else -1
                if s >= 0:
                    out.append({"type": r["tag"], "start": s, "end": s + len(own)})
                    at = s + len(own)
    return out


def blocks_of(html: str | None, base: str | None = None) -> list[dict]:
    """The display blocks of a page, in order."""
    tree, out = Tree(parse_html(html)), []

    def emit(kind: str, nodes: list[int], tag: str | None, parent: int, align: str | None, text: str | None = None, level: int | None = None, ordinal: int | None = None) -> int:
        text = tree.text(nodes) if text is None else text
        links = [link_record(r["attrs"]["href"], base, r["attrs"]) for i in nodes for r in tree.rows[i : tree.rows[i]["last_order"] + 1] if r["tag"] == "a" and "href" in (r["attrs"] or {})] if kind not in ("list", "list_item") else []
        out.append({"block_order": len(out), "anchor": nodes[0] if nodes else -1, "parent_block": parent, "type": kind, "tag": tag, "level": level, "text": text or None, "align": align, "bold": bool(_emphasis(tree, nodes, tag in HEADINGS)) if text else False, "ordinal": ordinal, "links": links, "annotations": _scripts(tree, nodes, text) if text else []})
        return len(out) - 1

    def aligned(r: dict, was: str | None) -> str | None:
        a = r["attrs"] or {}
        m = re.search(r"text-align\s*:\s*([a-z]+)", a.get("style", ""))
        return m[1] if m else a.get("align", "").lower() or was

    def flush(run: list[int], tag: str | None, parent: int, align: str | None) -> None:
        if run and tree.text(run):
            kind = "heading" if tag in HEADINGS else "paragraph" if tag in CONTAINERS or tag is None or tag == "li" else "unknown"
            emit(kind, list(run), tag, parent, align, level=int(tag[1]) if tag in HEADINGS else None)
        run.clear()

    def flow(nodes: list[int], tag: str | None, parent: int, align: str | None) -> None:
        run: list[int] = []
        for i in nodes:
            r = tree.rows[i]
            if r["kind"] in ("text", "cdata"):
                run.append(i)
            elif r["kind"] != "element" or r["tag"] in HIDDEN:
                continue
            elif not tree.has_block(i):
                run.append(i)
            else:
                flush(run, tag, parent, align)
                block(i, parent, aligned(r, align))
        flush(run, tag, parent, align)

    def block(i: int, parent: int, align: str | None) -> None:
        r = tree.rows[i]
        if r["tag"] in LISTS:
            items(i, parent, align)
        elif r["tag"] == "table":
            emit("table", [i], "table", parent, align)
        elif r["tag"] == "hr":
            emit("separator", [i], "hr", parent, align, "")
        elif r["tag"] in MEDIA and not tree.text([i]):
            emit("media", [i], r["tag"], parent, align, "")
        else:
            flow(tree.children(i), r["tag"], parent, align)

    def items(i: int, parent: int, align: str | None) -> None:
        a, kids = tree.rows[i]["attrs"] or {}, tree.children(i)
        n = sum(tree.rows[k]["tag"] == "li" for k in kids)
        step = -1 if "reversed" in a else 1
        number = int(a["start"]) if re.fullmatch(r"-?\d{1,9}", a.get("start", "")) else n if step < 0 else 1
        at = emit("list", [i], tree.rows[i]["tag"], parent, align, "")
        stray: list[int] = []
        for k in kids:
            r = tree.rows[k]
            if r["tag"] != "li":
                if r["kind"] == "text" or r["kind"] == "element":
                    stray.append(k)
                continue
            flow(stray, None, at, align)
            stray = []
            if re.fullmatch(r"-?\d{1,9}", (r["attrs"] or {}).get("value", "")):
                number = int(r["attrs"]["value"])
            ordinal = number if tree.rows[i]["tag"] == "ol" else None
            number += step
            if tree.has_inner_block(k):
                own = emit("list_item", [k], "li", at, align, "", ordinal=ordinal)
                flow(tree.children(k), "li", own, align)
                # a single paragraph is the item's own text
                if len(out) == own + 2 and out[-1]["type"] == "paragraph":
                    para = out.pop()
                    out[own] |= {f: para[f] for f in ("text", "bold", "links", "annotations")}
            else:
                own = emit("list_item", [k], "li", at, align, ordinal=ordinal)
                out[own]["links"] = [link_record(x["attrs"]["href"], base, x["attrs"]) for x in tree.rows[k : r["last_order"] + 1] if x["tag"] == "a" and "href" in (x["attrs"] or {})]
        flow(stray, None, at, align)

    tree.has_inner_block = lambda k: any(tree.has_block(c) for c in tree.children(k) if tree.rows[c]["kind"] == "element")
    root = tree.root()
    flow(tree.children(root), "body" if root >= 0 else None, -1, None)
    return out


def block_stream(pages: DataFrame, key: str = "page_id", html: str = "html", url: str | None = "url") -> DataFrame:
    """One row per display block; null and empty pages give none."""

    def run(batches):
        for b in batches:
            rows: list[dict] = []
            bases = b.column(2).to_pylist() if url else [None] * b.num_rows
            for page, text, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bases, strict=True):
                rows += [x | {"page_id": page} for x in blocks_of(text, base)]
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return pages.select(key, html, *([url] if url else [])).mapInArrow(run, SCHEMA)
