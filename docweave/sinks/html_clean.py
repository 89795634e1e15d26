"""Captured HTML reduced to tags and attributes that are safe to keep."""

from __future__ import annotations

import re
from html import escape
from urllib.parse import urlsplit

from docweave.operators.blocks import Tree
from docweave.sources.html_dom import VOID, parse_html

KEEP = frozenset("a article b blockquote br caption center col colgroup dd div dl dt em h1 h2 h3 h4 h5 h6 hr i li ol p pre section span strong sub sup table tbody td tfoot th thead tr u ul".split())
DROP = frozenset("base button embed form iframe input link meta noscript object script select style svg template textarea".split())


def clean_html(html: str | None) -> str:
    """Kept tags with numeric spans and http(s) links only; other tags go and their content stays; executable subtrees go whole."""
    tree, out = Tree(parse_html(html)), []

    def walk(nodes: list[int]) -> None:
        for i in nodes:
            r = tree.rows[i]
            if r["kind"] == "text":
                out.append(escape(r["text"], quote=False))
            elif r["kind"] != "element" or r["tag"] in DROP:
                continue
            elif r["tag"] not in KEEP:
                walk(tree.children(i))
            else:
                a = r["attrs"] or {}
                own = "".join(f' {k}="{int(a[k])}"' for k in ("colspan", "rowspan") if r["tag"] in ("td", "th") and re.fullmatch(r"[0-9]{1,5}", a.get(k, "")))
                if r["tag"] == "a" and _is_web(a.get("href", "")):
                    own += f' href="{escape(a["href"])}"'
                out.append(f"<{r['tag']}{own}>")
                walk(tree.children(i))
                if r["tag"] not in VOID:
                    out.append(f"</{r['tag']}>")

    walk(tree.children(-1))
    return "".join(out)


def _is_web(href: str) -> bool:
    try:
        parts = urlsplit(href.strip())
    except ValueError:
        return False
    return parts.scheme in ("http", "https") and bool(parts.netloc)


def wrapped(body: str, title: str = "") -> str:
    return f'<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>{escape(title)}</title></head><body>{clean_html(body)}</body></html>\n'
