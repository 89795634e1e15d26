"""Metadata tabs: label and value fields, declared groups of relations, history tables."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.blocks import Tree, link_record
from docweave.operators.tables import grid
from docweave.sources.html_dom import parse_html

# Labels of the portal's property tab, as old snapshots print them
# without markup, and the labels of its history tables.
PROPERTY_LABELS = ("Số hiệu", "Loại văn bản", "Ngành", "Ngày ban hành", "Lĩnh vực", "Ngày có hiệu lực", "Tình trạng hiệu lực", "Ngày hết hiệu lực", "Cơ quan ban hành", "Chức danh", "Người ký")
HISTORY_LABELS = {"Thời gian": "date", "Trạng thái": "status", "Văn bản nguồn": "source_document"}
ITEM, LABEL, VALUE = "ant-descriptions-item-container", "ant-descriptions-item-label", "ant-descriptions-item-content"
PLACEHOLDERS = ("--", "—", "-")

_FIELD = pa.schema([("page_id", pa.int64()), ("anchor", pa.int32()), ("label", pa.string()), ("value", pa.string()), ("role", pa.string()), ("evidence", pa.string())])
_EVENT = pa.schema([("page_id", pa.int64()), ("table_id", pa.int32()), ("row", pa.int32()), ("date", pa.string()), ("status", pa.string()), ("source_document", pa.string()), ("source_url", pa.string()), ("other_values", pa.map_(pa.string(), pa.string())), ("simple", pa.bool_())])


def _with_class(tree: Tree, lo: int, hi: int, name: str) -> list[int]:
    return [r["dom_order"] for r in tree.rows[lo : hi + 1] if r["kind"] == "element" and name in (r["attrs"] or {}).get("class", "").split()]


def _bare(text: str) -> str:
    return re.sub(r"\s+", "", text)


def fields_of(html: str | None) -> list[dict]:
    """Fields of a property tab, in order.

    A field with one label and one value that hold all of its text is known;
    unclear borders and text beside them make it unknown, with all its text.
    Snapshots without markup are read cell by cell, by known labels.
    """
    tree, out = Tree(parse_html(html)), []
    boxes = _with_class(tree, 0, len(tree.rows) - 1, ITEM)
    for i in boxes:
        hi, whole = tree.rows[i]["last_order"], tree.text([i])
        labels, values = (_with_class(tree, i, hi, c) for c in (LABEL, VALUE))
        field = {"anchor": i, "label": None, "value": whole or None, "role": "unknown"}
        if len(labels) != 1 or len(values) != 1:
            out.append(field | {"evidence": "ambiguous_field_markup"})
            continue
        label, value = tree.text(labels), tree.text(values)
        if _bare(label + value) != _bare(whole):
            out.append(field | {"evidence": "extra_field_text"})
        else:
            out.append({"anchor": i, "label": label or None, "value": value or None, "role": "field", "evidence": "label_content_markup"})
    if boxes:
        return out
    inner = -1
    for r in tree.rows:
        if r["tag"] != "td" or r["dom_order"] <= inner:
            continue
        inner = r["last_order"]
        text = tree.text(tree.children(r["dom_order"]))
        label = next((x for x in PROPERTY_LABELS if re.match(rf"{re.escape(x)}(?:[\s:]|$)", text)), None)
        if text:
            value = text[len(label) :].strip(" :\n\t") if label else text
            out.append({"anchor": r["dom_order"], "label": label, "value": value or None, "role": "field" if label else "unknown", "evidence": "legacy_label_prefix" if label else "unlabelled_cell"})
    return out


def events_of(html: str | None, base: str | None = None) -> list[dict]:
    """Rows of history tables, by header; a table that is not simple gives one row with ``simple`` false.

    Simple: one header row at least, different headers, no table inside, and
    in every other row that has text one unspanned cell without a list for each header.
    """
    tree, out = Tree(parse_html(html)), []
    inside = -1
    for t in tree.rows:
        if t["tag"] != "table" or t["dom_order"] <= inside:
            continue
        at, inside = t["dom_order"], t["last_order"]
        rows: dict[int, list[dict]] = {}
        for c in grid(tree, at):
            rows.setdefault(c["row"], []).append(c)
        head = next((cs for _, cs in sorted(rows.items()) if all(c["tag"] == "th" for c in cs)), [])
        names = [c["text"] for c in head]
        below = lambda c: {r["tag"] for r in tree.rows[c["cell_id"] : tree.rows[c["cell_id"]]["last_order"] + 1]}  # noqa: B023,E731
        body = [(k, cs) for k, cs in sorted(rows.items()) if any(c["text"] for c in cs)]
        plain = all(len(cs) == len(names) and all(c["rowspan"] == 1 and c["colspan"] == 1 and not below(c) & {"ol", "ul"} for c in cs) for _, cs in body)
        if not names or len(set(names)) < len(names) or any(r["tag"] == "table" for r in tree.rows[at + 1 : inside + 1]) or not plain:
            out.append({"table_id": at, "row": None, "simple": False, "other_values": []})
            continue
        for k, cs in body:
            if all(c["tag"] == "th" for c in cs):
                continue
            event = {"table_id": at, "row": k, "simple": True, "other_values": []}
            for name, c in zip(names, cs, strict=True):
                field = HISTORY_LABELS.get(name)
                if field:
                    event[field] = c["text"]
                else:
                    event["other_values"].append((name, c["text"]))
                if field == "source_document":
                    hrefs = [r["attrs"] for r in tree.rows[c["cell_id"] : tree.rows[c["cell_id"]]["last_order"] + 1] if r["tag"] == "a" and "href" in (r["attrs"] or {})]
                    urls = {link_record(a["href"], base, a)["url"] for a in hrefs} - {None}
                    event["source_url"] = next(iter(urls)) if len(urls) == 1 else None
            out.append(event)
    return out


def _per_page(pages: DataFrame, f, schema: pa.Schema, ddl: str, key: str, html: str) -> DataFrame:
    def run(batches):
        for b in batches:
            rows = [x | {"page_id": p} for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in f(t)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return pages.select(key, html).mapInArrow(run, ddl)


def property_fields(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return _per_page(pages, fields_of, _FIELD, "page_id bigint, anchor int, label string, value string, role string, evidence string", key, html)


def history_events(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return _per_page(pages, events_of, _EVENT, "page_id bigint, table_id int, row int, date string, status string, source_document string, source_url string, other_values map<string,string>, simple boolean", key, html)


def relation_groups(rows: DataFrame, keys: list[str], order: str, text: str = "text", urls: str | None = None, numbers: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(groups, items) from rows in order: a row that ends with ``(n)`` opens a group of n declared items.

    Placeholders are no items but counted as ignored.  An item is resolved as
    source_reference if it has exactly one URL, candidate_only if it has a
    number, else unidentified; a group whose items differ from its declared
    count is a mismatch.  Rows before the first label have no group and are left out.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    label = F.col(text).rlike(r"^.*\S\s*\([0-9]{1,6}\)\s*$")
    x = rows.withColumn("_label", F.coalesce(label, F.lit(False))).withColumn("group_order", F.last(F.when(F.col("_label"), F.col(order)), ignorenulls=True).over(w))
    none = F.trim(text).isin(*PLACEHOLDERS)
    n_urls = F.size(F.array_distinct(urls)) if urls else F.lit(0)
    n_numbers = F.size(numbers) if numbers else F.lit(0)
    status = F.when(n_urls == 1, "source_reference").when(n_numbers > 0, "candidate_only").otherwise("unidentified")
    members = x.where("not _label and group_order is not null and trim(" + text + ") <> ''")
    items = members.where(~none).withColumn("resolution_status", status).drop("_label")
    counts = members.groupBy(*keys, "group_order").agg(F.count_if(~none).alias("n_items"), F.count_if(none).alias("n_ignored"))
    heads = x.where("_label").select(*keys, "group_order", F.trim(F.regexp_replace(text, r"\s*\([0-9]+\)\s*$", "")).alias("name"), F.regexp_extract(text, r"\(([0-9]+)\)\s*$", 1).cast("int").alias("declared"))
    groups = heads.join(counts, [*keys, "group_order"], "left").withColumns({"n_items": F.coalesce("n_items", F.lit(0)), "n_ignored": F.coalesce("n_ignored", F.lit(0))})
    return groups.withColumn("mismatch", F.col("declared") != F.col("n_items")), items
