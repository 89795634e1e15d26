"""Physical table grids from DOM rows, and header associations as interval joins.

Placement walks the cells of a table in order, as HTML does; all that follows
is relational.  An interval join meets by the columns (or rows) that a header
covers, so a table's cells are never paired with all of its headers.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.blocks import Tree
from docweave.sources.html_dom import parse_html

MAX_ROWSPAN, MAX_COLSPAN = 65534, 1000  # limits of the HTML standard
SCOPES = {"col": "column_header", "row": "row_header", "colgroup": "column_group_header", "rowgroup": "row_group_header"}
_FIELDS = [
    ("page_id", pa.int64()), ("table_id", pa.int32()), ("cell_id", pa.int32()), ("row", pa.int32()), ("col", pa.int32()), ("rowspan", pa.int32()), ("colspan", pa.int32()), ("row_group", pa.int32()),
    ("group_tag", pa.string()), ("tag", pa.string()), ("html_id", pa.string()), ("headers", pa.string()), ("scope", pa.string()), ("text", pa.string()), ("issue", pa.string()), ("role", pa.string()), ("confidence", pa.float64()),
]
_SQL = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.float64(): "double"}


def parse_span(value: str | None, limit: int, to_end: int | None = None) -> tuple[int, str | None]:
    """(span, issue): absent is 1, 0 means up to ``to_end`` if that is given, invalid counts as 1, too large as the limit."""
    if value is None:
        return 1, None
    value = value.strip()
    if not value.isdecimal() or int(value) == 0 and to_end is None:
        return 1, "invalid_span"
    n = int(value)
    if n == 0:
        return to_end, None
    return (limit, "span_clamped") if n > limit else (n, None)


def grid(tree: Tree, table: int) -> list[dict]:
    """Cells of one table, nested ones excluded, with the first column that no earlier cell covers."""
    rows: list[tuple[int, str, int]] = []  # (tr, group tag, group number)
    group = 0
    for g in tree.children(table):
        tag = tree.rows[g]["tag"]
        if tag == "tr":
            rows.append((g, "", group))
        elif tag in ("thead", "tbody", "tfoot"):
            group += 1
            rows += [(r, tag, group) for r in tree.children(g) if tree.rows[r]["tag"] == "tr"]
            group += 1
    last = {g: k for k, (_, _, g) in enumerate(rows)}
    out: list[dict] = []
    taken: dict[int, set[int]] = {}  # columns by row, of cells that reach below their own row
    for k, (tr, tag, g) in enumerate(rows):
        here, col = taken.pop(k, set()), 0
        for c in tree.children(tr):
            r = tree.rows[c]
            if r["tag"] not in ("td", "th"):
                continue
            a = r["attrs"] or {}
            end = last[g] - k + 1
            down, issue = parse_span(a.get("rowspan"), MAX_ROWSPAN, end)
            right, wide = parse_span(a.get("colspan"), MAX_COLSPAN)
            issue = issue or wide
            while col in here:
                col += 1
            if down > end:
                down, issue = end, "rowspan_crosses_group"
            cover = range(col, col + right)
            if any(x in here for x in cover):
                issue = "cells_overlap"
            here.update(cover)
            for below in range(k + 1, k + down):
                taken.setdefault(below, set()).update(cover)
            out.append({"table_id": table, "cell_id": c, "row": k, "col": col, "rowspan": down, "colspan": right, "row_group": g, "group_tag": tag, "tag": r["tag"], "html_id": a.get("id"), "headers": a.get("headers"), "scope": a.get("scope", "").lower() or None, "text": tree.text(tree.children(c)) or None, "issue": issue})
            col += right
    return roles(out)


def roles(cells: list[dict]) -> list[dict]:
    """Role and confidence of every cell, by the first rule that holds.

    A scope on td is ambiguous; a valid scope decides (1.0), an invalid one is
    unknown; th in leading rows of headers only, or in thead, heads columns (0.9);
    th with no data in its columns heads rows (0.9); other th are unknown; td
    is data (1.0).
    """
    by_row: dict[int, list[dict]] = {}
    data_cols: set[int] = set()
    for c in cells:
        by_row.setdefault(c["row"], []).append(c)
        if c["tag"] == "td":
            data_cols.update(range(c["col"], c["col"] + c["colspan"]))
    lead = 0
    while lead in by_row and all(c["tag"] == "th" for c in by_row[lead]) and all(c["row"] + c["rowspan"] <= lead + 1 or c["tag"] == "th" for c in by_row[lead]):
        lead += 1
    for c in cells:
        if c["scope"] is not None:
            role = "ambiguous" if c["tag"] == "td" else SCOPES.get(c["scope"], "unknown")
            c["role"], c["confidence"] = role, 1.0 if role in SCOPES.values() else 0.0
        elif c["tag"] == "td":
            c["role"], c["confidence"] = "data", 1.0
        elif c["row"] < lead or c["group_tag"] == "thead":
            c["role"], c["confidence"] = "column_header", 0.9
        elif not any(x in data_cols for x in range(c["col"], c["col"] + c["colspan"])):
            c["role"], c["confidence"] = "row_header", 0.9
        else:
            c["role"], c["confidence"] = "unknown", 0.0
    return cells


def table_cells(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per cell of every table; pages without tables, null or empty, give none."""
    schema = pa.schema(_FIELDS)

    def run(batches):
        for b in batches:
            rows: list[dict] = []
            for page, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text and "<table" in text.lower():
                    tree = Tree(parse_html(text))
                    for r in tree.rows:
                        if r["tag"] == "table":
                            rows += [x | {"page_id": page} for x in grid(tree, r["dom_order"])]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return pages.select(key, html).mapInArrow(run, ", ".join(f"{n} {_SQL[t]}" for n, t in _FIELDS))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], lo: str, span: str) -> DataFrame:
    """Pairs of rows of one key whose intervals [lo, lo + span) meet, once each; columns of ``right`` get the prefix ``h_``.

    Both sides are dealt by every place they cover; a pair is kept at the first place that both cover.
    """
    places = lambda a, n: F.explode(F.sequence(F.col(a), F.col(a) + F.col(n) - 1))
    r = right.select(*[F.col(c).alias(f"h_{c}") for c in right.columns]).withColumn("_at", places(f"h_{lo}", f"h_{span}"))
    on = [F.col(k) == F.col(f"h_{k}") for k in keys]
    both = left.withColumn("_p", places(lo, span)).join(r, [*on, F.col("_p") == F.col("_at")])
    return both.where(F.col("_p") == F.greatest(lo, f"h_{lo}")).drop("_p", "_at")


def header_links(cells: DataFrame) -> DataFrame:
    """(page_id, table_id, cell_id, axis, header_id, status) for data cells.

    ``headers`` attributes win: ids that are missing, repeated or no header are
    unresolved.  Else a column header lies above and covers the cell's columns,
    a row header lies left and covers its rows, a group header shares its row
    group; a header that covers a part only is a candidate, and so are two
    bands of column headers with data between them.  Tables with bad geometry
    have no links.
    """
    t = ["page_id", "table_id"]
    bad = cells.where("issue in ('cells_overlap', 'rowspan_crosses_group')").select(*t).distinct()
    good = cells.join(bad, t, "left_anti")
    heads = good.where("role like '%header'").select(*t, "cell_id", "row", "col", "rowspan", "colspan", "row_group", "role")
    data = good.where("role = 'data'")
    explicit = data.where("trim(headers) <> ''").select(*t, "cell_id", F.explode(F.array_distinct(F.split(F.trim("headers"), r"\s+"))).alias("html_id"))
    ids = good.where("html_id is not null").groupBy(*t, "html_id").agg(F.count(F.lit(1)).alias("n"), F.first("cell_id").alias("header_id"), F.first("role").alias("role"))
    named = explicit.join(ids, [*t, "html_id"], "left").select(
        *t, "cell_id", F.when(F.col("role").like("row%"), "row").when(F.col("role").like("column%"), "column").otherwise("other").alias("axis"), "header_id",
        F.when((F.col("n") == 1) & F.col("role").like("%header"), "resolved").otherwise("unresolved").alias("status"),
    )
    free = data.where("coalesce(trim(headers), '') = ''").select(*t, "cell_id", "row", "col", "rowspan", "colspan", "row_group")
    above = interval_join(free, heads.where("role in ('column_header', 'column_group_header')"), t, "col", "colspan").where("h_row + h_rowspan <= row")
    whole = F.expr("h_col <= col and h_col + h_colspan >= col + colspan")
    # data between two bands: the next data row below the upper header comes before the lower one
    rows = free.select(*t, F.explode(F.expr("sequence(col, col + colspan - 1)")).alias("col"), "row").groupBy(*t, "col").agg(F.sort_array(F.collect_set("row")).alias("_rows"))
    above = above.join(rows, [*t, "col"], "left")
    w = Window.partitionBy(*t, "cell_id")
    lowest = F.max("h_row").over(w)
    split = F.exists("_rows", lambda r: (r > F.col("h_row")) & (r < F.col("_lowest")))
    column = above.withColumn("_lowest", lowest).withColumn("_split", F.max(F.coalesce(split, F.lit(False))).over(w))
    column = column.select(*t, "cell_id", F.lit("column").alias("axis"), F.col("h_cell_id").alias("header_id"), F.when(whole & ~F.col("_split"), "resolved").otherwise("candidate").alias("status"))
    left = interval_join(free, heads.where("role in ('row_header', 'row_group_header')"), t, "row", "rowspan").where("h_col + h_colspan <= col")
    covers = F.expr("case when h_role = 'row_group_header' then h_row_group = row_group else h_row <= row and h_row + h_rowspan >= row + rowspan end")
    row = left.select(*t, "cell_id", F.lit("row").alias("axis"), F.col("h_cell_id").alias("header_id"), F.when(covers, "resolved").otherwise("candidate").alias("status"))
    return named.unionByName(column).unionByName(row)


def overlapping_cells(cells: DataFrame) -> DataFrame:
    """(page_id, table_id, a, b): cells whose rectangles overlap, the later one as b."""
    t = ["page_id", "table_id"]
    c = cells.select(*t, "cell_id", "row", "col", "rowspan", "colspan")
    pairs = interval_join(c, c, t, "col", "colspan").where("cell_id < h_cell_id and row < h_row + h_rowspan and h_row < row + rowspan")
    return pairs.select(*t, F.col("cell_id").alias("a"), F.col("h_cell_id").alias("b"))
