from pyspark.sql import functions as F

from docweave.operators import legal, tables
from docweave.operators.blocks import Tree
from docweave.sources.html_dom import parse_html


def cells_of(html):
    t = Tree(parse_html(html))
    return tables.grid(t, next(r["dom_order"] for r in t.rows if r["tag"] == "table"))


def at(cells):
    return {c["text"]: (c["row"], c["col"], c["rowspan"], c["colspan"]) for c in cells}


def test_cells_take_the_first_free_column():
    got = at(cells_of("<table><tr><th rowspan=2>A<th colspan=2>B<tr><th>C<th>D<tr><td>1<td>2<td>3</table>"))
    assert got == {"A": (0, 0, 2, 1), "B": (0, 1, 1, 2), "C": (1, 1, 1, 1), "D": (1, 2, 1, 1), "1": (2, 0, 1, 1), "2": (2, 1, 1, 1), "3": (2, 2, 1, 1)}


def test_spans():
    assert tables.parse_span(None, 10) == (1, None)
    assert tables.parse_span("0", 10, 4) == (4, None)
    assert tables.parse_span("0", 1000) == (1, "invalid_span")
    assert tables.parse_span("x", 10) == (1, "invalid_span") and tables.parse_span("-1", 10) == (1, "invalid_span")
    assert tables.parse_span("2000", 1000) == (1000, "span_clamped")


def test_crossing_and_overlap_are_reported_and_nothing_is_dropped():
    cells = cells_of("<table><thead><tr><th rowspan=3>A<th>B</thead><tbody><tr><td>1<td>2</tbody></table>")
    assert {c["text"]: c["issue"] for c in cells} == {"A": "rowspan_crosses_group", "B": None, "1": None, "2": None}
    cells = cells_of("<table><tr><td>x<td rowspan=2>y<tr><td colspan=2>z</table>")
    assert {c["text"]: c["issue"] for c in cells}["z"] == "cells_overlap"


def links(spark, html):
    cells = tables.table_cells(spark.createDataFrame([(1, html)], "page_id long, html string")).cache()
    name = {r["cell_id"]: r["text"] for r in cells.collect()}
    return {(name[r["cell_id"]], r["axis"], name.get(r["header_id"]), r["status"]) for r in tables.header_links(cells).collect()}, cells


def test_multilevel_headers_associate(spark):
    got, _ = links(spark, "<table><thead><tr><th rowspan=2>A<th colspan=2>B<tr><th>C<th>D</thead><tr><th scope=row>r<td>2<td>3</table>")
    assert got == {("2", "column", "B", "resolved"), ("2", "column", "C", "resolved"), ("3", "column", "B", "resolved"), ("3", "column", "D", "resolved"), ("2", "row", "r", "resolved"), ("3", "row", "r", "resolved")}


def test_partial_cover_is_a_candidate_and_explicit_ids_win(spark):
    got, _ = links(spark, '<table><thead><tr><th id=a>A<th id=b>B</thead><tr><td colspan=2>w<tr><td headers="a b zz">v<td>u</table>')
    assert got == {("w", "column", "A", "candidate"), ("w", "column", "B", "candidate"), ("v", "column", "A", "resolved"), ("v", "column", "B", "resolved"), ("v", "other", None, "unresolved"), ("u", "column", "B", "resolved")}


def test_data_between_bands_makes_candidates(spark):
    got, _ = links(spark, "<table><tr><th scope=col>A<tr><td>1<tr><th scope=col>B<tr><td>2</table>")
    assert got == {("1", "column", "A", "resolved"), ("2", "column", "A", "candidate"), ("2", "column", "B", "candidate")}


def test_bad_geometry_has_no_links_and_overlaps_are_found(spark):
    got, cells = links(spark, "<table><tr><th scope=col>h<td rowspan=2>y<tr><td colspan=2>z</table>")
    assert got == set()
    name = {r["cell_id"]: r["text"] for r in cells.collect()}
    assert [(name[r["a"]], name[r["b"]]) for r in tables.overlapping_cells(cells).collect()] == [("y", "z")]


def test_roman_and_alphabets(spark):
    df = spark.createDataFrame([("I", 1), ("iv", 4), ("MCMXCIV", 1994), ("MMMCMXCIX", 3999), ("IIII", None), ("", None), ("VX", None), (None, None)], "r string, n int")
    assert all(a == b for a, b in df.select(legal.roman(F.col("r")), "n").collect())
    pairs = [("a", "b", True), ("d", "đ", True), ("e", "g", True), ("e", "f", True), ("b", "a", False), ("z", "a", False), ("", "a", False)]
    df = spark.createDataFrame(pairs, "a string, b string, ok boolean")
    assert all(x == y for x, y in df.select(legal.successor(F.col("a"), F.col("b")), "ok").collect())


def test_labels_and_citations(spark):
    cases = [("Chương II QUY ĐỊNH CHUNG", "chapter", "ii", True), ("Điều 12. Phạm vi", "article", "12", True), ("Article 3a: scope", "article", "3a", True), ("Điều 5 của Luật này", None, None, None), ("Khoản 2", "clause", "2", True), ("3. text", "clause", "3", False), ("đ) text", "point", "đ", False), ("Tiểu mục 1", "subsection", "1", True), ("Article 7 of this act", None, None, None), ("3.5 percent", None, None, None), ("plain", None, None, None), (None, None, None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, text string, kind string, number string, explicit boolean")
    for r in df.withColumn("l", legal.legal_label(F.col("text"))).collect():
        got = (r["l"]["kind"], r["l"]["number"], r["l"]["explicit"]) if r["l"] else (None, None, None)
        assert got == (r["kind"], r["number"], r["explicit"]), r["text"]


def test_hierarchy_pops_equal_and_higher_levels(spark):
    texts = ["Phần I", "Chương I", "Điều 1. a", "1. x", "a) y", "b) z", "2. x", "Điều 2. b", "a) orphan", "Chương II", "Điều 3. c", "1. x", "1. again", "Khoản 9"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc int, pos int, text string")
    got = {r["pos"]: (r["parent"], r["parent_status"], r["duplicate"]) for r in legal.hierarchy(df, ["doc"], "pos").collect()}
    assert {k: v[0] for k, v in got.items()} == {0: None, 1: 0, 2: 1, 3: 2, 4: 3, 5: 3, 6: 2, 7: 1, 8: 7, 9: 0, 10: 9, 11: 10, 12: 10, 13: 10}
    assert {k for k, v in got.items() if v[1] == "unresolved"} == {8} and {k for k, v in got.items() if v[2]} == {12}


def test_clause_evidence(spark):
    rows = [(1, 1, 1, False, "a", False), (1, 2, 2, False, None, False), (1, 3, 3, True, None, False), (1, 4, 9, False, None, False), (1, 5, 10, False, None, True)]
    df = spark.createDataFrame(rows, "art int, pos int, n int, wall boolean, pt string, field boolean")
    got = {r["pos"]: (r["score"], r["decision"]) for r in legal.clause_evidence(df, ["art"], "pos", "n", barrier=F.col("wall"), next_point=F.col("pt"), form_field=F.col("field")).collect()}
    assert got == {1: (1.0, "clause"), 2: (0.75, "clause"), 3: (0.35, "numbered_paragraph"), 4: (0.75, "clause"), 5: (0.4, "numbered_paragraph")}


def test_prefix_parents(spark):
    rows = [(1, 1, "2"), (1, 2, "2.1"), (1, 3, "2.1.1"), (1, 4, "2.1.1"), (1, 5, "3.1"), (2, 6, "2.2")]
    got = {r["pos"]: (r["parent"], r["issue"]) for r in legal.prefix_parents(spark.createDataFrame(rows, "annex int, pos int, label string"), ["annex"], "pos", "label").collect()}
    missing = "prefix_parent_missing_in_current_annex_scope"
    assert got == {1: (None, None), 2: (1, None), 3: (2, None), 4: (2, "numbering_sequence_conflict"), 5: (None, missing), 6: (None, missing)}
