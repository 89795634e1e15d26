import datetime

import duckdb
import pytest
from pyspark.sql import functions

from docweave.functions import scalars
from docweave.plans import registry
from docweave.sources.html_dom import TreeRows, dom_rows

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(rows):
    def one(v):
        if isinstance(v, float):
            return round(v, 4)
        return str(v)[:10] if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime) else v

    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = plain(tuple(r) for r in df.select(*cols).collect())
    assert got == plain(duck.sql(f"select {','.join(cols)} from ({registry.ORACLE_SQL[name]})").fetchall())


def test_block_stream_reads_references_as_its_sql_does(spark, duck, tmp_path):
    html = ["<h1>A&amp;&amp</h1><h2>b &lt;i&gt; &quot;&am</h2>", "<h3>&copy; &#65; &amp;lt; &lt x</h3><p>c&amp", "<h1>&amp</h1>", None]
    spark.createDataFrame(list(enumerate(html)), "page_id bigint, html string").withColumn("url", functions.lit("https://e.org/")).write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.QUERIES["block_stream"](spark, str(tmp_path)).select("page_id", "heading", "level", "text").collect()
    sql = f"with pages as (from '{tmp_path}/pages.parquet/*.parquet') select page_id, heading, level, text from ({registry.ORACLE_SQL['block_stream']})"
    assert plain(tuple(r) for r in got) == plain(duck.sql(sql).fetchall())
    assert (0, 0, 1, "A&&amp") in [tuple(r) for r in got]


def tree(html):
    t = TreeRows()
    t.feed(html)
    return t.finish()


def test_optional_end_tags_are_implied_inside_their_scope():
    rows = tree("<ul><li>a<ul><li>b</ul><li>c</ul>")
    items = [r for r in rows if r["tag"] == "li"]
    assert [r["depth"] for r in items] == [1, 3, 1]
    assert [r["issue"] for r in items] == ["implied_end"] * 3


def test_a_start_tag_ends_every_open_element_of_its_scope_that_may_lack_an_end_tag():
    rows = tree("<table><tbody><tr><td><p>a<td>b<tr><td>c<tfoot><tr><td>d</table>")
    assert [(r["tag"], r["depth"]) for r in rows if r["kind"] == "element"] == [("table", 0), ("tbody", 1), ("tr", 2), ("td", 3), ("p", 4), ("td", 3), ("tr", 2), ("td", 3), ("tfoot", 1), ("tr", 2), ("td", 3)]
    rows = tree("<table><tr><td><table><tr><td>x</table>y<td>z</table>")
    assert [r["depth"] for r in rows if r["tag"] == "td"] == [2, 5, 2]
    rows = tree("<dl><dt>a<dd>b<dt>c</dl><select><option>1<option>2</select><p>x<div>y</div>")
    assert [r["depth"] for r in rows if r["kind"] == "element"] == [0, 1, 1, 1, 0, 1, 1, 0, 0]


def test_bad_markup_is_reported_and_text_kept():
    rows = tree("<p>one</b> two<p a=1 a=2>three")
    assert "unmatched_end" in {r["issue"] for r in rows}
    assert "".join(r["text"] for r in rows if r["kind"] == "text") == "one two" + "three"
    nodes = [r for r in rows if r["kind"] != "issue"]
    assert [r["dom_order"] for r in nodes] == list(range(len(nodes)))  # end tags do not tick
    three = next(r for r in nodes if r["tag"] == "p" and r["attrs"])
    assert three["attrs"] == {"a": "2"} and three["raw_attrs"] == [{"k": "a", "v": "1"}, {"k": "a", "v": "2"}]


def test_only_comments_with_content_tick_and_two_bodies_are_reported():
    rows = tree("<body>a<!-- --><!-- c -->b<body>d")
    assert [r["kind"] for r in rows if r["kind"] != "issue"] == ["element", "text", "comment", "text", "element", "text"]
    assert [r["issue"] for r in rows if r["kind"] == "issue"] == ["multiple_bodies"]


def test_null_and_empty_pages_have_no_rows(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x")], "page_id long, html string")
    assert {r["page_id"] for r in dom_rows(pages).collect()} == {3}


def test_labels_fold_marks_and_counts(spark):
    df = spark.createDataFrame([("Văn bản Đã sửa (12)",)], "x string")
    from pyspark.sql import functions as F

    assert df.select(scalars.fold_label(scalars.whitespace(F.col("x")))).first()[0] == "van ban da sua"
