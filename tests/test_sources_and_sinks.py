import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from docweave import __main__ as cli
from docweave.functions import urls
from docweave.operators import blocks, metadata, quality, sampling
from docweave.sinks import files, html_clean
from docweave.sources import captures, sitemap
from docweave.streaming import waves

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:xhtml="http://www.w3.org/1999/xhtml"'


def test_sitemap_scan():
    assert sitemap.locations(f'<urlset {NS}><url><loc> https://e.org/a </loc><xhtml:link href="https://e.org/b"/></url><url/></urlset>') == ("urlset", ["https://e.org/a"])
    assert sitemap.locations(f"<sitemapindex {NS}><sitemap><loc>https://e.org/s.xml</loc></sitemap></sitemapindex>") == ("sitemapindex", ["https://e.org/s.xml"])
    for bad in (None, "", "plain", "<html/>", "<urlset>", '<!DOCTYPE x [<!ENTITY a "b">]><urlset/>'):
        assert sitemap.locations(bad) == (None, [])


def test_sitemaps_expand_once_and_urls_are_first_seen(spark):
    index = lambda *u: f"<sitemapindex {NS}>{''.join(f'<sitemap><loc>{x}</loc></sitemap>' for x in u)}</sitemapindex>"
    pages = lambda *u: f"<urlset {NS}>{''.join(f'<url><loc>{x}</loc></url>' for x in u)}</urlset>"
    maps = [("https://e.org/i", index("https://e.org/1", "https://e.org/2", "https://e.org/i", "https://other.org/3")), ("https://e.org/1", pages("https://e.org/luat-2020--ab-1?x=1", "https://e.org/p")), ("https://e.org/2", pages("https://e.org/p#f", "http://e.org/q", "https://e.org/no/1", "https://e.org/7")), ("https://other.org/3", pages("https://e.org/never"))]
    e = sitemap.expand(spark.createDataFrame(maps, "url string, xml string"), ["https://e.org/i"], "e.org")
    got = {r["canonical_url"]: (r["sitemap"], r["document_id"], r["type_hint"], r["year_hint"]) for r in sitemap.inventory(e, "e.org", disallowed=["/no/"]).collect()}
    assert set(got) == {"https://e.org/luat-2020--ab-1", "https://e.org/p", "https://e.org/7"}
    assert got["https://e.org/luat-2020--ab-1"] == ("https://e.org/1", "ab-1", "law", 2020) and got["https://e.org/p"][0] == "https://e.org/1" and got["https://e.org/7"][1] == "7"


def test_names_and_magic_bytes(spark):
    df = spark.createDataFrame([("a/b\\c:d?.pdf", bytearray(b"%PDF-1.4 x %%EOF")), ("..", bytearray(b"PK\x03\x04 cut")), (" x. ", bytearray(b"<!DOCTYPE html>")), (None, bytearray(b""))], "n string, b binary")
    assert [tuple(r) for r in df.select(urls.safe_name(F.col("n")), urls.file_kind(F.col("b"))).collect()] == [("c_d_.pdf", "pdf"), ("download", "truncated"), ("x", "html"), ("download", "unknown")]


def capture(root, folder, ident, url, text="body", **other):
    at = root / folder
    at.mkdir(parents=True)
    (at / "c.html").write_text(text)
    m = {"document_id": ident, "source_url": url, "document_scope": "s", "status": "complete", "identity_verified": True, "content_complete": True, "tabs": {"content": "c.html"}, "files": [{"path": "c.html", "bytes": len(text), "sha256": hashlib.sha256(text.encode()).hexdigest()}]}
    (at / "manifest.json").write_text(json.dumps(m | other))


def test_captures_are_verified_and_the_reviewed_one_is_preferred(spark, tmp_path):
    capture(tmp_path / "a", "d1", "d1", "https://e.org/d1")
    capture(tmp_path / "b", "d1", "d1", "https://e.org/d1?x=2")
    capture(tmp_path / "a", "d2", "d2", "https://e.org/d2", files=[{"path": "c.html", "bytes": 9, "sha256": "00"}])
    capture(tmp_path / "a", "d3", "d3", "https://e.org/d3-d4")
    capture(tmp_path / "a", "d4", "d4", "https://e.org/d3-d4")
    capture(tmp_path / "a", "d5", "d5", "https://x.org/d5", status="failed", tabs={})
    (tmp_path / "a" / "d6").mkdir()
    (tmp_path / "a" / "d6" / "manifest.json").write_text("{no json")
    v = captures.verify(captures.read_manifests(spark, str(tmp_path)), captures.read_files(spark, str(tmp_path)), "e.org").cache()
    name = lambda r: r["capture"].split(str(tmp_path))[1]
    problems = {name(r): r["problems"] for r in v.collect()}
    assert problems["/a/d1"] == [] and problems["/a/d2"] == ["size_differs", "hash_differs"] and problems["/a/d5"] == ["wrong_host", "not_complete", "tabs_incomplete"]
    assert "unreadable_manifest" in problems["/a/d6"]
    reviewed = v.where(F.col("capture").endswith("b/d1")).select("capture")
    inv = captures.inventory(v, reviewed)
    got = {name(r): (r["usable"], r["preferred"], r["url_conflict"]) for r in inv.collect()}
    assert got["/b/d1"] == (True, True, False) and got["/a/d1"] == (True, False, False) and got["/a/d3"] == (False, False, True) == got["/a/d4"]
    assert tuple(captures.inventory_summary(inv).first()) == (7, 2, 5, 1, 1, 2)
    assert captures.inventory(v).where("preferred").select("capture").first()[0].endswith("a/d1")


def test_archive_members(tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("in/x.json", "1")
    assert captures.read_member(f"{tmp_path}/s.zip!/in/x.json") == b"1"
    for bad in ("../x", "/x", "in/../x", "a\\b"):
        with pytest.raises(ValueError, match="archive"):
            captures.read_member(f"{tmp_path}/s.zip!/{bad}")


def test_files_are_replaced_whole_and_folders_come_back(tmp_path, monkeypatch):
    files.write_atomic(tmp_path / "a.json", files.canonical_json({"b": "é", "a": [1]}))
    assert (tmp_path / "a.json").read_text() == '{\n  "b": "é",\n  "a": [\n    1\n  ]\n}\n'
    (tmp_path / "new").mkdir()
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "x").write_text("1")
    move, calls = files.os.replace, []

    def broken(a, b):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("full")
        move(a, b)

    monkeypatch.setattr(files.os, "replace", broken)
    with pytest.raises(OSError, match="full"):
        files.publish(tmp_path / "new", tmp_path / "old")
    assert (tmp_path / "old" / "x").read_text() == "1"
    monkeypatch.setattr(files.os, "replace", move)
    files.publish(tmp_path / "new", tmp_path / "old")
    assert not list((tmp_path / "old").iterdir()) and sorted(p.name for p in tmp_path.iterdir()) == ["a.json", "old"]


def test_progress_goes_on_and_refuses_other_settings(tmp_path):
    p = files.Progress(tmp_path / "p.json", {"target": 3})
    for i in ("b", "a", "b"):
        p.add({"document_id": i, "result": "complete"})
    p.add({"document_id": "c", "result": "failed"})
    again = files.Progress(tmp_path / "p.json", {"target": 3})
    assert again.pending(["a"]) == ["b"] and again.text() == "2 captured in 4 attempts, target 3"
    with pytest.raises(ValueError, match="target"):
        files.Progress(tmp_path / "p.json", {"target": 4})


def test_bundles(spark, tmp_path):
    rows = [("d1", "a.html", "é"), ("d1", "b.html", None), ("d2", "a", "x"), ("d2", "a", "y"), ("d3", "../a", "x"), (None, "a", "x")]
    got = {r["key"]: (r["files"], r["published"], r["problem"]) for r in files.write_bundles(spark.createDataFrame(rows, "doc string, name string, body string"), str(tmp_path), "doc", "name", "body").collect()}
    assert got == {"d1": (2, True, None), "d2": (2, False, "repeated_file_names"), "d3": (1, False, "unsafe_name")}
    assert [p.name for p in tmp_path.iterdir()] == ["d1"]
    m = json.loads((tmp_path / "d1" / "manifest.json").read_text())
    assert [f["path"] for f in m["files"]] == ["a.html", "b.html"] and m["files"][0]["sha256"] == hashlib.sha256("é".encode()).hexdigest()
    assert files.fingerprint([tmp_path / "d1" / "a.html"]) != files.fingerprint([tmp_path / "d1" / "b.html"])


def test_cleaned_html_and_reports(tmp_path):
    html = '<p onclick=x>a &lt;b<script>evil()</script><a href="javascript:1">l</a><a href="https://e.org/?a=1&b=2">m</a><table><tr><td colspan=2 rowspan=x>c</table><font>f</font>'
    assert html_clean.clean_html(html) == '<p>a &lt;b<a>l</a><a href="https://e.org/?a=1&amp;b=2">m</a></p><table><tr><td colspan="2">c</td></tr></table>f'
    files.write_report(tmp_path, "T", {"s": [{"a": 1, "b": "x|y"}], "none": []})
    assert (tmp_path / "report.md").read_text() == "# T\n\n## s\n\n| a | b |\n|---|---|\n| 1 | x\\|y |\n\n## none\n\n_none_\n"
    assert files.tree_lines([{"depth": 0, "type": "body"}, {"depth": 1, "type": "article", "label": "1"}]) == "body\n  article 1"


def test_blocks():
    html = '<body>Hi <b>there</b><br>line<p>One <sup>2</sup> para<div style="text-align:center"><b>Bold</b></div><ol start=3><li>a<li value=7><p>b</p><li>c<ul><li>d</ul></ol><hr><h2>T &amp; U</h2><a href="/x--ab?docId=9">k</a> tail<script>no</script>'
    got = [(b["type"], b["text"], b["ordinal"], b["parent_block"]) for b in blocks.blocks_of(html, "https://e.org/p")]
    assert got == [("paragraph", "Hi there\nline", None, -1), ("paragraph", "One 2 para", None, -1), ("paragraph", "Bold", None, -1), ("list", None, None, -1), ("list_item", "a", 3, 3), ("list_item", "b", 7, 3), ("list_item", None, 8, 3), ("paragraph", "c", None, 6), ("list", None, None, 6), ("list_item", "d", None, 8), ("separator", None, None, -1), ("heading", "T & U", None, -1), ("paragraph", "k tail", None, -1)]
    b = blocks.blocks_of(html, "https://e.org/p")
    assert b[2]["bold"] and b[2]["align"] == "center" and not b[0]["bold"] and b[1]["annotations"] == [{"type": "sup", "start": 4, "end": 5}]
    assert b[-1]["links"] == [{"href": "/x--ab?docId=9", "url": "https://e.org/x--ab?docId=9", "identifiers": ["ab", "9"]}]
    assert [x["ordinal"] for x in blocks.blocks_of("<ol reversed><li>a<li>b</ol>")] == [None, 2, 1]
    assert blocks.blocks_of(None) == [] == blocks.blocks_of("") and blocks.rendered_text("<p>a\xa0 b<p>c<table><tr><td>1<td>2</table>") == "a b\nc\n1 2"
    assert blocks.link_record("http://[bad", None, {})["url"] is None


def test_conservation_and_issues(spark):
    src = spark.createDataFrame([(1, 2, " b c"), (1, 1, "a "), (2, 1, "x"), (3, 1, "gone")], "p int, o int, text string")
    out = spark.createDataFrame([(1, 1, "ab"), (1, 2, "c"), (2, 1, "y")], "p int, o int, text string")
    got = {r["p"]: (r["text_conserved"], r["source_chars"], r["output_chars"]) for r in quality.conservation(src, out, ["p"], ["o"]).collect()}
    assert got == {1: (True, 3, 3), 2: (False, 1, 1), 3: (False, 4, 0)}
    df = spark.createDataFrame([(1, "unclosed", "m"), (1, "unclosed", "m"), (1, "other", "m"), (2, None, "m")], "p int, code string, m string")
    rows = quality.issues(df, ["p"], F.col("code"), F.col("m"), F.lit("s"), F.lit(None).cast("string"), F.when(F.col("code") == "other", "error")).collect()
    assert sorted((r["p"], r["code"], r["severity"]) for r in rows) == [(1, "other", "error"), (1, "unclosed", "warning")]
    body = '{"code":"unclosed","details":null,"message":"m","severity":"warning","source_ref":"s"}'
    assert {r["issue_id"] for r in rows if r["code"] == "unclosed"} == {"issue_" + hashlib.sha256(body.encode()).hexdigest()[:16]}


def test_property_fields_and_history():
    box = lambda inner: f'<div class="x ant-descriptions-item-container">{inner}</div>'
    span = lambda c, t: f'<span class="ant-descriptions-item-{c}">{t}</span>'
    html = box(span("label", "Số hiệu") + span("content", "1/2020")) + box(span("label", "L") + "extra" + span("content", "v")) + box(span("label", "only"))
    assert [(f["label"], f["value"], f["role"], f["evidence"]) for f in metadata.fields_of(html)] == [("Số hiệu", "1/2020", "field", "label_content_markup"), (None, "Lextrav", "unknown", "extra_field_text"), (None, "only", "unknown", "ambiguous_field_markup")]
    old = "<table><tr><td>Ngày ban hành: 1/1/2020<td>whatever</table>"
    assert [(f["label"], f["value"]) for f in metadata.fields_of(old)] == [("Ngày ban hành", "1/1/2020"), (None, "whatever")]
    table = '<table><tr><th>Thời gian<th>Trạng thái<th>Văn bản nguồn<th>Khác<tr><td>2020<td>ok<td><a href="https://e.org/1">S</a><td>z<tr><th>a<th>b<th>c<th>d</table>'
    assert metadata.events_of(table) == [{"table_id": 0, "row": 1, "simple": True, "other_values": [("Khác", "z")], "date": "2020", "status": "ok", "source_document": "S", "source_url": "https://e.org/1"}]
    for odd in ("<table><tr><th>a<th>a<tr><td>1<td>2</table>", "<table><tr><th>a<tr><td colspan=2>1</table>", "<table><tr><td>1</table>", "<table><tr><th>a<tr><td><ul><li>1</ul></table>"):
        assert [e["simple"] for e in metadata.events_of(odd)] == [False]
    assert metadata.fields_of(None) == [] == metadata.events_of("")


def test_relation_groups(spark):
    rows = [(1, 0, "before", [], []), (1, 1, "Amends (2)", [], []), (1, 2, "a", ["u"], []), (1, 3, "b", [], ["9"]), (1, 4, "Repeals (1)", [], []), (1, 5, "--", [], []), (1, 6, "None (0)", [], [])]
    g, i = metadata.relation_groups(spark.createDataFrame(rows, "doc int, pos int, text string, urls array<string>, numbers array<string>"), ["doc"], "pos", urls="urls", numbers="numbers")
    assert sorted((r["name"], r["declared"], r["n_items"], r["n_ignored"], r["mismatch"]) for r in g.collect()) == [("Amends", 2, 2, 0, False), ("None", 0, 0, 0, False), ("Repeals", 1, 0, 1, True)]
    assert {r["text"]: r["resolution_status"] for r in i.collect()} == {"a": "source_reference", "b": "candidate_only"}


def test_samples(spark):
    assert sampling.quotas(5, ("x", "y")) == ["x", "y", "x", "y", "x"] and sampling.quotas(4, ("x", "y"), 1) == ["x", "y", "y", "y"]
    assert sampling.pending(["b", "a", "b", "c"], ["c"]) == ["b", "a"]
    cols = "document_id string, url string, scope string, type string, bucket string, decade string, family string"
    c = spark.createDataFrame([(f"d{i}", f"u{i}", "s" if i else "t", "law" if i < 4 else "decree", None, "2000", "f" if i != 5 else "g") for i in range(7)], cols)
    a = spark.createDataFrame([("d1", "u1", "law", None, "2000", "f", "complete"), ("d9", "u9", "law", "b", "2000", "f", "failed"), ("d8", "u8", "law", "b", "2000", "f", "scope_hint_mismatch"), ("d7", "u7", "law", "b", "2000", "g", "environment")], "document_id string, url string, type string, bucket string, decade string, family string, result string")
    assert sampling.next_candidate(c, a, "s").first()["document_id"] == "d5"  # the family without a mismatch
    assert sampling.next_candidate(c, a, "none").count() == 0
    ids, deficit = sampling.target_manifest(c, ["d2"], 4)
    assert ids[0] == "d2" and len(set(ids)) == 4 and deficit == 0 and "d0" in ids and {"d4", "d5", "d6"} & set(ids)
    assert sampling.target_manifest(c, [], 9)[1] == 2
    with pytest.raises(ValueError, match="d77"):
        sampling.target_manifest(c, ["d77"], 4)
    assert tuple(sampling.attempt_summary(a).first())[:3] == (4, 1, 1) and sampling.attempt_summary(a.limit(0)).first()["acceptance_rate"] is None
    g = sampling.failing_gates(spark.createDataFrame([(1, True, None)], "x int, a boolean, b boolean"), {"a": F.col("a"), "b": F.col("b"), "c": F.col("x") > 1})
    assert g.first()["failing"] == ["b", "c"]
    n = spark.createDataFrame([(1, 4), (2, 6)], "k int, n int")
    assert sampling.compare_sizes(n, n.withColumn("n", F.col("n") - 1), "k", "n").first()["reduction_percent"] == 20.0
    with pytest.raises(Exception, match="one side"):
        sampling.compare_sizes(n, n.where("k = 1"), "k", "n").collect()
    assert [r["document_id"] for r in sampling.repeated(spark.createDataFrame([("a",), ("a",), ("b",)], "document_id string"), "document_id").collect()] == ["a"]


def test_waves_settle_once_and_go_on(spark, tmp_path):
    src, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    row = lambda n, doc, result="complete", **o: json.dumps({"attempt": n, "wave": 1, "scope": "s", "document_id": doc, "result": result, "found_scope": "s"} | o) + "\n"
    (src / "1.json").write_text(row(1, "a") + row(2, "a") + row(3, "b", found_scope="t") + row(4, None, "failed", error="DNS lookup") + row(5, "c", "failed"))
    waves.run_waves(spark, str(src), out, mark).awaitTermination()
    (src / "2.json").write_text(row(6, "a") + row(7, "d", "reused_capture"))
    waves.run_waves(spark, str(src), out, mark).awaitTermination()
    waves.run_waves(spark, str(src), out, mark).awaitTermination()
    got = spark.read.parquet(out)
    assert {r["attempt"]: r["result"] for r in got.collect()} == {1: "complete", 2: "duplicate", 3: "scope_hint_mismatch", 4: "environment", 5: "failed", 6: "duplicate", 7: "reused_capture"}
    assert tuple(waves.wave_complete(got, 1, 2).first()) == (2, 53, True)
    caps = spark.createDataFrame([("a", "u", "p", "s", True, True), ("x", "v", "q", "s", True, True), ("y", "w", "r", "s", False, False)], "document_id string, source_url string, capture string, document_scope string, usable boolean, preferred boolean")
    assert [r["document_id"] for r in waves.fill_from_captures(caps, got, 2, "s", 5).collect()] == ["x"]
    reuse = captures.first_reusable(spark.createDataFrame([(1, 1, "s", "p", "scope_hint_mismatch"), (1, 2, "s", "q", "scope_hint_mismatch")], "wave int, attempt int, scope string, capture string, result string"), spark.createDataFrame([("p",)], "capture string"))
    assert [r["capture"] for r in reuse.collect()] == ["q"]


def test_command_line(spark, tmp_path):
    spark.createDataFrame([(1, "https://e.org", "<p>a<table><tr><td>x</table>"), (2, None, None)], "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    assert cli.main(["blocks", f"{tmp_path}/p", f"{tmp_path}/b"]) == 0 and spark.read.parquet(f"{tmp_path}/b").count() == 2
    assert cli.main(["tables", f"{tmp_path}/p", f"{tmp_path}/t"]) == 0 and spark.read.parquet(f"{tmp_path}/t").count() == 1
    assert cli.main(["audit", f"{tmp_path}/p", f"{tmp_path}/r"]) == 0
    assert json.loads((tmp_path / "r" / "report.json").read_text()) == {"status": [{"status": "success", "pages": 1, "conserved": 1}]}
    assert cli.main(["compare", f"{tmp_path}/p", f"{tmp_path}/p", f"{tmp_path}/c"]) == 0
    capture(tmp_path / "raw", "d1", "d1", "https://e.org/d1")
    assert cli.main(["inventory", f"{tmp_path}/raw", f"{tmp_path}/i", "--host", "e.org"]) == 0
    spark.createDataFrame([("https://e.org/i", f"<urlset {NS}><url><loc>https://e.org/1</loc></url></urlset>")], "url string, xml string").write.parquet(f"{tmp_path}/m")
    assert cli.main(["discover", f"{tmp_path}/m", f"{tmp_path}/d", "--root", "https://e.org/i", "--host", "e.org"]) == 0
    with pytest.raises(SystemExit):
        cli.main(["nothing"])
