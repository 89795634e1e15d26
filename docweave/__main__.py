"""Command line: blocks, tables, discover, inventory, audit and compare."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators import blocks, quality, sampling, tables
from docweave.sinks.files import write_report
from docweave.sources import captures, sitemap
from docweave.sources.html_dom import dom_rows


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docweave")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("blocks", "tables"):
        x = sub.add_parser(name, help=f"{name} of a table of pages")
        x.add_argument("pages")
        x.add_argument("out")
    x = sub.add_parser("discover", help="inventory of URLs from captured sitemaps (Parquet with url and xml)")
    x.add_argument("sitemaps")
    x.add_argument("out")
    x.add_argument("--root", action="append", required=True)
    x.add_argument("--host", required=True)
    x = sub.add_parser("inventory", help="verify captures below a folder")
    x.add_argument("root")
    x.add_argument("out")
    x.add_argument("--host", required=True)
    x = sub.add_parser("audit", help="parse pages, report status and conservation")
    x.add_argument("pages")
    x.add_argument("report")
    x = sub.add_parser("compare", help="sizes of two tables of pages by page")
    x.add_argument("before")
    x.add_argument("after")
    x.add_argument("report")
    return p


def page_audit(pages: DataFrame) -> DataFrame:
    """Status of every page, with its source text compared to that of its blocks."""
    dom = dom_rows(pages)
    # leaves inside hidden elements and outside a single body show nothing
    hidden = dom.where("tag in ('head', 'script', 'style', 'template')").select("page_id", F.col("dom_order").alias("lo"), F.col("last_order").alias("hi"))
    leaves = dom.where("kind in ('text', 'cdata')").select("page_id", "dom_order", "text")
    shown = leaves.join(hidden, "page_id", "left").groupBy("page_id", "dom_order", "text").agg(F.max(F.coalesce(F.expr("dom_order between lo and hi"), F.lit(False))).alias("h")).where("not h")
    out = blocks.block_stream(pages).select("page_id", F.col("block_order").alias("dom_order"), "text")
    kept = quality.conservation(shown, out, ["page_id"], ["dom_order"])
    return quality.page_status(dom).join(kept, "page_id", "left")


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("docweave").getOrCreate()
    if a.command in ("blocks", "tables"):
        pages = spark.read.parquet(a.pages)
        (blocks.block_stream(pages) if a.command == "blocks" else tables.table_cells(pages)).write.parquet(a.out)
    elif a.command == "discover":
        sitemap.inventory(sitemap.expand(spark.read.parquet(a.sitemaps), a.root, a.host), a.host).write.json(a.out)
    elif a.command == "inventory":
        inv = captures.inventory(captures.verify(captures.read_manifests(spark, a.root), captures.read_files(spark, a.root), a.host))
        inv.write.parquet(a.out)
        return int(not inv.where("not usable").isEmpty())
    elif a.command == "audit":
        x = page_audit(spark.read.parquet(a.pages)).groupBy("status").agg(F.count(F.lit(1)).alias("pages"), F.count_if("text_conserved").alias("conserved"))
        rows = [r.asDict() for r in x.orderBy("status").collect()]
        write_report(a.report, "Audit", {"status": rows})
        return int(any(r["status"] == "failed" for r in rows))
    elif a.command == "compare":
        size = lambda p: spark.read.parquet(p).select("page_id", F.octet_length("html").cast("long").alias("n"))
        write_report(a.report, "Sizes", {"sizes": [r.asDict() for r in sampling.compare_sizes(size(a.before), size(a.after), "page_id", "n").collect()]})
    return 0


if __name__ == "__main__":
    sys.exit(main())
