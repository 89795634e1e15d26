"""Sitemaps: XML scan, expansion level by level, first-seen inventory."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.scalars import canonical_url
from docweave.functions.urls import in_scope, stable_id, type_hint, year_hint


def locations(xml: str | None) -> tuple[str | None, list[str]]:
    """(kind, locs) of one document: sitemapindex or urlset; anything else, entities included, has kind None."""
    if not xml or "<!DOCTYPE" in xml or "<!ENTITY" in xml:
        return None, []
    try:
        root = ET.fromstring(xml.strip())
    except ET.ParseError:
        return None, []
    name = lambda e: e.tag.rsplit("}", 1)[-1]
    entry = {"sitemapindex": "sitemap", "urlset": "url"}.get(name(root))
    if entry is None:
        return None, []
    # only loc of the entries themselves; alternates are links, not locs
    found = [(c.text or "").strip() for e in root if name(e) == entry for c in e if name(c) == "loc"]
    return name(root), [x for x in found if x]


def scan(sitemaps: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """(sitemap, kind, pos, loc) of every entry; a document that is no sitemap gives one row with kind null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for u, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                kind, locs = locations(x)
                rows += [(u, kind, i, loc) for i, loc in enumerate(locs)] or [(u, kind, None, None)]
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.string()), strict=True)], names=["sitemap", "kind", "pos", "loc"])

    return sitemaps.select(url, xml).mapInArrow(run, "sitemap string, kind string, pos int, loc string")


def expand(sitemaps: DataFrame, roots: list[str], host: str, prefix: str = "/", most: int = 10) -> DataFrame:
    """(sitemap, level, kind, pos, loc) reachable from ``roots`` through indexes of one host, each sitemap once.

    One join a level over a captured table; at most ``most`` levels, beyond
    which an error says that the index is nested too deeply.
    """
    entries = scan(sitemaps)
    spark = sitemaps.sparkSession
    front = spark.createDataFrame([(r,) for r in dict.fromkeys(roots)], "sitemap string")
    seen, out = front, None
    for level in range(most + 1):
        found = entries.join(front, "sitemap").withColumn("level", F.lit(level))
        out = found if out is None else out.unionByName(found)
        front = found.where("kind = 'sitemapindex'").select(F.col("loc").alias("sitemap")).where(in_scope(F.col("sitemap"), host, prefix)).distinct().join(seen, "sitemap", "left_anti")
        if front.isEmpty():
            return out
        seen = seen.union(front)
    raise ValueError(f"sitemap indexes nest deeper than {most} levels")


def inventory(entries: DataFrame, host: str, prefix: str = "/", disallowed: list[str] | None = None) -> DataFrame:
    """One row per canonical URL, as first seen by level, sitemap and place, with its identity and hints; robots' disallowed prefixes are left out."""
    u = entries.where("kind = 'urlset' and loc is not null").withColumn("canonical_url", canonical_url(F.col("loc")))
    u = u.where(in_scope(F.col("canonical_url"), host, prefix))
    path = F.regexp_replace("canonical_url", "^[a-z]+://[^/]+", "")
    for p in disallowed or []:
        u = u.where(~path.startswith(p))
    w = Window.partitionBy("canonical_url").orderBy("level", "sitemap", "pos")
    first = u.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    c = F.col("canonical_url")
    return first.select("canonical_url", "sitemap", "pos", stable_id(c).alias("document_id"), type_hint(c).alias("type_hint"), year_hint(c).alias("year_hint"))
