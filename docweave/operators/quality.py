"""Diagnostics, status, conservation and audits as relational queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERITIES = ("info", "warning", "error", "fatal")
# Fixed severities by issue code.
SEVERITY = {"implied_end": "info", "duplicate_attribute": "info", "unclosed": "warning", "misnested_end": "warning", "unmatched_end": "warning", "multiple_bodies": "warning", "semantic_text_mismatch": "fatal"}


def severity_of(code: Column, given: Column | None = None) -> Column:
    """The given severity, else the code's own, else warning; null without a code."""
    table = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    own = F.when(code.isNotNull(), F.coalesce(table[code], F.lit("warning")))
    return own if given is None else F.coalesce(given, own)


def severity_counts(severity: Column) -> list[Column]:
    """Aggregates n_info, n_warning, n_error and n_fatal, all present, zero where nothing is."""
    return [F.count_if(F.coalesce(severity == s, F.lit(False))).alias(f"n_{s}") for s in SEVERITIES]


def status(n_fatal: Column, n_error: Column, n_warning: Column) -> Column:
    """failed on any fatal or error, else success_with_warnings on any warning, else success."""
    return F.when(n_fatal + n_error > 0, "failed").when(n_warning > 0, "success_with_warnings").otherwise("success")


def issues(df: DataFrame, keys: list[str], code: Column, message: Column, source: Column, details: Column, severity: Column | None = None) -> DataFrame:
    """Issue rows with a content hash as id; equal issues of one key count once.

    The id is ``issue_`` and 16 hex digits of the hash of the issue as JSON, its
    names in alphabetical order.
    """
    body = F.struct(code.alias("code"), details.alias("details"), message.alias("message"), severity_of(code, severity).alias("severity"), source.alias("source_ref"))
    out = df.where(code.isNotNull()).select(*keys, body.alias("b"))
    ident = F.concat(F.lit("issue_"), F.substring(F.sha2(F.to_json("b", {"ignoreNullFields": "false"}), 256), 1, 16))
    return out.select(*keys, ident.alias("issue_id"), "b.severity", "b.code", "b.message", "b.source_ref", "b.details").dropDuplicates([*keys, "issue_id"])


def ordered_text(order: Column, text: Column) -> Column:
    """Aggregate: all texts in order, without white space.  A page's texts meet in one row, as its HTML did."""
    rows = F.collect_list(F.when(text.isNotNull(), F.struct(order.alias("o"), text.alias("t"))))
    joined = F.array_join(F.transform(F.array_sort(rows), lambda x: x["t"]), "")
    return F.regexp_replace(joined, "(?U)\\s+", "")


def conservation(source: DataFrame, output: DataFrame, keys: list[str], order: list[str], text: str = "text") -> DataFrame:
    """Source and output texts of every key, compared without white space: lengths, hashes, whether they are equal.

    Keys that one side lacks have the empty text there.
    """
    at = F.struct(*order)
    side = lambda df, name: df.groupBy(*keys).agg(ordered_text(at, F.col(text)).alias(name))
    both = side(source, "s").join(side(output, "o"), keys, "full_outer").withColumns({c: F.coalesce(c, F.lit("")) for c in "so"})
    return both.select(*keys, F.length("s").alias("source_chars"), F.length("o").alias("output_chars"), F.sha2("s", 256).alias("source_sha256"), F.sha2("o", 256).alias("output_sha256"), (F.col("s") == F.col("o")).alias("text_conserved"), F.col("s").contains("\ufffd").alias("replacement_glyph"))


def page_status(dom: DataFrame) -> DataFrame:
    """One row per page: nodes, text hash, issues by severity, status."""
    severity = severity_of(F.col("issue"))
    text = F.when(F.col("kind") == "text", F.struct("dom_order", "text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda x: x["text"]), "")
    node = F.col("kind") != "issue"
    out = dom.groupBy("page_id").agg(
        F.count_if(node).alias("n_nodes"), F.max("dom_order").alias("last_order"), F.max("depth").alias("max_depth"), F.count_if(F.col("kind") == "text").alias("n_texts"),
        F.sha2(F.regexp_replace(joined, "[ \\t\\n\\r\\f]+", " "), 256).alias("text_sha256"), *severity_counts(severity),
    )
    out = out.withColumn("dense_order", F.col("last_order") + 1 == F.col("n_nodes"))
    return out.withColumn("status", status(F.col("n_fatal"), F.col("n_error"), F.col("n_warning")))


def document_flags(tabs: DataFrame, key: str, flags: list[str]) -> DataFrame:
    """Quality flags of a document: each holds where it holds in all its tabs."""
    return tabs.groupBy(key).agg(F.count(F.lit(1)).alias("n_tabs"), *[F.coalesce(F.bool_and(f), F.lit(False)).alias(f) for f in flags])


def key_audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys by where they occur, with counts on either side."""
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    return a.join(b, key, "full_outer").select(key, F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))
