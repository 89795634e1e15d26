"""Scalar library as Catalyst expressions: labels, URLs, numbers, whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vietnamese letters with marks and their plain forms; fixed values.
MARKED = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
PLAIN = "aaaaaaaaaaaaaaaaaeeeeeeeeeeeiiiiiooooooooooooooooouuuuuuuuuuuyyyyyd"


def whitespace(c: Column) -> Column:
    """Runs of white space, no-break spaces included, as one space; ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def fold_label(c: Column) -> Column:
    """Lower case without marks and without a trailing count in brackets."""
    return F.translate(F.lower(F.trim(F.regexp_replace(c, r"\s*\(\d+\)\s*$", ""))), MARKED, PLAIN)


def canonical_url(c: Column) -> Column:
    return F.regexp_replace(c, "[?#].*$", "")


def url_host(c: Column) -> Column:
    return F.regexp_extract(c, "^[a-z]+://([^/]+)", 1)


def url_identity(c: Column) -> Column:
    """The trailing number of the path, else the start of the URL's hash."""
    u = canonical_url(c)
    tail = F.regexp_extract(u, "([0-9]+)$", 1)
    return F.when(tail != "", tail).otherwise(F.substring(F.sha2(u, 256), 1, 32))


def source_family(c: Column) -> Column:
    tail = F.regexp_extract(canonical_url(c), "([^/]*)$", 1)
    return F.when(tail.rlike("^[0-9]+$"), "numeric").when(tail.rlike("^[0-9a-f-]{32,36}$"), "opaque").otherwise(F.regexp_extract(tail, "^([a-z]*)", 1))


def numbers(c: Column) -> Column:
    """Distinct digit runs in order of first mention."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit("([0-9]+)"), 1))
