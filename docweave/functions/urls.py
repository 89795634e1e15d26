"""URL and file-name expressions: identity, scope and type hints, safe names, magic bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.scalars import canonical_url

# Leading parts of a slug and the document types they hint at; fixed values.
TYPE_HINTS = {"luat": "law", "nghi-dinh": "decree", "thong-tu": "circular", "quyet-dinh": "decision", "nghi-quyet": "resolution", "chi-thi": "directive", "phap-lenh": "ordinance", "cong-van": "letter"}


def path_tail(url: Column) -> Column:
    return F.regexp_extract(canonical_url(url), "([^/]*)/*$", 1)


def stable_id(url: Column) -> Column:
    """What follows the last ``--`` of the path's tail, a tail of 36 hex digits and hyphens, or digits; else the start of the hash of the canonical URL."""
    tail = path_tail(url)
    after = F.regexp_extract(tail, "--([0-9A-Za-z-]+)$", 1)
    ident = F.when(after != "", after).when(tail.rlike("^([0-9a-f-]{36}|[0-9]+)$"), tail)
    return F.coalesce(F.nullif(ident, F.lit("")), F.substring(F.sha2(canonical_url(url), 256), 1, 32))


def in_scope(url: Column, host: str, prefix: str = "/") -> Column:
    """https, exactly this host, and a path below the prefix."""
    return F.coalesce(F.regexp_extract(url, "^(https)://([^/?#:]+)", 2) == host, F.lit(False)) & F.coalesce(F.regexp_replace(canonical_url(url), "^[a-z]+://[^/]+", "").startswith(prefix), F.lit(False))


def type_hint(url: Column) -> Column:
    """Type by the slug's leading part, the longest prefix first; null without one."""
    slug, out = F.lower(path_tail(url)), F.lit(None).cast("string")
    for prefix, kind in sorted(TYPE_HINTS.items(), key=lambda kv: len(kv[0])):
        out = F.when(slug.rlike(f"^{prefix}(-|$)"), kind).otherwise(out)
    return out


def year_hint(url: Column) -> Column:
    """First 19xx or 20xx of the slug, before an id that ``--`` sets off; null without one."""
    slug = F.regexp_replace(path_tail(url), "--[^-].*$", "")
    return F.nullif(F.regexp_extract(slug, "(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1), F.lit("")).cast("int")


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def percentage(part: Column, whole: Column) -> Column:
    """part of whole in percent with two decimals; null without a whole."""
    return F.round(F.try_divide(part * 100.0, whole), 2)


def clip01(x: Column) -> Column:
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)), 2)


def digit_path(label: Column) -> Column:
    """Numbers of a decimal label such as 2.1.3; null for anything else."""
    return F.when(label.rlike(r"^[0-9]{1,9}(\.[0-9]{1,9})*\.?$"), F.transform(F.split(F.regexp_replace(label, r"\.$", ""), r"\."), lambda x: x.cast("int")))


def safe_name(name: Column) -> Column:
    """A download's name without folders and without characters that file systems refuse; never empty."""
    base = F.regexp_replace(name, r"^.*[/\\]", "")
    clean = F.regexp_replace(F.regexp_replace(base, r'[\x00-\x1f<>:"|?*]', "_"), r"^[. ]+|[. ]+$", "")
    return F.when(F.coalesce(clean, F.lit("")) == "", "download").otherwise(clean)


def file_kind(content: Column) -> Column:
    """pdf, zip, ole, html or unknown, by the first bytes; truncated where a pdf lacks its trailer or a zip its directory."""
    head, tail = F.hex(F.substring(content, 1, 8)), F.hex(F.substring(content, -1024, 1024))
    pdf, zipped = head.startswith("25504446"), head.startswith("504B0304")
    kind = F.when(pdf, "pdf").when(zipped, "zip").when(head.startswith("D0CF11E0A1B11AE1"), "ole").when(F.lower(F.decode(F.substring(content, 1, 64), "ISO-8859-1")).rlike(r"^\s*<(!doctype|html)"), "html").otherwise("unknown")
    cut = (pdf & ~tail.contains("2525454F46")) | (zipped & ~tail.contains("504B0506"))
    return F.when(F.coalesce(cut, F.lit(False)), "truncated").otherwise(kind)
