"""Bounded labelled samples and held-out splits shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(key: str, mod: int):
    """crc32 of the key as text, modulo ``mod``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def training(labels: DataFrame, label: str, mod: int = 5, held: int = 0, key: str = "doc_id") -> DataFrame:
    """All training labels as (_key, y).

    Rows in the held-out remainder, null keys and null labels are left out;
    repeated labels of a key count once, at their maximum.
    """
    use = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (remainder(key, mod) != held))
    return use.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("y"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int, mod: int = 5, held: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``rows`` of the ``training`` labels with their texts as (key, text, y), chosen by a hash of the key."""
    picked = training(labels, label, mod, held, key).orderBy(F.xxhash64("_key"), "_key").limit(rows)
    # ``rows`` bounds the broadcast side
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(picked), "_key")
