"""Order-dependent operators over keyed sequences, as window expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def counter_runs(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Maximal runs of consecutive numbers: keys, first, last, length (gaps and islands)."""
    w = Window.partitionBy(*keys).orderBy(number)
    base = df.select(*keys, number).distinct().withColumn("_g", F.col(number) - F.row_number().over(w))
    return base.groupBy(*keys, "_g").agg(F.min(number).alias("first_number"), F.max(number).alias("last_number"), F.count(F.lit(1)).alias("run_length")).drop("_g")


def nearest_parent(df: DataFrame, keys: list[str], order: list[str], node: str, level: Column, levels: int) -> DataFrame:
    """Parent = latest preceding node of a strictly lower level, one running maximum for each level."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    pos = F.struct(*order, node)
    lead = df.withColumn("_l", level)
    last = [F.max(F.when(F.col("_l") == i, pos)).over(w) for i in range(levels)]
    best = F.lit(None)
    for i in range(levels):
        below = [last[k] for k in range(i)]
        pick = F.greatest(*below) if len(below) > 1 else (below[0] if below else F.lit(None))
        best = F.when(F.col("_l") == i, pick[node] if below else F.lit(None)).otherwise(best) if i else best
    return lead.withColumn("parent", best).withColumn("level", F.col("_l")).drop("_l")


def overlap_pairs(df: DataFrame, key: str, node: str, start: str, end: str, width: float) -> DataFrame:
    """Pairs of intervals [start, end) of one key that overlap, smaller node first.

    Time is cut into buckets of ``width``; intervals meet in the buckets they
    touch, and a pair counts where the later one starts, so a hot key is split.
    """
    number = lambda c: F.unix_micros(c.cast("timestamp")) if isinstance(df.schema[start].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) else c.cast("double")
    bucket = lambda c: F.floor(c / F.lit(width)).cast("long")
    x = df.select(F.col(key).alias("k"), F.col(node).alias("n"), number(F.col(start)).alias("s"), number(F.col(end)).alias("e")).where("s < e")
    x = x.withColumn("_b", F.explode(F.sequence(bucket(F.col("s")), F.greatest(bucket(F.col("s")), F.ceil(F.col("e") / F.lit(width)).cast("long") - 1))))
    a, b = (x.select("k", "_b", F.col("n").alias(c), F.col("s").alias(f"s{c}"), F.col("e").alias(f"e{c}")) for c in "ab")
    pairs = a.join(b, ["k", "_b"]).where("a < b and sa < eb and sb < ea").where(F.col("_b") == bucket(F.greatest("sa", "sb")))
    return pairs.select(F.col("k").alias(key), "a", "b")


def asof_previous(df: DataFrame, keys: list[str], order: list[str], value: Column, alias: str) -> DataFrame:
    """The last non-null value before each row of its key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(alias, F.last(value, ignorenulls=True).over(w))


def balanced_sample(df: DataFrame, by: str, key: str, seed: str, size: int) -> DataFrame:
    """Greedy balanced sample: rank by hash inside each group, then take rounds of ranks."""
    h = F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)
    ranked = df.select(by, key, h.alias("h")).withColumn("rank_in_group", F.row_number().over(Window.partitionBy(by).orderBy("h", key)))
    return ranked.orderBy("rank_in_group", "h", key).limit(size).drop("h")
