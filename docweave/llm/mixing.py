"""Mixing sources to target weights by Sainte-Lague apportionment.

Seats are blocks of equally many tokens.  Quotas by source come from the
highest quotients w / (2s + 1) of the sources' targets, quotas by shard of a
source from those of the shard's tokens.  A shard's texts, in seeded order,
form one stream of blocks; its quota is spread evenly over the stream from a
seeded start, so each block is taken floor(q/n) or ceil(q/n) times.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm import _text as X
from docweave.llm._spark import small_batches


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess is shared again."""
    out, open_ = [0.0] * len(sizes), [i for i in range(len(sizes)) if sizes[i] > 0]
    left = min(float(total), most * sum(sizes))
    while open_:
        w = sum(weights[i] for i in open_)
        if w <= 0:
            break
        full = [i for i in open_ if left * weights[i] / w > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats by highest quotients votes / (2s + 1), ties to the smaller index; at most ``most`` each.

    The last divisor is found by bisection, then single seats are settled, so
    the cost does not depend on the number of seats.
    """
    votes = np.asarray(votes, float)
    most = np.full(len(votes), seats, np.int64) if most is None else np.asarray(most, np.int64)
    most = np.where(votes > 0, most, 0)
    seats = int(min(seats, most.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)

    def at(d: float) -> np.ndarray:  # quotients above d
        return np.minimum(np.maximum(np.ceil((votes / d - 1) / 2), 0), most.astype(float)).astype(np.int64)

    lo, hi = votes[votes > 0].min() / (2.0 * seats + 3), votes.max() * 2
    while at(lo).sum() < seats and lo > 1e-300:
        lo /= 4
    for _ in range(200):
        mid = (lo + hi) / 2
        if at(mid).sum() > seats:
            lo = mid
        else:
            hi = mid
    got = at(hi)
    while (left := seats - int(got.sum())) > 0:  # what is left are ties at the last divisor
        q = np.where(got < most, votes / (2 * got + 1), -1.0)
        got[np.argsort(-q, kind="stable")[: min(left, int((q >= lo).sum()) or 1)]] += 1
    return got


def count_words(df: DataFrame, text: str, out: str, keep_text: bool = False) -> DataFrame:
    """Append the number of white-space separated words; null texts have none.

    The text goes unless ``keep_text`` is set; a clashing column ``out`` is replaced.
    """
    small_batches(df.sparkSession)
    cols = [c for c in df.columns if c != text and c.lower() != out.lower()]
    src = df.select(*cols, text)
    kept = len(cols) + keep_text

    def run(batches):
        for b in batches:
            data, offs = X.column_bytes(b.column(len(cols)))
            n = [np.zeros(0, np.int64)] + [np.diff(X.word_spans(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], X.SPACE)[2]) for i, j in X.chunks(offs, 4_000_000)]
            yield pa.RecordBatch.from_arrays([*b.columns[:kept], pa.array(np.concatenate(n), pa.int64())], names=[*b.schema.names[:kept], out])

    return src.mapInArrow(run, T.StructType([*src.schema.fields[:kept], T.StructField(out, T.LongType())]))


def mix_sources(sizes: DataFrame, weights=(5.0, 2.0, 1.0), source: str = "source", key: str = "doc_id", size: str = "size", block: int = 64, shard_tokens: int = 2_000_000, most: int = 3, seed: int = 17, rows: DataFrame | None = None) -> DataFrame:
    """Rows (source, key, size) with source_size, target and taken added.

    Weights go round the sources in code-point order, null last.  A row's words
    are taken at most ``most`` times; a source's total differs from its target
    by less than a few blocks for every shard.  Rows of size 0 or null take 0;
    repeated rows are separate rows; an empty table gives no rows; equal seeds
    give equal results.  ``rows`` may give the same rows with further columns,
    which are kept if no added column has their name.  The driver holds a few
    numbers for each source and for each shard of ``shard_tokens``, never rows:
    some 8 million shards, 200 MB, for 100 TB of text.
    """
    spark = sizes.sparkSession
    base = sizes.select(F.col(key).alias("_k"), F.col(source).alias("_s"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_n"))
    per = {r["_s"]: int(r["n"]) for r in base.groupBy("_s").agg(F.sum("_n").alias("n")).toLocalIterator()}
    names = sorted((s for s in per if s is not None), key=lambda s: [ord(c) for c in str(s)]) + [None] * (None in per)
    n, w = [per[s] for s in names], [float(weights[i % len(weights)]) for i in range(len(names))]
    total = sum(n)
    goal = targets(n, w, total, most)
    seats = sainte_lague(np.array(goal), int(round(min(total, most * total) / block)))
    shards = [max(1, -(-x // shard_tokens)) for x in n]
    plan = spark.createDataFrame([(s, i, n[i], float(goal[i]), shards[i]) for i, s in enumerate(names)], "_s string, _i int, _ss long, _t double, _shards int")

    def dealt(df: DataFrame, *more: str) -> DataFrame:  # one small row for each source, so the join is by broadcast only if Spark finds it small
        df = df.withColumn("_s", F.col("_s").cast("string"))
        h = F.pmod(F.xxhash64(F.lit(seed), F.col("_k"), F.lit(1)), F.col("_shards")).cast("int").alias("_h")
        return df.join(plan, df["_s"].eqNullSafe(plan["_s"]), "inner").select("_k", df["_s"].alias("_s"), "_n", "_i", "_ss", "_t", h, *more)

    sums = dealt(base).groupBy("_i", "_h").agg(F.sum("_n").alias("n")).orderBy("_i", "_h").toPandas()
    size_, which = sums["n"].to_numpy(float), sums["_i"].to_numpy()
    got = np.zeros(len(sums), np.int64)
    for i in np.unique(which).tolist():
        own = which == i
        got[own] = sainte_lague(size_[own], int(seats[i]), np.ceil(most * size_[own] / block).astype(np.int64))
    added = {c.lower() for c in (key, source, size, "source_size", "target", "taken")}
    more = [] if rows is None else [c for c in rows.columns if c.lower() not in added]
    if rows is not None:
        base = rows.select(F.col(key).alias("_k"), F.col(source).alias("_s"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_n"), *[F.col(c).alias(f"_more{i}") for i, c in enumerate(more)])
    names_ = [f"_more{i}" for i in range(len(more))]
    quotas = spark.createDataFrame(pd.DataFrame({"_i": which, "_h": sums["_h"], "_q": got, "_all": sums["n"]}), "_i int, _h int, _q long, _all long")
    w_ = Window.partitionBy("_i", "_h").orderBy("_o", "_k", "_n")
    o = F.xxhash64(F.lit(seed), F.col("_k"), F.lit(2))
    run = dealt(base, *names_).join(quotas, ["_i", "_h"]).withColumn("_o", o).withColumn("_e", F.sum("_n").over(w_.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    blocks = F.greatest(F.ceil(F.col("_all") / F.lit(block)), F.lit(1)).cast("decimal(30,0)")
    start = F.pmod(F.xxhash64(F.lit(seed), "_i", "_h"), F.lit(1_000_003)).cast("decimal(30,0)")

    def turns(k):  # quota used up before block k: floor((k q + u) / n) with a seeded u in [0, n)
        u = F.floor(start * blocks / F.lit(1_000_003).cast("decimal(30,0)"))
        return F.floor((k.cast("decimal(30,0)") * F.col("_q") + u) / blocks).cast("long")

    def upto(x):  # words taken before word x of the stream; a short last block counts in proportion
        b = F.floor(x / F.lit(block)).cast("long")
        inside = x - b * F.lit(block)
        return turns(b) * F.lit(block) + inside * F.least(turns(b + 1) - turns(b), F.lit(most))

    run = run.withColumn("_taken", (upto(F.col("_e")) - upto(F.col("_e") - F.col("_n"))).cast("long"))
    return run.select(F.col("_k").alias(key), F.col("_s").alias(source), F.col("_n").alias(size), F.col("_ss").cast("long").alias("source_size"), F.col("_t").alias("target"), F.when(F.col("_n") == 0, 0).otherwise(F.col("_taken")).cast("long").alias("taken"), *[F.col(a).alias(c) for a, c in zip(names_, more, strict=True)])


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(count_words(docs, "text", "size")).select("doc_id", "size", "source_size", "target", "taken", "source")
