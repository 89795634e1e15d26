"""Near-duplicate embeddings: iterative quantisation and multi-index Hamming tables.

Rotations learnt on a bounded sample give balanced binary codes.  The codes of
all vectors are cut into substrings, each with its own table; vectors that
agree on a substring meet in a bucket and are compared there by their original
values.  A pair is counted in the first table it meets in.  Equal vectors
collapse first; large buckets are cut into chunks that meet two by two.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm._spark import components, join_roots, parts_of, saved
from docweave.llm.jaccard import _cells

CHUNK = 1500


def learn_rotations(x: np.ndarray, count: int, steps: int = 30, seed: int = 3) -> list[np.ndarray]:
    """Projections (d, d): principal axes turned so that signs lose least, from several starts."""
    rng = np.random.Generator(np.random.PCG64(seed))
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    pad = np.zeros((x.shape[1], x.shape[1]))
    pad[: len(axes)] = axes
    v = x @ pad.T
    out = []
    for _ in range(count):
        r, _ = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))
        for _ in range(steps):
            u, _, w = np.linalg.svd(v.T @ np.sign(v @ r))
            r = u @ w
        out.append(pad.T @ r)
    return out


def plan_tables(n: int, spread: float, least: float, recall: float = 0.98) -> tuple[int, int]:
    """Bits of a substring, so that buckets stay small at any n, and tables for the recall at the threshold."""
    bits = min(32, max(6, round(math.log2(max(n, 2) / 64))))
    half = min(1.0, math.sqrt(2 - 2 * least) / (2 * max(spread, 1e-6)))
    agree = max(0.05, 1 - 2 * math.asin(half) / math.pi)
    return bits, max(4, math.ceil(math.log(1 - recall) / math.log(1 - agree**bits)))


def near_vectors(vectors: DataFrame, least: float = 0.9, key: str = "vec_id", column: str = "embedding", sample_rows: int = 8192) -> DataFrame:
    """One row per input row: key, n_links, component_id, kept (the key names its component).

    Rows link at a cosine of ``least`` or more, computed in double precision.
    Null, empty and zero vectors and those with null or non-finite components
    link with nothing; vectors of each length link among themselves.  Equal
    vectors and repeated rows link with each other; a null key is linked but
    names no component unless it has no other, and is then kept.  An empty
    table gives none.  Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    parts = parts_of(spark)
    e = F.transform(F.col(column), lambda x: x.cast("double"))
    fine = F.col(column).isNotNull() & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("_key"), F.when(F.coalesce(fine, F.lit(False)), F.col(column)).alias("_v")).withColumn("node", F.when(F.col("_v").isNotNull(), F.xxhash64(F.transform("_v", lambda x: x.cast("double")), F.lit(5))))
    nodes = saved(rows.where("node is not null").groupBy("node").agg(F.min("_key").alias("name"), F.count(F.lit(1)).alias("w"), F.first("_v").alias("v")))
    # vectors of different lengths never link, so every length has an index of its own
    sizes = {r["d"]: r["n"] for r in nodes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect()}
    links = None
    for d in sorted(sizes):
        own = nodes.where(F.size("v") == d)
        # the bound of the sample is ``sample_rows``
        sample = own.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(sample_rows).select("v").toPandas()["v"]
        x = np.array([np.asarray(v, float) for v in sample], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        mean = x.mean(0)
        spread = float(np.sqrt(((x - mean) ** 2).sum(1).mean())) or 1.0
        bits, tables = plan_tables(sizes[d], spread, least)
        turn = np.concatenate(learn_rotations(x - mean, -(-bits * tables // d)), axis=1)[:, : bits * tables]
        found = _links(own, d, mean, turn, bits, tables, least, parts)
        found = saved(found) if len(sizes) > 1 else found
        links = found if links is None else links.union(found)
    if links is None:
        found, comp = spark.createDataFrame([], "node bigint, links bigint"), spark.createDataFrame([], "node bigint, component bigint")
    else:
        links = saved(links)
        found = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
        comp = components(links.where("b is not null").select("a", "b"))
    info = nodes.select("node", "name", "w").join(found, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = info.groupBy("component").agg(F.min("name").alias("first"))
    info = info.join(names, "component").select("node", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "first")
    out = rows.select("_key", "node").join(info, "node", "left")
    first = F.coalesce("first", "_key")
    return out.select(F.col("_key").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), first.alias("component_id"), F.coalesce(F.col("_key") == first, F.lit(True)).alias("kept"))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(float)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _links(nodes: DataFrame, d: int, mean, turn, bits: int, tables: int, least: float, parts: int) -> DataFrame:
    """Rows (a, null, links) with weights of linked nodes, and (a, b, 0) that join components."""

    # values travel as they were stored; they become doubles where they are compared
    kind = {"float": np.float32, "double": np.float64}.get(nodes.schema["v"].dataType.elementType.simpleString())
    if kind is None:
        kind, nodes = np.float64, nodes.withColumn("v", F.transform("v", lambda x: x.cast("double")))

    def encode(batches):
        place = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            node, w = b.column(0).to_numpy(), b.column(1).to_numpy()
            v = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, d)
            code = (((_unit(v) - mean) @ turn) > 0).reshape(-1, tables, bits) @ place
            small = code.astype(np.uint32)
            for i in range(0, len(node), 2000):
                n = len(node[i : i + 2000])
                s = slice(i, i + n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(node[s], tables)), pa.array(np.repeat(w[s], tables)), pa.array([x.tobytes() for x in v[s] for _ in range(tables)], pa.binary()),
                    pa.array([x.tobytes() for x in small[s] for _ in range(tables)], pa.binary()), pa.array(np.tile(np.arange(tables), n), pa.int32()), pa.array(code[s].ravel()),
                ], names=["node", "w", "v", "code", "t", "bucket"])

    rows = nodes.select("node", "w", "v").mapInArrow(encode, "node bigint, w bigint, v binary, code binary, t int, bucket bigint")
    full = rows.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > CHUNK).withColumn("k", F.ceil(F.col("m") / CHUNK)).drop("m")
    rows = rows.join(full, ["t", "bucket"], "left")
    own = F.pmod(F.xxhash64("node", F.lit(21)), F.coalesce("k", F.lit(1)))
    rows = rows.withColumn("_o", own).withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("k", F.lit(1)) - 1)))
    side = F.when(F.col("_o") == F.col("_j"), 0).when(F.col("_o") < F.col("_j"), 1).otherwise(2)
    rows = rows.select("node", "w", "v", "code", "t", side.alias("side"), F.xxhash64("t", "bucket", F.least("_o", "_j"), F.greatest("_o", "_j")).alias("cell"))

    def compare(batches):
        for t in _cells(batches, "cell"):
            if t.num_rows < 2:
                continue
            node, w, at, s = t.column("node").to_numpy(), t.column("w").to_numpy(), t.column("t")[0].as_py(), t.column("side").to_numpy()
            v = _unit(np.frombuffer(b"".join(t.column("v").to_pylist()), kind).reshape(len(node), d))
            code = np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint32).reshape(len(node), tables)
            one, two = (np.flatnonzero(s == 0),) * 2 if (s == 0).all() else (np.flatnonzero(s == 1), np.flatnonzero(s == 2))
            links, label = np.zeros(len(node), np.int64), np.arange(len(node))
            for i in range(0, len(one), 1000):
                x, y = np.nonzero(v[one[i : i + 1000]] @ v[two].T >= least)
                x, y = one[i + x], two[y]
                use = x < y if one is two else np.ones(len(x), bool)
                x, y = x[use], y[use]
                for lo in range(0, len(x), 200_000):
                    a, b = x[lo : lo + 200_000], y[lo : lo + 200_000]
                    new = ~(code[a, :at] == code[b, :at]).any(1)
                    a, b = a[new], b[new]
                    links += np.bincount(a, weights=w[b], minlength=len(node)).astype(np.int64) + np.bincount(b, weights=w[a], minlength=len(node)).astype(np.int64)
                    label = join_roots(label, a, b)
            hit, away = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([node[hit], node[away]])), pa.array(np.concatenate([node[hit], node[label[away]]]), mask=np.arange(len(hit) + len(away)) < len(hit)),
                pa.array(np.concatenate([links[hit], np.zeros(len(away), np.int64)])),
            ], names=["a", "b", "links"])

    return rows.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(compare, "a bigint, b bigint, links bigint")


def op10_itq_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
