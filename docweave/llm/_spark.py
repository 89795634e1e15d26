"""Session helpers: partition counts, durable intermediate tables, hub-safe joins, connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EDGES = 200_000  # edges that one task joins
HUB = 50_000  # rows with one key that may meet in one task


def parts_of(spark: SparkSession) -> int:
    """The number of shuffle partitions that the cluster is set to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def parts_for(df: DataFrame, most: int = 64 << 20) -> int:
    """Partitions for a shuffle of ``df``: the cluster's setting, or more where that would give one over ``most`` bytes.

    The size is what the optimizer knows of it; where it knows nothing, the setting holds.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(parts_of(df.sparkSession), -(-size // most) if size < 1 << 60 else 0)


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Arrow batches of at most ``most`` bytes, or of one row, from now on; a lower setting stays.

    The default of 64 MB is held several times over by the JVM, and again by
    the Python worker, of every task.  The setting has to outlive the call, as
    plans read it only when they run.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(name, "64m")).lower().rstrip("b")
    size = int(now[:-1]) << {"k": 10, "m": 20, "g": 30}[now[-1]] if now[-1] in "kmg" else int(now)
    if size > most:
        spark.conf.set(name, str(most))


def _folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is set and all runs on one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="checkpoint")
        spark.sparkContext.setCheckpointDir(at)
    return at


def saved(df: DataFrame) -> DataFrame:
    """The same rows, written to and read from the cluster's checkpoint folder; lineage ends here."""
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._docweave_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete saved tables that no later plan reads."""
    for t in tables:
        path = getattr(t, "_docweave_path", None)
        if path:
            jvm = t.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def bit_set(of: DataFrame, value: Column, bits: int = 1 << 24) -> np.ndarray:
    """A bitmap, the same size for any table, with the bit of every value of a long column."""
    bit = of.select(F.pmod(value, F.lit(bits)).alias("b"))
    marks = bit.groupBy(F.shiftright("b", 15).alias("k")).agg(F.bitmap_construct_agg(F.col("b").bitwiseAND(F.lit(32767))).alias("m")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in marks:  # at most bits / 8 bytes in all
        out[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(r["m"], np.uint8)
    return out


def in_bit_set(marks: np.ndarray, value: np.ndarray) -> np.ndarray:
    k = value % (len(marks) * 8)
    return marks[k >> 3] >> (k & 7) & 1 > 0


def hub_join(rows: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined with ``few``, which has a key once, though one key may hold a third of the rows.

    Keys of more than HUB rows, so at most one for every HUB rows, are joined
    by broadcast where the rows are; the others by a shuffle.  ``rows`` is read
    three times, so it should be a saved table.
    """
    add = [c for c in few.columns if c != key]
    heavy = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > HUB).select(key)
    heavy = saved(heavy)
    if heavy.isEmpty():
        drop(heavy)
        return rows.join(few, key, "left").select(*rows.columns, *add)
    top = few.join(F.broadcast(heavy), key)
    hot = rows.join(F.broadcast(top.withColumn("_top", F.lit(True))), key, "left").where("_top").select(*rows.columns, *add)
    rest = rows.join(F.broadcast(heavy), key, "left_anti")
    missing = rows.join(F.broadcast(heavy), key, "left_semi").join(F.broadcast(top.select(key)), key, "left_anti").select(*rows.columns, *[F.lit(None).cast(few.schema[c].dataType).alias(c) for c in add])
    return hot.unionByName(rest.join(few, key, "left").select(*rows.columns, *add)).unionByName(missing)


def join_roots(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Merge the components of pairs (i, j) in an array of component labels, which are smallest members."""
    while True:
        a, b = label[i], label[j]
        live = a != b
        if not live.any():
            return label
        i, j, a, b = i[live], j[live], a[live], b[live]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _columns(batches) -> tuple[np.ndarray, np.ndarray]:
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    z = np.zeros(0, np.int64)
    return np.concatenate([z, *[x for x, _ in got]]), np.concatenate([z, *[y for _, y in got]])


def _forest(batches):
    """Every node of some edges with the smallest node that they join it to."""
    u, v = _columns(batches)
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = join_roots(np.arange(len(nodes)), at[: len(u)], at[len(u) :])
    for i in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + 100_000]), pa.array(nodes[root[i : i + 100_000]])], names=["node", "root"])


def _contract(batches):
    """Rows of whole nodes: the smallest root of each (kind 0) if no edge table needs the node any more, else edges (kind 1)."""
    node, root = _columns(batches)
    order = np.lexsort((root, node))
    node, root = node[order], root[order]
    away = node != root
    is_root = np.unique(node[~away])
    node, root = node[away], root[away]
    new = np.ones(len(node), bool)
    new[1:] = node[1:] != node[:-1]
    first = root[np.flatnonzero(new)][np.cumsum(new) - 1] if len(node) else root
    needed = np.isin(node, is_root)
    alone = np.setdiff1d(is_root, node)
    for kind, a, b in ((0, node[new & ~needed], root[new & ~needed]), (0, alone, alone), (1, node[new & needed], root[new & needed]), (1, root[~new], first[~new])):
        for i in range(0, len(a), 100_000):
            n = len(a[i : i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(a[i : i + n]), pa.array(b[i : i + n])], names=["kind", "a", "b"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of an undirected graph of longs; component is the smallest node reachable.

    Edges are dealt evenly, whatever their ends; every task replaces its own by
    a forest of stars, so a hub leaves a task as one row and later meets as
    many rows as there are tasks.  Nodes that are no root anywhere keep a
    pointer and leave the graph; the rest, smaller every time, is dealt again
    until one task of EDGES edges holds it.  Nodes should be hashes, so that
    small ones lie anywhere in the graph.  Loops name a node without a link.
    """
    edges = saved(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")))
    pointers = []
    while True:
        n = -(-max(1, edges.count()) // EDGES)
        if n == 1:
            found = saved(edges.repartition(1).mapInArrow(_forest, "node bigint, root bigint"))
            drop(edges)
            break
        forest = edges.repartition(n).mapInArrow(_forest, "node bigint, root bigint").repartition(n, "node")
        both = saved(forest.mapInArrow(_contract, "kind int, a bigint, b bigint"))
        pointers.append(both.where("kind = 0").select(F.col("a").alias("node"), F.col("b").alias("root")))
        drop(edges)
        edges = saved(both.where("kind = 1 and a <> b").select("a", "b").distinct())
    for p in reversed(pointers):
        up = hub_join(saved(p), found.select(F.col("node").alias("root"), F.col("root").alias("_up")), "root")
        found = saved(found.unionByName(up.select("node", F.coalesce("_up", "root").alias("root"))).distinct())
    return found.select("node", F.col("root").alias("component"))
