"""Benchmark decontamination with sparse suffix arrays over the training text.

Each chunk of training texts is a shard.  Its suffix array holds, in word
order, every suffix that begins as some benchmark window does (the others
cannot match).  All benchmark windows are binary-searched in it at once; runs
of matches on one diagonal are the longest verbatim matches.  There is no
shuffle: the benchmark goes to the shards in blocks of a bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm import _text as X
from docweave.llm._spark import small_batches

#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 8_000_000


def benchmark_blocks(bench: DataFrame, text: str, item: str, window: int, block_bytes: int):
    """Windows of the benchmark as blocks of word-hash rows, read row by row."""
    rows = bench.select(F.col(item).cast("string").alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    ids, texts, size = [], [], 0
    for r in rows.toLocalIterator():
        ids.append(r["i"])
        texts.append(r["t"])
        size += len(r["t"])
        if size >= block_bytes:
            yield _block(ids, texts, window)
            ids, texts, size = [], [], 0
    yield _block(ids, texts, window)


def _block(ids: list, texts: list, window: int) -> dict:
    data, offs = X.column_bytes(pa.array(texts, pa.large_string()))
    h, _, _, first = X.words(data, offs, X.ALNUM)
    n = np.diff(first)
    width = np.minimum(n, window)
    count = np.where(n > 0, n - width + 1, 0)
    item = np.repeat(np.arange(len(n)), count)
    pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[:-1][item]
    w = width[item]
    grid = np.zeros((len(pos), window), np.uint64)
    for j in range(window):
        ok = j < w
        grid[ok, j] = h[pos[ok] + j]
    # equal windows are searched once; (window, item, position) lists who has them
    keyed = np.column_stack([w.astype(np.uint64), grid])
    kinds, which = np.unique(keyed, axis=0, return_inverse=True) if len(keyed) else (keyed, np.zeros(0, np.int64))
    which = which.ravel()
    order = np.argsort(which, kind="stable")
    return {
        "ids": ids, "width": kinds[:, 0].astype(np.int64), "grid": kinds[:, 1:].copy(),
        "item": item[order], "pos": pos[order], "first": np.searchsorted(which[order], np.arange(len(kinds) + 1)),
    }


def suffix_array(h: np.ndarray, at: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ``at`` in the order of their first ``depth`` words, and those words (0 past a text's end)."""
    cols = np.zeros((len(at), depth), np.uint64)
    for j in range(depth):
        ok = at + j < end
        cols[ok, j] = h[at[ok] + j]
    order = np.lexsort(cols.T[::-1])
    return at[order], cols[order]


def search(cols: np.ndarray, grid: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window the range of suffixes that begin with it, by binary search."""
    out = []
    for after in (False, True):
        lo, hi = np.zeros(len(grid), np.int64), np.full(len(grid), len(cols), np.int64)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            live = lo < hi
            m = np.where(live, mid, 0)
            less, same = np.zeros(len(grid), bool), np.ones(len(grid), bool)
            for j in range(cols.shape[1]):
                use = same & (j < width)
                if not use.any():
                    break
                a = cols[m, j]
                less |= use & (a < grid[:, j])
                same &= ~use | (a == grid[:, j])
            right = (less | same if after else less) & live
            lo = np.where(right, mid + 1, lo)
            hi = np.where(live & ~right, mid, hi)
        out.append(lo)
    return out[0], out[1]


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of the ranges [lo, hi) and the range each belongs to."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def chunk_matches(data: np.ndarray, offs: np.ndarray, block: dict):
    """Matches of one shard: hit words, items by text, longest match by text, words by text."""
    h, starts, ends, first = X.words(data, offs, X.ALNUM)
    doc, n_docs, window = X.owner(first), len(offs) - 1, block["grid"].shape[1]
    end = first[1:][doc] if len(h) else np.zeros(0, np.int64)
    hit = np.zeros(len(h), bool)
    longest = np.zeros(n_docs, np.int64)
    pairs = np.zeros((0, 2), np.int64)
    if len(h) and len(block["width"]):
        grid, width = block["grid"], block["width"]
        head = h.copy()
        head[:-1] = X.grams(h, 2)
        two = width > 1
        begins = X.grams(grid[two][:, :2].ravel(), 2)[::2] if two.any() else np.zeros(0, np.uint64)
        at = np.flatnonzero((np.isin(head, np.unique(begins)) & (np.arange(len(h)) + 1 < end)) | np.isin(h, np.unique(grid[~two][:, 0])))
        if len(at):
            order, cols = suffix_array(h, at, end[at], window)
            lo, hi = search(cols, grid, width)
            kind, p = _expand(lo, hi)
            p = order[p]
            if len(p):
                hit = X.covered(p, p + width[kind], len(h))
                who, k = _expand(block["first"][kind], block["first"][kind + 1])
                item, pos, wp, ww = block["item"][k], block["pos"][k], p[who], width[kind[who]]
                pairs = np.unique(np.column_stack([doc[wp], item]), axis=0)
                s = np.lexsort([wp, wp - pos, item])
                item, diag, wp, ww = item[s], (wp - pos)[s], wp[s], ww[s]
                new = np.ones(len(wp), bool)
                new[1:] = (item[1:] != item[:-1]) | (diag[1:] != diag[:-1]) | (wp[1:] != wp[:-1] + 1) | (doc[wp[1:]] != doc[wp[:-1]])
                run = np.cumsum(new) - 1
                length = np.bincount(run) - 1 + ww[new]
                np.maximum.at(longest, doc[wp[new]], length)
    return hit, pairs, longest, first, starts, ends


def match_benchmark(docs: DataFrame, bench: DataFrame, text: str = "text", window: int = 10, item: str = "item_id", bench_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Append n_words, n_hit, items (array), longest_match and hit_spans to every row.

    A benchmark window is ``window`` consecutive words of an item, or all words
    of a shorter one.  hit_spans are [start, end) pairs of words.  Null and empty texts and items have no
    words and match nothing; repeated rows and items each count; an empty table
    on either side gives no hits.  Columns of ``docs`` named like an added one
    are replaced; ``bench`` may have any further columns.
    """
    small_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c.lower() not in ("n_words", "n_hit", "items", "longest_match", "hit_spans")]
    plain = docs.select(*[docs[c] for c in cols])
    tag = "_"
    while any(c.lower().startswith(tag) for c in cols):  # names that no column has
        tag += "_"
    extra = [tag + c for c in ("n", "hit", "items", "long")]
    state = T.StructType([*plain.schema.fields, *[T.StructField(c, t) for c, t in zip(extra, (T.LongType(), T.BinaryType(), T.ArrayType(T.StringType()), T.LongType()), strict=True)]])
    none = F.lit(None)
    df = plain.select("*", F.lit(0).cast("long").alias(extra[0]), none.cast("binary").alias(extra[1]), none.cast("array<string>").alias(extra[2]), F.lit(0).cast("long").alias(extra[3]))
    at, k = cols.index(text), len(cols)
    # one block at a time is on the driver; a broadcast one lies in the block manager's files
    for block in benchmark_blocks(bench, bench_text, item, window, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def step(batches, shared=shared):
            block = shared.value
            for b in batches:
                data, offs = X.column_bytes(b.column(at))
                old_hit, old_items, old_long = b.column(k + 1).to_pylist(), b.column(k + 2).to_pylist(), b.column(k + 3).to_pylist()
                n, hits, items, longest = [], [], [], []
                for i, j in X.chunks(offs, 2_000_000):
                    hit, pairs, lm, first, _, _ = chunk_matches(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], block)
                    n += np.diff(first).tolist()
                    by = [[] for _ in range(j - i)]
                    for d, x in pairs.tolist():
                        by[d].append(block["ids"][x])
                    bits = hit.astype(np.uint8)
                    any_hit = X.sums(bits.astype(np.int64), first) > 0
                    for d in range(j - i):
                        own = bits[first[d] : first[d + 1]] if any_hit[d] else None
                        before = old_hit[i + d]
                        if before is not None:
                            was = np.unpackbits(np.frombuffer(before, np.uint8))[: first[d + 1] - first[d]]
                            own = was if own is None else own | was
                        hits.append(None if own is None else np.packbits(own).tobytes())
                        items.append((old_items[i + d] or []) + by[d])
                        longest.append(max(int(lm[d]), old_long[i + d]))
                yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(n, pa.int64()), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64())], names=[*b.schema.names[:k], *extra])

        df = df.mapInArrow(step, state)

    def last(batches):
        for b in batches:
            n, spans, count = b.column(k).to_pylist(), [], []
            for size, raw in zip(n, b.column(k + 1).to_pylist(), strict=True):
                if raw is None:
                    spans.append([])
                    count.append(0)
                    continue
                bits = np.unpackbits(np.frombuffer(raw, np.uint8))[:size].astype(np.int8)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], bits, [0]])))
                spans.append([{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)])
                count.append(int(bits.sum()))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*b.columns[:k], b.column(k), pa.array(count, pa.int64()), b.column(k + 2), b.column(k + 3), pa.array(spans, kind)], names=[*b.schema.names[:k], "n_words", "n_hit", "items", "longest_match", "hit_spans"])

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType([*plain.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest_match", T.LongType()), T.StructField("hit_spans", span)])
    return df.mapInArrow(last, out)


def decontaminate(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Keep the rows in which no benchmark window occurs, with their columns."""
    return match_benchmark(docs, bench, **options).where(F.col("n_hit") == 0).select(*docs.columns)



def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = match_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.filter("items", lambda x: x.isNotNull()))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "longest_match")
