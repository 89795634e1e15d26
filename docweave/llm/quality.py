"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Pairwise interactions are low-rank and cost linear time by
    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].
Training takes a bounded labelled sample on the driver; scoring is one pass
without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm import _learn as L
from docweave.llm import _text as X
from docweave.llm._spark import small_batches

WORDS = 1 << 16
BINS = 16
#: Each statistic is cut into BINS bins by these rules, so no fit is needed.
STATS = ("words", "mean_len", "digits", "upper", "marks", "bars", "doubled", "distinct", "lines", "end_marks", "non_ascii", "one_letter", "top_mark", "repeat_line")


def _bins(x: np.ndarray, scale: float) -> np.ndarray:
    return np.clip((x * scale).astype(np.int64), 0, BINS - 1)


def features(data: np.ndarray, offs: np.ndarray):
    """Sparse rows as (text, feature id, value), ordered by text."""
    h, starts, ends, first = X.words(data, offs, X.SPACE)
    n, doc = len(offs) - 1, X.owner(first)
    words = np.diff(first)
    some, size = np.maximum(words, 1), np.maximum(np.diff(offs), 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return X.sums(mask.astype(np.int64), offs) / size

    low = X.LOWER[data]
    letter = (low >= 0x61) & (low <= 0x7A) | (data >= 0x80)
    mark = (data > 0x20) & (data < 0x7F) & ~letter & ~((data >= 0x30) & (data <= 0x39))
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    twice = np.zeros(len(h), bool)
    twice[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    pair = doc.astype(np.int64) * WORDS + (h % np.uint64(WORDS)).astype(np.int64)
    uniq, count = np.unique(pair, return_counts=True)
    d, w = uniq // WORDS, uniq % WORDS
    distinct = np.bincount(d, minlength=n)
    newline = data == 10
    top = np.max([X.sums(((data == c)).astype(np.int64), offs) for c in b".,!|#$%&*"], axis=0) if len(data) else np.zeros(n, np.int64)
    stats = [
        _bins(np.log2(words + 1), 1.0), _bins(X.sums(ends - starts, first) / some, 1.0), _bins(share((data >= 0x30) & (data <= 0x39)), 60), _bins(share((data >= 0x41) & (data <= 0x5A)), 20),
        _bins(share(mark), 40), _bins(share(data == 0x7C), 60), _bins(X.sums(twice.astype(np.int64), first) / some, 20), _bins(distinct / some, 15.99),
        _bins(X.sums(newline.astype(np.int64), offs) / some, 60), _bins(X.sums(np.isin(last, np.frombuffer(b"!#$%&*|", np.uint8)).astype(np.int64), first) / some, 20), _bins(share(data >= 0x80), 30),
        _bins(X.sums((ends - starts == 1).astype(np.int64), first) / some, 20), _bins(top / size, 40), _bins(np.log2(np.maximum(np.bincount(d, weights=(count > words[d] / 12) * 1.0, minlength=n), 0) + 1), 3.0),
    ]
    norm = np.sqrt(np.bincount(d, weights=count.astype(float) ** 2, minlength=n))
    rows = np.concatenate([d, np.tile(np.arange(n), len(stats))])
    ids = np.concatenate([w, *[WORDS + j * BINS + s for j, s in enumerate(stats)]])
    values = np.concatenate([count / norm[d], np.full(n * len(stats), 0.5)])
    order = np.argsort(rows, kind="stable")
    return rows[order], ids[order], values[order].astype(np.float32)


def raw_scores(model: dict, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Linear part plus interactions, in time linear in the number of values."""
    out = model["b"] + np.bincount(rows, weights=model["w"][ids] * x, minlength=n)
    v = model["v"]
    for f in range(v.shape[1]):
        z = v[ids, f] * x
        out += 0.5 * (np.bincount(rows, weights=z, minlength=n) ** 2 - np.bincount(rows, weights=z * z, minlength=n))
    return out


def train(rows: np.ndarray, ids: np.ndarray, x: np.ndarray, y: np.ndarray, rank: int = 4, updates: int = 900, batch: int = 128, rate: float = 0.08, ridge: float = 1e-5, seed: int = 5) -> dict:
    """Adagrad over mini-batches of the logistic loss, whole passes up to ``updates`` steps or more."""
    rng = np.random.Generator(np.random.PCG64(seed))
    size = WORDS + len(STATS) * BINS
    w, v, b = np.zeros(size), rng.normal(0, 0.02, (size, rank)), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    gw, gv, gb = np.full(size, 1e-2), np.full((size, rank), 1e-2), 1e-2
    first = np.searchsorted(rows, np.arange(len(y) + 1))
    for _ in range(max(8, -(-updates * batch // len(y)))):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            take = order[k : k + batch]
            n = first[take + 1] - first[take]
            r = np.repeat(np.arange(len(take)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[take][r]
            i, xv = ids[at], x[at].astype(float)
            vx = v[i] * xv[:, None]
            s = np.stack([np.bincount(r, weights=vx[:, f], minlength=len(take)) for f in range(rank)], 1)
            q = np.stack([np.bincount(r, weights=vx[:, f] ** 2, minlength=len(take)) for f in range(rank)], 1)
            z = b + np.bincount(r, weights=w[i] * xv, minlength=len(take)) + 0.5 * (s**2 - q).sum(1)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[take]) / len(take)
            u, inv = np.unique(i, return_inverse=True)
            dw = np.bincount(inv, weights=e[r] * xv, minlength=len(u)) + ridge * w[u]
            gw[u] += dw**2
            w[u] -= rate * dw / np.sqrt(gw[u])
            for f in range(rank):
                dv = np.bincount(inv, weights=e[r] * xv * (s[r, f] - vx[:, f]), minlength=len(u)) + ridge * v[u, f]
                gv[u, f] += dv**2
                v[u, f] -= rate * dv / np.sqrt(gv[u, f])
            gb += e.sum() ** 2
            b -= rate * e.sum() / np.sqrt(gb)
    return {"w": w.astype(np.float32), "v": v.astype(np.float32), "b": b}


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 6000, held: int = 0, mod: int = 5) -> dict | None:
    """Train on at most ``sample_rows`` labelled texts outside the held-out remainder."""
    sample = L.labelled(docs, labels, label, sample_rows, mod, held).select("_key", "y", "text")

    def run(batches):
        for b in batches:
            data, offs = X.column_bytes(b.column(2))
            keys, y = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in X.chunks(offs):
                r, ids, x = features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                cut = np.searchsorted(r, np.arange(j - i + 1))
                blobs = [X.pack(i=ids[cut[k] : cut[k + 1]].astype(np.int32), x=x[cut[k] : cut[k + 1]]) for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([pa.array([str(k) for k in keys[i:j]]), pa.array(y[i:j], pa.int32()), pa.array(blobs, pa.binary())], names=["k", "y", "b"])

    got = sorted((r["k"], r["y"], bytes(r["b"])) for r in sample.mapInArrow(run, "k string, y int, b binary").collect())
    if len({y for _, y, _ in got}) < 2:
        return {"prior": float(got[0][1])} if got else None
    parts = [X.unpack(b) for *_, b in got]
    rows = np.repeat(np.arange(len(parts)), [len(p["i"]) for p in parts])
    return train(rows, np.concatenate([p["i"] for p in parts]), np.concatenate([p["x"] for p in parts]), np.array([y for _, y, _ in got], float))


def score_quality(docs: DataFrame, model: dict | None, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability of label 1 to every row.

    Null and empty texts are scored from their structure alone; repeated rows
    alike; an empty table gives none.  Without training rows every score is
    0.5, and with one class only it is that class.  A clashing score column is
    replaced.
    """
    small_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c.lower() != out.lower()]
    plain = docs.select(*[docs[c] for c in cols])
    shared, at = docs.sparkSession.sparkContext.broadcast(model), cols.index(text)

    def run(batches):
        model = shared.value
        for b in batches:
            data, offs = X.column_bytes(b.column(at))
            s = [np.zeros(0)]
            for i, j in X.chunks(offs):
                if model is None or "prior" in model:
                    s.append(np.full(j - i, 0.5 if model is None else model["prior"]))
                    continue
                z = raw_scores(model, *features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]), j - i)
                s.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(s), pa.float64())], names=[*b.schema.names, out])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(out, T.DoubleType())]))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    x = score_quality(docs, model)
    return x.select("doc_id", (L.remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
