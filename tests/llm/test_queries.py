"""Every opN_ query and the pipeline on small tables, against DuckDB SQL or a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docweave.llm import quality, queries, secrets, toxicity, vectors

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BENCH = [(1, " ".join(f"Bench{i}" for i in range(25))), (2, "two Words"), (3, None), (4, ""), (1, " ".join(f"bench{i}" for i in range(5, 30))), (7, "héllo wörld"), (None, "alone1 alone2")]


def held(i, mod):
    return zlib.crc32(("" if i is None else str(i)).encode()) % mod


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))


@pytest.fixture(scope="module")
def documents():
    r = random.Random(12)
    vocab = [f"wörd{i}" if i % 9 == 0 else f"Word{i}" for i in range(400)]
    make = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, sources = make(90), ["a", "a", "a", "a", "b", "c", None]
    texts = [make(r.randint(1, 250)) for _ in range(120)]
    texts += [texts[r.randrange(20)] for _ in range(20)]  # copies of few texts
    for _ in range(20):
        w = texts[r.randrange(120)].split(" ")
        w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [f"{make(20)} {passage}\n{make(r.randint(0, 30))}" for _ in range(15)] + [f"{make(15)} {BENCH[0][1].lower()} {make(15)}" for _ in range(8)]
    texts += [f'{make(9)} token = "{hashlib.sha1(bytes([i])).hexdigest()}" AKIA{"Q7" * 8} {make(9)}' for i in range(8)]
    texts += [f"{make(30)} you vile rotten scum {make(10)}" for _ in range(60)] + [f"{make(30)} v1le r0tten $cum {make(10)}" for _ in range(10)]
    texts += [None, "", " \t\n ", "one", "two words here", make(20000), "\x00\x01 ctrl", "Two wORDS", "ab" * 3000, "héllo wörld"]
    rows = [(i, t, "en", r.choice(sources), len(t or "")) for i, t in enumerate(texts)] + [(5, texts[5], "en", "a", 3), (6, "other text", None, "b", None)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, documents):
    at = tmp_path_factory.mktemp("tables")
    r, rng = random.Random(13), np.random.default_rng(14)

    def write(name, rows, columns):
        pq.write_table(pa.table({c: pa.array([x[i] for x in rows], k) for i, (c, k) in enumerate(columns)}), at / f"{name}.parquet")

    write("documents", documents, [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    write("benchmark", BENCH, [("item_id", pa.int64()), ("text", pa.string())])
    write("labels", [(i, int(t is not None and len(t) > 400), int("scum" in (t or "") or "$cum" in (t or ""))) for i, t, *_ in documents if r.random() < 0.9], [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
    base = rng.normal(size=(80, 16))
    x = np.concatenate([base, base[:30] + rng.normal(scale=0.1, size=(30, 16)), base[:5]]).astype(np.float32)
    odd = [None, [0.0] * 16, [math.nan] * 16, [1.0] * 15 + [None], [], [1.0, 2.0], [2.0, 4.0]]
    write("embeddings", [(i, v) for i, v in enumerate([*x.tolist(), *odd])], [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))])
    return str(at)


@pytest.fixture(scope="module")
def none(spark, tables, tmp_path_factory):
    at = tmp_path_factory.mktemp("none")
    for name in ("documents", "benchmark", "labels", "embeddings"):
        pq.write_table(pq.read_table(f"{tables}/{name}.parquet").slice(0, 0), at / f"{name}.parquet")
    return str(at)


def plain(x):
    return round(x, 9) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    got = queries.QUERIES[name](spark, tables)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(tuple(map(plain, x)) for x in got.collect()) == Counter(tuple(map(plain, x)) for x in want)
    assert len(want) > 100


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_of_empty_tables(spark, none, name):
    assert queries.QUERIES[name](spark, none).count() == 0


def test_op2(spark, tables, documents):
    count = Counter(w for i, t, *_ in documents if held(i, 7) != 2 for w in [*words(t), None])
    n, v = sum(count.values()), len(count)
    got = queries.op2_katz(spark, tables).collect()
    want = []
    for i, t, *_ in documents:
        w = [*words(t), None]
        want.append((i, held(i, 7) == 2, len(w), sum(x in count for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 4)))
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == Counter(want)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_op4(spark, tables, documents):
    patterns = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    got = queries.op4_secret_scan(spark, tables).collect()
    want = Counter()
    for i, t, *_ in documents:
        found = sorted((m.start(), k, name, m.end()) for k, (name, p, g, least) in enumerate(patterns) for m in p.finditer(t or "") if len(m[g]) >= least)
        base = [f"{name}:{s}:{e}" for s, _, name, e in found]
        want[i, *[sum(name == x for _, _, name, _ in found) for x in ("assign", "access", "hex")], hashlib.sha256(",".join(base).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    for r in got:
        own = [x for x in r["spans"].split(",") if x and not x.startswith("crf:")]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r["base_sha256"]


def test_op5(spark, tables, documents):
    got = queries.op5_mix_sources(spark, tables).collect()
    size = defaultdict(int)
    for _, t, _, s, _ in documents:
        size[s] += len(words(t))
    names = sorted(x for x in size if x is not None) + [None]
    weight = dict(zip(names, [5, 2, 1, 5, 2, 1], strict=False))
    goal, left, todo = {}, sum(size.values()), list(names)
    while todo:
        full = [s for s in todo if left * weight[s] / sum(weight[x] for x in todo) > 3 * size[s]]
        if not full:
            total = sum(weight[x] for x in todo)
            goal |= {s: left * weight[s] / total for s in todo}
            break
        goal |= {s: 3 * size[s] for s in full}
        left, todo = left - sum(3 * size[s] for s in full), [s for s in todo if s not in full]
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got) == Counter((i, len(words(t)), size[s], round(goal[s], 6)) for i, t, _, s, _ in documents)
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 256 for s in names)
    assert sorted(map(repr, got)) == sorted(map(repr, queries.op5_mix_sources(spark, tables).collect()))


@pytest.mark.parametrize(("name", "threshold", "label"), [("op6_quality", 0.3, "quality"), ("op9_toxicity", 0.5, "toxic")])
def test_classifiers(spark, tables, documents, name, threshold, label):
    got = queries.QUERIES[name](spark, tables).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in got) == Counter((i, held(i, 5) == 0) for i, *_ in documents)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold) for r in got)
    truth = dict(pq.read_table(f"{tables}/labels.parquet").select(["doc_id", label]).to_pandas().itertuples(index=False))
    own = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in own) >= 0.85 * len(own)


def test_factorisation_identity():
    rng = np.random.default_rng(3)
    n, size = 6, quality.WORDS + len(quality.STATS) * quality.BINS
    model = {"b": 0.3, "w": rng.normal(size=size), "v": rng.normal(size=(size, 4))}
    rows = np.repeat(np.arange(n), [0, 1, 2, 5, 9, 3])
    ids, x = rng.integers(0, size, len(rows)), rng.normal(size=len(rows))
    got = quality.raw_scores(model, rows, ids, x, n)
    for d in range(n):
        at = np.flatnonzero(rows == d)
        pairs = sum(model["v"][ids[i]] @ model["v"][ids[j]] * x[i] * x[j] for a, i in enumerate(at) for j in at[a + 1 :])
        assert math.isclose(got[d], 0.3 + (model["w"][ids[at]] * x[at]).sum() + pairs, rel_tol=1e-9)


def test_recall_near_the_threshold(spark):
    """Pairs planted at cosines just above 0.9: nearly all are found, none too many, components included."""
    rng = np.random.default_rng(21)
    d, n = 64, 1500
    a = rng.normal(size=(n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(n, d))
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = rng.uniform(0.9005, 0.95, (n, 1))
    x = np.concatenate([a, c * a + np.sqrt(1 - c**2) * b])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    got = {r["vec_id"]: r for r in vectors.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    links = np.array([got[i]["n_links"] for i in range(2 * n)])
    assert (links <= link.sum(1)).all() and links.sum() >= 0.9 * link.sum()
    assert all(got[n + i]["component_id"] == i for i in range(n) if links[i] == 1 and link[i].sum() == 1 and link[n + i].sum() == 1)


@pytest.fixture(scope="module")
def stages(spark, tables):
    docs, out = spark.read.parquet(f"{tables}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, tables).cache()
        out[name] = [tuple(r) for r in before.collect()], [r.asDict() for r in docs.collect()], before.columns, docs.columns
    return out


def test_toxicity_stage(spark, tables, stages):
    before, after, columns, kept = stages["toxicity"]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    model = toxicity.fit(spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet"))
    want = Counter(tuple(r)[:5] for r in toxicity.score_toxicity(docs, model).where("score < 0.5").collect())
    assert kept == columns and Counter(tuple(r.values()) for r in after) == want
    gone = len(before) - len(after)
    assert 40 <= gone <= 80 and sum("scum" in (r["text"] or "") for r in after) <= 8


def test_near_duplicate_stage(stages):
    before, after, columns, kept = stages["ngram_jaccard_join"]
    assert kept == columns
    sets = []
    for _, t, *_ in before:
        w = words(t)
        sets.append({tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(before)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(before):
        least[find(i)] = min(least.get(find(i), row[0]), row[0])
    keep = defaultdict(bool)  # rows of one key stay or go together
    for i, row in enumerate(before):
        keep[row[0]] |= row[0] == least[find(i)]
    assert Counter(tuple(r.values()) for r in after) == Counter(r for r in before if keep[r[0]])
    assert len(after) < len(before) - 30


def test_contamination_stage(stages):
    before, after, columns, kept = stages["benchmark_decontamination"]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = set()
    for _, t in BENCH:
        w = word.findall((t or "").translate(LOW))
        wins |= {tuple(w[a : a + min(10, len(w))]) for a in range(len(w) - min(10, len(w)) + 1) if w}

    def hit(t):
        w = word.findall((t or "").translate(LOW))
        return any(tuple(w[a : a + k]) in wins for k in {len(x) for x in wins} for a in range(len(w) - k + 1))

    assert kept == columns and Counter(tuple(r.values()) for r in after) == Counter(r for r in before if not hit(r[1]))
    assert len(after) < len(before)


def test_secret_stage(stages):
    before, after, columns, kept = stages["secret_scans"]
    assert kept == columns and Counter(r[0] for r in before) == Counter(r["doc_id"] for r in after)
    assert not any(secrets.base_spans(r["text"] or "") for r in after)
    assert any("[SECRET]" in (r["text"] or "") for r in after)
    same = {(r[0], r[1]) for r in before if not secrets.base_spans(r[1] or "")}
    assert sum((r["doc_id"], r["text"]) in same for r in after) >= 0.95 * len(same)
    assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] is not None)


def test_mixing_stage(stages):
    before, after, _, kept = stages["mixing_sources"]
    assert {"doc_id", "text", "lang", "n_chars", "source", "size", "source_size", "target", "taken"} == set(kept)
    assert Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], r["size"]) for r in after) == Counter((*r, len(words(r[1]))) for r in before)
    taken, goal = Counter(), {}
    for r in after:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    assert all(abs(taken[s] - goal[s]) <= 256 for s in goal)


def test_run_equals_its_stages(spark, tables, stages):
    got = corpus_pipeline.run(spark, tables)
    assert Counter(repr(sorted(r.asDict().items())) for r in got.collect()) == Counter(repr(sorted(r.items())) for r in stages["mixing_sources"][1])


def test_run_of_empty_tables(spark, none):
    got = corpus_pipeline.run(spark, none)
    assert got.count() == 0 and "text" in got.columns


def test_stages_keep_further_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(40).withColumn("score", F.lit(1)).withColumn("_n", F.lit(2)).withColumn("component_id", F.lit(3)).withColumn("secrets", F.lit("s"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns, name
        assert stage(spark, docs, tables).where("score <> 1 or _n <> 2 or component_id <> 3 or secrets <> 's'").count() == 0
