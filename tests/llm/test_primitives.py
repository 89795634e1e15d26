"""Hashes, saved tables, hub joins and connected components."""

import random

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import _spark, _text, jaccard


def thue_morse(n):
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits[:n])


@pytest.mark.parametrize("n", [8, 64, 128, 129, 1024, 2048, 4096, 8192])
def test_structured_words_do_not_collide(n):
    w = thue_morse(n)
    x = w.translate(str.maketrans("ab", "ba"))
    h, *_ = _text.words(*_text.column_bytes(pa.array([w, x, "z " + w])))
    assert h[0] != h[1] and h[0] == h[3]


@pytest.mark.parametrize("n", [8, 50, 64, 90, 4096])
def test_structured_sequences_do_not_collide(n):
    a, b = np.array([0 if c == "a" else 1 for c in thue_morse(n)]), np.array([1 if c == "a" else 0 for c in thue_morse(n)])
    symbols = np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 64, 2, dtype=np.uint64)
    both = np.concatenate([symbols[a], symbols[b], symbols[a]])
    h = _text.sequence_hash(both, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
    assert h[0] != h[1] and h[0] == h[2]
    assert _text.grams(both[:n], n)[0] != _text.grams(both[n : 2 * n], n)[0]


def test_byte_hash_follows_content():
    r = random.Random(3)
    raw = bytes(r.choice(b"ab") for _ in range(4000))
    data = np.frombuffer(raw, np.uint8)
    s = np.array([r.randrange(3600) for _ in range(3000)])
    e = s + np.array([r.choice([0, 1, 2, 7, 8, 9, 16, 127, 128, 129, 300]) for _ in s])
    by, back = {}, {}
    for i, j, h in zip(s.tolist(), e.tolist(), _text.byte_hash(data, s, e).tolist(), strict=True):
        assert by.setdefault(raw[i:j], h) == h and back.setdefault(h, raw[i:j]) == raw[i:j]


def test_different_sets_of_structured_words_stay_apart(spark):
    w = thue_morse(4096)
    rows = [(1, w), (2, w.translate(str.maketrans("ab", "ba"))), (3, w)]
    got = {r[0]: r[2] for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k=3, num=90).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize(("edges", "hub"), [(200_000, 50_000), (40, 5)])
def test_components(spark, monkeypatch, edges, hub):
    monkeypatch.setattr(_spark, "EDGES", edges)
    monkeypatch.setattr(_spark, "HUB", hub)
    r = random.Random(8)
    name = [r.getrandbits(62) for _ in range(400)]
    links = [(name[0], name[i]) for i in range(1, 60)] + [(name[i], name[i + 1]) for i in range(100, 200)] + [(name[r.randrange(200, 400)], name[r.randrange(200, 400)]) for _ in range(120)]
    links += [links[0], (name[3], name[3])]
    root = {x: x for a, b in links for x in (a, b)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = _spark.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(root) and {x[0]: x[1] for x in got} == {x: find(x) for x in root}
    assert _spark.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hub_join(spark, monkeypatch):
    monkeypatch.setattr(_spark, "HUB", 10)
    rows = _spark.saved(spark.createDataFrame([(1, i) for i in range(50)] + [(2, 1), (None, 2), (3, 3)] + [(4, i) for i in range(20)], "k long, x long"))
    few = spark.createDataFrame([(1, "a"), (2, "b"), (5, "c")], "k long, y string")
    got = sorted(map(tuple, _spark.hub_join(rows, few, "k").collect()), key=str)
    assert got == sorted([(1, i, "a") for i in range(50)] + [(2, 1, "b"), (None, 2, None), (3, 3, None)] + [(4, i, None) for i in range(20)], key=str)


def test_saved_tables_can_be_dropped(spark):
    t = _spark.saved(spark.range(5).toDF("x"))
    assert t.count() == 5
    _spark.drop(t, spark.range(1))
    with pytest.raises(Exception, match="(?i)path|file"):
        t.collect()
