"""Toxicity with noisy-channel deobfuscation.

Words that look disguised (digits or symbols for letters, letters spaced out,
letters repeated) become lattices of the letters they may stand for.  Viterbi
under the frequent words of all texts, and a character language model counted
over all texts for other words, restores them; plain words stay.  A logistic
model over the restored words, learnt from all labelled texts, scores the
text.  Scoring needs no shuffle.
"""

from __future__ import annotations

import bisect
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm import _learn as L
from docweave.llm import _text as X
from docweave.llm._spark import bit_set, drop, in_bit_set, saved, small_batches

#: Letters that a disguising character may stand for; fixed values.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
SUBSTITUTE, DELETE, DROP_LEET, REPEAT = -1.5, -3.0, -9.0, -0.5  # channel log-probabilities
UNKNOWN = 0.05  # share of words that the lexicon lacks
EDGE, SPACED_EDGE = -4.0, -1.0  # log-probabilities of a word edge inside a token, and between spaced letters
BUCKETS = 1 << 20
HELD = 500_000  # different words that a task counts at once
GRAIN = float(1 << 24)
_SYMBOLS = 28  # a-z, any other letter, word edge
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LEET]] = True
_CODE = np.full(256, 27, np.int64)
_CODE[0x61:0x7B] = np.arange(26)
_CODE[0x41:0x5B] = np.arange(26)
_CODE[0x80:] = 26
_WORD = re.compile(rb"[a-z\x80-\xff]+")
_PIECE = r"(?:[^\W_]|[@$!|+(])(?![^\W_])"  # a letter, a digit or a symbol that may stand for one, alone
_SPACED = re.compile(rf"(?<![^\W_]){_PIECE}(?:[\s._*-]{{1,2}}{_PIECE}){{2,}}")


def symbol(c: str) -> int:
    c = c.lower()
    return ord(c) - 97 if "a" <= c <= "z" else 26


def char_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of three character classes in a row over all texts; what stands before a word edge is not told apart."""

    def run(batches):
        total = np.zeros(_SYMBOLS**3, np.int64)
        for b in batches:
            data, offs = X.column_bytes(b.column(0))
            for i, j in X.chunks(offs):
                c = np.concatenate([[27, 27], _CODE[data[offs[i] : offs[j]]], [27]])
                first = np.where(c[1:-1] == 27, 27, c[:-2])
                total += np.bincount((first * _SYMBOLS + c[1:-1]) * _SYMBOLS + c[2:], minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k], pa.int64())], names=["k", "n"])

    rows = docs.select(text).mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(_SYMBOLS**3, np.int64)
    for r in rows:  # at most 21952
        out[r["k"]] = r["n"]
    return out.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)


def char_model(counts: np.ndarray) -> np.ndarray:
    c = counts.astype(float) + 0.5
    return np.log(c / c.sum(-1, keepdims=True))


def word_counts(docs: DataFrame, text: str = "text", most: int = 1 << 17) -> dict[str, int]:
    """Documents of all texts that hold a word, for the ``most`` most frequent words of three documents or more."""

    def run(batches):
        held: dict[int, list] = {}  # by hash: the word, documents
        for b in batches:
            data, offs = X.column_bytes(b.column(0))
            for i, j in X.chunks(offs):
                own = X.LOWER[data[offs[i] : offs[j]]]
                h, starts, ends, first = X.words(own, offs[i : j + 1] - offs[i], _LETTER, lower=False)
                raw, doc, short = own.tobytes(), X.owner(first), np.flatnonzero(ends - starts <= 40)
                order = short[np.argsort(h[short], kind="stable")]  # by word and document
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = h[1:] != h[:-1]
                once = new.copy()
                once[1:] |= doc[1:] != doc[:-1]
                at = np.flatnonzero(new)
                n = np.add.reduceat(once.astype(np.int64), at) if len(at) else at
                for k, m, s, e in zip(h[at].tolist(), n.tolist(), starts[order[at]].tolist(), ends[order[at]].tolist(), strict=True):
                    if k in held:
                        held[k][1] += m
                    else:
                        held[k] = [raw[s:e], m]
            if len(held) > HELD:
                yield _counted(held)
                held = {}
        yield _counted(held)

    n = docs.select(text).mapInArrow(run, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")).where("n >= 3")
    return {r["w"]: r["n"] for r in n.orderBy(F.desc("n"), "w").limit(most).collect()}


def _counted(held: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode(errors="replace") for w, _ in held.values()], pa.string()), pa.array([n for _, n in held.values()], pa.int64())], names=["w", "n"])


class Lexicon:
    """Log-probabilities of known words; ``begins`` tells whether one starts with the letters."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) or 1
        self.words = sorted(counts)
        self.score = {w: math.log((1 - UNKNOWN) * n / total) for w, n in counts.items()}

    def begins(self, letters: str) -> bool:
        i = bisect.bisect_left(self.words, letters)
        return i < len(self.words) and self.words[i].startswith(letters)


def restore(word: str, lm: np.ndarray, lexicon: Lexicon | None = None, edge: float = EDGE) -> str:
    """The most probable plain words behind a disguised one, by Viterbi over its lattice.

    A state is the letters of a known word begun, or the last letters of an
    unknown one; known words are scored by their counts, unknown ones by the
    character model, and a word may end and another begin at the cost ``edge``.
    Every character may be kept, read as a letter it resembles, dropped if it
    is no letter, or merged into the letter before it if it repeats it.
    """
    order = lm.ndim - 1
    known = lexicon is not None and bool(lexicon.words)
    new = math.log(UNKNOWN) if known else 0.0
    start = {(False, "", ""): (new, None)}  # (known, letters, last letter) -> score, letters written
    if known:
        start[True, "", ""] = (0.0, None)

    def letter_score(ctx: str, x: int) -> float:
        return float(lm[(27,) * (order - len(ctx)) + tuple(map(symbol, ctx)) + (x,)])

    def end(state, score: float) -> float | None:
        is_known, ctx, _ = state
        if is_known:
            return score + lexicon.score[ctx] if ctx in lexicon.score else None
        return score + letter_score(ctx, 27) if ctx else None

    best, w = start, word.lower()
    for i, c in enumerate(w):
        letter = c.isalpha()
        options = [(c, 0.0)] if letter else [(x, SUBSTITUTE) for x in LEET.get(c, "")]
        # two of a letter may be natural, so merging them saves nothing in an unknown word
        run = i > 0 and w[i - 1] == c
        twice = run and w[i - 2 : i - 1] != c and w[i + 1 : i + 2] != c
        after: dict[tuple, tuple] = {}

        def put(state, score, out, after=after):
            if state not in after or after[state][0] < score:
                after[state] = (score, out)

        for (is_known, ctx, last), (score, out) in best.items():
            for x, cost in options:
                if last == x and (run or is_known):
                    lost = letter_score(ctx, symbol(x)) if twice and not is_known else 0.0
                    put((is_known, ctx, last), score + REPEAT + lost, out)
                    if not is_known and out and out[0] and out[0][1] == x:
                        continue  # three of a letter never stand
                if not is_known:
                    put((False, (ctx + x)[-order:], x), score + cost + letter_score(ctx, symbol(x)), (out, x))
                elif lexicon.begins(ctx + x):
                    put((True, ctx + x, x), score + cost, (out, x))
            if not letter:
                put((is_known, ctx, last), score + (DROP_LEET if options and i + 1 < len(w) else DELETE), out)
        if known and i + 1 < len(w):
            ends = [(z, out) for state, (score, out) in after.items() if (z := end(state, score)) is not None]
            if ends:
                z, out = max(ends, key=lambda y: y[0])
                put((True, "", ""), z + edge, (out, " "))
                put((False, "", ""), z + edge + new, (out, " "))
        best = after or best
    done = [(z, out) for state, (score, out) in best.items() if (z := end(state, score)) is not None]
    out = max(done, key=lambda y: y[0])[1] if done else None
    letters = []
    while out:
        letters.append(out[1])
        out = out[0]
    return "".join(reversed(letters))


def disguised(data: np.ndarray, offs: np.ndarray):
    """Starts, ends and texts of the white-space words that look disguised by symbols or repeats."""
    starts, ends, first = X.word_spans(data, offs, X.SPACE)
    n = len(data)
    letter, leet, low = _LETTER[data], _LEET[data], X.LOWER[data]
    sign = np.zeros(n + 1, np.int64)
    at = np.zeros(n, bool)
    if n > 1:
        at[:-1] |= leet[:-1] & letter[1:]
        at[1:-1] |= leet[1:-1] & leet[2:] & letter[:-2]
        digit = (data >= 0x30) & (data <= 0x39)
        at[1:] |= digit[1:] & leet[1:] & letter[:-1]
    if n > 2:
        at[2:] |= letter[2:] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & (data[2:] < 0x80)
    np.cumsum(at, out=sign[1:])
    letters = np.zeros(n + 1, np.int64)
    np.cumsum(letter, out=letters[1:])
    odd = (sign[ends] > sign[starts]) & (letters[ends] > letters[starts])
    return starts[odd], ends[odd], X.owner(first)[odd]


def spaced(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Texts that may hold a run of spaced-out letters."""
    word = np.concatenate([[False], X.ALNUM[data], [False]])
    before, after = word[:-2].copy(), word[2:].copy()
    full = offs[1:] > offs[:-1]
    before[offs[:-1][full]] = False
    after[offs[1:][full] - 1] = False
    at = np.flatnonzero((X.ALNUM | _LEET)[data] & ~before & ~after)
    near = (np.diff(at) >= 2) & (np.diff(at) <= 3)
    text = np.searchsorted(offs, at, "right") - 1
    return np.unique(text[2:][near[1:] & near[:-1] & (text[2:] == text[:-2])]) if len(at) > 2 else np.zeros(0, np.int64)


def word_features(data: np.ndarray, offs: np.ndarray, lm: np.ndarray, cache: dict, lexicon: Lexicon | None = None):
    """Distinct (text, hashed word) pairs of the plain and the restored words."""
    h, _, _, first = X.words(data, offs, _LETTER)
    doc = [X.owner(first)]
    hashes = [h]
    raw = data.tobytes()
    extra, owner = [], []
    s, e, d = disguised(data, offs)
    for a, b, k in zip(s.tolist(), e.tolist(), d.tolist(), strict=True):
        w = raw[a:b]
        if w not in cache:
            if len(cache) > 200_000:
                cache.clear()
            cache[w] = restore(w.decode(errors="replace").strip(".,;:?\"'"), lm, lexicon)
        extra.append(cache[w])
        owner.append(k)
    # spaced-out letters: only texts with three pieces of one character in a row are looked at
    for k in spaced(data, offs).tolist():
        t = raw[offs[k] : offs[k + 1]].decode(errors="replace")
        for m in _SPACED.finditer(t):
            if any(c.isalpha() for c in m[0]):
                extra.append(restore(re.sub(r"[\s._*-]+", "", m[0]), lm, lexicon, SPACED_EDGE))
                owner.append(k)
    if extra:
        # a restored text may itself hold several words
        eh, _, _, ef = X.words(*X.column_bytes(pa.array(extra, pa.large_string())), _LETTER)
        hashes.append(eh)
        doc.append(np.array(owner)[X.owner(ef)])
    doc_, h = np.concatenate(doc).astype(np.int64), np.concatenate(hashes)
    u = np.unique(doc_ * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64))
    return u // BUCKETS, u % BUCKETS


def telling_words(rows: DataFrame, keep: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The hashed words whose presence tells most about the label, ascending, with the rows that hold each; rows of label 1 and of label 0.

    ``rows`` has (y, b), the hashed words of a text packed.
    """
    total = {r["y"]: r["count"] for r in rows.select((F.col("y") != 0).cast("int").alias("y")).groupBy("y").count().collect()}
    yes, no = total.get(1, 0), total.get(0, 0)

    def count(batches):
        both = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for y, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                both[int(y != 0)][X.unpack(blob.as_buffer())["f"]] += 1
        k = np.flatnonzero(both.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(both[1][k]), pa.array(both[0][k])], names=["k", "pos", "neg"])

    def weigh(batches):
        for b in batches:
            k, pos, neg = (x.to_numpy() for x in b.columns)
            p, q, both = (pos + 0.1) / (max(yes, 1) + 0.2), (neg + 0.1) / (max(no, 1) + 0.2), (pos + neg + 0.2) / (max(yes, 1) + max(no, 1) + 0.4)

            def gain(a, n, both=both):
                return n * (a * np.log(a / both) + (1 - a) * np.log((1 - a + 1e-9) / (1 - both + 1e-9)))

            g = gain(p, max(yes, 1)) + gain(q, max(no, 1))
            use = (pos + neg >= 3) & (g > 4)
            yield pa.RecordBatch.from_arrays([pa.array(k[use]), pa.array((pos + neg)[use]), pa.array(g[use])], names=["k", "n", "g"])

    counts = rows.select("y", "b").mapInArrow(count, "k bigint, pos bigint, neg bigint").groupBy("k").agg(F.sum("pos"), F.sum("neg"))
    top = sorted((r["k"], r["n"]) for r in counts.mapInArrow(weigh, "k bigint, n bigint, g double").orderBy(F.desc("g"), "k").limit(keep).collect())
    return np.array([k for k, _ in top], np.int64), np.array([n for _, n in top], np.int64), yes, no


def train(rows: DataFrame, keep: int = 3000, steps: int = 50, ridge: float = 0.2) -> dict:
    """Logistic regression on all ``rows`` (y, b) over the words whose presence tells most about the label.

    The words chosen are stored once; every step of L-BFGS is one pass over
    them that returns a gradient a task.  Errors are rounded to 2^-24, so sums
    are exact and do not depend on how rows are dealt.
    """
    top, held, yes, no = telling_words(rows, keep)
    if not yes or not no:
        return {"prior": float(yes > 0)}

    def choose(batches):
        for b in batches:
            got = [X.unpack(x.as_buffer())["f"] for x in b.column(1)]
            if not got:
                continue
            f = np.concatenate(got)
            k = np.minimum(np.searchsorted(top, f), max(len(top) - 1, 0))
            use = top[k] == f if len(top) else np.zeros(len(f), bool)
            n = np.bincount(np.repeat(np.arange(len(got)), [len(x) for x in got])[use], minlength=len(got))
            y = (b.column(0).to_numpy() != 0).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([X.pack(c=k[use].astype(np.int32), n=n.astype(np.int32), y=y)], pa.binary())], names=["b"])

    chosen = saved(rows.select("y", "b").mapInArrow(choose, "b binary"))

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches):
            total = np.zeros(len(x) + 1)
            for b in batches:
                for blob in b.column(0):
                    d = X.unpack(blob.as_buffer())
                    r = np.repeat(np.arange(len(d["n"])), d["n"])
                    z = x[-1] + np.bincount(r, weights=x[d["c"]], minlength=len(d["y"]))
                    e = np.rint((1 / (1 + np.exp(-np.clip(z, -30, 30))) - d["y"]) * GRAIN) / GRAIN
                    loss = np.rint((np.logaddexp(0, z) - d["y"] * z) * GRAIN) / GRAIN
                    total[:-2] += np.bincount(d["c"], weights=e[r], minlength=len(x) - 1)
                    total[-2:] += e.sum(), loss.sum()
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["t"])

        got = sum((np.frombuffer(bytes(r["t"])) for r in chosen.mapInArrow(run, "t binary").collect()), np.zeros(len(x) + 1))
        got[: len(x) - 1] += ridge * x[:-1]
        return float(got[-1] + ridge / 2 * (x[:-1] ** 2).sum()), got[:-1]

    prior = yes / (yes + no)
    # about the curvature at the start, without what words share
    scale = 1 / (prior * (1 - prior) * np.append(held, yes + no) + np.append(np.full(len(top), ridge), 0))
    x = minimise(value, np.append(np.zeros(len(top)), np.log(yes / no)), scale, steps)
    drop(chosen)
    return {"at": top, "w": x[:-1], "b": x[-1]}


def minimise(value, x: np.ndarray, scale: np.ndarray, steps: int, memory: int = 10, least: float = 1e-6) -> np.ndarray:
    """L-BFGS from x with a first inverse curvature ``scale``, until a step gains less than the share ``least`` of the value."""
    f, g = value(x)
    pairs: list[tuple] = []
    for _ in range(steps):
        d, back = g.copy(), []
        for s, y in reversed(pairs):
            back.append(s @ d / (s @ y))
            d -= back[-1] * y
        d *= scale * (pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ (scale * pairs[-1][1])) if pairs else 1.0)
        for (s, y), a in zip(pairs, reversed(back), strict=True):
            d += (a - y @ d / (s @ y)) * s
        slope, t = g @ d, 1.0
        while True:
            new, after = value(x - t * d)
            if new <= f - 1e-4 * t * slope or t < 1e-3:
                break
            t /= 2
        if new >= f:
            break
        if (y := after - g) @ d < 0:
            pairs = [*pairs[1 - memory :], (-t * d, y)]
        gained, x, f, g = f - new, x - t * d, new, after
        if gained < least * max(f, 1.0):
            break
    return x


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", held: int = 0, mod: int = 5) -> dict:
    """Character model and lexicon of all texts, and word weights from all labelled texts outside the held-out remainder.

    Labels travel as a bitmap that tells most other texts apart; whom it lets
    pass wrongly the join of hashed words and labels drops.
    """
    small_batches(docs.sparkSession)
    lm, counts = char_model(char_counts(docs)), word_counts(docs)
    known = saved(L.training(labels, label, mod, held))
    bits = bit_set(known, F.xxhash64("_key"))
    shared = docs.sparkSession.sparkContext.broadcast((lm, counts, bits))

    def run(batches):
        cache: dict = {}
        lm, lexicon, bits = shared.value[0], Lexicon(shared.value[1]), shared.value[2]
        for b in batches:
            b = b.take(pa.array(np.flatnonzero(in_bit_set(bits, b.column(1).to_numpy()))))
            data, offs = X.column_bytes(b.column(2))
            for i, j in X.chunks(offs):
                d, f = word_features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], lm, cache, lexicon)
                cut = np.searchsorted(d, np.arange(j - i + 1))
                blobs = [X.pack(f=f[cut[k] : cut[k + 1]].astype(np.int32)) for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(blobs, pa.binary())], names=["_key", "b"])

    texts = docs.select(F.col("doc_id").alias("_key"), F.xxhash64(F.col("doc_id").cast(known.schema["_key"].dataType)).alias("_h"), F.col("text"))
    hashed = texts.where("_key is not null").mapInArrow(run, T.StructType([texts.schema["_key"], T.StructField("b", T.BinaryType())]))
    rows = saved(hashed.join(known, "_key").select("y", "b"))
    model = {"lm": lm, "words": counts} | train(rows)
    drop(known, rows)
    return model


def score_toxicity(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability of label 1 to every row.

    Null and empty texts get the score of a text without known words; repeated
    rows alike; an empty table gives none.  Without training rows every score
    is 0, with one class only it is that class.  A clashing score column is replaced.
    """
    small_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c.lower() != out.lower()]
    plain = docs.select(*[docs[c] for c in cols])
    shared, at = docs.sparkSession.sparkContext.broadcast(model), cols.index(text)

    def run(batches):
        model, cache = shared.value, {}
        lexicon = Lexicon(model["words"])
        for b in batches:
            data, offs = X.column_bytes(b.column(at))
            s = [np.zeros(0)]
            for i, j in X.chunks(offs):
                if "prior" in model:
                    s.append(np.full(j - i, model["prior"]))
                    continue
                d, f = word_features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], model["lm"], cache, lexicon)
                k = np.minimum(np.searchsorted(model["at"], f), max(len(model["at"]) - 1, 0))
                known = model["at"][k] == f if len(model["at"]) else np.zeros(len(f), bool)
                z = model["b"] + np.bincount(d[known], weights=model["w"][k[known]], minlength=j - i)
                s.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(s), pa.float64())], names=[*b.schema.names, out])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(out, T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows that score below ``threshold``, with their columns."""
    return score_toxicity(docs, fit(docs, labels, **options), out="_toxic_score").where(F.col("_toxic_score") < threshold).select(*docs.columns)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    x = score_toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return x.select("doc_id", (L.remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
