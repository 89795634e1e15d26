"""Katz back-off trigram model over words, with Good-Turing discounts.

Unigram counts are one hash-partitioned table.  Trigrams are dealt to parts by
their middle word, so a part holds every occurrence of its bigrams and of their
trigrams: it counts both, normalises both kinds of back-off weights exactly
and scores the occurrences in place, from unigrams up; only sums by document
leave it.  A middle word that holds a large share of all tokens is dealt by its
left neighbour, too; counts of its bigrams are summed in a second partitioned
table and sent back.  Arrays travel packed, one message for each map buffer and part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm import _learn as L
from docweave.llm import _text as X
from docweave.llm._spark import parts_for, saved, small_batches

K = 5  # counts above K are not discounted
NONE, START, END = np.uint64(0), np.uint64(1), np.uint64(2)
BUFFER = 2_400_000  # tokens held by a map task before it sends messages
LEVEL = 6  # of compression, for the one large exchange
HEAVY = 1000  # a middle word met less often is never split


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's Good-Turing factors for counts 0..K from the numbers n[1..K+1] of types by count.

    Where these are undefined (small or odd tables) the factor is 1 - 0.5/r.
    """
    r = np.arange(1, K + 1, dtype=float)
    plain = np.concatenate([[0.0], 1 - 0.5 / r])
    n = np.asarray(n, float)[1 : K + 2]
    if (n <= 0).any():
        return plain
    x = np.log(np.arange(1, K + 2))
    slope = ((x - x.mean()) * (np.log(n) - np.log(n).mean())).sum() / ((x - x.mean()) ** 2).sum()
    for s in (n, np.exp(slope * x)):  # as counted, else on their log-log line
        with np.errstate(all="ignore"):
            cut = (K + 1) * s[K] / s[0]
            d = ((r + 1) * s[1:] / s[:-1] / r - cut) / (1 - cut)
        if np.isfinite(d).all() and ((d > 0) & (d < 1)).all():
            return np.concatenate([[0.0], d])
    return plain


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts after the discount."""
    c = np.asarray(c)
    return np.where(c <= K, d[np.minimum(c, K)] * c, c).astype(float)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _types_by_count(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c[c > 0], K + 2), minlength=K + 3)[: K + 2].tolist()


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate([*keys, np.zeros(0, np.uint64)])
    c = np.concatenate([*counts, np.zeros(0, np.int64)])
    order = np.argsort(k)
    k, c = k[order], c[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    return k[new], (np.add.reduceat(c, np.flatnonzero(new)) if len(k) else c)


def unigrams(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (part, blob of sorted words and counts, types, tokens, types by count) from rows (_row, _key, _text, _train)."""

    def count(batches):
        keys, counts, size = [], [], 0

        def flush():
            k, c = _merge(keys, counts)
            order = np.argsort(X.mix(k))
            k, c = k[order], c[order]
            cut = np.searchsorted(part_of(X.mix(k), parts), np.arange(parts + 1))
            use = [p for p in range(parts) if cut[p] < cut[p + 1]]
            blobs = [X.pack(k=X.pack_sorted(np.sort(k[cut[p] : cut[p + 1]])), c=c[cut[p] : cut[p + 1]][np.argsort(k[cut[p] : cut[p + 1]])]) for p in use]
            return pa.RecordBatch.from_arrays([pa.array(use, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

        for b in batches:
            data, offs = X.column_bytes(b.column(0))
            for i, j in X.chunks(offs):
                h = X.words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])[0]
                k, c = np.unique(np.append(h, np.repeat(END, j - i)), return_counts=True)
                keys.append(k)
                counts.append(c)
                size += len(k)
                if size > BUFFER:
                    k, c = _merge(keys, counts)
                    keys[:], counts[:], size = [k], [c], len(k)
                    if size > BUFFER:
                        yield flush()
                        keys[:], counts[:], size = [], [], 0
        if keys:
            yield flush()

    def merge(batches):
        by: dict[int, list] = {}
        for b in batches:
            for p, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = X.unpack(blob.as_buffer())
                by.setdefault(p, []).append((X.unpack_sorted(x["k"]), x["c"]))
        for p, own in by.items():
            k, c = _merge([x for x, _ in own], [x for _, x in own])
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([X.pack(k=X.pack_sorted(k), c=c)], pa.binary()), pa.array([len(k)], pa.int64()), pa.array([int(c.sum())], pa.int64()), pa.array([_types_by_count(c)], pa.list_(pa.int64()))], names=["part", "blob", "v", "n", "r"])

    rows = docs.where("_train").select("_text").mapInArrow(count, "part int, blob binary")
    return rows.repartition(parts, "part").mapInArrow(merge, "part int, blob binary, v bigint, n bigint, r array<bigint>")


def frequent_counts(table: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words counted at least ``least`` times and their counts; no more than tokens / least of them."""

    def run(batches):
        for b in batches:
            for blob in b.column(0):
                x = X.unpack(blob.as_buffer())
                use = x["c"] >= least
                yield pa.RecordBatch.from_arrays([pa.array(X.unpack_sorted(x["k"])[use].astype(np.int64), pa.int64()), pa.array(x["c"][use], pa.int64())], names=["k", "c"])

    got = sorted((r["k"] & ((1 << 64) - 1), r["c"]) for r in table.select("blob").mapInArrow(run, "k bigint, c bigint").collect())
    return np.array([k for k, _ in got], np.uint64), np.array([c for _, c in got], np.int64)


def _context(ctx: np.ndarray) -> np.ndarray:
    return X.mix(ctx + np.uint64(0x9E3779B97F4A7C15))


def _member(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def trigrams(docs: DataFrame, parts: int, heavy: np.ndarray) -> DataFrame:
    """Rows (part, blob): distinct trigrams of a buffer with their occurrences by document.

    The first token of a text has no trigram, its left neighbour is NONE.
    """
    heavy_c = np.sort(_context(heavy))

    def run(batches):
        held: list = []
        size = docs_held = 0

        def flush():
            left, ctx, word, ref, train = (np.concatenate([x[i] for x in held]) for i in range(5))
            rows, keys, nulls = (np.concatenate([x[i] for x in held]) for i in (5, 6, 7))
            c = _context(ctx)
            big = _member(heavy_c, c)
            lead = np.where(big, X.mix(c ^ (np.where(left == NONE, word, left) * np.uint64(0x9E3779B97F4A7C15))), c)
            # by context, word and left neighbour, so that equal trigrams meet and places of words grow
            sort = (lead & np.uint64(0xFFFFFFFF00000000)) | (word >> np.uint64(48) << np.uint64(16)) | (left >> np.uint64(48))
            order = np.argsort(sort)
            c, left, word, ref, train, part = c[order], left[order], word[order], ref[order], train[order], part_of(sort[order], parts)
            cut = np.searchsorted(part, np.arange(parts + 1))
            first = np.empty(len(rows), np.int32)  # a document's key goes to one part
            first[ref[::-1]] = part[::-1]
            for p in range(parts):
                a, z = cut[p], cut[p + 1]
                if a == z:
                    continue
                pc, pl, pw = c[a:z], left[a:z], word[a:z]
                new = np.ones(z - a, bool)
                new[1:] = (pc[1:] != pc[:-1]) | (pw[1:] != pw[:-1]) | (pl[1:] != pl[:-1])
                at = np.flatnonzero(new)
                uc, ci = np.unique(pc[at], return_inverse=True)
                # words once a message, then their places
                uw, wi = np.unique(np.concatenate([pl[at], pw[at]]), return_inverse=True)
                own, d = np.unique(ref[a:z], return_inverse=True)
                told = first[own] == p
                blob = X.pack(
                    _level=LEVEL, uc=X.pack_sorted(uc), ci=ci.astype(np.uint32), uw=X.pack_sorted(uw), li=wi[: len(at)].astype(np.uint32), wi=wi[len(at) :].astype(np.uint32),
                    n=np.diff(at, append=z - a).astype(np.uint32), t=np.add.reduceat(train[a:z].astype(np.uint32), at), d=d.astype(np.uint32), g=rows[:1], row=rows[own], told=told, key=keys[own][told], null=nulls[own][told],
                )
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([blob], pa.binary())], names=["part", "blob"])

        for b in batches:
            data, offs = X.column_bytes(b.column(2))
            rows, train = b.column(0).to_numpy(), b.column(3).to_numpy(zero_copy_only=False)
            nulls = b.column(1).is_null().to_numpy(zero_copy_only=False)
            keys = b.column(1).fill_null(0).to_numpy()
            for i, j in X.chunks(offs):
                h, _, _, first = X.words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                doc, n = X.owner(first), len(h) + j - i
                at = np.arange(len(h)) + doc
                word, ctx, left = np.full(n, END), np.full(n, START), np.full(n, NONE)
                word[at], ctx[at + 1] = h, h
                ref = np.repeat(np.arange(j - i), np.diff(first) + 1)
                left[1:] = np.where(ref[1:] == ref[:-1], ctx[:-1], NONE)
                held.append((left, ctx, word, ref + docs_held, train[i:j][ref], rows[i:j], keys[i:j], nulls[i:j]))
                size, docs_held = size + n, docs_held + j - i
                if size > BUFFER:
                    yield from flush()
                    held, size, docs_held = [], 0, 0
                    X.release()
        if held:
            yield from flush()

    return docs.select("_row", "_key", "_text", "_train").mapInArrow(run, "part int, blob binary").repartitionById(parts, F.col("part"))


def _words_of(x: dict) -> tuple[np.ndarray, np.ndarray]:
    u = X.unpack_sorted(x["uw"])
    return u[x["li"]], u[x["wi"]]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows of equal keys, and the group of every row; rows are sorted by the keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _load(blobs):
    """Distinct trigrams of some messages, sorted by context, word and left neighbour: those, training counts, and the messages with their places."""
    loaded = [X.unpack(b.as_buffer()) for b in blobs]
    c = np.concatenate([X.unpack_sorted(x["uc"])[x["ci"]] for x in loaded])
    u, w = (np.concatenate(x) for x in zip(*[_words_of(x) for x in loaded], strict=True))
    t = np.concatenate([x["t"] for x in loaded]).astype(np.int64)
    order = np.lexsort((u, w, c))
    first, at = _groups(c[order], w[order], u[order])
    place = np.empty(len(c), np.int64)
    place[order] = at
    pick = order[first]
    return c[pick], w[pick], u[pick], np.bincount(place, weights=t, minlength=len(pick)).astype(np.int64), loaded, place


def _katz(seen, t, size, kept, known, lower, of, d) -> np.ndarray:
    """One step of the back-off: discounted n-grams, or the lower order's probability times the context's exact weight.

    ``size`` counts a context's training tokens, ``kept`` what is left of them
    by the discount, ``known`` the lower order's mass of its seen words.
    """
    with np.errstate(all="ignore"):
        none = (size > 0) & (size - kept < 1e-9)  # nothing was discounted: keep one count for the rest
        total = size + none
        rest = np.where(size > 0, (total - kept) / np.maximum(total, 1), 1.0)
        alpha = np.where(size > 0, rest / np.maximum(1 - known, 1e-12), 1.0)
        return np.where(seen, discounted(t, d) / np.maximum(total, 1)[of], alpha[of] * lower)


class _Bigrams:
    """Bigrams of a part: context, word and training count, in the order of ``_load``, and each trigram's bigram."""

    def __init__(self, c: np.ndarray, w: np.ndarray, t: np.ndarray):
        first, self.of = _groups(c, w)
        self.c, self.w, self.t = c[first], w[first], np.bincount(self.of, weights=t, minlength=len(first)).astype(np.int64)


def _by_part(batches):
    by: dict[int, list] = {}
    for b in batches:
        for p, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            by.setdefault(p, []).append(blob)
    return by.items()


class _Model:
    """Fixed numbers of the model: unigram totals and discounts."""

    def __init__(self, n: int, v: int, r: np.ndarray):
        self.n, self.v, self.d = n, v, discounts(r)
        r = np.asarray(r, float)
        low = float((np.arange(1, K + 1) * (1 - self.d[1:]) * r[1 : K + 1]).sum())
        self.extra = 0 if low > 0 else 1  # keep some mass for unknown words
        self.unknown = (low + self.extra) / (n + self.extra) if n else 1.0

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d) / max(self.n + self.extra, 1), self.unknown)


def katz_scores(docs: DataFrame, train, text: str = "text", key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """log10 probability of every text; ``train`` is a column that marks the training rows.

    Lower-cased words and one end token per text are scored.  Returns one row
    per input row: key, trained, n_tokens, n_known, train_tokens, base_score
    (add-one unigrams) and score (Katz).  Null and empty texts consist of the
    end token; repeated rows count each; an empty table gives none; without
    training rows an unknown word has probability 1.  Null keys stay null.
    Other columns are ignored, whatever their names.  Keys are whole numbers;
    words are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = parts or max(2, parts_for(docs))
    src = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"), F.coalesce(train, F.lit(False)).alias("_train"))
    table = saved(unigrams(src, parts))
    total = table.agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.coalesce(F.sum(F.get("r", F.lit(i))), F.lit(0)).alias(f"r{i}") for i in range(K + 2)]).first()
    uni = _Model(int(total["n"]), int(total["v"]), np.array([total[f"r{i}"] for i in range(K + 2)]))
    heavy, _ = frequent_counts(table, max(HEAVY, uni.n // (4 * parts)))
    heavy = np.unique(np.append(heavy[heavy != END], START))
    heavy_c = np.sort(_context(heavy))
    dealt = trigrams(src, parts, heavy)

    def ask(batches):  # which words a part needs from each part of the unigram table, with its bigrams of heavy contexts, and its types by count
        for p, blobs in _by_part(batches):
            c, w, u, t, _, _ = _load(blobs)
            two = _Bigrams(c, w, t)
            big = _member(heavy_c, two.c)
            r = np.array(_types_by_count(two.t[~big]) + _types_by_count(t[u != NONE]))
            words, (hc, hw, ht) = np.unique(two.w), (x[big] for x in (two.c, two.w, two.t))
            of, hof = part_of(X.mix(words), parts), part_of(X.mix(hw), parts)
            for q in np.unique(of).tolist():
                i = hof == q
                blob = X.pack(k=X.pack_sorted(words[of == q]), c=hc[i], w=hw[i], t=ht[i], r=r)
                r = r[:0]
                yield pa.RecordBatch.from_arrays([pa.array([q], pa.int32()), pa.array([p], pa.int32()), pa.array([blob], pa.binary())], names=["part", "to", "ask"])

    state = pa.schema([("part", pa.int32()), ("words", pa.binary()), ("c", pa.int64()), ("s", pa.list_(pa.float64()))])

    def answer(key, asked, own):  # counts of words and of whole heavy bigrams; types by count; and what heavy contexts' normalisers need
        k, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if own.num_rows:
            x = X.unpack(own.column("blob")[0].as_buffer())
            k, n = X.unpack_sorted(x["k"]), x["c"]

        def count_of(w):
            if not len(k):
                return np.zeros(len(w), np.int64)
            i = np.minimum(np.searchsorted(k, w), len(k) - 1)
            return np.where(k[i] == w, n[i], 0)

        got = [X.unpack(b.as_buffer()) for b in asked.column("ask")]
        if not got:
            return state.empty_table()
        c, w, t = (np.concatenate([x[f] for x in got]) for f in "cwt")
        order = np.lexsort((w, c))
        first, at = _groups(c[order], w[order])
        whole = np.bincount(at, weights=t[order], minlength=len(first)).astype(np.int64)
        back = np.empty(len(c), np.int64)
        back[order] = whole[at]
        types = sum([x["r"] for x in got if len(x["r"])], np.zeros(2 * K + 4, np.int64))
        types[: K + 2] += np.array(_types_by_count(whole))
        rows = [{"part": -1, "s": types.astype(float).tolist()}]
        seen = whole > 0
        uc, ci = np.unique(c[order][first][seen], return_inverse=True)
        p1 = uni.unigram(count_of(w[order][first]))
        sums = np.stack([np.bincount(ci, weights=x[seen], minlength=len(uc)) for x in (whole, p1, np.where(whole > K, whole, 0), *[whole == r for r in range(1, K + 1)])], 1)
        rows += [{"part": -1, "c": x, "s": y} for x, y in zip(uc.astype(np.int64).tolist(), sums.tolist(), strict=True)]
        lo = 0
        for p, x in zip(asked.column("to").to_pylist(), got, strict=True):
            hi = lo + len(x["c"])
            # in the order asked, which the part knows
            rows.append({"part": p, "words": X.pack(q=np.array([key[0].as_py()]), n=count_of(X.unpack_sorted(x["k"])), t=back[lo:hi])})
            lo = hi
        return pa.Table.from_pylist(rows, schema=state)

    asked = dealt.mapInArrow(ask, "part int, to int, ask binary").repartitionById(parts, F.col("part"))
    table_by = table.select("part", "blob").repartitionById(parts, F.col("part"))
    told = asked.groupBy("part").cogroup(table_by.groupBy("part")).applyInArrow(answer, "part int, words binary, c bigint, s array<double>")

    # one row of as many entries as heavy contexts, which is at most 4 * parts, and one; it goes to every part once
    sums = told.where("part = -1").groupBy("c").agg(F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(2 * K + 4)]).alias("s"))
    sums = sums.agg(F.collect_list(F.struct(F.col("c"), F.col("s"))).alias("sums")).withColumn("_z", F.lit(0))
    every = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("_z")).join(F.broadcast(sums), "_z").select("part", "sums")
    kind = "array<struct<c:bigint,s:array<double>>>"
    told_all = told.where("part >= 0").select("part", "words", F.lit(None).cast(kind).alias("sums"))
    told_all = told_all.union(every.select("part", F.lit(None).cast("binary"), F.col("sums").cast(kind))).repartitionById(parts, F.col("part"))

    def global_sums(rows):
        got = next(x.as_py() for x in rows if x.is_valid)
        count = next((np.array(x["s"]) for x in got if x["c"] is None), np.zeros(2 * K + 4))
        norms = sorted((x["c"] & ((1 << 64) - 1), x["s"][: K + 3]) for x in got if x["c"] is not None)
        return discounts(count[: K + 2]), discounts(count[K + 2 :]), np.array([c for c, _ in norms], np.uint64), np.array([x for _, x in norms], float).reshape(-1, K + 3)

    def score(key, own, words):
        if not own.num_rows:
            return pa.table({"g": pa.array([], pa.int64()), "blob": pa.array([], pa.binary())})
        d2, d3, names, sums = global_sums(words.column("sums"))
        c, w, u, t, loaded, place = _load(own.column("blob"))
        two = _Bigrams(c, w, t)
        known_, big = np.unique(two.w), np.flatnonzero(_member(heavy_c, two.c))
        of, hof, n = part_of(X.mix(known_), parts), part_of(X.mix(two.w[big]), parts), np.zeros(len(known_), np.int64)
        for blob in words.column("words"):
            if blob.is_valid:  # counts of this part's words, and whole counts of its heavy bigrams
                x = X.unpack(blob.as_buffer())
                n[of == x["q"][0]], two.t[big[hof == x["q"][0]]] = x["n"], x["t"]
        count2 = n[np.searchsorted(known_, two.w)]
        p1 = uni.unigram(count2)
        first, of = _groups(two.c)
        seen = two.t > 0
        size, kept, known = (np.bincount(of, weights=x, minlength=len(first)) for x in (two.t, discounted(two.t, d2), np.where(seen, p1, 0.0)))
        at = np.searchsorted(names, two.c[first])
        big = np.flatnonzero(_member(names, two.c[first]))
        if len(big):
            x = sums[at[big]]
            size[big], known[big] = x[:, 0], x[:, 1]
            kept[big] = x[:, 2] + x[:, 3:] @ (np.arange(1, K + 1) * d2[1:])
        p2 = _katz(seen, two.t, size, kept, known, p1, of, d2)[two.of]
        # trigrams: the same step over bigrams, in the order of context and left neighbour
        order = np.lexsort((u, c))
        first, of_sorted = _groups(c[order], u[order])
        of = np.empty(len(c), np.int64)
        of[order] = of_sorted
        seen = t > 0
        size, kept, known = (np.bincount(of, weights=x, minlength=len(first)) for x in (t, discounted(t, d3), np.where(seen, p2, 0.0)))
        p = np.where(u == NONE, p2, _katz(seen, t, size, kept, known, p2, of, d3))
        count = count2[two.of]
        with np.errstate(divide="ignore"):
            logp = np.log10(p)
        base = np.log10((count + 1) / (uni.n + uni.v + 1))
        out, at = [], 0
        for x in loaded:
            m = len(x["n"])
            pair = np.repeat(place[at : at + m], x["n"])
            at += m
            docs_, z = x["d"], len(x["row"])
            blob = X.pack(
                row=x["row"], told=x["told"], key=x["key"], null=x["null"], n=np.bincount(docs_, minlength=z).astype(np.int32), known=np.bincount(docs_, weights=count[pair] > 0, minlength=z).astype(np.int32),
                base=np.bincount(docs_, weights=base[pair], minlength=z), logp=np.bincount(docs_, weights=logp[pair], minlength=z),
            )
            out.append((int(x["g"][0]), blob))
        X.release()
        return pa.table({"g": pa.array([g for g, _ in out], pa.int64()), "blob": pa.array([b for _, b in out], pa.binary())})

    def add(batches):  # the parts' sums of a buffer's documents
        by: dict[int, list] = {}
        for b in batches:
            for g, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                by.setdefault(g, []).append(blob)
        for blobs in by.values():
            got = [X.unpack(b.as_buffer()) for b in blobs]
            rows = np.concatenate([x["row"] for x in got])
            _, one, at = np.unique(rows, return_index=True, return_inverse=True)
            total = lambda c: np.bincount(at, weights=np.concatenate([x[c] for x in got]), minlength=len(one))  # noqa: B023,E731
            known = np.concatenate([x["told"] for x in got])
            keys, nulls = np.empty(len(one), np.int64), np.empty(len(one), bool)
            keys[at[known]], nulls[at[known]] = (np.concatenate([x[c] for x in got]) for c in ("key", "null"))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64(), mask=nulls), pa.array(total("n").astype(np.int64)), pa.array(total("known").astype(np.int64)), pa.array(total("base")), pa.array(total("logp"))], names=["_key", "n_tokens", "n_known", "base_score", "score"])

    rows = dealt.groupBy("part").cogroup(told_all.groupBy("part")).applyInArrow(score, "g bigint, blob binary")
    sums = rows.repartition(parts, "g").mapInArrow(add, "_key bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    return sums.select(F.col("_key").alias(key), "n_tokens", "n_known", F.lit(uni.n).cast("long").alias("train_tokens"), "base_score", "score")


def op2_katz(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    x = katz_scores(docs, L.remainder("doc_id", 7) != 2)
    return x.select("doc_id", (L.remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
