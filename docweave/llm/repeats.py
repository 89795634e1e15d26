"""Repeated passages across documents, by words (suffix trees) or bytes (longest previous factors).

A window is ``size`` symbols of one text.  Its anchor is the leftmost least
hash among its q-grams, so equal windows have equal anchors at equal places.
Texts that lack a partner for an anchor can repeat no window there; only the
runs of windows around shared anchors go on, each as the symbols it covers,
dealt by anchor.  Runs that are equal symbol by symbol become one; a part then
builds its suffix structures over the different ones, and these alone tell
which windows a document with a smaller key holds: nodes of the suffix trees,
or the lengths of the longest previous factors.  Exchanges carry texts, anchors and
runs; every message is merged within its bucket of documents first, so a
passage in a third of all texts is sent once a bucket.

Symbols of op7 are 64-bit hashes of words, so two given different words are
taken as one with probability 2**-64; bytes are compared as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm import _text as X
from docweave.llm._spark import parts_for, small_batches
from docweave.llm.katz import part_of

SLICE = 1_000_000  # symbols that suffix structures are built over at once
GROUP = 250_000  # suffixes of one subtree
CHUNK = 130_000  # bytes that are scanned at once, so that their hashes stay in the cache
LEVEL = 6  # compression of runs
PENDING = 1_000_000  # anchors of a bucket before equal ones are merged
JUMPS = 24  # steps to a smaller document before tables of ranges are made
LAST = np.iinfo(np.int64).max  # stands for a null key: larger than all others


def symbols(data: np.ndarray, offs: np.ndarray, by_words: bool):
    """Symbols of all texts, each text's first symbol, and the words' byte spans."""
    if by_words:
        h, starts, ends, first = X.words(data, offs, X.SPACE, lower=False)
        return h, first, starts, ends
    return data, offs, None, None


def gram_hash(sym: np.ndarray, q: int, at: np.ndarray | None = None) -> np.ndarray:
    return (X.byte_grams if sym.dtype == np.uint8 else X.grams)(sym, q, at)


def anchor_name(a: np.ndarray) -> np.ndarray:
    """Forty bits of anchors, which are small hashes and so are mixed again; ascending names go to ascending parts.

    Texts ask by name.  Two anchors of one name only send runs that turn out alone.
    """
    return X.mix(a) >> np.uint64(24)


def anchors(sym: np.ndarray, first: np.ndarray, size: int, q: int):
    """Runs of windows with one anchor: (text, first window, windows, anchor place, anchor hash)."""
    n = len(sym)
    if n < size:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    g = gram_hash(sym, q)
    width = size - q + 1
    # the upper half of a hash and its place below: the least of span places is the leftmost, doubled up to the width
    low = np.uint64((1 << 32) - 1)
    key, span = (g & ~low) | np.arange(len(g), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        key = np.minimum(key[: len(key) - step], key[step:])
        span += step
    new = np.ones(n - size + 1, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    # texts begin with a run, and so do the windows that reach out of them
    edge = np.concatenate([first, first - size + 1])
    new[edge[(edge >= 0) & (edge < len(new))]] = True
    s = np.flatnonzero(new)
    m = np.diff(s, append=len(new))
    text = np.searchsorted(first, s, "right") - 1
    use = s + size <= first[text + 1]
    s, m, text = s[use], m[use], text[use]
    at = (key[s] & low).astype(np.int64)
    return text, s, m, at, g[at]


def run_hash(sym: np.ndarray, s: np.ndarray, e: np.ndarray, anchor: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Identity of a run: its symbols, its anchor and the anchor's place in it."""
    h = (X.byte_hash if sym.dtype == np.uint8 else X.sequence_hash)(sym, s, e)
    return X.mix(h ^ X.mix(anchor + (place - s).astype(np.uint64)) ^ (e - s).astype(np.uint64))


class Suffixes:
    """Ranks of the suffixes of some runs by their first c, 2c, 4c, ... symbols; a suffix ends with its run.

    The last doubling, to whole suffixes, is made for those at ``starts`` only.
    """

    def __init__(self, sym: np.ndarray, ends: np.ndarray, starts: np.ndarray):
        self.ends, self.starts = ends, starts  # ends by position: where its run ends
        self.base = base = sym.astype(np.uint64) + np.uint64(1) if sym.dtype == np.uint8 else X.dense_ranks(sym).astype(np.uint64) + np.uint64(1)
        n, width = len(base), int(base.max()).bit_length() if len(base) else 1
        c = max(1, 63 // width)
        left = ends - np.arange(n)
        key = base << np.uint64(width * (c - 1))
        for k in range(1, min(c, n)):  # as many symbols as fit a number
            key[: n - k] |= base[k:] << np.uint64(width * (c - 1 - k))
        # zeros past the end
        key &= np.array([((1 << width * k) - 1) << width * (c - k) for k in range(c + 1)], np.uint64)[np.minimum(left, c)]
        self.levels = [(c, X.dense_ranks(key).astype(np.int32))]
        longest = int(left.max()) if n else 0
        while 2 * self.levels[-1][0] < longest:
            have, r = self.levels[-1]
            key = r.astype(np.uint64) << np.uint64(32)
            if have < n:
                key[: n - have] |= np.where(left[: n - have] > have, r[have:] + 1, 0).astype(np.uint64)
            self.levels.append((2 * have, X.dense_ranks(key).astype(np.int32)))
        have, r = self.levels[-1]
        self.whole = r[starts].astype(np.uint64) << np.uint64(32)
        far = np.flatnonzero(left[starts] > have)
        self.whole[far] |= (r[starts[far] + have] + 1).astype(np.uint64)

    def order(self, own: np.ndarray) -> np.ndarray:
        """The suffixes ``own``, given as indices of ``starts``, in their order."""
        return own[np.argsort(self.whole[own], kind="stable")]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes a and b."""
        n, most = np.zeros(len(a), np.int64), np.minimum(self.ends[a] - a, self.ends[b] - b)
        for have, r in reversed([*self.levels, self.levels[-1]]):
            live = np.flatnonzero(n < most)
            i, j = a[live] + n[live], b[live] + n[live]
            live = live[r[i] == r[j]]
            n[live] = np.minimum(n[live] + have, most[live])
        for _ in range(self.levels[0][0] - 1):
            live = np.flatnonzero(n < most)
            i, j = a[live] + n[live], b[live] + n[live]
            n[live[self.base[i] == self.base[j]]] += 1
            # a suffix that differs once stays where it is
            most[live[self.base[i] != self.base[j]]] = 0
        return n


class AnchoredSuffixes:
    """The same for bytes, of windows only, by their anchor, by how far they start before it, and only then by their symbols.

    Equal windows have equal anchors at equal places, so suffixes of another
    anchor or place never share a window.  Those that start at their anchor
    are sorted as they are; one that starts a byte earlier is ordered by that
    byte, then by the order of the suffix behind it.  The runs come ordered by
    anchor.
    """

    def __init__(self, sym: np.ndarray, at: np.ndarray, m: np.ndarray, anchor: np.ndarray, place: np.ndarray, size: int):
        span = m + size - 1
        self.x, first = X.eights(sym), np.cumsum(m) - m
        self.starts = np.repeat(at - first, m) + np.arange(m.sum())
        self.ends = np.repeat(at + span, span)
        p, right, low = at + place, span - place, place - m + 1
        kind = np.cumsum(np.diff(anchor, prepend=anchor[:1]) != 0).astype(np.uint64) << np.uint64(40)
        words = [right]
        for k in reversed(range(0, int(right.max()), 8)):
            left = np.clip(right - k, 0, 8)
            words.append((self.x[np.where(left > 0, p + k, 0)] & X._LOW_BYTES[left]).byteswap())
        now = np.lexsort((*words, kind))
        found = []
        for j in range(int(place.max()) + 1):
            found.append((first + place - j)[now][low[now] <= j])
            now = now[place[now] > j]
            key = kind[now] | sym[p[now] - j - 1].astype(np.uint64) << np.uint64(32) | np.arange(len(now), dtype=np.uint64)
            key.sort()
            now = now[(key & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        self.sorted = np.concatenate(found)

    def order(self, own: np.ndarray) -> np.ndarray:
        if len(own) == len(self.sorted):
            return self.sorted
        rank = np.empty(len(self.sorted), np.int64)
        rank[self.sorted] = np.arange(len(self.sorted))
        return own[np.argsort(rank[own])]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, most = np.zeros(len(a), np.int64), np.minimum(self.ends[a] - a, self.ends[b] - b)
        live, k = np.arange(len(a)), 0
        while len(live):
            d = self.x[a[live] + k] ^ self.x[b[live] + k]
            k += 8
            off = d != 0
            n[live[off]] = k - 8 + (np.bitwise_count((d & (~d + np.uint64(1))) - np.uint64(1))[off] >> 3)
            live = live[~off]
            n[live] = k
            live = live[most[live] > k]
        return np.minimum(n, most)


class Least:
    """Smallest value of any range, from tables of ranges of 1, 2, 4, ... values."""

    def __init__(self, x: np.ndarray):
        self.tables = [x]
        while 2 << (len(self.tables) - 1) <= len(x):
            t, step = self.tables[-1], 1 << (len(self.tables) - 1)
            self.tables.append(np.minimum(t[:-step], t[step:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest of [lo, hi), which is not empty."""
        out = np.empty(len(lo), self.tables[0].dtype)
        k = np.floor(np.log2(hi - lo)).astype(np.int64)
        for level in np.unique(k).tolist():
            use = np.flatnonzero(k == level)
            t = self.tables[level]
            out[use] = np.minimum(t[lo[use]], t[hi[use] - (1 << level)])
        return out

    def before(self, value: np.ndarray) -> np.ndarray:
        """For every place the nearest place before it whose value is below ``value``, or -1."""
        at = np.arange(len(value))
        for level in range(len(self.tables) - 1, -1, -1):
            step, t = 1 << level, self.tables[level]
            live = np.flatnonzero(at >= step)
            live = live[t[at[live] - step] >= value[live]]
            at[live] -= step
        return at - 1

    def after(self, value: np.ndarray) -> np.ndarray:
        """The same behind it, or the number of values."""
        n = len(value)
        at = np.arange(1, n + 1)
        for level in range(len(self.tables) - 1, -1, -1):
            step, t = 1 << level, self.tables[level]
            live = np.flatnonzero(at + step <= n)
            live = live[t[at[live]] >= value[live]]
            at[live] += step
        return at


def internal_nodes(common: np.ndarray, depth: int):
    """Internal nodes of the suffix tree at ``depth`` or deeper, as (first leaf, end, depth, whether no other lies above).

    ``common`` holds the common prefix lengths of neighbouring leaves.
    """
    deep = np.flatnonzero(common >= depth)
    table = Least(common)
    lo, hi = table.before(common)[deep] + 1, table.after(common)[deep] + 1
    _, one = np.unique(lo * (len(common) + 2) + hi, return_index=True)
    lo, hi, own = lo[one], hi[one], common[deep][one]
    above = np.maximum(np.where(lo > 0, common[lo - 1], 0), np.where(hi <= len(common), common[np.minimum(hi - 1, len(common) - 1)], 0))
    return lo, hi, own, above < depth


def solve_by_trees(suffixes: Suffixes, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """By window: whether a smaller document holds it, and whether its leaf is deep enough to repeat in a later copy of the run.

    Variable-length prefixes split the suffixes into groups: a prefix grows
    while more than GROUP suffixes share it.  Each group's subtree is built
    from its leaves in order and their common prefixes.  Nodes of depth
    ``size`` or more are the maximal repeats; the topmost above a leaf holds
    all places of the leaf's window.
    """
    starts = suffixes.starts
    before, again = np.zeros(len(starts), bool), suffixes.ends[starts] - starts >= size
    todo, ready = [(np.arange(len(starts)), 0)], []
    while todo:
        own, level = todo.pop()
        if len(own) <= GROUP or level >= len(suffixes.levels) or suffixes.levels[level][0] > size:
            ready.append(own)
            continue
        prefix = suffixes.levels[level][1][starts[own]]
        order = np.argsort(prefix, kind="stable")
        cut = np.append(np.flatnonzero(np.diff(prefix[order], prepend=-1)), len(own))
        large = np.append(np.flatnonzero(np.diff(cut) > GROUP), len(cut) - 1)
        lo = 0
        while lo < len(cut) - 1:
            stop = int(large[np.searchsorted(large, lo)])
            if stop == lo:
                todo.append((own[order[cut[lo] : cut[lo + 1]]], level + 1))
                lo += 1
                continue
            # small neighbours share a group
            hi = min(stop, int(np.searchsorted(cut, cut[lo] + GROUP, "right")) - 1)
            ready.append(own[order[cut[lo] : cut[hi]]])
            lo = hi
    for own in ready:
        leaf = suffixes.order(own)
        if len(leaf) < 2:
            continue
        lo, hi, _, top = internal_nodes(suffixes.common(starts[leaf[:-1]], starts[leaf[1:]]), size)
        least = Least(doc[leaf]).of(lo[top], hi[top])
        width = hi[top] - lo[top]
        at = np.repeat(lo[top] - np.cumsum(width) + width, width) + np.arange(width.sum())
        before[leaf[at]] = np.repeat(least, width) < doc[leaf[at]]
    return before, again


def smaller_before(common: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Common prefix lengths with the nearest suffix before that a smaller document has, 0 without one.

    A suffix looks at its neighbour; while that is no smaller, it goes on from
    where the neighbour looks, as nothing between is smaller.  The few that
    JUMPS do not settle are found in tables of ranges.
    """
    n = len(doc)
    to = np.arange(-1, n - 1)
    low = np.concatenate([np.zeros(1, np.int64), common])
    live = np.flatnonzero(doc[1:] <= doc[:-1]) + 1
    for _ in range(JUMPS):
        if not len(live):
            return low
        by = to[live]
        to[live], low[live] = to[by], np.minimum(low[live], low[by])
        # a common prefix of 0 stays 0
        live = live[low[live] > 0]
        live = live[doc[to[live]] >= doc[live]]
    if len(live):
        docs, prefix = Least(doc), Least(common)
        prev = docs.before(doc)[live]
        low[live] = 0
        live, prev = live[prev >= 0], prev[prev >= 0]
        low[live] = prefix.of(prev, live)
    return low


def previous_factors(common: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Lengths of the longest previous factors of suffixes in order: common prefixes with the previous and next smaller document."""
    return np.maximum(smaller_before(common, doc), smaller_before(common[::-1], doc[::-1])[::-1])


def solve_by_lpf(suffixes: Suffixes, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``solve_by_trees``, by longest previous factors over the suffix array; a later copy's factor is all that is left of its run."""
    starts = suffixes.starts
    order = suffixes.order(np.arange(len(starts)))
    length = np.zeros(len(starts), np.int64)
    common = suffixes.common(starts[order[:-1]], starts[order[1:]])
    # a suffix that shares no window with a neighbour shares none at all
    deep = np.zeros(len(order) + 1, bool)
    deep[1:-1] = common >= size
    use = np.flatnonzero(deep[1:] | deep[:-1])
    if len(use):
        length[order[use]] = previous_factors(common[use[1:] - 1], doc[order[use]])
    return length >= size, suffixes.ends[starts] - starts >= size


def _equal_runs(sym: np.ndarray, at: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Raise unless the runs a and b, whose hashes are equal, agree symbol by symbol."""
    if sym.dtype == np.uint8 and len(a):  # eight symbols at a time
        n, x, y, word = length[a], at[a], at[b], X.eights(sym)
        equal = (n == length[b]).all()
        for k in range(0, int(n.max()), 8):
            use = n > k
            n, x, y = n[use], x[use], y[use]
            equal = equal and not ((word[x + k] ^ word[y + k]) & X._LOW_BYTES[np.minimum(n - k, 8)]).any()
        if not equal:
            raise ValueError("two different runs share a hash")
        return
    for i in range(0, len(a), 20_000):
        x, y = a[i : i + 20_000], b[i : i + 20_000]
        n = length[x]
        if (n != length[y]).any():
            raise ValueError("two different runs share a hash")
        off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if (sym[np.repeat(at[x], n) + off] != sym[np.repeat(at[y], n) + off]).any():
            raise ValueError("two different runs share a hash")


def mark_repeats(docs: DataFrame, by_words: bool, size: int, q: int, solve: Callable, finish: Callable, schema: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Apply ``finish`` to every text with the mask of its symbols that repeat a smaller document's window."""
    spark = docs.sparkSession
    small_batches(spark)
    q = min(size, max(q, size - 60))  # a run's windows fit the bits of a number
    parts = buckets = parts_for(docs)
    src = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    dealt = src.withColumn("bk", F.pmod(F.xxhash64("_key", "_text"), F.lit(buckets)).cast("int")).repartitionById(buckets, F.col("bk"))

    def scan(batch_key, batch_text):
        """Runs of some rows, chunk by chunk."""
        data, offs = X.column_bytes(batch_text)
        keys = batch_key.cast(pa.int64()).fill_null(LAST).to_numpy()
        for i, j in X.chunks(offs, CHUNK if not by_words else 1_000_000):
            d, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            sym, first, s, e = symbols(d, o, by_words)
            yield keys[i:j], d, o, sym, first, s, e, anchors(sym, first, size, q)

    def ask(batches):  # names of the anchors of a bucket, with whether different documents in it have them
        held: dict[int, list] = {}
        for b in batches:
            bk = b.column(2).to_numpy()
            for k in np.unique(bk).tolist():
                pick = pa.array(np.flatnonzero(bk == k))
                for keys, _, _, _, _, _, _, (t, _, _, _, a) in scan(b.column(0).take(pick), b.column(1).take(pick)):
                    own = held.setdefault(k, [])
                    own.append((anchor_name(a), keys[t], np.zeros(len(a), bool)))
                    if sum(len(x[0]) for x in own[1:]) > PENDING:
                        own[:] = [_owners(*(np.concatenate([x[i] for x in own]) for i in range(3)))]
            X.release()
        for k, got in held.items():
            a, _, many = _owners(*(np.concatenate([x[i] for x in got]) for i in range(3)))
            cut = np.searchsorted(part_of(a << np.uint64(24), parts), np.arange(parts + 1))
            for i in range(parts):
                s = slice(cut[i], cut[i + 1])
                if cut[i] < cut[i + 1]:
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([k], pa.int32()), pa.array([X.pack(a=X.pack_sorted(a[s]), m=many[s])], pa.binary())], names=["part", "bk", "blob"])

    def share(batches):  # anchors that different documents, or buckets, have, back to the buckets
        by: dict[int, list] = {}
        for b in batches:
            for p, k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                by.setdefault(p, []).append((k, blob))
        for rows in by.values():
            got = []
            for k, blob in rows:
                x = X.unpack(blob.as_buffer())
                got.append((k, X.unpack_sorted(x["a"]), x["m"]))
            a, _, many = _owners(np.concatenate([x[1] for x in got]), np.repeat(np.arange(len(got)), [len(x[1]) for x in got]), np.concatenate([x[2] for x in got]))
            a = a[many]
            for k, own, _ in got:
                own = own[_member(a, own)]
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([X.pack(a=X.pack_sorted(own))], pa.binary())], names=["bk", "blob"])

    asked = dealt.mapInArrow(ask, "part int, bk int, blob binary").repartitionById(parts, F.col("part"))
    shared = asked.mapInArrow(share, "bk int, blob binary").repartitionById(buckets, F.col("bk"))

    def send(key, rows, told):  # distinct runs with a shared anchor, and their smallest key in the bucket
        if not told.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), "bk": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
        known = np.sort(np.concatenate([X.unpack_sorted(X.unpack(x.as_buffer())["a"]) for x in told.column("blob")]))
        out: list[list] = [[], [], []]
        texts, base = [], 0
        for keys, _, _, sym, _, _, _, (t, s, m, p, a) in scan(rows.column("_key"), rows.column("_text")):
            use = _member(known, anchor_name(a))
            t, s, m, p, a = t[use], s[use], m[use], p[use], a[use]
            e = s + m + size - 1
            texts.append((run_hash(sym, s, e, a, p), a, keys[t], s + base, e + base, m, p - s, sym))
            base += len(sym)
        h, a, kk, s, e, m, place, sym = (np.concatenate([x[i] for x in texts]) for i in range(8))
        order = np.lexsort((kk, h))
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        same = np.flatnonzero(~new)
        _equal_runs(sym, s, e - s, order[same], order[same - 1])
        pick = order[new]
        p = part_of(X.mix(a[pick]), parts)
        pick = pick[np.argsort(p, kind="stable")]
        cut = np.searchsorted(np.sort(p), np.arange(parts + 1))
        for i in range(parts):
            own = pick[cut[i] : cut[i + 1]]
            if not len(own):
                continue
            own = own[np.argsort(a[own], kind="stable")]
            body = np.concatenate([sym[i:j] for i, j in zip(s[own].tolist(), e[own].tolist(), strict=True)])
            words = {"sym": body}
            if by_words:
                u, at = np.unique(body, return_inverse=True)
                words = {"u": X.pack_sorted(u), "at": at.astype(np.uint32)}
            out[0].append(i)
            out[1].append(rows.column("bk")[0].as_py())
            out[2].append(X.pack(LEVEL, k=kk[own], m=m[own].astype(np.uint8), o=place[own].astype(np.uint8), **words))
        del texts, sym
        X.release()
        return pa.table({"part": pa.array(out[0], pa.int32()), "bk": pa.array(out[1], pa.int32()), "blob": pa.array(out[2], pa.binary())})

    sent = dealt.groupBy("bk").cogroup(shared.groupBy("bk")).applyInArrow(send, "part int, bk int, blob binary").repartitionById(parts, F.col("part"))

    def decide(batches):  # by run the windows that a smaller document holds, and those that a later copy repeats
        by: dict[int, list] = {}
        for b in batches:
            for p, k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                by.setdefault(p, []).append((k, blob))
        for rows in by.values():
            got = [X.unpack(blob.as_buffer()) for _, blob in rows]
            k = np.concatenate([x["k"] for x in got])
            m, o = (np.concatenate([x[c] for x in got]).astype(np.int64) for c in "mo")
            body = [X.unpack_sorted(x["u"])[x["at"]] if by_words else x["sym"] for x in got]
            sym = np.concatenate(body)
            length = m + size - 1
            at = np.cumsum(length) - length
            bk = np.repeat(np.arange(len(rows)), [len(x["k"]) for x in got])
            h, a = np.empty((2, len(k)), np.uint64)
            for i in range(0, len(k), 20_000):  # anchors and hashes travel as the symbols that they are made of
                x, n, p = at[i : i + 20_000], length[i : i + 20_000], o[i : i + 20_000]
                own = sym[x[0] : x[-1] + n[-1]]
                x = x - x[0]
                a[i : i + 20_000] = gram_hash(own, q, x + p)
                h[i : i + 20_000] = run_hash(own, x, x + n, a[i : i + 20_000], x + p)
            uh, one, kind = np.unique(h, return_index=True, return_inverse=True)
            copies = np.flatnonzero(one[kind] != np.arange(len(h)))
            _equal_runs(sym, at, length, copies, one[kind[copies]])
            least = np.full(len(uh), LAST)
            np.minimum.at(least, kind, k)
            # the different runs, each for its smallest key; equal windows have equal anchors, so whole anchors go together
            kinds = np.argsort(a[one], kind="stable")
            before, again = np.zeros(len(uh), np.uint64), np.zeros(len(uh), np.uint64)
            total = np.cumsum(length[one[kinds]])
            edge = np.append(np.flatnonzero(np.concatenate([[True], np.diff(a[one[kinds]].view(np.int64)) != 0])), len(kinds))
            lo = 0
            while lo < len(kinds):  # SLICE symbols at a time
                most = np.searchsorted(total, (total[lo - 1] if lo else 0) + SLICE, "right")
                hi = int(edge[max(np.searchsorted(edge, most, "right") - 1, 0)])
                hi = hi if hi > lo else int(edge[np.searchsorted(edge, lo, "right")])
                own = kinds[lo:hi]
                before[own], again[own] = _masks(sym, at[one[own]], m[one[own]], a[one[own]], o[one[own]], least[own], size, solve)
                lo = hi
            mask = np.where(k == least[kind], before[kind], again[kind] | before[kind])
            later = again[kind]
            for i, (b, _) in enumerate(rows):
                own = np.flatnonzero(bk == i)
                own = own[np.argsort(h[own])]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([X.pack(h=X.pack_sorted(h[own]), k=k[own], x=mask[own], y=later[own])], pa.binary())], names=["bk", "blob"])
            del got, body, sym, h, a, k, m, o, kind, uh, mask, later, before, again
            X.release()

    decided = sent.mapInArrow(decide, "bk int, blob binary").repartitionById(buckets, F.col("bk"))

    def close(key, rows, told):
        got = [X.unpack(x.as_buffer()) for x in told.column("blob")] if told.num_rows else []
        h = np.concatenate([X.unpack_sorted(x["h"]) for x in got]) if got else np.zeros(0, np.uint64)
        least = np.concatenate([x["k"] for x in got]) if got else np.zeros(0, np.int64)
        mask, later = (np.concatenate([x[c] for x in got]) if got else np.zeros(0, np.uint64) for c in "xy")
        order = np.argsort(h)
        h, least, mask, later = h[order], least[order], mask[order], later[order]
        out, at = [], 0
        for keys, data, offs, sym, first, starts, ends, (t, s, m, p, a) in scan(rows.column("_key"), rows.column("_text")):
            removed = np.zeros(len(sym), bool)
            if len(h) and len(s):
                r = run_hash(sym, s, s + m + size - 1, a, p)
                i = np.minimum(np.searchsorted(h, r), len(h) - 1)
                known = h[i] == r
                bits = np.where(known, np.where(least[i] < keys[t], mask[i] | later[i], mask[i]), np.uint64(0))
                use = np.flatnonzero(bits)
                run, off = np.nonzero(np.unpackbits(bits[use].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                removed[s[use[run]] + off] = True
                reach = 1
                while reach < size:  # every window's symbols
                    step = min(reach, size - reach)
                    removed[step:] |= removed[:-step].copy()
                    reach += step
            n = len(keys)
            out.append(finish(rows.column("_key").slice(at, n), data, offs, first, starts, ends, removed))
            at += n
        return pa.concat_tables(out)

    return dealt.groupBy("bk").cogroup(decided.groupBy("bk")).applyInArrow(close, schema)


def _masks(sym: np.ndarray, at: np.ndarray, m: np.ndarray, anchor: np.ndarray, place: np.ndarray, least: np.ndarray, size: int, solve: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the windows of some runs that a smaller document among them holds, and that a later copy of the run repeats."""
    span = m + size - 1
    s0, w0 = np.cumsum(span) - span, np.cumsum(m) - m
    own = sym[np.repeat(at - s0, span) + np.arange(span.sum())]
    off = np.arange(m.sum()) - np.repeat(w0, m)
    if sym.dtype == np.uint8:
        suffixes = AnchoredSuffixes(own, s0, m, anchor, place, size)
    else:
        suffixes = Suffixes(own, np.repeat(s0 + span, span), np.repeat(s0, m) + off)
    got = solve(suffixes, np.repeat(least, m), size)
    bit = np.uint64(1) << off.astype(np.uint64)
    return tuple(np.bitwise_or.reduceat(np.where(hit, bit, np.uint64(0)), w0) for hit in got)


def _owners(a: np.ndarray, w: np.ndarray, many: np.ndarray):
    """Distinct anchors with one document that has each, and whether different ones do."""
    order = np.argsort(a)
    a, w, many = a[order], w[order], many[order]
    at = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    if not len(at):
        return a, w, many
    least = np.minimum.reduceat(w, at)
    return a[at], least, np.logical_or.reduceat(many, at) | (np.maximum.reduceat(w, at) != least)


def _member(known: np.ndarray, a: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(a), bool)
    return known[np.minimum(np.searchsorted(known, a), len(known) - 1)] == a


def drop_repeated_words(docs: DataFrame, size: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_removed, kept): words without those in a ``size``-word window that starts in a smaller key's text, too.

    Kept words are joined by one space.  Null and empty texts have no words;
    rows with equal keys do not remove from each other; a null key counts as
    the largest; an empty table gives none; other columns are ignored.  Keys
    are whole numbers.
    """

    def finish(keys, data, offs, first, starts, ends, removed):
        raw, kept = data.tobytes(), []
        lost = X.sums(removed.astype(np.int64), first)
        for d in range(len(offs) - 1):
            own = np.arange(first[d], first[d + 1])
            if lost[d]:
                own = own[~removed[own]]
            kept.append(b" ".join(raw[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)))
        return pa.table({key: keys.cast(pa.int64()), "n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(lost, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return mark_repeats(docs, True, size, min(10, size), solve_by_trees, finish, f"{key} bigint, n_words bigint, n_removed bigint, kept binary", text, key)


def drop_repeated_bytes(docs: DataFrame, size: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): UTF-8 bytes without those in a ``size``-byte string that starts in a smaller key's text, too.

    Null and empty texts have no bytes; rows with equal keys do not remove from
    each other; a null key counts as the largest; an empty table gives none;
    other columns are ignored.  Keys are whole numbers.
    """

    def finish(keys, data, offs, first, starts, ends, removed):
        edge = removed.copy()
        edge[1:] &= ~removed[:-1]
        full = np.diff(offs) > 0
        edge[offs[:-1][full]] = removed[offs[:-1][full]]
        count = lambda x: np.diff(np.searchsorted(np.flatnonzero(x), offs))
        lost = count(removed)
        ends = np.cumsum(np.diff(offs) - lost, dtype=np.int64)
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lost), [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(data[~removed])]).cast(pa.binary())
        return pa.table({key: keys.cast(pa.int64()), "n_bytes": pa.array(np.diff(offs), pa.int64()), "n_removed": pa.array(lost, pa.int64()), "n_spans": pa.array(count(edge), pa.int64()), "kept": kept})

    return mark_repeats(docs, False, size, min(16, size), solve_by_lpf, finish, f"{key} bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", text, key)


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op7_suffix_trees(spark, sf_dir: str) -> DataFrame:
    return _hashed(drop_repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


def op8_previous_factors(spark, sf_dir: str) -> DataFrame:
    return _hashed(drop_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
