"""Jaccard join on word n-grams with signature trees.

1. Equal sets collapse to one node.  Every node's prefix (the rarest n-grams,
   in one global order) goes to the part of each n-gram; nodes that share one
   form a cell.  Linked nodes always meet in some cell.  N-grams whose words
   are all frequent come last in the order, so common passages make no cells.
   Large cells are cut into overlapping ranges of sizes that hold every link.
2. In a cell the nodes' bitmaps stand in a signature tree: inner nodes hold
   OR-combined bitmaps and size ranges, and a dual traversal drops node pairs
   whose largest possible overlap is too small.  What is left joins nodes into
   clusters, which are few and small.
3. The nodes of a cluster meet once, with their whole sets.  The same trees
   give pairs, pairs of different components are verified exactly, and a link
   merges components; so a group of copies costs about one check a member.
   Large clusters are cut into chunks that share a pivot, and only nodes
   outside the main component then meet the other chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm import _text as X
from docweave.llm._spark import bit_set, components, drop, hub_join, in_bit_set, join_roots, parts_of, saved, small_batches
from docweave.llm.katz import frequent_counts, unigrams

WIDE = 2000  # larger cells are cut by the sizes of their sets
CELL = 20_000  # what is larger even then becomes one cluster without a look inside
CHUNK = 1500  # nodes of a cluster that meet in one task
MEMBERS = 2_000_000  # about the members of their sets, unless one set has more
FAN = 16
BLOOM = 1 << 24  # bits


def gram_sets(data: np.ndarray, offs: np.ndarray, k: int):
    """Distinct word k-grams by text as (text, hash, word index), in the order of text and hash."""
    h, _, _, first = X.words(data, offs)
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[:-1][doc]
    g = np.zeros(len(h), np.uint64)
    full = X.grams(h, k)
    g[: len(full)] = full
    for d in np.flatnonzero((n > 0) & (n < k)).tolist():
        g[first[d]] = X.grams(h[first[d] : first[d + 1]], int(n[d]))[0] ^ np.uint64(n[d])
    g = g[at]
    order = np.lexsort((g, doc))
    doc, g, at = doc[order], g[order], at[order]
    new = np.ones(len(g), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])
    return doc[new], g[new], at[new], h, first


def bitmap_words(n: np.ndarray) -> np.ndarray:
    """64-bit words of a set's bitmap: a power of two with at least a bit a member, 2 at least."""
    return np.maximum(2, 1 << np.ceil(np.log2(np.maximum(n, 1) / 64.0)).clip(0).astype(np.int64))


def bitmap(g: np.ndarray, words: int) -> np.ndarray:
    b = np.zeros(words, np.uint64)
    bit = (g >> np.uint64(20)) % np.uint64(words * 64)
    np.bitwise_or.at(b, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return b


def need(n, num: int, den: int):
    """Smallest overlap of a set of n members with any linked set."""
    return (n * num + den - 1) // den


def _pop(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(-1, dtype=np.int64)


class SignatureTree:
    """Levels of (OR-combined bitmaps, smallest size, largest size, largest number of members that share a bit)."""

    def __init__(self, bits: np.ndarray, n: np.ndarray):
        self.order = np.lexsort((bits[:, 0], n))
        bits, n = bits[self.order], n[self.order]
        spare = n - _pop(bits)
        self.levels = [(bits, n, n, spare)]
        while len(self.levels[-1][1]) > FAN:
            b, lo, hi, s = self.levels[-1]
            at = np.arange(0, len(lo), FAN)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(s, at)))


def _may_link(a, b, i, j, num: int, den: int) -> np.ndarray:
    """Whether node pairs can hold a linked pair: sizes and the largest possible overlap."""
    lo_a, hi_a, lo_b, hi_b = a[1][i], a[2][i], b[1][j], b[2][j]
    ok = (hi_b * den >= lo_a * num) & (hi_a * den >= lo_b * num)
    i, j = i[ok], j[ok]
    if len(i):
        most = np.empty(len(i), np.int64)
        step = max(1, 2_000_000 // a[0].shape[1])
        for k in range(0, len(i), step):
            most[k : k + step] = _pop(a[0][i[k : k + step]] & b[0][j[k : k + step]])
        most += np.minimum(a[3][i], b[3][j])
        ok[ok] = most * (num + den) >= num * (a[1][i] + b[1][j])
    return ok


def dual_traversal(a: SignatureTree, b: SignatureTree, num: int, den: int):
    """Blocks of leaf pairs (as given to the trees) that the bitmaps cannot rule out; a tree with itself gives i < j."""
    same = a is b
    top = max(len(a.levels), len(b.levels)) - 1
    la, lb = min(top, len(a.levels) - 1), min(top, len(b.levels) - 1)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.levels[la][1])), np.arange(len(b.levels[lb][1])), indexing="ij"))
    if same:
        i, j = i[i <= j], j[i <= j]
    stack = [(la, lb, i, j)]
    while stack:
        la, lb, i, j = stack.pop()
        ok = _may_link(a.levels[la], b.levels[lb], i, j, num, den)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if la == 0 and lb == 0:
            if same:
                i, j = i[i != j], j[i != j]
            yield a.order[i], b.order[j]
            continue
        if la >= lb and la > 0:
            i, j = _children(i, j, len(a.levels[la - 1][1]))
            la -= 1
            if same and lb > la:
                j, i = _children(j, i, len(b.levels[lb - 1][1]))
                lb -= 1
        else:
            j, i = _children(j, i, len(b.levels[lb - 1][1]))
            lb -= 1
        if same and la == lb:
            i, j = i[i <= j], j[i <= j]
        step = 100_000 if la == 0 and lb == 0 else 1024  # inner pairs have up to FAN * FAN children each
        for k in range(0, len(i), step):
            stack.append((la, lb, i[k : k + step], j[k : k + step]))


def _children(i: np.ndarray, j: np.ndarray, n: int):
    c = (i[:, None] * FAN + np.arange(FAN)[None]).ravel()
    j = np.repeat(j, FAN)
    return c[c < n], j[c < n]


def candidate_pairs(bits: list[np.ndarray], n: np.ndarray, num: int, den: int):
    """Blocks of pairs of sets that may link; bitmaps of neighbouring lengths are compared folded."""
    size = np.array([len(b) for b in bits])
    for s in np.unique(size).tolist():
        own = np.flatnonzero(size == s)
        a = SignatureTree(np.stack([bits[i] for i in own]), n[own])
        for i, j in dual_traversal(a, a, num, den):
            yield own[i], own[j]
        wide = np.flatnonzero(size == 2 * s)
        if len(wide):
            b = SignatureTree(np.stack([bits[i][:s] | bits[i][s:] for i in wide]), n[wide])
            for i, j in dual_traversal(a, b, num, den):
                yield own[i], wide[j]


def small_cells(cell: np.ndarray, n: np.ndarray, bits: np.ndarray, at: np.ndarray, num: int, den: int):
    """``candidate_pairs`` for many cells of at most FAN sets, whose trees are single leaves, all at once.

    ``cell`` is sorted; ``bits`` holds the bitmaps one after the other, from ``at`` on.
    """
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(start, append=len(cell))
    words = np.diff(at)
    ii, jj = [], []
    for m in np.unique(size[size > 1]).tolist():
        x, y = np.triu_indices(m, 1)
        s = start[size == m]
        ii.append((s[:, None] + x[None]).ravel())
        jj.append((s[:, None] + y[None]).ravel())
    if not ii:
        return
    i, j = np.concatenate(ii), np.concatenate(jj)
    swap = words[i] > words[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    ok = (n[j] * den >= n[i] * num) & (n[i] * den >= n[j] * num)
    i, j = i[ok], j[ok]
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
    for w in np.unique(words[i]).tolist():
        for wide in (w, 2 * w):
            use = np.flatnonzero((words[i] == w) & (words[j] == wide))
            step = max(1, 1_000_000 // w)
            for k in range(0, len(use), step):
                x, y = i[use[k : k + step]], j[use[k : k + step]]
                span = np.arange(w)[None]
                a, b = bits[at[x][:, None] + span], bits[at[y][:, None] + span]
                if wide > w:
                    b = b | bits[at[y][:, None] + span + w]
                    own = _pop(b)
                else:
                    own = ones[at[y] + w] - ones[at[y]]
                most = _pop(a & b) + np.minimum(n[x] - (ones[at[x] + w] - ones[at[x]]), n[y] - own)
                hit = most * (num + den) >= num * (n[x] + n[y])
                yield x[hit], y[hit]


def size_ranges(n: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Ranges of ascending sizes, two neighbouring steps each, so that any two sizes that can link share one.

    Sizes of one step, and those of linked sets, differ at most by the factor
    den / num; a little more keeps rounding from parting two that can link.
    """
    step = np.floor(np.log(n) / max(np.log(den / num) * (1 + 1e-6), 1e-9)).astype(np.int64)
    cut = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(n)).tolist()
    out, upto = [], 0
    for lo, mid, hi in zip(cut, cut[1:], [*cut[2:], len(n)], strict=False):
        end = hi if mid < len(n) and step[mid] == step[lo] + 1 else mid
        if end > upto:  # else the range before holds it
            out.append((lo, end))
            upto = end
    return out


def _cells(batches, key: str, rows: int = 1):
    """Tables of whole cells (rows with an equal key) of about ``rows`` rows or more; input comes sorted by the key."""
    held: list = []
    count = 0
    for b in batches:
        k = b.column(b.schema.get_field_index(key)).to_numpy()
        if not len(k):
            continue
        cut = np.flatnonzero(np.concatenate([[not held or last != k[0]], k[1:] != k[:-1]]))
        at = 0
        for z in cut.tolist():
            if count + z - at >= rows:
                if z > at:
                    held.append(b.slice(at, z - at))
                if held:
                    yield pa.Table.from_batches(held)
                held, count, at = [], 0, z
        if at < len(k):
            held.append(b.slice(at))
            count += len(k) - at
        last = k[-1]
    if held:
        yield pa.Table.from_batches(held)


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, n_shingles, component_id; rows link at Jaccard >= num/den.

    A text's set holds its distinct k-word shingles in lower case, or all words
    of a shorter text as one.  Null and empty texts have an empty set and link
    with nothing; component_id is the smallest key reachable, the own key
    included.  Repeated rows and equal texts link with each other (similarity
    1); null keys link too but name a component only if it has no other.  An
    empty table gives none.  Other columns are ignored, whatever their names.
    Keys are whole numbers; thresholds below 1/2 are refused.
    """
    if 2 * num < den or num > den:
        raise ValueError("the threshold has to lie between 1/2 and 1")  # bitmaps of sizes s and 2s are compared
    spark = docs.sparkSession
    small_batches(spark)
    parts = parts_of(spark)
    src = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    counts = saved(unigrams(src.withColumn("_train", F.lit(True)), max(2, parts // 2)))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    often, seen = frequent_counts(counts, max(100, total // 65536))  # at most 65536 words, or a hundredth of a small corpus
    rank, fine = np.log2(np.maximum(seen, 1)).astype(np.int64) + 1, np.rint(8 * np.log2(np.maximum(seen, 1))).astype(np.int64)

    def sets_of(data, offs):
        doc, g, at, h, first = gram_sets(data, offs, k)
        n = np.bincount(doc, minlength=len(offs) - 1)
        cut = np.concatenate([[0], np.cumsum(n)])
        digest = X.sums(X.mix(g), cut) ^ n.astype(np.uint64)
        return doc, g, at, h, first, n, cut, digest

    def describe(batches):  # one row for each text, and its prefix packed
        for b in batches:
            data, offs = X.column_bytes(b.column(1))
            for i, j in X.chunks(offs):
                doc, g, at, h, first, n, cut, digest = sets_of(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                r = f = np.zeros(len(h), np.int64)
                if len(often):
                    p = np.minimum(np.searchsorted(often, h), len(often) - 1)
                    known = often[p] == h
                    r, f = np.where(known, rank[p], 0), np.where(known, fine[p], 0)
                # the count of the rarest word bounds that of an n-gram; below it, words that are all rare rarely meet by chance
                weight, chance = r[at], f[at]
                size = np.diff(first)[doc]
                for s in range(1, k):
                    use = s < size
                    weight[use] = np.minimum(weight[use], r[at[use] + s])
                    chance[use] += f[at[use] + s]
                order = np.lexsort((g, chance, weight, doc))
                inside = np.arange(len(g)) - np.repeat(cut[:-1], n)
                prefix = inside < (n - need(n, num, den) + 1)[doc]
                sig, pre = [], []
                words = bitmap_words(n)
                for d in range(j - i):
                    own = g[cut[d] : cut[d + 1]]
                    sig.append(bitmap(own, int(words[d])).tobytes() if len(own) else b"")
                    pre.append(g[order[cut[d] : cut[d + 1]][prefix[cut[d] : cut[d + 1]]]].astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(digest.astype(np.int64), pa.int64()), pa.array(sig, pa.binary()), pa.array(pre, pa.list_(pa.int64()))], names=["_key", "n", "node", "sig", "prefix"])

    # one row per distinct set; the key is any key of the set, to find its text again
    texts = saved(src.mapInArrow(describe, "_key bigint, n bigint, node bigint, sig binary, prefix array<bigint>"))
    plain = texts.select("_key", "n", "node")
    nodes = saved(texts.where("n > 0").groupBy("node").agg(F.min_by(F.struct("_key", "n", "sig", "prefix"), F.xxhash64("_key")).alias("x")).select("node", "x.*"))

    def meet(batches):  # cells: the nodes that share a prefix member, named by who they are
        got = [[b.column(i).to_numpy() for i in range(3)] for b in batches]
        if not got:
            return
        g, d, n = (np.concatenate([x[i] for x in got]) for i in range(3))
        order = np.lexsort((d, n, g))
        g, d, n = g[order], d[order], n[order]
        new = np.ones(len(g), bool)
        # a gap in the sizes that no link can span ends a cell, too
        new[1:] = (g[1:] != g[:-1]) | (n[:-1].astype(np.int64) * den < n[1:].astype(np.int64) * num)
        at = np.flatnonzero(new)
        size = np.diff(at, append=len(g))
        large = np.flatnonzero(size > WIDE)
        if len(large):
            few = np.flatnonzero(size <= WIDE)
            cut = [(a + lo, hi - lo) for a, m in zip(at[large].tolist(), size[large].tolist(), strict=True) for lo, hi in size_ranges(n[a : a + m], num, den)]
            at, size = (np.append(x[few], np.array([c[i] for c in cut], np.int64)) for i, x in enumerate((at, size)))
        who = np.concatenate([np.zeros(1, np.uint64), np.cumsum(X.mix(d.astype(np.uint64)))])
        who = who[at + size] - who[at]
        keep = size > 1
        _, one = np.unique(who[keep], return_index=True)
        pick = np.flatnonzero(keep)[one]
        for lo in range(0, len(pick), 20_000):
            p = pick[lo : lo + 20_000]
            m = size[p]
            at_ = np.repeat(at[p], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(who[p].astype(np.int64), m)), pa.array(d[at_]), pa.array(np.repeat(m, m)), pa.array(np.repeat(d[at[p]], m))], names=["cell", "node", "m", "hub"])

    # (member, node) pairs of 16 bytes; a member shared by very many nodes still is a light group
    dealt = nodes.select(F.explode("prefix").alias("g"), "node", F.col("n").cast("int").alias("n")).repartition(parts, "g")
    cells = saved(dealt.mapInArrow(meet, "cell bigint, node bigint, m bigint, hub bigint").distinct())
    stars = cells.where(F.col("m") > CELL).select(F.col("node").alias("a"), F.col("hub").alias("b"))

    def cluster(batches):
        for t in _cells(batches, "cell", 4000):
            cell, node, n = t.column("cell").to_numpy(), t.column("node").to_numpy(), t.column("n").to_numpy()
            bits = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("sig")]
            start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            size = np.diff(start, append=len(cell))
            few = np.repeat(size <= FAN, size)
            found = []
            if few.any():
                own = np.flatnonzero(few)
                at = np.concatenate([[0], np.cumsum([len(bits[i]) for i in own])])
                found += [(own[i], own[j]) for i, j in small_cells(cell[own], n[own], np.concatenate([bits[i] for i in own]), at, num, den)]
            for s, m in zip(start[size > FAN].tolist(), size[size > FAN].tolist(), strict=True):
                label = np.arange(m)
                for i, j in candidate_pairs(bits[s : s + m], n[s : s + m], num, den):
                    label = join_roots(label, i, j)
                away = np.flatnonzero(label != np.arange(m))
                found.append((s + away, s + label[away]))
            for i, j in found:
                yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["a", "b"])

    small = cells.where(F.col("m") <= CELL).join(nodes.select("node", "n", "sig"), "node").select("cell", "node", "n", "sig")
    near = small.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(cluster, "a bigint, b bigint")
    clusters = components(near.union(stars)).select("node", F.col("component").alias("cluster"))
    member = saved(clusters.join(nodes.select("node", "_key", "n"), "node").select("node", F.xxhash64("_key").alias("_h"), "cluster", "n"))
    # the number of chunks follows the nodes and the members of their sets
    split = lambda m, n: F.ceil(F.greatest(m / CHUNK, n / MEMBERS))
    sizes = member.groupBy("cluster").agg(split(F.count(F.lit(1)), F.sum("n")).alias("chunks"), F.min_by("node", F.xxhash64("node")).alias("pivot"))
    whole_member = saved(hub_join(member, sizes, "cluster"))
    drop(cells, nodes, member)
    member = whole_member

    def sets(of: DataFrame) -> DataFrame:
        """Whole sets of the nodes of ``of``.

        A bitmap of BLOOM bits, the same at any size, tells most other texts
        apart before the join; whom it lets pass wrongly the join drops.
        """
        bloom = bit_set(of, F.col("node").bitwiseXOR(F.col("_h")), BLOOM)
        shared = spark.sparkContext.broadcast(bloom)

        def whole(batches):
            for b in batches:
                data, offs = X.column_bytes(b.column(1))
                for i, j in X.chunks(offs):
                    _, g, _, _, _, n, cut, digest = sets_of(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                    digest, h = digest.astype(np.int64), b.column(0).slice(i, j - i).to_numpy()
                    pick = np.flatnonzero((n > 0) & in_bit_set(shared.value, digest ^ h))
                    for lo in range(0, len(pick), 500):
                        p = pick[lo : lo + 500]
                        own = [X.pack(g=X.pack_sorted(g[cut[d] : cut[d + 1]])) for d in p]
                        yield pa.RecordBatch.from_arrays([pa.array(digest[p]), pa.array(h[p]), pa.array(own, pa.binary())], names=["node", "_h", "members"])

        found = src.select(F.xxhash64("_key").alias("_h"), "_text").mapInArrow(whole, "node bigint, _h bigint, members binary")
        return found.join(of, ["node", "_h"]).drop("_h")

    def link(batches):
        for t in _cells(batches, "cell"):
            _, once = np.unique(t.column("node").to_numpy(), return_index=True)  # repeated rows
            t = t.take(once)
            if len(once) < 2:
                continue
            node, side = t.column("node").to_numpy(), t.column("side").to_numpy()
            own = [X.unpack_sorted(X.unpack(x.as_buffer())["g"]) for x in t.column("members")]
            n = np.array([len(x) for x in own])
            start = t.column("comp").to_numpy()
            _, label = np.unique(start, return_inverse=True)
            # roots as indices of nodes
            at = np.full(label.max() + 1, len(node))
            np.minimum.at(at, label, np.arange(len(node)))
            label = at[label]
            bits = [bitmap(x, int(w)) for x, w in zip(own, bitmap_words(n), strict=True)]
            a, b = [], []

            def root(x, label=label):
                while label[x] != x:
                    label[x] = label[label[x]]
                    x = label[x]
                return x

            for i, j in candidate_pairs(bits, n, num, den):
                cross = (side[i] != side[j]) | (side[i] == 0)
                for x, y in zip(i[cross].tolist(), j[cross].tolist(), strict=True):
                    rx, ry = root(x), root(y)
                    if rx == ry:
                        continue
                    both = np.concatenate([own[x], own[y]])
                    both.sort()
                    same = int((both[1:] == both[:-1]).sum())
                    if same * den >= num * (n[x] + n[y] - same):
                        label[max(rx, ry)] = min(rx, ry)
                        a.append(node[x])
                        b.append(node[y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            if len(once) > CHUNK // 4:
                t = own = bits = None
                X.release()

    def links_of(rows: DataFrame) -> DataFrame:  # side 0: all pairs; sides 1 and 2: pairs across
        return rows.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(link, "a bigint, b bigint")

    chunks = F.col("chunks")
    chunk = F.pmod(F.xxhash64("node", F.lit(7)), chunks)
    cell = lambda *c: F.xxhash64(*c)
    common = ["node", "members"]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    # a pivot goes to all chunks of its cluster, any other node to its own
    where = F.when((F.col("node") == F.col("pivot")) & (chunks > 1), F.sequence(F.lit(0).cast("long"), chunks - 1)).otherwise(F.array(chunk))
    first = sets(member).select(*common, "cluster", F.explode(where).alias("_c")).select(*common, cell("cluster", "_c").alias("cell"), F.col("node").alias("comp"), F.lit(0).alias("side"))
    found = saved(links_of(first))
    wide = member.where(chunks > 1)
    if wide.limit(1).count():
        comp = components(found)
        known = wide.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        known = saved(known)
        by = known.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
        top = F.struct("c", "comp", "s")
        main = by.groupBy("cluster").agg(F.max(top).alias("t"), F.sum("c").alias("c"), F.sum("s").alias("s"))
        main = main.where("c > t.c").select("cluster", F.col("t.comp").alias("main"), split(F.col("c") - F.col("t.c"), F.col("s") - F.col("t.s")).alias("rest_chunks"))
        left = saved(hub_join(known, main, "cluster").where("main is not null"))
        full = sets(left.select("node", "_h")).select("node", "members")
        known = full.join(left, "node")
        rest_chunks = F.col("rest_chunks")
        rest_chunk = F.pmod(F.xxhash64("node", F.lit(9)), rest_chunks)
        inside = known.where("comp = main").withColumn("_j", every(rest_chunks)).select(*common, cell("cluster", chunk, "_j", F.lit(1)).alias("cell"), "comp", F.lit(1).alias("side"))
        outside = known.where("comp <> main").withColumn("_i", every(chunks)).select(*common, cell("cluster", "_i", rest_chunk, F.lit(1)).alias("cell"), "comp", F.lit(2).alias("side"))
        pairs = known.where("comp <> main").withColumn("_o", rest_chunk).withColumn("_j", every(rest_chunks))
        among = pairs.select(*common, cell("cluster", F.least("_o", "_j"), F.greatest("_o", "_j"), F.lit(2)).alias("cell"), "comp", F.lit(0).alias("side"))
        found = saved(found.union(links_of(inside.union(outside).union(among))))
    comp = components(found)
    # names by node first: one row for every set that others link to
    least = plain.where("n > 0").groupBy("node").agg(F.min("_key").alias("_least"))
    named = saved(least.join(comp, "node", "left").select("node", F.coalesce("component", "node").alias("_c"), "_least"))
    names = named.where("_least is not null").groupBy("_c").agg(F.min("_least").alias("_name"))
    named = saved(hub_join(named, names, "_c").select("node", "_name"))
    out = hub_join(plain, named, "node")
    return out.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("_name", "_key")).otherwise(F.col("_key")).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows whose key names their component: one document of every group stays, with its columns.

    Rows with an empty set or a null key stay; rows with equal keys stay or go together.
    """
    comp = jaccard_components(docs, key=key, **options).where(F.col(key).isNotNull())
    lost = comp.groupBy(F.col(key).alias("_lost")).agg(F.max((F.col(key) == F.col("component_id")).cast("int")).alias("stays")).where("stays = 0")
    return docs.join(lost.select("_lost"), docs[key] == F.col("_lost"), "left_anti")


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, k=3, num=90, den=100)
