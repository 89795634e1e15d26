"""Secret scanning: fixed patterns plus a linear-chain conditional random field.

Tokens are tagged begin, inside or outside of a secret from their shape, their
neighbours and features of the whole file, and decoded by Viterbi.  It learns
from real texts: where patterns hit, and where secrets of other forms (bare and
prefixed keys, credentials in URLs, values behind words without a sign, dotted
tokens) and harmless look-alikes are written into them.  A token
whose outside score leads by more than all transitions can make up is outside
on every best path, so only the rest is decoded; this prunes without changing
the result.  There is no shuffle.
"""

from __future__ import annotations

import heapq
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm import _text as X
from docweave.llm._spark import drop, saved, small_batches

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
_HEX16 = np.zeros(256, bool)
_HEX16[0x30:0x3A] = _HEX16[0x61:0x67] = True
_TOKEN = np.zeros(256, bool)
for _c in b"+/_-":
    _TOKEN[_c] = True
_TOKEN |= X.ALNUM
O, B, I = 0, 1, 2  # noqa: E741
#: Tokens that often name what follows; a fixed list.
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey", "key", "auth", "bearer", "credential", "private", "access", "pwd")
_NAMES = np.sort(X.words(*X.column_bytes(pa.array(NAMES)), _TOKEN)[0])
SLOTS, WIDTH = 17, 16
HIDDEN = 0.15  # share of the features hidden in training
_LETTERS, _KEY = string.ascii_lowercase, string.ascii_letters + string.digits


def _word(r: random.Random) -> str:
    return "".join(r.choice(_LETTERS) for _ in range(r.randint(3, 9)))


def _key(r: random.Random, least: int, most: int, more: str = "") -> str:
    """Random letters and digits, some of each."""
    while True:
        k = "".join(r.choice(_KEY + more) for _ in range(r.randint(least, most)))
        if any(c.isdigit() for c in k) and any(c.isupper() for c in k) and any(c.islower() for c in k):
            return k


def written_secret(r: random.Random) -> tuple[str, str, str]:
    """A secret that the patterns need not cover, with what stands before and after it."""
    form = r.randrange(7)
    if form == 0:
        return "", _key(r, 20, 40), ""
    if form == 1:
        return "", "".join(r.choice(_LETTERS) for _ in range(r.randint(2, 4))) + r.choice("_-") + _key(r, 20, 36), ""
    if form == 2:
        return r.choice(("password is ", "Bearer ", "my key ", "credential ", "the token is ", "auth ", "pwd ", "secret was ")), _key(r, 12, 24), ""
    if form == 3:
        return f"https://{_word(r)}:", _key(r, 10, 20), f"@{_word(r)}.example.org/{_word(r)}"
    if form == 4:
        return "", ".".join((_key(r, 16, 30), _key(r, 16, 40), _key(r, 20, 40))), ""
    if form == 5:
        return r.choice(("", '"', "key: ")), _key(r, 36, 44, "+/"), ""
    return f'{_word(r)}="', _key(r, 16, 32), '"'


def harmless(r: random.Random) -> str:
    """What may look like a secret and is none."""
    d = lambda n: "".join(r.choice(string.digits) for _ in range(n))
    w = lambda: _word(r)
    return r.choice((
        f"{w()}.{d(2)}@mail{d(1)}.example.com", f"{d(2)}.{d(3)}.{d(2)}.{d(3)}", f"20{d(2)}-0{d(1)}-1{d(1)}", f"v{d(1)}.{d(2)}.{d(1)}", f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"/usr/{w()}/{w()}/{w()}",
        f"{w()}{w().title()}{w().title()}{w().title()}", f"{w()}-{w()}-{w()}-{w()}", f"{w()}_{w()}_{w()}".upper(), f"{d(3)}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"https://www.{w()}.example.org/{w()}/{d(4)}",
        f"{w()}{w()}{w()}{w()}", f"{d(2)},{d(3)}.{d(2)}", f"password is {w()}", f"token {w()}", f"{w()}{d(2)}", f"Bearer {w()}", f"{w()}:{w()}",
    ))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, in code points."""
    found = []
    low = text.lower()
    if "=" in text or ":" in text:
        if any(k in low for k in ("password", "passwd", "secret", "token", "apikey", "api_key")):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def features(data: np.ndarray, offs: np.ndarray):
    """Feature ids by token (len, SLOTS), and the tokens' starts, ends and first token of each text.

    Slot j holds ids j*WIDTH to j*WIDTH + WIDTH - 1.
    """
    h, starts, ends, first = X.words(data, offs, _TOKEN)
    n, doc = len(h), X.owner(first)

    def count(mask: np.ndarray) -> np.ndarray:
        c = np.zeros(len(data) + 1, np.int32)
        np.cumsum(mask, out=c[1:])
        return c

    digit = (data >= 0x30) & (data <= 0x39)
    upper = (data >= 0x41) & (data <= 0x5A)
    lower = (data >= 0x61) & (data <= 0x7A)
    cd, cu, cl = count(digit), count(upper), count(lower)
    cx, chigh = count(_HEX16[data]), count(data >= 0x80)
    kind = digit + 2 * upper + 3 * lower
    turn = np.zeros(len(data), bool)
    turn[1:] = kind[1:] != kind[:-1]
    ct = count(turn)
    quote = count((data == 0x22) | (data == 0x27))
    assign = count((data == 0x3D) | (data == 0x3A))
    at_sign = count(data == 0x40)
    length = ends - starts
    d, u, lo, x, hi = cd[ends] - cd[starts], cu[ends] - cu[starts], cl[ends] - cl[starts], cx[ends] - cx[starts], chigh[ends] - chigh[starts]
    turns = ct[ends] - ct[np.minimum(starts + 1, ends)]
    size = np.searchsorted([4, 8, 12, 16, 20, 24, 32, 40, 41, 64], length, "right")
    share = np.minimum(d * 8 // np.maximum(length, 1), 7)
    mixed = (d > 0) * 1 + (u > 0) * 2 + (lo > 0) * 4 + ((length - d - u - lo) > 0) * 8
    shape = np.where(hi > 0, 0, np.where(length < 12, 1, np.where(d == 0, 2, np.where(x == length, 3, np.where(d == length, 4, 5)))))
    same_b = np.zeros(n, bool)
    same_b[1:] = doc[1:] == doc[:-1]
    same_a = np.zeros(n, bool)
    same_a[:-1] = same_b[1:]
    gap_s = np.zeros(n, np.int64)
    gap_s[1:] = ends[:-1]
    gap_s = np.where(same_b, gap_s, offs[doc] if n else 0)
    gap_e = np.zeros(n, np.int64)
    gap_e[:-1] = starts[1:]
    gap_e = np.where(same_a, gap_e, offs[1:][doc] if n else 0)
    dotted = np.zeros(n, np.int64)  # joined to the token before it by one full stop
    if n > 1:
        dotted[1:] = same_b[1:] & (starts[1:] - ends[:-1] == 1) & (data[ends[:-1].clip(max=len(data) - 1)] == 0x2E)
    named = np.zeros(n, bool)
    if n:
        named = _NAMES[np.minimum(np.searchsorted(_NAMES, h), len(_NAMES) - 1)] == h

    def before(a: np.ndarray, none: int) -> np.ndarray:
        out = np.full(n, none)
        out[1:] = a[:-1]
        return np.where(same_b, out, none)

    def after(a: np.ndarray, none: int) -> np.ndarray:
        out = np.full(n, none)
        out[:-1] = a[1:]
        return np.where(same_a, out, none)

    text_len = np.maximum(offs[1:] - offs[:-1], 1)
    doc_digits = np.minimum((cd[offs[1:]] - cd[offs[:-1]]) * 40 // text_len, 7)
    doc_assign = np.minimum((assign[offs[1:]] - assign[offs[:-1]]) * 200 // text_len, 7)
    doc_size = np.minimum(np.log2(text_len).astype(np.int64) // 2, 15)
    own = [
        np.zeros(n, np.int64), size, share * 2 + (x == length), np.minimum(mixed, 15), shape * 2 + (length >= 16), np.minimum(turns, 15),
        named * 1, before(named * 1, 2), ((assign[starts] - assign[gap_s]) > 0) * 2 + ((quote[starts] - quote[gap_s]) > 0), ((quote[gap_e] - quote[ends]) > 0) * 2 + ((assign[gap_e] - assign[ends]) > 0),
        ((at_sign[gap_e] - at_sign[ends]) > 0) * 2 + ((at_sign[starts] - at_sign[gap_s]) > 0), dotted * 2 + after(dotted, 0), before(size, 11),
        before(shape, 6), after(shape, 6), doc_digits[doc] * 2 + (doc_assign[doc] > 0) if n else np.zeros(0, np.int64), doc_size[doc] if n else np.zeros(0, np.int64),
    ]
    ids = np.empty((n, SLOTS), np.int16)
    for j, a in enumerate(own):
        ids[:, j] = a + j * WIDTH
    return ids, starts, ends, first


def tags(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Begin/inside/outside tags of tokens that lie at least half inside the byte spans."""
    y = np.zeros(len(starts), np.int8)
    for s, e in spans:
        i, j = np.searchsorted(ends, s, "right"), np.searchsorted(starts, e)
        while i < j and 2 * (min(ends[i], e) - max(starts[i], s)) < ends[i] - starts[i]:
            i += 1
        while i < j and 2 * (min(ends[j - 1], e) - max(starts[j - 1], s)) < ends[j - 1] - starts[j - 1]:
            j -= 1
        if j > i:
            y[i:j] = I
            y[i] = B
    return y


def train(ids: np.ndarray, y: np.ndarray, mask: np.ndarray, steps: int = 80, rate: float = 0.15, ridge: float = 1e-3) -> dict:
    """Maximum conditional likelihood by Adam over padded sequences (S, L, SLOTS), (S, L), (S, L)."""
    s, size, _ = ids.shape
    w, t = np.zeros((SLOTS * WIDTH, 3)), np.zeros((3, 3))
    t_ok = np.ones((3, 3))
    t_ok[O, I] = 0
    gold_t = np.zeros((3, 3))
    pair = mask[:, 1:] & mask[:, :-1]
    np.add.at(gold_t, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    live = ids[mask]
    gold = np.zeros_like(w)
    for j in range(SLOTS):
        np.add.at(gold, (live[:, j], y[mask]), 1)
    m = [np.zeros_like(w), np.zeros_like(t)]
    v = [np.zeros_like(w), np.zeros_like(t)]
    count = max(int(mask.sum()), 1)
    for step in range(1, steps + 1):
        u = w[ids].sum(2)
        u[:, 0, I] -= 1e4  # a sequence can't begin inside
        tt = np.where(t_ok > 0, t, -1e4)
        a = np.empty((s, size, 3))
        a[:, 0] = u[:, 0]
        for i in range(1, size):
            z = a[:, i - 1, :, None] + tt[None]
            top = z.max(1)
            a[:, i] = np.where(mask[:, i, None], top + np.log(np.exp(z - top[:, None]).sum(1)) + u[:, i], a[:, i - 1])
        total = np.logaddexp.reduce(a[:, -1], 1)
        b = np.zeros((s, size, 3))
        for i in range(size - 2, -1, -1):
            z = tt[None] + (u[:, i + 1] + b[:, i + 1])[:, None, :]
            top = z.max(2)
            b[:, i] = np.where(mask[:, i + 1, None], top + np.log(np.exp(z - top[..., None]).sum(2)), b[:, i + 1])
        p = np.exp(a + b - total[:, None, None])
        g = [gold.copy(), gold_t.copy()]
        pm = p[mask]
        for k in range(3):
            for j in range(SLOTS):
                g[0][:, k] -= np.bincount(live[:, j], weights=pm[:, k], minlength=len(w))
        z = np.exp(a[:, :-1, :, None] + tt[None, None] + (u + b)[:, 1:, None, :] - total[:, None, None, None])
        g[1] -= (z * pair[..., None, None]).sum((0, 1))
        for k, par in enumerate((w, t)):
            grad = g[k] / count - ridge * par
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.99 * v[k] + 0.01 * grad**2
            par += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
    return {"w": w, "t": np.where(t_ok > 0, t, -1e4)}


def viterbi(u: np.ndarray, t: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Best tags for token scores u (n, 3); ``begins`` marks each text's first token."""
    n = len(u)
    best = np.zeros(n, np.int8)
    if not n:
        return best
    u = u.copy()
    u[begins, I] -= 1e4
    reach = t[t > -1e3].max() - t[t > -1e3].min()
    # made outside, a token may force the next one from inside to begin: three transitions and that token's loss
    loss = np.zeros(n)
    loss[:-1] = np.where(begins[1:], 0, np.maximum(u[1:, I] - u[1:, B], 0))
    sure = u[:, O] - np.maximum(u[:, B], u[:, I]) > 3 * reach + loss + 1e-9
    unsure = ~sure
    open_ = unsure.copy()
    open_[1:] &= sure[:-1] | begins[1:]
    heads = np.flatnonzero(open_)
    if not len(heads):
        return best
    stop = np.flatnonzero(unsure & np.concatenate([sure[1:] | begins[1:], [True]])) + 1
    length = stop - heads
    for size in np.unique(length):
        h = heads[length == size]
        # a sure neighbour is outside, so it adds a fixed transition on either side
        inner = ~begins[h]
        a = u[h] + np.where(inner[:, None], t[O][None], 0)
        back = np.zeros((len(h), size, 3), np.int8)
        for i in range(1, size):
            z = a[:, :, None] + t[None]
            back[:, i] = z.argmax(1)
            a = z.max(1) + u[h + i]
        end = h + size
        follows = (end < n) & ~begins[np.minimum(end, n - 1)]
        a = a + np.where(follows[:, None], t[:, O][None], 0)
        k = a.argmax(1)
        for i in range(size - 1, -1, -1):
            best[h + i] = k
            k = back[np.arange(len(h)), i, k]
    return best


def windows(t: str, spans: list[tuple[int, int, int]], window: int, seed: int, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, tags) around at most ``most`` secrets that the patterns find, written ones and other tokens of a text."""
    r = random.Random(seed)
    at = []
    for s, k, e in spans:
        m = ASSIGN.match(t, s) if k == 0 else None
        at.append((m.start(1) if m else s, e))
    # two secrets and two look-alikes go between words outside the patterns' spans
    gaps = [m.start() for m in re.finditer(r"(?<=\S)\s", t) if not any(s <= m.start() < e for s, _, e in spans)] or [len(t)]
    parts, marks, upto, shift = [], [], 0, 0
    for g, kind in sorted((r.choice(gaps), kind) for kind in (1, 1, 0, 0)):
        before, what, after = written_secret(r) if kind else ("", harmless(r), "")
        piece = f" {before}{what}{after}" if g else f"{before}{what}{after}"
        parts += [t[upto:g], piece]
        s = g + shift + len(piece) - len(after) - len(what)
        marks.append((kind, s, s + len(what)))
        at = [(x + len(piece), y + len(piece)) if x >= g + shift else (x, y) for x, y in at]
        upto, shift = g, shift + len(piece)
    t = "".join([*parts, t[upto:]])
    raw = t.encode()
    ids, starts, ends, _ = features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    n = len(starts)
    if not n:
        return []
    to_bytes = lambda x: len(t[:x].encode())
    y = tags(starts, ends, [(to_bytes(s), to_bytes(e)) for s, e in at + [(s, e) for kind, s, e in marks if kind]])
    found = np.flatnonzero(y == B)
    centres = r.sample(found.tolist(), min(most, len(found)))
    centres += [int(np.searchsorted(ends, to_bytes(s), "right")) for kind, s, _ in marks if not kind][:1] + [r.randrange(n)]
    out = []
    for c in centres:
        i = max(0, min(c - window // 2, n - window))
        out.append((ids[i : i + window], y[i : i + window]))
    return out


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_rows: int = 1000, window: int = 16, most: int = 3) -> dict | None:
    """Train on at most ``most`` + 2 windows of each of at most ``sample_rows`` texts (documented bounds).

    Half of the bound is for texts where a pattern hits, wherever they are in
    the table, half for others; ``windows`` writes more secrets into all of
    them.  A table without a text gives no model.
    """
    half = max(1, sample_rows // 2)
    rows = docs.select(F.col(text).alias("text"), F.xxhash64(F.lit(11), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text)).alias("o"))

    def pick(batches):  # of each kind the texts of the smallest orders, ``half`` in a task
        least: tuple[list, list] = ([], [])
        for b in batches:
            for t, o in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not t or all(len(side) >= half and o >= -side[0][0] for side in least):
                    continue
                side = least[bool(base_spans(t))]
                if len(side) < half:
                    heapq.heappush(side, (-o, t))
                elif o < -side[0][0]:
                    heapq.heapreplace(side, (-o, t))
        for hit, side in enumerate(least):
            for o, t in side:
                yield pa.RecordBatch.from_arrays([pa.array([bool(hit)]), pa.array([-o], pa.int64()), pa.array([t], pa.string())], names=["hit", "o", "t"])

    def cut(batches):
        for b in batches:
            for t, o in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = windows(t, base_spans(t), window, o, most)
                if got:
                    blob = X.pack(n=np.array([len(y) for _, y in got]), ids=np.concatenate([i.ravel() for i, _ in got]), y=np.concatenate([y for _, y in got]))
                    yield pa.RecordBatch.from_arrays([pa.array([o], pa.int64()), pa.array([blob], pa.binary())], names=["o", "b"])

    # few rows leave each task, so the second kind is not worth a second scan
    picked = saved(rows.mapInArrow(pick, "hit boolean, o bigint, t string"))
    got = []
    for hit in (True, False):
        kind = picked.where(F.col("hit") == hit)
        orders = [r["o"] for r in kind.select("o").distinct().orderBy("o").limit(half).collect()]  # numbers, not texts
        if orders:
            few = kind.where(F.col("o") <= orders[-1]).dropDuplicates(["o"]).select("t", "o")
            got += [(r["o"], bytes(r["b"])) for r in few.mapInArrow(cut, "o bigint, b binary").collect()]
    got.sort()
    drop(picked)
    if not got:
        return None
    parts = []
    for _, blob in got:
        x = X.unpack(blob)
        at = np.cumsum(x["n"])[:-1]
        parts += zip(np.split(x["ids"].reshape(-1, SLOTS), at), np.split(x["y"], at), strict=True)
    ids = np.zeros((len(parts), window, SLOTS), np.int16)
    y, mask = np.zeros((len(parts), window), np.int8), np.zeros((len(parts), window), bool)
    for i, (x, t) in enumerate(parts):
        ids[i, : len(t)], y[i, : len(t)], mask[i, : len(t)] = x, t, True
    # some features are hidden (id 1, which no token has), so that no single one decides
    hide = np.random.Generator(np.random.PCG64(5)).random(ids.shape) < HIDDEN
    hide[..., 0] = False
    ids[hide] = 1
    return train(ids, y, mask)


def crf_spans(data: np.ndarray, offs: np.ndarray, model: dict):
    """(text, byte start, byte end) of the decoded secrets of a chunk of texts."""
    ids, starts, ends, first = features(data, offs)
    u = np.zeros((len(ids), 3))
    for j in range(SLOTS):
        u += model["w"][ids[:, j]]
    begins = np.zeros(len(ids), bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    y = viterbi(u, model["t"], begins)
    at = np.flatnonzero(y == B)
    if not len(at):
        return []
    doc = X.owner(first)
    out = []
    for i in at.tolist():
        j = i + 1
        while j < len(y) and y[j] == I and doc[j] == doc[i]:
            j += 1
        out.append((int(doc[i]), int(starts[i]), int(ends[j - 1])))
    return out


def _found(texts: list, data: np.ndarray, offs: np.ndarray, model: dict | None) -> list[list[tuple[int, int, int]]]:
    """For every text the sorted (start, kind, end) of patterns and decoded spans, in code points."""
    rows = []
    for i, j in X.chunks(offs, 500_000):
        extra: dict[int, list] = {}
        if model:
            for d, s, e in crf_spans(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], model):
                extra.setdefault(d, []).append((s, e))
        for d in range(i, j):
            t = texts[d] or ""
            found = base_spans(t)
            if d - i in extra:
                raw, o = t.encode(), int(offs[d] - offs[i])
                base = list(found)
                for s, e in extra[d - i]:
                    s, e = (s - o, e - o) if len(raw) == len(t) else (len(raw[: s - o].decode()), len(raw[: e - o].decode()))
                    # spans that reach beyond the patterns' stay whole
                    upto = s
                    for x, _, y in base:  # sorted by start
                        upto = max(upto, y) if x <= upto else upto
                    if upto < e:
                        found.append((s, 3, e))
                found.sort()
            rows.append(found)
    return rows


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_rows: int = 1000, model: dict | None = None) -> DataFrame:
    """Append ``secrets``, an array of (kind, start, end) in code points, end exclusive.

    Pattern matches always stay; a decoded span is added as kind ``crf`` where
    it reaches beyond them.  Null and empty texts have no spans; repeated rows
    are scanned alike; an empty table gives an empty one; a clashing column
    ``secrets`` is replaced.
    """
    small_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c.lower() != "secrets"]
    plain = docs.select(*[docs[c] for c in cols])
    model = model or fit(docs, text, key, sample_rows)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), cols.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        for b in batches:
            found = _found(b.column(at).to_pylist(), *X.column_bytes(b.column(at)), shared.value)
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], names=[*b.schema.names, "secrets"])

    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    return plain.mapInArrow(scan, T.StructType([*plain.schema.fields, T.StructField("secrets", span)]))


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", key: str = "doc_id", sample_rows: int = 1000, model: dict | None = None) -> DataFrame:
    """Replace every span that ``find_secrets`` finds by ``mark``; spans that touch or overlap become one.

    One pass finds and replaces, so a task needs one Python worker.
    """
    small_batches(docs.sparkSession)
    model = model or fit(docs, text, key, sample_rows)
    shared, at, cols = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text), docs.columns

    def run(batches):
        for b in batches:
            texts, out = b.column(at).to_pylist(), []
            for t, spans in zip(texts, _found(texts, *X.column_bytes(b.column(at)), shared.value), strict=True):
                if t is None or not spans:
                    out.append(t)
                    continue
                parts, upto = [], 0
                for s in sorted((x, y) for x, _, y in spans):
                    if s[0] > upto or not upto and s[0] == 0:
                        parts += [t[upto : s[0]], mark]
                    upto = max(upto, s[1])
                out.append("".join([*parts, t[upto:]]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if k == at else c for k, c in enumerate(b.columns)], names=cols)

    return docs.mapInArrow(run, docs.schema)


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    x = find_secrets(docs)
    line = lambda s: F.array_join(F.transform(s, lambda y: F.concat_ws(":", y["kind"], y["start"], y["end"])), ",")
    of = lambda k: F.size(F.filter("secrets", lambda y: y["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda y: y["kind"] != "crf")
    return x.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))
