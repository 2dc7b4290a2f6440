"""Problem 9: personal information inside free text.

A character-level bidirectional LSTM with CRF transitions, trained in numpy from labelled spans (pii_train.py, weights in
pii_weights.npz), tags every character of a window with the beginning or inside of one of five kinds. Windows overlap;
each is decoded on its own, and the spans of all windows of a text are reconciled over the whole text: equal spans are
one, a span that its window's edge cuts gives way to the whole one of the next window or, where it is longer than the
overlap, is joined with its other part, and of spans that exclude each other the set with the greatest total score stays.
The decoded spans set the limits; they are only moved to the edges of words. A check of plausibility follows (a mail
address has an at-sign and a domain, a telephone number five digits, a name a capital and two words or a title before it).

Windows are laid only where a mention can be: around numbers of six digits or more, words of letters and digits, numbers
beside a capitalised word or a French word for streets, at-signs and their spellings, two capitalised words beside each
other (particles between them aside) and capitalised words behind a form of address. What has none of these can't have
the form of a mention; everything else is read whole, at any length.

Scale: a map without a shuffle over whole texts. Weights (about 60 kB) and the given names, whose number is checked, are
all that is broadcast.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.llm import pii_rules as R

CONTEXT, WINDOW, OVERLAP, LANES, MAX_HINTS, SLAB = 28, 256, 96, 512, 100_000, 400_000
#: Added to the score of every tag but "outside".
BIAS = 0.0
WEIGHTS = os.path.join(os.path.dirname(__file__), "pii_weights.npz")
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "identity": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}

# characters: printable ASCII one by one, then classes
_BASE = 2
_CLASSES = (
    "line", "space", "upper", "lower", "number", "mark", "open", "close", "dash", "quote", "symbol", "other",
    "umlaut_lower", "umlaut_upper", "sharp_s", "accent_lower", "accent_upper",
)
VOCAB = _BASE + 95 + len(_CLASSES)
UPPER, LOWER, DIGIT, MARK, LINE = 1, 2, 4, 8, 16
_TABLES: tuple[np.ndarray, np.ndarray] | None = None


def _char_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the network's id, and the bits UPPER, LOWER (any other letter), DIGIT, MARK, LINE."""
    global _TABLES
    if _TABLES is None:
        at = {c: _BASE + 95 + i for i, c in enumerate(_CLASSES)}
        kind = {
            "Lu": "upper", "Lt": "upper", "Ll": "lower", "Lo": "lower", "Lm": "lower", "Nd": "number", "No": "number",
            "Nl": "number", "Ps": "open", "Pe": "close", "Pd": "dash", "Pi": "quote", "Pf": "quote",
        }
        ids, bits = np.full(sys.maxunicode + 1, at["other"], np.uint8), np.zeros(sys.maxunicode + 1, np.uint8)
        for cp in range(sys.maxunicode + 1):
            c = unicodedata.category(chr(cp))
            ids[cp] = at[kind.get(c) or {"Z": "space", "M": "mark", "S": "symbol"}.get(c[0], "other")]
            bits[cp] = UPPER if c in ("Lu", "Lt") else LOWER if c[0] == "L" else DIGIT if c == "Nd" else MARK if c[0] == "M" else 0
        ids[32:127] = np.arange(95) + _BASE
        ids[[10, 13, 0x2028, 0x2029, 0x85]] = at["line"]
        bits[[10, 13, 0x2028, 0x2029, 0x85]] = LINE
        ids[9] = at["space"]
        for cp in range(0xC0, 0x180):
            ids[cp] = at["accent_lower" if chr(cp).islower() else "accent_upper"]
        for chars, name in (("äöü", "umlaut_lower"), ("ÄÖÜ", "umlaut_upper"), ("ßẞ", "sharp_s")):
            ids[[ord(c) for c in chars]] = at[name]
        _TABLES = ids, bits
    return _TABLES


# --- words by hash --------------------------------------------------------------------------------------------------
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        m = max(n, SLAB + 1)
        _POWERS = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, p, np.uint64)])) for p in (_P, _P_INV))
    return _POWERS


def word_hash(word: str) -> int:
    h = 0
    for i, c in enumerate(word):
        h += ord(c) * pow(0x9E3779B97F4A7C15, i, 1 << 64)
    return h & ((1 << 64) - 1)


def hashes(words: Iterable[str]) -> np.ndarray:
    return np.unique(np.array([word_hash(w) for w in words], np.uint64))


def _among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


class Hints:
    """Given names, as hashes of their spelling and of the one in capitals."""

    def __init__(self, names: Iterable[str]):
        self.table = hashes({x for n in names for x in (n, n.upper())})


_SETS: dict[str, np.ndarray] = {}


def _sets() -> dict[str, np.ndarray]:
    if not _SETS:
        capital = lambda ws: {x for w in ws for x in ((w, w.capitalize(), w.upper()) if len(w) > 1 else (w,))}
        _SETS["function"] = hashes(capital(R.FUNCTION_WORDS))
        _SETS["particle"] = hashes(capital(R.PARTICLES))
        _SETS["title"] = hashes(R.LOWER_TITLES)
        _SETS["street"] = hashes(R.STREET_WORDS_BEHIND)
        _SETS["at"] = hashes(capital(R.AT_WORDS))
        _SETS["dot"] = hashes(capital(R.DOT_WORDS))
    return _SETS


class Text:
    """Joined texts as arrays: code points, ids, words and their hashes."""

    def __init__(self, texts: list[str], hints: Hints):
        ids, bits = _char_tables()
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        self.cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.ids, self.bits, self.n = ids[self.cps], bits[self.cps], len(self.cps)
        n, c = self.n, self.cps
        self.text_of = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        solid = (self.bits & (UPPER | LOWER | DIGIT | MARK)) > 0
        edge = np.zeros(n + 1, bool)  # a text's beginning
        edge[self.first] = True
        # hyphens and apostrophes between letters belong to the word
        link = np.zeros(n, bool)
        inner = np.flatnonzero((c == 45) | (c == 39) | (c == 0x2019) | (c == 0x2010) | (c == 0x2011))
        inner = inner[(inner > 0) & (inner < n - 1)]
        inner = inner[((self.bits[inner - 1] & (UPPER | LOWER | MARK)) > 0) & ((self.bits[inner + 1] & (UPPER | LOWER)) > 0) & ~edge[inner] & ~edge[inner + 1]]
        link[inner] = True
        w = solid | link
        begin = w.copy()
        begin[1:] &= ~w[:-1] | edge[1:n]
        end = w.copy()
        end[:-1] &= ~w[1:] | edge[1:n]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1  # of words
        power, inverse = _powers(n + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c.astype(np.uint64) * power[:n])])
        self.hash = (total[self.end] - total[self.start]) * inverse[self.start]
        self.hint = _among(self.hash, hints.table)
        # flags of the characters of given names
        step = np.zeros(n + 1, np.int8)
        step[self.start[self.hint]] += 1
        step[self.end[self.hint]] -= 1
        self.flags = np.cumsum(step[:n], dtype=np.int8)

    def hot(self) -> np.ndarray:
        """Characters around which a mention can lie."""
        s, e, sets = self.start, self.end, _sets()
        out = (self.cps == 64) | (self.cps == 0xFF20)
        if not len(s):
            return out
        is_digit = (self.bits & DIGIT) > 0
        digits = np.concatenate([[0], np.cumsum(is_digit)])
        count = digits[e] - digits[s]
        number, mixed = count == e - s, (count > 0) & (count < e - s)
        cap = ((self.bits[s] & UPPER) > 0) & ~_among(self.hash, sets["function"])
        particle = _among(self.hash, sets["particle"])
        nxt = np.full(len(s), 99)
        nxt[:-1] = s[1:] - e[:-1]
        near = nxt <= 3
        near[:-1] &= self.text_of[s[1:]] == self.text_of[s[:-1]]
        lines = np.concatenate([[0], np.cumsum((self.bits & LINE) > 0)])
        same_line = near.copy()
        same_line[:-1] &= lines[s[1:]] == lines[e[:-1]]
        shift = lambda x, k: np.concatenate([x[k:], np.zeros(k, x.dtype)])
        # two capitalised words, with up to three particles between them
        ahead = cap
        for _ in range(4):
            ahead = cap | (particle & same_line & shift(ahead, 1))
        pair = cap & same_line & shift(ahead, 1)
        titled = _among(self.hash, sets["title"]) & near & shift(ahead, 1)
        # numbers beside a capitalised word or before a word for streets; not parts of larger numbers
        c = np.concatenate([self.cps, np.zeros(2, np.uint32)])
        sep = lambda x: (x == 44) | (x == 46)
        digit = np.concatenate([is_digit, [False, False]])
        text_end = self.first[1:][self.text_of[s]]
        part = (sep(c[e]) & digit[np.minimum(e + 1, self.n + 1)] & (e + 1 < text_end)) | ((s > 1) & sep(c[s - 1]) & digit[s - 2])
        short = (number | mixed) & (count <= 4) & ~part
        before = np.zeros(len(s), bool)
        before[1:] = (cap & near)[:-1]
        house = short & (before | (near & shift(ahead | _among(self.hash, sets["street"]), 1)))
        # at-words with a domain behind them
        at = _among(self.hash, sets["at"]) & near & (shift(near & (c[e] == 46), 1) | (shift(near, 1) & shift(_among(self.hash, sets["dot"]), 2)))
        bracket = (s > 0) & np.isin(c[s - 1], (40, 91, 123, 60)) & np.isin(c[e], (41, 93, 125, 62))
        at |= bracket & (e - s <= 12) & ~number
        # six digits in a row of numbers
        run = np.zeros(len(s), np.int64)
        glued = (number | mixed) & near
        heads = np.flatnonzero((number | mixed) & ~np.concatenate([[False], glued[:-1]]))
        group = np.cumsum(np.bincount(heads, minlength=len(s))) - 1
        sums = np.bincount(np.maximum(group, 0), weights=np.where(number | mixed, count, 0), minlength=1)
        run = np.where(number | mixed, sums[np.maximum(group, 0)], 0)
        long = run >= 6
        mark = pair | titled | house | at | long | (mixed & (e - s >= 3))
        mark[1:] |= (pair | titled)[:-1]
        signs = np.flatnonzero(out)
        out[s[mark]] = True
        out[e[mark] - 1] = True
        # addresses may be long on either side of the sign
        signs = np.concatenate([signs, s[at]])
        t = self.text_of[signs]
        for step in (-CONTEXT, CONTEXT):
            out[np.clip(signs + step, self.first[t], self.first[t + 1] - 1)] = True
        return out

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of stretches with CONTEXT characters around every hot one, within their texts."""
        at = np.flatnonzero(self.hot())
        if not len(at):
            return at, at
        t = self.text_of[at]
        lo, hi = np.maximum(at - CONTEXT, self.first[t]), np.minimum(at + 1 + CONTEXT, self.first[t + 1])
        new = np.concatenate([[True], (lo[1:] > hi[:-1]) | (t[1:] != t[:-1])])
        k = np.flatnonzero(new)
        return lo[k], hi[np.concatenate([k[1:] - 1, [len(at) - 1]])]


class Model:
    def __init__(self, p: dict[str, np.ndarray], bias: float = BIAS):
        self.p, self.hidden, self.tags = p, p["Wh"].shape[1], len(p["b"])
        # one table for character and flag: its rows are the inputs to the gates
        self.table = np.stack([(p["emb"][k][None] + p["hint"][k][:, None]).reshape(-1, 4 * self.hidden) for k in range(2)])
        self.out = p["b"] + np.where(np.arange(self.tags) > 0, bias, 0).astype(np.float32)
        # what a path may gain over "outside" by a transition, at most: into a span, within one, out of one
        A, first = p["trans"], p["start"]
        self.into, self.within, self.out_of = (float(np.max(x - A[0, 0])) for x in (A[0, 1:], A[1:, 1:], A[1:, 0]))
        self.begin = float(np.max(first[1:] - first[0]))

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Scores (time, lane, tag) of input rows x (time, lane); row 0 stands for padding."""
        T, B = x.shape
        H, p = self.hidden, self.p
        h, c = np.zeros((2, B, H), np.float32), np.zeros((2, B, H), np.float32)
        z, inputs, tmp = np.empty((2, B, 4 * H), np.float32), np.empty((2, B, 4 * H), np.float32), np.empty((2, B, H), np.float32)
        hs = np.empty((2, T, B, H), np.float32)
        # the rows of both directions in one table, the second from the end on
        rows = np.stack([x, x[::-1] + self.table.shape[1]], 1).astype(np.intp)
        table = self.table.reshape(-1, 4 * H)
        for t in range(T):
            np.take(table, rows[t], axis=0, out=inputs, mode="clip")
            np.matmul(h, p["Wh"], out=z)
            z += inputs
            np.tanh(z, out=z)
            s = z[..., : 3 * H]
            s *= 0.5
            s += 0.5
            c *= z[..., H : 2 * H]
            np.multiply(z[..., :H], z[..., 3 * H :], out=tmp)
            c += tmp
            np.tanh(c, out=h)
            h *= z[..., 2 * H : 3 * H]
            hs[0, t], hs[1, T - 1 - t] = h[0], h[1]
        em = hs[0].reshape(-1, H) @ p["Wo"][0] + hs[1].reshape(-1, H) @ p["Wo"][1]
        em += self.out
        return em.reshape(T, B, self.tags)

    def viterbi(self, em: np.ndarray) -> np.ndarray:
        """Best tags (time, lane). Lanes where nothing can beat "outside" aren't walked: an upper bound of what any span
        can gain is followed along them first, with all tags but "outside" taken as one."""
        T, B, K = em.shape
        out = np.zeros((T, B), np.uint8)
        margin = em[:, :, 1:].max(2) - em[:, :, 0]
        gain = margin[0] + self.begin
        most = np.maximum(gain + self.out_of, gain) if T == 1 else gain + self.out_of
        for t in range(1, T):
            np.maximum(gain + self.within, self.into, out=gain)
            gain += margin[t]
            np.maximum(most, gain + (self.out_of if t < T - 1 else max(self.out_of, 0.0)), out=most)
        live = np.flatnonzero(most >= 0)
        if not len(live):
            return out
        e = np.ascontiguousarray(em[:, live].transpose(0, 2, 1))  # time, tag, lane
        A = self.p["trans"]
        scores = np.empty_like(e)
        scores[0] = e[0] + self.p["start"][:, None]
        best, other = np.empty_like(e[0]), np.empty_like(e[0])
        into = A[:, :, None]
        for t in range(1, T):
            np.add(scores[t - 1, 0], into[0], out=best)
            for k in range(1, K):
                np.add(scores[t - 1, k], into[k], out=other)
                np.maximum(best, other, out=best)
            np.add(best, e[t], out=scores[t])
        # the way back looks for the best step before only along the path
        path = scores[T - 1].argmax(0)
        out[T - 1, live] = path
        to = np.ascontiguousarray(A.T)
        for t in range(T - 1, 0, -1):
            path = (scores[t - 1].T + to[path]).argmax(1)
            out[t - 1, live] = path
        return out

    def spans(self, texts: list[str], hints: Hints, everywhere: bool = False) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) by text, reconciled over each whole text; everywhere: without the choice of places."""
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < SLAB):
                size += len(texts[end])
                end += 1
            if size:
                out[at:end] = self._spans(texts[at:end], hints, everywhere)
            at = end
        return out

    def _spans(self, texts: list[str], hints: Hints, everywhere: bool) -> list[list[tuple[int, int, str]]]:
        t = Text(texts, hints)
        rows = t.ids.astype(np.int32) + t.flags.astype(np.int32) * VOCAB
        if everywhere:
            lo, hi = t.first[:-1][t.lengths > 0], t.first[1:][t.lengths > 0]
        else:
            lo, hi = t.segments()
        # segments longer than a window become windows that overlap
        step = WINDOW - OVERLAP
        many = np.maximum(1, -(-(hi - lo - OVERLAP) // step))
        seg = np.repeat(np.arange(len(lo)), many)
        k = np.arange(len(seg)) - np.repeat(np.cumsum(many) - many, many)
        a = lo[seg] + k * step
        b = np.minimum(a + WINDOW, hi[seg])
        found: list[list[tuple]] = [[] for _ in texts]
        order = np.argsort(b - a, kind="stable")
        for w in (order[i : i + LANES] for i in range(0, len(order), LANES)):
            T = int((b[w] - a[w]).max())
            at = a[w][None] + np.arange(T)[:, None]
            inside = at < b[w][None]
            em = self.emissions(np.where(inside, rows[np.minimum(at, t.n - 1)], 0))
            tags = np.where(inside, self.viterbi(em), 0)
            lanes = np.flatnonzero(tags.any(0))
            for lane in lanes.tolist():
                y = tags[:, lane]
                margin = np.concatenate([[0.0], np.cumsum(em[np.arange(T), lane, y] - em[:, lane, 0])])
                a0, b0 = int(a[w[lane]]), int(b[w[lane]])
                text = int(t.text_of[a0])
                base = int(t.first[text])
                for s, e, kind in runs(y):
                    found[text].append((a0 + s - base, a0 + e - base, kind, float(margin[e] - margin[s]), s == 0 and a0 > base, a0 + e == b0 < int(t.first[text + 1])))
        return [reconciled(f) for f in found]


def runs(y: np.ndarray) -> list[tuple[int, int, str]]:
    """(start, end, kind) of a window's tags: odd tags begin, even ones go on; one that goes on with nothing begins."""
    kind = (y.astype(np.int16) + 1) // 2
    prev = np.concatenate([[0], kind[:-1]])
    start = (kind > 0) & ((kind != prev) | (y % 2 == 1))
    stop = (kind > 0) & np.concatenate([(kind[1:] != kind[:-1]) | start[1:], [True]])
    return [(s, e + 1, R.KINDS[kind[s] - 1]) for s, e in zip(np.flatnonzero(start).tolist(), np.flatnonzero(stop).tolist())]


def reconciled(found: list[tuple]) -> list[tuple[int, int, str]]:
    """One set of spans from those of overlapping windows: (start, end, kind, score, cut at the left, cut at the right)."""
    if len(found) > 1:
        found.sort(key=lambda s: (s[0], s[1]))
        merged: list[list] = []
        for s in found:
            p = merged[-1] if merged else None
            if p and s[0] < p[1] and s[2] == p[2]:
                if (s[0], s[1]) == (p[0], p[1]):
                    p[3], p[4], p[5] = max(p[3], s[3]), p[4] and s[4], p[5] and s[5]
                    continue
                if p[5] and s[4]:  # two parts of one span
                    p[1], p[3], p[5] = max(p[1], s[1]), p[3] + s[3], s[5]
                    continue
                if p[5] or p[4]:  # the next window has it whole
                    merged[-1] = list(s)
                    continue
                if s[4] or s[5]:
                    continue
            merged.append(list(s))
        found = [tuple(m) for m in merged]
        if any(x[1] > y[0] for x, y in zip(found, found[1:])):
            found = _best_set(found)
    return [(a, b, k) for a, b, k, *_ in found]


def _best_set(found: list[tuple]) -> list[tuple]:
    """Of spans that overlap the set without overlaps whose scores sum up to most."""
    found = sorted(found, key=lambda s: s[1])
    ends = [s[1] for s in found]
    best: list[tuple[float, int, bool]] = [(0.0, 0, False)]
    for i, s in enumerate(found):
        j = int(np.searchsorted(ends, s[0], "right"))
        take = best[j][0] + max(s[3], 1e-6)
        best.append((take, j, True) if take > best[i][0] else (best[i][0], i, False))
    out, i = [], len(found)
    while i:
        _, j, taken = best[i]
        if taken:
            out.append(found[i - 1])
        i = j
    return out[::-1]


_MODEL: Model | None = None


def load() -> Model:
    global _MODEL
    if _MODEL is None:
        with np.load(WEIGHTS) as f:
            _MODEL = Model({k: f[k].astype(np.float32) for k in f.files})
    return _MODEL


def checked(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans moved to the edges of their words, without those that can't be of their kind."""
    out: list[tuple[int, int, str]] = []
    for a, b, k in spans:
        got = R.trimmed(text, a, b, k)
        if got and not (out and got[0] < out[-1][1]):
            out.append((*got, k))
    return out


def find(texts: list[str | None], hints: set[str] | Hints, model: Model | None = None) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) in code points of each stored text; null and empty texts have none. Equal texts are read once."""
    model = model or load()
    hints = hints if isinstance(hints, Hints) else Hints(hints)
    place: dict[str, int] = {}
    for t in texts:
        if t:
            place.setdefault(t, len(place))
    plain = [R.composed(t) for t in place]
    got = []
    for (t, at), spans in zip(plain, model.spans([t for t, _ in plain], hints)):
        s = checked(t, spans)
        got.append([(at[a], at[b], k) for a, b, k in s] if at else s)
    return [got[place[t]] if t else [] for t in texts]


def replaced(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with a typed placeholder for each span; null stays null."""
    if text is None:
        return None
    parts, at = [], 0
    for a, b, k in spans:
        parts += [text[at:a], PLACEHOLDER[k]]
        at = b
    return "".join(parts) + text[at:]


def _hints(hints: DataFrame) -> set[str]:
    got = hints.select("given_name").where("given_name IS NOT NULL").distinct().limit(MAX_HINTS + 1).collect()
    if len(got) > MAX_HINTS:
        raise ValueError(f"more than {MAX_HINTS} given names")
    return {r.given_name.strip() for r in got}


def mentions(docs: DataFrame, hints: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kind, start_pos, end_pos) of every mention, positions from 1 in code points of the stored text, end_pos
    included. Null and empty texts have none; equal texts under different keys have their own rows; a null key stays
    null. Repeated rows give one set of rows. Empty tables give no rows; extra columns are ignored."""
    names = docs.sparkSession.sparkContext.broadcast(_hints(hints))
    head = docs.select(key).schema[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hints = Hints(names.value)
        for b in batches:
            found = find(b["__text"].tolist(), hints)
            n = list(map(len, found))
            yield pd.DataFrame({
                key: np.repeat(b[key].to_numpy(), n), "kind": np.array([k for f in found for _, _, k in f], object),
                "start_pos": np.array([a + 1 for f in found for a, _, _ in f], "int64"), "end_pos": np.array([e for f in found for _, e, _ in f], "int64"),
            })

    picked = docs.select(key, F.col(text).alias("__text")).where("__text <> ''")
    return picked.mapInPandas(run, f"`{key}` {head.dataType.simpleString()}, kind string, start_pos bigint, end_pos bigint").dropDuplicates([key, "kind", "start_pos"])


def mask(docs: DataFrame, hints: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, masked): every row's text with typed placeholders for its mentions; null stays null, the rest as it is."""
    names = docs.sparkSession.sparkContext.broadcast(_hints(hints))
    head = docs.select(key).schema[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hints = Hints(names.value)
        for b in batches:
            texts = b["__text"].tolist()
            yield pd.DataFrame({key: b[key], "masked": [replaced(t, s) for t, s in zip(texts, find(texts, hints))]})

    return docs.select(key, F.col(text).alias("__text")).mapInPandas(run, f"`{key}` {head.dataType.simpleString()}, masked string")
