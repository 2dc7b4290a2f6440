"""Problem 7: encoding whole texts with a public byte-level BPE vocabulary.

Pre-tokenisation works on the code points of a whole Arrow batch at once, without regular expressions: a table gives
each code point its class, a small automaton over classes tells where pieces begin, and its states come from an
associative scan over the transition functions. A transition function is a row of next states; composing rows at
distances 1, 2, 4, ... gives the state at every position, and the scan stops as soon as every composed function is
constant, which this automaton reaches after a few steps because it forgets what lies more than a few signs back.
Pieces then meet a cache of merged pieces; a miss is merged by rank. Offsets of pieces stay available for decoding.

Scale: a map without a shuffle. The vocabulary (about 50,000 ranks, a fixed size) is broadcast once; texts are cut off
nowhere; the cache is bounded.
"""

from __future__ import annotations

import base64
import os
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = os.environ.get("ANNOLYTICS_TOKENIZERS", "/opt/tokenizers")
CACHE_PIECES = 400_000
#: Code points of a batch that are looked at together.
SLAB = 2_000_000

BLANK, OTHER_SPACE, LETTER, NUMBER, MARK, QUOTE = range(6)  # classes: ' ', other white space, letter, number, rest, apostrophe
# fixed values: the white space that \s stands for in the vocabulary's pattern
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# fixed values: what a short form may hold behind its apostrophe
_SHORT = ("s", "t", "re", "ve", "m", "ll", "d")


def _class_table() -> np.ndarray:
    t = np.full(sys.maxunicode + 1, MARK, np.uint8)
    for cp in range(sys.maxunicode + 1):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            t[cp] = LETTER
        elif c == "N":
            t[cp] = NUMBER
    t[_SPACES] = OTHER_SPACE
    t[0x20], t[0x27] = BLANK, QUOTE
    return t


_CLASSES: np.ndarray | None = None


def classes() -> np.ndarray:
    global _CLASSES
    if _CLASSES is None:
        _CLASSES = _class_table()
    return _CLASSES


#: States: in white space that ended with ' ', in other white space, in letters, in numbers, in marks, in marks that are
#: so far a lone apostrophe which began a piece, and the start of a text.
AFTER_BLANK, AFTER_SPACE, IN_LETTERS, IN_NUMBERS, IN_MARKS, LONE_QUOTE, START = range(7)


def _transitions() -> np.ndarray:
    """next_state[class, state]."""
    t = np.empty((7, 7), np.uint8)
    t[BLANK], t[OTHER_SPACE], t[LETTER], t[NUMBER], t[MARK] = AFTER_BLANK, AFTER_SPACE, IN_LETTERS, IN_NUMBERS, IN_MARKS
    t[QUOTE] = LONE_QUOTE
    t[QUOTE, [AFTER_BLANK, IN_MARKS, LONE_QUOTE]] = IN_MARKS
    t[6] = START  # the border between two texts
    return t


TRANSITIONS = _transitions()
BORDER = 6


def scan_states(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state after each symbol, by an inclusive scan of composed transition functions."""
    f = TRANSITIONS[symbols]
    step = 1
    while len(f) and (f != f[:, :1]).any() and step < len(f):
        g = f.copy()
        g[step:] = np.take_along_axis(f[step:], f[:-step].astype(np.intp), axis=1)
        f, step = g, step * 2
    return f[:, START]


def piece_starts(cps: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """True where a piece begins. symbols holds BORDER where a new text begins (that position is no sign of a text)."""
    n = len(symbols)
    state = scan_states(symbols)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = START, state[:-1]
    after = np.full(n, BORDER, np.uint8)
    after[:-1] = symbols[1:]
    space, space_before = symbols <= OTHER_SPACE, before <= AFTER_SPACE
    more = (after != BORDER) & (after > OTHER_SPACE)  # something but white space follows
    # white space: a run begins a piece, and its last sign begins another where something follows
    starts = np.where(space, ~space_before | more, False)
    kind = np.where(symbols == QUOTE, MARK, symbols)
    was = np.where(before == LONE_QUOTE, IN_MARKS, before)
    same = ((kind == LETTER) & (was == IN_LETTERS)) | ((kind == NUMBER) & (was == IN_NUMBERS)) | ((kind == MARK) & (was == IN_MARKS))
    # a sign begins a piece unless it goes on with a run or the ' ' before it belongs to it
    starts |= ~space & (symbols != BORDER) & ~same & (before != AFTER_BLANK)
    # short forms: a lone apostrophe takes the letters behind it, and what follows begins a piece
    quotes = np.flatnonzero((state == LONE_QUOTE) & (symbols == QUOTE) & (after == LETTER))
    if len(quotes):
        padded = np.concatenate([cps, np.zeros(3, cps.dtype)])
        a, b = padded[quotes + 1], padded[quotes + 2]
        size = np.zeros(len(quotes), np.int64)
        for s in _SHORT:
            if len(s) == 1:
                size[a == ord(s)] = 1
            else:
                size[(a == ord(s[0])) & (b == ord(s[1]))] = 2
        hit = size > 0
        q, size = quotes[hit], size[hit]
        starts[q + 1] = False
        nxt = q + size + 1
        inside = nxt < n
        # the rest of the letters begins a piece; other classes begin one anyway
        starts[nxt[inside]] |= symbols[nxt[inside]] == LETTER
    starts[symbols == BORDER] = True
    return starts


def pieces(texts: list[str]) -> Iterator[list[str]]:
    """The pieces of each text; their lengths are the offsets that decoding needs."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size == 0 or size + len(texts[end]) < SLAB):
            size += len(texts[end]) + 1
            end += 1
        part = texts[at:end]
        joined = "\0" + "\0".join(part)
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
        first = np.concatenate([[0], np.cumsum(lengths)])
        symbols = classes()[cps]
        symbols[first[:-1]] = BORDER
        bounds = np.flatnonzero(piece_starts(cps, symbols))
        cuts = np.searchsorted(bounds, first)
        stops = np.append(bounds[1:], len(cps))
        for i in range(len(part)):
            lo, hi = cuts[i] + 1, cuts[i + 1]  # the border itself is left out
            yield [joined[a:b] for a, b in zip(bounds[lo:hi].tolist(), stops[lo:hi].tolist())]
        at = end


class Encoder:
    """Ids of texts by ranks of byte strings; decode() is its inverse."""

    def __init__(self, ranks: dict[bytes, int], cache: int = CACHE_PIECES):
        self.ranks, self.size, self.cache = ranks, cache, {}
        self.back = None

    def merge(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        parts = [raw[i : i + 1] for i in range(len(raw))]
        return self._merge_long(parts) if len(parts) > 64 else self._merge_short(parts)

    def _merge_short(self, parts: list[bytes]) -> list[int]:
        get, none = self.ranks.get, 1 << 60
        pair = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pair:
            best = min(pair)
            if best == none:
                break
            i = pair.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        """The same merges with a heap over a linked list: n log n for runs of one class without a break."""
        import heapq

        get, n = self.ranks.get, len(parts)
        nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = nxt[i] if live[i] else n
            if j >= n or parts[i] + parts[j] != both:
                continue
            parts[i], live[j], nxt[i] = both, False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for a, b in ((prv[i], i), (i, nxt[i])):
                if a >= 0 and b < n and (r := get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a] + parts[b]))
        return [self.ranks[p] for p, ok in zip(parts, live) if ok]

    def encode_batch(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts have none."""
        texts = [t or "" for t in texts]
        cache, out = self.cache, []
        for ps in pieces(texts):
            ids: list[int] = []
            for p in ps:
                got = cache.get(p)
                if got is None:
                    if len(cache) >= self.size:
                        cache.clear()
                    got = self.merge(p)
                    if len(p) <= 64:
                        cache[p] = got
                ids += got
            out.append(ids)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        if self.back is None:
            self.back = {i: b for b, i in self.ranks.items()}
        return b"".join(self.back[i] for i in ids).decode("utf-8", "surrogatepass")


def load_ranks(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> dict[bytes, int]:
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, count_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, ids) of every row, or n_tokens instead of ids: whole texts, repeated rows too, without special tokens.

    Null and empty texts have an empty list (no tokens); blank ones are encoded as they are. A null key stays null. An
    empty table gives none. The vocabulary file is read on the driver only.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(name, folder))
    picked = df.select(key, *keep, F.col(text).alias("__text"))
    out = "n_tokens int" if count_only else "ids array<int>"
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(key, *keep).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _ENCODERS.get((folder, name)) or _ENCODERS.setdefault((folder, name), Encoder(shared.value))
        for b in batches:
            ids = enc.encode_batch(None if x is None else x for x in b.pop("__text"))
            b["n_tokens" if count_only else "ids"] = list(map(len, ids)) if count_only else ids
            yield b

    return picked.mapInPandas(run, f"{head}, {out}")
