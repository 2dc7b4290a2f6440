"""Problem 2: splitting oversized texts at natural boundaries, by pointer doubling.

Every position of a text is a possible end of a piece. One table holds for each position the end of the piece that
follows it: the farthest legal boundary of the next piece, which begins with the overlap. Joining every end to its
successor and squaring the table doubles the number of pieces that each round reaches, so that all greedy cuts of all
texts of a batch come out after log2(pieces) rounds, without walking any text piece by piece.

Boundaries are ranked: blank line, end of line, end of a sentence, white space. The best rank that has a boundary in the
last part of a piece wins, and of that rank the farthest boundary; without any boundary the cut falls at the limit, moved
back so that it doesn't part a base sign from its marks, the two signs of a line end, or a joined sequence.

Scale: a map; only texts above the limit reach Python, and pieces go out as ranges unless asked for. Digests of the values
tell which come more than once; only those are shuffled, to be cut once.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.operators.joins import join_unique
from annolytics.session import persist_table

MAX_CHARS, OVERLAP, SLACK = 2000, 200, 40
#: A boundary of a better rank is taken only where the piece keeps at least this part of its size.
LEAST_PART = 0.5
SLAB = 250_000
PLAIN, SPACE, LINE, STOP, EXTEND = range(5)
_TABLE: np.ndarray | None = None


def _classes() -> np.ndarray:
    global _TABLE
    if _TABLE is None:
        t = np.zeros(sys.maxunicode + 1, np.uint8)
        for cp in range(sys.maxunicode + 1):
            c = unicodedata.category(chr(cp))
            if c[0] == "M" or cp in (0x200C, 0x200D) or 0x1F3FB <= cp <= 0x1F3FF:
                t[cp] = EXTEND
            elif c[0] == "Z" or cp in (0x09, 0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F):
                t[cp] = SPACE
        t[[0x0A, 0x0D, 0x85, 0x2028, 0x2029]] = LINE
        t[[ord(c) for c in ".!?…。！？"]] = STOP
        _TABLE = t
    return _TABLE


def _last(mask: np.ndarray) -> np.ndarray:
    """For each index the largest index up to it where mask holds, or -1."""
    return np.maximum.accumulate(np.where(mask, np.arange(len(mask), dtype=np.int32), np.int32(-1)))


def cut(texts: list[str], limit: int = MAX_CHARS, overlap: int = OVERLAP, slack: int = SLACK) -> list[list[tuple[int, int]]]:
    """Ranges (start, end) in code points of the pieces of each text, in order; a text within the limit is one piece.

    Every piece has at most `limit` code points and begins overlap - slack to overlap before the end of the one before,
    at a word's beginning where one lies there. An empty text has no piece.
    """
    if not 0 <= overlap < limit // 2 or not 0 <= slack <= overlap:
        raise ValueError("the overlap must be below half the limit, the slack at most the overlap")
    lengths = np.fromiter(map(len, texts), np.int32, len(texts))
    first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    n = int(first[-1])
    if not n:
        return [[] for _ in texts]
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    k = _classes()[cps]
    # index e stands for a cut before sign e; n is the end of the last text
    prev, here = np.concatenate([[PLAIN], k]), np.concatenate([k, [PLAIN]])
    white = (here == SPACE) | (here == LINE)
    after_white = (prev == SPACE) | (prev == LINE)
    word = after_white & ~white
    # a cut after white space belongs to the rank of the strongest sign in that white space
    index = np.arange(n + 1, dtype=np.int32)
    solid = _last(np.concatenate([[False], ~((k == SPACE) | (k == LINE))]))  # one past the last solid sign
    run = np.maximum(solid, 0)
    crlf = np.zeros(n + 1, bool)
    crlf[1:n] = (cps[:-1] == 13) & (cps[1:] == 10)
    lines = np.concatenate([[0], np.cumsum((k == LINE) & ~crlf[:n], dtype=np.int32)])
    breaks = lines[index] - lines[run]
    stop = np.zeros(n + 1, bool)
    ends = np.concatenate([[False], k == STOP])
    closing = np.concatenate([[False], np.isin(cps, np.array([ord(c) for c in "\"'”“’»«)]"], np.uint32))])
    back = np.zeros(n + 1, bool)
    back[1:] = closing[1:] & ends[:-1]
    stop = (ends | back)[run]
    ranks = [_last(m) for m in (word & (breaks >= 2), word & (breaks >= 1), word & stop, word)]
    hard = _last(~crlf & (here != EXTEND) & ~np.concatenate([[False], cps == 0x200D]))
    text_end = np.repeat(first[1:], lengths)
    text_end = np.append(text_end, np.int32(n))
    text_start = np.append(np.repeat(first[:-1], lengths), np.int32(n))
    # the start of the piece after an end e: the first word in the tolerated stretch, else exactly the overlap
    lo = np.maximum(index - overlap, text_start)
    to = np.maximum(index - overlap + slack, text_start)
    word_at = _next(word)
    start = np.where(word_at[lo] <= to, word_at[lo], lo)
    on_mark = here[start] == EXTEND
    start = np.where(on_mark, np.minimum(_next(here != EXTEND)[start], to), start)
    # an end e is followed by the end after[e]; index e = start of a text stands for its first piece
    own = first[:-1]
    succ = _successor(start, index, ranks, hard, text_end, limit, overlap)
    begin = _successor(own, own, ranks, hard, first[1:], limit, overlap) if len(own) else own
    succ = np.where(index >= text_end, index, succ)
    ends_of = _double(succ, begin, first)
    out = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if a == b:
            out.append([])
            continue
        e = ends_of[np.searchsorted(ends_of, a, "right") : np.searchsorted(ends_of, b, "right")]
        s = np.concatenate([[a], start[e[:-1]]]) - a
        out.append(list(zip(s.tolist(), (e - a).tolist())))
    return out


def _next(mask: np.ndarray) -> np.ndarray:
    """For each index the smallest index from it on where mask holds, or one past the last."""
    n = len(mask)
    return np.minimum.accumulate(np.where(mask, np.arange(n, dtype=np.int32), np.int32(n))[::-1])[::-1]


def _successor(start, end, ranks, hard, text_end, limit, overlap):
    far = np.minimum(start + limit, text_end)
    shortest = max(limit // 4, 2 * overlap)
    least = np.maximum(start + int(limit * LEAST_PART), end + 1)
    best = np.full(len(start), -1, np.int32)
    for r in ranks:
        best = np.where((best < 0) & (r[far] >= least), r[far], best)
    word = ranks[-1][far]
    best = np.where((best < 0) & (word > end) & (word > start + shortest), word, best)
    solid = hard[far]
    best = np.where(best < 0, np.where(solid > np.maximum(end, np.maximum(far - 64, start + 2 * overlap - 1)), solid, far), best)
    return np.where(far == text_end, text_end, best)


def _double(succ: np.ndarray, begin: np.ndarray, first: np.ndarray) -> np.ndarray:
    """All ends that are reached from the first pieces' ends: the successor table is squared until nothing is new."""
    reached = np.zeros(len(succ), bool)
    frontier = np.unique(begin[first[:-1] < first[1:]])
    reached[frontier] = True
    jump = succ
    while True:
        found = np.flatnonzero(reached)
        more = jump[found]
        if reached[more].all():
            return np.flatnonzero(reached)
        reached[more] = True
        jump = jump[jump]


def pieces(df: DataFrame, keys: tuple[str, ...], fields: tuple[str, ...], limit: int = MAX_CHARS, overlap: int = OVERLAP, slack: int = SLACK, with_text: bool = True) -> DataFrame:
    """(*keys, field_name, piece_no, start_pos, end_pos[, piece]) of every value of `fields` above the limit, from 1 on,
    end_pos included. Positions count code points. Null, empty and shorter values give no rows; rows that are alike in
    keys and value give one set of pieces; null keys stay null. Extra columns are ignored.
    """
    head = df.select(*keys).schema
    ids, long = [f"__k{i}" for i in range(len(keys))], None
    for f in fields:
        part = df.select(*[F.col(k).alias(i) for k, i in zip(keys, ids)], F.lit(f).alias("__field"), F.col(f).alias("__text")).where(F.length("__text") > limit)
        long = part if long is None else long.unionAll(part)
    # only values that come more than once have to be brought together: digests are counted, texts stay where they are
    value = F.sha2(F.to_json(F.struct(*ids, "__field", F.sha2("__text", 256).alias("d"))), 256)
    long = long.withColumn("__id", value)
    more = persist_table(long.groupBy("__id").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"), "repeats")
    marked = join_unique(long, more, "__id", "left")
    once = marked.where("__n IS NULL").drop("__n")
    long = once.unionByName(marked.where("__n IS NOT NULL").drop("__n").dropDuplicates(["__id"])).drop("__id")
    long = long.select(*[F.col(i).alias(k) for k, i in zip(keys, ids)], F.col("__field").alias("field_name"), "__text")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head) + ", field_name string, piece_no int, start_pos int, end_pos int" + (", piece string" if with_text else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, at = b.pop("__text").tolist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < SLAB):
                    size += len(texts[end])
                    end += 1
                got = cut(texts[at:end], limit, overlap, slack)
                rows = b.iloc[np.repeat(np.arange(at, end), list(map(len, got)))].reset_index(drop=True)
                rows["piece_no"] = np.concatenate([np.arange(1, len(g) + 1) for g in got]).astype("int32")
                rows["start_pos"] = np.array([s + 1 for g in got for s, _ in g], "int32")
                rows["end_pos"] = np.array([e for g in got for _, e in g], "int32")
                if with_text:
                    rows["piece"] = [t[s:e] for t, g in zip(texts[at:end], got) for s, e in g]
                yield rows
                at = end

    return long.mapInPandas(run, cols)
