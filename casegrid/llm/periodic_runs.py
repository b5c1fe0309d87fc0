"""Periodic runs of words: k-gram seeds, extended along diagonals.

A run is a longest stretch of words with smallest period q that is at least
``min_length`` and ``2 * q`` words long. Words q apart are equal in it, so it
shows as a diagonal of lag q: a match of the text with itself, q words on, of
``length - q`` words.

* *Seeds.* With ``k = ceil(min_length / 2)`` every diagonal has k matches or more;
  for lags from K on it has K. So k-grams are the seeds of lags under 2k, 2k-grams
  of lags from 2k to 4k, and so on, each level made of the one before. Only
  positions whose k-gram comes again in its document go on to the next level.
* *Pairs.* Two equal seeds of one document whose lag belongs to the level are a
  pair. A seed that came already half its length before, or less, lies within a run
  of a shorter period; of two such seeds no pair is made, since the ends of that run
  make it. So pairs grow with the words, not with the square of a seed's count.
* *Extension.* Pairs are taken by lag and place; for each lag the furthest place
  that was covered is kept, and pairs before it are skipped, as are those within a
  run whose period divides the lag. Each other pair is extended to both sides.

A document's words are in one task, and documents are taken a block at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import as_bytes, with_results

MIN_LENGTH = 12
_WORDS = 1 << 17  # words of a block, or one document
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash for two neighbours."""
    x = left * _ODD + right
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    code = _joined(x, np.full(len(x), np.uint64(k)))
    first = code
    for j in range(1, k):
        code = _joined(code[:-1], first[j:])
    return code


def _seed_pairs(at: np.ndarray, group: np.ndarray, size: int, low: int, high: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of pairs with low <= lag < high; ``at`` and ``group`` are in order of group, then place."""
    key = group * np.int64(n + 2 * high + 2) + at
    gap = np.full(len(at), np.int64(n + high))
    gap[1:] = np.where(group[1:] == group[:-1], at[1:] - at[:-1], n + high)
    lone = np.flatnonzero(2 * gap > size)
    sides = []
    for forward in (True, False):
        a = np.searchsorted(key, key[lone] + low if forward else key[lone] - high + 1)
        b = np.searchsorted(key, key[lone] + high if forward else key[lone] - low + 1)
        many = np.maximum(b - a, 0)
        mine = np.repeat(lone, many)
        other = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)
        x, y = (mine, other) if forward else (other, mine)
        sides.append((at[x], at[y] - at[x]))
    return np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])


def _equal_from(x: np.ndarray, i: int, j: int) -> int:
    """How many words from i and j (> i) on are equal."""
    size, n = 32, 0
    while True:
        same = x[i + n : i + n + size][: max(0, len(x) - j - n)] == x[j + n : j + n + size]
        if not same.all():
            return n + int(same.argmin())
        n += len(same)
        if len(same) < size:
            return n
        size = min(2 * size, 1 << 16)


def _equal_before(x: np.ndarray, i: int, j: int) -> int:
    """How many words before i and j (> i) are equal."""
    size, n = 32, 0
    while i - n > 0:
        m = min(size, i - n)
        same = x[i - n - m : i - n] == x[j - n - m : j - n]
        if not same.all():
            return n + int(same[::-1].argmin())
        n += m
        size = min(2 * size, 1 << 16)
    return n


def _primes(q: int) -> list[int]:
    out, d = [], 2
    while d * d <= q:
        if q % d == 0:
            out.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return out + [q] * (q > 1)


def runs_of(documents: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, in order of start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    ids: dict[bytes, int] = {}
    sizes = np.array([len(d) for d in documents], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    words = [i for k, d in enumerate(documents) for i in (*[ids.setdefault(w, len(ids)) for w in d], -1 - k)]  # each end is a word of its own
    x = np.array(words, np.int64)
    n, size = len(x), max(1, (min_length + 1) // 2)
    if n < min_length:
        return out
    owner = np.repeat(np.arange(len(documents)), sizes + 1)
    codes = _gram_hashes(x.view(np.uint64), size)
    at = np.arange(len(codes))
    cover_end, cover_period = np.zeros(n, np.int64), np.ones(n, np.int64)
    low = 1
    while len(at):
        mine = codes[at]
        order = np.lexsort((at, mine, owner[at]))
        at, mine = at[order], mine[order]
        same = np.flatnonzero((mine[1:] == mine[:-1]) & (owner[at[1:]] == owner[at[:-1]]))
        again = np.zeros(len(at), bool)
        again[same] = again[same + 1] = True
        fresh = np.ones(len(at), bool)
        fresh[same + 1] = False
        group = np.cumsum(fresh)[again]
        at = at[again]
        if not len(at):
            break
        place, lag = _seed_pairs(at, group, size, low, 2 * size, n)
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        open_ = (place + lag + size > cover_end[place]) | (lag % cover_period[place] != 0)
        now, covered = 0, 0
        for i, q in zip(place[open_].tolist(), lag[open_].tolist(), strict=True):
            if q != now:
                now, covered = q, 0
            if i < covered:
                continue
            after = _equal_from(x, i, i + q)
            start = i - _equal_before(x, i, i + q)
            covered = i + after + 1
            length = i + after - start + q
            if length < max(min_length, 2 * q) or any((x[start : start + q] == x[start + q // r : start + q + q // r]).all() for r in _primes(q)):
                continue
            doc = int(owner[start])
            out[doc].append((start - int(first[doc]), length, q))
            end = start + length
            longer = np.flatnonzero(cover_end[start:end] < end) + start
            cover_end[longer], cover_period[longer] = end, q
        # of the next level: what comes again and is followed by what comes again
        at = np.sort(at)
        known = np.zeros(n + size, bool)
        known[at] = True
        at = at[known[at + size]]
        longer_codes = np.zeros(len(codes), np.uint64)
        longer_codes[at] = _joined(codes[at], codes[at + size])
        codes, low, size = longer_codes, 2 * size, 2 * size
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    gone = np.cumsum(edges[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, id_col: str | None = None,
              change: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Columns ``row`` (the document), ``runs`` (start, length, period; by start, then period) and ``collapsed_text``.

    Words are what white space parts, numbered from 0; a null or empty text has none
    and no run. ``collapsed_text`` has the words that stay, joined by a space, when each run
    keeps its first period. ``change``, with ``id_col``, makes other words of a row's id
    and words before. Rows are judged each on their own, repeated rows too. Works on
    an empty table.
    """

    def fn(texts: pa.Array, keys: pa.Array | None = None) -> list[pa.Array]:
        runs, kept, held, size = [], [], [], 0

        def flush() -> None:
            for words, found in zip(held, runs_of(held, min_length), strict=True):
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                kept.append(b" ".join(collapsed(words, found)))

        for i, text in enumerate(as_bytes(texts)):
            words = text.split()
            held.append(change(keys[i].as_py(), words) if change else words)
            size += len(held[-1])
            if size >= _WORDS:
                flush()
                held, size = [], 0
        flush()
        return [pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())]

    fields = "runs array<struct<start:long,length:long,period:long>>, collapsed_text string"
    return with_results(docs, [text_col, *([id_col] if change else [])], fields, fn)


def longest(runs: F.Column) -> F.Column:
    """The run of greatest length; of those the first start, then the least period. Null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    return F.when(F.size(runs) > 0, F.struct((-best["before"]).alias("start"), best["length"].alias("length"), (-best["shorter"]).alias("period")))
