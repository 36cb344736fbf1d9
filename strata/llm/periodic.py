"""Periodic run detection over the words of a text (operator 12).

A run is a stretch of words with smallest period q and at least
``max(LEAST, EXPONENT * q)`` words that no neighbouring word extends keeping
that period.  Rows are independent, so nothing is shuffled: tasks take texts in
groups of some megabytes, put their word numbers in one row with a separator of
its own after each text, and work on all texts of the group at once.

1. Harmonic grid: for each period q the words 0, (E-1) q, 2 (E-1) q, ... of a
   text are compared with those q later (E = ``EXPONENT``).  The places x of a
   run at which word x equals word x + q are at least (E-1) q in a row, so one
   of them is on the grid.  That is n ln n / (E-1) pairs in all.
2. A pair is extended both ways by its longest common extension (LCE).  Nearly
   all pairs differ within ``FEW`` words on both sides, and are done.
3. For texts with pairs that go on an LCE index is built, one forwards and one
   backwards: of all suffixes only those at places of a difference cover modulo
   13 are sorted (by their first 13 words, then by doubling along places 13
   apart), with the common lengths of neighbours in a sparse table for range
   minima.  Any two places reach two sampled ones after the same, at most 12,
   words; these are compared, and the table has the rest.
4. Stretches that are long enough are the runs.  One found for several periods
   has the smallest, which divides the others.

``collapsed`` is the text without the words that any run contains after its
first q ones, joined by one space.

Defined results: words are what stands between white space (space, tab to
carriage return); a NULL or empty text has no words and no run and collapses to
an empty text; other columns pass through, those named like an added one give
way; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import add_columns
from strata.llm.tokens import distinct, groups

#: A run has so many words at least, and so many periods.
LEAST, EXPONENT = 6, 4
#: Words on either side of a pair that are compared without an index.
FEW = 8
#: A difference cover: any two residues are those of two members plus one common step.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Pairs that a task holds at a time.
PAIRS = 1 << 21


def cover_steps(modulus: int = MODULUS, cover: Sequence[int] = COVER) -> np.ndarray:
    """For residues (i, j) the least step that takes both into the cover."""
    inside = np.isin(np.arange(2 * modulus) % modulus, cover)
    steps = np.full((modulus, modulus), -1)
    for i in range(modulus):
        for j in range(modulus):
            both = np.flatnonzero(inside[i : i + modulus] & inside[j : j + modulus])
            steps[i, j] = both[0]
    return steps


_STEPS = cover_steps()


def _refined(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order the ``tied`` samples of each rank by ``key``, in place; returns those that still tie.

    A rank is the number of samples that are surely smaller.
    """
    order = np.lexsort((key, rank[tied]))
    at, key = tied[order], key[order]
    old = rank[at]
    step = np.arange(len(at))
    new_old = np.concatenate([[True], old[1:] != old[:-1]])
    new_key = new_old | np.concatenate([[True], key[1:] != key[:-1]])
    first = np.maximum.accumulate(np.where(new_key, step, 0))
    rank[at] = old + first - np.maximum.accumulate(np.where(new_old, step, 0))
    size = np.diff(np.append(np.flatnonzero(new_key), len(at)))
    return at[np.repeat(size, size) > 1]


class CommonExtension:
    """Lengths of common extensions to the right of pairs of places in a row of numbers.

    No two places may agree up to the end of the row, which separators see to.
    """

    def __init__(self, row: np.ndarray):
        n = len(row)
        # Past the end stand numbers that occur once.
        self.row = s = np.concatenate([row, row.max(initial=0) + 1 + np.arange(2 * MODULUS)]).astype(np.int64)
        sampled = np.isin(np.arange(n + MODULUS) % MODULUS, COVER)
        places = np.flatnonzero(sampled)
        self.sample = np.full(len(s), -1)
        self.sample[places] = np.arange(len(places))
        rank = np.zeros(len(places), np.int64)
        tied = np.arange(len(places))
        for t in range(MODULUS):
            if len(tied):
                tied = _refined(rank, tied, s[places[tied] + t])
        levels = [rank.copy()]
        while len(tied):
            ahead = self.sample[places[tied] + (MODULUS << (len(levels) - 1))]
            tied = _refined(rank, tied, rank[ahead])  # all keys are read before any rank changes
            levels.append(rank.copy())
        self.rank = rank
        order = np.empty(len(places), np.int64)
        order[rank] = np.arange(len(places))
        common = np.zeros(len(places), np.int64)
        a, b = places[order[:-1]], places[order[1:]]
        got = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = levels[level][self.sample[a]] == levels[level][self.sample[b]]
            step = np.where(same, MODULUS << level, 0)
            a, b, got = a + step, b + step, got + step
        going = np.arange(len(a))
        for _ in range(MODULUS):
            going = going[s[a[going]] == s[b[going]]]
            a[going] += 1
            b[going] += 1
            got[going] += 1
        common[1:] = got
        self.least = [common]
        while (1 << len(self.least)) <= len(common):
            last, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        steps = _STEPS[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        going = np.arange(len(i))
        for t in range(MODULUS):
            here = going[steps[going] > t]
            equal = self.row[i[here] + t] == self.row[j[here] + t]
            out[here[equal]] += 1
            going = here[equal]
        done = np.flatnonzero(out == steps)
        a, b = self.rank[self.sample[i[done] + steps[done]]], self.rank[self.sample[j[done] + steps[done]]]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = level == k
            out[done[at]] += np.minimum(self.least[k][low[at]], self.least[k][high[at] - (1 << k) + 1])
        return out


def grid(starts: np.ndarray, counts: np.ndarray):
    """Portions of (place, period): the harmonic grid of texts that start at ``starts`` and have ``counts`` words."""
    periods = np.where(counts >= LEAST, counts // EXPONENT, 0)
    text = np.repeat(np.arange(len(counts)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    pace = (EXPONENT - 1) * q
    points = -(-(counts[text] - q) // pace)
    ends = np.cumsum(points)
    a = 0
    while a < len(q):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
        n = points[a:b]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[text[a:b]], n) + nth * np.repeat(pace[a:b], n), np.repeat(q[a:b], n)
        a = b


def _near(row: np.ndarray, i: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common extensions of (i, i + q) to the right, and to the left before them, of up to ``FEW`` words each."""
    n = len(row)
    out = []
    for step, first in ((1, 0), (-1, -1)):
        got, going = np.zeros(len(i), np.int64), np.arange(len(i))
        for t in range(FEW):
            a = i[going] + first + step * t
            inside = (a >= 0) & (a + q[going] < n)
            a, going = a[inside], going[inside]
            going = going[row[a] == row[a + q[going]]]
            got[going] += 1
        out.append(got)
    return out[0], out[1]


def _long_enough(right: np.ndarray, left: np.ndarray, q: np.ndarray) -> np.ndarray:
    return right + left + q >= np.maximum(LEAST, EXPONENT * q)


def find_runs(row: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), sorted, of the runs of texts laid out in ``row`` with a unique number after each."""
    found, far_i, far_q = [], [], []
    for i, q in grid(starts, counts):
        hit = row[i] == row[i + q]
        i, q = i[hit], q[hit]
        right, left = _near(row, i, q)
        near = (right < FEW) & (left < FEW)
        ok = near & _long_enough(right, left, q)
        found.append(np.stack([i[ok] - left[ok], i[ok] + q[ok] + right[ok], q[ok]], 1))
        far_i.append(i[~near])
        far_q.append(q[~near])
    if far_i and (total := sum(map(len, far_i))):
        i, q = np.concatenate(far_i), np.concatenate(far_q)
        # Only the texts that have such pairs are indexed.
        of = np.searchsorted(starts, i, "right") - 1
        texts = np.unique(of)
        sizes = counts[texts] + 1
        offset = np.cumsum(sizes) - sizes
        part = row[np.repeat(starts[texts] - offset, sizes) + np.arange(sizes.sum())]
        shift = (starts[texts] - offset)[np.searchsorted(texts, of)]
        right, left = CommonExtension(part), CommonExtension(part[::-1])
        for a in range(0, total, PAIRS):
            at, p, back = i[a : a + PAIRS] - shift[a : a + PAIRS], q[a : a + PAIRS], shift[a : a + PAIRS]
            r, l = right(at, at + p), left(len(part) - at - p, len(part) - at)
            ok = _long_enough(r, l, p)
            found.append(np.stack([(at + back - l)[ok], (at + back + p + r)[ok], p[ok]], 1))
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def _group(texts: Sequence[str | None]) -> tuple[np.ndarray, list[int], list[str], np.ndarray]:
    """(start, length, period) of all runs, their number per text, the collapsed texts and the word counts."""
    words = [t.encode().split() if t else [] for t in texts]  # bytes split at just this white space
    counts = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(counts + 1) - counts - 1
    codes, names = distinct([w for x in words for w in x])
    row = np.empty(len(codes) + len(words), np.int64)
    ends = starts + counts
    inside = np.ones(len(row), bool)
    inside[ends] = False
    row[inside], row[ends] = codes, len(names) + np.arange(len(words))
    runs = find_runs(row, starts, counts)
    gone = np.zeros(len(row) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    kept = np.cumsum(gone) == 0
    of = np.searchsorted(starts, runs[:, 0], "right") - 1
    per_text = np.bincount(of, minlength=len(words)).tolist()
    collapsed = [b" ".join(compress(x, kept[s : s + len(x)].tolist()) if n else x).decode()
                 for x, s, n in zip(words, starts.tolist(), per_text)]
    return np.stack([runs[:, 0] - starts[of], runs[:, 1] - runs[:, 0], runs[:, 2]], 1), per_text, collapsed, counts


def _columns(texts: pa.Array) -> list[pa.Array]:
    texts = texts.to_pylist()
    runs, per_text, collapsed, counts = [np.zeros((0, 3), np.int64)], [], [], [np.zeros(0, np.int64)]
    for part in groups(texts):
        r, n, c, k = _group(texts[part])
        runs.append(r)
        per_text += n
        collapsed += c
        counts.append(k)
    all_runs = np.concatenate(runs)
    offsets = np.zeros(len(per_text) + 1, np.int32)
    np.cumsum(per_text, out=offsets[1:])
    fields = pa.StructArray.from_arrays([pa.array(all_runs[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"])
    return [pa.array(np.concatenate(counts), pa.int64()), pa.ListArray.from_arrays(offsets, fields), pa.array(collapsed, pa.string())]


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, ``runs`` (start, length, period; by start, then period) and the ``collapsed`` text."""
    return add_columns(docs, [text], "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string", _columns)
