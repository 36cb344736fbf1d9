"""Benchmark decontamination by spaced seeds (operator 6).

Each fixed mask picks six of nine to thirteen consecutive words and ignores the rest,
so a replaced word leaves some seed around it whole.  Seeds of the benchmark
are hashed into a sorted index; seeds of every position of every document are
looked up in it.  Each hit names a document, an item and an alignment; along
that alignment the longest stretch is found that keeps at least ``IDENTITY`` of
its words, and it counts when it covers ``MIN_WORDS`` words or the whole item
if that is shorter.

Items of fewer than ``SHORT`` words overlap as a whole or not at all, so they have masks of
their own length: each leaves out as many of the item's words as ``IDENTITY`` lets be
replaced, and one of them misses whichever those are.  Items of fewer than ``LEAST_ITEM``
words hold no shingle of five words; they are no evidence and are never matched.

With these masks no overlap of up to 30 words is missed, whichever words are replaced (a
test enumerates them up to 25).

Defined results: a NULL or empty text, and one without words, is clean; a NULL
item text is skipped; repeated items are each reported under their own id, a
repeated row of one item once; an empty benchmark leaves all documents clean;
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import add_columns
from strata.llm.tokens import groups, hashed_words

# Fixed masks: 1 a word that must be equal, 0 one that is ignored.  Of any 13 words with two replaced, any 15 with three,
# any 20 with four and so on, at least one mask at one place has none of the replaced ones.
MASKS = ("111110001", "101001111", "1100011011", "111001101", "1100000010111")
SHORT = 13
MIN_WORDS, IDENTITY, LEAST_ITEM = 13, 0.8, 5
#: Words of benchmark items per block: each block is one pass and one broadcast of a bounded size.
BLOCK_WORDS = 1 << 20

MATCH = "array<struct<item_id:bigint,start:int,stop:int,same:int>>"
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def masks_of(n: int) -> tuple[str, ...]:
    """The masks of an item of ``n`` words.

    Up to 9 words one may be replaced: each mask ignores one place.  Of 10 to
    12 two may be: the item is cut into four blocks, and each mask keeps two of them.
    """
    if n >= SHORT:
        return MASKS
    if n < 10:
        return tuple("1" * i + "0" + "1" * (n - 1 - i) for i in range(n))
    block = [4 * i // n for i in range(n)]
    return tuple("".join("1" if b in kept else "0" for b in block) for kept in combinations(range(4), 2))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each position at which the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, len(mask), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h += words[k : k + n] * _FACTORS[k]
    h ^= h >> np.uint64(29)
    h *= _FACTORS[63]
    return h ^ (h >> np.uint64(32))


@dataclass
class Index:
    """Benchmark items of one block: their words, and per mask the sorted seeds with item and position."""

    ids: list = field(default_factory=list)
    items: list = field(default_factory=list)
    by_mask: dict = field(default_factory=dict)

    def add(self, item_id, words: np.ndarray) -> None:
        if len(words) >= LEAST_ITEM:
            self.ids.append(item_id)
            self.items.append(words)

    def build(self) -> Index:
        raw: dict[str, list] = {}
        for i, words in enumerate(self.items):
            for mask in masks_of(len(words)):
                h = seeds(words, mask)
                raw.setdefault(mask, []).append((h, np.full(len(h), i), np.arange(len(h))))
        for mask, parts in raw.items():
            h, item, pos = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            h = h[order]
            seen = np.zeros(1 << 20, bool)
            seen[h >> np.uint64(44)] = True
            self.by_mask[mask] = (h, item[order], pos[order], seen)
        return self


def longest_stretch(same: np.ndarray) -> tuple[int, int]:
    """The longest stretch of which at least IDENTITY is the same.

    With whole-number scores such a stretch is one whose sum is not negative:
    it ends where the running sum is no lower than at its start.  The earliest
    start for each end is the first place at which the running minimum is as low.
    """
    up = round(1000 * (1 - IDENTITY))
    run = np.concatenate([[0], np.cumsum(np.where(same, up, up - 1000))])
    start = np.searchsorted(-np.minimum.accumulate(run), -run, "left")
    stop = int(np.argmax(np.arange(len(run)) - start))
    return int(start[stop]), stop


def lookup(index: Index, words: np.ndarray, starts: np.ndarray) -> list[set]:
    """For each text the (item id, start, stop, same words) of its verified overlaps."""
    found: list[set] = [set() for _ in range(len(starts) - 1)]
    checked = set()
    for mask, (known, item, pos, seen) in index.by_mask.items():
        h = seeds(words, mask)
        at = np.flatnonzero(seen[h >> np.uint64(44)])
        lo = np.searchsorted(known, h[at], "left")
        hi = np.searchsorted(known, h[at], "right")
        at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
        doc = np.searchsorted(starts, at, "right") - 1
        inside = at + len(mask) <= starts[doc + 1]
        for p, a, b, d in zip(at[inside], lo[inside], hi[inside], doc[inside]):
            for k in range(a, b):
                shift = int(p - pos[k])
                if (int(d), int(item[k]), shift) in checked:
                    continue
                checked.add((int(d), int(item[k]), shift))
                w = index.items[item[k]]
                first, last = max(shift, int(starts[d])), min(shift + len(w), int(starts[d + 1]))
                same = words[first:last] == w[first - shift : last - shift]
                s, e = longest_stretch(same)
                if e - s >= min(MIN_WORDS, len(w)):
                    base = first - int(starts[d])
                    found[d].add((index.ids[item[k]], base + s, base + e, int(same[s:e].sum())))
    return found


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark in blocks of bounded size, read partition by partition."""
    index, size = Index(), 0
    for row in benchmark.filter("text is not null").select(F.col("item_id").cast("bigint"), "text").distinct().toLocalIterator():
        words, _ = hashed_words([row[1]])
        index.add(row[0], words)
        size += len(words)
        if size >= BLOCK_WORDS:
            yield index.build()
            index, size = Index(), 0
    yield index.build()


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``matches``: the verified overlaps of each text with benchmark items (words from 0, end exclusive)."""
    sc = docs.sparkSession.sparkContext
    out = docs.withColumn("matches", F.array().cast(MATCH))
    for index in _blocks(benchmark):
        shared = sc.broadcast(index)

        def find(texts: pa.Array, earlier: pa.Array, shared=shared) -> list[pa.Array]:
            texts, found = texts.to_pylist(), []
            for part in groups(texts):
                found += lookup(shared.value, *hashed_words(texts[part]))
            rows = [[*old, *(dict(zip(("item_id", "start", "stop", "same"), x)) for x in sorted(new))]
                    for old, new in zip(earlier.to_pylist(), found)]
            return [pa.array(rows, earlier.type)]
        out = add_columns(out, [text, "matches"], f"matches {MATCH}", find)
    return out
