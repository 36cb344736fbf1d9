"""Word arrays for the operators that work on words inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
#: Characters of text that a task turns into words at a time; only bounds memory.
GROUP_CHARS = 1 << 21


def groups(texts: Sequence, budget: int = GROUP_CHARS) -> Iterator[slice]:
    """Consecutive slices of ``texts`` of about ``budget`` characters (a longer text is a slice of its own)."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t) if t is not None else 0
        if held >= budget:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def distinct(words: Sequence) -> tuple[np.ndarray, list]:
    """(codes, names): for each word its index among the distinct ones, and these in order of appearance.

    A dictionary, since pandas' hash table ends strings at a NUL character.
    """
    index = dict.fromkeys(words)
    for i, w in enumerate(index):
        index[w] = i
    return np.fromiter(map(index.__getitem__, words), np.int64, len(words)), list(index)


def word_hashes(words: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """(codes, hashes): for each word its index among the distinct ones, and their XXH64."""
    codes, names = distinct(words)
    return codes, np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in names), np.uint64, len(names))


def hashed_words(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts in a row, and where each text starts (one entry more)."""
    lists = [WORD.findall(t.lower()) if t else [] for t in texts]
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    codes, hashes = word_hashes([w for x in lists for w in x])
    return hashes[codes] if len(codes) else np.zeros(0, np.uint64), starts
