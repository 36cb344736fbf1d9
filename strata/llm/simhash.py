"""SimHash near-dedup over vantage-point trees (operator 5).

Fingerprint: ASCII letters lowered, words between ASCII white space, shingles
of ``SHINGLE`` words (a shorter text is one shingle), XXH64 of each, and a bit
is 1 when it is set in more than half of the hashes.  A text without words has
fingerprint 0.

Links at ``distance`` or fewer bits are found exactly.  The 64 bits are cut
into ``BLOCKS`` blocks; two linked fingerprints differ by at most
``distance // BLOCKS`` = r bits in one of them.  Over each block stands a
vantage-point tree: at a level with vantage point v and radius m a fingerprint
is inside (d <= m) or outside (d > m).  By the triangle inequality a neighbour
of an outside fingerprint can be inside only if d <= m + r, and then the
fingerprint visits the inside branch too.  Two linked fingerprints therefore
meet in the leaf that is inside wherever either of them is.  The vantage points
of a level are shared by its nodes, so a leaf is a string of bits, and the
depth grows with the number of fingerprints, so that a leaf keeps about
``LEAF`` visitors.  In a leaf, fingerprints are ordered by distance from the
zero point, and the triangle inequality again limits which are compared.

The radii are medians over at most ``SAMPLE`` fingerprints; they decide the
balance of the tree, never the result.

Defined results: a NULL or empty text has fingerprint 0 and links to others of
its kind; repeated rows share a component; a NULL doc_id does not name a
component unless all its members are NULL; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.cells import Connected, pair_tiles
from strata.llm.common import add_columns, aside, cut
from strata.llm.components import components
from strata.llm.tokens import groups

SHINGLE, DISTANCE, BLOCKS = 4, 4, 3
LEAF, SAMPLE, MAX_DEPTH = 4096, 4096, 20
#: Pairs compared at a time inside a tile.
STRIP_PAIRS = 1 << 20


def shingle_hashes(text: str | None, k: int = SHINGLE) -> list[int]:
    words = (text or "").encode().lower().split()  # bytes: only ASCII is lowered and only ASCII white space splits
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < k:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], 42) for a, b in zip([0, *ends], ends[k - 1 :])]


def fingerprints(texts: list[str | None], k: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    out = np.zeros(len(texts), np.uint64)
    for part in groups(texts):
        lists = [shingle_hashes(t, k) for t in texts[part]]
        sizes = np.array([len(x) for x in lists], np.uint64)
        real = np.flatnonzero(sizes)
        if not len(real):
            continue
        flat = np.array([h for x in lists for h in x], np.uint64)
        n = sizes[real]
        starts = (np.cumsum(n) - n).astype(np.int64)
        bits = np.zeros(len(real), np.uint64)
        for b in range(32):  # two counters, 32 bits apart, in one word
            both = np.add.reduceat((flat >> np.uint64(b)) & np.uint64(0x0000000100000001), starts)
            low, high = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
            bits |= (2 * low > n).astype(np.uint64) << np.uint64(b)
            bits |= (2 * high > n).astype(np.uint64) << np.uint64(b + 32)
        out[real + part.start] = bits
    return out


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` plus ``fp`` (the fingerprint's bits as a bigint)."""
    return add_columns(docs, [text], "fp bigint",
                       lambda t: [pa.array(fingerprints(t.to_pylist(), shingle).view(np.int64), pa.int64())])


class Forest:
    """A vantage-point tree over each block of bits."""

    def __init__(self, sample: np.ndarray, depth: int, distance: int = DISTANCE, blocks: int = BLOCKS, seed: int = 5):
        rng = np.random.default_rng(seed)
        edges = np.linspace(0, 64, blocks + 1).astype(int)
        self.depth, self.reach = depth, distance // blocks
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges, edges[1:])]
        self.vantage, self.radius = [], []
        for shift, mask in self.blocks:
            width = int(mask).bit_length()
            points: list[int] = []
            for _ in range(depth):  # the candidate most nearly at half the width from all points taken
                some = rng.integers(0, int(mask), 256, np.uint64, endpoint=True)
                far = [max((abs(2 * (int(c) ^ p).bit_count() - width) for p in points), default=0) for c in some]
                points.append(int(some[int(np.argmin(far))]))
            part = (sample >> shift) & mask
            self.vantage.append(points)
            self.radius.append([int(np.median(np.bitwise_count(part ^ np.uint64(p)))) if len(part) else width // 2 for p in points])

    def visits(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, block, leaf) of every leaf that every fingerprint visits."""
        out = []
        for b, (shift, mask) in enumerate(self.blocks):
            part = (fps >> shift) & mask
            row, leaf = np.arange(len(fps)), np.zeros(len(fps), np.int64)
            for level, (p, m) in enumerate(zip(self.vantage[b], self.radius[b])):
                d = np.bitwise_count(part ^ np.uint64(p)).astype(np.int64)[row]
                both = (d > m) & (d <= m + self.reach)  # outside, and a neighbour may be inside
                row, leaf = np.append(row, row[both]), np.append(leaf | ((d > m).astype(np.int64) << level), leaf[both])
            out.append((row, np.full(len(row), b), leaf))
        return tuple(np.concatenate(x) for x in zip(*out))


def linked_pairs(a: np.ndarray, b: np.ndarray | None, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a, into b) at ``distance`` or fewer bits, in portions; without ``b``, pairs inside a.

    Both sides are ordered by their number of set bits, that is their distance
    from zero, which differs by no more than ``distance`` between linked ones.
    """
    own = b is None
    b = a if own else b
    ca, cb = np.bitwise_count(a), np.bitwise_count(b)
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ca, cb, sa, sb = ca[oa].astype(np.int64), cb[ob].astype(np.int64), a[oa], b[ob]
    strip = max(16, STRIP_PAIRS // max(1, len(sb)))
    for s in range(0, len(sa), strip):
        e = min(s + strip, len(sa))
        lo = s if own else int(np.searchsorted(cb, ca[s] - distance, "left"))
        hi = int(np.searchsorted(cb, ca[e - 1] + distance, "right"))
        i, j = np.nonzero(np.bitwise_count(sa[s:e, None] ^ sb[None, lo:hi]) <= distance)
        yield oa[s + i], ob[lo + j]


def _tile(distance: int):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        fps = tile["fp"].to_numpy().view(np.uint64)
        ti, tj = tile["ti"].iat[0], tile["tj"].iat[0]
        known = Connected(len(fps))
        if ti == tj:
            for i, j in linked_pairs(fps, None, distance):
                known.link(i, j)
        else:
            one = np.flatnonzero(tile["chunk"].to_numpy() == ti)
            two = np.flatnonzero(tile["chunk"].to_numpy() == tj)
            for i, j in linked_pairs(fps[one], fps[two], distance):
                known.link(one[i], two[j])
        node = np.flatnonzero(known.root != np.arange(len(fps)))
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[node], "b": signed[known.root[node]]})
    return run


def links(fps: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints exactly as all links at ``distance`` or fewer bits do."""
    n = fps.count()
    sample = np.array([r[0] for r in fps.orderBy(F.xxhash64(F.lit("sample"), "fp"), "fp").limit(min(SAMPLE, n // 8)).collect()], np.int64).view(np.uint64)
    # A level halves the fingerprints of a leaf and lets about a sixth of them visit both branches.
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log(max(n, 1) / leaf) / math.log(2 / 1.17))))
    forest = Forest(sample, depth, distance)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            row, block, code = forest.visits(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(code, pa.int64()), pa.array(values[row], pa.int64())],
                                             ["block", "code", "fp"])

    visits = fps.select("fp").mapInArrow(route, "block int, code bigint, fp bigint")
    tiles = pair_tiles(visits, ["block", "code"], ["fp"], leaf)
    return tiles.groupBy("block", "code", "ti", "tj").applyInPandas(_tile(distance), "a bigint, b bigint")


def fingerprint_groups(marked: DataFrame, key: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of ``marked`` (key, fp)."""
    fps = cut(marked.groupBy("fp").agg(F.min(key).alias("least")), "fingerprints")
    found = components(links(fps.select("fp"), distance))
    known = fps.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = cut(known, "fingerprint-roots")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    return cut(known.join(least, "root").select("fp", "root", "component_id"), "fingerprint-groups")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``docs``."""
    marked = cut(with_fingerprint(docs.select(key, text), text, shingle).select(key, "fp"), "document-fingerprints")
    return (marked.join(fingerprint_groups(marked, key, distance), "fp")
            .select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs``, one of each component: that of least key (of equal keys, one with the least fingerprint, and one of these)."""
    docs, columns = aside(docs, ("fp",))
    marked = with_fingerprint(docs, text, shingle).withColumnRenamed("fp", "__sh_fp")
    # Row numbers are fixed once they are written.
    marked = cut(marked.withColumn("__sh_row", F.monotonically_increasing_id()), "documents-marked")
    thin = marked.select(key, F.col("__sh_fp").alias("fp"), "__sh_row")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "fp", F.col("__sh_row").alias("row"))
    first = thin.join(fingerprint_groups(thin, key, distance).select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("m"))
    # As many row numbers as documents: merged at every size, never broadcast.
    chosen = cut(first.select(F.col("m.row").alias("__sh_row")), "first-of-group").hint("merge")
    kept = marked.join(chosen, "__sh_row", "left_semi")
    return kept.select(*columns)
