"""Embedding near-dedup over an inverted multi-index (operator 10).

Vectors are scaled to length 1 and cut into two halves.  Each half has its own
codebook; the pair of nearest codes is the vector's cell in a product grid, one
grid per label.  A vector is stored in its cell and queries cells in the order
of their distance: of the rank pairs (i, j) of nearest codes in either half
only those with (i + 1) (j + 1) <= T can be among the T nearest cells, and of
these the T smallest distance sums are visited.  T is the number of cells after
which ``TARGET`` of sample vectors have met a neighbour made at exactly the
threshold.  A pair counts if either of its vectors visits the cell of the
other.  Pairs that meet are verified by their cosine in double precision.

The codebooks and T come from at most ``SAMPLE`` vectors; every vector is
indexed.  Equal vectors are one point with a weight, so copies make no pairs.

Defined results: a vector that is NULL, empty, zero or holds a NULL or
non-finite component, and one without a label, links with nothing; vectors of
unequal length do not link; repeated rows link with each other; a NULL id is
never the least of a component that has others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.cells import Connected, query_tiles
from strata.llm.common import cut
from strata.llm.components import components

THRESHOLD, TARGET = 0.98, 0.99
SAMPLE, CELL, MAX_CODES, CAP = 4096, 2048, 128, 2048
STRIP = 256


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)  # so that the squares neither vanish nor overflow
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)


def codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Lloyd's k-means from random rows."""
    rng = np.random.default_rng(seed)
    codes = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, codes).argmin(1)
        sums = np.zeros_like(codes)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        codes[n > 0] = sums[n > 0] / n[n > 0, None]
    return codes


@dataclass
class MultiIndex:
    """The codebooks of both halves, and how many cells a query visits."""

    first: np.ndarray
    second: np.ndarray
    visits: int

    @classmethod
    def fit(cls, sample: np.ndarray, k: int, threshold: float = THRESHOLD, target: float = TARGET, seed: int = 3) -> MultiIndex:
        x = unit(sample)
        k = max(1, min(k, len(x)))
        half = x.shape[1] // 2
        index = cls(codebook(x[:, :half], k, seed=seed), codebook(x[:, half:], k, seed=seed + 1), k * k)
        rng = np.random.default_rng(seed)
        ranks = []
        for _ in range(2):
            side = rng.normal(size=x.shape)
            side = unit(side - (side * x).sum(1, keepdims=True) * x) if x.shape[1] > 1 else side * 0
            home = index.cells(threshold * x + math.sqrt(1 - threshold**2) * side, 1)[:, 0]
            order = index.cells(x, min(k * k, 512))
            hit = order == home[:, None]
            ranks.append(np.where(hit.any(1), hit.argmax(1) + 1, k * k))
        index.visits = int(np.quantile(np.concatenate(ranks), target, method="higher"))
        return index

    def cells(self, x: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` cells nearest to each row, nearest first."""
        k = len(self.first)
        half = x.shape[1] // 2
        a, b = _distances(x[:, :half], self.first), _distances(x[:, half:], self.second)
        oa, ob = np.argsort(a, 1, kind="stable")[:, :count], np.argsort(b, 1, kind="stable")[:, :count]
        a, b = np.take_along_axis(a, oa, 1), np.take_along_axis(b, ob, 1)
        pairs = np.array([(i, j) for i in range(min(k, count)) for j in range(min(k, count // (i + 1)))])
        sums = a[:, pairs[:, 0]] + b[:, pairs[:, 1]]
        best = np.argsort(sums, 1, kind="stable")[:, :count]
        i, j = pairs[best, 0], pairs[best, 1]
        return np.take_along_axis(oa, i, 1) * k + np.take_along_axis(ob, j, 1)


def _matrix(vectors: pa.Array) -> list[np.ndarray]:
    return [np.array(v, np.float64) for v in vectors.to_pylist()]


def _place(indexes: dict[int, MultiIndex]):
    """Rows (label, dim, cell, query, ...) for the home cell and for every visited cell; an unknown length is one cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["vkey", "label", "weight"]).to_pandas()
            vectors = _matrix(batch.column("vector"))
            dims = np.array([len(v) for v in vectors])
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = unit(np.stack([vectors[i] for i in at]))
                index = indexes.get(dim)
                cells = index.cells(x, index.visits) if index else np.zeros((len(at), 1), np.int64)
                n, t = cells.shape
                payload = [r.tobytes() for r in x]
                seen = [r.tobytes() for r in np.sort(cells, 1).astype(np.int32)]
                part = rows.iloc[at]
                stored = pd.DataFrame({"label": part["label"].to_numpy(), "dim": dim, "cell": cells[:, 0], "query": False, "vkey": part["vkey"].to_numpy(),
                                       "weight": part["weight"].to_numpy(), "home": cells[:, 0], "unit": payload, "seen": seen})
                asked = stored.iloc[np.repeat(np.arange(n), t)].assign(cell=cells.ravel(), query=True, seen=b"")
                yield pa.RecordBatch.from_pandas(pd.concat([stored, asked]), schema=_PLACED, preserve_index=False)
    return run


_PLACED = pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("cell", pa.int64()), ("query", pa.bool_()), ("vkey", pa.int64()),
                     ("weight", pa.int64()), ("home", pa.int64()), ("unit", pa.binary()), ("seen", pa.binary())])
_PLACED_DDL = "label bigint, dim int, cell bigint, query boolean, vkey bigint, weight bigint, home bigint, unit binary, seen binary"


def _tile(threshold: float):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        is_query = tile["query"].to_numpy()
        s, q = tile[~is_query], tile[is_query]
        if not len(s) or not len(q):
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        dim = int(tile["dim"].iat[0])
        xs = np.frombuffer(b"".join(s["unit"]), np.float64).reshape(-1, dim)
        xq = np.frombuffer(b"".join(q["unit"]), np.float64).reshape(-1, dim)
        seen = np.frombuffer(b"".join(s["seen"]), np.int32).reshape(len(s), -1)
        ks, kq = s["vkey"].to_numpy(), q["vkey"].to_numpy()
        ws, wq, home = s["weight"].to_numpy(), q["weight"].to_numpy(), q["home"].to_numpy()
        got_q, got_s = np.zeros(len(q), np.int64), np.zeros(len(s), np.int64)
        keys, code = np.unique(np.concatenate([kq, ks]), return_inverse=True)
        known = Connected(len(keys))
        for a in range(0, len(q), STRIP):
            i, j = np.nonzero((xq[a : a + STRIP] @ xs.T >= threshold) & (kq[a : a + STRIP, None] != ks))
            i += a
            got_q += np.bincount(i, ws[j], len(q)).astype(np.int64)
            # The stored vector meets this one again as a query, unless it does not visit this one's cell.
            once = ~(seen[j] == home[i][:, None]).any(1)
            got_s += np.bincount(j[once], wq[i[once]], len(s)).astype(np.int64)
            known.link(code[i], code[len(q) + j])
        root = known.root
        links = np.bincount(code, np.concatenate([got_q, got_s]), len(keys)).astype(np.int64)
        out = np.flatnonzero((links > 0) | (root != np.arange(len(keys))))
        return pd.DataFrame({"node": keys[out], "links": links[out], "root": keys[root[out]]})
    return run


def link_vectors(rows: DataFrame, vector: str = "embedding", label: str = "label", key: str = "vec_id",
                 threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of ``rows``."""
    base = rows.select(F.col(key).alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"))
    base = base.withColumn("ok", usable(F.col("vector"), F.col("label")))
    points = cut(base.filter("ok").groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
                 .withColumn("vkey", F.monotonically_increasing_id()), "vectors")
    n = points.count()
    sample = points.select("vector").orderBy(F.xxhash64(F.lit("sample"), "vkey"), "vkey").limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r[0]), []).append(r[0])
    codes = min(MAX_CODES, math.ceil(math.sqrt(n / CELL)))
    indexes = {d: MultiIndex.fit(np.array(v), codes, threshold, target) for d, v in by_dim.items() if len(v) >= 64}
    placed = points.select("vkey", "label", "weight", "vector").mapInArrow(_place(indexes), _PLACED_DDL)
    tiles = query_tiles(placed, ["label", "dim", "cell"], ["vkey"], CAP)
    met = cut(tiles.groupBy("label", "dim", "cell", "ti", "tj").applyInPandas(_tile(threshold), "node bigint, links bigint, root bigint"), "links")
    found = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    known = (points.select("vkey", "label", "vector", "weight", "least")
             .join(counts.withColumnRenamed("node", "vkey"), "vkey", "left").join(found.withColumnRenamed("node", "vkey"), "vkey", "left")
             .withColumn("root", F.coalesce("root", "vkey")))
    known = cut(known, "vector-roots")
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = cut(known.join(least, "root").select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component"),
                "vector-components")
    out = base.filter("ok").join(known, ["label", "vector"]).select("id", "n_links", F.col("component").alias("component_id"))
    alone = base.filter("not ok").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(F.col("id").alias(key), "n_links", "component_id",
                                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
