"""Work inside cells of an index whose sizes differ by orders of magnitude.

A cell is worked on as a grid of tiles: its rows are dealt into chunks of about
``cap`` rows, and each pair of chunks is a tile of its own.  A cell that holds
a third of all rows thus becomes many tiles of bounded size, and every two rows
that must meet still do.  Inside a tile, links are reduced to a forest, so what
leaves it is a row per point, never a row per pair.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _chunk(salt: list[str], count: Column) -> Column:
    return F.pmod(F.xxhash64(*salt), count).cast("int")


def _upto(count: Column) -> Column:
    return F.sequence(F.lit(0), count - 1)


def _parts(rows: DataFrame, cell: list[str], counts: dict[str, Column], cap: int) -> DataFrame:
    """``rows`` plus, per name in ``counts``, how many chunks of ``cap`` its cell needs (1 for nearly all cells).

    Cells of one chunk are not in the joined table, so it is small next to the rows.
    """
    sizes = rows.groupBy(*cell).agg(*[c.alias(k) for k, c in counts.items()])
    large = sizes.filter(F.greatest(*counts, F.lit(0)) > cap)
    parts = large.select(*cell, *[F.greatest(F.ceil(F.col(k) / cap), F.lit(1)).cast("int").alias(k) for k in counts])
    return rows.join(parts, cell, "left").withColumns({k: F.coalesce(k, F.lit(1)) for k in counts})


def pair_tiles(rows: DataFrame, cell: list[str], salt: list[str], cap: int) -> DataFrame:
    """Tiles in which all rows of a cell meet each other: adds ``chunk`` and the tile's chunks ``ti`` <= ``tj``."""
    known = _parts(rows, cell, {"__n": F.count("*")}, cap).withColumn("chunk", _chunk(salt, F.col("__n")))
    return (known.withColumn("__o", F.explode(_upto(F.col("__n"))))
            .withColumns({"ti": F.least("chunk", "__o"), "tj": F.greatest("chunk", "__o")}).drop("__n", "__o")
            .repartition(*cell, "ti", "tj"))


def query_tiles(rows: DataFrame, cell: list[str], salt: list[str], cap: int, query: str = "query") -> DataFrame:
    """Tiles in which each query row of a cell meets each stored row: adds ``ti`` (stored chunk) and ``tj`` (query chunk)."""
    is_query = F.col(query)
    known = _parts(rows, cell, {"__s": F.count_if(~is_query), "__q": F.count_if(is_query)}, cap)
    s, q = F.col("__s"), F.col("__q")
    ti = F.when(is_query, _upto(s)).otherwise(F.array(_chunk(salt, s)))
    tj = F.when(is_query, F.array(_chunk(salt, q))).otherwise(_upto(q))
    return (known.withColumns({"__i": ti, "__j": tj}).withColumn("ti", F.explode("__i")).withColumn("tj", F.explode("__j"))
            .drop("__s", "__q", "__i", "__j").repartition(*cell, "ti", "tj"))


def roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` points the least point that links (i, j) connect it to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        new = new[root]
        if np.array_equal(new, root):
            return root
        root = new


class Connected:
    """Which of ``n`` points are connected, by links that arrive in portions; only one portion is held at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.root[i], self.root[j]
        apart = a != b
        if apart.any():
            self.root = roots(a[apart], b[apart], len(self.root))[self.root]
