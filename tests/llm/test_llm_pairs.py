"""Operators on pairs: SimHash near-dedup and embedding near-dedup, against all pairs."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import cells, components, embed_dedup, queries, simhash

SF = "/root/testdata/sf0.001"


def brute_components(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("edges", [
    [], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 200)], [(i, (7 * i + 3) % 101) for i in range(101)], [(5, 5), (6, 7), (7, 6)],
])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(df).collect()}
    real = [(a, b) for a, b in edges if a != b]
    want = brute_components(300, real)
    assert set(got) == {x for e in real for x in e}
    groups, other = defaultdict(set), defaultdict(set)
    for x, r in got.items():
        groups[r].add(x)
        other[want[x]].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, other.values()))


def test_roots():
    rng = np.random.default_rng(0)
    i, j = rng.integers(0, 500, (2, 300))
    got = cells.roots(i, j, 500)
    want = brute_components(500, zip(i.tolist(), j.tolist()))
    least = {}
    for x, r in enumerate(want):
        least.setdefault(r, x)
    assert got.tolist() == [least[r] for r in want]


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", lowered) if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(documents):
    texts = [r.text for r in documents] + [None, "", " \x0b\x0c", "One", "a b c", "A b C d", "é\xa0É x\x1cy z w v", "a a a a a a"]
    assert [int(x) for x in simhash.fingerprints(texts)] == [plain_fingerprint(t) for t in texts]


def planted(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, np.uint64, endpoint=True) * np.uint64(2) + rng.integers(0, 2, n, np.uint64)
    out = [base]
    for flips in range(1, 7):
        x = base[rng.integers(0, n, 150)].copy()
        for k in range(len(x)):
            for b in rng.choice(64, flips, replace=False):
                x[k] ^= np.uint64(1) << np.uint64(b)
        out.append(x)
    center = np.uint64(0x0123456789ABCDEF)  # a dense group: one leaf, many tiles
    dense = np.full(700, center)
    for k in range(len(dense)):
        for b in rng.choice(64, int(rng.integers(0, 6)), replace=False):
            dense[k] ^= np.uint64(1) << np.uint64(b)
    return np.unique(np.concatenate([*out, dense, np.array([0, 1, 15, 31], np.uint64)]))


@pytest.mark.parametrize("leaf", [4096, 128])
def test_all_links_are_found(spark, leaf):
    fps = planted()
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    want = brute_components(len(fps), zip(i.tolist(), j.tolist()))
    edges = simhash.links(df, leaf=leaf).collect()
    at = {int(x): k for k, x in enumerate(fps.view(np.int64))}
    got = brute_components(len(fps), [(at[r.a], at[r.b]) for r in edges])
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_op5_is_brute_force(spark, documents):
    out = {r.doc_id: r for r in queries.op5_simhash_dedup(spark, SF).collect()}
    ids = [r.doc_id for r in documents]
    fps = np.array([plain_fingerprint(r.text) for r in documents], np.uint64)
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    root = brute_components(len(ids), zip(i.tolist(), j.tolist()))
    least = defaultdict(lambda: 1 << 60)
    for d, r in zip(ids, root):
        least[r] = min(least[r], d)
    for d, f, r in zip(ids, fps, root):
        assert (out[d].fingerprint, out[d].component_id) == (f"{int(f):016x}", least[r])


def test_simhash_odd_rows(spark, odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by[i].component_id for i in (1, 2, 3)} == {1} and by[1].fingerprint == "0" * 16
    assert by[5].component_id == by[6].component_id == 5
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == ["1", "None"]
    kept = simhash.keep_one(odd.withColumn("fp", F.lit("mine"))).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "4", "5", "7", "8", "9", "None"] and {r.fp for r in kept} == {"mine"}
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).columns == empty.columns


# --- embeddings -------------------------------------------------------------

EMB = "vec_id bigint, embedding array<float>, label int"


def brute_links(rows, threshold=0.98):
    ok = [i for i, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    pairs = []
    for a, i in enumerate(ok):
        x = np.array(rows[i][1], np.float32).astype(float)
        for j in ok[a + 1 :]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                y = np.array(rows[j][1], np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    pairs.append((i, j))
    return pairs


def near_vectors(seed=0, n=400, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).tolist(), int(rng.integers(0, 3))) for i in range(n)]
    for i in range(n, n + 300):
        src = rows[int(rng.integers(0, n))]
        rows.append((i, (np.array(src[1]) * rng.uniform(0.5, 2) + rng.normal(size=dim) * rng.uniform(0, 0.3)).tolist(), src[2]))
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(20)]
    return rows


def check_links(rows, out, pairs, recall):
    n_links = np.zeros(len(rows), int)
    for i, j in pairs:
        n_links[i] += 1
        n_links[j] += 1
    got = np.array([out[r[0]].n_links for r in rows])
    assert (got <= n_links).all() and got.sum() >= recall * n_links.sum()
    return got.sum() == n_links.sum()


def test_embedding_links(spark, monkeypatch):
    rows = near_vectors()
    pairs = brute_links(rows)
    for cell in (embed_dedup.CELL, 16):
        monkeypatch.setattr(embed_dedup, "CELL", cell)
        out = {r.vec_id: r for r in embed_dedup.link_vectors(spark.createDataFrame(rows, EMB)).collect()}
        whole = check_links(rows, out, pairs, 0.97)
        assert cell == 16 or whole
        if whole:
            root = brute_components(len(rows), pairs)
            least = {}
            for r, k in zip(rows, root):
                least[k] = min(least.get(k, r[0]), r[0])
            assert all(out[r[0]].component_id == least[k] and out[r[0]].kept == (r[0] == least[k]) for r, k in zip(rows, root))


def test_large_cell_is_tiled(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CAP", 64)
    rows = near_vectors(3)
    out = {r.vec_id: r for r in embed_dedup.link_vectors(spark.createDataFrame(rows, EMB)).collect()}
    assert check_links(rows, out, brute_links(rows), 1.0)


def test_cells_come_nearest_first():
    rng = np.random.default_rng(2)
    index = embed_dedup.MultiIndex.fit(rng.normal(size=(500, 8)), 9)
    x = embed_dedup.unit(rng.normal(size=(50, 8)))
    got = index.cells(x, 20)
    full = embed_dedup._distances(x[:, :4], index.first)[:, :, None] + embed_dedup._distances(x[:, 4:], index.second)[:, None, :]
    want = np.sort(full.reshape(50, -1), 1)[:, :20]
    assert np.allclose(np.take_along_axis(full.reshape(50, -1), got, 1), want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, nan], 1), (5, [1.0, nan], 1), (6, [1.0, None], 1), (7, [inf, 1.0], 1),
            (8, [1.0, 0.0], None), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [2.0, -0.0], 1), (12, [1.0, 0.0], 2),
            (13, [1.0, 0.0, 0.0], 1), (None, [1e-30, 0.0], 1), (14, [3e38, 0.0], 2)]
    out = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.link_vectors(spark.createDataFrame(rows, EMB).withColumn("weight", F.lit(1))).collect()]
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 13)]
    want = [*alone, (10, 3, 10, True), (10, 3, 10, True), (11, 3, 10, False), (None, 3, 10, False), (12, 1, 12, True), (14, 1, 12, False)]
    assert sorted(map(str, out)) == sorted(map(str, want))
    assert embed_dedup.link_vectors(spark.createDataFrame([], EMB)).count() == 0
