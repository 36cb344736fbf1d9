"""Exact dedup, periodic runs and whitening against brute force, and their odd cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import exact_dedup, periodic, queries, whitening

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string"


# --- exact dedup --------------------------------------------------------------

def brute_groups(rows):
    """Multiset of (doc_id, keep_id, group_size, kept, text_sha256) as the operator defines them."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def got_groups(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_exact_dedup_of_the_table(spark, documents):
    assert got_groups(queries.op11_exact_dedup(spark, SF)) == brute_groups([(d.doc_id, d.text) for d in documents])


def test_exact_dedup_odd_rows(spark, odd, empty):
    assert got_groups(exact_dedup.dedup_texts(odd)) == brute_groups([(r.doc_id, r.text) for r in odd.collect()])
    assert exact_dedup.dedup_texts(empty).count() == 0
    assert exact_dedup.dedup_texts(odd).columns == ["doc_id", "lang", "source", "n_chars", *exact_dedup.MADE]


def test_exact_dedup_white_space_and_near_copies(spark):
    long = " ".join(f"w{i * i % 997}" for i in range(5000))
    texts = [long, long.replace(" ", "\t\n", 40), " " + long, long + "x", long + " ", "x" * 30_000, "x" * 30_001, "x" * 8192 + " " + "x" * 100, "x" * 8292,
             "a b", "a  b", "a b", "a\u0085b", "A b", "😀" * 9000, "😀" * 9000 + " ", None, "", " ", "\x1c", "r " * 3000, "r " * 3001]
    rows = list(enumerate(texts)) * 2
    assert got_groups(exact_dedup.dedup_texts(spark.createDataFrame(rows, DOC))) == brute_groups(rows)


def test_identifiers_that_clash_are_replaced(spark):
    """With a digest of two bits the chunks clash; the next digest serves, and results are the same."""
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(4)).cast("string").cast("binary")
    rows = [(i, f"text {i % 7} " * (1 + i % 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, DOC)
    assert exact_dedup.verified_digest(docs, "text", [weak, exact_dedup.DIGESTS[0]]) is exact_dedup.DIGESTS[0]
    assert got_groups(exact_dedup.dedup_texts(docs, digests=[weak, *exact_dedup.DIGESTS])) == brute_groups(rows)
    with pytest.raises(ValueError, match="digest"):
        exact_dedup.verified_digest(docs, "text", [weak])


def test_chunks_are_the_text_and_realign_after_an_insertion(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(500)}" for _ in range(4000)]
    texts = {"a": " ".join(words), "b": " ".join([*words[:100], "new", "words", *words[100:]])}
    rows = exact_dedup.chunked(spark.createDataFrame(list(texts.items()), "k string, text string"), "text").collect()
    parts = {r.k: r["__xd_parts"] for r in rows}
    for k, t in texts.items():
        assert "".join(parts[k]) == t + " "
        assert all(exact_dedup.LEAST <= len(p.split()) <= exact_dedup.MOST for p in parts[k][:-1])
    assert len(set(parts["a"]) & set(parts["b"])) >= len(set(parts["a"])) - 3


def test_exact_dedup_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "a", 10, "x", True, [1]), (2, "a ", 20, "y", False, [2])],
                                 "doc_id bigint, text string, chunk int, recipe string, kept boolean, `part.x` array<int>")
    out = exact_dedup.dedup_texts(docs)
    assert out.columns == ["doc_id", "chunk", "recipe", "part.x", *exact_dedup.MADE]
    assert sorted((r.doc_id, r.chunk, r.recipe, r["part.x"], r.keep_id, r.kept) for r in out.collect()) == [
        (1, 10, "x", [1], 1, True), (2, 20, "y", [2], 2, True)]  # "a " ends in a space, "a" does not


def test_a_hot_text_is_split(spark):
    """A third of all rows are one text: the join on recipes can split them, as both sides are written tables."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.col("id").cast("string")).alias("text"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.01",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = exact_dedup.dedup_texts(docs.repartition(8))
        assert out.filter("group_size = 2000").count() == 2000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- periodic runs ---------------------------------------------------------------

def brute_runs(x):
    """(start, length, period) by looking at every place for every period."""
    found = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapsed(x, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(x) if i not in gone)


def periodic_words(rng):
    n, letters = rng.choice([0, 1, 5, 6, 7, 24, 60, 250]), rng.choice([1, 2, 3, 30])
    x = [str(rng.randrange(letters)) for _ in range(n)]
    if n > 8 and rng.random() < 0.7:
        p, a = rng.randrange(1, n // 4 + 1), rng.randrange(n)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.4:
            x[rng.randrange(n)] = "other"
    return x


def test_runs_against_brute_force():
    rng = random.Random(11)
    for _ in range(150):
        texts = [periodic_words(rng) for _ in range(rng.choice([1, 4, 9]))]
        runs, per_text, collapsed, counts = periodic._group([" ".join(x) for x in texts])
        runs, at = [tuple(r) for r in runs.tolist()], 0
        for x, n, c, k in zip(texts, per_text, collapsed, counts):
            want = brute_runs(x)
            assert runs[at : at + n] == want and c == brute_collapsed(x, want) and k == len(x)
            at += n


def test_common_extensions_against_brute_force():
    rng = np.random.default_rng(5)
    for n, letters in ((1, 1), (40, 1), (200, 2), (300, 40)):
        row = np.append(rng.integers(0, letters, n), letters)
        index = periodic.CommonExtension(row)
        i = np.repeat(np.arange(n), n)
        j = np.tile(np.arange(n), n)
        i, j = i[i < j], j[i < j]
        got = index(i, j)
        for a, b, c in zip(i.tolist(), j.tolist(), got.tolist()):
            assert (row[a : a + c] == row[b : b + c]).all() and row[a + c] != row[b + c]


def test_the_cover_is_a_cover():
    assert (periodic.cover_steps() >= 0).all()


def test_periodic_portions_do_not_matter(monkeypatch):
    x = ("a b c d " * 50 + "x " * 30 + "q r s t u v w " * 20).split()
    want = brute_runs(x)
    monkeypatch.setattr(periodic, "PAIRS", 3)
    assert [tuple(r) for r in periodic._group([" ".join(x)])[0].tolist()] == want


def rewritten(doc_id, text):
    x = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return x
    h, n = zlib.crc32(str(doc_id).encode()), len(x)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    return x


def test_periodic_query_of_the_whole_table(spark, documents):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(documents)
    some = 0
    for d in documents:
        x = rewritten(d.doc_id, d.text)
        runs = brute_runs(x)
        some += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (math.floor(1000 * best[1] / best[2]) if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(x, runs).encode()).hexdigest()
    assert some >= 10


def test_periodic_odd_rows(spark, odd, empty):
    for r in periodic.periodic_runs(queries.rewritten(odd.select("doc_id", "text", "lang"))).collect():
        x = (r.text or "").encode().split()
        runs = brute_runs(x) if len(x) < 5000 else None
        assert r.n_words == len(x)
        if runs is not None:
            assert [tuple(s) for s in r.runs] == runs
    assert periodic.periodic_runs(empty).count() == 0
    named = spark.createDataFrame([(1, "a a a a a a", 5, "old")], "doc_id bigint, text string, runs int, collapsed string")
    r = periodic.periodic_runs(named).first()
    assert [tuple(s) for s in r.runs] == [(0, 6, 1)] and r.collapsed == "a" and r.text == "a a a a a a"


# --- whitening -----------------------------------------------------------------------

def matrices():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 30):
        a = rng.normal(size=(n, n))
        q, _ = np.linalg.qr(a)
        near = np.ones(n)
        near[: n // 2] = 4 + 1e-12 * np.arange(n // 2)
        yield a @ a.T
        yield np.eye(n) * 3
        yield np.zeros((n, n))
        yield (lambda v: (v + v.T) / 2)(q @ np.diag(near) @ q.T)
        yield np.diag(rng.normal(size=n) ** 2)
        yield np.outer(a[0], a[0]) * 1e-9


@pytest.mark.parametrize("v", list(matrices()))
def test_leading_components(v):
    k = min(8, len(v))
    values, vectors = whitening.leading_components(v, 8)
    size = max(np.abs(v).max(), 1e-300)
    assert values.shape == (k,) and vectors.shape == (k, len(v))
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1][:k]).max() / size < 1e-13
    assert np.abs(vectors @ v - values[:, None] * vectors).max() / size < 1e-12
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-13


def reference(e):
    x = np.floor(np.array(e, np.float64) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    y = x - s / n
    w, u = np.linalg.eigh(y.T @ y / n)
    w, u = w[::-1][:8], u[:, ::-1][:, :8]
    return n, ((n * x - s) ** 2).sum(1), y @ u / np.sqrt(w), w / np.trace(y.T @ y / n)


def test_whitening_query_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, whitened, explained = reference([r.embedding for r in rows])
    out = queries.op13_embedding_whitening(spark, SF).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in out] == [(r.vec_id, c) for r in rows for c in range(1, 9)]
    assert {r.n for r in out} == {n} and [r.deviation for r in out[::8]] == deviation.tolist()
    got = np.array([r.whitened for r in out]).reshape(-1, 8)
    sign = np.sign((got * whitened).sum(0))
    assert np.abs(got - whitened * sign).max() < 1e-9
    assert np.abs(np.array([r.explained for r in out[:8]]) / explained - 1).max() < 1e-9
    assert max(r.identity_error for r in out) < 1e-9


VEC = "vec_id bigint, embedding array<float>, whitened string, dim int"


def test_whitening_odd_vectors(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(50, 3)).tolist()
    rows = [(i, v, "own", 7) for i, v in enumerate(good)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [1.0, None, 2.0], [nan, 1.0, 1.0], [1.0, inf, 0.0], [-inf, 0.0, 0.0]]
    rows += [(100 + i, v, "own", 7) for i, v in enumerate(bad)]
    rows += [(200, [], "own", 7), (201, [0.5], "own", 7), (202, [0.5], None, None), (None, good[0], "own", 7), (None, good[0], "own", 7)]
    out = whitening.whiten(spark.createDataFrame(rows, VEC))
    assert out.columns == ["vec_id", "dim", *whitening.MADE]
    got = out.collect()
    assert len(got) == len(rows) - len(bad)
    n, deviation, whitened, _ = reference(np.array([*good, good[0], good[0]], np.float32))
    three = {r.vec_id: r for r in got if len(r.whitened) == 3}
    assert {r.fit_rows for r in three.values()} == {n} == {52}
    assert [three[i].deviation for i in range(50)] == deviation[:50].tolist()
    w = np.array([three[i].whitened for i in range(50)])
    assert np.abs(np.abs(w) - np.abs(whitened[:50])).max() < 1e-9
    one = {r.vec_id: r for r in got if r.vec_id in (200, 201, 202)}
    assert one[200].whitened == [] and one[200].deviation == 0 and one[200].identity_error is None
    assert one[201].whitened == [None] and one[201].deviation == 0 and one[201].fit_rows == 2 and one[201].explained == [None]
    assert whitening.whiten(spark.createDataFrame([], VEC)).count() == 0


def test_whitening_extreme_entries(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, -3.0])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert all(r.deviation is None for r in got.values() if r.vec_id < 3)
    assert all(math.isfinite(c) for r in got.values() for c in r.whitened if c is not None)


def test_exact_deviations_beyond_machine_words():
    model = whitening.Model(3_000_000, [3_000_000 * 100_000 + 1, 3_000_000 * 100_000 - 7], np.ones(2), np.eye(2), 2.0)
    x = np.array([[100_300, 99_800], [100_000, 100_000], [101_100, 100_000]])
    want = [sum((model.n * c - s) ** 2 for c, s in zip(r, model.sums)) for r in x.tolist()]
    assert model.deviations(x) == [w if w < 2**63 else None for w in want]
    assert want[1] == 50 and want[2] >= 2**63 > want[0] > 2**62 // 8


def test_models_in_portions(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=1 + i % 5).tolist()) for i in range(60)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = {r.vec_id: r for r in whitening.whiten(docs).collect()}
    monkeypatch.setattr(whitening, "MODEL_BYTES", 1)
    parts = {r.vec_id: r for r in whitening.whiten(docs).collect()}
    assert parts.keys() == whole.keys() and len(whole) == 60
    assert all(parts[i].deviation == whole[i].deviation and np.allclose(parts[i].whitened, whole[i].whitened) for i in whole)


def test_moments_merge_to_those_of_all_rows():
    rng = np.random.default_rng(6)
    x = rng.integers(99_000, 101_000, (500, 6))
    whole, part = whitening.Moments.of(x), None
    for a in range(0, 500, 70):
        m = whitening.Moments.of(x[a : a + 70])
        part = m if part is None else part.merged(m)
    assert (part.n, part.sums) == (whole.n, whole.sums)
    assert np.allclose(part.products, whole.products, rtol=1e-12)
