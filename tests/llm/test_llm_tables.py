"""Sharding, LM scoring and URL reputation against brute force; the pipeline's stages; oracles of this subpackage."""

from __future__ import annotations

import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from strata.llm import lm_score, queries, sharding, sp_codec, url_filter
from strata.session import scratch_dir
from tools.compare import canon

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string"


# --- sharding ---------------------------------------------------------------

def test_shards(spark, documents):
    out = {r.doc_id: r for r in queries.op7_sharding(spark, SF).collect()}
    assert len(out) == len(documents)
    load, places = Counter(), defaultdict(list)
    for d in documents:
        r, raw = out[d.doc_id], (d.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < 16
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    mean, largest = sum(load.values()) / 16, max(r.size for r in out.values())
    assert len(load) == 16 and max(load.values()) - min(load.values()) <= max(largest, 0.02 * mean)


def slot_frame(spark, sizes):
    return spark.createDataFrame([(i, b) for i, b in enumerate(sizes)], "vslot int, bytes bigint")


def test_balance_moves_little_and_evens_out(spark):
    rng = np.random.default_rng(0)
    sizes = rng.pareto(1.5, 4096).astype(int) * 100 + 50
    load, first = slot_frame(spark, sizes.tolist()), sharding.even_map(spark, 8)
    before = {r.vslot: r.shard for r in first.collect()}
    after = {r.vslot: r.shard for r in sharding.balance(first, load, 8).collect()}
    sums = np.bincount([after[i] for i in range(4096)], sizes, 8)
    assert sums.max() - sums.min() <= 60 and set(after) == set(before)
    moved = sum(sizes[i] for i in after if after[i] != before[i])
    old = np.bincount([before[i] for i in range(4096)], sizes, 8)
    assert moved <= np.maximum(0, old - old.mean()).sum() + 8 * sizes.max()
    again = {r.vslot: r.shard for r in sharding.balance(sharding.balance(first, load, 8), load, 8).collect()}
    assert sum(again[i] != after[i] for i in after) <= 16


def test_grow_moves_only_into_the_new_shard(spark):
    sizes = list(range(1, 4097))
    load, first = slot_frame(spark, sizes), sharding.even_map(spark, 4)
    before = {r.vslot: r.shard for r in first.collect()}
    after = {r.vslot: r.shard for r in sharding.grow(first, load, 4).collect()}
    assert all(after[i] in (before[i], 4) for i in before)
    new = sum(sizes[i] for i in after if after[i] == 4)
    assert 0.9 < new / (sum(sizes) / 5) <= 1.0


def test_map_versions(spark):
    path = scratch_dir(spark, "maps")
    sharding.store_map(sharding.even_map(spark, 4), path, 0)
    sharding.store_map(sharding.even_map(spark, 5), path, 1)
    assert {r.shard for r in sharding.read_map(spark, path, 0).collect()} == set(range(4))
    assert {r.shard for r in sharding.read_map(spark, path, 1).collect()} == set(range(5))


def write_docs(spark, df):
    path = scratch_dir(spark, "sf")
    df.write.parquet(f"{path}/documents.parquet")
    return path


def test_shards_of_odd_rows(spark, odd, empty):
    out = queries.op7_sharding(spark, write_docs(spark, odd.withColumn("shard", F.lit("x")))).collect()
    assert len(out) == 12 and [r.size for r in out if r.doc_id == 1] == [1] and [r.text_crc32 for r in out if r.doc_id == 1] == [0]
    assert queries.op7_sharding(spark, write_docs(spark, empty)).count() == 0


def test_hot_id_is_spread_over_shards(spark):
    rows = [(i, f"text number {i}") for i in range(2000)] + [(7, f"other text {i}") for i in range(1000)] + [(8, "the same row")] * 1000
    out = queries.op7_sharding(spark, write_docs(spark, spark.createDataFrame(rows, DOC))).collect()
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in out) == Counter((i, zlib.crc32(t.encode()), len(t) + 1) for i, t in rows)
    load, places = Counter(), defaultdict(list)
    for r in out:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert len(load) == 16 and max(load.values()) <= 1.05 * min(load.values())


# --- LM scoring -------------------------------------------------------------

def brute_lm(docs):
    tok = {i: [w for w in (t or "").encode().lower().split()] + [b"\n"] for i, t in docs}
    train = [i for i in tok if zlib.crc32(str(i).encode()) % 5 != 1]
    uni, bi = Counter(), Counter()
    for i in train:
        uni.update(tok[i])
        bi.update(zip([b"^", *tok[i]], tok[i]))
    uni[b"^"] = len(train)
    return tok, train, uni, bi


def table_of(train, tok, uni, bi):
    cells = Counter()
    for i in train:
        for h, w in zip([b"^", *tok[i]], tok[i]):
            c, p, u = uni[h] - 1, bi[h, w] - 1, uni[w] - 1
            two = 0 if p == 0 else 1 + min(round(-math.log2(p / c) * lm_score.STEPS_2), lm_score.GRID_2 - 2)
            one = 0 if u == 0 else 1 + min(round(math.log2(u) * lm_score.STEPS_1), lm_score.GRID_1 - 2)
            b = 0 if c == 0 else 1 + min(int(math.log2(c)), lm_score.BUCKETS - 2)
            cells[(b * lm_score.GRID_2 + two) * lm_score.GRID_1 + one] += 1
    return cells


def test_lm_is_brute_force(spark, documents):
    out = {r.doc_id: r for r in queries.op8_lm_scoring(spark, SF).collect()}
    docs = [(r.doc_id, r.text) for r in documents]
    tok, train, uni, bi = brute_lm(docs)
    n, v = sum(len(tok[i]) for i in train), len(uni) - 1
    cells = table_of(train, tok, uni, bi)
    w = lm_score.learn_weights(np.array(list(cells)), np.array(list(cells.values())), n, v)
    for i in tok:
        base = model = known = 0
        for h, x in zip([b"^", *tok[i]], tok[i]):
            c = uni[h]
            b = 0 if c == 0 else 1 + min(int(math.log2(c)), lm_score.BUCKETS - 2)
            base += math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1)))
            model += math.log10(w[b][0] * (bi[h, x] / c if c else 0) + w[b][1] * uni[x] / n + w[b][2] / (v + 1))
            known += uni[x] > 0
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i not in train, len(tok[i]), known, n)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and abs(r.score - model) < 1e-6 * abs(model)
    held = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_em_finds_the_mixture():
    rng = np.random.default_rng(0)
    two, one = rng.integers(1, 40, 4000), rng.integers(1, 60, 4000)
    p2, p1 = 2.0 ** (-(two - 1) / lm_score.STEPS_2), 2.0 ** ((one - 1) / lm_score.STEPS_1) / 99_999
    p = 0.6 * p2 + 0.3 * p1 + 0.1 / 5001
    cell = (3 * lm_score.GRID_2 + two) * lm_score.GRID_1 + one
    w = lm_score.learn_weights(cell, np.maximum(1, (1e6 * p).astype(int)), 100_000, 5000)
    assert np.allclose(w.sum(1), 1) and w[0][0] == 0 and (w[3] > 0).all()


def test_lm_odd_rows(spark, odd, empty):
    out = lm_score.score(odd.withColumn("score", F.lit(1)), F.lit(False)).collect()
    assert len(out) == 12 and all(r.score <= 0 and math.isfinite(r.score) for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 3)} == {1}
    untrained = lm_score.score(odd, F.lit(True)).collect()
    assert {(r.score, r.n_known, r.train_tokens) for r in untrained} == {(0.0, 0, 0)}
    assert lm_score.score(empty, F.lit(False)).count() == 0


# --- URLs -------------------------------------------------------------------

PAGES = [
    (1, "HTTP://WWW.Example.NET/EN/x"), (2, "http://a.example.net/en/y?z#q"), (3, "http://net/"), (4, "http://xnet/"), (5, "http://a.net"),
    (6, "//no.scheme/de/"), (7, None), (8, ""), (9, "x://y://z/w"), (10, "https://example.com/de/1"), (11, "https://m.example.com/de"),
    (12, "http://org/fr/"), (13, "http://ÄB.org/fr/é#"), (14, "http://h\nost.com/pa\nth?x"), (15, "http://notexample.com/de/"), (16, "http://a.net:80/"),
    (1, "HTTP://WWW.Example.NET/EN/x"),
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    return host, rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_parts_and_rules(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string")
    clash = ["rules", "mean", "n", "host", "best", "__own"]
    frame = url_filter.filter_urls(df.select("*", *[F.lit("mine").alias(c) for c in clash]), F.lit(None), queries.URL_RULES)
    assert frame.columns == ["page_id", "url", "rules", "best", "__own", *url_filter.MADE]
    out = frame.collect()
    assert len(out) == len(PAGES) and {r.rules for r in out} == {"mine"}
    for r in out:
        host, path = plain_parts(r.url)
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or "allow")


def test_reputation_shrinks_and_blocks(spark):
    rows = [(f"http://bad.spam.com/{i}", 1) for i in range(60)] + [(f"http://h{i % 20}.good.com/{i}", 0) for i in range(200)]
    rows += [("http://new.spam.com/", 1), ("http://new.good.com/", 1), ("http://other.com/", None)]
    df = spark.createDataFrame(rows, "url string, bad int")
    out = {r.host: r for r in url_filter.filter_urls(df, F.col("bad"), []).collect()}
    assert out["bad.spam.com"].verdict == "block" and out["h1.good.com"].verdict == "allow"
    assert out["new.good.com"].mean < out["new.spam.com"].mean  # the same single outcome under different domains
    assert out["new.good.com"].verdict == "allow" and out["other.com"].n == 0
    assert url_filter.filter_urls(df.limit(0), F.col("bad"), queries.URL_RULES).count() == 0


def test_the_bound_blocks_bad_hosts_and_no_others(spark):
    """Planted outcomes over the table's own hosts: hosts that are mostly bad are blocked, those at the common rate are not."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    pages = pages.withColumn("visit", F.explode(F.sequence(F.lit(0), F.lit(24))))
    host = url_filter.url_host(F.col("url"))
    planted = F.pmod(F.xxhash64(host), F.lit(7)) == 0
    bad = F.when(planted, 1).otherwise((F.col("visit") == 0).cast("int"))
    out = url_filter.filter_urls(pages.withColumn("planted", planted), bad, []).collect()
    sure = [r for r in out if r.planted]
    assert sure and all(r.verdict == "block" for r in sure)
    assert [r.host for r in out if r.verdict == "block" and not r.planted] == []


def skewed(spark, make):
    """Whether the join that ``make`` ends in splits a hot key, with the thresholds lowered."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.01",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = make()
        df.collect()
        return "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_hosts_blobs_chunks_and_passages_are_split(spark):
    from strata.llm import line_dedup, secret_scan

    rows = spark.range(9000).repartition(6)
    hot = F.col("id") % 3 == 0
    pages = rows.select(F.col("id").alias("page_id"), F.when(hot, "http://hot.com/").otherwise(F.concat(F.lit("http://h"), "id", F.lit(".net/"))).alias("url"))
    assert skewed(spark, lambda: url_filter.filter_urls(pages, F.lit(0), queries.URL_RULES))
    texts = rows.select(F.col("id").alias("doc_id"), F.when(hot, "token = abcdefghijklmnop").otherwise(F.concat(F.lit("token = abcdefghijkl"), "id")).alias("text"))
    assert skewed(spark, lambda: secret_scan.findings(texts, secret_scan.update_ledger(texts, scratch_dir(spark, "ledger"))))
    passage = "\n".join(f"line {i} of a passage that many texts share and that is long enough" for i in range(8))
    lines = rows.select(F.col("id").alias("doc_id"), F.when(hot, F.concat(F.lit(passage + "\n"), "id")).otherwise(
        F.concat("id", F.lit(" a\n"), "id", F.lit(" b\n"), "id", F.lit(" c"))).alias("text"))
    chunked = line_dedup.with_chunks(lines)
    assert skewed(spark, lambda: line_dedup.repeated_chunks(chunked))
    assert skewed(spark, lambda: line_dedup.repeated_lines(lines))


def test_levels(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("x.example.com:80",), ("localhost",), ("",), ("co.uk",)], "host string")
    d, s = url_filter.host_levels(F.col("host"))
    assert [(r.d, r.s) for r in df.select(d.alias("d"), s.alias("s")).collect()] == [
        ("b.co.uk", "co.uk"), ("example.com", "com"), ("localhost", "localhost"), ("", ""), ("co.uk", "co.uk")]


# --- oracles and pipeline ---------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLES[name])
    assert canon(df.columns, df.collect()) == canon([d[0] for d in res.description], res.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    seen = []
    for name, stage in P.STAGES:
        path = scratch_dir(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns[: len(cols)] == cols and (name == P.STAGES[-1][0] or docs.columns == cols)
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[0] >= 195 and seen[-1] > 100
    rows = docs.collect()
    voc = queries.vocabulary(spark)
    ids = np.concatenate([np.array(r.ids) for r in rows])
    assert sp_codec.decode(voc, ids, np.append(0, np.cumsum([len(r.ids) for r in rows]))) == [r.text for r in rows]
    assert all(r.n_chars == len(r.text) for r in rows)


def test_line_stage_removes_two_line_passages(spark):
    two = "\n".join(" ".join(f"w{i}{j}" for j in range(26)) for i in "ab")
    docs = spark.createDataFrame([(k, f"own head {k}\n{two}\nown tail {k}", 0) for k in range(8)], "doc_id bigint, text string, n_chars bigint")
    out = {r.doc_id: (r.text, r.n_chars) for r in P.line_dedup_stage(spark, docs, SF).collect()}
    assert two in out[0][0] and all(out[k] == (f"own head {k}\nown tail {k}", 21) for k in range(1, 8))


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_and_empty_tables(spark, odd, empty, k):
    made = ["score", "matches", "fp", "n_lines", "lang_pred"]
    docs = odd.withColumns({c: F.lit("mine") for c in made})
    out = P.STAGES[k][1](spark, docs, SF)
    rows = out.collect()
    assert out.columns[: len(docs.columns)] == docs.columns
    assert all(r[c] == "mine" for r in rows for c in made)
    none = P.STAGES[k][1](spark, empty, SF)
    assert none.count() == 0 and none.columns[:5] == empty.columns


def test_language_stage_keeps_documents_with_a_language(spark, odd):
    kept = sorted(str(r.doc_id) for r in P.language_id(spark, odd, SF).collect())
    assert kept == ["5", "5", "6", "7", "8", "9", "None"]
