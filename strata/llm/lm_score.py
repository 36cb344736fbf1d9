"""Language-model scoring by deleted interpolation (operator 8).

Tokens are words (ASCII letters lowered, ASCII white space between them) and
one end token per text.  A token's probability mixes three estimates: how often
its context, the token before, was followed by it; how often it occurs at all;
and a uniform one.  The mixture weights depend on the frequency of the context
(one set per power of two) and are learned by expectation-maximisation on
held-out counts: every training token is scored with its own occurrence deleted
from all counts.

How counts reach the tokens: texts are read in blocks.  A block asks for the
counts of its distinct words and word pairs only, as sorted 64-bit keys; keys
are dealt into ranges, each range adds up what all blocks contribute and
answers every block in the order of its question.  A word that makes up a third
of all tokens is one key per block.  The texts themselves, as token ids, are
sent only once, to where the answers to their block arrive: the input is read
in two branches that cut it into the same blocks, which a checksum per block
verifies.  The EM sees a table of rounded log
estimates whose size is fixed; everything counted covers all texts.

Defined results: a NULL text is an empty one, which is just its end token;
without training texts every probability is 1 over 1, score 0; repeated rows
count as often as they occur and score alike; a NULL id is scored under a NULL
id, in the fold of the empty id.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, shuffle_partitions
from strata.llm.tokens import distinct, groups
from strata.session import ship_package

END, START = b"\n", b"\n\n"  # no word holds white space
BLOCK_CHARS = 1 << 22
#: Bits of a pair's key that are sent: two of n pairs share a key with a chance of n^2 / 2^57.
PAIR_BITS = 56
#: Context buckets by power of two; steps per octave and size of the table of log estimates.
BUCKETS, STEPS_2, GRID_2, STEPS_1, GRID_1 = 20, 4, 96, 4, 192
ROUNDS, LEAST_WEIGHT = 60, 1e-6

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * _A + (second ^ (second >> np.uint64(29))) * _B
    x ^= x >> np.uint64(32)
    x *= _C
    return x ^ (x >> np.uint64(29))


def _pack(values: np.ndarray) -> bytes:
    """Bytes of an integer array, all lowest bytes first and all highest last, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def _unpack(data: bytes, kind=np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def tokenize(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()  # bytes: only ASCII is lowered and only ASCII white space splits
    words.append(END)
    return words


class Block:
    """Texts as ids of distinct tokens; ids are ranks among the sorted 64-bit keys of the block's words."""

    def __init__(self, doc_ids: list, held_out: np.ndarray, sizes: np.ndarray, ids: np.ndarray, keys: np.ndarray):
        self.doc_ids, self.held_out, self.sizes, self.ids, self.keys = doc_ids, held_out, sizes, ids, keys

    @classmethod
    def read(cls, doc_ids: list, held_out: np.ndarray, texts: list) -> Block:
        lists = [tokenize(t) for t in texts]
        codes, names = distinct([w for x in lists for w in x])
        hashes = np.array([_hash(w) for w in names], np.uint64)
        keys, rank = np.unique(hashes, return_inverse=True)
        return cls(doc_ids, held_out, np.array([len(x) for x in lists], np.int64), rank[codes].astype(np.uint32), keys)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context ids of the distinct pairs in key order, which pair each token is, the pairs' keys); START is the id after the last."""
        n = len(self.keys)
        before = np.empty(len(self.ids), np.int64)
        before[1:] = self.ids[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = n
        code = before * n + self.ids
        distinct, which = np.unique(code, return_inverse=True)
        context, word = distinct // n, distinct % n
        keys = pair_keys(np.append(self.keys, np.uint64(_hash(START)))[context], self.keys[word])
        keys >>= np.uint64(64 - PAIR_BITS)
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return context[order], rank[which], keys[order]

    def check(self) -> int:
        return xxhash.xxh64_intdigest(self.keys.tobytes() + self.sizes.tobytes()) >> 1

    def dump(self) -> bytes:
        """The block in bytes; ids as ranks by frequency, whose upper bytes are mostly 0, and keys as steps."""
        by_count = np.argsort(-np.bincount(self.ids, minlength=len(self.keys)), kind="stable").astype(np.uint32)
        rank = np.empty_like(by_count)
        rank[by_count] = np.arange(len(by_count), dtype=np.uint32)
        return pickle.dumps((self.doc_ids, self.held_out, self.sizes, _pack(rank[self.ids]), _pack(by_count),
                             _pack(np.diff(self.keys, prepend=np.uint64(0)))))

    @classmethod
    def load(cls, data: bytes) -> Block:
        doc_ids, held_out, sizes, ranks, by_count, steps = pickle.loads(data)
        ids = _unpack(by_count, np.uint32)[_unpack(ranks, np.uint32)]
        return cls(doc_ids, held_out, sizes, ids, np.cumsum(_unpack(steps), dtype=np.uint64))


_ASKED = pa.schema([("dest", pa.int32()), ("block", pa.int64()), ("check", pa.int64()), ("words", pa.binary()), ("word_n", pa.binary()),
                    ("pairs", pa.binary()), ("pair_n", pa.binary())])
_ASKED_DDL = "dest int, block bigint, check bigint, words binary, word_n binary, pairs binary, pair_n binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    """(number, block) of one partition's texts; a partition read again gives the same blocks."""
    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        ids, held, texts = (batch.column(i).to_pylist() for i in range(3))
        for part in groups(texts, BLOCK_CHARS):
            yield number, Block.read(ids[part], np.array(held[part], bool), texts[part])
            number += 1


def _ask(ranges: int):
    """Per block and key range one row with the block's keys and training counts."""
    word_edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    pair_edges = np.array([(i << PAIR_BITS) // ranges for i in range(1, ranges)], np.uint64)

    def steps(keys: np.ndarray) -> bytes:
        return _pack(np.diff(keys, prepend=np.uint64(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b in _blocks(batches):
            _, which, pair_key = b.pairs()
            train = np.repeat(~b.held_out, b.sizes)
            word_n = np.bincount(b.ids[train], minlength=len(b.keys)).astype(np.uint64)
            pair_n = np.bincount(which[train], minlength=len(pair_key)).astype(np.uint64)
            w, p = (np.concatenate([[0], np.searchsorted(k, e), [len(k)]]) for k, e in ((b.keys, word_edges), (pair_key, pair_edges)))
            rows = []
            for r in range(ranges):
                ws, ps = slice(w[r], w[r + 1]), slice(p[r], p[r + 1])
                rows.append((r, number, b.check(), steps(b.keys[ws]), _pack(word_n[ws]), steps(pair_key[ps]), _pack(pair_n[ps])))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ASKED)], schema=_ASKED)
    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block one row with its texts."""
    for number, b in _blocks(batches):
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([b.check()], pa.int64()), pa.array([b.dump()], pa.binary())],
                                         ["block", "check", "texts"])


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """For one key range: the total counts, per block in the order of its keys; the range's own totals as a block of negative number."""
    totals, n_tokens, n_words = {}, 0, 0
    for key, count in (("words", "word_n"), ("pairs", "pair_n")):
        keys = [np.cumsum(_unpack(x), dtype=np.uint64) for x in asked[key]]
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros(len(distinct), np.uint64)
        np.add.at(sums, which, np.concatenate([_unpack(x) for x in asked[count]]))
        if key == "words":
            n_tokens, n_words = int(sums.sum()), int((sums > 0).sum())
        at = np.cumsum([0, *map(len, keys)])
        totals[key] = [_pack(sums[which[a:b]]) for a, b in zip(at[:-1], at[1:])]
    out = pd.DataFrame({"block": asked["block"], "check": asked["check"], "dest": asked["dest"], "word_n": totals["words"], "pair_n": totals["pairs"],
                        "n_tokens": 0, "n_words": 0})
    own = pd.DataFrame({"block": [-1 - int(asked["dest"].iat[0])], "check": [0], "dest": [0], "word_n": [b""], "pair_n": [b""],
                        "n_tokens": [n_tokens], "n_words": [n_words]})
    return pd.concat([out, own])


_ANSWER_DDL = "block bigint, check bigint, dest int, word_n binary, pair_n binary, n_tokens bigint, n_words bigint"


def bucket(context_n: np.ndarray) -> np.ndarray:
    """0 for a context that was never seen, then one per power of two."""
    return np.where(context_n > 0, 1 + np.minimum(np.log2(np.maximum(context_n, 1)).astype(np.int64), BUCKETS - 2), 0)


def _counts(b: Block, word_n: np.ndarray, pair_n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: how often its word, its pair and its context occur in training; the start of a text occurs as often as the end."""
    context, which, _ = b.pairs()
    end = word_n[np.searchsorted(b.keys, np.uint64(_hash(END)))] if len(b.keys) else np.uint64(0)
    context_n = np.append(word_n, end)[context]
    return word_n[b.ids].astype(np.int64), pair_n[which].astype(np.int64), context_n[which].astype(np.int64)


def _join(told: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
    """One block: its texts and counts in one row, with its table of estimates that leave out the token itself."""
    if len(told) and told["block"].iat[0] < 0:  # the totals of a range
        return told[["n_tokens", "n_words"]].head(1).assign(texts=None, word_n=None, pair_n=None, table=[[]])[_JOINED]
    if len(kept) != 1 or not len(told) or (told["check"] != kept["check"].iat[0]).any():
        raise RuntimeError("the two branches did not cut the input into the same blocks; give score() a stored table")
    told, texts = told.sort_values("dest"), kept["texts"].iat[0]
    word_n, pair_n = (np.concatenate([_unpack(x) for x in told[c]]) for c in ("word_n", "pair_n"))
    b = Block.load(texts)
    train = np.repeat(~b.held_out, b.sizes)
    w, p, c = (x[train] - 1 for x in _counts(b, word_n, pair_n))
    two = np.where(p > 0, 1 + np.minimum((-np.log2(np.maximum(p, 1) / np.maximum(c, 1)) * STEPS_2).round(), GRID_2 - 2), 0).astype(np.int64)
    one = np.where(w > 0, 1 + np.minimum((np.log2(np.maximum(w, 1)) * STEPS_1).round(), GRID_1 - 2), 0).astype(np.int64)
    cell, n = np.unique((bucket(c) * GRID_2 + two) * GRID_1 + one, return_counts=True)
    table = [{"cell": x, "n": y} for x, y in zip(cell.tolist(), n.tolist())]
    return pd.DataFrame({"texts": [texts], "word_n": [_pack(word_n)], "pair_n": [_pack(pair_n)], "n_tokens": [0], "n_words": [0], "table": [table]})


_JOINED = ["texts", "word_n", "pair_n", "n_tokens", "n_words", "table"]
_JOIN_DDL = "texts binary, word_n binary, pair_n binary, n_tokens bigint, n_words bigint, table array<struct<cell:bigint,n:bigint>>"


def learn_weights(cell: np.ndarray, n: np.ndarray, n_tokens: int, n_words: int) -> np.ndarray:
    """Weights (bucket x [pair, word, uniform]) by EM on the table of held-out estimates.

    A bucket without tokens takes the weights of all buckets together; unseen
    contexts give the pair estimate no weight; without training tokens all weight
    is the uniform one's.
    """
    if n_tokens == 0:
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    one, rest = cell % GRID_1, cell // GRID_1
    two, b = rest % GRID_2, rest // GRID_2
    probs = np.stack([np.where(two > 0, 2.0 ** (-(two - 1) / STEPS_2), 0), np.where(one > 0, 2.0 ** ((one - 1) / STEPS_1) / max(1, n_tokens - 1), 0),
                      np.full(len(cell), 1 / (n_words + 1))], 1)

    def fit(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        w = start
        for _ in range(ROUNDS if len(rows) else 0):
            share = probs[rows] * w
            share /= share.sum(1, keepdims=True)
            w = (share * n[rows, None]).sum(0) / n[rows].sum()
        w = np.where(start > 0, np.maximum(w, LEAST_WEIGHT), 0)
        return w / w.sum()

    everywhere = fit(np.flatnonzero(b > 0), np.full(3, 1 / 3))
    unseen = np.array([0, everywhere[1], everywhere[2]])
    out = [fit(np.flatnonzero(b == 0), unseen / unseen.sum())]
    return np.stack(out + [fit(np.flatnonzero(b == k), everywhere) for k in range(1, BUCKETS)])


def _score(weights: np.ndarray, n_tokens: int, n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, word_n, pair_n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                b = Block.load(data)
                w, p, c = _counts(b, _unpack(word_n), _unpack(pair_n))
                mix = weights[bucket(c)]
                prob = mix[:, 0] * (p / np.maximum(c, 1)) + mix[:, 1] * (w / max(1, n_tokens)) + mix[:, 2] / (n_words + 1)
                base = np.log10((w + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
                at = np.cumsum(b.sizes) - b.sizes
                yield pa.RecordBatch.from_arrays([
                    pa.array(b.doc_ids, pa.int64()), pa.array(b.held_out), pa.array(b.sizes, pa.int64()),
                    pa.array(np.add.reduceat((w > 0).astype(np.int64), at), pa.int64()), pa.array(np.full(len(at), n_tokens), pa.int64()),
                    pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(np.log10(prob), at))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per text: log10 probabilities under the mixture (score) and under the add-0.5 unigram model (base_score).

    ``docs`` is a stored table, or a narrow projection of one.
    """
    ship_package(docs.sparkSession)
    ranges = 4 * shuffle_partitions(docs.sparkSession)
    read = docs.select(F.col(key).cast("bigint"), held_out, F.col(text))
    told = read.mapInArrow(_ask(ranges), _ASKED_DDL).groupBy("dest").applyInPandas(_answer, _ANSWER_DDL)
    kept = read.mapInArrow(_keep, "block bigint, check bigint, texts binary")
    ready = cut(told.groupBy("block").cogroup(kept.groupBy("block")).applyInPandas(_join, _JOIN_DDL), "lm-blocks")
    n_tokens, n_words = ready.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    # At most BUCKETS * GRID_2 * GRID_1 rows, whatever the corpus.
    table = ready.select(F.explode("table").alias("t")).groupBy("t.cell").agg(F.sum("t.n")).collect()
    cells = np.array([tuple(r) for r in table], np.int64).reshape(-1, 2)
    weights = learn_weights(cells[:, 0], cells[:, 1], n_tokens, n_words)
    return (ready.filter("texts is not null").select("texts", "word_n", "pair_n")
            .mapInArrow(_score(weights, n_tokens, n_words),
                        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"))
