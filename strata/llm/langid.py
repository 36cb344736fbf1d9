"""Language ID by a bidirectional gated recurrent network over bytes (operator 4).

The UTF-8 bytes of a text are read in windows of ``WINDOW`` bytes.  Two gated
recurrent units, one forward and one backward, give every byte position a
state; a softmax over the joined states labels the position; the document's
probabilities are the mean over all its positions.  The network is trained in
numpy by backpropagation through time on a bounded sample: ``DOCS_PER_LABEL``
labelled documents for every label that occurs, of each up to
``SAMPLE_CHARS`` characters from a place that its id's hash picks.  Prediction
reads whole texts.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0;
rows without a label are not trained on; without any labelled row all texts
are ``und``; equal texts get equal answers; other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import add_columns
from strata.llm.tokens import groups

HIDDEN, WINDOW = 8, 96
DOCS_PER_LABEL, SAMPLE_CHARS = 150, 384
STEPS, BATCH, RATE = 160, 192, 0.03
#: Windows that go through the network together.
WIDTH = 2048

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    m = _LETTER.search(text) if text else None
    return m is not None and (m[0].isalpha() or any(map(str.isalpha, text)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass
class Gru:
    """One direction: input rows per byte value for (update, reset, candidate), and recurrent weights."""

    inp: np.ndarray  # 256 x 3H
    rec: np.ndarray  # H x 3H

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Gru:
        h = HIDDEN
        inp = rng.normal(0, 0.3, (256, 3 * h))
        return cls(inp.astype(np.float32), rng.normal(0, h**-0.5, (h, 3 * h)).astype(np.float32))

    def run(self, steps: np.ndarray, keep: bool = False):
        """States (T x N x H) for byte values (T x N); with ``keep`` also what the backward pass needs."""
        t, n = steps.shape
        h = HIDDEN
        states = np.zeros((t + 1, n, h), self.inp.dtype)
        kept = []
        for i in range(t):
            x = self.inp[steps[i]]
            prev = states[i]
            u = prev @ self.rec
            gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
            np.subtract(prev, c, out=states[i + 1])
            states[i + 1] *= z
            states[i + 1] += c
            if keep:
                kept.append((z, r, c, u[:, 2 * h :]))
        return (states[1:], states, kept) if keep else states[1:]

    def back(self, steps: np.ndarray, states: np.ndarray, kept: list, dstates: np.ndarray):
        """Gradients (inp, rec) for the loss gradients ``dstates`` of every step's state."""
        h = HIDDEN
        dinp, drec = np.zeros_like(self.inp), np.zeros_like(self.rec)
        carry = np.zeros_like(dstates[0])
        for i in range(len(steps) - 1, -1, -1):
            z, r, c, un = kept[i]
            prev = states[i]
            d = dstates[i] + carry
            dz = d * (prev - c) * z * (1 - z)
            dc = d * (1 - z) * (1 - c * c)
            dr = dc * un * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], 1)
            du = np.concatenate([dz, dr, dc * r], 1)
            np.add.at(dinp, steps[i], dx)
            drec += prev.T @ du
            carry = d * z + du @ self.rec.T
        return dinp, drec


@dataclass
class Network:
    labels: list[str]
    forward: Gru
    backward: Gru
    out: np.ndarray  # 2H x L
    bias: np.ndarray
    trained_on: int = 0

    @classmethod
    def fresh(cls, labels: list[str], seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        return cls(labels, Gru.fresh(rng), Gru.fresh(rng),
                   rng.normal(0, 0.3, (2 * HIDDEN, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32))

    @staticmethod
    def flipped(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Index (T x N) that reverses each column's first ``length`` rows and leaves its padding in place."""
        at = np.arange(len(steps))[:, None]
        return np.where(at < lengths, lengths - 1 - at, at)

    def states(self, steps, lengths, keep=False):
        flip = self.flipped(steps, lengths)
        cols = np.arange(steps.shape[1])
        a, b = self.forward.run(steps, keep), self.backward.run(steps[flip, cols], keep)
        both = np.concatenate([a[0] if keep else a, (b[0] if keep else b)[flip, cols]], 2)
        return (both, a, b, flip) if keep else both

    def positions(self, steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Label probabilities of every position (T x N x L)."""
        logits = self.states(steps, lengths) @ self.out + self.bias
        logits -= logits.max(2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(2, keepdims=True)
        return logits

    def loss(self, steps, lengths, target):
        """Mean cross-entropy over positions, and the gradients of (forward, backward, out, bias)."""
        both, a, b, flip = self.states(steps, lengths, keep=True)
        logits = both @ self.out + self.bias
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(2, keepdims=True)
        real = np.arange(len(steps))[:, None] < lengths
        cols = np.arange(steps.shape[1])
        total = real.sum()
        value = -(np.log(p[:, cols, target] + 1e-12) * real).sum() / total
        p[:, cols, target] -= 1
        d = p * (real / total).astype(p.dtype)[:, :, None]
        dout = np.tensordot(both, d, ((0, 1), (0, 1)))
        dboth = d @ self.out.T
        h = HIDDEN
        fwd = self.forward.back(steps, a[1], a[2], dboth[:, :, :h])
        bwd = self.backward.back(steps[flip, cols], b[1], b[2], dboth[:, :, h:][flip, cols])
        return value, [*fwd, *bwd, dout, d.sum((0, 1))]

    def weights(self) -> list[np.ndarray]:
        return [self.forward.inp, self.forward.rec, self.backward.inp, self.backward.rec, self.out, self.bias]


def windows(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(steps T x N, lengths, owner): all bytes of all texts, cut into windows and padded with 0."""
    sizes = np.array([len(d) for d in data], np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(data)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    lengths = np.minimum(sizes[owner] - nth * WINDOW, WINDOW)
    flat = np.frombuffer(b"".join(d + bytes(int(c) * WINDOW - len(d)) for d, c in zip(data, counts)), np.uint8)
    return np.ascontiguousarray(flat.reshape(-1, WINDOW).T), lengths, owner


def train(texts: list[str], labels: list[str], seed: int = 11) -> Network:
    """Fit a network to whole-window samples of labelled texts with Adam; the same input gives the same weights."""
    names = sorted(set(labels))
    net = Network.fresh(names, seed)
    if not names:
        return net
    steps, lengths, owner = windows([t.encode() for t in texts])
    target = np.array([names.index(x) for x in labels], np.int64)[owner]
    rng = np.random.default_rng(seed)
    by_label = [np.flatnonzero(target == k) for k in range(len(names))]
    weights = net.weights()
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for i in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(x, -(-BATCH // len(names))) for x in by_label])
        # Half of the windows are shortened, so that short texts are learnt as well.
        short = np.minimum(lengths[pick], rng.integers(6, WINDOW + 1, len(pick)))
        _, grads = net.loss(steps[:, pick], np.where(rng.random(len(pick)) < 0.5, short, lengths[pick]), target[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - i / (STEPS + 1)))
        for w, g, a, b in zip(weights, grads, m, v):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= (rate * (a / (1 - 0.9**i)) / (np.sqrt(b / (1 - 0.99**i)) + 1e-6)).astype(w.dtype)
    net.trained_on = len(texts)
    return net


def learn(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network:
    """Train on a sample of the ``usable`` rows, at most ``DOCS_PER_LABEL`` of each label; every label is learnt."""
    rows = docs.filter(usable & F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = rows.groupBy(lang).count().collect()  # a row per label
    if not counts:
        return train([], [])
    place = F.pmod(F.xxhash64(F.lit("place"), key), F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(0)) + 1).cast("int")
    shares = docs.sparkSession.createDataFrame([(r[0], min(1.0, 2 * DOCS_PER_LABEL / r[1])) for r in counts], "__lang string, __share double")
    draw = F.pmod(F.xxhash64(F.lit("draw"), key), F.lit(1 << 30))
    some = (rows.join(F.broadcast(shares), F.col(lang) == F.col("__lang")).filter(draw < F.col("__share") * (1 << 30))
            .select(lang, F.col(text).substr(place + 1, F.lit(SAMPLE_CHARS)).alias("t"), draw.alias("d"))
            .orderBy("d", lang, "t").limit(4 * DOCS_PER_LABEL * len(counts)).collect())
    taken: dict[str, list[str]] = {}
    for r in some:
        if has_letter(r["t"]) and len(taken.setdefault(r[0], [])) < DOCS_PER_LABEL:
            taken[r[0]].append(r["t"])
    pairs = [(t, name) for name in sorted(taken) for t in taken[name]]
    return train([t for t, _ in pairs], [name for _, name in pairs])


def label_texts(net: Network, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities D x L, positions per label D x L) of whole texts."""
    n, k = len(texts), len(net.labels)
    probs, votes = np.zeros((n, k)), np.zeros((n, k), np.int64)
    if not k:
        return probs, votes
    for part in groups(texts):
        data = [(t or "").encode() for t in texts[part]]
        steps, lengths, owner = windows(data)
        for i in range(0, len(owner), WIDTH):
            s, ln, own = np.ascontiguousarray(steps[:, i : i + WIDTH]), lengths[i : i + WIDTH], owner[i : i + WIDTH] + part.start
            p = net.positions(s, ln)
            real = np.arange(WINDOW)[:, None] < ln
            np.add.at(probs, own, np.einsum("tnl,tn->nl", p, real.astype(p.dtype)))
            best = p.argmax(2)
            for j in range(k):
                np.add.at(votes[:, j], own, ((best == j) & real).sum(0))
        probs[part] /= np.maximum(1, np.array([len(d) for d in data]))[:, None]
    return probs, votes


def identify(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score (the label's pooled probability) and lang_share (its share of the positions)."""
    def run(texts: pa.Array) -> list[pa.Array]:
        texts = texts.to_pylist()
        probs, votes = label_texts(net, texts)
        known = np.array([has_letter(t) for t in texts], bool) & (len(net.labels) > 0)
        best = probs.argmax(1) if len(net.labels) else np.zeros(len(texts), int)
        at = np.arange(len(texts))
        score = np.where(known, probs[at, best] if len(net.labels) else 0.0, 0.0).clip(0, 1)
        share = np.where(known, votes[at, best] / np.maximum(1, votes.sum(1)) if len(net.labels) else 0.0, 0.0)
        names = [net.labels[b] if ok else "und" for b, ok in zip(best, known)]
        return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(share, pa.float64())]

    return add_columns(docs, [text], "lang_pred string, score double, lang_share double", run)
