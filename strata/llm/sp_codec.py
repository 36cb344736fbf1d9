"""SentencePiece encoding and decoding with a given vocabulary (operator 3).

A text's spaces become the marker U+2581, one marker is put in front, and the
text is split into the pieces whose log scores have the largest sum: Viterbi
over the matches that a double-array trie of the pieces gives at every
position.  A character that no piece covers costs the least score minus 10 and
is written as its UTF-8 bytes.  Decoding joins the pieces, reads byte pieces as
bytes and turns markers back into spaces.

No piece of such a vocabulary crosses from a letter to a marker, so the best
split of a text is made of the best splits of its words; each distinct word of
a batch is split once, all of them side by side in numpy.

A unigram model's scores are log probabilities and are used as they are.  A
merge model stores merge ranks; from these the log score is that of Zipf's law,
-ln(rank * H_n).  Scores are rounded to 1/1024, so sums are exact and ties are
ties: on a tie the split whose last piece is longer wins.

Defined results: a NULL text has NULL ids; an empty one none; a marker in the
text is a space afterwards; repeated rows get equal ids; other columns pass
through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import add_columns
from strata.llm.tokens import distinct, groups

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
GRID = 1024
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM = 1


@dataclass
class Vocabulary:
    """Pieces as bytes, log scores, the double-array trie, and the ids of unknown and byte pieces."""

    pieces: list[bytes]
    score: np.ndarray
    base: np.ndarray
    check: np.ndarray
    leaf: np.ndarray
    unknown: int
    first_byte: int
    byte_of: np.ndarray  # byte value of a byte piece, -1 for the others
    silent: np.ndarray   # pieces that decode to nothing
    splits_at_marks: bool


def double_array(words: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, leaf): state t = base[s] + byte follows s when check[t] == s; leaf[t] is the piece that ends at t, or -1."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, value in words:
        node = 0
        for b in word:
            nxt = children[node].get(b)
            if nxt is None:
                nxt = children[node][b] = len(children)
                children.append({})
                ends.append(-1)
            node = nxt
        ends[node] = value
    size = 4 * len(children) + 8192
    base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    used[:257] = True  # the root, and slots that not every byte value could reach from a positive base
    slots = [0] * len(children)
    free = 257  # no slot before this one is free
    sparse = 257  # nodes of several children look from here on; single children fill the holes before
    for node, kids in enumerate(children):  # parents come before their children
        if not kids:
            continue
        keys = np.array(sorted(kids))
        while used[free]:
            free += 1
        b = max(1, (free if len(keys) == 1 else max(free, sparse)) - keys[0])
        while True:  # the first base at which all children's slots are free, looked for 512 at a time
            fits = ~used[b + np.arange(512)[:, None] + keys].any(1)
            if fits.any():
                b += int(fits.argmax())
                break
            b += 512
            sparse = b
        base[slots[node]] = b
        used[b + keys] = True
        check[b + keys] = slots[node]
        for k in keys.tolist():
            slots[kids[k]] = b + k
            leaf[b + k] = ends[kids[k]]
    last = max(slots) + 257
    return base[:last], check[:last], leaf[:last]


def read_model(path: str = MODEL_PATH) -> Vocabulary:
    """Read a model file on the driver; what the tasks get is as large as the vocabulary."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("only models with identity normalisation and a dummy prefix are supported")
    kinds = np.array([p.type for p in model.pieces])
    if (kinds == BYTE).sum() != 256:
        raise ValueError("the model has no byte fallback")
    own = np.array([p.score for p in model.pieces], np.float64)
    inside = np.flatnonzero((kinds == NORMAL) | (kinds == USER))
    if model.trainer_spec.model_type != UNIGRAM:
        rank = np.empty(len(inside))
        rank[np.argsort(-own[inside], kind="stable")] = np.arange(1, len(inside) + 1)
        own[inside] = -np.log(rank) - np.log((1 / np.arange(1, len(inside) + 1)).sum())
    score = np.round(own * GRID) / GRID
    return build([p.piece for p in model.pieces], score, kinds)


#: Characters encoded at a time: the trie matches of a group take some hundred bytes per character.
GROUP_CHARS = 1 << 19


def build(pieces: list[str], score: np.ndarray, kinds: np.ndarray) -> Vocabulary:
    inside = np.flatnonzero((kinds == NORMAL) | (kinds == USER))
    raw = [p.encode() for p in pieces]
    base, check, leaf = double_array([(raw[i], int(i)) for i in inside])
    unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
    first = int(np.flatnonzero(kinds == BYTE)[0])
    byte_of = np.full(len(pieces), -1)
    byte_of[kinds == BYTE] = np.arange((kinds == BYTE).sum())
    score = score.copy()
    score[unknown] = score[inside].min() - UNKNOWN_PENALTY
    silent = (kinds == CONTROL) | (kinds == UNKNOWN)
    return Vocabulary(raw, score, base, check, leaf, unknown, first, byte_of, silent,
                      not any(re.search(f"[^{MARK}]{MARK}", pieces[i]) for i in inside))


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


def split_words(voc: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the pieces of every word, one word after the other."""
    n = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(words)), n)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # where characters start
    width = np.diff(np.append(at, len(data)))
    limit = (first + n)[owner[at]]
    # Matches of the trie at all positions, one byte further each round.
    found = []
    state, pos, k = np.zeros(len(at), np.int32), np.arange(len(at)), 0
    covered = np.zeros(len(at), bool)
    while len(pos):
        ok = at[pos] + k < limit[pos]
        pos, state = pos[ok], state[ok]
        nxt = voc.base[state] + data[at[pos] + k]
        ok = (nxt < len(voc.check))
        ok[ok] = voc.check[nxt[ok]] == state[ok]
        pos, state, k = pos[ok], nxt[ok], k + 1
        hit = voc.leaf[state] >= 0
        found.append((pos[hit], np.full(hit.sum(), k), voc.leaf[state[hit]]))
        covered[pos[hit & (width[pos] == k)]] = True
    bare = np.flatnonzero(~covered)
    found.append((bare, width[bare], np.full(len(bare), voc.unknown)))
    pos, size, piece = (np.concatenate(x) for x in zip(*found))
    # A node for each place between bytes; each word has one more node than bytes.
    node = at[pos] + owner[at[pos]]
    step = at[pos] - first[owner[at[pos]]]
    order = np.argsort(step, kind="stable")
    node, size, piece, step = node[order], size[order], piece[order], step[order]
    best = np.full(len(data) + len(words), -np.inf)
    back, via = np.zeros(len(best), np.int64), np.zeros(len(best), np.int64)
    start_nodes = first + np.arange(len(words))
    best[start_nodes] = 0
    cuts = np.flatnonzero(np.diff(step)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(step))):
        end = node[a:b] + size[a:b]
        value = best[node[a:b]] + voc.score[piece[a:b]]
        better = value > best[end]
        end = end[better]
        best[end], back[end], via[end] = value[better], node[a:b][better], piece[a:b][better]
    # Walk back from the ends of all words together.
    word, cur = np.arange(len(words))[n > 0], (start_nodes + n)[n > 0]
    out = []
    while len(word):
        out.append((word, back[cur], cur, via[cur]))
        cur = back[cur]
        go = cur > start_nodes[word]
        word, cur = word[go], cur[go]
    if not out:
        return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
    word, a, b, piece = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(a, kind="stable")
    word, a, b, piece = word[order], a[order], b[order], piece[order]
    # Unknown characters become their bytes.
    count = np.where(piece == voc.unknown, b - a, 1)
    ids = np.repeat(piece, count)
    raw = np.repeat(piece == voc.unknown, count)
    if raw.any():
        ids[raw] = voc.first_byte + data[_ragged(a - word, count)[raw]]
    per_word = np.bincount(word, weights=count, minlength=len(words)).astype(np.int64)
    return ids.astype(np.int32), np.append(0, np.cumsum(per_word))


def encode(voc: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of all texts; a NULL text counts as an empty one."""
    marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
    lists = [(_WORDS.findall(t) if voc.splits_at_marks else [t]) if t else [] for t in marked]
    codes, names = distinct([w for x in lists for w in x])
    ids, offsets = split_words(voc, [w.encode() for w in names])
    sizes = np.diff(offsets)[codes]
    ends = np.append(0, np.cumsum(sizes))
    return ids[_ragged(offsets[codes], sizes)], ends[np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64)]


def decode(voc: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of id sequences; bytes that are no UTF-8 read as the replacement character."""
    shown = [bytes([b]) if b >= 0 else b"" if s else p for p, b, s in zip(voc.pieces, voc.byte_of.tolist(), voc.silent.tolist())]
    sizes = np.array([len(p) for p in shown], np.int64)
    data = np.frombuffer(b"".join(shown), np.uint8)
    starts = np.cumsum(sizes) - sizes
    flat = data[_ragged(starts[ids], sizes[ids])].tobytes()
    ends = np.append(0, np.cumsum(sizes[ids]))[offsets]
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        t = flat[a:b].decode("utf-8", "replace").replace(MARK, " ")
        out.append(t[1:] if t.startswith(" ") else t)
    return out


def encode_column(docs: DataFrame, voc: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` plus ids (array of int), n_tokens, n_byte_tokens, and round_trip: decoding gives the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(voc)

    def run(texts: pa.Array) -> list[pa.Array]:
        voc = shared.value
        texts = texts.to_pylist()
        parts, sizes, same = [], [], []
        for part in groups(texts, GROUP_CHARS):
            ids, offsets = encode(voc, texts[part])
            parts.append(ids)
            sizes.append(np.diff(offsets))
            same += [None if t is None else t.replace(MARK, " ") == d for t, d in zip(texts[part], decode(voc, ids, offsets))]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        offsets = np.append(0, np.cumsum(size))
        n_bytes = np.diff(np.append(0, np.cumsum(voc.byte_of[ids] >= 0))[offsets])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()),
                                         mask=pa.array([t is None for t in texts]))
        return [lists.cast(pa.list_(pa.int32())), pa.array(size, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(same, pa.bool_())]

    return add_columns(docs, [text], "ids array<int>, n_tokens bigint, n_byte_tokens bigint, round_trip boolean", run)


def decode_column(frame: DataFrame, voc: Vocabulary, ids: str = "ids", into: str = "text") -> DataFrame:
    """``frame`` plus the decoded text of its id lists (NULL ids give NULL)."""
    shared = frame.sparkSession.sparkContext.broadcast(voc)

    def run(lists: pa.Array) -> list[pa.Array]:
        rows = lists.to_pylist()
        flat = np.array([i for r in rows for i in r or ()], np.int64)
        texts = decode(shared.value, flat, np.append(0, np.cumsum([len(r or ()) for r in rows])).astype(np.int64))
        return [pa.array([None if r is None else t for r, t in zip(rows, texts)], pa.string())]

    return add_columns(frame, [ids], f"`{into}` string", run)
