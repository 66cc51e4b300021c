"""Operator 3, toxicity: a bidirectional gated recurrent network with attention pooling over words and characters.

A text's words (runs of letters and digits, A-Z lowered) are cut into overlapping windows. Each word enters with its
own embedding, where the vocabulary has it, and the mean embedding of its character trigrams. Two gated recurrent
layers read a window in both directions, attention pools their states, and a linear unit scores the window. A document
scores as its highest window, through a logistic calibration. All windows of the whole text are scored.

The network is trained here in numpy by back-propagation and Adam, on a bounded sample of labelled documents. Only
documents are labelled, so a toxic document teaches by its most suspicious window: at first by its words' log odds,
then by the network's own choice. Labels, language, source and doc_id never enter a score.

A null or empty text, or one without a word, is a window without words: it gets the network's constant. Without
labelled rows of both classes every document scores 0. Repeated rows score alike. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .quality import sample
from .textnum import LOWER, run_hashes, spans

#: Bound of the training sample: documents, and characters of each.
TRAIN_DOCS = 3000
TRAIN_CHARS = 10_000
CUT = 0.7
WINDOW, STRIDE = 32, 16
#: Sizes: known words, word embedding, trigram buckets, trigram embedding, states of each direction, attention.
WORDS, WORD_DIM, BUCKETS, CHAR_DIM, STATES, ATTEND = 8000, 10, 2048, 6, 8, 8
LEAST_COUNT = 3
#: Windows that go through the network at once.
_BATCH = 2048

_STOP = np.ones(256, bool)
_STOP[48:58] = _STOP[65:91] = _STOP[97:123] = _STOP[128:] = False
_LETTER = np.where(_STOP, 0, LOWER).astype(np.uint32)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Words:
    """Words of a block of texts: hash, row, and trigram buckets by word."""

    hashes: np.ndarray
    row: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray


def read_words(body: np.ndarray, offsets: np.ndarray) -> Words:
    s, e, row = spans(body, offsets, _STOP)
    hashes = run_hashes(LOWER[body], s, e)
    # trigrams centred on each byte of a word; bytes outside it count as one sign
    c = _LETTER[body]
    left, right = np.concatenate([[0], c[:-1]]).astype(np.uint32), np.concatenate([c[1:], [0]]).astype(np.uint32)
    left[offsets[:-1][offsets[:-1] < len(body)]] = 0
    ends = offsets[1:][offsets[1:] > 0] - 1
    right[ends] = 0
    code = (left * np.uint32(0x9E3779B1) ^ c * np.uint32(0x85EBCA77) ^ right * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    grams = (code >> np.uint32(21)).astype(np.int32)  # 2048 buckets
    inside = c > 0
    at = np.concatenate([[0], np.cumsum(inside)])
    return Words(hashes, row, grams[inside], np.concatenate([at[s], [int(at[-1])]]))


def read_all(body: np.ndarray, offsets: np.ndarray) -> Words:
    """As ``read_words``, a bounded part at a time."""
    parts = [(a, read_words(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in common.pieces(offsets)]
    ahead = np.cumsum([0, *[int(w.bounds[-1]) for _, w in parts]])
    bounds = np.concatenate([*[w.bounds[:-1] + k for (_, w), k in zip(parts, ahead, strict=False)], ahead[-1:]])
    return Words(np.concatenate([w.hashes for _, w in parts]), np.concatenate([w.row + a for a, w in parts]), np.concatenate([w.grams for _, w in parts]), bounds)


def windows(row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of every window (-1 beyond the text) and each window's row; a row without words has one empty window."""
    bounds = np.searchsorted(row, np.arange(n + 1))
    size = np.diff(bounds)
    count = np.maximum(0, -(-(size - WINDOW) // STRIDE)) + 1
    owner = np.repeat(np.arange(n), count)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = (k * STRIDE)[:, None] + np.arange(WINDOW)
    return np.where(at < size[owner][:, None], bounds[owner][:, None] + at, -1), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    x *= 2
    _sigmoid(x)
    x *= 2
    x -= 1
    return x


class Network:
    def __init__(self, vocabulary: np.ndarray, odds: np.ndarray) -> None:
        """``vocabulary``: ascending word hashes; ``odds``: their log odds, where the embeddings start."""
        rng = np.random.default_rng(7)
        self.vocabulary = vocabulary
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        word = draw(len(vocabulary) + 1, WORD_DIM, scale=0.1)
        word[1:, 0] = odds
        word[0] = 0
        d = WORD_DIM + CHAR_DIM
        self.p = {"word": word, "char": draw(BUCKETS, CHAR_DIM, scale=0.1)}
        for side in "fb":
            self.p |= {f"w{side}": draw(d, 3 * STATES, scale=d**-0.5), f"u{side}": draw(STATES, 3 * STATES, scale=STATES**-0.5), f"c{side}": np.zeros(3 * STATES, np.float32)}
        self.p |= {"attend": draw(2 * STATES, ATTEND, scale=0.3), "query": draw(ATTEND, scale=0.3), "out": draw(2 * STATES, scale=0.3), "bias": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of words; 0 is unknown."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary numbers and input vectors of words."""
        number = self.numbers(w.hashes)
        x = np.empty((len(w.hashes), WORD_DIM + CHAR_DIM), np.float32)
        x[:, :WORD_DIM] = self.p["word"][number]
        if len(w.hashes):
            x[:, WORD_DIM:] = np.add.reduceat(self.p["char"][w.grams], w.bounds[:-1]) / np.diff(w.bounds)[:, None]
        return number, x

    def _layer(self, side: str, steps: np.ndarray, at: np.ndarray, keep: list | None) -> np.ndarray:
        """States after each word of windows ``at``; ``steps``: the words' share of the gates, a zero row last."""
        u, n = self.p[f"u{side}"], len(at)
        h = np.zeros((n, STATES), np.float32)
        out = np.zeros((WINDOW, n, STATES), np.float32)
        order = range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)
        for t in order:
            own, on = steps[at[:, t]], (at[:, t] >= 0)
            if not on.any():
                if keep is not None:
                    keep.append(None)
                continue
            hu = h @ u
            gates = _sigmoid(own[:, : 2 * STATES] + hu[:, : 2 * STATES])
            z, r = gates[:, :STATES], gates[:, STATES:]
            new = _tanh(own[:, 2 * STATES :] + r * hu[:, 2 * STATES :])
            after = new + z * (h - new)
            if not on.all():
                after = np.where(on[:, None], after, h)
            if keep is not None:
                keep.append((t, on, h, hu[:, 2 * STATES :], z, r, new))
            out[t] = h = after
        return out

    def logits(self, x: np.ndarray, at: np.ndarray, keep: dict | None = None) -> np.ndarray:
        p = self.p
        states, zero = [], np.zeros((1, 3 * STATES), np.float32)
        for side in "fb":
            steps = np.concatenate([x @ p[f"w{side}"] + p[f"c{side}"], zero])
            trail = [] if keep is not None else None
            states.append(self._layer(side, steps, at, trail))
            if keep is not None:
                keep[side] = trail
        both = np.concatenate(states, axis=2)
        on = (at >= 0).T
        a = _tanh(both @ p["attend"])
        weight = np.exp(np.minimum(a @ p["query"], 30)) * on
        total = weight.sum(0)
        weight /= np.where(total > 0, total, 1)
        pooled = (weight[:, :, None] * both).sum(0)
        if keep is not None:
            keep |= {"both": both, "a": a, "weight": weight, "pooled": pooled}
        return pooled @ p["out"] + p["bias"][0]

    def gradients(self, w: Words, at: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of windows ``at`` (all words of ``w`` are theirs)."""
        p, keep = self.p, {}
        number, x = self.inputs(w)
        z = self.logits(x, at, keep)
        dz = ((1 / (1 + np.exp(-z)) - y) / len(y)).astype(np.float32)
        g = {"out": keep["pooled"].T @ dz, "bias": np.array([dz.sum()], np.float32)}
        dpool = dz[:, None] * p["out"]
        both, a, weight = keep["both"], keep["a"], keep["weight"]
        dweight = (both * dpool).sum(2)
        dscore = weight * (dweight - (weight * dweight).sum(0))
        dboth = weight[:, :, None] * dpool
        g["query"] = np.einsum("tn,tna->a", dscore, a)
        da = dscore[:, :, None] * p["query"] * (1 - a * a)
        g["attend"] = np.einsum("tns,tna->sa", both, da)
        dboth = dboth + da @ p["attend"].T
        dx = np.zeros_like(x)
        for k, side in enumerate("fb"):
            u = p[f"u{side}"]
            du, dsteps = np.zeros_like(u), np.zeros((len(x) + 1, 3 * STATES), np.float32)
            dh = np.zeros((len(at), STATES), np.float32)
            for step in reversed([s for s in keep[side] if s is not None]):
                t, on, h, hn, z_, r, new = step
                dh = dh + dboth[t, :, k * STATES : (k + 1) * STATES]
                d = np.where(on[:, None], dh, 0)
                dn = d * (1 - z_) * (1 - new * new)
                dgate = np.concatenate([d * (h - new) * z_ * (1 - z_), dn * hn * r * (1 - r), dn], 1)
                drec = np.concatenate([dgate[:, : 2 * STATES], dn * r], 1)
                du += h.T @ drec
                np.add.at(dsteps, at[:, t], dgate)
                dh = np.where(on[:, None], d * z_ + drec @ u.T, dh)
            dsteps = dsteps[:-1]
            g[f"u{side}"], g[f"w{side}"], g[f"c{side}"] = du, x.T @ dsteps, dsteps.sum(0)
            dx += dsteps @ p[f"w{side}"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], number, dx[:, :WORD_DIM])
        g["word"][0] = 0
        g["char"] = np.zeros_like(p["char"])
        lengths = np.diff(w.bounds)
        np.add.at(g["char"], w.grams, np.repeat(dx[:, WORD_DIM:] / np.maximum(1, lengths)[:, None], lengths, axis=0))
        return g

    def window_scores(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit and row of every window of a block of texts."""
        w = read_words(body, offsets)
        at, owner = windows(w.row, len(offsets) - 1)
        _, x = self.inputs(w)
        out = np.empty(len(at), np.float64)
        for first in range(0, len(at), _BATCH):
            # windows of a part share a stretch of words
            part = at[first : first + _BATCH]
            low, high = (int(part[part >= 0].min()), int(part.max()) + 1) if (part >= 0).any() else (0, 0)
            out[first : first + _BATCH] = self.logits(x[low:high], np.where(part >= 0, part - low, -1))
        return out, owner

    def documents(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score in [0, 1] of each text of a block."""
        logit, owner = self.window_scores(body, offsets)
        best = np.maximum.reduceat(logit, np.searchsorted(owner, np.arange(len(offsets) - 1)))
        return 1 / (1 + np.exp(-np.clip(self.scale * best + self.shift, -60, 60)))


def _gather(w: Words, at: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of some windows as a block of their own."""
    own = at[at >= 0]
    lengths = np.diff(w.bounds)[own]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    grams = w.grams[np.repeat(w.bounds[own] - bounds[:-1], lengths) + np.arange(bounds[-1])]
    new = np.full(at.shape, -1)
    new[at >= 0] = np.arange(len(own))
    return Words(w.hashes[own], w.row[own], grams, bounds), new


def train(texts: list[str], y: np.ndarray, rounds: tuple[int, ...] = (6, 4), batch: int = 128, rate: float = 0.01) -> Network:
    """``y``: 1 toxic, 0 not, by text. Deterministic."""
    body, offsets = common.text_column(pa.array(texts, pa.large_string()))
    w = read_all(body, offsets)
    # log odds of words by the documents that hold them
    seen, first = np.unique(np.stack([w.hashes, w.row.astype(np.uint64)], 1), axis=0, return_index=True)
    words, inverse, count = np.unique(seen[:, 0], return_inverse=True, return_counts=True)
    inverse = inverse.ravel()
    toxic = np.bincount(inverse, weights=y[seen[:, 1].astype(np.int64)], minlength=len(words))
    enough = np.flatnonzero(count >= LEAST_COUNT)
    enough = np.sort(enough[np.lexsort((words[enough], -count[enough]))][:WORDS])
    share = (toxic + 0.5) / (count + 1)
    base = y.mean()
    odds = np.clip(np.log(share / (1 - share)) - np.log(base / (1 - base)), -3, 3)[enough].astype(np.float32)
    net = Network(words[enough], odds)
    at, owner = windows(w.row, len(texts))
    number = np.concatenate([net.numbers(w.hashes), [0]])
    suspicion = np.concatenate([[0.0], odds])[number[at]].max(1)
    rng = np.random.default_rng(11)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    starts = np.searchsorted(owner, np.arange(len(texts)))
    for epochs in rounds:
        top = np.array([s + int(np.argmax(suspicion[s:e])) for s, e in zip(starts, [*starts[1:], len(owner)], strict=True)])
        # of the clean documents also two windows at random
        clean = np.flatnonzero(y == 0)
        size = np.append(starts[1:], len(owner)) - starts
        more = starts[clean][:, None] + (rng.random((len(clean), 2)) * size[clean][:, None]).astype(np.int64)
        chosen = np.concatenate([top, more.ravel()])
        goal = np.concatenate([y, np.zeros(more.size)]).astype(np.float32)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // batch)):
                g = net.gradients(*_gather(w, at[chosen[part]]), goal[part])
                step += 1
                norm = max(1.0, float(np.sqrt(sum((v * v).sum() for v in g.values()))))
                for k, v in g.items():
                    m, s = moments[k]
                    m += 0.1 * (v / norm - m)
                    s += 0.01 * ((v / norm) ** 2 - s)
                    net.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
        suspicion = np.concatenate([net.window_scores(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0] for a, b in common.pieces(offsets)])
    best = np.maximum.reduceat(suspicion, starts)
    net.scale, net.shift = _calibrate(best, y)
    return net


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A logistic curve with a rising slope, by Newton steps with a little shrinkage."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - y) * x).sum() + 1e-2 * (a - 1), (p - y).sum()])
        q = p * (1 - p)
        hess = np.array([[(q * x * x).sum() + 1e-2, (q * x).sum()], [(q * x).sum(), q.sum() + 1e-6]])
        d = np.linalg.solve(hess, g)
        d *= min(1.0, 2.0 / max(1e-9, np.abs(d).max()))
        a, b = max(0.05, a - d[0]), b - d[1]
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    rows = sample(docs, labels, "toxic", TRAIN_DOCS, TRAIN_CHARS, ~held_out(F.col("doc_id")))
    if len({r[2] for r in rows}) < 2:
        return None
    return train([r[1] for r in rows], np.array([r[2] for r in rows], float))


def _scores(texts: pa.Array, net: Network | None) -> np.ndarray:
    """Scores of texts, by blocks of bounded size."""
    body, offsets = common.text_column(texts)
    if net is None:
        return np.zeros(len(texts))
    parts = [net.documents(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in common.pieces(offsets)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    common.prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), sent.value))], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, whole and without a shuffle; each row is judged by its own text."""
    common.prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return common.filtered(docs, lambda batch: _scores(batch.column("text"), sent.value) < CUT)
