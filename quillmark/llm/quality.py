"""Operator 6, quality rules: a linear-chain conditional random field labels each line content or boilerplate.

Lines with words are a sequence; each has binary features of its characters, length, beginning and repetition, and its
words. Viterbi decoding gives the likeliest label sequence, and a document is kept if lines marked content hold at least
``KEEP_SHARE`` of its words and it passes the base rules.

The field is trained here over a bounded sample of labelled documents. Labels are of documents; those of lines are
latent. A line that recurs across documents between different neighbours is a template and stays boilerplate whatever
document holds it. The others begin with their document's label; then training by gradient ascent on the conditional
likelihood and relabelling take turns: in each turn a line takes the label of the likeliest path, with a prior of
``PRIOR`` for its document's label. So good documents come to hold boilerplate lines and poor ones content.

A null, empty or blank text has no words, fails the base rules and is not kept. Without labelled rows of both classes
every line is content. Repeated rows each get the same verdict. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .textnum import LOWER, U64, row_bounds, run_hashes, spans, window_hashes

#: Bound of the training sample: documents, and characters of each.
TRAIN_DOCS = 3000
TRAIN_CHARS = 20_000
KEEP_SHARE = 0.5
#: Places that words are hashed to.
BUCKETS = 1 << 12
#: A line of at least so many words, and at most so many, between so many different neighbours is a template.
TEMPLATE_WORDS, TEMPLATE_CONTEXTS = (3, 25), 3
#: Turns of relabelling, and the log odds that a line is as its document.
TURNS, PRIOR = 3, 1.5
#: Base rules.
LEAST_WORDS = 20
MOST_REPEAT_PERCENT = 30
WINDOW = 8

_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[192:] = True  # a character's first byte
_MARK = np.zeros(256, bool)
_MARK[list(b"!?;=_~/\\^@{}()[]")] = True
_NO_LETTER = ~_LETTER
_NO_LETTER[128:192] = False  # a character's later bytes go on with a word
_CHAR = np.ones(256, bool)
_CHAR[128:192] = False
_BINS = {"symbols": (0.02, 0.08, 0.2), "upper": (0.1, 0.3, 0.6), "digits": (0.05, 0.2), "letters": (0.5, 0.7, 0.8), "marks": (0.03, 0.1), "words": (1.5, 3.5, 8.5, 20.5), "length": (3.0, 6.5, 9.0), "stutter": (0.05, 0.3)}
FEATURES = 1 + sum(len(b) + 1 for b in _BINS.values()) + 2


def _sums(flag: np.ndarray, body: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flag[body], dtype=np.int64)])


def lines_of(body: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Words, base figures and line features of a block of texts."""
    n = len(offsets) - 1
    ws, we, wrow = spans(body, offsets)
    chars = _sums(_CHAR, body)
    word_chars = np.zeros(n, np.int64)
    np.add.at(word_chars, wrow, chars[we] - chars[ws])
    symbols = _sums(_SYMBOL, body)
    hashes = run_hashes(body, ws, we)
    win, first = window_hashes(hashes, wrow, WINDOW)
    repeat_words = np.zeros(n, np.int64)
    if len(win):
        order = np.lexsort((win, wrow[first]))
        same = (win[order][1:] == win[order][:-1]) & (wrow[first][order][1:] == wrow[first][order][:-1])
        twice = np.zeros(len(win), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, first[twice], 1)
        np.add.at(cover, first[twice] + WINDOW, -1)
        repeated = np.cumsum(cover[:-1]) > 0
        repeat_words = np.bincount(wrow[repeated], minlength=n)
    # lines with a word
    ls, le, lrow = spans(body, offsets, _NEWLINE)
    wordcount = np.searchsorted(ws, le) - np.searchsorted(ws, ls)
    has = wordcount > 0
    ls, le, lrow, wordcount = ls[has], le[has], lrow[has], wordcount[has]
    lhash = run_hashes(body, ls, le)
    dup = np.zeros(len(ls), bool)
    if len(ls):
        order = np.lexsort((np.arange(len(ls)), lhash, lrow))
        dup[order[1:]] = (lhash[order][1:] == lhash[order][:-1]) & (lrow[order][1:] == lrow[order][:-1])
    size = np.maximum(1, chars[le] - chars[ls])
    letters = _sums(_LETTER, body)
    n_letters = letters[le] - letters[ls]
    upper, digits, marks = _sums(_UPPER, body), _sums(_DIGIT, body), _sums(_MARK, body)
    stutter = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes):
        stutter[2:] = np.cumsum((hashes[1:] == hashes[:-1]) & (wrow[1:] == wrow[:-1]))
    figures = {
        "symbols": (symbols[le] - symbols[ls]) / size,
        "upper": (upper[le] - upper[ls]) / np.maximum(1, n_letters),
        "digits": (digits[le] - digits[ls]) / size,
        "letters": n_letters / size,
        "marks": (marks[le] - marks[ls]) / size,
        "words": wordcount,
        "length": n_letters / np.maximum(1, wordcount),
        "stutter": (stutter[np.searchsorted(ws, le)] - stutter[np.searchsorted(ws, ls)]) / np.maximum(1, wordcount),
    }
    x = np.zeros((len(ls), FEATURES), np.float32)
    x[:, 0] = 1
    at = 1
    for name, bins in _BINS.items():
        x[np.arange(len(ls)), at + np.searchsorted(bins, figures[name], "right")] = 1
        at += len(bins) + 1
    x[:, at] = dup
    x[:, at + 1] = (body[ls] >= 97) & (body[ls] < 123) if len(ls) else 0
    lowered = LOWER[body]
    ts, te, _ = spans(lowered, offsets, _NO_LETTER)  # words of letters alone, without the marks around them
    terms = (run_hashes(lowered, ts, te) % U64(BUCKETS)).astype(np.int32)
    return {
        "line_hash": lhash, "terms": terms, "term_bounds": np.append(np.searchsorted(ts, ls), len(terms)) if len(ls) else np.zeros(1, np.int64),
        "n_words": np.bincount(wrow, minlength=n), "word_chars": word_chars, "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.bincount(lrow[dup], minlength=n), "n_repeat_words": repeat_words, "line_row": lrow, "line_words": wordcount, "x": x,
    }


def _ranked(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by falling length, and at each line position how many rows still have a line."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    alive = np.searchsorted(-lengths[order], -np.arange(1, (lengths.max() if len(lengths) else 0) + 1), "right")
    return order, alive


def viterbi(emit: np.ndarray, trans: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Likeliest labels of all sequences at once; a tie goes to content (1)."""
    labels = np.ones(len(emit), np.int8)
    order, alive = _ranked(bounds)
    if not len(alive):
        return labels
    starts = bounds[:-1][order]
    back = np.zeros((len(emit), 2), np.int8)
    score = np.zeros((len(order), 2))
    score[: alive[0]] = emit[starts[: alive[0]]]
    for t in range(1, len(alive)):
        k = alive[t]
        via = score[:k, :, None] + trans
        back[starts[:k] + t] = best = (via[:, 1] >= via[:, 0]).astype(np.int8)
        score[:k] = np.where(best, via[:, 1], via[:, 0]) + emit[starts[:k] + t]
    last = (score[:, 1] >= score[:, 0]).astype(np.int8)
    lengths = np.diff(bounds)[order]
    now = last.copy()
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        begins = lengths[:k] == t + 1
        now[:k][begins] = last[:k][begins]
        labels[starts[:k] + t] = now[:k]
        if t:
            now[:k] = back[starts[:k] + t, now[:k]]
    return labels


class Field:
    """Weights of line features (features x 2), of words (for content against boilerplate) and of transitions (2 x 2)."""

    def __init__(self) -> None:
        self.w, self.v, self.trans = np.zeros((FEATURES, 2)), np.zeros(BUCKETS), np.zeros((2, 2))

    def emit(self, made: dict[str, np.ndarray]) -> np.ndarray:
        """Scores of both labels for each line; a line's words count by their mean."""
        out = made["x"] @ self.w
        bounds = made["term_bounds"]
        sums = np.concatenate([[0.0], np.cumsum(self.v[made["terms"]])])[bounds]
        out[:, 1] += np.diff(sums) / np.maximum(1, np.diff(bounds))
        return out

    def train(self, made: dict[str, np.ndarray], y: np.ndarray, bounds: np.ndarray, steps: int = 50, rate: float = 0.1, ridge: float = 1e-3) -> None:
        """Ascend the conditional likelihood of labels ``y`` by forward-backward gradients and Adam."""
        x, terms, at_term = made["x"], made["terms"], made["term_bounds"]
        per = np.diff(at_term)
        owner, share = np.repeat(np.arange(len(x)), per), 1 / np.maximum(1, per)
        order, alive = _ranked(bounds)
        starts = bounds[:-1][order]
        gold = np.eye(2)[y]
        inner = np.ones(len(x), bool)
        inner[bounds[:-1][np.diff(bounds) > 0]] = False
        nxt = np.flatnonzero(inner)
        gold_trans = np.zeros((2, 2))
        np.add.at(gold_trans, (y[nxt - 1], y[nxt]), 1)
        params = (self.w, self.v, self.trans)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for step in range(1, steps + 1):
            emit = self.emit(made)
            fore, pair = np.zeros((len(x), 2)), np.exp(self.trans)
            local = np.exp(emit - emit.max(1, keepdims=True))
            fore[starts[: alive[0]]] = _unit(local[starts[: alive[0]]])
            for t in range(1, len(alive)):
                at = starts[: alive[t]] + t
                fore[at] = _unit((fore[at - 1] @ pair) * local[at])
            rear = np.ones((len(x), 2))
            for t in range(len(alive) - 1, 0, -1):
                at = starts[: alive[t]] + t
                rear[at - 1] = _unit((rear[at] * local[at]) @ pair.T)
            missing = gold - _unit(fore * rear)
            joint = fore[nxt - 1][:, :, None] * pair * (local[nxt] * rear[nxt])[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            of_terms = np.bincount(terms[at_term[0] :], weights=(missing[:, 1] * share)[owner], minlength=BUCKETS)
            grads = (x.T @ missing, of_terms, gold_trans - joint.sum(0))
            for (m, s), param, g in zip(moments, params, grads, strict=True):
                g = g / len(x) - ridge * param
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                param += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)


def templates(made: dict[str, np.ndarray], row: np.ndarray) -> np.ndarray:
    """Whether each line recurs between different neighbours; copies of a document have the same ones and do not count."""
    h = made["line_hash"]
    before, after = np.zeros(len(h), U64), np.zeros(len(h), U64)
    same = row[1:] == row[:-1]
    before[1:][same], after[:-1][same] = h[:-1][same], h[1:][same]
    few, many = TEMPLATE_WORDS
    fit = np.flatnonzero((made["line_words"] >= few) & (made["line_words"] <= many))
    distinct = np.unique(np.stack([h[fit], before[fit], after[fit]], 1), axis=0)
    line, n = np.unique(distinct[:, 0], return_counts=True)
    return np.isin(h, line[n >= TEMPLATE_CONTEXTS])


def learn(made: dict[str, np.ndarray], row: np.ndarray, of_doc: np.ndarray) -> tuple[Field, np.ndarray]:
    """A field, and the labels of the sample's lines that it was last trained on. ``of_doc``: each document's label."""
    field, bounds = Field(), row_bounds(row, len(of_doc))
    fixed = templates(made, row)
    prior = np.where(of_doc[row] == 1, PRIOR, -PRIOR)
    y = np.where(fixed, 0, of_doc[row])
    for turn in range(TURNS):
        if turn:
            emit = field.emit(made)
            emit[:, 1] += np.where(fixed, -1e3, prior)
            y = viterbi(emit, field.trans, bounds).astype(np.int64)
        field.train(made, y, bounds)
    return field, y


def _unit(p: np.ndarray) -> np.ndarray:
    return p / p.sum(1, keepdims=True)


def sample(docs: DataFrame, labels: DataFrame, column: str, most: int, chars: int, where=None) -> list:
    """At most ``most`` labelled rows (text, label) of at most ``chars`` characters, in hash order, half of each class where there are enough."""
    marked = labels.select("doc_id", F.col(column).cast("int").alias("y")).where(F.col("y").isin(0, 1)).where(where if where is not None else F.lit(True)).dropDuplicates(["doc_id"])
    ids = None
    for y in (0, 1):
        own = marked.where(F.col("y") == y).orderBy(common.stable_order("doc_id"), "doc_id").limit(most // 2)
        ids = own if ids is None else ids.unionByName(own)
    # the bound makes this side small enough to send everywhere; the texts are read once, one an id (the least) if it recurs
    found = docs.select("doc_id", "text").where(F.length("text") <= chars).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return sorted(((r.doc_id, r.text, r.y) for r in found.collect()), key=lambda r: (r[2], r[0], r[1]))


def fit(docs: DataFrame, labels: DataFrame) -> Field | None:
    rows = sample(docs, labels, "quality", TRAIN_DOCS, TRAIN_CHARS)
    if len({r[2] for r in rows}) < 2:
        return None
    body, offsets = common.text_column(pa.array([r[1] for r in rows], pa.large_string()))
    parts, at = [], 0
    for a, b in common.pieces(offsets):  # a bounded part at a time, as in the tasks
        made = lines_of(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        parts.append([*(made[c] for c in ("x", "line_hash", "line_words", "terms")), made["line_row"] + a, made["term_bounds"][:-1] + at])
        at += len(made["terms"])
    x, line_hash, line_words, terms, row, bounds = (np.concatenate(c) for c in zip(*parts, strict=True))
    made = {"x": x, "line_hash": line_hash, "line_words": line_words, "terms": terms, "term_bounds": np.append(bounds, at)}
    return learn(made, row, np.array([r[2] for r in rows]))[0] if len(x) else None


_FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words", "n_lines", "content_lines"]


def figures(texts: pa.Array, field: Field | None) -> dict[str, np.ndarray]:
    """Figures of each text, by blocks of bounded size."""
    body, offsets = common.text_column(texts)
    parts = []
    for a, b in common.pieces(offsets):
        made = lines_of(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        rows, content = made["line_row"], made["line_words"]
        made["n_lines"] = np.bincount(rows, minlength=b - a)
        if field is not None:
            chosen = viterbi(field.emit(made), field.trans, row_bounds(rows, b - a)) == 1
            rows, content = rows[chosen], content[chosen]
        made["content_words"] = np.bincount(rows, weights=content, minlength=b - a)
        made["content_lines"] = np.bincount(rows, minlength=b - a)
        parts.append([made[c].astype(np.int64) for c in _FIGURES])
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(_FIGURES)
    out = dict(zip(_FIGURES, columns, strict=True))
    n = out["n_words"]
    out["base_failed"] = (n < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEAT_PERCENT * n)
    out["kept"] = ~out["base_failed"] & (out["content_words"] >= KEEP_SHARE * n)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: base figures, words and lines marked content, base_failed, kept."""
    common.prepare(docs.sparkSession)
    field = fit(docs, labels)
    names = [*_FIGURES, "base_failed", "kept"]

    def run(batches):
        for batch in batches:
            found = figures(batch.column("text"), field)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(found[c]) for c in names]], ["doc_id", *names])

    kinds = ", ".join(f"{c} long" for c in _FIGURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {kinds}, base_failed boolean, kept boolean")


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, whole and without a shuffle; each row is judged by its own text."""
    common.prepare(docs.sparkSession)
    field = fit(docs, labels)
    return common.filtered(docs, lambda batch: figures(batch.column("text"), field)["kept"])
