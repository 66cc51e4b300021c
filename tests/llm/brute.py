"""Plain versions of the operators for small tables."""

from __future__ import annotations

import math
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    """rows: (doc_id, text), ids unique -> {doc_id: (n_shingles, component)}"""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def quality_base(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if grams[tuple(words[k : k + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


_BINS = {"symbols": (0.02, 0.08, 0.2), "upper": (0.1, 0.3, 0.6), "digits": (0.05, 0.2), "letters": (0.5, 0.7, 0.8), "marks": (0.03, 0.1), "words": (1.5, 3.5, 8.5, 20.5), "length": (3.0, 6.5, 9.0), "stutter": (0.05, 0.3)}


def line_evidence(text):
    """Of each line with a word: its words, its features, and its words of letters alone."""
    out, seen, last = [], set(), None
    for line in (text or "").split("\n"):
        words = WORD.findall(line)
        if not words:
            continue
        n, letters = len(line), [c for c in line if c.isascii() and c.isalpha() or c > "\x7f"]
        share = lambda own: sum(c in own for c in line) / n  # noqa: B023, E731
        figures = {
            "symbols": share("#*$%&|<>"), "upper": sum("A" <= c <= "Z" for c in line) / max(1, len(letters)), "digits": share("0123456789"), "letters": len(letters) / n,
            "marks": share("!?;=_~/\\^@{}()[]"), "words": len(words), "length": len(letters) / len(words),
            "stutter": sum(a == b for a, b in zip([last, *words], words, strict=False)) / len(words),
        }
        x = [1.0]
        for name, bins in _BINS.items():
            place = sum(figures[name] >= b for b in bins)
            x += [float(k == place) for k in range(len(bins) + 1)]
        x += [float(line in seen), float("a" <= line[0] <= "z")]
        seen.add(line)
        last = words[-1]
        out.append((len(words), x, re.findall("[a-zA-Z\x80-\U0010ffff]+", line)))
    return out


def toxicity(net, text, window, stride, run_hash):
    """The network's score of one text, a window, a word and a gate at a time, in plain numbers."""
    p = {k: v.astype(float).tolist() for k, v in net.p.items()}
    known = {int(h): k + 1 for k, h in enumerate(net.vocabulary)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    times = lambda v, m: [sum(x * row[j] for x, row in zip(v, m, strict=True)) for j in range(len(m[0]))]
    sig = lambda x: 1 / (1 + math.exp(-x))
    vectors = []
    for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode()):
        word = m[0].lower()
        own = p["word"][known.get(run_hash(word), 0)]
        grams = []
        for k, c in enumerate(word):
            a, b = word[k - 1] if k else 0, word[k + 1] if k + 1 < len(word) else 0
            code = ((a * 0x9E3779B1 & 0xFFFFFFFF) ^ (c * 0x85EBCA77 & 0xFFFFFFFF) ^ (b * 0xC2B2AE3D & 0xFFFFFFFF)) * 0x27D4EB2F & 0xFFFFFFFF
            grams.append(p["char"][code >> 21])
        vectors.append(own + [sum(g[j] for g in grams) / len(grams) for j in range(len(grams[0]))])
    size = len(p["uf"])
    logits = []
    for first in range(0, max(0, -(-(len(vectors) - window) // stride)) * stride + 1, stride):
        own = vectors[first : first + window]
        states = []
        for side, order in (("f", range(len(own))), ("b", range(len(own) - 1, -1, -1))):
            h, found = [0.0] * size, [None] * len(own)
            for t in order:
                x = [a + b for a, b in zip(times(own[t], p[f"w{side}"]), p[f"c{side}"], strict=True)]
                u = times(h, p[f"u{side}"])
                z, r = ([sig(x[k * size + j] + u[k * size + j]) for j in range(size)] for k in (0, 1))
                new = [math.tanh(x[2 * size + j] + r[j] * u[2 * size + j]) for j in range(size)]
                h = found[t] = [n + g * (old - n) for n, g, old in zip(new, z, h, strict=True)]
            states.append(found)
        both = [a + b for a, b in zip(*states, strict=True)]
        weight = [math.exp(dot([math.tanh(v) for v in times(s, p["attend"])], p["query"])) for s in both]
        pooled = [sum(w * s[j] for w, s in zip(weight, both, strict=True)) / sum(weight) for j in range(2 * size)] if both else [0.0] * (2 * size)
        logits.append(dot(pooled, p["out"]) + p["bias"][0])
    return sig(net.scale * max(logits) + net.shift)
