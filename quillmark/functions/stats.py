"""Statistics: intervals, verdicts, agreement and decision rules, as columns or as small driver functions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.96
EPS = 1e-6


def wilson(hits: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """The interval of a proportion; null for n = 0."""
    n = F.when(n > 0, n.cast("double"))
    p = hits / n
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = F.lit(z) * F.sqrt(p * (1 - p) / n + F.lit(z * z) / (4 * n * n)) / (1 + z * z / n)
    return centre - half, centre + half


def judge(low: Column, high: Column, bar: float) -> Column:
    """Verdict of an interval against a bar."""
    return F.when(low.isNull() | F.isnan(low), "undefined").when(low >= bar, "pass").when(high < bar, "fail").otherwise("not decided")


def gain_verdict(low: Column, high: Column) -> Column:
    return F.when(low.isNull() | F.isnan(low), "undefined").when(low > 0, "better").when(high <= 0, "not better").otherwise("not decided")


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def kappa(agree: Column, total: Column, expected: Column) -> Column:
    """Cohen's kappa from the weight of agreement, all weight, and the share expected by chance."""
    return ratio(ratio(agree, total) - expected, 1 - expected)


def at_quantile(ordered: Column, q: float, rule: str = "floor") -> Column:
    """A value of a sorted array. Rules: ``floor`` int(q*n), ``nearest`` round half even of q*(n-1), ``percent`` n*q/100 with q in percent."""
    n = F.size(ordered)
    if rule == "nearest":
        at = F.bround(F.lit(q) * (n - 1), 0).cast("int")
    elif rule == "percent":
        at = F.floor(n * q / 100).cast("int")
    else:
        at = F.floor(F.lit(q) * n).cast("int")
    return F.when(n > 0, F.element_at(ordered, F.least(at, n - 1) + 1))


def softmax_stack(probabilities: Sequence[Column], relevance: Column, classes: Sequence[str], coef: Sequence[Sequence[float]], intercept: Sequence[float]) -> Column:
    """Class probabilities of a stacked logistic regression over log probabilities and the logit of a relevance."""
    r = F.least(F.greatest(relevance, F.lit(EPS)), F.lit(1 - EPS))
    features = [F.log(F.least(F.greatest(p, F.lit(EPS)), F.lit(1.0))) for p in probabilities] + [F.log(r / (1 - r))]
    z = [sum((F.lit(c) * f for c, f in zip(row, features, strict=True)), F.lit(b)) for row, b in zip(coef, intercept, strict=True)]
    top = F.greatest(*z)
    e = [F.exp(v - top) for v in z]
    total = sum(e[1:], e[0])
    return F.struct(*[(v / total).alias(c) for c, v in zip(classes, e, strict=True)])


def best_class(scores: Column, classes: Sequence[str]) -> Column:
    """The class with the highest score; of equals the first listed."""
    out = F.lit(classes[-1])
    for k in range(len(classes) - 2, -1, -1):
        rest = [scores[c] for c in classes[k + 1 :]]
        out = F.when(scores[classes[k]] >= (F.greatest(*rest) if len(rest) > 1 else rest[0]), classes[k]).otherwise(out)
    return out


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double") / F.sqrt(dot(a, a)))


def without_direction(a: Column, noise: Column, share: float) -> Column:
    """``a`` less a share of its part along ``noise``, at unit length."""
    return unit(F.zip_with(a, F.transform(noise, lambda n: n * share * dot(a, noise)), lambda x, n: x.cast("double") - n))


def top_mean(values: Column, k: int = 3) -> Column:
    """The mean of the k largest."""
    best = F.slice(F.sort_array(values, asc=False), 1, k)
    return F.aggregate(best, F.lit(0.0), lambda s, x: s + x) / F.size(best)


def positive_weight(positive: Column, total: Column, cap: float = 4.0) -> Column:
    return F.least(F.greatest(F.sqrt(ratio(total - positive, positive)), F.lit(1.0)), F.lit(cap))


def class_weight(count: Column, total: Column, classes: Column) -> Column:
    return ratio(total, classes * count)


def sign_test(a_only: int, b_only: int) -> float:
    """Exact two-sided binomial probability of as uneven a split."""
    n, k = a_only + b_only, min(a_only, b_only)
    return 1.0 if not n else min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2**n)


def mcnemar(a_only: int, b_only: int) -> float:
    return sign_test(a_only, b_only)


def allocate(population: dict[int, int], n: int) -> dict[int, int]:
    """Equal shares of ``n`` over buckets, none beyond its population; what one cannot take goes to the others in order."""
    taken = dict.fromkeys(sorted(population), 0)
    left = min(n, sum(population.values()))
    while left:
        open_ = [b for b in taken if taken[b] < population[b]]
        share = max(1, left // len(open_))
        for b in open_:
            more = min(share, population[b] - taken[b], left)
            taken[b] += more
            left -= more
    return taken


def reply_estimate(chars: Column, per_token: float = 4.31) -> Column:
    return F.ceil(chars / per_token)
