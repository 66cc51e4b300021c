"""Measuring labels against truth: confusion, weighted rates, agreement, thresholds, areas, resampled intervals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import stats as S


def confusion(rows: DataFrame, truth: str, predicted: str, labels: Sequence | None = None) -> DataFrame:
    """Counts of (truth, predicted); all pairs of ``labels`` if given, with zeros."""
    counts = rows.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    if labels is None:
        return counts
    cells = rows.sparkSession.createDataFrame([(a, b) for a in labels for b in labels], ["truth", "predicted"])
    return cells.join(counts, ["truth", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def per_label(rows: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Support, predicted, precision, recall and F1 of every label, weighted."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    both = F.explode(F.array_distinct(F.array(F.col(truth).cast("string"), F.col(predicted).cast("string"))))
    cells = rows.select(F.col(truth).cast("string").alias("_t"), F.col(predicted).cast("string").alias("_p"), w.alias("_w"), both.alias("label"))
    hit = lambda c: F.sum(F.when(c, F.col("_w")).otherwise(0.0))
    t, p = F.col("_t") == F.col("label"), F.col("_p") == F.col("label")
    sums = cells.groupBy("label").agg(hit(t).alias("support"), hit(p).alias("predicted"), hit(t & p).alias("tp"))
    precision, recall = S.ratio(F.col("tp"), F.col("predicted")), S.ratio(F.col("tp"), F.col("support"))
    return sums.select("label", "support", "predicted", precision.alias("precision"), recall.alias("recall"), S.ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"))


def macro(per: DataFrame) -> DataFrame:
    return per.agg(*[F.avg(F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))).alias(f"macro_{c}") for c in ("precision", "recall", "f1")])


def set_figures(rows: DataFrame, gold: str, predicted: str) -> DataFrame:
    """Rates of predicted label sets: first label hit, equal sets, micro precision, recall and F1, mean size."""
    shared, g, p = F.size(F.array_intersect(gold, predicted)), F.size(gold), F.size(predicted)
    first = F.array_contains(F.col(gold), F.try_element_at(F.col(predicted), F.lit(1)))
    equal = (F.size(F.array_except(gold, predicted)) == 0) & (F.size(F.array_except(predicted, gold)) == 0)
    sums = rows.agg(
        F.avg(F.coalesce(first, F.lit(False)).cast("int")).alias("hit_at_1"), F.avg(equal.cast("int")).alias("exact"), F.sum(shared).alias("_s"), F.sum(g).alias("_g"), F.sum(p).alias("_p"),
        F.avg(p).alias("mean_size"),
    )
    return sums.select("hit_at_1", "exact", S.ratio(F.col("_s"), F.col("_p")).alias("precision"), S.ratio(F.col("_s"), F.col("_g")).alias("recall"), S.ratio(2 * F.col("_s"), F.col("_g") + F.col("_p")).alias("f1"), "mean_size")


def at_thresholds(rows: DataFrame, score: str, truth: str, cuts: Sequence[float]) -> DataFrame:
    """2 x 2 counts at each cut, in one pass: rows are counted by the cuts they reach, then summed over cuts."""
    reached = sum((F.when(F.col(score) >= c, 1).otherwise(0) for c in sorted(cuts)), F.lit(0))
    by = rows.select(reached.alias("_k"), (F.col(truth) == 1).alias("_t")).groupBy("_k").agg(F.sum(F.when(F.col("_t"), 1).otherwise(0)).alias("_pos"), F.sum(F.when(~F.col("_t"), 1).otherwise(0)).alias("_neg"))
    table = rows.sparkSession.createDataFrame([(float(c), k + 1) for k, c in enumerate(sorted(cuts))], "cut double, _rank int")
    sums = lambda side, c: F.sum(F.when(c, F.col(side)).otherwise(0))
    up, down = F.col("_k") >= F.col("_rank"), F.col("_k") < F.col("_rank")
    # at most len(cuts) + 1 rows on one side, len(cuts) on the other
    out = F.broadcast(table).join(by, F.lit(True)).groupBy("cut").agg(sums("_pos", up).alias("tp"), sums("_neg", up).alias("fp"), sums("_pos", down).alias("fn"), sums("_neg", down).alias("tn"))
    return out.select("cut", "tp", "fp", "fn", "tn", *[c.alias(n) for n, c in S.prf(F.col("tp"), F.col("fp"), F.col("fn")).items()])


def best_cut(sweep: DataFrame) -> DataFrame:
    """The cut of highest F1; among equals the middle one."""
    ties = sweep.groupBy(F.coalesce("f1", F.lit(0.0)).alias("f1")).agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    return ties.orderBy(F.desc("f1")).limit(1).select("f1", F.element_at("cuts", (F.floor((F.size("cuts") - 1) / 2) + 1).cast("int")).alias("cut"))


def sums_below(rows: DataFrame, order: str, value: str, name: str = "below") -> DataFrame:
    """``rows``, distinct in a numeric ``order``, with the sum of ``value`` over the rows before each.

    The order is cut into even ranges at quantiles that are literals of the plan, so a row's range is the same wherever
    it is computed; ranges are summed, and a running sum within its range is added to that of the ranges before.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.approxQuantile(order, [k / n for k in range(1, n)], 0.2 / n))) if n > 1 else []
    # comparisons one by one: constraints that the planner infers from a lambda's alias reach the side without ``order``
    part = sum((F.when(F.col(order) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    parts = rows.withColumn("_part", part)
    ahead = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    bases = parts.groupBy(F.col("_part").alias("_p")).agg(F.sum(value).alias("_n")).select("_p", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.withColumn(name, F.coalesce(F.sum(value).over(within), F.lit(0)))
    return ranked.join(F.broadcast(bases), F.col("_part") == F.col("_p")).withColumn(name, F.col(name) + F.col("_base")).drop("_part", "_p", "_base")


def roc_auc(rows: DataFrame, score: str, truth: str, weight: str | None = None) -> DataFrame:
    """The probability that a positive outscores a negative, ties counting half. Rows without a score do not count.

    Weights are gathered by score first; the running sum is over distinct scores, by ranges.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    own = rows.where(F.col(score).isNotNull())
    by = own.groupBy(F.col(score).cast("double").alias("s")).agg(F.sum(F.when(F.col(truth) == 1, w).otherwise(0.0)).alias("p"), F.sum(F.when(F.col(truth) == 1, 0.0).otherwise(w)).alias("n"))
    ranked = sums_below(by, "s", "n")
    wins = F.sum(F.col("p") * (F.col("below") + F.col("n") / 2))
    return ranked.agg(S.ratio(wins, F.sum("p") * F.sum("n")).alias("auc"), F.sum("p").alias("positives"), F.sum("n").alias("negatives"))


def agreement(rows: DataFrame, a: str, b: str, weight: str | None = None) -> DataFrame:
    """Weighted agreement and Cohen's kappa."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    cells = rows.groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.sum(w).alias("w"))
    total = cells.agg(F.sum("w").alias("total"), F.sum(F.when(F.col("a").eqNullSafe(F.col("b")), F.col("w")).otherwise(0.0)).alias("agree"))
    left, right = cells.groupBy(F.col("a").alias("k")).agg(F.sum("w").alias("x")), cells.groupBy(F.col("b").alias("k2")).agg(F.sum("w").alias("y"))
    chance = left.join(right, F.col("k").eqNullSafe(F.col("k2"))).agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0.0)).alias("xy"))
    both = total.join(F.broadcast(chance), F.lit(True))  # one row each
    expected = S.ratio(F.col("xy"), F.col("total") * F.col("total"))
    return both.select("total", S.ratio(F.col("agree"), F.col("total")).alias("agreement"), S.kappa(F.col("agree"), F.col("total"), expected).alias("kappa"))


def paired(rows: DataFrame, a: str, b: str) -> DataFrame:
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    x, y = F.col(a) == 1, F.col(b) == 1
    return rows.agg(count(x & y).alias("both"), count(x & ~y).alias("only_a"), count(~x & y).alias("only_b"), count(~x & ~y).alias("neither"))


def ratio_estimate(rows: DataFrame, weight: str, top: Column, bottom: Column) -> DataFrame:
    """Horvitz-Thompson ratio of weighted sums."""
    w = F.col(weight)
    return rows.agg(S.ratio(F.sum(w * top.cast("double")), F.sum(w * bottom.cast("double"))).alias("estimate"))


def _uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) by the md5 of the seed and the parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(16**12)


def _interval(units: DataFrame, drawn: DataFrame, names: Sequence[str]) -> DataFrame:
    """Point and 95% percentile interval of the first ratio, less the second if there is one; draws without a value do not count."""
    value = lambda c: sum((sign * S.ratio(F.sum(c(f"_t{k}")), F.sum(c(f"_b{k}"))) for k, sign in zip(names, (1, -1), strict=False)), F.lit(0.0))
    ratios = drawn.groupBy("draw").agg(value(lambda c: F.col("_k") * F.col(c)).alias("r"))
    ordered = ratios.agg(F.sort_array(F.collect_list("r")).alias("rs"))  # one value a draw
    point = units.agg(value(F.col).alias("point"))
    return point.join(F.broadcast(ordered), F.lit(True)).select("point", S.at_quantile(F.col("rs"), 0.025, "nearest").alias("low"), S.at_quantile(F.col("rs"), 0.975, "nearest").alias("high"))


def _units(rows: DataFrame, stratum: str | None, cluster: str, ratios: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Sums of each cluster; a ratio's rows count where both its sides are given."""
    sums = [F.sum(c.cast("double")).alias(f"_{side}{k}") for k, pair in enumerate(ratios) for side, c in zip("tb", pair, strict=True)]
    return rows.groupBy((F.col(stratum).cast("string") if stratum else F.lit("")).alias("_stratum"), F.col(cluster).cast("string").alias("_unit")).agg(*sums)


def resampled(
    rows: DataFrame, cluster: str, top: Column, bottom: Column, minus: tuple[Column, Column] | None = None, draws: int = 200, seed: int = 20261106, stratum: str | None = None, census: Sequence[str] = ()
) -> DataFrame:
    """A 95% percentile interval of a ratio of sums, or of a ratio less another, by drawing whole clusters with replacement.

    Each stratum's clusters are numbered; for each draw as many numbers are drawn as there are clusters, by hash, and
    clusters are joined to them. Draws are made from the numbered rows, spread over all tasks; neither side of the join is
    sent through the driver. Strata of ``census`` were drawn whole and stay as they are. For judged samples: it makes a row
    for each draw and cluster. ``bootstrap`` is for any size.
    """
    ratios = [(top, bottom), *([minus] if minus else [])]
    units = _units(rows, stratum, cluster, ratios)
    kept = F.col("_stratum").isin(*census) if census else F.lit(False)
    drawn_from = units.where(~F.coalesce(kept, F.lit(False)))
    places = drawn_from.withColumn("_no", (F.row_number().over(Window.partitionBy("_stratum").orderBy("_unit")) - 1).cast("long"))
    sizes = drawn_from.groupBy("_stratum").agg(F.count("*").alias("_n"))
    numbered = places.drop("_unit").repartition("_stratum", "_no")
    slots = numbered.join(sizes, "_stratum").select("_stratum", F.col("_no").alias("_slot"), "_n")
    picks = slots.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).select(
        "draw", "_stratum", F.floor(_uniform(seed, F.col("draw"), F.col("_stratum"), F.col("_slot")) * F.col("_n")).cast("long").alias("_no")
    )
    drawn = picks.hint("merge").join(numbered, ["_stratum", "_no"])
    sums = [f"_{side}{k}" for k in range(len(ratios)) for side in "tb"]
    by_draw = drawn.groupBy("draw").agg(*[F.sum(c).alias(c) for c in sums])
    if census:
        whole = units.where(kept).agg(*[F.sum(c).alias(c) for c in sums]).where(F.coalesce(*sums).isNotNull())
        by_draw = by_draw.unionByName(whole.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))))
    return _interval(units, by_draw.withColumn("_k", F.lit(1)), range(len(ratios)))


def bootstrap(rows: DataFrame, cluster: str, top: Column, bottom: Column, draws: int = 200, seed: int = 20261106, stratum: str | None = None) -> DataFrame:
    """As ``resampled``, at any size: each cluster gets, for each draw, a Poisson(1) count inverted from a hash, which
    resamples without gathering them; the draws are sums by (draw), combined before the shuffle."""
    units = _units(rows, stratum, cluster, [(top, bottom)])
    total, p, steps = 0.0, 2.718281828459045**-1, []
    for k in range(8):
        total += p
        steps.append(total)
        p /= k + 1
    drawn = units.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    u = _uniform(seed, F.col("draw"), F.col("_unit"))
    return _interval(units, drawn.withColumn("_k", sum((F.when(u >= s, 1).otherwise(0) for s in steps), F.lit(0))), [0])


def quantiles(rows: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Values at index int(q*n) of the order, with mean and bounds. Exact, by ranks over distinct values: a histogram, not a list, is ordered."""
    hist = rows.groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    if by:
        w = Window.partitionBy(*by)
        up = F.sum("c").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ranked = hist.withColumn("_up", up).withColumn("_n", F.sum("c").over(w))
    else:
        total = hist.agg(F.sum("c").alias("_n"))
        ranked = sums_below(hist.where("v is not null"), "v", "c").withColumn("_up", F.col("below") + F.col("c")).join(F.broadcast(total), F.lit(True))
    at = [F.min(F.when(F.col("_up") > F.floor(F.lit(q) * F.col("_n")), F.col("v"))).alias(f"p{round(q * 100)}") for q in shares]
    return ranked.groupBy(*by).agg(F.sum("c").alias("n"), F.min("v").alias("least"), *at, (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"), F.max("v").alias("most"))


def any_of(rows: DataFrame, item: str, flags: Mapping[str, Column]) -> DataFrame:
    return rows.groupBy(item).agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])


def scenarios(rows: DataFrame, kept: Mapping[str, Column]) -> DataFrame:
    """Each row once for every scenario that keeps it."""
    names = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in kept.items()]), lambda x: x.isNotNull())
    return rows.withColumn("scenario", F.explode(names))


def grid_search(rows: DataFrame, grid: Sequence[tuple[float, float]], predict: Callable[[Column, Column], Column], gold: str) -> DataFrame:
    """Micro F1 of a two-parameter set rule at every point of a small grid; the best first."""
    points = F.explode(F.array(*[F.struct(F.lit(float(a)).alias("least"), F.lit(float(b)).alias("share")) for a, b in grid]))
    out = rows.withColumn("_g", points).withColumn("_p", predict(F.col("_g.least"), F.col("_g.share")))
    sums = out.groupBy("_g.least", "_g.share").agg(F.sum(F.size(F.array_intersect(gold, "_p"))).alias("s"), F.sum(F.size(gold)).alias("g"), F.sum(F.size("_p")).alias("p"))
    return sums.select("least", "share", S.ratio(2 * F.col("s"), F.col("g") + F.col("p")).alias("f1")).orderBy(F.desc("f1"), "least", "share")
