"""Checks and reports over judged rows: integrity, faults, bands, paired items, cross-fitted rules, draws and batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import stats as S
from quillmark.functions import text as T
from quillmark.operators import measure, sampling
from quillmark.operators.relational import Refused


def integrity(rows: DataFrame, key: str, scores: str, label: str) -> DataFrame:
    """Repeated keys, rows with a score that is no number, and rows whose label is not the one of their highest score (the first name among equals)."""
    bad = F.exists(F.map_values(scores), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    entries = F.array_sort(F.map_entries(scores), lambda a, b: F.when(a["value"] != b["value"], F.when(a["value"] > b["value"], -1).otherwise(1)).when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    own = rows.select(key, bad.alias("bad"), (~entries[0]["key"].eqNullSafe(F.col(label))).alias("other"))
    return own.agg((F.count(key) - F.countDistinct(key)).alias("repeated"), F.count_if("bad").alias("not_finite"), F.count_if(~F.col("bad") & F.col("other")).alias("other_label"))


def quality_flags(rows: DataFrame, group: str, piece: str, body_chars: str) -> DataFrame:
    """What is odd about a body's pieces, joined by +: one with several headings, a tiny one, one that is nearly the whole body, too many."""
    headings = F.regexp_count(piece, F.lit("(?m)^[A-Z][^.!?\n]{2,60}:\\s*$"))
    tiny = (F.length(piece) < 30) | F.col(piece).rlike("^[A-Z][^.!?\n]{2,60}:\\s*$")
    sums = rows.groupBy(group).agg(F.max(headings).alias("h"), F.bool_or(tiny).alias("t"), F.max(F.length(piece)).alias("m"), F.max(body_chars).alias("b"), F.count("*").alias("n"))
    flags = F.concat_ws("+", F.when(F.col("h") >= 2, "several_headings"), F.when(F.col("t"), "tiny"), F.when((F.col("n") > 1) & (F.col("m") >= 0.9 * F.col("b")), "whole"), F.when(F.col("n") > 40, "many"))
    return sums.select(group, "n", flags.alias("flags"))


def sentence_measures(rows: DataFrame, id_col: str, named: str, own: str) -> DataFrame:
    """Of a text's sentences (``named``: an array of arrays of the entities each names): its own, mixed, of others, of nobody, and how many others."""
    rows = rows.select(id_col, F.col(own).alias("_own"), F.col(named).alias("_named"))
    mine = lambda s: F.array_contains(s, F.col("_own"))
    n = lambda f: F.size(F.filter("_named", f))
    others = F.array_distinct(F.filter(F.flatten("_named"), lambda e: e != F.col("_own")))
    return rows.select(
        id_col, F.size("_named").alias("sentences"), n(lambda s: mine(s) & (F.size(s) == 1)).alias("own"), n(lambda s: mine(s) & (F.size(s) > 1)).alias("mixed"),
        n(lambda s: ~mine(s) & (F.size(s) > 0)).alias("other"), n(lambda s: F.size(s) == 0).alias("nameless"), F.size(others).alias("others"),
    )


def pooled(rows: DataFrame, by: str, value: str, top: str, bottom: str) -> DataFrame:
    """Rows, mean and median of a value, and a share pooled over the rows."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.expr(f"percentile({value}, 0.5)").alias("median"), S.ratio(F.sum(top), F.sum(bottom)).alias("share"))


def nested_counts(rows: DataFrame, items: str, faults: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """How many items of nested arrays have each fault, and how many rows hold one; without exploding."""
    has = {n: F.size(F.filter(items, f)) for n, f in faults.items()}
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{n}_items") for n, c in has.items()], *[F.count_if(c > 0).alias(f"{n}_rows") for n, c in has.items()])


def changed_labels(big: DataFrame, small: DataFrame, key: str, label: str) -> DataFrame:
    """Two runs: rows of both, how many labels changed, and rows of the larger alone."""
    a, b = big.select(key, F.col(label).alias("a")), small.select(F.col(key).alias("_k"), F.col(label).alias("b"))
    joined = a.join(b, F.col(key) == F.col("_k"), "left")
    both = F.col("_k").isNotNull()
    return joined.agg(F.count_if(both).alias("both"), F.count_if(both & ~F.col("a").eqNullSafe(F.col("b"))).alias("changed"), F.count_if(~both).alias("rest"))


def containing(missed: Column, extra: Column) -> Column:
    """Pairs of a missed and an extra name one of which holds the other, each name once, in order: their number."""
    empty = F.struct(F.array().cast("array<string>").alias("used"), F.lit(0).alias("n"))

    def step(state: Column, m: Column) -> Column:
        hit = F.try_element_at(F.filter(extra, lambda e: ~F.array_contains(state["used"], e) & (F.lower(e).contains(F.lower(m)) | F.lower(m).contains(F.lower(e)))), F.lit(1))
        return F.when(hit.isNull(), state).otherwise(F.struct(F.concat(state["used"], F.array(hit)).alias("used"), (state["n"] + 1).alias("n")))

    return F.aggregate(missed, empty, step)["n"]


def miss_causes(missed: DataFrame, spans: DataFrame, id_col: str) -> DataFrame:
    """Each missed name's occurrence by the found spans it overlaps: cut short, run on, of another type, or not seen.

    Inputs: (id, name, start, end) and (id, start, end, entity_type, wanted). An interval join within a text.
    """
    s = spans.select(F.col(id_col).alias("_i"), F.col("start").alias("_a"), F.col("end").alias("_b"), (F.col("entity_type") == F.col("wanted")).alias("_same"))
    met = missed.join(s, (F.col(id_col) == F.col("_i")) & (F.col("_a") < F.col("end")) & (F.col("_b") > F.col("start")), "left")
    kind = (
        F.when(F.col("_i").isNull(), "4 not_seen").when(~F.col("_same"), "3 other_type").when((F.col("_a") <= F.col("start")) & (F.col("_b") >= F.col("end")), "2 run_on").otherwise("1 cut_short")
    )
    causes = met.groupBy(id_col, "name", "start", "end").agg(F.min(kind).alias("k"))
    return causes.select(id_col, "name", "start", "end", F.substring("k", 3, 20).alias("cause"))


def bands(rows: DataFrame, band: str, yes: Column, last: int) -> DataFrame:
    """Yes and all by band from 0 to ``last``, also where there is none."""
    all_ = rows.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("band"))
    by = rows.groupBy(F.col(band).cast("int").alias("_b")).agg(F.count_if(yes).alias("yes"), F.count("*").alias("total"))
    return all_.join(by, F.col("band") == F.col("_b"), "left").select("band", F.coalesce("yes", F.lit(0)).alias("yes"), F.coalesce("total", F.lit(0)).alias("total"))


def one_against_rest(rows: DataFrame, predicted: str, truth: str, labels: Sequence[str]) -> DataFrame:
    """Right, wrong and not known of each label's predictions, and how many of its known truths were found; a null truth is not known."""
    p, t = F.col(predicted), F.col(truth)
    label = F.explode(F.array(*map(F.lit, labels)))
    own = rows.select(p.alias("p"), t.alias("t"), label.alias("label"))
    said, is_ = F.col("p").eqNullSafe(F.col("label")), F.coalesce(F.col("t") == F.col("label"), F.lit(False))
    return own.groupBy("label").agg(F.count_if(said & is_).alias("right"), F.count_if(said & ~is_ & F.col("t").isNotNull()).alias("wrong"), F.count_if(said & F.col("t").isNull()).alias("unknown"), F.count_if(is_).alias("truth"))


def subsets(rows: DataFrame, kept: Mapping[str, Column]) -> DataFrame:
    return measure.scenarios(rows, kept)


def levels(rows: DataFrame, body: str, questions: Mapping[str, Column]) -> DataFrame:
    """Yes to each question, pieces clean in all of them, and bodies whose pieces all are."""
    clean = [F.coalesce(c, F.lit(False)) for c in questions.values()]
    all_ = clean[0]
    for c in clean[1:]:
        all_ = all_ & c
    own = rows.select(body, *[c.alias(n) for n, c in zip(questions, clean, strict=True)], all_.alias("_clean"))
    by = own.groupBy(body).agg(F.count("*").alias("pieces"), *[F.count_if(F.col(n)).alias(n) for n in questions], F.count_if("_clean").alias("clean"), F.bool_and("_clean").alias("_all"))
    return by.agg(F.sum("pieces").alias("pieces"), *[F.sum(n).alias(n) for n in questions], F.sum("clean").alias("clean_pieces"), F.count("*").alias("bodies"), F.count_if("_all").alias("clean_bodies"))


def rates(rows: DataFrame, by: Sequence[str], yes: Column, weight: str) -> DataFrame:
    """Weighted shares by group and bucket."""
    w = F.col(weight).cast("double")
    return rows.groupBy(*by).agg(F.count("*").alias("n"), S.ratio(F.sum(F.when(yes, w).otherwise(0.0)), F.sum(w)).alias("rate"))


def whole_bodies(pieces: DataFrame, body: str, unchanged: DataFrame, n: int, seed: int | str) -> DataFrame:
    """All pieces of ``n`` bodies drawn by hash from those whose source text is unchanged."""
    pool = pieces.select(body).distinct().join(unchanged.select(body).distinct(), body, "left_semi")
    return pieces.join(sampling.seeded(pool, body, n, seed), body, "left_semi")


def per_class_then_shuffled(rows: DataFrame, label: str, key: str, counts: Mapping[str, int], seed: int | str) -> DataFrame:
    """So many of each class, in one order by hash."""
    drawn = sampling.quota(rows, label, key, dict(counts), seed)
    return drawn.withColumn("position", F.row_number().over(Window.orderBy(sampling.order(key, f"{seed}-all"), F.col(key))))


def item_auc(rows: DataFrame, item: str, score: str, truth: str) -> DataFrame:
    """The area over items, each by its highest score and any truth."""
    return measure.roc_auc(rows.groupBy(item).agg(F.max(score).alias("s"), F.max(F.col(truth).cast("int")).alias("y")), "s", "y")


def ranking_accuracy(rows: DataFrame, key: str, score: str, truth: str) -> DataFrame:
    """Within each key, the share of (positive, negative) pairs in the right order, ties half, by rank sums: no pair is made."""
    w = Window.partitionBy(key).orderBy(score)
    n = F.count("*").over(Window.partitionBy(key, score))
    mid = F.rank().over(w) + (n - 1) / 2
    by = rows.withColumn("_m", mid).groupBy(key).agg(F.sum(F.when(F.col(truth) == 1, F.col("_m"))).alias("r"), F.count_if(F.col(truth) == 1).alias("p"), F.count_if(F.col(truth) != 1).alias("n"))
    both = by.where("p > 0 and n > 0")
    wins, pairs = F.sum(F.col("r") - F.col("p") * (F.col("p") + 1) / 2), F.sum(F.col("p") * F.col("n"))
    return both.agg(F.count("*").alias("keys"), F.sum(F.col("p") * F.col("n")).alias("pairs"), S.ratio(wins, pairs).alias("accuracy"))


def decided(rows: DataFrame, item: str, candidate_is_right: str, score: str, threshold: float) -> DataFrame:
    """Of items with candidates: the best is right, wrong, or nobody reaches the threshold (right if nobody was)."""
    best = rows.groupBy(item).agg(F.max(F.struct(F.col(score).alias("s"), F.col(candidate_is_right).cast("int").alias("y"))).alias("b"), F.max(F.col(candidate_is_right).cast("int")).alias("any"))
    chosen = F.col("b.s") >= threshold
    share = lambda c: F.avg(c.cast("int"))
    return best.agg(share(chosen & (F.col("b.y") == 1)).alias("right"), share(chosen & (F.col("b.y") == 0)).alias("wrong"), share(~chosen).alias("nobody"), share(~chosen & (F.col("any") == 0)).alias("rightly_nobody"))


def cross_fitted(rows: DataFrame, fold: str, fit: Callable[[DataFrame], DataFrame], apply: Callable[[DataFrame], DataFrame], folds: int) -> DataFrame:
    """Each fold's rows with what was fitted on the others. ``fit`` gives one row of settings; ``apply`` uses them as columns."""
    out = None
    for k in range(folds):
        own = apply(rows.where(F.col(fold) == k).join(F.broadcast(fit(rows.where(F.col(fold) != k))), F.lit(True)))
        out = own if out is None else out.unionByName(own)
    return out


def pair_ceiling(rows: DataFrame, gold: str) -> DataFrame:
    """The most that one label a row can reach of all labels."""
    return rows.agg(S.ratio(F.count("*"), F.sum(F.size(gold))).alias("ceiling"))


def design_problems(rows: DataFrame, stratum: str, quotas: Mapping[str, int]) -> DataFrame:
    """Strata whose rows are not as many as designed, also those with none or without a design."""
    spark = rows.sparkSession
    want = spark.createDataFrame(list(quotas.items()), "_s string, wanted long")
    got = rows.groupBy(F.col(stratum).cast("string").alias("stratum")).agg(F.count("*").alias("n"))
    both = got.join(F.broadcast(want), F.col("stratum") == F.col("_s"), "full")
    return both.select(F.coalesce("stratum", "_s").alias("stratum"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("wanted", F.lit(0)).alias("wanted")).where("n <> wanted")


def precision_by(rows: DataFrame, kind: str, right: Column) -> DataFrame:
    """Precision of each kind with its Wilson interval, and rows without a year counted by their null."""
    by = rows.groupBy(kind).agg(F.count("*").alias("n"), F.count_if(right).alias("hits"))
    low, high = S.wilson(F.col("hits"), F.col("n"))
    return by.select(kind, "n", "hits", S.ratio(F.col("hits"), F.col("n")).alias("share"), low.alias("low"), high.alias("high"))


def owners_with_omitted(marks: DataFrame, owners: str, right: str, omitted: DataFrame, key: str) -> DataFrame:
    """Share right by owner: a mark counts for each of its owners, what an owner left out counts as wrong. ``omitted``: (owner, key)."""
    own = marks.select(F.explode(owners).alias("owner"), key, F.col(right).cast("int").alias("right"))
    both = own.unionByName(omitted.select("owner", key, F.lit(0).alias("right")))
    return both.groupBy("owner").agg(F.count("*").alias("n"), F.sum("right").alias("right"), F.avg("right").alias("share"))


def agreements(rows: DataFrame, judge: str, first: str, second: str) -> DataFrame:
    """A judge's label against a model's: its first, or its first two."""
    strict, lenient = F.col(judge).eqNullSafe(F.col(first)), F.col(judge).eqNullSafe(F.col(first)) | F.col(judge).eqNullSafe(F.col(second))
    return rows.agg(F.avg(strict.cast("int")).alias("strict"), F.avg(lenient.cast("int")).alias("lenient"))


def entity_measures(rows: DataFrame, id_col: str, source: str, summary: str, main: str) -> DataFrame:
    """Whether a summary keeps the main entity, and its share of the source's entities."""
    kept = F.size(F.array_intersect(source, summary))
    return rows.select(id_col, F.array_contains(F.col(summary), F.col(main)).alias("main_kept"), S.ratio(kept.cast("double"), F.size(F.array_distinct(source)).cast("double")).alias("recall"))


def sensitivity(size: Column, flagged: Column, clean: Column) -> Column:
    """The share of all faults that a flag finds: from a flag's share of rows and the fault rates of both sides."""
    found, missed = size * flagged, (1 - size) * clean
    return F.when(found + missed > 0, found / (found + missed))


def without_copies(pool: DataFrame, title: str, seen: DataFrame) -> DataFrame:
    """Rows whose normalized title is not among those of ``seen`` (a column of titles)."""
    keys = seen.select(T.title_key(F.col(seen.columns[0])).alias("_k")).distinct()
    return pool.join(keys, T.title_key(F.col(title)) == F.col("_k"), "left_anti")


def check_draw(chosen: DataFrame, key: str, never: DataFrame, title: str, seen: DataFrame) -> None:
    """Refuse a draw that holds a forbidden key, a copy by title, or a key twice."""
    faults = {
        "forbidden keys": chosen.join(never.select(key).distinct(), key, "left_semi"), "titles seen before": chosen.join(without_copies(chosen, title, seen).select(key), key, "left_anti"),
        "repeated keys": chosen.groupBy(key).count().where(F.col("count") > 1),
    }
    if found := [name for name, rows in faults.items() if rows.limit(1).count()]:
        raise Refused(f"a draw holds {', '.join(found)}")


def funnel(rows: DataFrame, reasons: Sequence[tuple[str, Column]]) -> DataFrame:
    """``rows`` with the first reason that drops each, null for those that stay."""
    out = F.lit(None).cast("string")
    for name, drops in reversed(reasons):
        out = F.when(F.coalesce(drops, F.lit(False)), name).otherwise(out)
    return rows.withColumn("dropped", out)


def filled_quota(rows: DataFrame, label: str, key: str, n: int, quotas: Mapping[str, int], seed: int | str) -> DataFrame:
    """Up to a quota of each class by hash, then what is left of others until there are ``n``."""
    order = [sampling.order(key, seed), F.col(key)]
    limits = F.coalesce(F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col(label)], F.lit(0)) if quotas else F.lit(0)
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(label).orderBy(*order))).withColumn("_in", F.col("_r") <= limits)
    return ranked.orderBy(F.desc("_in"), *order).limit(n).drop("_r", "_in")


def tercile_edges(rows: DataFrame, value: str) -> DataFrame:
    """The values at a third and two thirds of the order."""
    out = measure.quantiles(rows, value, [1 / 3, 2 / 3])
    return out.select(F.col("p33").alias("low"), F.col("p67").alias("high"))


def length_batches(rows: DataFrame, key: str, length: str, size: int, pool: int, seed: int | str) -> DataFrame:
    """Rows shuffled by hash into pools of ``pool`` batches, in order of length within each, cut into batches of ``size``: (pool, batch)."""
    n = F.floor(_uniform(key, seed) * F.greatest(F.lit(1), F.ceil(F.lit(rows.count()) / (size * pool)))).cast("int")
    pooled_ = rows.withColumn("pool", n)
    at = F.row_number().over(Window.partitionBy("pool").orderBy(length, key)) - 1
    return pooled_.withColumn("batch", F.floor(at / size).cast("int"))


def _uniform(key: str, seed: int | str) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 12), 16, 10).cast("double") / float(16**12)


def kind_batches(rows: DataFrame, kind: str, key: str, size: int, seed: int | str) -> DataFrame:
    """Batches of one kind each, by hash order."""
    at = F.row_number().over(Window.partitionBy(kind).orderBy(sampling.order(key, seed), F.col(key))) - 1
    return rows.withColumn("batch", F.floor(at / size).cast("int"))


def merged_texts(rows: DataFrame, text: str, owner: str) -> DataFrame:
    """Equal texts once, with all that gave them."""
    return rows.groupBy(text).agg(F.sort_array(F.collect_set(owner)).alias("owners"))


def ids_of(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """The keys of many tables, once each."""
    out = parts[0].select(key)
    for p in parts[1:]:
        out = out.unionByName(p.select(key))
    return out.distinct()


def representative(rows: DataFrame, id_col: str, text: str, n: int, width: int = 1 << 12) -> DataFrame:
    """The ``n`` texts nearest to the mean of all in weighted words (hashed to ``width`` places), with their cosine.

    Word counts are rows (text, place), so no vector is ever gathered; the mean is a table of at most ``width`` rows.
    """
    words = rows.select(id_col, F.explode(T.words(F.lower(F.coalesce(text, F.lit(""))))).alias("w")).withColumn("place", F.pmod(F.xxhash64("w"), F.lit(width)))
    tf = words.groupBy(id_col, "place").agg(F.count("*").alias("tf"))
    total = rows.count()
    df = tf.groupBy(F.col("place").alias("_p")).agg((F.log(F.lit(total + 1.0) / (F.count("*") + 1.0))).alias("idf"))
    weighted = tf.join(F.broadcast(df), F.col("place") == F.col("_p")).select(id_col, "place", (F.col("tf") * F.col("idf")).alias("x"))
    norm = weighted.groupBy(F.col(id_col).alias("_i")).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    unit = weighted.join(norm, F.col(id_col) == F.col("_i")).where("norm > 0").select(id_col, "place", (F.col("x") / F.col("norm")).alias("x"))
    mean = unit.groupBy(F.col("place").alias("_p")).agg((F.sum("x") / total).alias("m"))
    near = unit.join(F.broadcast(mean), F.col("place") == F.col("_p")).groupBy(id_col).agg(F.sum(F.col("x") * F.col("m")).alias("nearness"))
    return near.orderBy(F.desc(F.round("nearness", 12)), id_col).limit(n)
