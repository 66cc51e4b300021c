"""Queries that measure labels, scores and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions import stats as S
from quillmark.functions import structures as N
from quillmark.operators import measure, scorers

from .registry import query, table

#: A stand-in prediction: a length rule, which both engines compute alike.
_PRED = "CASE WHEN n_chars < 400 THEN 0 ELSE 1 END"
_ROWS = f"r AS (SELECT doc_id, lang, source, n_chars, quality, toxic, {_PRED} AS pred, CAST(n_chars % 97 AS DOUBLE) / 97 AS score FROM documents JOIN labels USING (doc_id))"
CUTS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
COEF = ((0.5, -0.2, -0.1, 0.1), (-0.2, 0.4, -0.05, 0.2), (-0.1, -0.1, 0.1, -0.3))
INTERCEPT = (0.0, -0.3, 0.3)


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return docs.withColumn("pred", F.expr(_PRED)).withColumn("score", (F.col("n_chars") % 97).cast("double") / 97)


@query(f"WITH {_ROWS}, g AS (SELECT a AS truth, b AS predicted FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b)) SELECT truth, predicted, count(doc_id) AS n FROM g LEFT JOIN r ON quality = truth AND pred = predicted GROUP BY truth, predicted")
def confusion(spark, sf):
    out = measure.confusion(_rows(spark, sf), "quality", "pred", [0, 1])
    return out.select(F.col("truth").cast("int").alias("truth"), F.col("predicted").cast("int").alias("predicted"), "n")


@query(f"""WITH {_ROWS}, w AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY source) AS w FROM r), l AS (SELECT 0 AS label UNION ALL SELECT 1),
t AS (SELECT label, sum(CASE WHEN quality = label THEN w ELSE 0 END) AS s, sum(CASE WHEN pred = label THEN w ELSE 0 END) AS p, sum(CASE WHEN quality = label AND pred = label THEN w ELSE 0 END) AS tp FROM w, l GROUP BY label)
SELECT CAST(label AS VARCHAR) AS label, round(s, 9) AS support, round(p, 9) AS predicted, round(tp / nullif(p, 0), 9) AS "precision", round(tp / nullif(s, 0), 9) AS recall, round(2 * tp / nullif(s + p, 0), 9) AS f1 FROM t WHERE s + p > 0""")
def weighted_prf(spark, sf):
    """Rows weighted by one over their source's rows."""
    rows = _rows(spark, sf)
    w = rows.groupBy("source").agg((F.lit(1.0) / F.count("*")).alias("w"))
    out = measure.per_label(rows.join(w, "source"), "quality", "pred", "w")
    return out.select("label", *[F.round(c, 9).alias(c) for c in ("support", "predicted", "precision", "recall", "f1")])


@query(f"""WITH {_ROWS}, s AS (SELECT lang, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS hits FROM r GROUP BY lang), i AS (SELECT *, hits * 1.0 / n AS p, 1.96 * 1.96 AS zz FROM s),
w AS (SELECT lang, n, hits, (p + zz / (2 * n)) / (1 + zz / n) - 1.96 * sqrt(p * (1 - p) / n + zz / (4.0 * n * n)) / (1 + zz / n) AS low, (p + zz / (2 * n)) / (1 + zz / n) + 1.96 * sqrt(p * (1 - p) / n + zz / (4.0 * n * n)) / (1 + zz / n) AS high FROM i)
SELECT lang, n, hits, round(low, 9) AS low, round(high, 9) AS high, CASE WHEN low >= 0.8 THEN 'pass' WHEN high < 0.8 THEN 'fail' ELSE 'not decided' END AS verdict FROM w""")
def wilson_share(spark, sf):
    s = _rows(spark, sf).groupBy("lang").agg(F.count("*").alias("n"), F.sum("quality").alias("hits"))
    low, high = S.wilson(F.col("hits"), F.col("n"))
    return s.select("lang", "n", "hits", F.round(low, 9).alias("low"), F.round(high, 9).alias("high"), S.judge(low, high, 0.8).alias("verdict"))


@query(f"""WITH {_ROWS}, k AS (SELECT quality, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS m FROM r)
SELECT round((sum(m) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 1) * (count(*) FILTER (WHERE quality = 1) + 1) / 2.0) / (count(*) FILTER (WHERE quality = 1) * count(*) FILTER (WHERE quality = 0)), 9) AS auc,
CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) AS positives, CAST(count(*) FILTER (WHERE quality = 0) AS DOUBLE) AS negatives FROM k""")
def roc_auc_rank(spark, sf):
    return measure.roc_auc(_rows(spark, sf), "score", "quality").select(F.round("auc", 9).alias("auc"), "positives", "negatives")


@query(f"""WITH {_ROWS}, c AS (SELECT unnest([{', '.join(map(str, CUTS))}]) AS c), s AS (SELECT CAST(c AS DOUBLE) AS cut, count(*) FILTER (WHERE score >= c AND quality = 1) AS tp, count(*) FILTER (WHERE score >= c AND quality = 0) AS fp,
count(*) FILTER (WHERE score < c AND quality = 1) AS fn, count(*) FILTER (WHERE score < c AND quality = 0) AS tn FROM r, c GROUP BY c)
SELECT cut, tp, fp, fn, tn, round(tp * 1.0 / nullif(tp + fp, 0), 9) AS "precision", round(tp * 1.0 / nullif(tp + fn, 0), 9) AS recall, round(2.0 * tp / nullif(2 * tp + fp + fn, 0), 9) AS f1 FROM s""")
def threshold_sweep(spark, sf):
    out = measure.at_thresholds(_rows(spark, sf), "score", "quality", CUTS)
    return out.select("cut", "tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(f"""WITH {_ROWS}, c AS (SELECT unnest([{', '.join(map(str, CUTS))}]) AS c), s AS (SELECT CAST(c AS DOUBLE) AS cut, count(*) FILTER (WHERE score >= c AND quality = 1) AS tp, count(*) FILTER (WHERE score >= c AND quality = 0) AS fp,
count(*) FILTER (WHERE score < c AND quality = 1) AS fn FROM r, c GROUP BY c), f AS (SELECT cut, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM s)
SELECT round(max(f1), 9) AS f1, list_sort(list(cut) FILTER (WHERE f1 = (SELECT max(f1) FROM f)))[(count(*) FILTER (WHERE f1 = (SELECT max(f1) FROM f)) - 1) // 2 + 1] AS cut FROM f""")
def best_threshold(spark, sf):
    return measure.best_cut(measure.at_thresholds(_rows(spark, sf), "score", "quality", CUTS)).withColumn("f1", F.round("f1", 9))


@query("""WITH r AS (SELECT l_extendedprice / l_quantity AS s, l_returnflag = 'R' AS y, l_quantity AS w FROM lineitem), g AS (SELECT s, sum(CASE WHEN y THEN w ELSE 0 END) AS p, sum(CASE WHEN y THEN 0 ELSE w END) AS n FROM r GROUP BY s),
b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 9) AS auc, round(sum(p), 3) AS positives, round(sum(n), 3) AS negatives FROM b""")
def roc_auc_many(spark, sf):
    """The area over as many distinct scores as there are prices, weighted by quantity."""
    rows = table(spark, sf, "lineitem").select((F.col("l_extendedprice") / F.col("l_quantity")).alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_quantity").alias("w"))
    return measure.roc_auc(rows, "s", "y", "w").select(F.round("auc", 9).alias("auc"), F.round("positives", 3).alias("positives"), F.round("negatives", 3).alias("negatives"))


@query(f"""WITH {_ROWS}, t AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality = pred) AS a, count(*) FILTER (WHERE quality = 1) AS q, count(*) FILTER (WHERE pred = 1) AS p FROM r),
e AS (SELECT *, (q * p + (n - q) * (n - p)) * 1.0 / (n * n) AS e FROM t) SELECT CAST(n AS DOUBLE) AS total, round(a * 1.0 / n, 9) AS agreement, round((a * 1.0 / n - e) / (1 - e), 9) AS kappa FROM e""")
def cohen_kappa(spark, sf):
    return measure.agreement(_rows(spark, sf), "quality", "pred").select("total", F.round("agreement", 9).alias("agreement"), F.round("kappa", 9).alias("kappa"))


@query(f"""WITH {_ROWS}, w AS (SELECT *, (SELECT count(*) FROM documents d WHERE d.lang = r.lang) * 1.0 / count(*) OVER (PARTITION BY lang) AS w FROM r)
SELECT round(sum(w * quality * pred) / sum(w * pred), 9) AS estimate FROM w""")
def ht_estimate(spark, sf):
    """Precision of the rule over all documents, from the labelled ones by language."""
    from quillmark.operators import sampling

    populations = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("population"))
    rows = sampling.weights(_rows(spark, sf), populations, "lang")
    return measure.ratio_estimate(rows, "weight", F.col("quality") * F.col("pred"), F.col("pred")).select(F.round("estimate", 9).alias("estimate"))


@query(f"WITH {_ROWS} SELECT count(*) FILTER (WHERE quality = 1 AND pred = 1) AS both, count(*) FILTER (WHERE quality = 1 AND pred <> 1) AS only_a, count(*) FILTER (WHERE quality <> 1 AND pred = 1) AS only_b, count(*) FILTER (WHERE quality <> 1 AND pred <> 1) AS neither FROM r")
def paired_report(spark, sf):
    return measure.paired(_rows(spark, sf), "quality", "pred")


def _drawn(text: str) -> str:
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) AS DOUBLE) / {float(16**12)})"


def _sql_interval(units: str, drawn: str, value) -> str:
    """Percentiles by the nearest rank, halves to even, over the draws that have a value."""
    at = lambda q: f"list_sort(list(v))[CAST(round_even({q} * (count(v) - 1), 0) AS BIGINT) + 1]"
    return f"""WITH {_ROWS}, {units}, {drawn}, v AS (SELECT draw, {value('k * ')} AS v FROM drawn GROUP BY draw), i AS (SELECT {at(0.025)} AS low, {at(0.975)} AS high FROM v WHERE v IS NOT NULL)
SELECT (SELECT round({value('')}, 9) FROM u) AS point, round(low, 9) AS low, round(high, 9) AS high FROM i"""


_UNITS = "u AS (SELECT lang AS s, CAST({unit} AS VARCHAR) AS unit, {sums} FROM r GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY unit) - 1 AS no FROM u)"
_PICKS = """z AS (SELECT s, count(*) AS size FROM u GROUP BY s), p AS (SELECT s, draw, slot, size FROM (SELECT s, size, unnest(range(1, 101)) AS draw FROM z), LATERAL (SELECT unnest(range(0, size)) AS slot)),
q AS (SELECT s, draw, CASE WHEN s = 'es' THEN slot ELSE CAST(floor({u} * size) AS BIGINT) END AS no, count(*) AS k FROM p GROUP BY ALL), drawn AS (SELECT * FROM q JOIN n USING (s, no))""".replace(
    "{u}", _drawn("'20261106:' || CAST(draw AS VARCHAR) || ':' || s || ':' || CAST(slot AS VARCHAR)")
)


@query(_sql_interval(_UNITS.format(unit="source", sums="CAST(sum(quality) AS DOUBLE) AS t, CAST(count(*) AS DOUBLE) AS b"), _PICKS, lambda k: f"sum({k}t) / nullif(sum({k}b), 0)"))
def bootstrap_ci(spark, sf):
    """The share of good documents, sources drawn with replacement within each language but one that was drawn whole."""
    out = measure.resampled(_rows(spark, sf), "source", F.col("quality"), F.lit(1), draws=100, stratum="lang", census=["es"])
    return out.select(*[F.round(c, 9).alias(c) for c in ("point", "low", "high")])


_GAIN = "CAST(sum(CASE WHEN quality = pred THEN 1 ELSE 0 END) AS DOUBLE) AS t, CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS t2, CAST(count(*) AS DOUBLE) AS b"


@query(_sql_interval(_UNITS.format(unit="doc_id", sums=_GAIN), _PICKS, lambda k: f"sum({k}t) / nullif(sum({k}b), 0) - sum({k}t2) / nullif(sum({k}b), 0)"))
def paired_gain_ci(spark, sf):
    """What the length rule gains in agreement over calling everything good, on the same draws of documents."""
    hit = lambda c: F.when(c, 1).otherwise(0)
    rows = _rows(spark, sf)
    out = measure.resampled(rows, "doc_id", hit(F.col("quality") == F.col("pred")), F.lit(1), (hit(F.col("quality") == 1), F.lit(1)), draws=100, stratum="lang", census=["es"])
    return out.select(*[F.round(c, 9).alias(c) for c in ("point", "low", "high")])


_STEPS = [sum(2.718281828459045**-1 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)[: k + 1]) for k in range(8)]


@query(_sql_interval("u AS (SELECT CAST(source AS VARCHAR) AS unit, CAST(sum(quality) AS DOUBLE) AS t, CAST(count(*) AS DOUBLE) AS b FROM r GROUP BY ALL)",
    f"""p AS (SELECT *, unnest(range(1, 201)) AS draw FROM u), x AS (SELECT *, {_drawn("'20261106:' || CAST(draw AS VARCHAR) || ':' || unit")} AS w FROM p),
drawn AS (SELECT *, len(list_filter([{', '.join(map(repr, _STEPS))}], lambda c: c <= w)) AS k FROM x)""", lambda k: f"sum({k}t) / nullif(sum({k}b), 0)"))
def bootstrap_poisson(spark, sf):
    """The same share with Poisson counts of the sources, the form for any size."""
    out = measure.bootstrap(_rows(spark, sf), "source", F.col("quality"), F.lit(1))
    return out.select(*[F.round(c, 9).alias(c) for c in ("point", "low", "high")])


@query("""SELECT count(*) AS n, min(l_extendedprice) AS least, list_sort(list(l_extendedprice))[CAST(floor(0.1 * count(*)) AS BIGINT) + 1] AS p10, list_sort(list(l_extendedprice))[CAST(floor(0.5 * count(*)) AS BIGINT) + 1] AS p50,
list_sort(list(l_extendedprice))[CAST(floor(0.9 * count(*)) AS BIGINT) + 1] AS p90, round(sum(l_extendedprice) / count(*), 4) AS mean, max(l_extendedprice) AS most FROM lineitem""")
def quantiles_of_all(spark, sf):
    """Quantiles without groups, over many distinct values, by ranges."""
    return measure.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.1, 0.5, 0.9]).withColumn("mean", F.round("mean", 4))


@query("""SELECT lang, count(*) AS n, min(n_chars) AS least, list_sort(list(n_chars))[CAST(floor(0.1 * count(*)) AS BIGINT) + 1] AS p10, list_sort(list(n_chars))[CAST(floor(0.5 * count(*)) AS BIGINT) + 1] AS p50,
list_sort(list(n_chars))[CAST(floor(0.9 * count(*)) AS BIGINT) + 1] AS p90, round(sum(n_chars) * 1.0 / count(*), 6) AS mean, max(n_chars) AS most FROM documents GROUP BY lang""")
def quantiles_indexed(spark, sf):
    out = measure.quantiles(table(spark, sf, "documents"), "n_chars", [0.1, 0.5, 0.9], ["lang"])
    return out.withColumn("mean", F.round("mean", 6))


@query("""SELECT source, bool_or(n_chars > 5000) AS long, bool_or(lang = 'es') AS spanish FROM documents GROUP BY source""")
def flags_any_of(spark, sf):
    return measure.any_of(table(spark, sf, "documents"), "source", {"long": F.col("n_chars") > 5000, "spanish": F.col("lang") == "es"})


@query("""SELECT doc_id, 'all' AS scenario FROM documents UNION ALL SELECT doc_id, 'short' FROM documents WHERE n_chars < 1000 UNION ALL SELECT doc_id, 'english' FROM documents WHERE lang = 'en'""")
def scenarios(spark, sf):
    return measure.scenarios(table(spark, sf, "documents").select("doc_id", "n_chars", "lang"), {"all": F.lit(True), "short": F.col("n_chars") < 1000, "english": F.col("lang") == "en"}).select("doc_id", "scenario")


_DIMS = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"


#: Vectors of each label, by id, that stand for it, and how many of the nearest are averaged.
PROTOTYPES, NEAREST = 7, 3
MOST_LABELS = 10_000


@query(f"""WITH p AS (SELECT CAST(label AS VARCHAR) AS label, vec_id AS pid, {_DIMS} AS v FROM embeddings WHERE label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= {PROTOTYPES}),
s AS (SELECT e.vec_id, p.label, list_sum(list_transform(range(1, len(p.v) + 1), lambda i: e.v[i] * p.v[i])) / sqrt(list_sum(list_transform(e.v, lambda x: x * x))) / sqrt(list_sum(list_transform(p.v, lambda x: x * x))) AS score FROM (SELECT vec_id, {_DIMS} AS v FROM embeddings) e, p),
m AS (SELECT vec_id, label, round(avg(score), 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, label ORDER BY score DESC) AS r FROM s) WHERE r <= {NEAREST} GROUP BY vec_id, label),
o AS (SELECT vec_id, list(label ORDER BY score DESC, label) AS l, list(score ORDER BY score DESC, label) AS x FROM m GROUP BY vec_id)
SELECT vec_id, l[1] AS candidate, round(x[1] - x[2], 6) AS margin, CASE WHEN x[1] - x[2] >= 0.0293 THEN 'assigned' ELSE 'out_of_scope' END AS status FROM o""")
def prototype_gate(spark, sf):
    """Cosine to the prototypes of each label, the mean of the three nearest, the gap of the two best labels, and the gate.

    The prototypes are a dimension of a few vectors a label; they are sent to every task once their number is checked.
    """
    rows = table(spark, sf, "embeddings")
    named = rows.where("label is not null").select(F.col("label").cast("string").alias("label"), "vec_id", "embedding")
    by_id = Window.partitionBy("label").orderBy("vec_id")
    first = named.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= PROTOTYPES).select("label", S.unit(F.col("embedding")).alias("p"))
    labels = [r.label for r in first.select("label").distinct().limit(MOST_LABELS + 1).collect()]
    if len(labels) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels: their prototypes are no dimension")
    protos = first.groupBy("label").agg(F.collect_list("p").alias("p")).agg(F.collect_list(F.struct("label", "p")).alias("protos"))  # one row
    u = rows.select("vec_id", S.unit(F.col("embedding")).alias("u")).join(F.broadcast(protos), F.lit(True))
    near = lambda x: S.top_mean(F.transform(x["p"], lambda p: S.dot(F.col("u"), p)), NEAREST)
    scores = F.map_from_entries(F.transform("protos", lambda x: F.struct(x["label"], F.round(near(x), 9))))
    out = u.select("vec_id", N.gate(scores, sorted(labels), F.lit(""), 0.0293).alias("g"))
    return out.select("vec_id", "g.candidate", F.round("g.margin", 6).alias("margin"), "g.status")


def _sql_stack() -> str:
    z = [f"{b} + " + " + ".join(f"({c}) * f{k}" for k, c in enumerate(row)) for row, b in zip(COEF, INTERCEPT, strict=True)]
    return f"""WITH {_ROWS}, f AS (SELECT doc_id, ln(0.2 + 0.6 * quality) AS f0, ln(0.1 + 0.3 * toxic) AS f1, ln(0.5) AS f2, ln(greatest(least(score, 0.999999), 0.000001) / (1 - greatest(least(score, 0.999999), 0.000001))) AS f3 FROM r),
z AS (SELECT doc_id, {z[0]} AS a, {z[1]} AS b, {z[2]} AS c FROM f), p AS (SELECT doc_id, exp(a) / (exp(a) + exp(b) + exp(c)) AS pa, exp(b) / (exp(a) + exp(b) + exp(c)) AS pb, exp(c) / (exp(a) + exp(b) + exp(c)) AS pc FROM z)
SELECT doc_id, round(pa, 9) AS positive, round(pb, 9) AS negative, round(pc, 9) AS neutral, CASE WHEN pa >= pb AND pa >= pc THEN 'positive' WHEN pb >= pc THEN 'negative' ELSE 'neutral' END AS label FROM p"""


@query(_sql_stack())
def stack_logit(spark, sf):
    """The stacked logistic decision on made-up probabilities."""
    p = [F.lit(0.2) + 0.6 * F.col("quality"), F.lit(0.1) + 0.3 * F.col("toxic"), F.lit(0.5)]
    rows = _rows(spark, sf).withColumn("s", S.softmax_stack(p, F.col("score"), scorers.STACK_CLASSES, COEF, INTERCEPT))
    return rows.select("doc_id", *[F.round(f"s.{c}", 9).alias(c) for c in scorers.STACK_CLASSES], S.best_class(F.col("s"), scorers.STACK_CLASSES).alias("label"))


@query("""WITH e AS (SELECT vec_id, abs(embedding[1]) AS a, abs(embedding[2]) AS b, abs(embedding[3]) AS c, abs(embedding[4]) AS d FROM embeddings),
x AS (SELECT vec_id, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(c AS DOUBLE) AS c, CAST(d AS DOUBLE) AS d FROM e),
l AS (SELECT *, CASE greatest(a, b, c, d) WHEN a THEN 'earnings_performance' WHEN b THEN 'capital_shareholder_returns' WHEN c THEN 'market_analyst_sentiment' ELSE 'other' END AS label FROM x)
SELECT vec_id, label, round(CASE label WHEN 'earnings_performance' THEN a + b WHEN 'capital_shareholder_returns' THEN a + b WHEN 'market_analyst_sentiment' THEN c ELSE d END / (a + b + c + d), 9) AS group_score FROM l""")
def category_group_mass(spark, sf):
    """Argmax label of four made-up scores, and its group's share of their sum."""
    labels = ("earnings_performance", "capital_shareholder_returns", "market_analyst_sentiment", "other")
    x = [F.abs(F.col("embedding")[k]).cast("double") for k in range(4)]
    rows = table(spark, sf, "embeddings").select("vec_id", F.struct(*[c.alias(n) for c, n in zip(x, labels, strict=True)]).alias("s"))
    label = S.best_class(F.col("s"), labels)
    scores = F.create_map(*[y for n in labels for y in (F.lit(n), F.col(f"s.{n}"))])
    out = rows.select("vec_id", label.alias("label"), scores.alias("scores"))
    return out.select("vec_id", "label", F.round(N.group_share(F.col("scores"), scorers.GROUP_OF, F.col("label")), 9).alias("group_score"))


@query("""WITH s AS (SELECT vec_id, list_transform(range(0, 4), lambda i: {'k': 'l' || i, 'v': round(abs(CAST(embedding[i + 1] AS DOUBLE)), 6)}) AS e FROM embeddings), o AS (SELECT vec_id, unnest(e) AS e FROM s),
r AS (SELECT vec_id, e.k AS k, e.v AS v, row_number() OVER (PARTITION BY vec_id ORDER BY e.v DESC, e.k) AS n, max(e.v) OVER (PARTITION BY vec_id) AS top FROM o),
f AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n) AS m FROM r WHERE n = 1 OR (v >= 0.05 AND v >= top * 0.5)) SELECT vec_id, string_agg(k, ',' ORDER BY m) AS labels FROM f WHERE m <= 3 GROUP BY vec_id""")
def label_sets(spark, sf):
    """The top label with those near it, three at most."""
    scores = F.create_map(*[y for k in range(4) for y in (F.lit(f"l{k}"), F.round(F.abs(F.col("embedding")[k].cast("double")), 6))])
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(N.predict_set(scores, 0.05, 0.5), ",").alias("labels"))
