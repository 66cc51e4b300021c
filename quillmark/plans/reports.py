"""Queries that check and report on judged rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmark.operators import audit

from .registry import query, table

_JOINED = "j AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id))"


def _judged(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf, "labels"), "doc_id")


@query("""WITH e AS (SELECT vec_id, [CAST(embedding[1] AS DOUBLE), CAST(embedding[2] AS DOUBLE), CAST(embedding[3] AS DOUBLE)] AS v, label FROM embeddings),
r AS (SELECT vec_id, ['a', 'b', 'c'][list_position(v, list_max(v))] AS top, CASE label % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS l FROM e)
SELECT count(vec_id) - count(DISTINCT vec_id) AS repeated, CAST(0 AS BIGINT) AS not_finite, count(*) FILTER (WHERE top <> l) AS other_label FROM r""")
def score_integrity(spark, sf):
    """Repeated keys, scores that are no numbers, labels that are not those of the highest score."""
    rows = table(spark, sf, "embeddings").select("vec_id", F.create_map(*[x for k, n in enumerate("abc") for x in (F.lit(n), F.col("embedding")[k].cast("double"))]).alias("scores"), F.expr("CASE label % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END").alias("l"))
    return audit.integrity(rows, "vec_id", "scores", "l")


@query(f"WITH {_JOINED}, b AS (SELECT unnest(range(0, 8)) AS band) SELECT CAST(band AS INTEGER) AS band, count(*) FILTER (WHERE quality = 1) AS yes, count(doc_id) AS total FROM b LEFT JOIN j ON CAST(floor(n_chars / 1500.0) AS INTEGER) = band GROUP BY band")
def yes_by_band(spark, sf):
    rows = _judged(spark, sf).withColumn("band", F.floor(F.col("n_chars") / 1500.0).cast("int"))
    return audit.bands(rows, "band", F.col("quality") == 1, 7)


@query(f"""WITH {_JOINED}, p AS (SELECT CASE WHEN n_chars < 800 THEN 'short' WHEN n_chars < 2500 THEN 'middle' ELSE 'long' END AS p, CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN 'short' WHEN lang = 'en' THEN 'middle' ELSE 'long' END AS t FROM j), l AS (SELECT unnest(['short', 'middle', 'long']) AS label)
SELECT label, count(*) FILTER (WHERE p = label AND t = label) AS "right", count(*) FILTER (WHERE p = label AND t IS NOT NULL AND t <> label) AS wrong, count(*) FILTER (WHERE p = label AND t IS NULL) AS unknown, count(*) FILTER (WHERE t = label) AS truth FROM p, l GROUP BY label""")
def one_against_rest(spark, sf):
    """Each label against the others, where some truths are not known."""
    said = F.when(F.col("n_chars") < 800, "short").when(F.col("n_chars") < 2500, "middle").otherwise("long")
    truth = F.when(F.col("toxic") == 1, None).when(F.col("quality") == 0, "short").when(F.col("lang") == "en", "middle").otherwise("long")
    return audit.one_against_rest(_judged(spark, sf).select(said.alias("p"), truth.alias("t")), "p", "t", ["short", "middle", "long"])


@query(f"""WITH {_JOINED}, q AS (SELECT source, quality = 1 AS good, toxic = 0 AS civil, n_chars > 500 AS whole FROM j), b AS (SELECT source, count(*) AS pieces, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE civil) AS civil, count(*) FILTER (WHERE whole) AS whole,
count(*) FILTER (WHERE good AND civil AND whole) AS clean, bool_and(good AND civil AND whole) AS every FROM q GROUP BY source)
SELECT CAST(sum(pieces) AS BIGINT) AS pieces, CAST(sum(good) AS BIGINT) AS good, CAST(sum(civil) AS BIGINT) AS civil, CAST(sum(whole) AS BIGINT) AS whole, CAST(sum(clean) AS BIGINT) AS clean_pieces, count(*) AS bodies, count(*) FILTER (WHERE every) AS clean_bodies FROM b""")
def clean_levels(spark, sf):
    """Yes to each question, pieces clean in all, bodies whose pieces all are."""
    return audit.levels(_judged(spark, sf), "source", {"good": F.col("quality") == 1, "civil": F.col("toxic") == 0, "whole": F.col("n_chars") > 500})


@query(f"""WITH {_JOINED}, p AS (SELECT a.source, CASE WHEN a.n_chars > b.n_chars THEN 1.0 WHEN a.n_chars = b.n_chars THEN 0.5 ELSE 0.0 END AS w FROM j a JOIN j b ON a.source = b.source AND a.quality = 1 AND b.quality <> 1)
SELECT count(DISTINCT source) AS keys, count(*) AS pairs, round(avg(w), 9) AS accuracy FROM p""")
def ranking_accuracy(spark, sf):
    """Pairs of a good and a poor document of one source in the order of their lengths, by rank sums."""
    return audit.ranking_accuracy(_judged(spark, sf), "source", "n_chars", "quality").withColumn("accuracy", F.round("accuracy", 9))


@query("""WITH i AS (SELECT l_orderkey, max(l_extendedprice) AS s, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS y FROM lineitem GROUP BY l_orderkey), g AS (SELECT s, sum(y) AS p, sum(1 - y) AS n FROM i GROUP BY s),
b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) SELECT round(sum(p * (below + n / 2.0)) / (sum(p) * sum(n)), 9) AS auc FROM b""")
def item_auc(spark, sf):
    """The area over orders, each by its dearest line, true if any line was returned."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", (F.col("l_returnflag") == "R").alias("y"))
    return audit.item_auc(rows, "l_orderkey", "l_extendedprice", "y").select(F.round("auc", 9).alias("auc"))


@query("""SELECT text, array_to_string(list_sort(list(DISTINCT role)), ',') AS owners FROM conversations GROUP BY text""")
def merged_texts(spark, sf):
    out = audit.merged_texts(table(spark, sf, "conversations"), "text", "role")
    return out.select("text", F.array_join("owners", ",").alias("owners"))


@query(f"""WITH {_JOINED}, g AS (SELECT lang AS stratum, count(*) AS n FROM j GROUP BY lang), d(s, w) AS (VALUES ('en', 10), ('de', 5), ('xx', 3))
SELECT coalesce(stratum, s) AS stratum, coalesce(n, 0) AS n, CAST(coalesce(w, 0) AS BIGINT) AS wanted FROM g FULL JOIN d ON stratum = s WHERE coalesce(n, 0) <> coalesce(w, 0)""")
def design_problems(spark, sf):
    """Strata that a design asks other numbers of."""
    return audit.design_problems(_judged(spark, sf), "lang", {"en": 10, "de": 5, "xx": 3})


@query(f"""WITH {_JOINED}, r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('3:' || CAST(doc_id AS VARCHAR)), doc_id) <= CASE lang WHEN 'en' THEN 12 WHEN 'fr' THEN 4 ELSE 0 END AS inside FROM j)
SELECT doc_id, lang FROM r ORDER BY inside DESC, md5('3:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 30""")
def filled_quota(spark, sf):
    """Thirty rows: a quota of two languages, then others by hash."""
    return audit.filled_quota(_judged(spark, sf).select("doc_id", "lang"), "lang", "doc_id", 30, {"en": 12, "fr": 4}, 3)


@query(f"""WITH {_JOINED}, f AS (SELECT *, CAST(CAST('0x' || substr(md5('5:' || source), 1, 12) AS BIGINT) % 3 AS INTEGER) AS fold FROM j), c AS (SELECT k.fold, avg(n_chars) AS cut FROM f, (SELECT unnest([0, 1, 2]) AS fold) k WHERE f.fold <> k.fold GROUP BY k.fold)
SELECT doc_id, f.fold, CASE WHEN n_chars >= cut THEN 1 ELSE 0 END AS predicted FROM f JOIN c USING (fold)""")
def cross_fitted(spark, sf):
    """Each fold's documents by a length that was fitted on the other folds; sources stay together."""
    from quillmark.operators import sampling

    rows = sampling.group_folds(_judged(spark, sf), "source", 3, 5)
    out = audit.cross_fitted(rows, "fold", lambda other: other.agg(F.avg("n_chars").alias("cut")), lambda own: own.withColumn("predicted", (F.col("n_chars") >= F.col("cut")).cast("int")), 3)
    return out.select("doc_id", "fold", "predicted")


@query("""WITH e AS (SELECT event_id, user_id, event_id * 3 AS a, event_id * 3 + 2 AS b FROM events), s AS (SELECT user_id AS u, event_id * 3 + 1 AS x, event_id * 3 + CASE WHEN event_id % 5 = 0 THEN 9 ELSE 2 END AS y, event_type = 'click' AS same FROM events WHERE value > 50),
m AS (SELECT event_id, user_id, a, b, min(CASE WHEN u IS NULL THEN '4 not_seen' WHEN NOT same THEN '3 other_type' WHEN x <= a AND y >= b THEN '2 run_on' ELSE '1 cut_short' END) AS k FROM e LEFT JOIN s ON user_id = u AND x < b AND y > a GROUP BY ALL)
SELECT user_id, CAST(event_id AS VARCHAR) AS name, a AS start, b AS "end", substr(k, 3, 20) AS cause FROM m""")
def miss_causes(spark, sf):
    """Made-up missed names by the spans of their user that overlap them."""
    events = table(spark, sf, "events")
    at = F.col("event_id") * 3
    missed = events.select("user_id", F.col("event_id").cast("string").alias("name"), at.alias("start"), (at + 2).alias("end"))
    spans = events.where("value > 50").select("user_id", (at + 1).alias("start"), (at + F.when(F.col("event_id") % 5 == 0, 9).otherwise(2)).alias("end"), F.col("event_type").alias("entity_type"), F.lit("click").alias("wanted"))
    return audit.miss_causes(missed, spans, "user_id")


@query(f"""WITH {_JOINED}, f AS (SELECT doc_id, CASE WHEN n_chars < 200 THEN 'short' WHEN toxic = 1 THEN 'toxic' WHEN lang <> 'en' THEN 'language' END AS dropped FROM j) SELECT coalesce(dropped, 'kept') AS dropped, count(*) AS n FROM f GROUP BY ALL""")
def funnel(spark, sf):
    """What a funnel of filters drops, each row by its first reason."""
    out = audit.funnel(_judged(spark, sf), [("short", F.col("n_chars") < 200), ("toxic", F.col("toxic") == 1), ("language", F.col("lang") != "en")])
    return out.groupBy(F.coalesce("dropped", F.lit("kept")).alias("dropped")).agg(F.count("*").alias("n"))
