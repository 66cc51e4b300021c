"""Queries that run the rule expressions and small operators over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmark.functions import dates as D
from quillmark.functions import structures as N
from quillmark.functions import text as T
from quillmark.operators import matching, measure, relational, sampling, stages

from .corpus import COLLAPSED, HASH, WS
from .registry import query, table

_GAPS = "[ \\x{a0}\\t,''`\\x{b4}\\x{2019}\\x{2013}\\x{2014}-]+"


@query(f"""SELECT p_partkey, strip_accents('É' || p_name) AS folded, substr(p_name, 1, 1) || substr(p_name, 2, 1) || ' ' || p_name AS squashed, trim(regexp_replace(lower(p_name || '-' || p_brand || ', Inc'), '{_GAPS}', ' ', 'g')) AS form,
p_name AS short, CASE WHEN p_size % 3 = 0 THEN '''=' || p_name ELSE p_name END AS safe, p_name || '|' || p_brand AS items, CASE WHEN p_size >= 30 THEN 3 WHEN p_size >= 20 THEN 2 WHEN p_size >= 10 THEN 1 ELSE 0 END AS bucket,
CASE WHEN p_size % 15 <= 2 THEN CAST(p_size % 15 AS VARCHAR) WHEN p_size % 15 <= 5 THEN '3-5' WHEN p_size % 15 <= 10 THEN '6-10' ELSE '11+' END AS counted FROM part""")
def name_rules(spark, sf):
    """Keys and cells made of names."""
    name, size = F.col("p_name"), F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", T.fold_accents(F.concat(F.lit("É"), name)).alias("folded"), T.squash_initials(F.concat(F.substring(name, 1, 1), F.lit(" "), F.substring(name, 2, 1), F.lit(" "), name)).alias("squashed"),
        T.form_key(F.concat(name, F.lit("-"), "p_brand", F.lit(", Inc"))).alias("form"), T.singular(T.company_name(F.concat(name, F.lit("s ("), "p_type", F.lit(")")))).alias("short"),
        T.spreadsheet_safe(F.concat(F.when(size % 3 == 0, "=").otherwise(""), name)).alias("safe"), F.array_join(T.split_list(F.concat(name, F.lit(" , "), "p_brand", F.lit(",,"))), "|").alias("items"),
        T.length_bucket(size, [10, 20, 30]).alias("bucket"), T.count_bucket(size % 15).alias("counted"),
    )


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''").replace("\n", "\\n") + "'"


_FURNISHED = "'Sign up for ' || source || '. ' || text || ' Compiled by FactSet.' || chr(10) || 'End'"
_TITLE = "CASE WHEN n_chars < 600 THEN 'Stocks to watch' ELSE source END"
_NOTE = "CASE lang WHEN 'en' THEN 'the Economy' WHEN 'de' THEN 'a sector' WHEN 'fr' THEN 'two companies' ELSE '' END"
_LABEL = "CASE WHEN toxic = 1 THEN ' Unrelated ' WHEN quality = 0 THEN 'other' ELSE 'x' END"


@query(f"""WITH d AS (SELECT *, list_filter(list_transform(regexp_split_to_array(text, '\\n+'), lambda x: regexp_replace(regexp_replace(x, '^{WS}+', ''), '{WS}+$', '')), lambda x: length(x) >= 20) AS p FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, substr({HASH}, 1, 32) AS short_hash, substr({COLLAPSED}, 1, 80) AS head, p[2] AS second, CAST(length(regexp_replace({_FURNISHED}, {_sql(T.BOILERPLATE)}, ' ', 'g')) AS INTEGER) AS chars,
(n_chars < 600 OR n_chars % 7 >= 3 OR n_chars % 11 >= 5) AS roundup, CASE WHEN toxic = 1 THEN 'unrelated' WHEN lang = 'en' THEN 'market_economy' WHEN lang = 'de' THEN 'sector' WHEN lang = 'fr' THEN 'multi' WHEN quality = 0 THEN 'investing_general' ELSE 'single' END AS gold,
CASE WHEN lang = 'en' THEN 'single' ELSE lang END AS combined, coalesce(length(p[1]) < 80 AND NOT regexp_matches(p[1], '[.!?]["'')\\x{{201d}}]?$'), false) AS fragment FROM d""")
def text_rules(spark, sf):
    """Rules over bodies: keys, segments, boilerplate, round-ups, scopes of notes."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    c, n = F.col("text"), F.col("n_chars")
    return docs.select(
        "doc_id", T.short_hash(c).alias("short_hash"), T.company_segment(c).alias("head"), T.segment_text(c, 1).alias("second"), F.length(T.strip_boilerplate(F.expr(_FURNISHED.replace("chr(10)", "char(10)")))).alias("chars"),
        T.is_roundup(F.expr(_TITLE), F.lit("a-slug"), n % 7, n % 11).alias("roundup"), T.gold_scope(F.expr(_LABEL), F.expr(_NOTE)).alias("gold"), T.combine_scope(F.when(F.col("lang") == "en", "company").otherwise(F.col("lang")), F.lit("single")).alias("combined"),
        F.coalesce(T.is_fragment(T.segment_text(c, 0)), F.lit(False)).alias("fragment"),
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamped, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS crawled, strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS published,
CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE '2020-01-01T00:00:00Z' END AS effective, CAST(strftime(ts, '%Y') AS INTEGER) AS year, strftime(ts, '%Y-%m') AS month, CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y') ELSE 'unknown' END AS known,
CASE WHEN date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) >= 0 AND date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) % 7 = 0 THEN CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS BIGINT) END AS week,
event_id % 5 <> 0 AS shaped FROM events""")
def date_rules(spark, sf):
    """Dates as they are stored, read and put on the grid."""
    ts, i = F.col("ts").cast("timestamp"), F.col("event_id")
    s = D.stamp(ts)
    rfc = F.date_format(ts, "E, d MMM yyyy HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id", s.alias("stamped"), D.crawl_date(F.when(i % 2 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss'+00:00'")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))).alias("crawled"),
        D.pub_date(F.concat(rfc, F.lit(" +0200"))).alias("published"), D.effective_date(F.when(i % 3 == 0, s).otherwise(""), F.lit("2020-01-01T00:00:00Z")).alias("effective"), D.year_of(s).alias("year"), D.year_month(ts).alias("month"),
        T.year_or_unknown(F.when(i % 4 == 0, s).otherwise("no date")).alias("known"), D.index_of(F.to_date(ts), "2024-01-01", 7).alias("week"), D.stamp_ok(F.when(i % 5 == 0, F.date_format(ts, "yyyy-MM-dd")).otherwise(s)).alias("shaped"),
    )


@query("""SELECT i AS period, strftime(TIMESTAMP '2022-01-03 15:00:00' + to_days(CAST(i * 21 AS INTEGER)) + CASE WHEN (i * 21 + 2) BETWEEN 71 AND 308 THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END, '%Y-%m-%dT%H:%M:%SZ') AS cut FROM (SELECT unnest(range(0, 17)) AS i)""")
def cut_times(spark, sf):
    """The cuts of a year at 15:00 in New York, in UTC: summer time from 13 March to 6 November 2022."""
    return spark.range(17).select(F.col("id").alias("period"), D.stamp(D.cut_utc(F.col("id"))).alias("cut"))


@query("""WITH v AS (SELECT vec_id, [round(abs(CAST(embedding[1] AS DOUBLE)), 6), round(abs(CAST(embedding[2] AS DOUBLE)), 6), round(abs(CAST(embedding[3] AS DOUBLE)), 6)] AS x FROM embeddings), e AS (SELECT vec_id, unnest(['a', 'b', 'c']) AS k, unnest(x) AS s, unnest([0.1, 0.2, 0.05]) AS cut FROM v),
o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, k) AS r, count(*) FILTER (WHERE s >= cut) OVER (PARTITION BY vec_id) AS n FROM e)
SELECT vec_id, string_agg(k, ',' ORDER BY r) FILTER (WHERE s >= cut OR (n = 0 AND r = 1)) AS own, max(s) FILTER (WHERE k <> 'c') AS ab, max(s) FILTER (WHERE k = 'c') AS c, array_to_string(list_sort(list(DISTINCT CASE WHEN k = 'b' THEN 'a' ELSE k END) FILTER (WHERE s >= cut OR (n = 0 AND r = 1))), ',') AS merged FROM o GROUP BY vec_id""")
def label_rules(spark, sf):
    """Labels over their own cuts, and labels and columns merged."""
    scores = F.create_map(*[y for k, n in enumerate("abc") for y in (F.lit(n), F.round(F.abs(F.col("embedding")[k].cast("double")), 6))])
    own = N.set_by_thresholds(scores, {"a": 0.1, "b": 0.2, "c": 0.05})
    both = N.merged(scores, {"ab": ["a", "b"], "c": ["c"]})
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(own, ",").alias("own"), both["ab"].alias("ab"), both["c"].alias("c"), F.array_join(F.array_sort(N.merge_labels(own, {"b": "a"})), ",").alias("merged"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, 0 AS absent, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS score, CASE WHEN event_id % 2 = 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS replied, CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'a,b' END AS labels FROM events""")
def stored_json(spark, sf):
    """Stored objects, the object in a reply, and lists of labels."""
    reply = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Sure: "), "props", F.lit(" that is it"))).otherwise("no object")
    cell = F.when(F.col("event_id") % 3 == 0, "a; uncertain, z, a").otherwise("a, b;b")
    return table(spark, sf, "events").select(
        "event_id", N.stored_number(F.col("props"), "k").alias("k"), N.stored_number(F.col("props"), "none").alias("absent"), N.class_scores(F.replace("props", F.lit("{"), F.lit('{"_v": 1, ')))["k"].alias("score"),
        N.first_object(reply, "k int")["k"].alias("replied"), F.array_join(N.parse_labels(cell, ["a", "b", "uncertain"]), ",").alias("labels"),
    )


@query("""WITH c AS (SELECT o_orderpriority, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS r FROM orders WHERE o_orderstatus = 'P') WHERE r <= 20 GROUP BY 1),
w(p, wanted) AS (VALUES ('1-URGENT', 5), ('2-HIGH', 100000), ('9-NONE', 1)) SELECT p AS o_orderpriority, CAST(wanted AS BIGINT) AS wanted, CAST(coalesce(n, 0) AS BIGINT) AS drawn FROM w LEFT JOIN c ON o_orderpriority = p WHERE coalesce(n, 0) < wanted""")
def quota_shortfalls(spark, sf):
    chosen = sampling.quota(table(spark, sf, "orders").where("o_orderstatus = 'P'"), "o_orderpriority", "o_orderkey", 20, 7)
    return sampling.shortfalls(chosen, "o_orderpriority", {"1-URGENT": 5, "2-HIGH": 100000, "9-NONE": 1})


@query("""SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) ORDER BY (s_acctbal < 0) DESC, md5('4:' || CAST(s_suppkey AS VARCHAR)), s_suppkey LIMIT 8""")
def rare_then_fill(spark, sf):
    """All of a rare stratum, then others by hash, taken ones left out (the limit is the draw's size)."""
    taken = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").cast("long").alias("s_suppkey"))
    return sampling.all_rare_then_fill(table(spark, sf, "supplier"), F.col("s_acctbal") < 0, "s_suppkey", 8, 4, taken).select("s_suppkey")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('6:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS r FROM customer) SELECT c_custkey, c_nationkey FROM r WHERE r <= 2 ORDER BY md5('6-2:' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 20""")
def per_parent(spark, sf):
    """Two customers of a nation at most, twenty in all (the draw's size)."""
    return sampling.per_parent(table(spark, sf, "customer"), "c_nationkey", "c_custkey", 2, 20, 6).select("c_custkey", "c_nationkey")


@query("""SELECT o_orderpriority, count(*) AS size, count(*) FILTER (WHERE o_orderstatus = 'P') AS excluded, count(*) FILTER (WHERE o_orderstatus <> 'P') AS free, count(*) FILTER (WHERE o_totalprice > 100000) AS drawn FROM orders GROUP BY 1""")
def strata_sizes(spark, sf):
    out = sampling.strata_sizes(table(spark, sf, "orders"), "o_orderpriority", F.col("o_orderstatus") == "P", F.col("o_totalprice") > 100000)
    return out.select("o_orderpriority", *[F.col(c).cast("long").alias(c) for c in ("size", "excluded", "free", "drawn")])


_SETS = """s AS (SELECT doc_id, list_filter(['good', 'long', lang], lambda x: x <> 'good' OR quality = 1) AS g, list_filter(['long', 'good', 'en'], lambda x: x <> 'long' OR n_chars > 900) AS p FROM documents JOIN labels USING (doc_id)),
m AS (SELECT *, len(list_intersect(g, p)) AS common FROM s)"""


@query(f"""WITH {_SETS} SELECT round(avg(CASE WHEN list_contains(g, p[1]) THEN 1 ELSE 0 END), 9) AS hit_at_1, round(avg(CASE WHEN common = len(list_distinct(g)) AND common = len(list_distinct(p)) THEN 1 ELSE 0 END), 9) AS exact, round(sum(common) / sum(len(p)), 9) AS "precision",
round(sum(common) / sum(len(g)), 9) AS recall, round(2 * sum(common) / sum(len(g) + len(p)), 9) AS f1, round(avg(len(p)), 9) AS mean_size FROM m""")
def set_figures(spark, sf):
    """Rates of predicted label sets."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    pick = lambda *xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    g = pick(F.when(F.col("quality") == 1, "good"), F.lit("long"), F.col("lang"))
    p = pick(F.when(F.col("n_chars") > 900, "long"), F.lit("good"), F.lit("en"))
    out = measure.set_figures(rows.select(g.alias("g"), p.alias("p")), "g", "p")
    return out.select(*[F.round(c, 9).alias(c) for c in ("hit_at_1", "exact", "precision", "recall", "f1", "mean_size")])


@query("""WITH p AS (SELECT CAST(quality AS VARCHAR) AS t, CASE WHEN n_chars < 400 THEN '0' ELSE '1' END AS p FROM documents JOIN labels USING (doc_id)), l AS (SELECT DISTINCT unnest([t, p]) AS label FROM p),
c AS (SELECT label, count(*) FILTER (WHERE t = label) AS s, count(*) FILTER (WHERE p = label) AS q, count(*) FILTER (WHERE t = label AND p = label) AS tp FROM p, l GROUP BY label)
SELECT round(avg(coalesce(tp / nullif(q, 0), 0)), 9) AS macro_precision, round(avg(coalesce(tp / nullif(s, 0), 0)), 9) AS macro_recall, round(avg(coalesce(2 * tp / nullif(s + q, 0), 0)), 9) AS macro_f1 FROM c""")
def macro_means(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumn("p", F.when(F.col("n_chars") < 400, 0).otherwise(1))
    return measure.macro(measure.per_label(rows, "quality", "p")).select(*[F.round(c, 9).alias(c) for c in ("macro_precision", "macro_recall", "macro_f1")])


@query("""SELECT md5(text) AS content, count(DISTINCT source) AS folds, count(*) AS n FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1""")
def leaked_contents(spark, sf):
    """Texts that lie in more than one source."""
    return relational.shared_across(table(spark, sf, "documents").select(F.md5("text").alias("content"), "source"), "content", "source")


@query("""WITH c AS (SELECT s_suppkey % 20 AS id, 'N' || s_nationkey AS entity, count(*) AS n FROM supplier GROUP BY ALL), t AS (SELECT DISTINCT s_suppkey % 20 AS id, 'N' || s_nationkey AS entity FROM supplier WHERE s_acctbal > 5000)
SELECT c.id, c.entity, n FROM c LEFT JOIN t ON t.id = c.id AND t.entity = c.entity WHERE n >= 2 OR t.id IS NOT NULL""")
def subject_companies(spark, sf):
    """Entities named twice or in the title: suppliers' nations by group, rich ones standing for titles."""
    rows = table(spark, sf, "supplier").select((F.col("s_suppkey") % 20).alias("id"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("entity"), "s_acctbal")
    return matching.subjects(rows.groupBy("id", "entity").agg(F.count("*").alias("n")), rows.where("s_acctbal > 5000"))


@query("""WITH c AS (SELECT DISTINCT s_suppkey % 7 AS id, s_nationkey AS k FROM supplier), g AS (SELECT id, 'r' || n_regionkey AS sector, 's' || (n_nationkey % 2) AS sub, count(*) AS k FROM c JOIN nation ON n_nationkey = c.k GROUP BY ALL), n AS (SELECT id, count(*) AS n FROM c GROUP BY id),
b AS (SELECT id, max((k, sector, sub)) AS b FROM g GROUP BY id) SELECT id, b[2] AS sector, b[3] AS sub FROM b JOIN n USING (id) WHERE n >= 2 AND 2 * b[1] >= n""")
def majority_group(spark, sf):
    """The group that half of a text's entities share."""
    counts = table(spark, sf, "supplier").select((F.col("s_suppkey") % 7).alias("id"), F.col("s_nationkey").cast("string").alias("entity"))
    groups = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("entity"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("sector"), F.concat(F.lit("s"), (F.col("n_nationkey") % 2).cast("string")).alias("sub"))
    return matching.majority_group(counts, groups, "id")


@query("""WITH s AS (SELECT s_suppkey AS i, s_nationkey AS k FROM supplier), c AS (SELECT i % 9 AS id, 'N' || k AS ticker, count(*) AS mentions FROM s WHERE k < 20 GROUP BY ALL)
SELECT id, ticker, mentions, CASE WHEN (id + mentions) % 2 = 0 THEN 0.75 ELSE 0.25 END AS relevance, CASE WHEN (id + mentions) % 2 = 0 THEN 1 ELSE 0 END AS is_main FROM c""")
def spans_to_companies(spark, sf):
    """Spans that name a company of the universe, with their relevance and whether they are main."""
    spans = table(spark, sf, "supplier").select((F.col("s_suppkey") % 9).alias("id"), F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string"), F.lit(" Inc.")).alias("text"))
    names = table(spark, sf, "nation").where("n_nationkey < 20").select(F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("key"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ticker"))
    counted = spans.join(names, T.normalize_name(F.col("text")) == F.col("key")).groupBy("id", "ticker").agg(F.count("*").alias("m"))
    scores = counted.select("id", "ticker", F.when((F.col("id") + F.col("m")) % 2 == 0, 0.75).otherwise(0.25).alias("relevance"))
    return stages.companies_of(spans, "id", names, scores, 0.5)


@query("""SELECT 'body' AS item_kind, 'h' || doc_id AS item_id, 'h' || doc_id AS body_hash FROM labels UNION ALL SELECT 'sub_news', CAST(doc_id AS VARCHAR), CASE WHEN toxic = 1 THEN 'b' || quality END FROM labels""")
def item_hashes(spark, sf):
    """Items with the body they come from, where that is known."""
    labels = table(spark, sf, "labels")
    items = labels.select(F.lit("body").alias("item_kind"), F.concat(F.lit("h"), F.col("doc_id").cast("string")).alias("item_id")).unionByName(labels.select(F.lit("sub_news").alias("item_kind"), F.col("doc_id").cast("string").alias("item_id")))
    subs = labels.where("toxic = 1").select(F.col("doc_id").alias("id"), F.concat(F.lit("b"), F.col("quality").cast("string")).alias("body_hash"))
    return stages.hashes_of_items(items, subs)
