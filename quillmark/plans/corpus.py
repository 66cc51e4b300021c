"""Queries over documents, pages, conversations and labels: bodies, pending work, texts, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import text as T
from quillmark.operators import attribution, matching, parts, relational, scorers, state

from .registry import query, table

#: White space and the body hash, for DuckDB.
WS = "[\\t-\\r\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
COLLAPSED = f"trim(regexp_replace(text, '{WS}+', ' ', 'g'))"
HASH = f"sha256({COLLAPSED})"
HASHED = f"h AS (SELECT doc_id, text, lang, source, n_chars, {HASH} AS body_hash FROM documents)"
WORDS = f"list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> '')"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


UNIQUE_BODIES = f"WITH {HASHED} SELECT body_hash, min(doc_id) AS doc_id FROM h GROUP BY body_hash"


@query(UNIQUE_BODIES)
def unique_bodies(spark, sf):
    return state.unique_bodies(_docs(spark, sf), "doc_id", "text")


@query(f"""WITH {HASHED}, u AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY body_hash ORDER BY doc_id) = 1)
SELECT lang, source, count(*) AS bodies, CAST(sum(n_chars) AS BIGINT) AS chars FROM u GROUP BY lang, source""")
def unique_bodies_breakdown(spark, sf):
    first = state.unique_bodies(_docs(spark, sf), "doc_id", "text", ["lang", "source", "n_chars"])
    return first.groupBy("lang", "source").agg(F.count("*").alias("bodies"), F.sum("n_chars").alias("chars"))


@query(f"""WITH {HASHED}, done AS (SELECT DISTINCT body_hash FROM h JOIN labels USING (doc_id) WHERE quality = 0)
SELECT body_hash, min(doc_id) AS doc_id FROM h WHERE body_hash NOT IN (SELECT body_hash FROM done) GROUP BY body_hash""")
def pending_bodies_anti(spark, sf):
    """The bodies that no low-quality mark has finished."""
    docs = _docs(spark, sf)
    done = docs.join(table(spark, sf, "labels").where("quality = 0"), "doc_id").select(T.body_hash(F.col("text")).alias("item_id")).distinct()
    return state.pending_bodies(docs, done, "doc_id", "text")


@query(f"""WITH {HASHED}, scope AS (SELECT DISTINCT body_hash FROM h JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT body_hash, min(doc_id) AS doc_id FROM h WHERE body_hash IN (SELECT body_hash FROM scope) GROUP BY body_hash""")
def scoped_bodies_semi(spark, sf):
    docs = _docs(spark, sf)
    scopes = docs.join(table(spark, sf, "labels"), "doc_id").select(T.body_hash(F.col("text")).alias("body_hash"), F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("scope"))
    return state.pending_scoped(docs, scopes, scopes.limit(0).select(F.col("body_hash").alias("item_id")), "toxic", "doc_id", "text")


@query("SELECT count(DISTINCT doc_id) AS items, count(DISTINCT doc_id) FILTER (WHERE doc_id NOT IN (SELECT page_id FROM pages)) AS without_text FROM documents")
def items_without_text(spark, sf):
    items = _docs(spark, sf).select("doc_id").distinct()
    missing = items.join(table(spark, sf, "pages").select(F.col("page_id").alias("doc_id")), "doc_id", "left_anti").agg(F.count("*").alias("without_text"))
    return items.agg(F.count("*").alias("items")).join(F.broadcast(missing), F.lit(True))


@query("""SELECT d.doc_id, d.lang, d.source, l.quality, coalesce(c.turns, 0) AS turns, n_chars FROM documents d LEFT JOIN labels l USING (doc_id)
LEFT JOIN (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id) c ON c.conv_id = d.doc_id WHERE lang = 'en' ORDER BY n_chars DESC, d.doc_id LIMIT 50 OFFSET 10""")
def list_articles(spark, sf):
    """A page of a listing: joins, a child count, a total order, limit and offset."""
    docs = _docs(spark, sf).where("lang = 'en'").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"))
    return relational.page(relational.counted(docs, turns, "doc_id", "turns"), [F.desc("n_chars"), F.col("doc_id")], 50, 10)


@query("""SELECT d.doc_id, list_aggregate(list_sort(list(CAST(turn AS VARCHAR) || ':' || role)), 'string_agg', ',') AS turns FROM documents d JOIN conversations c ON c.conv_id = d.doc_id GROUP BY d.doc_id""")
def article_detail(spark, sf):
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.concat_ws(":", F.col("turn").cast("string"), "role").alias("t"))
    out = relational.nested(_docs(spark, sf).select("doc_id"), turns, "doc_id", "turns", ["t"])
    return out.where("turns is not null").select("doc_id", F.array_join(F.transform("turns", lambda x: x["t"]), ",").alias("turns"))


_LABEL = "CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END"


@query(f"""SELECT source, count(*) FILTER (WHERE l = 'positive') AS positive, count(*) FILTER (WHERE l = 'neutral') AS neutral, count(*) FILTER (WHERE l = 'negative') AS negative, count(*) AS total
FROM (SELECT source, {_LABEL} AS l FROM documents JOIN labels USING (doc_id)) GROUP BY source""")
def sentiment_pivot(spark, sf):
    rows = _docs(spark, sf).select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id").withColumn("l", F.expr(_LABEL))
    return relational.label_pivot(rows, ["source"], "l", ["positive", "neutral", "negative"])


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source ORDER BY n DESC, lang, source LIMIT 20")
def category_stats(spark, sf):
    return relational.top_counts(_docs(spark, sf), ["lang", "source"], 20)


@query(f"SELECT w AS word, count(*) AS n FROM (SELECT unnest({WORDS}) AS w FROM documents) GROUP BY w ORDER BY n DESC, w LIMIT 20")
def entity_top(spark, sf):
    """The 20 most frequent words (the limit is the report's length)."""
    return relational.top_counts(_docs(spark, sf).select(F.explode(T.words(F.col("text"))).alias("word")), ["word"], 20)


@query("""SELECT conv_id, string_agg(text, ', ' ORDER BY turn, text) AS entities FROM conversations WHERE role = 'user' AND NOT regexp_full_match(text, '[0-9]') GROUP BY conv_id""")
def entities_concat(spark, sf):
    rows = table(spark, sf, "conversations").where((F.col("role") == "user") & ~T.bare_digit(F.col("text")))
    return attribution.joined_texts(rows, ["conv_id"], ["turn"], "text", ", ").withColumnRenamed("text", "entities")


@query("""WITH e AS (SELECT conv_id, string_agg(text, ', ' ORDER BY turn, text) AS entities FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT doc_id, 'METADATA:' || chr(10) || 'Ticker-' || lang || chr(10) || 'Company-' || source || chr(10) || chr(10) || 'NLP FEATURES:' || chr(10) || 'Sentiment-' || CAST(quality AS VARCHAR) || ' Confidence-'
|| CAST(toxic AS VARCHAR) || chr(10) || 'Entities-' || entities || chr(10) || chr(10) || 'TEXT BODY:' || chr(10) || 'Title-' || source || chr(10) || 'Body-' || text AS input
FROM documents JOIN labels USING (doc_id) JOIN e ON e.conv_id = doc_id WHERE doc_id NOT IN (SELECT page_id FROM pages WHERE url LIKE '%7%')""")
def pending_summaries(spark, sf):
    """Records ready for a summary: labelled, with entities, none written; each as its template."""
    talk = table(spark, sf, "conversations").where("role = 'user'").withColumnRenamed("conv_id", "doc_id")
    rows = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").join(attribution.joined_texts(talk, ["doc_id"], ["turn"], "text", ", ").withColumnRenamed("text", "entities"), "doc_id")
    done = table(spark, sf, "pages").where("url like '%7%'").select(F.col("page_id").alias("doc_id"))
    todo = state.pending_items(rows, done, ["doc_id"])
    cols = {"ticker": "lang", "company": "source", "label": "quality", "score": "toxic", "entities": "entities", "title": "source", "body": "text"}
    return todo.select("doc_id", T.summary_input({k: F.col(v).cast("string") for k, v in cols.items()}).alias("input"))


@query(f"WITH {HASHED} SELECT lang, count(*) AS rows, count(DISTINCT body_hash) AS bodies, count(*) - count(DISTINCT body_hash) AS copies FROM h GROUP BY lang")
def corpus_breakdown(spark, sf):
    h = _docs(spark, sf).select("lang", T.body_hash(F.col("text")).alias("h")).groupBy("lang", "h").agg(F.count("*").alias("n"))
    return h.groupBy("lang").agg(F.sum("n").alias("rows"), F.count("*").alias("bodies"), (F.sum("n") - F.count("*")).alias("copies"))


@query(f"""WITH a AS (SELECT DISTINCT {HASH} AS k FROM documents WHERE lang = 'en'), b AS (SELECT DISTINCT {HASH} AS k FROM documents WHERE source = 'src0')
SELECT (SELECT count(*) FROM a) AS in_a, (SELECT count(*) FROM b) AS in_b, (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS in_either,
(SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS in_both, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_b""")
def set_difference_bodies(spark, sf):
    docs = _docs(spark, sf).withColumn("k", T.body_hash(F.col("text")))
    return relational.set_sizes(docs.where("lang = 'en'"), docs.where("source = 'src0'"), "k")


@query("""SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'lost' WHEN a.doc_id IS NULL THEN 'gained' ELSE 'changed' END AS kind
FROM (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS v FROM documents) a FULL JOIN (SELECT l.doc_id, quality AS v FROM labels l UNION ALL SELECT -1 - page_id, 1 FROM pages) b ON a.doc_id = b.doc_id
WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.v IS DISTINCT FROM b.v""")
def movement_diff(spark, sf):
    """A length rule's reading of all documents against the labels, which cover some of them and, here, pages besides: what was lost, gained, changed."""
    a = _docs(spark, sf).select("doc_id", F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("v"))
    pages = table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.lit(1).alias("v"))
    b = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("v")).unionByName(pages)
    return relational.movement(a, b, "doc_id", "v")


@query("""SELECT d.doc_id, u.c AS "column", u.a AS target, u.b AS source FROM labels d, LATERAL (VALUES ('quality', CAST(quality AS VARCHAR), CAST(CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS VARCHAR)),
('toxic', CAST(toxic AS VARCHAR), CAST(toxic AS VARCHAR))) u(c, a, b) WHERE u.a IS DISTINCT FROM u.b""")
def tag_differences(spark, sf):
    a = table(spark, sf, "labels")
    b = a.withColumn("quality", F.when(F.col("doc_id") % 7 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    return relational.tag_differences(a, b, "doc_id", ["quality", "toxic"])


@query("""SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'b' || CAST(toxic AS VARCHAR) END, ''), 'a' || CAST(quality AS VARCHAR)) AS tag,
doc_id % 3 <> 0 AS conflict FROM labels""")
def merge_tags(spark, sf):
    rows = table(spark, sf, "labels")
    a = rows.select("doc_id", F.concat(F.lit("a"), F.col("quality").cast("string")).alias("tag"))
    b = rows.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("b"), F.col("toxic").cast("string"))).alias("tag"))
    return relational.merge_tags(a, b, "doc_id", ["tag"], source_wins=True)


_SHINGLED = f"w AS (SELECT id, kind, list_distinct(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: md5(list_aggregate(w[i:i + 7], 'string_agg', ' ')))) AS s FROM (SELECT id, kind, {WORDS} AS w FROM (SELECT item_id AS id, 'b' AS kind, lower(text) AS text FROM benchmark UNION ALL SELECT doc_id, 'd', lower(text) FROM documents)) WHERE len(w) >= 8)"


@query(f"""WITH {_SHINGLED}, e AS (SELECT id, kind, unnest(s) AS s, len(s) AS n FROM w)
SELECT a.id AS item_id, b.id AS doc_id, count(*) AS shared, CAST(any_value(a.n) AS INTEGER) AS own FROM e a JOIN e b ON a.s = b.s AND a.kind = 'b' AND b.kind = 'd' GROUP BY a.id, b.id HAVING count(*) >= 0.8 * any_value(a.n)""")
def shingle_copies(spark, sf):
    """Benchmark items that a document holds at least 80% of the 8-word shingles of."""

    def sets(df, key):
        runs = F.array_distinct(F.transform(T.runs(F.lower("text"), 8), lambda r: F.md5(r)))
        return df.select(F.col(key).alias("id"), runs.alias("s")).where(F.size("s") > 0)

    out = relational.copies_of(sets(table(spark, sf, "benchmark"), "item_id"), sets(_docs(spark, sf), "doc_id"), "id", "s", 0.8, same_ids=False)
    return out.select(F.col("id").alias("item_id"), F.col("other_id").alias("doc_id"), "shared", "own")


@query("""SELECT doc_id, CAST(len(p) AS INTEGER) AS sentences, CAST(list_sum(list_transform(p, lambda s: length(s))) AS BIGINT) AS chars FROM (
SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(text, '([.!?])\\s+([A-Z0-9"''])', concat('\\1', chr(1), '\\2'), 'g'), '([.!?])\\s+([A-Z0-9"''])', concat('\\1', chr(1), '\\2'), 'g'), chr(1)), lambda s: s <> '') AS p FROM documents)""")
def sentence_split(spark, sf):
    s = T.sentences(F.col("text"))
    return _docs(spark, sf).select("doc_id", F.size(s).alias("sentences"), F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))


@query(f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS position, s AS segment FROM (SELECT doc_id, unnest(p) AS s, unnest(range(1, len(p) + 1)) AS i FROM (
SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\\n+'), lambda x: regexp_replace(regexp_replace(x, '^{WS}+', ''), '{WS}+$', '')), lambda x: length(x) >= 20) AS p FROM documents))""")
def paragraph_segments(spark, sf):
    return _docs(spark, sf).select("doc_id", F.posexplode(T.segments(F.col("text"))).alias("position", "segment"))


@query(f"""SELECT doc_id, CAST(i // 120 AS INTEGER) AS position, list_aggregate(w[i + 1:i + 120], 'string_agg', ' ') AS chunk FROM (SELECT doc_id, w, unnest(range(0, len(w), 120)) AS i FROM (SELECT doc_id, {WORDS} AS w FROM documents))""")
def word_chunks(spark, sf):
    return _docs(spark, sf).select("doc_id", F.posexplode(T.word_chunks(F.col("text"))).alias("position", "chunk"))


@query()
def chunk_pack(spark, sf):
    return attribution.chunks(_docs(spark, sf), "doc_id", "text", 128)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_footer() -> str:
    a = attribution
    like = lambda labels: f"regexp_matches(bare, {_sql(a.begins(labels))})"
    footer = f"{like(a.FOOTER)} AND ({like(a.LEGAL)} OR length(bare) <= CASE WHEN {like(a.CREDIT)} THEN {a.LONGEST_CREDIT} ELSE {a.LONGEST_FOOTER} END)"
    stripped = lambda c: f"regexp_replace(regexp_replace({c}, '^{WS}+', ''), '{WS}+$', '')"
    return f"""WITH l AS (SELECT doc_id, body, unnest(string_split(body, chr(10))) AS line, unnest(range(0, len(string_split(body, chr(10))))) AS i FROM (SELECT doc_id, {_FURNISHED} AS body FROM documents)),
b AS (SELECT *, {stripped('line')} AS bare, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM l),
c AS (SELECT *, {like(a.BLOCK)} AS block, {like(a.LINKS)} AS heading, length(bare) <= {a.LONGEST_LINK} AND NOT regexp_matches(bare, {_sql(a.SENTENCE_END)}) AS link, {like(a.ANYWHERE)} AS dropped, bare = '' OR ({footer}) AS closing FROM b),
d AS (SELECT *, min(i) FILTER (WHERE block AND ahead >= {a.TAIL} * greatest(length(body), 1)) OVER (PARTITION BY doc_id) AS cut FROM c),
e AS (SELECT *, last_value(CASE WHEN heading THEN 1 WHEN NOT link THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS linked FROM d WHERE cut IS NULL OR i < cut),
f AS (SELECT * FROM e WHERE NOT dropped AND NOT heading AND NOT (link AND coalesce(linked, 0) = 1)),
g AS (SELECT *, max(i) FILTER (WHERE NOT closing) OVER (PARTITION BY doc_id) AS last FROM f),
h AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept FROM g WHERE i <= last GROUP BY doc_id),
k AS (SELECT doc_id, CASE WHEN length({stripped("coalesce(kept, '')")}) >= {a.LEAST_KEPT} THEN kept ELSE body END AS kept FROM (SELECT doc_id, {_FURNISHED} AS body FROM documents) LEFT JOIN h USING (doc_id))
SELECT doc_id, CAST(length(kept) AS INTEGER) AS kept_chars, md5(kept) AS digest FROM k"""


#: Documents with the furniture of a site by their language, as the test corpus has next to none.
_FURNISHED = """CASE lang WHEN 'en' THEN text || chr(10) || 'More from ' || source || chr(10) || 'A link' || chr(10) || 'Copyright 2020 ' || source
WHEN 'de' THEN 'Jane Doe contributed to this report' || chr(10) || text || chr(10) || 'Disclosures: none' || chr(10) || text
WHEN 'fr' THEN 'Related: more' || chr(10) || text || chr(10) || 'Read more here' || chr(10) || text || chr(10) || '----' ELSE text END"""


@query(_sql_footer())
def strip_footer(spark, sf):
    docs = _docs(spark, sf).select("doc_id", F.expr(_FURNISHED.replace("chr(10)", "char(10)")).alias("text"))
    out = attribution.strip_footer(docs, "doc_id", "text")
    return out.select("doc_id", F.length("kept_text").alias("kept_chars"), F.md5("kept_text").alias("digest"))


_BREAK = "regexp_replace(regexp_replace({t}, '([.!?])\\s+([A-Z0-9\"''])', concat('\\1', chr(1), '\\2'), 'g'), '([.!?])\\s+([A-Z0-9\"''])', concat('\\1', chr(1), '\\2'), 'g')"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM documents),
s AS (SELECT doc_id, line, list_filter(string_split({_BREAK.format(t="regexp_replace(l, '^[-•·▪*–—]\\s+', '')")}, chr(1)), lambda x: x <> '') AS s FROM l),
p AS (SELECT doc_id, line, flatten(list_transform(s, lambda x: regexp_split_to_array(x, '[;]\\s+|\\s+[•·▪|]\\s+'))) AS p FROM s)
SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(position AS INTEGER) AS position, piece FROM (SELECT doc_id, line, unnest(p) AS piece, unnest(range(0, len(p))) AS position FROM p) WHERE trim(piece) <> ''""")
def attribution_pieces(spark, sf):
    return attribution.pieces(_docs(spark, sf), "doc_id", "text")


@query("""SELECT page_id, regexp_replace(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1), '\\.html?$', '') AS slug, trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g')) AS title_key FROM pages""")
def slug_and_title_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.slug_of(F.col("url")).alias("slug"), T.title_key(F.col("url")).alias("title_key"))


@query("""SELECT doc_id, length(t) AS chars, sha256(t) AS text_hash, sha256(source || chr(10) || text) AS source_hash FROM (SELECT doc_id, source, text, regexp_replace(regexp_replace(text, '^%s+', ''), '%s+$', '') AS t FROM documents)""" % (WS, WS))
def text_keys(spark, sf):
    c = F.col("text")
    return _docs(spark, sf).select("doc_id", F.length(T.strip(c)).cast("long").alias("chars"), T.text_hash(c).alias("text_hash"), T.source_hash(F.col("source"), c).alias("source_hash"))


def _hits(terms) -> str:
    import re

    body = "|".join(re.escape(t).replace("'", "''") for t in sorted(terms, key=len, reverse=True))
    # a mark before each word start and end stands in for look-around
    return f"len(regexp_extract_all(regexp_replace(lower(text), '([^a-z0-9_&]+)', ' \\1 ', 'g'), '(?:^| )(?:{body})(?: |$)'))"


#: Sentences with the keyword lists' words by source, as the test corpus has none of them.
_TOPICS = """CASE WHEN source IN ('src0', 'src1') THEN text || ' The Fed, inflation; STOCKS rally.' WHEN source IN ('src2', 'src3') THEN text || ' S&P 500 futures, the sell-off' ELSE text || ' economy' END"""


def _hits(terms) -> str:
    """Whole words counted in DuckDB: other characters become marks, so that two terms can share one."""
    import re

    body = "|".join(re.escape(t).replace("'", "''").replace("\\ ", " ") for t in sorted(terms, key=len, reverse=True))
    return f"CAST(len(regexp_extract_all(regexp_replace(' ' || lower(t) || ' ', '([^a-z0-9_&])', '\\1\\1', 'g'), '[^a-z0-9_&](?:{body.replace(' ', '  ').replace('-', '--')})[^a-z0-9_&]')) AS INTEGER)"


@query(f"""WITH t AS (SELECT doc_id, {_TOPICS} AS t FROM documents), n AS (SELECT doc_id, {_hits(T.ECONOMY_TERMS)} AS e, {_hits(T.MARKET_TERMS)} AS m FROM t)
SELECT doc_id, e AS economy, m AS market, CASE WHEN greatest(e, m) < 2 THEN 'no_company' WHEN e >= m THEN 'economy' ELSE 'market' END AS scope FROM n""")
def keyword_scope(spark, sf):
    rows = _docs(spark, sf).select("doc_id", F.expr(_TOPICS).alias("t"))
    return rows.select("doc_id", T.keyword_hits(F.col("t"), T.ECONOMY_TERMS).alias("economy"), T.keyword_hits(F.col("t"), T.MARKET_TERMS).alias("market"), T.keyword_scope(F.col("t")).alias("scope"))


@query("""WITH d AS (SELECT doc_id, text, n_nationkey AS k, replace(n_name, 'NATION_', 'Nation-') AS n FROM documents JOIN nation ON n_nationkey = doc_id % 25),
m AS (SELECT *, length(text) + 1 AS a FROM d)
SELECT doc_id, 0 AS position, CAST(a AS INTEGER) AS start, CAST(a + length(n) AS INTEGER) AS "end", 'N' || k AS entity, 'name' AS kind, CAST(NULL AS VARCHAR) AS disclosed FROM m
UNION ALL SELECT doc_id, 1, CAST(a + length(n) + 6 AS INTEGER), CAST(a + length(n) + 16 AS INTEGER), 'N1', 'ticker', NULL FROM m""")
def mentions_dict(spark, sf):
    """Mentions of nations, whose number bounds the dictionary, in documents that each have a name and a ticker form at their end."""
    nation = table(spark, sf, "nation")
    names = [(f"N{r.n_nationkey}", r.n_name.title().replace("_", " ")) for r in nation.select("n_nationkey", "n_name").collect()]
    dictionary = matching.Dictionary(names)
    own = nation.select(F.col("n_nationkey").cast("long").alias("k"), F.replace("n_name", F.lit("NATION_"), F.lit("Nation-")).alias("n"))
    docs = _docs(spark, sf).withColumn("k", F.pmod("doc_id", F.lit(25)))
    docs = docs.join(F.broadcast(own), "k").select("doc_id", F.concat("text", F.lit(" "), "n", F.lit(" said (NYSE: N1) on Monday.")).alias("text"))
    return matching.mention_spans(docs, "doc_id", "text", dictionary)


@query("""SELECT conv_id, turn, last_value(CASE WHEN text LIKE '%a%e%i%' THEN role END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS owner FROM conversations""")
def carry_forward_attribution(spark, sf):
    named = F.when(F.col("text").like("%a%e%i%"), F.col("role"))
    return attribution.carried(table(spark, sf, "conversations"), "conv_id", ["turn", "role", "text"], named, "owner").select("conv_id", "turn", "owner")


@query("""WITH e AS (SELECT *, CASE WHEN length(text) < 80 THEN 'reset' WHEN role = 'user' THEN CAST(turn AS VARCHAR) END AS ev FROM conversations)
SELECT conv_id, turn, nullif(last_value(ev IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING), 'reset') AS lead FROM e""")
def carry_forward_reset(spark, sf):
    rows = table(spark, sf, "conversations")
    named = F.when(F.col("role") == "user", F.col("turn").cast("string"))
    return attribution.carried_with_reset(rows, "conv_id", ["turn", "role", "text"], named, F.length("text") < 80, "lead").select("conv_id", "turn", "lead")


@query("SELECT conv_id, turn, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS context FROM conversations")
def context_prev(spark, sf):
    return attribution.with_previous(table(spark, sf, "conversations"), "conv_id", ["turn", "role", "text"], "text").select("conv_id", "turn", "context")


@query("""SELECT doc_id, CASE WHEN length(text) > 2000 THEN 'summary' ELSE 'original' END AS text_source, source || '. ' || substr(text, 1, 800) AS fragment FROM documents""")
def summary_routing(spark, sf):
    c = F.col("text")
    return _docs(spark, sf).select("doc_id", T.needs_summary(c).alias("text_source"), T.fragment(F.col("source"), c).alias("fragment"))


_MARKED = "regexp_replace(regexp_replace(text, '([.!?])(\\s+[A-Z0-9\"''])', concat('\\1', chr(1), '\\2'), 'g'), '([.!?])(\\s+[A-Z0-9\"''])', concat('\\1', chr(1), '\\2'), 'g')"


@query(f"""SELECT doc_id, CASE WHEN length(text) > 2000 THEN array_to_string((string_split({_MARKED}, chr(1)))[1:3], '') ELSE text END AS summary_text, CASE WHEN length(text) > 2000 THEN 'summary' ELSE 'original' END AS text_source FROM documents""")
def lexical_summaries(spark, sf):
    return scorers.summarised(_docs(spark, sf), "doc_id", "text")


@query("""SELECT c_custkey, array_to_string(list_filter(string_split(trim(regexp_replace(replace(lower(c_name), '.com', ''), '[^a-z0-9& ]+', ' ', 'g')), ' '), lambda w: w <> '' AND w NOT IN ('inc', 'incorporated', 'corp', 'corporation', 'co', 'company',
'companies', 'ltd', 'limited', 'plc', 'llc', 'lp', 'holdings', 'holding', 'group', 'sa', 'nv', 'ag', 'se', 'the', 'class')), ' ') AS name_key FROM customer""")
def normalized_names(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", T.normalize_name(F.col("c_name")).alias("name_key"))


@query("""WITH r AS (SELECT n_nationkey, n_name, n_regionkey, '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}' AS j FROM nation)
SELECT sha256(CAST(sum(CAST(CAST('0x' || substr(sha256(j), 1, 15) AS BIGINT) AS DECIMAL(38, 0))) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR)) AS digest, count(*) AS n FROM r""")
def result_digest(spark, sf):
    return relational.digest(table(spark, sf, "nation"))


_MEASURES = "subjects AS (SELECT doc_id, source, lang, quality, n_chars, CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END AS corpus FROM documents LEFT JOIN labels USING (doc_id))"


@query(f"""WITH {_MEASURES} SELECT source, corpus, count(*) AS rows, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE lang = 'en') AS english, count(*) FILTER (WHERE quality = 1 AND lang = 'en') AS both FROM subjects GROUP BY source, corpus""")
def source_counters(spark, sf):
    """Counters by source and corpus over the measures that a document has, held as an array."""
    docs = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    corpus = F.when(F.col("n_chars") < 1000, "short").otherwise("long")
    return relational.counters(docs.withColumn("corpus", corpus), ["source", "corpus"], {"rows": F.lit(True), "good": F.col("quality") == 1, "english": F.col("lang") == "en", "both": (F.col("quality") == 1) & (F.col("lang") == "en")})


@query(f"""WITH {_MEASURES}, c AS (SELECT source, corpus, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS g FROM subjects GROUP BY source, corpus),
s AS (SELECT DISTINCT source FROM documents UNION SELECT 'src_unseen')
SELECT s.source, coalesce(max(n) FILTER (WHERE corpus = 'short'), 0) AS short_rows, coalesce(max(g) FILTER (WHERE corpus = 'short'), 0) AS short_good, coalesce(max(n) FILTER (WHERE corpus = 'long'), 0) AS long_rows, coalesce(max(g) FILTER (WHERE corpus = 'long'), 0) AS long_good
FROM s LEFT JOIN c ON s.source IS NOT DISTINCT FROM c.source GROUP BY s.source""")
def wide_counters(spark, sf):
    """One row a source, known or not, with a column for each corpus and counter, zero where there is nothing; checked for rows that cannot be."""
    docs = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").withColumn("corpus", F.when(F.col("n_chars") < 1000, "short").otherwise("long"))
    counted = relational.counters(docs, ["source", "corpus"], {"rows": F.lit(True), "good": F.col("quality") == 1})
    known = _docs(spark, sf).select("source").distinct().unionByName(spark.createDataFrame([("src_unseen",)], "source string"))
    out = relational.widened(counted, "source", "corpus", ["short", "long"], ["rows", "good"], known)
    relational.require_rows(out, {"more good than rows": "short_good <= short_rows and long_good <= long_rows", "negative": "short_rows >= 0 and long_rows >= 0"}, "source")
    return out


@query("""WITH n AS (SELECT source, doc_id, len(list_filter(string_split(text, chr(10)), lambda l: length(l) >= 20)) AS k, n_chars FROM documents),
g AS (SELECT source, count(*) AS bodies, sum(k) AS pieces, max(k) AS most, count(*) FILTER (WHERE k > 5) AS over FROM n GROUP BY source)
SELECT count(*) AS groups, CAST(sum(bodies) AS BIGINT) AS bodies, CAST(sum(pieces) AS BIGINT) AS pieces, max(most) AS most, round(avg(pieces / bodies), 6) AS mean_of_means, round(sum(over) / sum(bodies), 6) AS share_over FROM g""")
def group_statistics(spark, sf):
    """Statistics over groups' own statistics: pieces a body, by source, then over sources."""
    docs = _docs(spark, sf).select("source", F.size(F.filter(F.split("text", "\n"), lambda x: F.length(x) >= 20)).alias("k"))
    by = docs.groupBy("source").agg(F.count("*").alias("bodies"), F.sum("k").alias("pieces"), F.max("k").alias("most"), F.count_if(F.col("k") > 5).alias("over"))
    return by.agg(
        F.count("*").alias("groups"), F.sum("bodies").alias("bodies"), F.sum("pieces").alias("pieces"), F.max("most").alias("most"), F.round(F.avg(F.col("pieces") / F.col("bodies")), 6).alias("mean_of_means"),
        F.round(F.sum("over") / F.sum("bodies"), 6).alias("share_over"),
    )


@query("""SELECT s.size, count(*) FILTER (WHERE length(text) <= s.size) AS fit, round(count(*) FILTER (WHERE length(text) <= s.size) / count(*), 9) AS share FROM documents, (SELECT unnest([500, 1000, 2000, 4000, 8000]) AS size) s GROUP BY s.size""")
def size_shares(spark, sf):
    """How many texts fit each of several sizes."""
    return relational.shares_within(_docs(spark, sf).select(F.length("text").alias("chars")), "chars", [500, 1000, 2000, 4000, 8000])


@query(f"""WITH {HASHED} SELECT body_hash, min(doc_id) AS first_id, count(*) AS n, array_to_string(list_sort(list(doc_id))[1:3], ',') AS ids FROM h GROUP BY body_hash""")
def bodies_with_ids(spark, sf):
    """Unique bodies with how many documents have them and the first three."""
    rows = _docs(spark, sf).select("doc_id", T.body_hash(F.col("text")).alias("body_hash"))
    out = parts.with_all_ids(rows, "body_hash", "doc_id", 3)
    return out.select("body_hash", "first_id", "n", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("""SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type, bool_or(value > 90) AS high, bool_or(event_type = 'purchase') AS bought, count(*) AS readings FROM events GROUP BY user_id""")
def folded_readings(spark, sf):
    """Readings folded by key: the first one's kind stays, flags are set once any sets them."""
    return parts.folded(table(spark, sf, "events"), "user_id", ["ts", "event_id"], {"high": "value > 90", "bought": "event_type = 'purchase'"}, ["event_type"])


@query("""SELECT conv_id, turn, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn, text) = 1""")
def top_row(spark, sf):
    """The longest turn of each conversation, the first among equals."""
    rows = table(spark, sf, "conversations")
    return relational.nth_latest(rows, ["conv_id"], [F.desc(F.length("text")), F.col("turn"), F.col("text")], 1).select("conv_id", "turn", "text")


@query("""SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r <= 3""")
def latest_three(spark, sf):
    """The three latest orders of each priority (the limit is the report's)."""
    rows = table(spark, sf, "orders")
    parts_ = [relational.nth_latest(rows, ["o_orderpriority"], [F.desc("o_orderdate"), F.desc("o_orderkey")], k) for k in (1, 2, 3)]
    return relational.union_disjoint(parts_, ["o_orderkey"]).select("o_orderpriority", "o_orderkey", "o_totalprice")
