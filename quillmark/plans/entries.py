"""Queries over rows as they are read and written."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmark.operators import records

from .registry import query, table

_SCOPE = "CASE WHEN n_chars < 500 THEN 'Sector' WHEN n_chars < 1500 THEN '' ELSE 'single' END"
_TICKER = "CASE WHEN lang = 'en' THEN ' AAPL ' ELSE '' END"


@query("""SELECT doc_id, lang = 'en' AND n_chars >= 500 AS pair, CASE WHEN n_chars >= 500 AND n_chars < 1500 THEN true ELSE (lang = 'en') <> (n_chars < 500) END AS agrees, contains(lower(text), lower(source)) AS holds_name FROM documents""")
def pair_rules(spark, sf):
    """Which texts are read with a company, and whether scope and ticker agree."""
    docs = table(spark, sf, "documents")
    s, t = F.expr(_SCOPE), F.expr(_TICKER)
    return docs.select("doc_id", records.reads_as_pair(s, t).alias("pair"), records.agrees_with_ticker(s, t).alias("agrees"), records.contains_name(F.col("text"), F.col("source")).alias("holds_name"))


_REPLY = """CASE event_id % 5 WHEN 0 THEN '<html>' WHEN 1 THEN '{"model":"m","choices":[{"finish_reason":"stop","message":{"content":" text "}}],"usage":{"prompt_tokens":' || user_id || ',"completion_tokens":2}}'
WHEN 2 THEN '{"model":"m","choices":[{"finish_reason":"length","message":{"content":"cut"}}],"usage":{"prompt_tokens":1,"completion_tokens":2}}' WHEN 3 THEN '{"choices":[{"message":{"content":"x"}}]}' ELSE '{"choices":[{"message":{"content":" "}}],"usage":{"prompt_tokens":1,"completion_tokens":2}}' END"""


@query("""SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'text' END AS text, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN user_id WHEN 2 THEN 1 WHEN 4 THEN 1 END AS prompt_tokens,
['the reply is not a chat completion', NULL, 'the reply was cut at the token limit', 'the reply has no usage', 'the reply was empty'][event_id % 5 + 1] AS error FROM events""")
def parsed_replies(spark, sf):
    """Replies of a chat endpoint, good and bad."""
    rows = table(spark, sf, "events").select("event_id", records.parsed_reply(F.expr(_REPLY)).alias("r"))
    return rows.select("event_id", "r.text", "r.prompt_tokens", "r.error")


@query("""SELECT count(*) AS calls, CAST(coalesce(sum(user_id), 0) AS BIGINT) AS prompt_tokens, CAST(coalesce(sum(event_id), 0) AS BIGINT) AS completion_tokens, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS models FROM events""")
def call_usage(spark, sf):
    calls = table(spark, sf, "events").select(F.col("user_id").alias("prompt_tokens"), F.col("event_id").alias("completion_tokens"), F.col("event_type").alias("model"))
    return records.usage_of(calls).withColumn("models", F.array_join("models", ","))


@query("""SELECT coalesce(CAST(r_regionkey AS VARCHAR), k) AS code, coalesce(r_name, v) AS name FROM region FULL JOIN (VALUES ('1', 'one'), ('9', 'nine')) c(k, v) ON CAST(r_regionkey AS VARCHAR) = k""")
def overridden_names(spark, sf):
    """Constants with the rows of a table in their place."""
    rows = table(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name"))
    return records.with_overrides({"1": "one", "9": "nine"}, rows, "code", "name")


@query("""SELECT s_nationkey AS ticker, min(s_name) AS company, min(CASE WHEN s_acctbal > 0 THEN 'rich' END) AS gics_sector, min(CASE WHEN s_suppkey % 3 = 0 THEN s_name END) AS gics_sub_industry FROM supplier GROUP BY s_nationkey""")
def universe_rows(spark, sf):
    """One row a ticker, whatever rows it has."""
    rows = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("string").alias("ticker"), F.col("s_name").alias("company"), F.expr("CASE WHEN s_acctbal > 0 THEN 'rich' ELSE ' ' END").alias("gics_sector"), F.expr("CASE WHEN s_suppkey % 3 = 0 THEN s_name END").alias("gics_sub_industry"))
    return records.universe_rows(rows).withColumn("ticker", F.col("ticker").cast("int"))


@query("""SELECT doc_id, coalesce(l, '') AS match_class, coalesce(l, '') = 'toxic' AS bad, coalesce(l, '') IN ('good', 'poor') AS judged FROM documents LEFT JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'poor' END AS l FROM labels) USING (doc_id)""")
def matched_flags(spark, sf):
    """Documents with the class that another table has for them, and flags of classes."""
    classes = table(spark, sf, "labels").select("doc_id", F.expr("CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'poor' END").alias("match_class"))
    return records.matched_flags(table(spark, sf, "documents").select("doc_id"), "doc_id", classes, {"bad": ["toxic"], "judged": ["good", "poor"]})


@query("""SELECT conv_id, string_agg(text, chr(1) ORDER BY turn, text, role) AS tokens, string_agg(role, ',' ORDER BY turn, text, role) AS labels FROM conversations GROUP BY conv_id""")
def sentence_rows(spark, sf):
    """Rows of tokens as one row a sentence, in order."""
    rows = table(spark, sf, "conversations")
    out = records.sentences_of_tokens(rows, ["conv_id"], "turn", "text", "role")
    return out.select("conv_id", F.array_join("tokens", "\x01").alias("tokens"), F.array_join("labels", ",").alias("labels"))


@query("""SELECT doc_id, toxic, CASE WHEN d.doc_id IS NULL THEN 'no text' WHEN toxic = 1 THEN 'other text' ELSE 'ok' END AS state FROM labels LEFT JOIN (SELECT doc_id FROM documents) d USING (doc_id) UNION ALL SELECT -1 - page_id, 0, 'no text' FROM pages""")
def checked_marks(spark, sf):
    """Marks against the texts they were made on, some of which have changed or are gone."""
    from quillmark.functions import text as T

    docs = table(spark, sf, "documents").select("doc_id", "text")
    marks = table(spark, sf, "labels").join(docs, "doc_id").select("doc_id", "toxic", T.text_hash(F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h"))
    marks = marks.unionByName(table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.lit(0).alias("toxic"), F.lit("x").alias("h")))
    return records.checked_marks(marks, docs, "doc_id", "text", "h").select("doc_id", "toxic", "state")
