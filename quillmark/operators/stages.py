"""Scoring long texts in chunks, and the work of each step: what is pending, what a row of its result holds, how it went.

A text is cut into chunks that a scorer takes; chunks are rows, so a text with many is spread like many texts, and its
chunks meet again by aggregation. Scorers come from ``scorers.scored``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import text as T
from quillmark.operators import attribution, scorers, state

MOST_PASSES = 6


def chunk_rows(rows: DataFrame, id_col: str, text: str, most: int) -> DataFrame:
    """(id, position, start, chunk): whole sentences up to ``most`` tokens. A text without a token has none."""
    cut = attribution.chunks(rows, id_col, text, most).withColumnRenamed("end", "_end")
    own = rows.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    return cut.join(own, F.col(id_col) == F.col("_id")).select(id_col, "position", "start", F.substring("_text", F.col("start") + 1, F.col("_end") - F.col("start")).alias("chunk"))


def chunk_mean(rows: DataFrame, id_col: str, text: str, make: Callable[[], scorers.Scorer], classes: Sequence[str], most: int = 510) -> DataFrame:
    """(id, chunks, scores, label): class probabilities as the mean over a text's chunks; the label is the first class of the highest."""
    pieces = chunk_rows(rows, id_col, text, most).select(id_col, F.col("chunk").alias("text"))
    scored = scorers.scored(pieces, make, "scores", "map<string,double>")
    means = [F.avg(F.coalesce(F.col("scores")[c], F.lit(0.0))).alias(c) for c in classes]
    by = scored.groupBy(id_col).agg(F.count("*").alias("chunks"), *means)
    best = F.lit(classes[-1])
    for k in range(len(classes) - 2, -1, -1):
        rest = [F.col(c) for c in classes[k + 1 :]]
        best = F.when(F.col(classes[k]) >= (F.greatest(*rest) if len(rest) > 1 else rest[0]), classes[k]).otherwise(best)
    return by.select(id_col, "chunks", F.create_map(*[x for c in classes for x in (F.lit(c), F.col(c))]).alias("scores"), best.alias("label"))


def chunk_spans(rows: DataFrame, id_col: str, text: str, make: Callable[[], scorers.Scorer], most: int = 510, least: int = 2) -> DataFrame:
    """(id, entity_type, text, start, end, score): entity spans found in chunks, at their place in the whole text.

    A scorer gives an array of (entity_type, start, end, score) a chunk. Equal spans count once, at their best score;
    those shorter than ``least`` characters go.
    """
    kind = "array<struct<entity_type:string,start:int,end:int,score:double>>"
    pieces = chunk_rows(rows, id_col, text, most).select(id_col, "start", F.col("chunk").alias("text"))
    found = scorers.scored(pieces, make, "spans", kind).select(id_col, F.col("start").alias("_at"), F.col("text").alias("_chunk"), F.explode("spans").alias("s"))
    placed = found.select(
        id_col, "s.entity_type", F.substring("_chunk", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("text"), (F.col("_at") + F.col("s.start")).alias("start"),
        (F.col("_at") + F.col("s.end")).alias("end"), "s.score",
    )
    return placed.where(F.col("end") - F.col("start") >= least).groupBy(id_col, "entity_type", "text", "start", "end").agg(F.max("score").alias("score"))


def reduced(rows: DataFrame, id_col: str, text: str, summarise: Callable[[], scorers.Scorer], most: int = 510, passes: int = MOST_PASSES) -> DataFrame:
    """(id, summary, chunks, passes): each chunk summarised and the summaries joined, again and again until one chunk is left.

    ``chunks`` is how many the text itself had. After the last pass what is there counts, joined. A text without a token
    has an empty summary.
    """
    now, done = rows.select(id_col, F.col(text).alias("text")), None
    counted = attribution.chunks(now, id_col, "text", most).groupBy(F.col(id_col).alias("_id")).agg(F.count("*").alias("chunks"))
    for k in range(1, passes + 1):
        pieces = chunk_rows(now, id_col, "text", most).select(id_col, "position", F.col("chunk").alias("text"))
        short = scorers.scored(pieces, summarise, "summary", "string").select(id_col, "position", "summary")
        joined = short.groupBy(id_col).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "summary"))), lambda x: x["summary"]), " ").alias("text"), F.count("*").alias("n"))
        # a written table a pass, so that a text is summarised once however many passes follow
        joined = joined.checkpoint() if rows.sparkSession.sparkContext.getCheckpointDir() else joined.cache()
        ready = joined.where(F.lit(k == passes) | (F.col("n") == 1)).select(id_col, F.col("text").alias("summary"), F.lit(k).alias("passes"))
        done = ready if done is None else done.unionByName(ready)
        now = joined.where("n > 1").select(id_col, "text")
        if k < passes and now.isEmpty():
            break
    out = rows.select(id_col).join(done, id_col, "left").join(counted, F.col(id_col) == F.col("_id"), "left")
    return out.select(id_col, F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("chunks", F.lit(0)).alias("chunks"), F.coalesce("passes", F.lit(0)).alias("passes"))


def pair_text(name: Column, text: Column, most: int) -> Column:
    """Words of a text that fit beside a name's in a budget; only the text is cut."""
    left = F.greatest(F.lit(0), F.lit(most) - F.size(T.words(name)))
    return F.array_join(F.slice(T.words(text), 1, left), " ")


def companies_of(spans: DataFrame, id_col: str, names: DataFrame, relevance: DataFrame, threshold: float) -> DataFrame:
    """(id, ticker, mentions, relevance, is_main): spans that name a company of the universe, with scores of (id, ticker).

    ``names``: (key, ticker). The main companies are those at the threshold.
    """
    keys = spans.withColumn("_k", T.normalize_name(F.col("text"))).join(names.select(F.col("key").alias("_key"), "ticker"), F.col("_k") == F.col("_key"))
    counts = keys.groupBy(id_col, "ticker").agg(F.count("*").alias("mentions"))
    scored = counts.join(relevance.select(id_col, "ticker", "relevance"), [id_col, "ticker"], "left")
    return scored.withColumn("is_main", F.coalesce(F.col("relevance") >= threshold, F.lit(False)).cast("int"))


def known_pairs(items: DataFrame, key: Sequence[str], tickers: str, universe: DataFrame) -> DataFrame:
    """(key, known, dropped): an item's tickers of the universe, as (ticker, name), and those that are not, in order."""
    each = items.select(*key, F.posexplode_outer(tickers).alias("_p", "ticker"))
    named = each.join(universe.select(F.col("ticker").alias("_t"), F.col("company").alias("name")).dropDuplicates(["_t"]), F.col("ticker") == F.col("_t"), "left")
    row = F.struct("_p", "ticker", F.col("name").alias("name"))
    by = named.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), row))).alias("k"), F.sort_array(F.collect_list(F.when(F.col("ticker").isNotNull() & F.col("name").isNull(), row))).alias("d"))
    return by.select(*key, F.transform("k", lambda x: F.struct(x["ticker"], x["name"])).alias("known"), F.transform("d", lambda x: x["ticker"]).alias("dropped"))


def pending_texts(summaries: DataFrame, scopes: DataFrame, sub_news: DataFrame, done: DataFrame, items: Sequence[str] = ("single", "sub_news"), limit: int | None = None) -> DataFrame:
    """(item_kind, item_id, body_hash, text): summaries of bodies of one company, then of sub-news, that a step has not finished."""
    single = summaries.where("item_kind = 'body'").join(scopes.where("scope = 'single'").select(F.col("body_hash").alias("_h")).distinct(), F.col("item_id") == F.col("_h"))
    subs = summaries.where("item_kind = 'sub_news'").join(sub_news.select(F.col("id").cast("string").alias("_s"), "body_hash"), F.col("item_id") == F.col("_s"))
    sources = {"single": single.withColumn("body_hash", F.col("_h")), "sub_news": subs}
    cols = ["item_kind", "item_id", "body_hash", F.col("summary_text").alias("text")]
    parts = [state.pending_items(sources[i].select(*cols), done, ["item_kind", "item_id"]) for i in items]
    return state.ordered_union(parts, ["item_id"], limit)


def pending_scored_pairs(companies: DataFrame, texts: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Items with their main (ticker, relevance) pairs and their text, that are not finished."""
    key = ["item_kind", "item_id"]
    main = companies.where("is_main = 1").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("ticker", F.col("relevance_score").alias("relevance")))).alias("pairs"))
    return state.pending_items(main.join(texts.select(*key, "summary_text"), key), done, key, key, limit)


def pending_assigned(articles: DataFrame, sectors: DataFrame, done: DataFrame, id_col: str, text: str, limit: int | None = None) -> DataFrame:
    """Bodies that the sector step assigned and a later step has not finished."""
    return state.pending_scoped(articles, sectors.select("body_hash", F.col("status").alias("scope")), done, "assigned", id_col, text, limit)


def hashes_of_items(items: DataFrame, sub_news: DataFrame) -> DataFrame:
    """Items with the hash of the body they come from: their own id, or their sub-news' body."""
    subs = sub_news.select(F.col("id").cast("string").alias("_s"), F.col("body_hash").alias("_h"))
    both = items.join(subs, (F.col("item_kind") == "sub_news") & (F.col("item_id") == F.col("_s")), "left")
    return both.withColumn("body_hash", F.when(F.col("item_kind") == "body", F.col("item_id")).otherwise(F.col("_h"))).drop("_s", "_h")


def snapshot_rows(pairs: DataFrame, articles: DataFrame, revision: str, inputs: Mapping[str, str], processed_at: str) -> DataFrame:
    """Rows of company facts. ``pairs``: item, ticker, body_hash, text, text_source, sector, category and sentiment columns; ``articles``: (body_hash, fetched_at, pub_date, title)."""
    return _facts(pairs, articles, revision, inputs, processed_at)


def sector_rows(bodies: DataFrame, articles: DataFrame, revision: str, inputs: Mapping[str, str], processed_at: str) -> DataFrame:
    """Rows of sector facts: no company, no category and no sentiment. ``bodies``: body_hash, text, text_source, sector."""
    own = bodies.select(F.lit("body").alias("item_kind"), F.col("body_hash").alias("item_id"), F.lit("").alias("ticker"), "body_hash", "text", "text_source", "sector")
    for c in ("category", "group_label", "sentiment"):
        own = own.withColumn(c, F.lit(""))
    return _facts(own.withColumn("sentiment_score", F.lit(None).cast("double")), articles, revision, inputs, processed_at)


def _facts(rows: DataFrame, articles: DataFrame, revision: str, inputs: Mapping[str, str], processed_at: str) -> DataFrame:
    from quillmark.sources import tables

    known = F.create_map(*[F.lit(x) for kv in sorted(inputs.items()) for x in kv])
    joined = rows.join(articles.select(F.col("body_hash").alias("_h"), "fetched_at", "pub_date", "title"), F.col("body_hash") == F.col("_h"))
    full = joined.withColumn("model_revision", F.lit(revision)).withColumn("inputs", known).withColumn("processed_at", F.lit(processed_at))
    return full.select(*[F.col(f.name).cast(f.dataType) for f in tables.schema("news_snapshot")])


def outcomes(results: DataFrame, counted: Mapping[str, Column]) -> DataFrame:
    """How a batch went: one row of counters, such as done, review, failed, truncated or dropped."""
    return results.agg(F.count("*").alias("seen"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counted.items()])
