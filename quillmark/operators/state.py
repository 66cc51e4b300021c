"""Incremental, revision-keyed processing: unique bodies, pending work, step state, idempotent records.

A body is a unique text, carried by its smallest id. Work of a step is what no row of its revision has finished. A
record adds rows that are not there yet and moves the item's state, so running a step twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import text as T

PROPER = ("ok", "quarantined")
FINAL = ("done", "skipped")
STATE_KEY = ["item_kind", "item_id", "step", "model_revision"]


def proper(articles: DataFrame, status: str = "fetch_status", body: str = "body_text") -> DataFrame:
    return articles.where(F.col(status).isin(*PROPER) & (F.coalesce(F.col(body), F.lit("")) != ""))


def unique_bodies(articles: DataFrame, id_col: str, text: str, carry: Sequence[str] = ()) -> DataFrame:
    """(body_hash, id, carried columns): the smallest id of each text. Partial minima before the shuffle, so a text with very many copies is one row a task."""
    hashed = articles.select(T.body_hash(F.col(text)).alias("body_hash"), F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in carry]).alias("_row"))
    first = hashed.groupBy("body_hash").agg(F.min("_row").alias("_row"))
    return first.select("body_hash", F.col("_row._id").alias(id_col), *[F.col(f"_row.{c}").alias(c) for c in carry])


def finished(state: DataFrame, step: str, revision: str, kind: str = "body", statuses: Sequence[str] = FINAL) -> DataFrame:
    rows = state.where((F.col("step") == step) & (F.col("model_revision") == revision) & (F.col("item_kind") == kind) & F.col("status").isin(*statuses))
    return rows.select("item_id").distinct()


def pending_bodies(articles: DataFrame, done: DataFrame, id_col: str, text: str, limit: int | None = None) -> DataFrame:
    """Unique bodies with no finished row, in id order."""
    todo = unique_bodies(articles, id_col, text).join(done.select(F.col("item_id").alias("body_hash")), "body_hash", "left_anti")
    return todo.orderBy(id_col).limit(limit) if limit is not None else todo


def bodies_by_hash(articles: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """The smallest id of each wanted text."""
    hashed = articles.select(F.col(id_col), T.body_hash(F.col(text)).alias("body_hash"))
    return hashed.join(wanted.select("body_hash").distinct(), "body_hash", "left_semi").groupBy("body_hash").agg(F.min(id_col).alias(id_col))


def pending_scoped(articles: DataFrame, scopes: DataFrame, done: DataFrame, scope: str, id_col: str, text: str, limit: int | None = None) -> DataFrame:
    """Bodies of a scope (body_hash, scope) that a step has not finished."""
    wanted = scopes.where(F.col("scope") == scope).select("body_hash").join(done.select(F.col("item_id").alias("body_hash")), "body_hash", "left_anti")
    found = bodies_by_hash(articles, wanted, id_col, text)
    return found.orderBy(id_col).limit(limit) if limit is not None else found


def pending_items(rows: DataFrame, done: DataFrame, key: Sequence[str], order: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    todo = rows.join(done.select(*key).distinct(), list(key), "left_anti")
    return todo.orderBy(*order).limit(limit) if limit is not None else todo


def main_tickers(companies: DataFrame, key: Sequence[str]) -> DataFrame:
    """Items with their main tickers, sorted."""
    return companies.where("is_main = 1").groupBy(*key).agg(F.sort_array(F.collect_list("ticker")).alias("tickers"))


def ordered_union(parts: Sequence[DataFrame], order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows of several sources one after another under one limit."""
    out = None
    for k, part in enumerate(parts):
        part = part.withColumn("_source", F.lit(k))
        out = part if out is None else out.unionByName(part)
    out = out.orderBy("_source", *order) if limit is None else out.orderBy("_source", *order).limit(limit)
    return out.drop("_source")


def upsert(current: DataFrame, changes: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The latest row of each key."""
    both = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    first = Window.partitionBy(*key).orderBy(F.desc("_new"), F.desc(order))
    return both.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r", "_new")


def insert_missing(current: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` whose key is not there yet; repeated ones once."""
    return rows.dropDuplicates(list(key)).join(current.select(*key), list(key), "left_anti")


def advance(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after ``changes`` (key, status, error, finished_at): attempts count on, the change's status holds."""
    old = state.select(*STATE_KEY, F.col("status").alias("_s"), F.col("error").alias("_e"), F.col("finished_at").alias("_f"), F.col("attempts").alias("_a"))
    new = changes.groupBy(*STATE_KEY).agg(F.max(F.struct("finished_at", "status", "error")).alias("_c"), F.count("*").alias("_n"))
    return old.join(new, STATE_KEY, "full_outer").select(
        *STATE_KEY,
        F.coalesce("_c.status", "_s").alias("status"),
        F.when(F.col("_c").isNotNull(), F.substring("_c.error", 1, 500)).otherwise(F.col("_e")).alias("error"),
        F.coalesce("_c.finished_at", "_f").alias("finished_at"),
        (F.coalesce("_a", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("int").alias("attempts"),
    )


def company_state(best: Column, threshold: float) -> Column:
    """Status of an item whose companies were scored: review where none reaches the threshold."""
    return F.when(best.isNull() | (best < threshold), "review").otherwise("done")


def latest_revision(state: DataFrame, step: str) -> DataFrame:
    return state.where(F.col("step") == step).agg(F.max_by("model_revision", F.struct("finished_at", "model_revision")).alias("model_revision"))


def revisions(state: DataFrame, step: str) -> DataFrame:
    """Revisions of a step in order of their first appearance."""
    return state.where(F.col("step") == step).groupBy("model_revision").agg(F.min("finished_at").alias("first_seen")).orderBy("first_seen", "model_revision")


def reset(rows: DataFrame, revision: str, column: str = "model_revision") -> DataFrame:
    """What stays of a table when a revision goes; a partition drop where the table is partitioned by it."""
    return rows.where(~F.col(column).eqNullSafe(F.lit(revision)))


def cascade(rows: DataFrame, gone: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of a dependent table whose parents are still there."""
    return rows.join(gone.select(*key).distinct(), list(key), "left_anti")


def ready_and_waiting(pairs: DataFrame, texts: DataFrame, categories: DataFrame, sentiments: DataFrame, written: DataFrame) -> DataFrame:
    """Pairs not written yet, with the first thing each waits for (null: ready)."""
    item, pair = ["item_kind", "item_id"], ["item_kind", "item_id", "ticker"]
    todo = pairs.join(written.select(*pair).distinct(), pair, "left_anti")
    todo = todo.join(texts.select(*item, "summary_text").dropDuplicates(item), item, "left")
    todo = todo.join(categories.select(*pair, "category").dropDuplicates(pair), pair, "left")
    todo = todo.join(sentiments.select(*pair, "sentiment").dropDuplicates(pair), pair, "left")
    reason = F.when(F.col("summary_text").isNull(), "no_text").when(F.col("category").isNull(), "no_category").when(F.col("sentiment").isNull(), "no_sentiment")
    return todo.withColumn("waiting", reason)


def stale(rows: DataFrame, named: dict[str, str], provenance: str = "inputs") -> DataFrame:
    """Rows built from other revisions than those named, counted by input."""
    sums = [F.sum(F.when(~F.get_json_object(provenance, f"$.{k}").eqNullSafe(F.lit(v)), 1).otherwise(0)).alias(k) for k, v in named.items()]
    return rows.agg(*sums)


def record_batch(run, rows: DataFrame, key: Sequence[str], score, schema: str) -> DataFrame:
    """Score rows with a function over batches; a batch that fails is tried again row by row, and a row that fails gets its error."""
    import pandas as pd

    def work(batches):
        for pdf in batches:
            try:
                out = score(pdf).assign(error=None)
            except Exception:
                parts = []
                for k in range(len(pdf)):
                    one = pdf.iloc[k : k + 1]
                    try:
                        parts.append(score(one).assign(error=None))
                    except Exception as e:
                        parts.append(one[list(key)].assign(error=f"{type(e).__name__}: {e}"[:500]))
                out = pd.concat(parts) if parts else pdf[list(key)].assign(error=None)
            yield out.reindex(columns=names)

    names = [c.split()[0] for c in schema.split(",")] + ["error"]
    return rows.mapInPandas(work, f"{schema}, error string")
