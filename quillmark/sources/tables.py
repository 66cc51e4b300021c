"""Readers, schemas, guards and sinks. Paths go to Spark as they are, so any store that Spark reads will do."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from quillmark.functions import text as T
from quillmark.operators.relational import Refused, require_unique

_ITEM = "item_kind string, item_id string"
_PAIR = f"{_ITEM}, ticker string"
_REV = "model_revision string"
_DONE = "processed_at string"
#: The result tables as DDL; a key is never null: the empty text stands for none.
SCHEMAS = {
    "eval_run": "id long, stage string, experiment string, sample_size long, low_conf_n long, random_n long, seed long, judge_model string, judge_url string, code_version string, "
    "strata_json string, metrics_json string, status string, error string, started_at string, finished_at string",
    "eval_inference": "id long, run_id long, article_id string, task string, experiment string, bucket string, prediction_json string",
    "eval_verdict": "id long, inference_id long, run_id long, article_id string, task string, experiment string, verdict_json string, correct boolean, severity string, rationale string, judged_at string",
    "eval_confusion": "run_id long, task string, experiment string, true_label string, predicted_label string, n long",
    "articles": "id long, ticker string, company string, gics_sector string, gics_sub_industry string, title string, author string, pub_date string, fetched_at string, word_count int, "
    "source_domain string, fetch_status string, http_status_code int, language string, extraction_method string",
    "body_scope": f"body_hash string, {_REV}, scope string, scores map<string,double>, text_used string, {_DONE}",
    "body_sector": f"body_hash string, {_REV}, status string, sector string, candidate string, margin double, vote_sector string, scores map<string,double>, votes map<string,int>, {_DONE}",
    "sub_news": f"id string, body_hash string, segment_index int, {_REV}, ticker string, text string, {_DONE}",
    "news_summary": f"{_ITEM}, {_REV}, summary_text string, text_source string, num_chunks int, {_DONE}",
    "news_summary_call": f"{_ITEM}, {_REV}, prompt_tokens long, completion_tokens long, {_DONE}",
    "news_company": f"{_PAIR}, {_REV}, mentions int, relevance_score double, is_main int, {_DONE}",
    "news_sentiment": f"{_PAIR}, {_REV}, label string, score double, positive double, negative double, neutral double, {_DONE}",
    "news_category": f"{_PAIR}, {_REV}, label string, score double, group_label string, group_score double, slug_scores map<string,double>, {_DONE}",
    "news_snapshot": f"{_PAIR}, {_REV}, fetched_at string, pub_date string, title string, text string, text_source string, sector string, category string, group_label string, sentiment string, "
    f"sentiment_score double, inputs map<string,string>, {_DONE}",
    "period_run": f"period_end string, {_REV}, snapshot_revision string, period_start string, created_at string",
    "period_summary": f"period_end string, kind string, key string, {_REV}, counts map<string,struct<total:bigint,neutral:bigint,positive:bigint,negative:bigint>>, not_counted long",
    "period_item": f"period_end string, {_REV}, {_PAIR}, late boolean",
    "sector": "code string, name string, descriptions array<string>",
    "company_sector": "ticker string, sector string",
    "pipeline_step_state": f"{_ITEM}, step string, {_REV}, status string, attempts int, error string, finished_at string",
}


def schema(name: str) -> Y.StructType:
    return Y._parse_datatype_string(SCHEMAS[name])


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schema(name))


def store(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All result tables of a folder; those not written yet are empty."""
    jvm = spark.sparkContext._jvm
    out = {}
    for name in SCHEMAS:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        out[name] = with_columns(spark.read.parquet(f"{folder}/{name}"), schema(name)) if there else empty(spark, name)
    return out


def append(rows: DataFrame, folder: str, name: str) -> None:
    """Append to a result table, partitioned by revision where it has one, so that a revision is dropped as a folder."""
    fields = schema(name)
    out = with_columns(rows, fields).select(*fields.fieldNames())
    writer = out.write.mode("append")
    (writer.partitionBy("model_revision") if "model_revision" in fields.fieldNames() else writer).parquet(f"{folder}/{name}")


def with_columns(rows: DataFrame, fields: Y.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """``rows`` with the columns it lacks, as nulls or defaults."""
    for f in fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit((defaults or {}).get(f.name)).cast(f.dataType))
    return rows


def attach(spark: SparkSession, tables: Mapping[str, DataFrame], namespace: str = "source") -> None:
    """Read-only views of another store."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(f"{namespace}_{name}")


def detach(spark: SparkSession, names: Sequence[str], namespace: str = "source") -> None:
    for name in names:
        spark.catalog.dropTempView(f"{namespace}_{name}")


def check_schema(rows: DataFrame, columns: Sequence[str], version: int | None = None, least: int = 3, known: int = 5) -> str | None:
    """Refuse a source without columns or of an old version; returns a warning for a newer one."""
    missing = sorted(set(columns) - set(rows.columns))
    if missing:
        raise Refused(f"the source lacks columns: {missing}")
    if version is not None and version < least:
        raise Refused(f"the source's version is {version}; at least {least} is needed")
    return f"version {version} is newer than {known}" if version is not None and version > known else None


def require_text(rows: DataFrame, column: str = "body_text") -> None:
    if column not in rows.columns or rows.where(F.trim(F.coalesce(column, F.lit(""))) != "").isEmpty():
        raise Refused("the source has no texts")


def universe(articles: DataFrame) -> DataFrame:
    """One row a ticker with the least of each attribute."""
    return articles.where("fetch_status = 'ok'").groupBy("ticker").agg(*[F.min(c).alias(c) for c in ("company", "gics_sector", "gics_sub_industry")])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV file with a header, quotes and line breaks in cells, a byte order mark taken off; all columns text."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    if columns is not None and (missing := [c for c in columns if c not in rows.columns]):
        raise Refused(f"{path} lacks columns: {missing}")
    return rows


def read_marked(spark: SparkSession, path: str, column: str, allowed: Sequence[str], required: Sequence[str] = ("article_id",)) -> DataFrame:
    """A file whose every row has an allowed mark."""
    rows = read_csv(spark, path, [*required, column])
    bad = rows.where(~F.coalesce(F.trim(column).isin(*allowed), F.lit(False))).limit(5).collect()
    if bad:
        raise Refused(f"{path}: rows without an allowed mark in {column}: {[r.asDict() for r in bad]}")
    return rows


def read_marked_prefix(spark: SparkSession, path: str, column: str, allowed: Sequence[str], least: int, order: str = "review_order") -> tuple[DataFrame, int]:
    """A file marked from its first row on without a gap."""
    rows = read_csv(spark, path, [order, column])
    marked = rows.where(F.trim(F.coalesce(column, F.lit(""))) != "").withColumn(order, F.col(order).cast("int"))
    s = marked.agg(F.count("*").alias("n"), F.min(order).alias("a"), F.max(order).alias("b"), F.countDistinct(order).alias("d"), F.sum(F.when(F.trim(column).isin(*allowed), 0).otherwise(1)).alias("bad")).first()
    if s.n < least or (s.a, s.b, s.d) != (1, s.n, s.n) or s.bad:
        raise Refused(f"{path}: {s.n} marked rows, from {s.a} to {s.b}; {s.bad} marks are not allowed")
    return marked, s.n


def read_keyed(spark: SparkSession, path: str, columns: Sequence[str], key: Sequence[str], allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """A file of exactly these columns, known values and a unique key."""
    rows = read_csv(spark, path)
    if list(rows.columns) != list(columns):
        raise Refused(f"{path}: its columns are {rows.columns}")
    for c, values in allowed.items():
        if not rows.where(~F.col(c).isin(*values)).isEmpty():
            raise Refused(f"{path}: unknown values in {c}")
    require_unique(rows, key)
    return rows


def read_json(spark: SparkSession, path: str, ddl: str, lines: bool = False) -> DataFrame:
    """JSON by a schema; refused if a record does not fit."""
    rows = spark.read.schema(f"{ddl}, _corrupt_record string").option("multiLine", not lines).json(path)
    # kept by a table, as Spark reads no corrupt records alone from a file
    bad = rows.cache().where("_corrupt_record is not null").limit(1).collect()
    if bad:
        raise Refused(f"{path}: a record does not fit: {bad[0]._corrupt_record[:200]}")
    return rows.drop("_corrupt_record")


def documents_of(text: str) -> tuple[list[object], str]:
    """JSON documents one after another in a text, and what is between them."""
    decoder, out, rest, at = json.JSONDecoder(), [], [], 0
    while at < len(text):
        start = min((k for k in (text.find("{", at), text.find("[", at)) if k >= 0), default=-1)
        if start < 0:
            break
        try:
            value, end = decoder.raw_decode(text, start)
        except ValueError:
            rest.append(text[at : start + 1])
            at = start + 1
            continue
        rest.append(text[at:start])
        out.append(value)
        at = end
    return out, "".join([*rest, text[at:]]).strip()


def file_identity(spark: SparkSession, path: str) -> str:
    """The first 16 digits of the file's SHA-256."""
    return spark.read.format("binaryFile").load(path).select(F.substring(F.sha2("content", 256), 1, 16).alias("h")).first().h


def write_csv(rows: DataFrame, path: str, safe: Sequence[str] = (), overwrite: bool = False) -> None:
    """A CSV folder; cells of ``safe`` columns cannot run as formulas."""
    for c in safe:
        rows = rows.withColumn(c, T.spreadsheet_safe(F.col(c)))
    rows.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).option("escape", '"').csv(path)


def tagged_rows(rows: DataFrame, tag: str = "human_label") -> int:
    return rows.where(F.trim(F.coalesce(tag, F.lit(""))) != "").count()


def cached(rows: DataFrame, cache: DataFrame, key: str, tag: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their valid cached value (same source hash and tag), and rows that have none."""
    valid = cache.where(F.col("tag") == tag).select(key, "source_hash", "value")
    return rows.join(valid, [key, "source_hash"]), rows.join(valid.select(key, "source_hash"), [key, "source_hash"], "left_anti")


def adopt_untagged(cache: DataFrame, tag: str) -> DataFrame:
    return cache.withColumn("tag", F.coalesce(F.nullif("tag", F.lit("")), F.lit(tag)))
