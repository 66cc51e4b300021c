"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of ``documents``.
``run`` writes each stage's result and reads it back as the next one's documents.

The first two stages judge each row by its own text, without a shuffle, so rows without doc_id or with one used again
are judged like any other. The near-duplicate stage tells rows apart by doc_id and text: of a group of similar texts
those with the smallest doc_id stay (a null id, or an id that an earlier text has, counts after all others), and of
rows equal in both one stays, chosen by a hash of all columns. A null text fails the quality rules. An empty table passes
through all stages empty. Extra columns stay as they are, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import common, minmax, mixing, packing, quality, toxicity

#: Stand-in ids of texts whose doc_id is null or taken are at or above this number.
_STAND_IN = 1 << 62


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, common.read_table(spark, sf_dir, "labels"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep(docs, common.read_table(spark, sf_dir, "labels"))


def _renamed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with names that no operator adds."""
    return docs.toDF(*[c if c.lower() in keep else f"in_{k}" for k, c in enumerate(docs.columns)])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _renamed(docs, ("doc_id", "text"))
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.xxhash64("text"), F.lit(0))
    # texts by id: an id's first text keeps it, any other text of the id gets a number of its own
    shared = rows.groupBy(doc_id.alias("id")).agg(F.min(text).alias("first"), F.max(text).alias("last")).where("id is null or first <> last").select("id", F.when(F.col("id").isNotNull(), F.col("first")).alias("first"))
    stand_in = F.lit(_STAND_IN) + F.xxhash64(doc_id, text).bitwiseAND(F.lit(_STAND_IN - 1))
    if shared.isEmpty():
        keyed = rows.withColumn("key", doc_id)
    else:
        keyed = rows.join(shared, doc_id.eqNullSafe(F.col("id")), "left")
        keyed = keyed.withColumn("key", F.when(doc_id.isNull() | (text != F.col("first")), stand_in).otherwise(doc_id)).drop("id", "first")
    found = minmax.near_duplicates(spark, keyed.select(F.col("key").alias("doc_id"), "text"))
    chosen = found.where("kept").select(F.col("doc_id").alias("chosen"))
    # one row of a key by partial minima, so that a row repeated a million times does not meet in one task
    order = F.xxhash64(*[F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in rows.schema])
    kept = keyed.join(chosen, F.col("key") == F.col("chosen"), "left_semi")
    one = kept.groupBy("key").agg(F.min_by(F.struct(*rows.columns), order).alias("row"))
    return one.select("row.*").toDF(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _renamed(docs, ("doc_id", "text", "source"))
    return mixing.mix(spark, rows).select(rows.columns).toDF(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near-duplicates", near_dedup),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]

#: The label models, the similarity graph and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.scratch(spark, "pipeline")
    docs = common.read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = common.written(stage(spark, docs, sf_dir), f"{folder}/{k}")
        if k:
            common.drop(spark, f"{folder}/{k - 1}")
    return docs
