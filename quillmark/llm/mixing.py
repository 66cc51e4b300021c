"""Operator 9, mixing sources to target weights by Poisson replication, in DataFrame operations alone.

A source's rate is its target share of the corpus divided by its actual share, both in characters, so that the
expected size stays that of the input. Each row draws a uniform number from a seeded hash of its id and text, inverts
the Poisson distribution of its source's rate, and is repeated so often (often not at all). Copies are then dealt
over all partitions by a hash of id, text and copy number and ordered by it within each: a global shuffle.

A null source is a source of its own. A null text counts no characters; a source without any keeps rate 1. A source
without a given weight gets none; if no weight is positive nothing is drawn. Equal rows draw the same count. Columns of the input that are named as one of the
added columns are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SEED = "mix-1"
#: Hexadecimal digits of an md5 that make a uniform number: 52 bits.
DIGITS = 13
#: Sources whose rates are held in the plan's small side; its rows are one a source.
MOST_SOURCES = 1_000_000
#: A rate above this is drawn as a sum of equal parts, each by a hash of its own.
MOST_RATE = 64.0


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) by the md5 of the joined parts; a null part counts as a mark no text begins with."""
    text = F.concat_ws("\x1f", F.lit(SEED), *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("\x00")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def steps(rate: float) -> list[float]:
    """The cumulative distribution up to where a 52-bit uniform number cannot pass it."""
    term = total = math.exp(-rate)
    found, k = [total], 0
    while total < 1 - 2.0**-53 and (k < rate or term > 1e-18):
        k += 1
        term *= rate / k
        total += term
        found.append(total)
    return found


def rates(docs: DataFrame, weights: dict[str | None, float] | None) -> DataFrame:
    """(_mix_source, rate): one row a source. Equal weights if none are given."""
    sums = docs.groupBy(F.col("source").cast("string").alias("_mix_source")).agg(F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("size"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(None).cast("double")
        for name, w in weights.items():
            if w < 0:
                raise ValueError("a target weight is negative")
            weight = F.when(F.col("_mix_source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    sums = sums.withColumn("weight", F.coalesce(weight, F.lit(0.0)))
    whole = sums.agg(F.sum("size").alias("all_size"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("all_weight"))
    share = F.coalesce(F.col("weight") / F.nullif("all_weight", F.lit(0.0)), F.lit(0.0))
    rate = F.when(F.col("size") > 0, share * F.col("all_size") / F.col("size")).otherwise(F.lit(1.0))
    return sums.crossJoin(F.broadcast(whole)).select("_mix_source", rate.alias("rate"))


def mix(spark: SparkSession, docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """The columns of ``docs`` with rate, n_copies, copy (from 1) and shuffle_key; rows in the order of the global shuffle."""
    found = rates(docs, weights).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    table = [(r["_mix_source"], r["rate"], max(1, math.ceil(r["rate"] / MOST_RATE))) for r in found]
    tables = spark.createDataFrame([(s, rate, n, steps(rate / n)) for s, rate, n in table], "_mix_source string, _mix_rate double, _mix_parts int, _mix_steps array<double>")
    kept = [c for c in docs.columns if c not in ("rate", "n_copies", "copy", "shuffle_key")]
    rows = docs.select(kept).join(F.broadcast(tables), F.col("source").cast("string").eqNullSafe(F.col("_mix_source")))
    rows = rows.withColumn("_mix_u", uniform("doc_id", F.coalesce(F.md5("text"), F.lit("\x00"))))
    # the smallest k whose cumulative probability exceeds the number
    drawn = lambda u: F.size(F.filter("_mix_steps", lambda c: c <= u))
    more = lambda n, j: n + drawn(uniform(F.lit("part"), "doc_id", F.coalesce(F.md5("text"), F.lit("\x00")), j.cast("string")))
    parts = F.when(F.col("_mix_parts") > 1, F.aggregate(F.sequence(F.lit(2), F.col("_mix_parts")), F.lit(0), more)).otherwise(0)
    rows = rows.withColumn("n_copies", drawn(F.col("_mix_u")) + parts).where("n_copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    rows = rows.withColumn("shuffle_key", uniform("doc_id", F.coalesce(F.md5("text"), F.lit("\x00")), "copy"))
    rows = rows.select(*kept, F.col("_mix_rate").alias("rate"), "n_copies", "copy", "shuffle_key")
    n = common.shuffle_partitions(spark)
    part = F.least(F.floor(F.col("shuffle_key") * n), F.lit(n - 1)).cast("int")
    return rows.repartitionById(n, part).sortWithinPartitions("shuffle_key", "doc_id")


def _sql_uniform(*parts: str) -> str:
    return f"CAST(CAST('0x' || SUBSTR(MD5(CONCAT_WS(CHR(31), '{SEED}', {', '.join(parts)})), 1, {DIGITS}) AS BIGINT) AS DOUBLE) / {float(16**DIGITS)}"


_ROW = "COALESCE(CAST(doc_id AS VARCHAR), CHR(0))", "COALESCE(MD5(text), CHR(0))"
#: Equal weights, seed and digits as above. A part's rate is at most MOST_RATE, and 400 steps reach past any number it draws.
SQL = f"""
WITH sums AS (SELECT source, CAST(SUM(LENGTH(COALESCE(text, ''))) AS DOUBLE) AS size FROM documents GROUP BY source),
whole AS (SELECT SUM(size) AS all_size, CAST(COUNT(*) FILTER (WHERE size > 0) AS DOUBLE) AS n FROM sums),
rates AS (SELECT source, CASE WHEN size > 0 THEN 1.0 / n * all_size / size ELSE 1.0 END AS rate FROM sums, whole),
parted AS (SELECT source, rate, CAST(GREATEST(1, CEIL(rate / {MOST_RATE})) AS BIGINT) AS parts FROM rates),
steps AS (
  SELECT source, k, SUM(EXP(-part + k * LN(part) - LGAMMA(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below
  FROM (SELECT source, rate / parts AS part FROM parted), (SELECT UNNEST(RANGE(0, 400)) AS k)),
lists AS (SELECT source, LIST(below ORDER BY k) AS belows FROM steps GROUP BY source),
draws AS (
  SELECT d.*, r.rate, l.belows, UNNEST(RANGE(1, r.parts + 1)) AS part, ROW_NUMBER() OVER () AS row_no
  FROM documents d JOIN parted r ON r.source IS NOT DISTINCT FROM d.source JOIN lists l ON l.source IS NOT DISTINCT FROM d.source),
numbers AS (
  SELECT *, CASE WHEN part = 1 THEN {_sql_uniform(*_ROW)}
    ELSE {_sql_uniform("'part'", *_ROW, "CAST(part AS VARCHAR)")} END AS u FROM draws),
counted AS (
  SELECT row_no, ANY_VALUE(doc_id) AS doc_id, ANY_VALUE(text) AS text, ANY_VALUE(lang) AS lang, ANY_VALUE(source) AS source, ANY_VALUE(n_chars) AS n_chars, ANY_VALUE(rate) AS rate,
    SUM(LEN(LIST_FILTER(belows, lambda c: c <= u))) AS n_copies
  FROM numbers GROUP BY row_no),
copies AS (SELECT *, UNNEST(RANGE(1, CAST(n_copies AS BIGINT) + 1)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, ROUND(rate, 9) AS rate, CAST(n_copies AS INTEGER) AS n_copies, CAST(copy AS INTEGER) AS copy,
  {_sql_uniform(*_ROW, "CAST(copy AS VARCHAR)")} AS shuffle_key
FROM copies
"""
