"""Tumbling calendar windows, open at the start and closed at the end, cut at a wall time.

A row counts in the first window that closes at or after its date, or, if that one was written before the row came,
in the next that is written: late rows are carried on, marked and never dropped. The grid is computed per row, so there
is no range join and no grid table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import dates as D

SENTIMENTS = ("neutral", "positive", "negative")
#: Categories counted as ``other``.
FOLDED = ("product_innovation", "leadership_governance", "capital_shareholder_returns", "reputational_harm")


def folded(category: Column) -> Column:
    return F.when(category.isin(*FOLDED), "other").otherwise(category)


def count_cells(sentiment: Column) -> list[Column]:
    return [F.count("*").alias("total"), *[F.sum(F.when(sentiment == s, 1).otherwise(0)).alias(s) for s in SENTIMENTS]]


def assign(rows: DataFrame, date: str, arrived: str | None = None, **grid) -> DataFrame:
    """``rows`` with the window of their date and, where ``arrived`` is given, the window that counts them and whether that is late."""
    out = rows.withColumn("date_period", D.period_of(F.col(date), **grid))
    if arrived is None:
        return out.withColumn("period", F.col("date_period")).withColumn("late", F.lit(False))
    out = out.withColumn("period", F.greatest(F.col("date_period"), D.period_of(F.col(arrived), **grid)))
    return out.withColumn("late", F.col("period") > F.col("date_period"))


def tally(rows: DataFrame, company: str, sector: str, category: str, sentiment: str) -> DataFrame:
    """Counts by period and category of each company and of each sector, from one pass."""
    cells = rows.select("period", F.col(company).alias("_c"), F.coalesce(F.col(sector), F.lit("")).alias("_s"), folded(F.col(category)).alias("category"), F.col(sentiment).alias("_t"))
    both = cells.groupingSets([["period", "_c", "category"], ["period", "_s", "category"]], "period", "_c", "_s", "category").agg(F.grouping("_c").alias("_g"), *count_cells(F.col("_t")))
    kind = F.when(F.col("_g") == 1, "sector").otherwise("company")
    return both.select("period", kind.alias("kind"), F.when(F.col("_g") == 1, F.col("_s")).otherwise(F.col("_c")).alias("key"), "category", "total", *SENTIMENTS)


def summaries(cells: DataFrame) -> DataFrame:
    """One row for each period, kind and key, with its counts as a JSON object by category."""
    entry = F.struct(F.col("category").alias("key"), F.struct("total", *SENTIMENTS).alias("value"))
    return cells.groupBy("period", "kind", "key").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("counts"))


def write_next(rows: DataFrame, counted: DataFrame, key: Sequence[str], date: str, index: int, **grid) -> DataFrame:
    """The items of the window being written: all at or before its cut that no earlier window counted, with their late flag."""
    end, start = D.cut_utc(F.lit(index), **grid), D.cut_utc(F.lit(index - 1), **grid)
    todo = rows.where(F.col(date) <= end).join(counted.select(*key).distinct(), list(key), "left_anti")
    return todo.withColumn("late", F.lit(index > 0) & (F.col(date) <= start)).withColumn("period", F.lit(index))


def to_write(written: DataFrame, last: Column, rows: DataFrame) -> DataFrame:
    """Closed windows not written yet, in order. ``rows`` gives the clock (one row)."""
    closed = rows.select(F.explode(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))).alias("period"))
    return closed.join(written.select("period").distinct(), "period", "left_anti").orderBy("period")


def gaps(pairs: DataFrame, snapshots: DataFrame, key: Sequence[str], date: str, **grid) -> DataFrame:
    """Main pairs without a snapshot, counted by the window of their date and company."""
    waiting = pairs.join(snapshots.select(*key).distinct(), list(key), "left_anti").where(F.col(date).isNotNull())
    return waiting.withColumn("period", D.period_of(F.col(date), **grid)).groupBy("period", "ticker").agg(F.count("*").alias("not_counted"))


def render(cells: DataFrame, period: int) -> DataFrame:
    """Report lines of a window: the largest first, then by key."""
    own = cells.where(F.col("period") == period).groupBy("kind", "key").agg(F.sum("total").alias("total"), *[F.sum(s).alias(s) for s in SENTIMENTS])
    line = F.format_string("%s %s: %d (+%d / -%d)", "kind", "key", "total", "positive", "negative")
    return own.orderBy("kind", F.desc("total"), "key").select("kind", "key", line.alias("line"))
