"""Deterministic draws. A seeded order is the hash of key and seed: equal on every run and partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order(key: str | Column, seed: int | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def seeded(rows: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    return rows.orderBy(order(key, seed), key).limit(n)


def systematic(rows: DataFrame, key: str, modulo: int, residue: int) -> DataFrame:
    return rows.where(F.pmod(F.col(key), F.lit(modulo)) == residue)


def quota(rows: DataFrame, stratum: str, key: str, quotas: Mapping[str, int] | int, seed: int | str, first: Column | None = None) -> DataFrame:
    """At most a quota of each stratum; rows with ``first`` before others."""
    by = [F.desc(first)] if first is not None else []
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(*by, order(key, seed), F.col(key))))
    if isinstance(quotas, int):
        limit = F.lit(quotas)
    else:
        limit = F.lit(0)
        for name, n in quotas.items():
            limit = F.when(F.col(stratum) == name, F.lit(n)).otherwise(limit)
    return ranked.where(F.col("_r") <= limit).drop("_r")


def shortfalls(chosen: DataFrame, stratum: str, quotas: Mapping[str, int]) -> DataFrame:
    spark = chosen.sparkSession
    want = spark.createDataFrame(sorted(quotas.items()), f"{stratum} string, wanted long")
    have = chosen.groupBy(stratum).agg(F.count("*").alias("drawn"))
    return want.join(have, stratum, "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).where("drawn < wanted")


def all_rare_then_fill(rows: DataFrame, rare: Column, key: str, n: int, seed: int | str, taken: DataFrame | None = None) -> DataFrame:
    """All rows of the rare strata, others in hash order up to ``n``; taken keys left out."""
    if taken is not None:
        rows = rows.join(taken.select(key).distinct(), key, "left_anti")
    return rows.orderBy(F.desc(rare), order(key, seed), key).limit(n)


def group_folds(rows: DataFrame, group: str, k: int, seed: int | str) -> DataFrame:
    """A fold for each row; a group lies in one. By the group's hash alone, so there is no shuffle."""
    h = F.conv(F.substring(order(group, seed), 1, 12), 16, 10).cast("long")
    return rows.withColumn("fold", F.pmod(h, F.lit(k)).cast("int"))


def split(rows: DataFrame, label: str, key: str, test: float, validation: float, seed: int | str) -> DataFrame:
    """train, validation or test within each label, by hash order."""
    w = Window.partitionBy(label)
    at = (F.row_number().over(w.orderBy(order(key, seed), F.col(key))) - 1) / F.count("*").over(w)
    return rows.withColumn("split", F.when(at < test, "test").when(at < test + validation, "validation").otherwise("train"))


def blocks(rows: DataFrame, stratum: str, key: str, size: int, seed: int | str) -> DataFrame:
    """Balanced blocks: ``size`` rows of each class in each."""
    r = F.row_number().over(Window.partitionBy(stratum).orderBy(order(key, seed), F.col(key)))
    return rows.withColumn("block", F.ceil(r / size).cast("int"))


def per_parent(rows: DataFrame, parent: str, key: str, most: int, n: int, seed: int | str) -> DataFrame:
    """At most ``most`` rows of a parent, then ``n`` of those."""
    r = F.row_number().over(Window.partitionBy(parent).orderBy(order(key, seed), F.col(key)))
    return seeded(rows.withColumn("_r", r).where(F.col("_r") <= most).drop("_r"), key, n, f"{seed}-2")


def weights(rows: DataFrame, populations: DataFrame, stratum: str) -> DataFrame:
    """Rows with their stratum's population over the rows drawn of it."""
    drawn = rows.groupBy(stratum).agg(F.count("*").alias("_drawn"))
    return rows.join(populations.join(drawn, stratum).select(stratum, (F.col("population") / F.col("_drawn")).alias("weight")), stratum)


def strata_sizes(frame: DataFrame, stratum: str, taken: Column, chosen: Column) -> DataFrame:
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return frame.groupBy(stratum).agg(F.count("*").alias("size"), count(taken).alias("excluded"), count(~taken).alias("free"), count(chosen).alias("drawn"))


def slices(rows: DataFrame, order_by: Sequence[str], size: int, within: str | None = None) -> DataFrame:
    """Fixed-size parts of an order, within a group, or of all rows by one numeric key that tells them apart."""
    if within is None:
        if len(order_by) != 1:
            raise ValueError("an order of all rows takes one numeric key")
        from quillmark.operators.parts import numbered

        return numbered(rows, order_by[0]).withColumn("part", F.floor(F.col("rank") / size).cast("int")).drop("rank")
    w = Window.partitionBy(within).orderBy(*order_by)
    return rows.withColumn("part", F.floor((F.row_number().over(w) - 1) / size).cast("int"))


def disjoint(chosen: DataFrame, never: DataFrame, key: str) -> bool:
    return chosen.join(never.select(key).distinct(), key, "left_semi").isEmpty()
