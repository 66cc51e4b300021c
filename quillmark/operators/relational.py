"""Joins, pivots, set comparisons and guards over result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Refused(ValueError):
    """Input that breaks a rule."""


def anti(rows: DataFrame, done: DataFrame, on: str, order: Sequence[str], limit: int | None = None) -> DataFrame:
    todo = rows.join(done.select(on).distinct(), on, "left_anti").orderBy(*order)
    return todo if limit is None else todo.limit(limit)


def counted(rows: DataFrame, children: DataFrame, on: str, name: str) -> DataFrame:
    """``rows`` with the number of their children: counted before the join, so a parent with many is one row."""
    n = children.groupBy(on).agg(F.count("*").alias(name))
    return rows.join(n, on, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def page(rows: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)


def after_key(rows: DataFrame, key: str, last, limit: int) -> DataFrame:
    """The next page by key: rows above the last one seen."""
    return rows.where(F.col(key) > F.lit(last)).orderBy(key).limit(limit)


def nested(rows: DataFrame, children: DataFrame, on: str, name: str, order: Sequence[str]) -> DataFrame:
    lists = children.groupBy(on).agg(F.sort_array(F.collect_list(F.struct(*order, *[c for c in children.columns if c not in (on, *order)]))).alias(name))
    return rows.join(lists, on, "left")


def latest(rows: DataFrame, key: Sequence[str], by: str) -> DataFrame:
    """Rows at the largest ``by`` of their key; equals all stay."""
    best = rows.groupBy(*key).agg(F.max(by).alias("_best"))
    return rows.join(best, list(key)).where(F.col(by) == F.col("_best")).drop("_best")


def nth_latest(rows: DataFrame, key: Sequence[str], by: Sequence[Column], n: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*by))).where(F.col("_n") == n).drop("_n")


def label_pivot(rows: DataFrame, keys: Sequence[Column | str], label: str, values: Sequence[str]) -> DataFrame:
    sums = [F.sum(F.when(F.col(label) == v, 1).otherwise(0)).alias(v) for v in values]
    return rows.groupBy(*keys).agg(*sums, F.count("*").alias("total"))


def top_counts(rows: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    out = rows.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)
    return out if n is None else out.limit(n)


def override(base: DataFrame, changes: DataFrame, key: str, value: str) -> DataFrame:
    """A mapping with some values overridden; keys of either side."""
    return base.join(changes.select(key, F.col(value).alias("_o")), key, "full_outer").select(key, F.coalesce("_o", value).alias(value))


def earliest(rows: DataFrame, key: str, id_col: str, dates: Mapping[str, Column], title: str, flag: Column) -> DataFrame:
    """Of each key: the earliest valid dates (empty if none), the first row's title, whether any row has the flag."""
    least = [F.coalesce(F.min(F.nullif(c, F.lit(""))), F.lit("")).alias(n) for n, c in dates.items()]
    return rows.groupBy(key).agg(*least, F.min_by(title, id_col).alias(title), F.bool_or(flag).alias("flag"))


def movement(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys lost, gained or changed from ``a`` to ``b``."""
    both = a.select(key, F.col(value).alias("_a"), F.lit(True).alias("_in_a")).join(b.select(key, F.col(value).alias("_b"), F.lit(True).alias("_in_b")), key, "full_outer")
    kind = F.when(F.col("_in_b").isNull(), "lost").when(F.col("_in_a").isNull(), "gained").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return both.select(key, kind.alias("kind")).where("kind is not null")


def merge_tags(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str], source_wins: bool = False) -> DataFrame:
    """Tags of both files by key; ``conflict`` marks keys tagged differently in both."""
    s = source.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    out = target.join(s, key, "left")
    conflict = F.lit(False)
    for c in columns:
        mine, theirs = F.col(c), F.col(f"_{c}")
        conflict = conflict | (~blank(mine) & ~blank(theirs) & (mine != theirs))
    chosen = [F.when(blank(F.col(f"_{c}")), F.col(c)).when(blank(F.col(c)) | F.lit(source_wins), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    return out.select(key, *chosen, conflict.alias("conflict"))


def tag_differences(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, column, target, source): one row for each differing cell."""
    both = target.select(key, *columns).join(source.select(key, *[F.col(c).alias(f"_{c}") for c in columns]), key)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("target"), F.col(f"_{c}").cast("string").alias("source")) for c in columns])
    return both.select(key, F.explode(cells).alias("d")).select(key, "d.*").where(~F.col("target").eqNullSafe(F.col("source")))


def set_sizes(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of two sets of keys, their union, intersection and differences, in one pass."""
    marks = a.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(key, F.lit(0).alias("a"), F.lit(1).alias("b")))
    own = marks.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    return own.agg(
        count(F.col("a") == 1).alias("in_a"), count(F.col("b") == 1).alias("in_b"), F.count("*").alias("in_either"), count((F.col("a") == 1) & (F.col("b") == 1)).alias("in_both"),
        count((F.col("a") == 1) & (F.col("b") == 0)).alias("only_a"), count((F.col("a") == 0) & (F.col("b") == 1)).alias("only_b"),
    )


def require_unique(rows: DataFrame, key: Sequence[str]) -> None:
    bad = rows.groupBy(*key).count().where("count > 1").limit(5).collect()
    if bad:
        raise Refused(f"repeated keys, for example {[tuple(r)[:-1] for r in bad]}")


def require_same_keys(found: DataFrame, expected: DataFrame, key: Sequence[str]) -> None:
    for what, a, b in (("missing", expected, found), ("unexpected", found, expected)):
        bad = a.select(*key).distinct().join(b.select(*key).distinct(), list(key), "left_anti").limit(5).collect()
        if bad:
            raise Refused(f"{what} keys, for example {[tuple(r) for r in bad]}")


def require_subset(rows: DataFrame, of: DataFrame, key: Sequence[str], what: str) -> None:
    bad = rows.select(*key).distinct().join(of.select(*key).distinct(), list(key), "left_anti").limit(5).collect()
    if bad:
        raise Refused(f"{what}: no such {key}, for example {[tuple(r) for r in bad]}")


def union_disjoint(parts: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    require_unique(out, key)
    return out


def shared_across(rows: DataFrame, content: str, fold: str) -> DataFrame:
    """Contents that lie in more than one fold."""
    return rows.groupBy(content).agg(F.countDistinct(fold).alias("folds"), F.count("*").alias("n")).where("folds > 1")


def copies_of(own: DataFrame, train: DataFrame, id_col: str, shingles: str, least: float = 0.8, same_ids: bool = True) -> DataFrame:
    """Texts that one other text holds at least a share of the shingles of. Inputs: (id, array of distinct shingles).

    A text that shares ``least`` of its shingles shares one of any choice of the others and one more, so candidates meet
    in the rarest that many only: a shingle that most texts hold joins nothing unless a text has no rarer ones. Pairs
    are then counted on the full sets. ``same_ids``: equal ids are the same text and no pair.
    """
    a = own.select(F.col(id_col), F.array_distinct(shingles).alias("_s")).where(F.size("_s") > 0)
    b = train.select(F.col(id_col).alias("_other"), F.array_distinct(shingles).alias("_t"))
    each = a.select(id_col, F.size("_s").alias("_n"), F.explode("_s").alias("_x"))
    seen = b.select("_other", F.explode("_t").alias("_x"))
    wanted = each.select(F.col("_x").alias("_w")).distinct()
    common = seen.join(wanted, F.col("_x") == F.col("_w"), "left_semi").groupBy(F.col("_x").alias("_y")).agg(F.count("*").alias("_df"))
    ranked = each.join(common, F.col("_x") == F.col("_y"), "left").withColumn("_df", F.coalesce("_df", F.lit(0)))
    order = Window.partitionBy(id_col).orderBy("_df", "_x")
    few = F.col("_n") - F.ceil(F.lit(least) * F.col("_n")) + 1
    rare = ranked.withColumn("_r", F.row_number().over(order)).where((F.col("_r") <= few) & (F.col("_df") > 0)).select(id_col, "_x")
    met = rare.join(seen.withColumnRenamed("_x", "_z"), F.col("_x") == F.col("_z")).select(F.col(id_col).alias("_a"), F.col("_other").alias("_b")).distinct()
    if same_ids:
        met = met.where("_a <> _b")
    full = met.join(a, F.col("_a") == F.col(id_col)).join(b, F.col("_b") == F.col("_other"))
    counted = full.select("_a", "_b", F.size(F.array_intersect("_s", "_t")).cast("long").alias("shared"), F.size("_s").alias("own"))
    return counted.where(F.col("shared") >= F.lit(least) * F.col("own")).select(F.col("_a").alias(id_col), F.col("_b").alias("other_id"), "shared", "own")


def fingerprint(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n"), F.min(id_col).alias("least"), F.max(id_col).alias("most"), F.sum(F.col(id_col).cast("decimal(38,0)")).alias("total"))


def digest(rows: DataFrame) -> DataFrame:
    """A hash of a result that does not depend on row order: the sum of its rows' hashes with their count, so no task holds all rows."""
    row = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    h = rows.select(F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)").alias("h"))
    return h.agg(F.sha2(F.concat_ws(":", F.coalesce(F.sum("h"), F.lit(0)).cast("string"), F.count("*").cast("string")), 256).alias("digest"), F.count("*").alias("n"))


def counters(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """How many rows of each key each measure holds for."""
    return rows.groupBy(*keys).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in measures.items()])


def widened(counted: DataFrame, key: str, corpus: str, corpora: Sequence[str], names: Sequence[str], known: DataFrame) -> DataFrame:
    """One row for each of ``known`` keys, with a column ``corpus_name`` for each counter, zero where there is none."""
    cell = lambda c, n: F.coalesce(F.max(F.when(F.col(corpus) == c, F.col(n))), F.lit(0)).alias(f"{c}_{n}")
    wide = counted.groupBy(F.col(key).alias("_k")).agg(*[cell(c, n) for c in corpora for n in names])
    columns = [F.coalesce(f"{c}_{n}", F.lit(0)).alias(f"{c}_{n}") for c in corpora for n in names]
    return known.join(wide, F.col(key).eqNullSafe(F.col("_k")), "left").select(key, *columns)


def require_rows(rows: DataFrame, rules: Mapping[str, str], key: str) -> None:
    """Refuse a table in which a row breaks a rule, with the first keys that do."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    bad = rows.select(key, broken.alias("broken")).where(F.size("broken") > 0).orderBy(key).limit(5).collect()
    if bad:
        raise Refused(f"rows break rules: {[(r[0], r.broken) for r in bad]}")


def shares_within(rows: DataFrame, value: str, sizes: Sequence[int]) -> DataFrame:
    """How many rows, and what share, have a value up to each size; one pass."""
    counted = rows.agg(F.count("*").alias("n"), *[F.count_if(F.col(value) <= s).alias(f"s{s}") for s in sizes])
    out = counted.select("n", F.explode(F.array(*[F.struct(F.lit(s).alias("size"), F.col(f"s{s}").alias("fit")) for s in sizes])).alias("x"))
    return out.select("x.size", "x.fit", F.round(F.col("x.fit") / F.col("n"), 9).alias("share"))
