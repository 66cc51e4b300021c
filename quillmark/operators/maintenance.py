"""Keeping stores of revisions: plans, purges that check themselves, verified copies, job control."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .relational import Refused, fingerprint


def revision_counts(rows: DataFrame, column: str, newest: str | None = None) -> DataFrame:
    extra = [F.max(newest).alias("newest")] if newest else []
    return rows.groupBy(column).agg(F.count("*").alias("n"), *extra)


def purge_plan(tables: Mapping[str, DataFrame], column: str, keep: Sequence[str]) -> dict:
    """What goes by table and revision, with row counts and a digest that binds an execution to it."""
    out = {}
    for name, rows in sorted(tables.items()):
        counts = revision_counts(rows, column).collect()  # one row a revision
        out[name] = {r[column]: r["n"] for r in sorted(counts, key=lambda r: str(r[column])) if r[column] not in keep}
    return {"drop": out, "digest": hashlib.sha256(json.dumps(out, sort_keys=True).encode()).hexdigest()}


def purge(tables: Mapping[str, DataFrame], column: str, plan: Mapping, digest: str) -> dict[str, DataFrame]:
    """What stays, after checking that the plan still describes the tables."""
    if plan["digest"] != digest or purge_plan(tables, column, keep=_kept(tables, column, plan))["digest"] != digest:
        raise Refused("the tables are not what was planned")
    return {name: rows.where(~F.coalesce(F.col(column).isin(*plan["drop"][name]), F.lit(False))) if plan["drop"][name] else rows for name, rows in tables.items()}


def _kept(tables: Mapping[str, DataFrame], column: str, plan: Mapping) -> list[str]:
    gone = {r for t in plan["drop"].values() for r in t}
    return sorted({r[column] for rows in tables.values() for r in rows.select(column).distinct().collect()} - gone)


def verify_copy(a: Mapping[str, DataFrame], b: Mapping[str, DataFrame], ids: Mapping[str, str]) -> list[str]:
    """Differences of two stores: tables, counts, id fingerprints."""
    out = [f"only in one: {t}" for t in sorted(set(a) ^ set(b))]
    for t in sorted(set(a) & set(b)):
        x, y = fingerprint(a[t], ids[t]).first(), fingerprint(b[t], ids[t]).first()
        if x != y:
            out.append(f"{t}: {tuple(x)} and {tuple(y)}")
    return out


def dangling(rows: DataFrame, provenance: str, key: str, keep: Sequence[str]) -> DataFrame:
    """Rows by the revision their provenance names, where that is not kept."""
    named = F.get_json_object(provenance, f"$.{key}")
    return rows.select(named.alias("revision")).where(~F.col("revision").isin(*keep)).groupBy("revision").agg(F.count("*").alias("n"))


def swap(spark: SparkSession, new: str, live: str, backup: str) -> None:
    """Put a finished folder in the place of the live one; back out if the second step fails."""
    path = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    fs = path(live).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path(new)):
        raise Refused(f"{new} is not there")
    if fs.exists(path(backup)):
        raise Refused(f"{backup} is there already")
    if fs.exists(path(live)) and not fs.rename(path(live), path(backup)):
        raise Refused("the live folder cannot be moved")
    if not fs.rename(path(new), path(live)):
        fs.rename(path(backup), path(live))
        raise Refused("the new folder cannot be moved")


@dataclass
class Jobs:
    """One job at a time: steps planned up front, cancelled between or within steps."""

    spark: SparkSession
    steps: Mapping[str, Callable[[], object]]
    log: list[tuple[str, str]] = field(default_factory=list)
    running: str | None = None
    cancelled: bool = False

    def run(self, names: Sequence[str]) -> dict[str, object]:
        if self.running:
            raise Refused(f"{self.running} is running")
        unknown = [n for n in names if n not in self.steps]
        if unknown:
            raise Refused(f"no such steps: {unknown}")
        out: dict[str, object] = {}
        self.cancelled = False
        for name in names:
            if self.cancelled:
                self.log.append((name, "cancelled"))
                continue
            self.running = name
            self.spark.sparkContext.setJobGroup("quillmark", name, interruptOnCancel=True)
            try:
                out[name] = self.steps[name]()
                self.log.append((name, "done"))
            except Exception:
                self.log.append((name, "failed"))
                raise
            finally:
                self.running = None
        return out

    def cancel(self) -> None:
        self.cancelled = True
        self.spark.sparkContext.cancelJobGroup("quillmark")


@contextmanager
def single_writer(spark: SparkSession, folder: str):
    """A lock file in a shared folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/.lock")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.createNewFile(path):
        raise Refused(f"{folder} is locked")
    try:
        yield
    finally:
        fs.delete(path, False)
