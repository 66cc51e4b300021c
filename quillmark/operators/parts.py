"""Jobs in parts that can be stopped and resumed.

The rows of a job are numbered by their key and dealt into parts of a fixed size, each written as a table of its own
with a record of what it holds. A run does the parts that have no valid record, many in one pass over the rows. A job that is resumed must have the
conditions it began with: the same rows, size and settings, told by a fingerprint. Results are read only when every part
is there and valid.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.operators.relational import Refused

#: Parts done in one pass over the rows at most, and separate stretches of the key that they may lie in.
TOGETHER = 4096
_STRETCHES = 20


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """``rows``, distinct in an integer key, with their rank (from 0) in its order, by even ranges of the key."""
    from quillmark.operators.measure import sums_below

    return sums_below(rows.withColumn("_one", F.lit(1)), key, "_one", "rank").drop("_one")


def fingerprint(rows: DataFrame, key: str) -> tuple[int, str]:
    """How many rows, and a sum over their keys' hashes that does not depend on their order."""
    got = rows.agg(*_print(F.col(key))).first()
    return got.n, got.h


def _print(key: Column) -> list[Column]:
    return [F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(key).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("h")]


class Job:
    """``conditions``: settings that a resumed job must share, such as a revision."""

    def __init__(self, spark: SparkSession, folder: str, rows: DataFrame, key: str, size: int, conditions: Mapping[str, object]) -> None:
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key
        if rows.groupBy(key).count().where(F.col("count") > 1).limit(1).count() or rows.where(F.col(key).isNull()).limit(1).count():
            raise Refused(f"{key} does not tell the rows of a job apart")
        n, content = fingerprint(rows, key)
        wanted = {"rows": n, "content": content, "key": key, "size": size, "conditions": json.loads(json.dumps(dict(conditions), sort_keys=True, default=str))}
        stored = self._read("job.json")
        if stored is None:
            self._write("job.json", wanted)
        elif changed := sorted(k for k in wanted if stored.get(k) != wanted[k]):
            raise Refused(f"the job in {folder} began with other {', '.join(changed)}")
        self.parts = -(-n // size)
        self.rows, self.type = rows, rows.schema[key].dataType
        path, fs = self._path("keys/_SUCCESS")
        if not fs.exists(path):
            ranked = numbered(rows.select(key), key)
            ranked.select(key, F.floor(F.col("rank") / size).cast("int").alias("part")).write.mode("overwrite").parquet(f"{self.folder}/keys")
        self.keys = spark.read.schema(T.StructType([T.StructField(key, self.type), T.StructField("part", T.IntegerType())])).parquet(f"{self.folder}/keys")
        #: of each part, its least and greatest key and its fingerprint
        self.spans = {r.part: r for r in self.keys.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"), *_print(F.col(key))).collect()}

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, name: str) -> dict | None:
        path, fs = self._path(name)
        if not fs.exists(path):
            return None
        with_ = fs.open(path)
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(with_)))
        finally:
            with_.close()

    def _write(self, name: str, content: dict) -> None:
        """Under a name of its own first, so that a record is whole or absent."""
        data = json.dumps(content, sort_keys=True).encode()
        path, fs = self._path(name)
        draft, _ = self._path(name + "." + hashlib.sha256(data).hexdigest()[:8])
        out = fs.create(draft, True)
        out.write(bytearray(data))
        out.close()
        fs.delete(path, False)
        if not fs.rename(draft, path):
            raise Refused(f"{name} could not be written")

    def state(self, part: int) -> str:
        """done, invalid (its table is not what its record says) or open."""
        return self.states([part])[part]

    def states(self, which: Sequence[int]) -> dict[int, str]:
        """The state of each of these parts; their tables are read in one pass."""
        records = {part: self._read(f"part-{part:06d}.json") for part in which}
        there = [part for part, record in records.items() if record is not None and self._there(part)]
        holds = {}
        if there:
            rows = self._tables(there, T.StructType([T.StructField(self.key, self.type)]))
            holds = {r.part: [r.n, r.h] for r in rows.groupBy("part").agg(*_print(F.col(self.key))).collect()}
        return {part: "open" if record is None else "done" if part in there and holds.get(part, [0, "0"]) == record["holds"] else "invalid" for part, record in records.items()}

    def _there(self, part: int) -> bool:
        path, fs = self._path(f"part-{part:06d}")
        return fs.exists(path)

    def _tables(self, which: Sequence[int], schema: T.StructType) -> DataFrame:
        """Tables of parts with their number, which is in their files' paths."""
        rows = self.spark.read.schema(schema).parquet(*[f"{self.folder}/part-{part:06d}" for part in which])
        return rows.withColumn("part", F.regexp_extract("_metadata.file_path", "part-([0-9]+)/[^/]*$", 1).cast("int"))

    def run(self, work: Callable[[DataFrame], DataFrame], most: int | None = None, stop: Callable[[], bool] = lambda: False, together: int = TOGETHER) -> list[int]:
        """Do what is open or invalid, in order, up to ``most`` parts or until ``stop``; returns the parts done.

        ``work`` is given the rows of up to ``together`` parts at once; work that must see a part's rows by themselves
        is run with 1. ``stop`` is asked before each call.
        """
        todo = [part for part, state in self.states(range(self.parts)).items() if state != "done"][:most]
        done: list[int] = []
        while len(done) < len(todo) and not stop():
            own, stretches = [], []
            for part in todo[len(done) :]:
                if own and part == own[-1] + 1:
                    stretches[-1][1] = part
                elif len(stretches) < _STRETCHES:
                    stretches.append([part, part])
                else:
                    break
                own.append(part)
                if len(own) >= together:
                    stretches[-1][1] = part
                    break
            self._do(work, own, stretches)
            done += own
        return done

    def _do(self, work: Callable[[DataFrame], DataFrame], own: Sequence[int], stretches: Sequence[Sequence[int]]) -> None:
        key = F.col(self.key)
        within = F.lit(False)
        for a, b in stretches:
            within |= key.between(self.spans[a].low, self.spans[b].high)
        draft = f"draft-{uuid.uuid4().hex}"
        out = work(self.rows.where(within))
        fields = out.schema.jsonValue()
        out = out.drop("part").join(self.keys.where(within), self.key, "left").select(*[c for c in out.columns if c != "part"], F.coalesce("part", F.lit(-1)).alias("_part"))
        out.repartition("_part").write.partitionBy("_part").parquet(f"{self.folder}/{draft}")
        whole = self.spark.read.schema(T.StructType([T.StructField(self.key, out.schema[self.key].dataType), T.StructField("_part", T.IntegerType())])).parquet(f"{self.folder}/{draft}")
        holds = {r._part: (r.n, r.h) for r in whole.groupBy("_part").agg(*_print(key)).collect()}
        if wrong := [part for part in own if holds.get(part) != (self.spans[part].n, self.spans[part].h)]:
            raise Refused(f"parts {wrong[:10]} do not hold the rows they were given")
        if strange := sorted(set(holds) - set(own)):
            raise Refused(f"rows that were not given are in the result of parts {own[0]} to {own[-1]}: {strange[:10]}")
        for part in own:
            path, fs = self._path(f"part-{part:06d}")
            fs.delete(path, True)
            if not fs.rename(self._path(f"{draft}/_part={part}")[0], path):
                raise Refused(f"part {part} could not be written")
            self._write(f"part-{part:06d}.json", {"holds": list(holds[part]), "fields": fields})
        path, fs = self._path(draft)
        fs.delete(path, True)

    def redo(self, parts: Sequence[int]) -> None:
        """Forget the records of parts, so that the next run does them again."""
        for part in parts:
            path, fs = self._path(f"part-{part:06d}.json")
            fs.delete(path, False)

    def result(self) -> DataFrame:
        """All parts with their number; refused while one is open or invalid."""
        states = self.states(range(self.parts))
        if bad := {p: s for p, s in states.items() if s != "done"}:
            raise Refused(f"parts that are not done: {bad}")
        if not states:
            return self.rows.withColumn("part", F.lit(None).cast("int")).limit(0)
        fields = [self._fields(part) for part in states]
        if any(f != fields[0] for f in fields):
            raise Refused("the parts were written with different columns")
        schema = T.StructType.fromJson(fields[0])
        return self._tables(list(states), T.StructType([f for f in schema if f.name != "part"]))

    def _fields(self, part: int) -> dict:
        """The columns of a part, by its record or, where an older one does not tell, by its table."""
        return self._read(f"part-{part:06d}.json").get("fields") or self.spark.read.parquet(f"{self.folder}/part-{part:06d}").schema.jsonValue()


def folded(events: DataFrame, key: str, order: Sequence[str], flags: Mapping[str, str], first: Sequence[str]) -> DataFrame:
    """A keyed fold over readings in order: the first reading's values stay, flags are set once any reading sets them."""
    by = F.struct(*order)
    return events.groupBy(key).agg(*[F.min_by(c, by).alias(c) for c in first], *[F.bool_or(F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in flags.items()], F.count("*").alias("readings"))


def with_all_ids(rows: DataFrame, content: str, id_col: str, most: int) -> DataFrame:
    """One row a content with its first id, how many there are, and the first ``most`` of them in order."""
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(content).orderBy(id_col)))
    head = ranked.where(F.col("_r") <= most).groupBy(content).agg(F.sort_array(F.collect_list(id_col)).alias("ids"))
    return rows.groupBy(content).agg(F.min(id_col).alias("first_id"), F.count("*").alias("n")).join(head, content)
