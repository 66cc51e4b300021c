"""Operator 5, exact top-k search: dual-tree search over cover trees.

Vectors are turned into integers and dealt into blocks of near neighbours of even size; queries likewise into groups.
A cover tree is built over the vectors of each block, and over the queries of each group once, to be sent along with
them. A pair of nodes is pruned when the largest inner product that its two covering balls allow is below the worst kth
score of the query node. The same bound on whole blocks and groups decides beforehand which blocks a group is sent to,
once its own block has given it kth scores. Pruning is by strict comparison, so ties are never lost, and scores are
exact. ``search_report`` says what share of all pairs was scored.

Vectors that are null or empty or hold null or non-finite components, and rows without vec_id, take no part. Vectors
are compared with those of the same length only. Repeated rows (id and vector) count once; a query's candidates are the
rows with another vec_id. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SCALE = 256
#: Points of a leaf.
LEAF = 32
#: Vectors taken by hash order as centres of the cells that order the blocks.
PIVOTS = 64
#: Rows of a block at least, and blocks at most: their summaries are sent to every task.
BLOCK_ROWS, MOST_BLOCKS = 512, 20_000
GROUP_ROWS, MOST_GROUPS = 128, 4_000
#: Vector lengths told apart; more are refused.
MOST_LENGTHS = 1_000


class Node:
    """A ball around a point that covers all points below it."""

    __slots__ = ("center", "radius", "norm", "points", "children", "centers", "radii", "norms")

    def __init__(self, center: np.ndarray, radius: float, points: np.ndarray, children: list[Node]) -> None:
        self.center, self.radius, self.points, self.children = center, radius, points, children
        self.norm = float(np.sqrt(center @ center))
        if children:
            self.centers = np.array([c.center for c in children])
            self.radii = np.array([c.radius for c in children])
            self.norms = np.array([c.norm for c in children])


def tree(x: np.ndarray) -> Node:
    """A cover tree: children of a node lie within half its radius of their centres, which are further apart than that."""

    def build(points: np.ndarray, center: int, far: np.ndarray) -> Node:
        radius = float(far.max())
        if len(points) <= LEAF or radius == 0:
            return Node(x[center], radius, points, [])
        children, single = [], []
        rest, at, reach = points, center, radius / 2
        while len(rest):
            d = np.sqrt(((x[rest] - x[at]) ** 2).sum(1))
            near = d <= reach
            near |= rest == at
            if near.sum() == 1:
                single.append(at)
            else:
                children.append(build(rest[near], at, d[near]))
            rest = rest[~near]
            if len(rest):
                at = rest[0]
        # points alone in their ball are tested together
        for first in range(0, len(single), LEAF):
            own = np.array(single[first : first + LEAF])
            children.append(Node(x[own[0]], float(np.sqrt(((x[own] - x[own[0]]) ** 2).sum(1).max())), own, []))
        return Node(x[center], radius, points, children)

    everything = np.arange(len(x))
    return build(everything, 0, np.sqrt(((x - x[0]) ** 2).sum(1)))


def flat(root: Node, x: np.ndarray) -> bytes:
    """A tree as numbers, in preorder: of each node its centre's row, radius, children and points, then the points of leaves."""
    numbers, radii, leaves = [], [], []
    todo = [root]
    while todo:
        node = todo.pop()
        at = int(np.flatnonzero((x == node.center).all(1))[0])
        numbers += [at, len(node.children), len(node.points)]
        radii.append(node.radius)
        leaves.append(node.points)
        todo += node.children[::-1]
    parts = np.array([len(radii)], np.int64), np.array(numbers, np.int64), np.array(radii), np.concatenate(leaves).astype(np.int64)
    return b"".join(p.tobytes() for p in parts)


def unflat(data: bytes, x: np.ndarray) -> Node:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    numbers, radii = np.frombuffer(data, np.int64, 3 * n, 8).reshape(n, 3), np.frombuffer(data, float, n, 8 + 24 * n)
    points, at, first = np.frombuffer(data, np.int64, -1, 8 + 32 * n), 0, 0

    def read() -> Node:
        nonlocal at, first
        center, children, size = numbers[at].tolist()
        own, radius = points[first : first + size], float(radii[at])
        at, first = at + 1, first + size
        return Node(x[center], radius, own, [read() for _ in range(children)])

    return read()


def ceiling(ca: np.ndarray, ra, na, cb: np.ndarray, rb, nb):
    """The largest inner product of a point of one ball with one of another, with room for rounding."""
    top = cb @ ca + ra * nb + rb * na + ra * rb
    return top + 1e-9 * (np.abs(top) + (na + ra) * (nb + rb)) + 1e-6


class Search:
    """The k best of a block for each query of a group. ``floor``: kth scores known beforehand."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, floor: np.ndarray) -> None:
        self.q, self.q_ids, self.x, self.x_ids, self.k = q, q_ids, x, x_ids, k
        self.floor, self.norms = floor, np.sqrt((q * q).sum(1))
        self.score = np.full((len(q), k), -np.inf)
        self.ids = np.full((len(q), k), np.iinfo(np.int64).max)
        self.scored = 0

    def worst(self, points: np.ndarray) -> float:
        return float(np.maximum(self.score[points, -1], self.floor[points]).min())

    def base(self, qs: np.ndarray, leaf: Node) -> None:
        """Score the queries that the leaf's ball can still serve, each by its own kth score."""
        tops = ceiling(leaf.center, leaf.radius, leaf.norm, self.q[qs], 0.0, self.norms[qs])
        qs, xs = qs[tops >= np.maximum(self.score[qs, -1], self.floor[qs])], leaf.points
        if not len(qs):
            return
        self.scored += len(qs) * len(xs)
        s = self.q[qs] @ self.x[xs].T
        s[self.q_ids[qs][:, None] == self.x_ids[xs]] = -np.inf
        open_ = (s >= np.maximum(self.score[qs, -1], self.floor[qs])[:, None]) & (s > -np.inf)
        for row in np.flatnonzero(open_.any(1)):
            j, i = open_[row], qs[row]
            score, ids = np.concatenate([self.score[i], s[row, j]]), np.concatenate([self.ids[i], self.x_ids[xs[j]]])
            best = np.lexsort((ids, -score))[: self.k]
            self.score[i], self.ids[i] = score[best], ids[best]

    def run(self, a: Node, b: Node) -> None:
        if ceiling(a.center, a.radius, a.norm, b.center, b.radius, b.norm) < self.worst(a.points):
            return
        if not a.children and not b.children:
            self.base(a.points, b)
        elif b.children and (not a.children or b.radius >= a.radius):
            tops = ceiling(a.center, a.radius, a.norm, b.centers, b.radii, b.norms)
            for j in np.argsort(-tops, kind="stable"):
                if tops[j] < self.worst(a.points):
                    break
                self.run(a, b.children[j])
        else:
            for child in a.children:
                self.run(child, b)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal-length integer lists, as floats: inner products below 2**53 are exact."""
    n = len(column)
    x = np.asarray(column.flatten(), np.float64).reshape(n, -1)
    if x.size and float(np.abs(x).max()) ** 2 * x.shape[1] >= 2.0**53:
        raise OverflowError("components are too large for exact scores")
    return x


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of each value of ``keys``, which arrive sorted by them."""
    held, now = [], None
    for batch in batches:
        if not len(batch):
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        cut = np.zeros(len(batch), bool)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(cut), len(batch)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[a].item() for c in cols)
            if key != now and held:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim) of the rows that take part."""
    x = F.col("embedding")
    good = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    return vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.size(x).alias("dim"))


def _cells(rows: DataFrame) -> tuple[DataFrame, Callable]:
    """Rows with the nearest of a bounded number of pivots of their length."""
    pivots: dict[int, np.ndarray] = {}
    lengths = [r["dim"] for r in rows.select("dim").distinct().limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"more than {MOST_LENGTHS} vector lengths")
    for dim in lengths:
        some = rows.where(F.col("dim") == dim).orderBy(common.stable_order("vec_id"), "vec_id").limit(PIVOTS).collect()
        p = np.array(sorted({tuple(r["v"]) for r in some}), float)
        # neighbours follow one another: each next pivot is the nearest of those left
        left, chain = list(range(1, len(p))), [0]
        while left:
            chain.append(left.pop(int(np.argmin(((p[left] - p[chain[-1]]) ** 2).sum(1)))))
        pivots[dim] = p[chain]

    def run(batches):
        for (dim,), t in ((k, t) for b in batches for k, t in _runs(iter([b]), ["dim"])):
            x, p = _matrix(t["v"].combine_chunks()), pivots[dim]
            cell = np.argmin((p * p).sum(1) - 2 * x @ p.T, axis=1) if len(x) else np.zeros(0, int)
            for batch in t.append_column("cell", pa.array(cell, pa.int32())).to_batches():
                yield batch

    return rows.mapInArrow(run, "vec_id long, v array<long>, dim int, cell int")


def search(spark: SparkSession, vectors: DataFrame, query: str, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of each row that the SQL condition ``query`` chooses."""
    return search_report(spark, vectors, query, k)[0]


def search_report(spark: SparkSession, vectors: DataFrame, query: str, k: int = 5) -> tuple[DataFrame, float]:
    """The result of ``search``, and the share of all pairs of a query and a vector of its length that were scored."""
    folder = common.scratch(spark, "top-k")
    rows = common.written(_cells(integers(vectors).dropDuplicates(["vec_id", "v"])), f"{folder}/rows")
    cells = sorted((r["dim"], r["cell"], r["n"]) for r in rows.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect())
    total = sum(c[2] for c in cells)
    per_block = max(BLOCK_ROWS, -(-total // MOST_BLOCKS))
    before, starts = {}, {}
    for dim, cell, n in cells:
        starts.setdefault(dim, sum(x for d, _, x in cells if d < dim))
        before[dim, cell] = sum(x for d, c, x in cells if (d, c) < (dim, cell))
    # a row's place in the order of its cell is dealt by hash, so blocks are even however large a cell is
    u = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(1)), F.lit(1 << 20)).cast("double") / (1 << 20)
    table = spark.createDataFrame([(d, c, n, before[d, c]) for d, c, n in cells], "dim int, cell int, n long, ahead long")
    placed = rows.join(F.broadcast(table), ["dim", "cell"]).withColumn("at", F.col("ahead") + F.floor(u * F.col("n")))
    block = F.floor(F.col("at") / per_block).cast("long") * MOST_LENGTHS
    dim_no = {d: i for i, d in enumerate(sorted(starts))}
    number = F.lit(0)
    for d, i in dim_no.items():
        number = F.when(F.col("dim") == d, F.lit(i)).otherwise(number)
    placed = placed.withColumn("block", block + number)
    chosen = placed.where(query)
    n_queries = chosen.count()
    per_group = max(1, total // max(1, min(MOST_GROUPS, -(-n_queries // GROUP_ROWS))))
    chosen = chosen.withColumn("grp", F.floor(F.col("at") / per_group).cast("long") * MOST_LENGTHS + number)
    data = common.written(placed.select("block", "vec_id", "v"), f"{folder}/data")
    asked = common.written(chosen.select("grp", "block", "vec_id", "v"), f"{folder}/asked")
    n = common.shuffle_partitions(spark)

    def balls(df: DataFrame, key: str) -> DataFrame:
        """(key, center, radius) around each block's or group's mean, and for groups the block that holds most of it."""

        def run(batches):
            for (name,), t in _runs(batches, [key]):
                x = _matrix(t["v"].combine_chunks())
                center = x.mean(0)
                home = int(np.bincount(np.unique(t["block"], return_inverse=True)[1]).argmax())
                home = int(np.unique(t["block"])[home])
                radius = float(np.sqrt(((x - center) ** 2).sum(1).max()))
                made = flat(tree(x), x) if key == "grp" else b""
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([home]), pa.array([center.tolist()], pa.list_(pa.float64())), pa.array([radius]), pa.array([len(x)]), pa.array([made], pa.binary())], [key, "home", "center", "radius", "n", "tree"])

        kind = f"{key} long, home long, center array<double>, radius double, n long, tree binary"
        return df.repartition(n, key).sortWithinPartitions(key, "vec_id", "v").mapInArrow(run, kind)

    blocks = balls(data, "block").drop("tree").collect()  # at most MOST_BLOCKS and the lengths' remainders
    groups = common.held(balls(asked, "grp"))
    nothing = F.lit(float("-inf"))

    def find(links: DataFrame, floors: DataFrame | None) -> DataFrame:
        """The best of each query in the blocks that its group is linked with. A block's tree is built once a task."""
        sent = asked.drop("block").join(links, "grp")
        if floors is not None:
            sent = sent.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", nothing))
        else:
            sent = sent.withColumn("floor", nothing)
        none = F.lit(None).cast("binary")
        own = data.join(links.select("block").distinct(), "block", "left_semi").select(F.lit(-1).cast("long").alias("grp"), "block", "vec_id", "v", nothing.alias("floor"), none.alias("tree"))
        trees = links.join(groups.select("grp", "tree"), "grp").select("grp", "block", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<long>").alias("v"), nothing.alias("floor"), "tree")
        both = own.unionByName(sent.select("grp", "block", "vec_id", "v", "floor", none.alias("tree"))).unionByName(trees)

        def run(batches):
            held: tuple | None = None
            scored = 0
            for (name, grp), t in _runs(batches, ["block", "grp"]):
                if grp == -1:
                    x = _matrix(t["v"].combine_chunks())
                    held = (name, x, np.asarray(t["vec_id"]), tree(x))
                    continue
                if held is None or held[0] != name:
                    continue
                made, t = t["tree"][0].as_py(), t.slice(1)  # the row without an id comes first
                x, ids = _matrix(t["v"].combine_chunks()), np.asarray(t["vec_id"])
                s = Search(x, ids, held[1], held[2], k, np.asarray(t["floor"], float))
                s.run(unflat(made, x), held[3])
                scored += s.scored
                found = np.isfinite(s.score)
                who, rank = np.nonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(s.ids[found]), pa.array(s.score[found].astype(np.int64))], ["query_id", "vec_id", "score"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([scored], pa.int64())], ["query_id", "vec_id", "score"])

        dealt = both.repartition(n, "block").sortWithinPartitions("block", "grp", F.asc_nulls_first("vec_id"), "v")
        return dealt.mapInArrow(run, "query_id long, vec_id long, score long")

    first_found = common.held(find(groups.select("grp", F.col("home").alias("block")), None))
    first = first_found.where("query_id is not null")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k)
    kth = common.held(kth.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor")))
    worst = asked.join(kth, "vec_id", "left").groupBy("grp").agg(F.min(F.coalesce("floor", nothing)).alias("worst"))
    by_dim = {}
    for b in blocks:
        by_dim.setdefault(len(b["center"]), []).append(b)
    by_dim = {d: (np.array([b["center"] for b in x]), np.array([b["radius"] for b in x]), np.array([b["block"] for b in x])) for d, x in by_dim.items()}

    def reach(batches):
        for batch in batches:
            for g in batch.to_pylist():
                c = np.array(g["center"])
                centers, radii, names = by_dim[len(c)]
                tops = ceiling(c, g["radius"], float(np.sqrt(c @ c)), centers, radii, np.sqrt((centers**2).sum(1)))
                to = names[(tops >= g["worst"]) & (names != g["home"])]
                yield pa.RecordBatch.from_arrays([pa.array([g["grp"]] * len(to), pa.int64()), pa.array(to, pa.int64())], ["grp", "block"])

    links = common.held(groups.join(worst, "grp").mapInArrow(reach, "grp long, block long"))
    more = common.held(find(links, kth))
    done = first_found.unionByName(more).where("query_id is null").agg(F.sum("score")).first()[0] or 0
    queries = {}
    for g in groups.groupBy(F.size("center").alias("dim")).agg(F.sum("n").alias("n")).collect():
        queries[g["dim"]] = g["n"]
    pairs = sum(n * sum(c[2] for c in cells if c[0] == dim) for dim, n in queries.items())
    found = first.unionByName(more.where("query_id is not null"))
    out = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    out = common.held(out)
    common.drop(spark, folder)
    return out, done / pairs if pairs else 0.0


SQL = """
WITH good AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256.0 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(CAST(c AS DOUBLE)))) = 0),
scored AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
  FROM good q JOIN good x ON q.vec_id <> x.vec_id AND q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
