"""Operator 4, near-duplicates by min-max hashing.

A document is the set of its distinct 5-word shingles. Under each of ``PERMUTATIONS`` hash functions both the smallest
and the largest value are kept: twice the signature for the same hashing. ``BANDS`` bands of six values deal documents
into buckets; one bit of each value makes a sketch whose agreement estimates the similarity. Documents of one bucket
whose sketches allow the threshold are connected, as a spanning forest, into candidate groups. The edges of the forest
are confirmed on the full sets first, and confirmed edges give classes. Only where a group holds several classes are
members of different classes compared, exactly, in pairs of blocks; confirmed links give the components.

- Documents with equal sets are one node throughout, so thousands of copies cost one signature.
- A pair at the threshold is missed by all bands with a probability of 3e-7, and by its sketch with less.
- Buckets and groups have no cap. Of a bucket beyond ``RUN`` members all are connected with its first, sketches or not,
  so a task holds no more of it than that. A group of one class, however many near-copies it has, ships each set once an
  edge; in a group of several, blocks of one class are not compared with each other.

Words are lowered in A-Z and split at ASCII white space; with fewer than five, the whole sequence is the one shingle.
A null, empty or blank text has an empty set and is linked with nothing. Repeated rows are linked like other copies:
each is returned. Rows that share a doc_id are one document, with all their texts. Rows without doc_id are returned too;
their component is that of a document with an equal set, if there is one, and else null. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components
from .covertree import _runs
from .textnum import LOWER, U64, mix, row_bounds, run_hashes, spans, window_hashes

SHINGLE = 5
PERMUTATIONS = 96
BANDS = 32
#: A band's permutations; each gives two values.
_PER_BAND = PERMUTATIONS // BANDS
#: Least agreement of two sketches: 5.5 standard deviations below that expected at the threshold.
THRESHOLD = (85, 100)
_BITS = 2 * PERMUTATIONS
_EXPECTED = (1 + THRESHOLD[0] / THRESHOLD[1]) / 2
LEAST_AGREEMENT = int(_BITS * (_EXPECTED - 5.5 * (_EXPECTED * (1 - _EXPECTED) / _BITS) ** 0.5))
#: Documents and shingles of a block of a group.
BLOCK_DOCS, BLOCK_SHINGLES = 128, 1 << 18
#: Members of a bucket whose sketches are compared.
RUN = 10_000
_SEEDS = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def shingle_sets(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within each row, and each row's bounds."""
    n = len(offsets) - 1
    body = LOWER[body]
    s, e, row = spans(body, offsets)
    h = run_hashes(body, s, e)
    win, first = window_hashes(h, row, SHINGLE)
    count = np.bincount(row, minlength=n)
    bounds = row_bounds(row, n)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    extra = np.zeros(len(short), U64)
    for k in range(1, SHINGLE):
        # shorter sequences: their own number of words sets them apart
        rows = count[short] == k
        total = np.full(rows.sum(), k, U64)
        for j in range(k):
            total = mix(total * U64(0xD6E8FEB86659FD93) + h[bounds[short[rows]] + j])
        extra[rows] = total
    value, owner = np.concatenate([win, extra]), np.concatenate([row[first], short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, row_bounds(owner, n)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x 2 PERMUTATIONS) smallest and largest values of non-empty sets."""
    starts = bounds[:-1]
    low, high = np.empty((PERMUTATIONS, len(starts)), U64), np.empty((PERMUTATIONS, len(starts)), U64)
    for k in range(PERMUTATIONS):
        x = (sets ^ _SEEDS[2 * k]) * (_SEEDS[2 * k + 1] | U64(1))
        np.minimum.reduceat(x, starts, out=low[k])
        np.maximum.reduceat(x, starts, out=high[k])
    return low, high


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n, d1, d2, bands, sketch): set size, 128-bit digest of the set, band keys and sketch words."""

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            body, offsets = common.text_column(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in common.pieces(offsets):
                sets, bounds = shingle_sets(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                bands, sketch = np.zeros((b - a, BANDS), np.int64), np.zeros((b - a, _BITS // 64), np.int64)
                digest = np.zeros((2, b - a), np.int64)
                if len(full):
                    edges = np.concatenate([bounds[full], [len(sets)]])
                    digest[0, full] = np.add.reduceat(mix(sets), edges[:-1]).view(np.int64)
                    digest[1, full] = np.add.reduceat(mix(sets ^ _SEEDS[0]), edges[:-1]).view(np.int64)
                    low, high = signatures(sets, edges)
                    for k in range(BANDS):
                        key = np.full(len(full), k + 1, U64)
                        for j in range(k * _PER_BAND, (k + 1) * _PER_BAND):
                            key = mix(key * U64(3) + low[j])
                            key = mix(key * U64(3) + high[j])
                        bands[full, k] = key.view(np.int64)
                    bits = np.concatenate([mix(low), mix(high)]).T >> U64(63)
                    packed = np.packbits(np.ascontiguousarray(bits.astype(np.uint8)), axis=1)
                    sketch[full] = packed.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a), pa.array(row + np.arange(b - a)), pa.array(n.astype(np.int64)), pa.array(digest[0]), pa.array(digest[1]),
                        pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64())),
                        pa.FixedSizeListArray.from_arrays(pa.array(sketch.ravel()), _BITS // 64).cast(pa.list_(pa.int64())),
                    ],
                    ["doc_id", "row", "n", "d1", "d2", "bands", "sketch"],
                )
                row += b - a

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, row long, n long, d1 long, d2 long, bands array<long>, sketch array<long>")


def forest(sketches: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect, in each run, the members that a chain of agreeing sketches connects."""
    a, b = [], []
    two = ends - starts == 2
    i = starts[two]
    alike = np.bitwise_count(~(sketches[i] ^ sketches[i + 1])).sum(1) >= LEAST_AGREEMENT
    a.append(i[alike])
    b.append(i[alike] + 1)
    for s, e in zip(starts[~two].tolist(), ends[~two].tolist(), strict=True):
        left = np.arange(s, e)
        while len(left) > 1:
            frontier, left = [left[0]], left[1:]
            while frontier and len(left):
                x = frontier.pop()
                near = np.bitwise_count(~(sketches[left] ^ sketches[x])).sum(1) >= LEAST_AGREEMENT
                if near.any():
                    a.append(np.full(near.sum(), x))
                    b.append(left[near])
                    frontier += left[near].tolist()
                    left = left[~near]
    return np.concatenate(a), np.concatenate(b)


def _candidates(nodes: DataFrame, n: int) -> DataFrame:
    """Edges (u, v) of candidate pairs between nodes (node, bands, sketch)."""
    words = [f"s{k}" for k in range(_BITS // 64)]
    rows = nodes.select("node", F.explode("bands").alias("key"), *[F.col("sketch")[k].alias(w) for k, w in enumerate(words)])
    rows = rows.repartition(n, "key").sortWithinPartitions("key", "node")

    def links(t: pa.Table):
        """Edges of whole buckets."""
        key, node = np.asarray(t["key"]), np.asarray(t["node"])
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(cut[1:], len(key))
        many = ends - cut > 1
        if many.any():
            a, b = forest(np.stack([np.asarray(t[w]) for w in words], 1).view(U64), cut[many], ends[many])
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["u", "v"])

    def star(first: int, node: np.ndarray):
        node = node[node != first]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), first)), pa.array(node)], ["u", "v"])

    def run(batches):
        rest, held = [], 0  # the last bucket, which may go on: parts and rows
        hot: tuple[int, int] | None = None  # key and first member of a bucket beyond the bound
        for batch in batches:
            key = np.asarray(batch.column("key"))
            if hot is not None:
                more = int(np.searchsorted(key, hot[0], "right"))
                yield from star(hot[1], np.asarray(batch.column("node"))[:more])
                batch, key = batch.slice(more), key[more:]
            if not len(key):
                continue
            hot = None
            last = int(np.searchsorted(key, key[-1]))
            if rest and (last or key[0] != rest[0].column("key")[0].as_py()):
                yield from links(pa.Table.from_batches([*rest, batch.slice(0, last)]))
                rest, held = [], 0
            elif last:
                yield from links(pa.Table.from_batches([batch.slice(0, last)]))
            rest.append(batch.slice(last))
            held += len(batch) - last
            if held > RUN:
                hot = int(key[-1]), rest[0].column("node")[0].as_py()
                for part in rest:
                    yield from star(hot[1], np.asarray(part.column("node")))
                rest, held = [], 0
        if rest:
            yield from links(pa.Table.from_batches(rest))

    return rows.mapInArrow(run, "u long, v long").distinct()


def confirmed(sets: list[np.ndarray], left: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
    """Links that hold on the full sets and connect what ``root`` says is not connected; with ``left`` mixed, only across its two sides.

    Shared shingles are counted by sparse products over the members' joint vocabulary, one member against all after it
    that it is not yet connected with.
    """
    sizes = np.array([len(s) for s in sets])
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(value, kind="stable")
    code = np.empty(len(value), np.int64)
    v = value[order]
    code[order] = np.cumsum(np.concatenate([[0], v[1:] != v[:-1]]))
    by_code, starts = owner[order], np.searchsorted(code[order], np.arange(code[order][-1] + 2))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    root = root.copy()
    two_sides = left.any() and not left.all()
    out = []
    for i in range(len(sets)):
        if two_sides and not left[i]:
            continue
        open_ = (root != root[i]) & (~left if two_sides else np.arange(len(sets)) > i)
        if not open_.any():
            continue
        c = code[bounds[i] : bounds[i + 1]]
        lo, hi = starts[c], starts[c + 1]
        width = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
        shared = np.bincount(by_code[at], minlength=len(sets))
        for j in np.flatnonzero(open_ & (THRESHOLD[1] * shared >= THRESHOLD[0] * (sizes[i] + sizes - shared))):
            if root[j] != root[i]:
                out.append((i, int(j)))
                root[root == root[j]] = root[i]
    return out


def _pairs(u: list[int], v: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _blocks(docs, shingles):
    """How many blocks of bounded documents and shingles."""
    return F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")


def _part(node: str, of: str):
    return F.pmod(F.xxhash64(node), F.col(of)).cast("int")


def full_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes of groups. ``docs``: (node, text)."""

    def read(batches):
        for batch in batches:
            for first in range(0, len(batch), 256):
                cut = batch.slice(first, 256)
                body, offsets = common.text_column(cut.column("text"))
                sets, bounds = shingle_sets(body, offsets)
                yield pa.RecordBatch.from_arrays([cut.column("node"), pa.array([sets[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["node", "shingles"])

    # the same join at every size: which texts are shuffled must not hinge on what is small enough to broadcast
    wanted = members.select(F.col("node").alias("_node")).hint("merge")
    return docs.join(wanted, F.col("node") == F.col("_node")).select("node", "text").mapInArrow(read, "node long, shingles binary")


def confirmed_edges(edges: DataFrame, members: DataFrame, sets: DataFrame, n: int) -> DataFrame:
    """The edges (u, v) that hold on the full sets. A node with many edges meets its neighbours in parts, its set once in each."""
    sized = edges.join(members.select(F.col("node").alias("v"), "size"), "v")
    load = sized.groupBy("u").agg(_blocks(F.count("*"), F.sum("size")).alias("parts"))
    placed = edges.join(load, "u").withColumn("part", _part("v", "parts")).select("u", "part", F.col("v").alias("_node"), F.lit(1).alias("side"))
    hubs = load.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("u").alias("_node"), F.lit(0).alias("side"))
    dealt = placed.unionByName(hubs).join(sets, F.col("node") == F.col("_node")).select("u", "part", "side", "node", "shingles")
    dealt = dealt.repartition(n, "u", "part").sortWithinPartitions("u", "part", "side", "node")

    def check(batches):
        for (hub, _), t in _runs(batches, ["u", "part"]):
            node, side, data = np.asarray(t["node"]), np.asarray(t["side"]), [np.frombuffer(x.as_py(), U64) for x in t["shingles"]]
            # rows that share a doc_id bring several sets of one node
            own, near = [x for x, k in zip(data, side, strict=True) if not k], [(i, x) for i, x, k in zip(node, data, side, strict=True) if k]
            holds = [i for i, x in near if any(alike(h, x) for h in own)]
            yield _pairs([hub] * len(holds), holds)

    return dealt.mapInArrow(check, "u long, v long").distinct()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending sets reach the threshold."""
    least, most = sorted((len(a), len(b)))
    if THRESHOLD[1] * least < THRESHOLD[0] * most:
        return False
    at = np.searchsorted(a, b)
    shared = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return THRESHOLD[1] * shared >= THRESHOLD[0] * (len(a) + len(b) - shared)


def links_between(members: DataFrame, sets: DataFrame, n: int) -> DataFrame:
    """Links (u, v) between members of different classes of a group. ``members``: (node, grp, class, size)."""
    classes = members.groupBy("grp", "class").agg(F.count("*").alias("docs"), F.sum("size").alias("shingles"))
    several = classes.groupBy("grp").agg(F.count("*").alias("k")).where("k > 1").select(F.col("grp").alias("_g"))
    classes = classes.join(several, F.col("grp") == F.col("_g")).drop("_g")
    # a large class has blocks of its own; small ones share some. A block is its class, or null, and a number
    own = F.when((F.col("docs") >= BLOCK_DOCS) | (F.col("shingles") >= BLOCK_SHINGLES), F.col("class"))
    classes = classes.withColumn("of", own)
    shares = classes.groupBy("grp", "of").agg(_blocks(F.sum("docs"), F.sum("shingles")).alias("blocks"))
    blocks = shares.select("grp", "of", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k"))
    name = F.struct(F.coalesce("of", F.lit(-(1 << 62))).alias("of"), "k")
    blocks = blocks.select("grp", "of", name.alias("block"))
    other = blocks.select(F.col("grp").alias("_g"), F.col("of").alias("_of"), F.col("block").alias("_block"))
    # every pair of blocks once, but for blocks of one class
    pairs = blocks.join(other, (F.col("grp") == F.col("_g")) & (F.col("block") <= F.col("_block")) & ~F.coalesce(F.col("of") == F.col("_of"), F.lit(False)))
    pairs = pairs.select("grp", F.col("block").alias("i"), F.col("_block").alias("j"))
    sides = pairs.select("grp", "i", "j", F.col("i").alias("block")).unionByName(pairs.where("i <> j").select("grp", "i", "j", F.col("j").alias("block")))
    known = classes.select("grp", "class", "of").join(shares.withColumnRenamed("grp", "_g").withColumnRenamed("of", "_of"), (F.col("grp") == F.col("_g")) & F.col("of").eqNullSafe(F.col("_of")))
    placed = members.join(known.select("grp", "class", "of", "blocks"), ["grp", "class"]).withColumn("k", _part("node", "blocks"))
    placed = placed.select("grp", name.alias("block"), "class", F.col("node").alias("_node")).join(sides, ["grp", "block"])
    dealt = placed.join(sets, F.col("node") == F.col("_node"))
    dealt = dealt.select("grp", F.xxhash64("i", "j").alias("pair"), (F.col("block") == F.col("i")).alias("left"), "node", "class", "shingles")
    dealt = dealt.repartition(n, "grp", "pair").sortWithinPartitions("grp", "pair", "node")

    def check(batches):
        for _, t in _runs(batches, ["grp", "pair"]):
            node, left, own = np.asarray(t["node"]), np.asarray(t["left"]), np.asarray(t["class"])
            if len(node) < 2 or (own == own[0]).all():
                continue
            root = np.unique(own, return_inverse=True)[1]
            found = confirmed([np.frombuffer(x.as_py(), U64) for x in t["shingles"]], left, root)
            yield _pairs([int(node[a]) for a, _ in found], [int(node[b]) for _, b in found])

    return dealt.mapInArrow(check, "u long, v long").distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    folder = common.scratch(spark, "near")
    n = common.shuffle_partitions(spark)
    signed = common.written(_signed(docs), f"{folder}/signed")
    # one node per distinct set: the smallest id that has it. Its rows all have the same text words
    ids = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    nodes = ids.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    nodes = common.written(nodes, f"{folder}/nodes")
    edges = common.written(_candidates(nodes, n), f"{folder}/edges")
    rough = components(edges, f"{folder}/rough")
    members = nodes.select("node", F.col("n").alias("size")).join(rough.withColumnRenamed("component", "grp"), "node")
    members = common.written(members.groupBy("node", "grp").agg(F.sum("size").alias("size")), f"{folder}/members")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("node"), "text")
    sets = common.written(full_sets(texts, members), f"{folder}/sets")
    sure = common.written(confirmed_edges(edges, members, sets, n), f"{folder}/sure")
    classed = components(sure, f"{folder}/classes1").select(F.col("node").alias("_n"), "component")
    classed = members.join(classed, F.col("node") == F.col("_n"), "left").select("node", "grp", F.coalesce("component", "node").alias("class"), "size")
    classed = common.written(classed, f"{folder}/classed")
    more = links_between(classed, sets, n)
    exact = components(sure.unionByName(more), f"{folder}/exact")
    classes = nodes.select("d1", "d2", "n", "node").join(exact, "node", "left").select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.col("n").alias("_n"), F.coalesce("component", "node").alias("component")
    )
    # two tables, so that a set with a third of the rows can be split
    classes = common.written(classes, f"{folder}/classes")
    out = signed.select("doc_id", "n", "d1", "d2").join(classes, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")) & (F.col("n") == F.col("_n")), "left")
    component = F.coalesce("component", "doc_id")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
    out = common.held(out)
    common.drop(spark, folder)
    return out
