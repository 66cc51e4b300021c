"""Operator 7, language-model scoring by cross-entropy difference.

Two bigram models, of a target domain and of all documents as the background, share one vocabulary (all words of the
corpus; words that only the target has are one unknown word, which no scored text holds), order and smoothing. A
document's score is the mean over its tokens of target loss less background loss, in nats: low where a text is more
like the target than like the corpus.

Words are as in the near-duplicate operator: A-Z lowered, split at ASCII white space. A text is its words and an end
mark after a begin mark, so a null or empty text has one token. Repeated rows count as often as they occur. Extra
columns are not read.

Neither model is ever in one place. Texts are cut into blocks; a block asks for the counts of its distinct words and
word pairs, which are added up by ranges of their hashes, and each block gets its own back. A frequent word or pair is
one entry a block. Two of the words and pairs share a 63-bit hash with probability 2^-63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .textnum import LOWER, U64, mix, run_hashes, spans

#: Words told apart: all that a table can hold. A smaller number keeps the most frequent words of the corpus.
VOCABULARY = 2**63 - 1
#: Weight of the bigram against the unigram estimate, and the count added to each unigram.
WEIGHT = 0.7
ADDED = 0.5
#: Bytes of text of a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Tokens whose words and pairs a range of hashes holds at most, on the average.
RANGE_TOKENS = 1 << 24
#: Word hashes that a task holds before it sends them on to be counted.
_HELD_WORDS = 1 << 22
#: Bytes hashed at once.
_PIECE_BYTES = 1 << 18
_MARK, _UNKNOWN = mix(np.array([0x6D61726B, 0x756E6B], U64))
_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = "[\\x20\\x09-\\x0D]+"
_BLOCK = "block long, background boolean, n_tokens long, ids array<long>, lengths binary, words binary, tokens binary"


def vocabulary(docs: DataFrame, size: int) -> list[str]:
    """The most frequent words; among equals the smaller."""
    words = F.explode(F.split(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWERED), _GAP))
    counts = docs.select(words.alias("word")).where("word != ''").groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


def _packed(numbers: np.ndarray) -> bytes:
    """Their number and, compressed, their first bytes, second bytes and so on; high bytes are mostly zero."""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and each row's number of words."""
    body = LOWER[body]
    s, e, row = spans(body, offsets)
    return run_hashes(body, s, e), np.bincount(row, minlength=len(offsets) - 1)


def blocks(docs: DataFrame, background: bool, known: np.ndarray | None) -> DataFrame:
    """Blocks of documents: ids, tokens a text, distinct word hashes, and for every token the place of its word.

    Place 0 is the mark that ends a text and, being before the next one's first word, begins it. Words outside ``known``,
    if given, are one.
    """

    def run(batches):
        number = (TaskContext.get().partitionId() << 32) * 2 + background
        for batch in batches:
            body, offsets = common.text_column(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in common.pieces(offsets, BLOCK_BYTES):
                at = offsets[a : b + 1]
                parts = [word_hashes(body[at[c] : at[d]], at[c : d + 1] - at[c]) for c, d in common.pieces(at, _PIECE_BYTES)]
                h, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                if known is not None:
                    h = np.where(np.isin(h, known), h, _UNKNOWN)
                words, place = np.unique(h, return_inverse=True)
                tokens = np.zeros(len(h) + len(n), np.int32)
                tokens[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = place + 1
                columns = [[number], [background], [len(tokens)], [ids.slice(a, b - a).to_pylist()], [_packed(n + 1)], [_packed(np.diff(words, prepend=U64(0)))], [_packed(tokens)]]
                number += 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 3], strict=True)], _NAMES)

    return docs.mapInArrow(run, _BLOCK)


_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


class Block:
    """Distinct words and pairs of a block; ``keys`` are their hashes, words first, told apart by the lowest bit."""

    def __init__(self, words: bytes, tokens: bytes, buckets: int) -> None:
        h = np.concatenate([[_MARK], np.cumsum(_unpacked(words, U64), dtype=U64)])
        now = _unpacked(tokens, np.int32).astype(np.int64)
        before = np.concatenate([[0], now[:-1]])
        pair, self.token_pair, n = np.unique(before * len(h) + now, return_inverse=True, return_counts=True)
        self.before, self.now = pair // len(h), pair % len(h)
        both = mix(h[self.before] * U64(0xA0761D6478BD642F) + mix(h[self.now]))
        self.keys = np.concatenate([h | U64(1), both & ~U64(1)])
        self.n = np.concatenate([np.bincount(now, minlength=len(h)), n])
        self.order = np.argsort(self.keys)
        #: of each bucket, the first of its keys in that order
        bucket = (self.keys[self.order] >> U64(32)) * U64(buckets) >> U64(32)
        self.bounds = np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))


def asked(rows: DataFrame, buckets: int) -> DataFrame:
    """What each block holds of each range of hashes."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                own = Block(r["words"], r["tokens"], buckets)
                keys, n = own.keys[own.order], own.n[own.order]
                spans_ = [(k, a, b) for k, (a, b) in enumerate(zip(own.bounds[:-1], own.bounds[1:], strict=True)) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _, _ in spans_], pa.int32()), pa.array([r["block"]] * len(spans_), pa.int64()), pa.array([r["background"]] * len(spans_), pa.bool_()),
                        pa.array([_packed(np.diff(keys[a:b], prepend=U64(0))) for _, a, b in spans_], pa.binary()), pa.array([_packed(n[a:b]) for _, a, b in spans_], pa.binary()),
                    ], ["bucket", "block", "background", "keys", "n"],
                )

    return rows.select("block", "background", "words", "tokens").mapInArrow(run, "bucket int, block long, background boolean, keys binary, n binary")


def totals(table: pa.Table) -> pa.Table:
    """Of one range of hashes: to every background block the counts over the target and over the corpus, in its order."""
    rows = table.to_pylist()
    keys = [np.cumsum(_unpacked(r["keys"], U64), dtype=U64) for r in rows]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys])
    sums = np.zeros((2, len(distinct)), np.int64)
    for r, k, end in zip(rows, keys, ends, strict=True):
        sums[int(r["background"]), at[end - len(k) : end]] += _unpacked(r["n"])  # a block's keys are distinct
    found = []
    for r, k, end in zip(rows, keys, ends, strict=True):
        if r["background"]:
            own = at[end - len(k) : end]
            found.append((r["block"], r["bucket"], _packed(sums[0][own]), _packed(sums[1][own])))
    columns = list(zip(*found, strict=True)) if found else [[]] * 4
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.binary(), pa.binary()], strict=True)], ["block", "bucket", "t", "b"])


def distinct_words(rows: DataFrame, buckets: int) -> int:
    """How many words the blocks hold, by ranges of their hashes; a task sends a word once for many blocks."""

    def dealt(batches):
        held, n = [], 0
        for batch in batches:
            for data in batch.column("words").to_pylist():
                held.append(np.cumsum(_unpacked(data, U64), dtype=U64))
                n += len(held[-1])
                if n > _HELD_WORDS:
                    held = [np.unique(np.concatenate(held))]
                    n = len(held[0])
                    if n > _HELD_WORDS // 2:
                        yield sent(held[0])
                        held, n = [], 0
        if held:
            yield sent(np.unique(np.concatenate(held)))

    def sent(h: np.ndarray) -> pa.RecordBatch:
        bounds = np.searchsorted((h >> U64(32)) * U64(buckets) >> U64(32), np.arange(buckets + 1, dtype=U64))
        own = [(k, _packed(np.diff(h[a:b], prepend=U64(0)))) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if a < b]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in own], pa.int32()), pa.array([x for _, x in own], pa.binary())], ["bucket", "words"])

    def counted(table: pa.Table) -> pa.Table:
        h = [np.cumsum(_unpacked(x, U64), dtype=U64) | U64(1) for x in table.column("words").to_pylist()]
        return pa.table({"n": pa.array([len(np.unique(np.concatenate(h)))], pa.int64())})

    parts = rows.select("words").mapInArrow(dealt, "bucket int, words binary").groupBy("bucket").applyInArrow(counted, "n long")
    return parts.agg(F.sum("n")).first()[0] or 0


def _written(df: DataFrame, uri: str) -> DataFrame:
    """``df``, whose rows are few and large, as a Parquet table in pages of a row or so; its numbers are packed already."""
    pages = {"compression": "uncompressed", "parquet.block.size": 16 << 20, "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    df.write.mode("overwrite").options(**pages).parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def losses(own: Block, counts: np.ndarray, total: int, size: int) -> np.ndarray:
    """-log p(word | previous word) of a block's pairs, interpolated with the unigram estimate.

    A word is followed as often as it occurs, and a text begins as often as one ends.
    """
    words = len(counts) - len(own.now)
    word, pair = counts[:words], counts[words:]
    single = (word[own.now] + ADDED) / (total + ADDED * size)
    before = word[own.before]
    weight = np.where(before > 0, WEIGHT, 0.0)
    return -np.log(weight * (pair / np.maximum(before, 1)) + (1 - weight) * single)


def score(spark: SparkSession, docs: DataFrame, target: DataFrame, size: int = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_tokens, target_loss, background_loss, score, the last three rounded to six digits."""
    common.prepare(spark)
    known = None
    if size < VOCABULARY:
        body, offsets = common.text_column(pa.array(vocabulary(docs, size), pa.large_string()))
        known = run_hashes(body, offsets[:-1], offsets[1:])
    folder = common.scratch(spark, "cross-entropy")
    of_docs = blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), True, known)
    of_target = blocks(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), False, known)
    rows = _written(of_docs.unionByName(of_target), f"{folder}/blocks")
    sums = {r["background"]: r["n"] for r in rows.groupBy("background").agg(F.sum("n_tokens").alias("n")).collect()}
    total = [sums.get(False, 0), sums.get(True, 0)]
    # a range of hashes is added up by one task at once, so their number grows with the texts
    buckets = max(2 * common.shuffle_partitions(spark), -(-sum(total) // RANGE_TOKENS))
    # the words are counted by themselves, so that the counts go to the blocks without being written as a table between
    told = len(known) if known is not None else distinct_words(rows.where("background"), buckets)
    found = asked(rows, buckets).groupBy("bucket").applyInArrow(totals, "block long, bucket int, t binary, b binary")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        r = left.to_pylist()[0]
        own = Block(r["words"], r["tokens"], buckets)
        n = _unpacked(r["lengths"])
        first = np.cumsum(n) - n
        replies = sorted(right.select(["bucket", "t", "b"]).to_pylist(), key=lambda x: x["bucket"])
        means = []
        for name, tokens in zip("tb", total, strict=True):
            counts = np.zeros(len(own.keys), np.int64)
            counts[own.order] = np.concatenate([_unpacked(x[name]) for x in replies])
            means.append(np.add.reduceat(losses(own, counts, tokens, told + 2)[own.token_pair], first) / n)
        return pa.Table.from_arrays([pa.array(r["ids"], pa.int64()), pa.array(n), *map(pa.array, means)], ["doc_id", "n_tokens", "t", "b"])

    scored = rows.where("background").select("block", "ids", "lengths", "words", "tokens")
    out = scored.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, "doc_id long, n_tokens long, t double, b double")
    return out.select("doc_id", "n_tokens", F.round("t", 6).alias("target_loss"), F.round("b", 6).alias("background_loss"), F.round(F.col("t") - F.col("b"), 6).alias("score"))


SQL = f"""
WITH texts AS (
  SELECT 'b' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWERED}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
  UNION ALL SELECT 't', item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWERED}'), '[^\\x20\\x09-\\x0D]+') FROM benchmark),
vocab AS (SELECT word FROM (SELECT unnest(w) AS word FROM texts WHERE kind = 'b') GROUP BY word ORDER BY count(*) DESC, word LIMIT {VOCABULARY}),
tokens AS (SELECT kind, id, list_concat(w, ['</s>']) AS w FROM texts),
flat AS (SELECT kind, id, unnest(w) AS raw, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM tokens),
coded AS (SELECT kind, id, i, n, CASE WHEN i = n THEN '</s>' WHEN v.word IS NULL THEN '<unk>' ELSE 'w' || v.word END AS word FROM flat LEFT JOIN vocab v ON raw = v.word),
pairs AS (SELECT kind, id, n, word, coalesce(lag(word) OVER (PARTITION BY kind, id ORDER BY i), '<s>') AS prev FROM coded),
uni AS (SELECT kind, word, count(*) AS c FROM pairs GROUP BY kind, word),
tot AS (SELECT kind, count(*) AS c FROM pairs GROUP BY kind),
bi AS (SELECT kind, prev, word, count(*) AS c FROM pairs GROUP BY kind, prev, word),
ctx AS (SELECT kind, prev, count(*) AS c FROM pairs GROUP BY kind, prev),
size AS (SELECT count(*) + 2 AS v FROM vocab),
asked AS (SELECT id, n, word, prev FROM pairs WHERE kind = 'b'),
p AS (SELECT a.id, a.n, m.kind,
  -ln((CASE WHEN x.c IS NULL THEN 0.0 ELSE {WEIGHT} END) * CASE WHEN x.c IS NULL THEN 0.0 ELSE CAST(coalesce(b.c, 0) AS DOUBLE) / x.c END
    + (CASE WHEN x.c IS NULL THEN 1.0 ELSE {1 - WEIGHT} END) * (coalesce(u.c, 0) + {ADDED}) / (m.c + {ADDED} * s.v)) AS loss
  FROM asked a CROSS JOIN tot m CROSS JOIN size s
  LEFT JOIN bi b ON b.kind = m.kind AND b.prev = a.prev AND b.word = a.word
  LEFT JOIN ctx x ON x.kind = m.kind AND x.prev = a.prev
  LEFT JOIN uni u ON u.kind = m.kind AND u.word = a.word),
sums AS (SELECT id, n, sum(loss) FILTER (WHERE kind = 't') / n AS t, sum(loss) FILTER (WHERE kind = 'b') / n AS b FROM p GROUP BY id, n)
SELECT id AS doc_id, CAST(n AS BIGINT) AS n_tokens, round(t, 6) AS target_loss, round(b, 6) AS background_loss, round(t - b, 6) AS score FROM sums
"""
