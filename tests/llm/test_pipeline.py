"""The corpus pipeline and the registered queries on small tables."""

import os
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from quillmark.llm import queries

from . import brute
from .test_operators import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(3)
    folder = str(tmp_path_factory.mktemp("sf"))
    word = lambda: rng.choice(["stone", "river", "under", "walks", "light", "seven", "paper", "north", "green", "voice"]) + rng.choice("abcdefgh")
    rows, labels = [], []
    for i in range(240):
        kind = i % 6
        text = "\n".join(" ".join(word() for _ in range(15)) + "." for _ in range(4))
        if kind == 1:
            text = "\n".join(" | ".join(word().upper() for _ in range(15)) + " ###" for _ in range(4))
        if kind == 2:
            text += " you vile creature."
        if kind == 3 and i > 10:
            text = rows[i - 6][1]
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(kind != 1), int(kind == 2)))
    rows += [(900, None, None, None, None), (901, "", "en", "s0", 0), (902, rows[0][1], "en", "s0", 5), (902, rows[0][1], "en", "s0", 5), (None, rows[6][1], "en", "s1", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    quality, toxic, near, mixed = kept
    assert {i for i in range(240) if i % 6 == 1}.isdisjoint(quality) and {900, 901}.isdisjoint(quality) and {i for i in range(240) if i % 6 in (0, 4, 5)} <= quality
    assert toxic == {i for i in quality if i is None or i % 6 != 2 or i >= 900}
    rows = spark.read.parquet(f"{tmp_path}/1").select("doc_id", "text").collect()
    want = brute.components({10**9 if r.doc_id is None else r.doc_id: r.text for r in rows}.items())
    assert near == {i for i, (_, c) in want.items() if c == i} and mixed <= near  # the row without an id is a copy of another
    assert spark.read.parquet(f"{tmp_path}/2").groupBy("doc_id").count().where("count > 1").isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check_packing(packed, [(r.doc_id, r.text) for r in docs.collect()], 4096, t, 2)


def test_stages_keep_clashing_columns_and_odd_ids(spark, sf_dir, tmp_path):
    """Columns named as what the stages add, null and reused ids, repeated rows, a very long text."""
    rng = random.Random(5)
    long = "\n".join(" ".join(rng.choice(["stone", "river", "under", "walks", "light", "seven", "paper", "north"]) + rng.choice("abcdefgh") for _ in range(15)) + "." for _ in range(5000))
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prose = table.where("doc_id = 0").first().text
    odd = [(950, prose.replace("stone", "granite") + " one", "en", "s0", 1), (950, long, "en", "s0", 1), (950, long, "en", "s0", 1), (None, prose.upper() + " x", "en", None, 1), (None, "short", "en", None, 1)]
    docs = table.unionByName(spark.createDataFrame(odd, table.schema))
    names = ["_id", "id", "copy", "rate", "n_copies", "shuffle_key", "_kept", "kept", "key", "row", "chosen", "first", "n_words", "score", "DOC_KEY", "in_3"]
    for k, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(70 + k))
    docs = docs.withColumn("tags", F.expr("map('a', doc_id)"))
    columns, ids = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert [r[0] for r in docs.select(F.struct(*names)).distinct().collect()] == [tuple(70 + j for j in range(len(names)))]
        ids[name] = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
    for name in ("quality rules", "toxicity"):
        # rows are judged one by one: both texts of an id and the row without one stay, repeated rows too
        assert [i for i, _ in ids[name] if i in (None, 950)].count(950) == 3 and (None, prose.upper() + " x") in ids[name]
    assert (None, "short") not in ids["quality rules"]
    near = ids["near-duplicates"]
    assert [len(t) > 10**5 for i, t in near if i == 950].count(True) == 1 and len(set(near)) == len(near)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0


def test_near_duplicates_keep_the_least_id_and_one_of_equal_rows(spark):
    rows = [(5, "a b c d e f g", "x"), (5, "a b c d e f g", "y"), (5, "h i j k l m n", "x"), (3, "h i j k l m n", "x"), (None, "a b c d e f g", "x"), (None, "o p q r s t u", "x"), (None, "o p q r s t u", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for n in (1, 4):
        got = corpus_pipeline.near_dedup(spark, docs.repartition(n), "").collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=repr) == [(3, "h i j k l m n"), (5, "a b c d e f g"), (None, "o p q r s t u")]
    plain = docs.where("doc_id = 3")
    assert corpus_pipeline.near_dedup(spark, plain, "").collect() == plain.collect()


def test_run_is_stable_and_takes_an_empty_table(spark, sf_dir, tmp_path):
    key = lambda df: sorted((r.doc_id, r.doc_tokens, r.length, r.ids_crc32) for r in df.collect())
    whole = sum(x[2] for x in key(corpus_pipeline.run(spark, sf_dir)))
    assert whole == sum(x[2] for x in key(corpus_pipeline.run(spark, sf_dir))) > 0
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    from ..test_queries import TABLES, rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    cur = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cur.fetchall())


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
