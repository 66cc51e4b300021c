"""The ten operators on small tables with nulls, empty and long texts, ties, repeated rows, and clashing columns."""

import io
import math
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillmark.llm import common, components, covertree, licenses, license_texts, minmax, mixing, moore_lewis, packing, quality, token_store, tokens, toxicity, warc
from quillmark.llm import textnum as X

from . import brute

LONG = " ".join(f"w{k % 977}" for k in range(60_000))
DOCS = [
    (1, "Plain words make a text of more than twenty words so that the base rules do not reject it at once, and it ends here.", "en", "a", 1),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (4, "   \n\t ", "de", "b", 6),
    (5, LONG, "en", "b", 1),
    (6, "same row", "fr", "a", 8),
    (6, "same row", "fr", "a", 8),
    (7, "é ñ 日本語 – “quoted” \U0001f600", "es", "c", 9),
    (None, "a row without an id", "en", "a", 3),
    (8, "Plain words make a text of more than twenty words so that the base rules do not reject it at once, and it ends here!", "en", "b", 1),
]
CLASH = "score double, kept boolean, n_words long, rate double, copy int, node long, part int, digest string, rank int, begin long, source2 string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for c in CLASH.split(", "):
        name, kind = c.split()
        rows = rows.withColumn(name, F.lit(None).cast(kind))
    return rows


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (7, 1, 1), (6, 0, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def by_id(df, *cols):
    return sorted((tuple(r[c] for c in ("doc_id", *cols)) for r in df.collect()), key=repr)


# 1
def test_license_forms(spark, docs, nothing):
    mit = license_texts.KNOWN["MIT"]
    texts = [(1, mit), (2, "Copyright (c) 2020 A. Person\n\n" + mit.upper().replace(" ", "  \n")), (3, mit + " And more."), (4, None), (5, license_texts.KNOWN["ISC"].replace("NEGLIGENCE", "negligence —"))]
    got = {r.doc_id: r.license_id for r in licenses.scan(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: "ISC"}
    own = spark.createDataFrame([("B", "Same  ROW."), ("A", "same row"), ("E", "")], "license_id string, text string")
    assert by_id(licenses.scan(spark, docs, own).where("license_id is not null"), "license_id") == [(6, "A"), (6, "A")]
    assert licenses.scan(spark, docs).count() == len(DOCS) and licenses.scan(spark, nothing).count() == 0
    pairs = [("The licence, sub-license", "the LICENSE sublicense"), ("licence licence x", "license license x"), ("copyright holder copyright holders per cent", "Copyright owner copyright owners percent"), ("sub licence", "sublicense")]
    for pair in pairs:  # equivalent words side by side too
        spelt = licenses.scan(spark, spark.createDataFrame(list(enumerate(pair)), "doc_id long, text string")).select("digest").distinct()
        assert spelt.count() == 1
    assert licenses.scan(spark, spark.createDataFrame([(1, "the copy is free of a copyright"), (2, "the cop")], "doc_id long, text string")).select("digest").distinct().count() == 2


def test_license_notices_of_lines(spark):
    texts = [
        (1, "Some prose.\nReleased under the MIT License.\nMore."), (2, "SPDX-License-Identifier: Apache-2.0\nLICENSED UNDER  CC BY-NC 4.0!\nLicensed under the Apache License, Version 2.0."),
        (3, "The licence of the poet."), (4, None), (5, "This work is licensed under the GNU General Public Licence, version 3."), (6, "released under the MIT License, as it were"),
    ]
    got = {r.doc_id: r.notice_ids for r in licenses.scan(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "Apache-2.0,CC-BY-NC-4.0", 3: "", 4: "", 5: "GPL-3.0", 6: ""}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the test tables are not here")
def test_license_lines_of_the_test_table(spark):
    got = licenses.scan(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert got.where("notice_ids <> ''").count() > 10


@pytest.mark.skipif(not os.path.exists("/usr/share/common-licenses/GPL-3"), reason="no licence texts here")
def test_license_digests(spark):
    rows = [(k, open(f"/usr/share/common-licenses/{k}", encoding="utf-8", errors="replace").read()) for k in license_texts.KNOWN_DIGESTS]
    got = licenses.scan(spark, spark.createDataFrame(rows, "doc_id string, text string"))
    assert all(r.license_id == r.doc_id for r in got.collect())


NOTICES = [
    "Copyright The Go Authors", "Copyright Jane Doe", "Copyright Will Smith. All rights reserved.", "Copyright: 2020 X", "Copyright [yyyy] [name of copyright owner]",
    "Portions Copyright (c) 2010 X", "(c) Copyright 2011 Y", " * Copyright {yyyy} {name}\n * Copyright 2012 Émile",
]


@pytest.mark.skipif(not os.path.exists("/usr/share/common-licenses/GPL-3"), reason="no licence texts here")
def test_license_notices(spark):
    import textwrap

    shipped = {k: open(f"/usr/share/common-licenses/{k}", encoding="utf-8", errors="replace").read() for k in license_texts.KNOWN_DIGESTS}
    known = {**license_texts.KNOWN, **shipped}
    rows = [(k, f"{notice}\n\n{text}") for k, text in known.items() for notice in NOTICES]
    # every "copyright" of the running text begins a line once
    rows += [(k, textwrap.fill(" ".join(text.split()), width)) for k, text in license_texts.KNOWN.items() for width in range(40, 60)]
    line = "   Copyright [yyyy] [name of copyright owner]"
    assert line in shipped["Apache-2.0"]
    rows += [("Apache-2.0", shipped["Apache-2.0"].replace(line, filled)) for filled in ("   Copyright 2020 Example Authors", "   Copyright Jane Doe", "")]
    got = licenses.scan(spark, spark.createDataFrame(rows, "doc_id string, text string")).where("license_id is null or license_id <> doc_id")
    assert [r.doc_id for r in got.collect()] == []
    # where a wrapped line begins with the word, it stays
    broken = [(k, text, text.replace("copyright", "\ncopyright").replace("Copyright ", "\nCopyright ")) for k, text in shipped.items() if k in ("CC0-1.0", "Artistic", "MPL-2.0")]
    forms = spark.createDataFrame(broken, "id string, a string, b string").select("id", (licenses.canonical(F.col("a")) == licenses.canonical(F.col("b"))).alias("same"))
    assert [r.id for r in forms.where("not same").collect()] == []


# 2
@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoded(e, texts, end=7):
    body, offsets = common.text_column(pa.array(texts, pa.large_string()))
    ids, bounds = e.encode(body, offsets, end)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_give_the_ids_of_whole_texts(name, as_text):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    if as_text:
        plain.encode_special_tokens = True
    e = tokens.Encoder(public_tokenizers.path(name), as_text)
    alphabet = st.sampled_from(list("abzAZéñßÖ×÷'’.,!#1290 \n\t\x00\x1f\u00a0\u2003\u3000́日ǅİΣςªµ<|>") + ["  ", " \n", "\n\n", "'s", "don't", "<|endoftext|>", "word ", " Été", "x, ", "y\n"])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.lists(alphabet, max_size=30).map("".join), max_size=5))
    def check(texts):
        assert encoded(e, texts) == [[*plain.encode(t, add_special_tokens=False).ids, 7] for t in texts]

    check()
    texts = [r[1] for r in DOCS] + ["a <|endoftext|> b", "<|endoftext|>", "a <| b |> c"]
    assert encoded(e, texts) == [[*plain.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]


def test_long_texts_and_full_tables(monkeypatch, byte_tokenizer):
    monkeypatch.setattr(tokens, "SEGMENT", 64)
    monkeypatch.setattr(tokens, "MOST_UNITS", 5)
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for k in range(40):
        texts = [" ".join(f"x{j} Wort, é{j}\nz" for j in range(k, k + 37)), "y" * 500 + " tail", "", "x1"]
        assert encoded(e, texts) == [[*byte_tokenizer.encode(t, add_special_tokens=False).ids, 7] for t in texts]


def test_a_rule_not_known_goes_through_the_library(tmp_path):
    from tokenizers import models, pre_tokenizers

    t = Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2}, [("a", "b")]))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(str(tmp_path / "t.json"))
    assert encoded(tokens.Encoder(str(tmp_path / "t.json")), ["ab a", "", "bab"], 9) == [[2, 0, 9], [9], [1, 2, 9]]


def test_token_files(spark, docs, nothing, byte_tokenizer):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = common.scratch(spark, "test")
    manifest = token_store.write(docs, folder, path, 0, files=3)
    got = [tuple(r) for r in token_store.read(spark, manifest).orderBy("start").collect()]
    want, at = [], 0
    for i, t in sorted(((r[0], r[1]) for r in DOCS), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*byte_tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    file = next(r.path for r in manifest.collect() if r.documents > 1).removeprefix("file:")
    with open(file, "rb") as f:
        raw = f.read()
    reader = token_store.Reader(pa.BufferReader(raw))
    wanted = [i for i in reader.doc_ids() if i is not None][-1]
    assert {i for i, _ in reader.documents({wanted})} == {wanted}
    broken = bytearray(raw)
    broken[8] ^= 0xFF
    with pytest.raises(Exception):  # noqa: B017  the decompressor's or the checksum's
        list(token_store.Reader(pa.BufferReader(bytes(broken))).documents())
    assert token_store.token_output(spark, nothing, path).count() == 0


def test_frames_are_independent():
    out = io.BytesIO()
    w = token_store.Writer(out)
    for k in range(5):
        w.frame(bytes([k]) * 1000)
    w.close()
    raw = out.getvalue()
    import zstandard

    r = token_store.Reader(pa.BufferReader(raw))
    assert [r.frame(k) for k in (4, 0, 2)] == [bytes([k]) * 1000 for k in (4, 0, 2)]
    assert b"".join(zstandard.ZstdDecompressor().read_to_iter(io.BytesIO(raw), read_size=10**6))[:1000] == bytes(1000)


# 3
def test_gradients():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["ab", "cd", "ef", "gh"], rng.integers(0, 40))) for _ in range(6)]
    body, offsets = common.text_column(pa.array(texts))
    w = toxicity.read_words(body, offsets)
    net = toxicity.Network(np.unique(w.hashes)[:3], np.zeros(3, np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    at, owner = toxicity.windows(w.row, len(texts))
    y = (np.arange(len(at)) % 2).astype(float)

    def loss():
        z = net.logits(net.inputs(w)[1].astype(np.float64), at)
        return float(np.mean(np.log1p(np.exp(-z)) + (1 - y) * z))

    g = net.gradients(w, at, y)
    for name in ("wf", "ub", "attend", "query", "out", "char", "cf"):
        v = net.p[name]
        k = np.unravel_index(np.argmax(np.abs(g[name])), v.shape)
        keep, step = v[k], 1e-3
        v[k] = keep + step
        up = loss()
        v[k] = keep - step
        down = loss()
        v[k] = keep
        assert g[name][k] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-4), name


def test_all_windows_are_scored():
    row = np.repeat([0, 2, 3], [10, 100, 32])
    at, owner = toxicity.windows(row, 5)
    assert list(np.bincount(owner, minlength=5)) == [1, 1, 6, 1, 1]
    for r in range(5):
        assert set(at[owner == r].ravel()) - {-1} == set(np.flatnonzero(row == r))


def test_toxicity(spark, docs, labels, nothing):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma"]
    rows = []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 90))]
        bad = i % 3 == 0
        if bad:
            text[rng.randrange(len(text))] = "vile"
        rows.append((i, " ".join(text), int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.score(table, table.select("doc_id", "toxic")).collect()
    truth = {i: y for i, _, y in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    edge = toxicity.score(docs, labels).collect()
    assert len(edge) == len(DOCS) and all(0 <= r.score <= 1 for r in edge)
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(nothing, labels).count() == 0


def test_scores_equal_a_plain_network():
    """Each window alone, word by word, gives the scores that whole blocks of texts get."""
    rng = random.Random(12)
    words = ["alpha", "Beta", "gamma", "délta", "omega9", "vile", "x"]
    texts = [" ".join(rng.choice(words[:-2]) for _ in range(rng.randrange(3, 60))) + (" vile thing" if k % 3 == 0 else "") for k in range(90)]
    net = toxicity.train(texts, np.array([float(k % 3 == 0) for k in range(90)]), rounds=(2, 1))
    run_hash = lambda w: int(X.run_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    probe = texts[:6] + ["", None, "?!", "one", "unknown words, VILE words and 日本 " * 20, " ".join(rng.choice(words) for _ in range(33)), "a-b_c"]
    body, offsets = common.text_column(pa.array(probe, pa.large_string()))
    got = net.documents(body, offsets)
    want = [brute.toxicity(net, t, toxicity.WINDOW, toxicity.STRIDE, run_hash) for t in probe]
    assert np.allclose(got, want, atol=1e-4)
    assert np.ptp(want) > 0.1


# 4
def near_rows():
    rng = random.Random(9)
    words = [f"v{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(30, 120))]
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((i, " ".join(text).upper() if rng.random() < 0.2 else "\n".join(text)))
            i += 1
    return [*rows, (i, "a b"), (i + 1, "A  b"), (i + 2, "a b c"), (i + 3, ""), (i + 4, ""), (i + 5, None), (i + 6, LONG), (i + 7, LONG + " tail")]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_rows()
    got = minmax.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    want = brute.components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert got.where("kept <> (doc_id = component_id)").isEmpty()


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Groups larger than a block are compared block by block, with the same result."""
    monkeypatch.setattr(minmax, "BLOCK_DOCS", 2)
    rows = near_rows()
    got = minmax.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows)


def test_near_duplicates_in_hot_buckets(spark, monkeypatch):
    """Buckets beyond the bound connect all their members with the first; the full sets decide as before."""
    monkeypatch.setattr(minmax, "RUN", 2)
    monkeypatch.setattr(minmax, "BLOCK_DOCS", 3)
    rows = near_rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = minmax.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_groups_ship_sets_once_an_edge(spark):
    """A group of one class needs no pairs of blocks, whatever its size; one of two classes only those between them."""
    n = 600
    nodes = [(k, 0, 0 if k < n - 3 else n - 3 + k % 2, 40) for k in range(n)]
    members = spark.createDataFrame(nodes, "node long, grp long, class long, size long")
    sets = spark.createDataFrame([(k, np.arange(100 * c, 100 * c + 40, dtype=np.uint64).tobytes()) for k, _, c, _ in nodes], "node long, shingles binary")
    one = members.where("class = 0")
    assert minmax.links_between(one, sets, 4).isEmpty()
    near = sets.where("node <> 599").unionByName(spark.createDataFrame([(599, np.arange(0, 40, dtype=np.uint64).tobytes())], "node long, shingles binary"))
    found = {tuple(sorted(r)) for r in minmax.links_between(members, near, 4).collect()}
    assert found and all(b == 599 for _, b in found)
    edges = spark.createDataFrame([(0, k) for k in range(1, n)], "u long, v long")
    assert {r.v for r in minmax.confirmed_edges(edges, members, near, 4).collect()} == {*range(1, n - 3), 599}


def test_near_duplicates_edges(spark, docs, nothing):
    got = by_id(minmax.near_duplicates(spark, docs), "n_shingles", "component_id", "kept")
    assert len(got) == len(DOCS)
    assert [g for g in got if g[0] == 6] == [(6, 1, 6, True)] * 2
    assert (2, 0, 2, True) in got and (3, 0, 3, True) in got and (None, 1, None, True) in got
    assert minmax.near_duplicates(spark, nothing).count() == 0


def test_signature_estimates_similarity():
    a = np.arange(1000, dtype=np.uint64)
    sets = np.concatenate([np.sort(X.mix(a)), np.sort(X.mix(a[100:]))])
    low, high = minmax.signatures(sets, np.array([0, 1000, 1900]))
    agree = np.concatenate([low[:, 0] == low[:, 1], high[:, 0] == high[:, 1]]).mean()
    assert agree == pytest.approx(0.9, abs=0.08)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (5, 5), (102, 100)] + [(200, 200 + k) for k in range(1, 30)]
    got = components.components(spark.createDataFrame(edges, "u long, v long"), common.scratch(spark, "cc"))
    want = {**{k: 0 for k in range(41)}, **{k: 100 for k in (100, 101, 102)}, **{200 + k: 200 for k in range(30)}}
    assert {r.node: r.component for r in got.collect()} == want
    assert components.components(spark.createDataFrame([], "u long, v long"), common.scratch(spark, "cc")).count() == 0


# 5
def brute_topk(rows, k, chosen):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[i, tuple(math.floor(256 * x) for x in v)] = True
    out = []
    for q, a in good:
        if chosen(q):
            found = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(a) == len(b)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("n,dim,clusters", [(900, 6, 8), (300, 24, 1), (3, 4, 1), (0, 1, 1)])
def test_topk_equals_brute_force(spark, monkeypatch, n, dim, clusters):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 64)
    monkeypatch.setattr(covertree, "GROUP_ROWS", 8)
    rng = np.random.default_rng(n)
    centers = rng.standard_normal((clusters, dim)) * 3
    rows = [(i, [float(x) for x in np.round(centers[i % clusters] + rng.standard_normal(dim), 1)]) for i in range(n)]
    if n > 10:
        rows += [(rows[3][0], rows[3][1]), (n + 1, rows[0][1]), (n + 2, None), (n + 3, [1.0, None]), (n + 4, [float("nan")] * dim), (n + 5, []), (None, rows[0][1]), (1000000, [1.0, 2.0]), (1000010, [2.0, 1.0])]
        rows += [(2000 + k, rows[0][1]) for k in range(40)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out, scored = covertree.search_report(spark, df.withColumn("score", F.lit("x")).withColumn("block", F.lit(1)), "vec_id % 10 = 0")
    assert sorted(tuple(r) for r in out.collect()) == brute_topk(rows, 5, lambda q: q % 10 == 0)
    assert 0 <= scored <= 1 and (scored < 0.8 or clusters == 1)  # clusters leave room to prune


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.standard_normal((400, 3)) + 40 * c for c in rng.standard_normal((10, 3))])
    root = covertree.tree(x)

    def points(node):
        below = np.concatenate([points(c) for c in node.children]) if node.children else node.points
        assert np.sqrt(((x[below] - node.center) ** 2).sum(1)).max() <= node.radius + 1e-9
        return below

    assert sorted(points(root)) == list(range(len(x)))
    again = covertree.unflat(covertree.flat(root, x), x)

    def same(a, b):
        assert (a.center == b.center).all() and a.radius == b.radius and (a.points == b.points).all() and len(a.children) == len(b.children)
        for c, d in zip(a.children, b.children, strict=True):
            same(c, d)

    same(root, again)
    q = x[:20] + 0.01
    s = covertree.Search(q, np.arange(-20, 0), x, np.arange(len(x)), 5, np.full(20, -np.inf))
    s.run(covertree.tree(q), root)
    assert s.scored < 0.5 * len(q) * len(x)
    assert np.allclose(np.sort(q @ x.T, 1)[:, :-6:-1], s.score)


# 6
def test_quality_base(spark, docs, labels, nothing):
    rng = random.Random(2)
    words = ["a", "bb", "c#c", "é", "$%", "|", "x\ty"]
    texts = ["\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(12))) for _ in range(200)]
    texts += ["p q r s t u v w " * 4, None, "", LONG]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in quality.judge(table, labels.limit(0)).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], brute.quality_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and r.kept == (not r.base_failed)
    assert quality.judge(docs, labels).count() == len(DOCS) and quality.judge(nothing, labels).count() == 0


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(4)
    bounds = np.array([0, 3, 3, 8, 9])
    emit, trans = rng.standard_normal((9, 2)), rng.standard_normal((2, 2))
    got = quality.viterbi(emit, trans, bounds)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        path = lambda p: sum(emit[a + k, y] for k, y in enumerate(p)) + sum(trans[x, y] for x, y in zip(p, p[1:], strict=False))  # noqa: B023, E731
        if b > a:
            assert tuple(got[a:b]) == max(itertools.product((0, 1), repeat=b - a), key=path)


def line_corpus(rng):
    good = lambda: " ".join(rng.choice(["river", "stone", "walks", "under"]) for _ in range(12)) + "."
    bad = lambda: " | ".join(rng.choice(["HOME", "LOGIN", "CART", "HELP"]) for _ in range(12))
    rows = [(i, "\n".join((bad if i % 4 == 0 else good)() + f" {i}" for _ in range(5)), int(i % 4 != 0)) for i in range(200)]
    rows += [(200 + i, "\n".join([good(), good(), "Printed with kind leave.", good(), good()]), 1) for i in range(40)]
    return rows, good, bad


def test_field_labels_lines(spark):
    rng = random.Random(8)
    rows, good, bad = line_corpus(rng)
    mixed = [(1000, "\n".join([bad()] * 1 + [good() for _ in range(6)])), (1001, "\n".join([bad() + f" {k}" for k in range(6)] + [good()])), (1002, "\n".join([good(), good(), "Printed with kind leave.", good()]))]
    docs = spark.createDataFrame([r[:2] for r in rows] + mixed, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert got[1000].kept and not got[1001].kept and np.mean([got[i].kept == bool(y) for i, _, y in rows]) > 0.98
    # documents with lines of both kinds, in the sample and outside it
    assert (got[1000].content_lines, got[1001].content_lines, got[1002].content_lines) == (6, 1, 3)
    assert all(got[200 + i].content_lines == 4 for i in range(40))
    assert {r.doc_id for r in quality.keep(docs, labels).collect()} == {i for i, r in got.items() if r.kept}


def test_verdicts_equal_brute_force(monkeypatch):
    """Emissions by a plain reading of each line, the best of all label sequences, and the share of words."""
    import itertools

    rng = random.Random(4)
    rows, good, bad = line_corpus(rng)
    shapes = [good, bad, lambda: "", lambda: "Printed with kind leave.", lambda: "a a a b", lambda: "É 12 (x) !? " + good()]
    texts = [r[1] for r in rows] + ["\n".join(rng.choice(shapes)() for _ in range(rng.randrange(1, 9))) for _ in range(150)] + [None, " \n "]
    body, offsets = common.text_column(pa.array([r[1] for r in rows], pa.large_string()))
    made = quality.lines_of(body, offsets)
    field, _ = quality.learn(made, made["line_row"], np.array([r[2] for r in rows]))
    got = quality.figures(pa.array(texts, pa.large_string()), field)
    both = 0
    for k, t in enumerate(texts):
        lines = brute.line_evidence(t)
        emit = []
        for _, x, terms in lines:
            data = [term.translate(brute.LOWER).encode() for term in terms]
            place = [int(X.run_hashes(np.frombuffer(d, np.uint8), np.array([0]), np.array([len(d)]))[0] % quality.BUCKETS) for d in data]
            own = np.array(x) @ field.w
            emit.append((own[0], own[1] + (np.mean(field.v[place]) if place else 0.0)))
        path = lambda p: sum(emit[i][y] for i, y in enumerate(p)) + sum(field.trans[a, b] for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(lines)), key=path)
        content = sum(n for (n, *_), y in zip(lines, best, strict=True) if y)
        base = brute.quality_base(t)
        assert (got["n_lines"][k], got["content_lines"][k], got["content_words"][k]) == (len(lines), sum(best), content)
        assert got["kept"][k] == (base[0] >= 20 and 100 * base[4] <= 30 * base[0] and content >= 0.5 * base[0])
        both += 0 < sum(best) < len(best)
    assert both > 20


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the test tables are not here")
def test_documents_with_lines_of_both_kinds(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    got = quality.judge(read("documents"), read("labels")).agg(F.avg(F.expr("int(content_lines > 0 and content_lines < n_lines)")).alias("both")).first()
    assert got.both > 0.01


# 7
def test_cross_entropy_difference(spark, docs, nothing):
    target = spark.createDataFrame([(1, "the cat sat"), (2, "the cat ran"), (3, None)], "item_id long, text string")
    corpus = [(1, "the cat sat"), (2, "stock prices fell and fell"), (3, "stock prices rose"), (4, ""), (5, None), (6, "THE\ncat  ran home")]
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    size = 5
    from collections import Counter

    words = lambda t: brute.WORD.findall((t or "").translate(brute.LOWER))
    count = Counter(w for _, t in corpus for w in words(t))
    vocab = {w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:size]}
    pairs = lambda t: list(zip(["<s>"] + (u := [w if w in vocab else "?" for w in words(t)]), u + ["</s>"], strict=True))

    def model(texts):
        bi = Counter(p for t in texts for p in pairs(t))
        uni, ctx = Counter(), Counter()
        for (a, b), n in bi.items():
            uni[b] += n
            ctx[a] += n
        total = sum(uni.values())

        def loss(a, b):
            single = (uni[b] + 0.5) / (total + 0.5 * (size + 2))
            return -math.log(0.7 * bi[a, b] / ctx[a] + 0.3 * single if ctx[a] else single)

        return loss

    t, b = model(["the cat sat", "the cat ran", ""]), model([x for _, x in corpus])
    got = {r.doc_id: r for r in moore_lewis.score(spark, df, target, size).collect()}
    for i, text in corpus:
        p = pairs(text)
        assert got[i].n_tokens == len(p)
        assert got[i].target_loss == pytest.approx(sum(t(*x) for x in p) / len(p), abs=2e-6)
        assert got[i].score == pytest.approx(sum(t(*x) - b(*x) for x in p) / len(p), abs=2e-6)
    assert got[1].score < got[3].score
    assert moore_lewis.score(spark, docs, target).count() == len(DOCS) and moore_lewis.score(spark, nothing, target.limit(0)).count() == 0


def test_cross_entropy_does_not_hang_on_ranges(spark, monkeypatch):
    corpus = spark.createDataFrame([(k, f"the cat number {k % 5} sat on mat {k}") for k in range(60)], "doc_id long, text string")
    target = corpus.limit(7).withColumnRenamed("doc_id", "item_id")
    want = sorted(map(tuple, moore_lewis.score(spark, corpus, target).collect()))
    monkeypatch.setattr(moore_lewis, "RANGE_TOKENS", 20)
    monkeypatch.setattr(moore_lewis, "BLOCK_BYTES", 100)
    assert sorted(map(tuple, moore_lewis.score(spark, corpus, target).collect())) == want


def test_cross_entropy_writes_no_table_of_counts(spark, monkeypatch):
    corpus = [(1, "the cat sat\tThe"), (2, None), (3, "  "), (4, "a mat")]
    df, folders = spark.createDataFrame(corpus, "doc_id long, text string").repartition(2), []
    real = moore_lewis._written
    monkeypatch.setattr(moore_lewis, "_written", lambda rows, uri: folders.append(uri) or real(rows, uri))
    assert moore_lewis.score(spark, df, df.limit(1)).count() == 4
    assert [f.rsplit("/", 1)[1] for f in folders] == ["blocks"]
    assert moore_lewis.distinct_words(moore_lewis.blocks(df, True, None), 7) == 5
    monkeypatch.setattr(moore_lewis, "_HELD_WORDS", 1)
    monkeypatch.setattr(moore_lewis, "BLOCK_BYTES", 1)
    assert moore_lewis.distinct_words(moore_lewis.blocks(df, True, None), 7) == 5
    monkeypatch.undo()
    assert moore_lewis.BLOCK_BYTES >= 4 << 20  # a pair that recurs in a block is asked for once


def test_cross_entropy_tells_rare_words_apart(spark):
    frequent = " ".join(f"f{k} f{k}" for k in range(1500))
    target = spark.createDataFrame([(1, "quark gluon quark gluon")], "item_id long, text string")
    corpus = [(1, frequent), (2, "quark gluon"), (3, "plumb gusset"), (4, None)]
    got = {r.doc_id: r for r in moore_lewis.score(spark, spark.createDataFrame(corpus, "doc_id long, text string").repartition(3), target).collect()}
    size, total = 1500 + 4 + 2, 5  # one text of the target: begin, four words, end
    single = lambda n: (n + 0.5) / (total + 0.5 * size)
    want = [0.7 + 0.3 * single(2), 0.7 + 0.3 * single(2), 0.35 + 0.3 * single(1)]  # <s> quark, quark gluon, gluon </s>
    assert got[2].target_loss == pytest.approx(-sum(map(math.log, want)) / 3, abs=2e-6)
    want = [0.3 * single(0), single(0), single(1)]
    assert got[3].target_loss == pytest.approx(-sum(map(math.log, want)) / 3, abs=2e-6)
    assert got[2].score < got[3].score and got[2].background_loss == got[3].background_loss


# 8
def check_packing(rows, texts, size, tokenizer, end):
    ids = {}
    for k, t in texts:
        ids.setdefault(k, []).append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4"))
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(r.length for r in rows) == total
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
    assert sorted(seqs) == list(range(len(seqs)))
    for k, own in seqs.items():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == size if k < total // size else at.bit_count() == 1
    return seqs


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0}, {"c": 1.0}])
def test_packing(spark, docs, nothing, weights):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = packing.pack(spark, docs, path, size=256, weights=weights, burst=16).collect()
    check_packing(rows, [r[:2] for r in DOCS], 256, t, 2)
    assert packing.pack(spark, nothing, path).count() == 0


def test_proportions_hold_in_every_sequence():
    plan = packing.plan({"x": 70_000, "y": 20_000, "z": 10_000, None: 1}, None, 4096, 1)
    step = np.diff([plan.sent(r) for r in range(21)], axis=0)
    share = {n: step[:, k] for k, n in enumerate(plan.names)}
    assert (np.abs(share["x"] - 0.7 * 4096) <= 1.1).all() and (np.abs(share["z"] - 0.1 * 4096) <= 1.1).all()
    # deficits are carried: the sums stay within a token of the target
    assert (np.abs(np.cumsum(share["y"]) - 0.2 * 4096 * np.arange(1, 21)) <= 2).all()
    assert packing.tails(13) == [8, 4, 1]


@pytest.mark.parametrize("weights", [None, {"x": 1.0, "y": 1.0, "z": 2.0, "w": 0.5}])
def test_rounds_equal_a_queue_by_queue_loop(weights):
    """A plain deficit round-robin, one round after another, sends the same bursts in the same rounds."""
    tokens_, size, burst = {"x": 9000, "y": 700, "z": 2511, "w": 1}, 512, 32
    p = packing.plan(tokens_, weights, size, burst)
    want, earned, sent, r = weights or tokens_, dict.fromkeys(tokens_, 0.0), dict.fromkeys(tokens_, 0), 0
    while any(sent[s] < tokens_[s] for s in tokens_):
        left = float(size)
        while left > 1e-6 and (open_ := [s for s in tokens_ if earned[s] < tokens_[s] - 1e-6]):
            unit = sum(want[s] for s in open_)
            step = min(left / unit, *((tokens_[s] - earned[s]) / want[s] for s in open_))
            for s in open_:
                earned[s] += step * want[s]
            left -= step * unit
        for s in tokens_:
            due = earned[s] + 1e-6
            sent[s] = tokens_[s] if due >= tokens_[s] else int(due // burst) * burst
        r += 1
        assert dict(zip(p.names, p.sent(r).tolist(), strict=True)) == sent
    assert r == p.rounds


def test_packing_many_sources(spark):
    rows = [(i, f"word{i} and more of it " * (1 + i % 5), f"s{i % 700}") for i in range(2100)]
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), path).collect()
    check_packing(got, [r[:2] for r in rows], 4096, Tokenizer.from_file(path), 2)
    assert len(got) < 2 * len(rows)
    big = packing.plan({f"s{k}": 1000 + k for k in range(100_000)}, None, 4096)
    assert sum(x.nbytes for x in (big.tokens, big.weight, big.times, big.spent)) < 4 << 20 and int(big.sent(big.rounds).sum()) == int(big.tokens.sum())


# 9
def test_mixing(spark, docs, nothing):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") < 3000, "big").otherwise("small").alias("source"))
    out = mixing.mix(spark, rows, {"big": 1.0, "small": 1.0})
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert n["big"] == pytest.approx(2000, rel=0.1) and n["small"] == pytest.approx(2000, rel=0.1)
    per = out.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("m"), F.max("n_copies").alias("c")).where("n <> m or n <> c")
    assert per.isEmpty()
    again = mixing.mix(spark, rows.repartition(7), {"small": 2.0, "big": 2.0})
    assert out.exceptAll(again).isEmpty()
    keys = [r.shuffle_key for r in out.coalesce(1).collect()]
    assert keys == sorted(keys)
    edge = mixing.mix(spark, docs)
    assert edge.columns == [*[c for c in docs.columns if c not in ("rate", "copy")], "rate", "n_copies", "copy", "shuffle_key"]
    assert edge.where("n_copies < 1 or copy > n_copies").isEmpty()
    small = edge.where("doc_id = 7").agg(F.max("rate").alias("r"), F.max("n_copies").alias("n")).first()
    assert small.r > 1000 and abs(small.n - small.r) < 6 * small.r**0.5  # a rare source is repeated as often as its weight asks
    assert mixing.mix(spark, docs, {"a": 0.0}).where("source is not null").isEmpty()
    assert mixing.mix(spark, nothing).count() == 0
    s = mixing.steps(3.0)
    assert s[0] == pytest.approx(math.exp(-3)) and s[-1] == pytest.approx(1.0) and s == sorted(s)


def test_mixing_sql(spark):
    import duckdb

    rows = [*[(i, f"text {i} " + "x" * 2000, "en", "big", i) for i in range(60)], *[(100 + i, "rare text", "de", None, i) for i in range(9)], (200, "tiny", "fr", "small", 4), (None, None, None, "small", None), (201, None, None, "void", 0)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    got = mixing.mix(spark, spark.createDataFrame(rows, kind)).withColumn("rate", F.round("rate", 9))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    names = ", ".join(got.columns)
    key = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    want = con.execute(f"SELECT {names} FROM ({mixing.SQL})").fetchall()
    assert sorted(map(key, map(tuple, got.collect())), key=repr) == sorted(map(key, want), key=repr)
    assert max(r[names.split(", ").index("n_copies")] for r in want) > 399 and any(r[names.split(", ").index("source")] is None for r in want)


# 10
PAGES = [
    (5, "http://a.example/x y", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"), (9, None, None), (7, "", ""), (1, "http://c.example/\n", "é" * 50_000),
    (3, "http://d.example/", "<p>\r\n\r\n</p>\n\n"), (3, "http://d.example/", "<p>\r\n\r\n</p>\n\n"), (None, "http://e.example/", "<p>one</p>"), (None, "http://f.example/", "alone"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_arc_to_warc(spark, least):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("x")).repartition(3)
    got = sorted((tuple(r) for r in warc.round_trip(spark, df, least).collect()), key=repr)
    import base64
    import hashlib

    want, first = [], {}
    for i, _, h in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if digest in first and len(data) >= least:
            want.append((i, len(data), digest, "revisit", first[digest]))
        else:
            first[digest] = i
            want.append((i, len(data), digest, "response", None))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(spark, df.limit(0)).count() == 0


BLOCK = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nbody\n\nhttp://not.a.header 1 2 3 4\n"


def arc_parts(version, blocks):
    parts = [warc.arc_version_block(version, "n.arc")]
    return parts + [warc.arc_record(version, f"http://u/{k}", "20200102030405", b, "-", 0, "n.arc") for k, b in enumerate(blocks)]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_and_lengths(version):
    data = b"".join(map(warc._member, arc_parts(version, [BLOCK])))
    (_, head, _), (_, fields, found) = warc.parse_arc(io.BytesIO(data))
    assert found == BLOCK and fields["Archive-date"] == "20200102030405" and len(head) == len(warc.ARC_FIELDS[version].split(" "))
    headers, out = next(warc.parse_warc(io.BytesIO(warc._member(warc.convert_record(fields, BLOCK, None)))))
    assert headers["WARC-Date"] == "2020-01-02T03:04:05Z" and headers["WARC-Type"] == "response" and out == BLOCK and headers["WARC-Record-ID"].startswith("<urn:uuid:")
    assert warc.warc_date("2020") == "2020-01-01T00:00:00Z" and warc.warc_date("20200315") == "2020-03-15T00:00:00Z"
    first, record = arc_parts(version, [BLOCK])
    longer, shorter = (first + record.replace(f" {len(BLOCK)}\n".encode(), f" {len(BLOCK) + d}\n".encode()) for d in (5, -5))
    for bad in (first + record[:-9], longer, shorter, first + b"\nhttp://u/ 0 x\n", b"filedesc://x 0 0 text/plain 9\n3 0 x\nURL\n\n"):
        for wrapped in (bad, warc._member(bad)):
            with pytest.raises(ValueError):
                list(warc.parse_arc(io.BytesIO(wrapped)))
    with pytest.raises(ValueError):
        list(warc.parse_arc(io.BytesIO(warc._member(first + record)[:-20])))
    assert list(warc.parse_arc(io.BytesIO(b""))) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=6), st.data(), st.sampled_from([1, 2]), st.sampled_from([b"", b"\n", b"\r\n"]))
def test_arcs_of_any_layout(blocks, data, version, end):
    """Uncompressed, one member, a record a member, several a member, or members that end anywhere: the same records."""
    whole = b"".join(arc_parts(version, blocks)) + end
    cuts = sorted(data.draw(st.lists(st.integers(0, len(whole)), max_size=8)))
    pieces = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)], strict=True)]
    for raw in (whole, warc._member(whole), b"".join(map(warc._member, pieces))):
        for chunk in (7, 1 << 20):
            class Source(io.BytesIO):
                def read(self, n=-1, chunk=chunk):
                    return super().read(min(n, chunk) if n >= 0 else n)

            got = list(warc.parse_arc(Source(raw)))
            assert [b for _, _, b in got[1:]] == blocks and [f["URL"] for _, f, _ in got[1:]] == [f"http://u/{k}" for k in range(len(blocks))]


def test_long_blocks_are_read_in_parts():
    block = os.urandom(1 << 16) * 80
    whole = b"".join(arc_parts(1, [block, b"x"]))
    assert [len(b) for *_, b in warc.parse_arc(io.BytesIO(warc._member(whole)))][1:] == [len(block), 1]
    with pytest.raises(ValueError):
        list(warc.parse_arc(io.BytesIO(b"x" * (warc.MOST_HEADER + (2 << 20)))))
