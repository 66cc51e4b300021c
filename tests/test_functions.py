"""Rules of text, dates and statistics on small values."""

import math

import pytest
from pyspark.sql import functions as F

from quillmark.functions import dates as D
from quillmark.functions import stats as S
from quillmark.functions import structures as N
from quillmark.functions import text as T


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def lit(x):
    return F.lit(x)


def test_body_hash_ignores_spacing(spark):
    a, b = one(spark, a=T.body_hash(lit(" x  y\n")), b=T.body_hash(lit("x y")))
    assert a == b


@pytest.mark.parametrize(
    "name,key",
    [("Alphabet Inc. (Class A)", "alphabet"), ("Estée Lauder Companies", "estee lauder"), ("Amazon.com, Inc.", "amazon"), ("The Group", ""), ("AT&T", "at&t")],
)
def test_normalize_name(spark, name, key):
    assert one(spark, k=T.normalize_name(lit(name))).k == key


def test_keys(spark):
    r = one(
        spark, s=T.squash_initials(lit("j b hunt")), f=T.form_key(lit("Take-Two, Inc")), t=T.title_key(lit("A -- Title!")), u=T.slug_of(lit("https://x.org/a/b-c.html?q=1#z")),
        c=T.company_name(lit("Acme (Class B)")), p=T.spreadsheet_safe(lit("=1+1")), q=T.spreadsheet_safe(lit("a=1")),
    )
    assert tuple(r) == ("jb hunt", "take two inc", "a title", "b-c", "Acme", "'=1+1", "a=1")


def test_sentences_and_segments(spark):
    r = one(spark, s=T.sentences(lit('One. Two? "Three" etc. four.')), g=T.segments(lit("short\n" + "x" * 25 + "\n\n  " + "y" * 20 + " ")), w=T.word_chunks(lit("a b c d e"), 2), e=T.word_chunks(lit(""), 2))
    assert r.s == ["One.", "Two?", '"Three" etc. four.']
    assert r.g == ["x" * 25, "y" * 20]
    assert r.w == ["a b", "c d", "e"] and r.e == []


def test_scopes(spark):
    scope = lambda text: one(spark, s=T.keyword_scope(lit(text))).s
    assert scope("inflation and GDP; stocks") == "economy"
    assert scope("stocks rally, the fed and inflation") == "economy"  # a tie
    assert scope("stocks and futures") == "market"
    assert scope("nothing, index") == "no_company"
    r = one(
        spark, a=T.gold_scope(lit("Unrelated"), lit("")), b=T.gold_scope(lit("x"), lit("the economy")), c=T.gold_scope(lit("x"), lit("industry")), d=T.gold_scope(lit("miscellany"), lit("")),
        e=T.gold_scope(lit("other"), lit("")), f=T.gold_scope(lit("x"), lit("")),
    )
    assert tuple(r) == ("unrelated", "market_economy", "sector", "multi", "investing_general", "single")


def test_dates(spark):
    r = one(
        spark, a=D.crawl_date(lit("2026-08-12T22:19:20.655964+02:00")), b=D.crawl_date(lit("2026-08-12T22:19:20")), c=D.pub_date(lit("Mon, 03 Jan 2022 10:00:00 +0100")),
        d=D.pub_date(lit("2022-01-03")), e=D.pub_date(lit("1980-01-01")), f=D.pub_date(lit("rubbish")), g=D.published_after_crawl(lit("2022-01-03T00:00:01Z"), lit("2022-01-02T00:00:00Z")),
    )
    assert tuple(r) == ("2026-08-12T20:19:20Z", "", "2022-01-03T09:00:00Z", "2022-01-03T00:00:00Z", "", "", True)


def test_period_grid_follows_the_clock(spark):
    cut = lambda k: one(spark, c=D.stamp(D.cut_utc(lit(k)))).c
    assert cut(0) == "2022-01-03T20:00:00Z"
    assert cut(8) == "2022-06-20T19:00:00Z"
    at = lambda s: one(spark, p=D.period_of(F.to_timestamp(lit(s)))).p
    assert [at(s) for s in ("2021-01-01 00:00:00", "2022-01-03 20:00:00", "2022-01-03 20:00:01", "2022-01-24 20:00:00", "2022-06-20 19:00:00", "2022-06-20 19:00:01")] == [0, 0, 1, 1, 8, 9]
    last = lambda s: one(spark, p=D.last_index(F.to_timestamp(lit(s)))).p
    assert [last(s) for s in ("2022-01-03 19:59:59", "2022-01-03 20:00:00", "2022-06-20 18:59:59", "2022-06-20 19:00:00")] == [-1, 0, 7, 8]
    assert one(spark, a=D.index_of(lit("2022-01-24").cast("date")), b=D.index_of(lit("2022-01-25").cast("date"))) == (1, None)


def test_statistics(spark):
    low, high = S.wilson(lit(8), lit(10))
    r = one(spark, low=low, high=high, v=S.judge(low, high, 0.4), n=S.wilson(lit(0), lit(0))[0])
    assert r.low == pytest.approx(0.4901, abs=1e-3) and r.high == pytest.approx(0.9433, abs=1e-3) and r.v == "pass" and r.n is None
    assert S.sign_test(0, 5) == pytest.approx(2 / 32) and S.mcnemar(3, 3) == 1.0
    assert S.allocate({1: 2, 2: 10, 3: 10}, 12) == {1: 2, 2: 5, 3: 5}
    a = F.array(*map(lit, [1, 2, 3, 4, 5]))
    assert tuple(one(spark, a=S.at_quantile(a, 0.5), b=S.at_quantile(a, 0.5, "nearest"), c=S.at_quantile(a, 90, "percent"), d=S.at_quantile(F.array().cast("array<int>"), 0.5))) == (3, 3, 5, None)


def test_structures(spark):
    scores = F.create_map(*[lit(x) for x in ("a", 0.5, "b", 0.5, "c", 0.1)])
    r = one(
        spark, p=N.predict_set(scores, 0.2, 0.5), q=N.set_by_thresholds(scores, {"a": 0.9, "b": 0.9, "c": 0.9}), c=N.class_scores(lit('{"x": 1, "_n": 3}')), l=N.parse_labels(lit("a, b;uncertain,zz,a"), ["a", "b"]),
        f=N.first_object(lit('so: {"k": 3} ok'), "k int").k, g=N.gate(scores, ["a"], lit(""), 0.01).status, h=N.gate(scores, ["a"], lit("a"), 0.01).status,
    )
    assert r.p == ["a", "b"] and r.q == ["a"] and r.c == {"x": 1.0} and r.l == ["a", "b"] and r.f == 3 and r.g == "out_of_scope" and r.h == "assigned"
    assert not math.isnan(1.0)


def test_text_rules_read_long_stretches_once(spark):
    import time

    odd = ["", " ", "\n", "a\n", " \u2003a \u00a0\n", "Sign up for x. y\n Click here", "é😀 disclosure: 😀.\nRelated Tickers", ".click here..", "x" * 19 + "\n" + "y" * 19 + " 😀\t\n\n\r" + "z" * 20, "a" + " " * 40 + "b", None]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    t = F.col("t")
    plain = {
        "b": F.regexp_replace(t, T.BOILERPLATE, " "), "s": F.regexp_replace(t, f"^{T.SPACE}+|{T.SPACE}+$", ""), "c": F.trim(F.regexp_replace(t, T.SPACE + "+", " ")),
        "g": F.filter(F.transform(F.split(t, "\n+"), lambda x: F.regexp_replace(x, f"^{T.SPACE}+|{T.SPACE}+$", "")), lambda x: F.length(x) >= 20),
    }
    got = {"b": T.strip_boilerplate(t), "s": T.strip(t), "c": T.collapse(t), "g": T.segments(t)}
    for r in df.select(*[c.alias(k + "0") for k, c in plain.items()], *[c.alias(k + "1") for k, c in got.items()]).collect():
        assert [r[k + "0"] for k in plain] == [r[k + "1"] for k in got]
    n, began = 60_000, time.monotonic()
    long = spark.createDataFrame([("ab " * (n // 3),), ("a" + " " * n + "b",), ("😀b" * n,)], "t string")
    assert long.select(F.sum(F.length(got["b"])), F.sum(F.length(got["s"])), F.sum(F.size(got["g"]))).first()[0] == n + n + 2 + 2 * n
    assert time.monotonic() - began < 10
