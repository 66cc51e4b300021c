"""Rows as they are read and written."""

import pytest
from pyspark.sql import functions as F

from quillmark.operators import matching, records
from quillmark.operators.relational import Refused


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_subject_rules(spark):
    names = lambda t, c, k: one(spark, records.names_subject(F.lit(t), F.lit(c), F.lit(k)))
    assert names("Shares of aapl rose", None, "AAPL") and not names("aaplx rose", None, "AAPL") and names("The Meta Platforms, Inc. plan", "Meta Platforms Inc.", None)
    assert not names("text", "", "") and not names("text", None, None) and names("BRK.B fell", None, "BRK.B")
    assert one(spark, records.named_in(F.array(F.lit("A")), F.array(F.lit("B"), F.lit("A")))) and not one(spark, records.named_in(F.array(F.lit("A")), F.array().cast("array<string>")))


def test_paragraphs_and_headers(spark):
    body = "Opening words of a body here. Apple — The company rose today and more.\n\n— a dash paragraph of some length\nshort"
    assert one(spark, records.paragraphs(F.lit(body))) == ["Opening words of a body here.", "Apple — The company rose today and more."]
    head = lambda t: one(spark, records.header_name(F.lit(t)))
    assert head("Wendy's (WEN) — Sales fell") == "Wendy's (WEN)" and head("Apple - rose") == "Apple" and head("no header") is None
    assert head("One Two Three Four Five Six Seven Eight - text") is None


def test_direct_mentions(spark):
    d = matching.Dictionary([("GPS", "Gap"), ("META", "Meta Platforms"), ("C", "Citigroup Global Markets")])
    rows = spark.createDataFrame([(1, "The gap widened. Gap fell, and Gap rose."), (2, "Citigroup Global Markets or its affiliates own it"), (3, "He is long META"), (4, None)], "id long, t string")
    assert {(r.id, r.entity, r.n) for r in records.direct_mentions(rows, "id", "t", d).collect()} == {(1, "GPS", 2)}


def test_texts_and_decisions_of_companies(spark):
    rows = [(1, 0, "A rose.", ["A"], None, 0.0), (1, 1, "It grew.", [], "A", 0.9), (1, 2, "B fell.", ["B"], None, 0.0), (1, 3, "Maybe.", [], "B", 0.2)]
    df = spark.createDataFrame(rows, "body long, position int, sentence string, mentions array<string>, chosen string, score double")
    got = {r.ticker: r.text for r in records.company_texts(df, "body", ["position"], "mentions", "chosen", "score").collect()}
    assert got == {"A": "A rose. It grew.", "B": "B fell."}
    candidates, names = spark.createDataFrame([(1, "A"), (1, "B"), (1, "Z")], "body long, ticker string"), spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "ticker string, name string")
    found = sorted((r.position, r.candidate, r.context, r.recent) for r in records.run_time_decisions(df, candidates, names, "body").collect())
    assert found == [(1, "A", "A rose.", "A"), (1, "B", "A rose.", "A"), (3, "A", "B fell.", "B"), (3, "B", "B fell.", "B")]


def test_replies_and_scores(spark):
    reply = 'Here: {"claims": [{"text": "a", "status": "supported"}, {"text": "b", "status": "unsupported"}], "main_kept": true}'
    v = spark.range(1).select(records.verdict(F.lit(reply), "summary").alias("v")).select("v.main_kept", records.claim_counts(F.col("v.claims")).alias("c")).first()
    assert v.main_kept and tuple(v.c) == (1, 0, 1, 2) and one(spark, records.verdict(F.lit("none"), "category")) is None
    assert one(spark, records.decoded_scores(F.lit('{"a": 0.5}'))) == {"a": 0.5} and one(spark, records.decoded_scores(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="scores are no object"):
        one(spark, records.decoded_scores(F.lit("[1")))
    rows = spark.createDataFrame([(1.0, 2.0), (0.0, 2.0), (None, 5.0)], "v double, w double")
    assert rows.agg(records.weighted_mean("v", "w").alias("m")).first().m == 0.5
    rates = spark.createDataFrame([(1.0, None), (0.0, float("nan"))], "p double, r double")
    assert records.selection_score(rates, ["p", "r"]).first().score == 0.25


def test_decisions():
    verdicts = {"score": "better", "recall": "not decided", "precision": "better"}
    assert records.pin_decision(verdicts, "score", ["recall", "precision"])[0] and not records.pin_decision({**verdicts, "recall": "undefined"}, "score", ["recall"])[0]
    assert not records.pin_decision({**verdicts, "score": "not decided"}, "score", [])[0]
    assert records.at_most(0.2, 0.3, "row") and not records.at_most(0.4, 0.3, "row")
    for none in (None, float("nan")):
        with pytest.raises(Refused):
            records.at_most(none, 0.3, "row")


def test_runs_and_deletes(spark):
    runs = spark.createDataFrame([(3, "a", None)], "id long, stage string, status string")
    number, more = records.next_run(runs, {"stage": "b"})
    assert number == 4 and more.count() == 2 and records.next_run(runs.limit(0), {"stage": "b"})[0] == 1
    done = records.updated(more, "id", 4, {"status": "done"})
    assert {(r.id, r.status) for r in done.collect()} == {(3, None), (4, "done")} and done.schema == more.schema
    with pytest.raises(Refused):
        records.updated(more, "id", 9, {"status": "x"})
    periods = spark.createDataFrame([("2022-01-03", "r1"), ("2022-01-24", "r1"), ("2022-01-24", "r2"), (None, "r1")], "period_end string, model_revision string")
    assert records.before(periods, "period_end", "2022-01-10").count() == 2 and records.before(periods, "period_end", "2022-01-10", "r1").count() == 3
    subs = spark.createDataFrame([(1, "old"), (2, "kept")], "id long, model_revision string")
    items = spark.createDataFrame([("1",), ("2",), ("1",), ("x",)], "item_id string")
    assert [tuple(r) for r in records.pruned_references(items, "item_id", subs, "id", ["kept"]).collect()] == [("old", 2)]


def test_reviews(spark, tmp_path):
    rows = spark.createDataFrame([(1, "t", "x"), (2, "u", "y")], "article_id long, title string, text string")
    spanish = spark.createDataFrame([(1, "eins")], "article_id long, t string")
    out = records.with_translations(rows, "article_id", spanish, {"spanish_title": "t"}, "title")
    assert out.columns == ["article_id", "title", "spanish_title", "text"] and {r.article_id: r.spanish_title for r in out.collect()} == {1: "eins", 2: ""}
    assert records.format_problems(out, out.columns, ["spanish_title"]) == ["spanish_title is empty for 1 rows"]
    with pytest.raises(Refused):
        records.require_format(out, "f", ["a"], [])
    assert records.format_problems(out.limit(0), out.columns, []) == ["no rows"]
    a = rows.withColumn("p", F.col("article_id"))
    b = spark.createDataFrame([(1, 1, "k"), (2, 2, "l")], "article_id long, p long, label string")
    assert {(r.article_id, r.label) for r in records.zipped(a, b, "article_id", "p").collect()} == {(1, "k"), (2, "l")}
    for other in (b.where("p = 1"), b.withColumn("p", 3 - F.col("p"))):
        with pytest.raises(Refused):
            records.zipped(a, other, "article_id", "p")
    review, key = rows.withColumn("tag", F.lit("")), rows.select("article_id")
    records.write_review(review, key, str(tmp_path), ("review.csv", "key.csv"), "tag")
    records.write_review(review.withColumn("tag", F.lit("yes")), key, str(tmp_path), ("review.csv", "key.csv"), "tag")
    assert spark.read.option("header", True).csv(str(tmp_path / "review.csv")).where("tag = 'yes'").count() == 2
    with pytest.raises(Refused, match="holds 2 tags"):
        records.write_review(review, key, str(tmp_path), ("review.csv", "key.csv"), "tag")
    assert records.relation({"a": rows}, "a") is rows
    with pytest.raises(Refused):
        records.relation({"a": rows}, "b; drop")


def test_identities(spark, tmp_path):
    train = spark.createDataFrame([(1, "a"), (2, "b")], "k long, l string")
    base = records.training_identity(train, train, "k", "l", {"rate": 1})
    assert base == records.training_identity(train.orderBy(F.desc("k")), train, "k", "l", {"rate": 1}) != records.training_identity(train, train, "k", "l", {"rate": 2})
    assert base != records.training_identity(train.withColumn("l", F.lit("a")), train, "k", "l", {"rate": 1})
    (tmp_path / "config.json").write_text("{}")
    (tmp_path / "metrics.json").write_text("1")
    first = records.folder_identity(spark, str(tmp_path), ["config.json"], ["metrics.json"])
    (tmp_path / "metrics.json").write_text("2")
    assert first == records.folder_identity(spark, str(tmp_path), ["config.json"], ["metrics.json"]) and len(first) == 16
    with pytest.raises(Refused):
        records.folder_identity(spark, str(tmp_path), ["weights"])
    nodes = records.node_rows(spark.createDataFrame([("E", "Oil & Gas"), ("E", "Oil & Gas"), ("F", "Banks"), ("F", "")], "gics_sector string, gics_sub_industry string"), spark.createDataFrame([("10", "oil and gas")], "code string, name string"))
    assert {tuple(r) for r in nodes.collect()} == {("E", "Oil & Gas", "10"), ("F", "Banks", "")}
    assert records.missing_years(spark.createDataFrame([("2020-01",), (None,), ("x",)], "d string"), "d").first().without_year == 2
    assert one(spark, records.now_text())[4] == "-" and len(one(spark, records.now_text())) == 20
