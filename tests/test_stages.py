"""Chunked scoring, work of the steps, commands and the service."""

import io
import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillmark.operators import attribution, commands, scorers, stages
from quillmark.operators.relational import Refused
from quillmark.sources import tables

TEXT = "Stone walks under. River light! " * 40


def test_chunk_mean(spark):
    rows = spark.createDataFrame([(1, TEXT + "good good."), (2, "good. bad."), (3, None), (4, "")], "id long, t string")
    make = lambda: scorers.LexicalClasses({"good": ["good"], "bad": ["bad"]})
    got = {r.id: r for r in stages.chunk_mean(rows, "id", "t", make, ["good", "bad"], 50).collect()}
    spans = attribution.packed(TEXT + "good good.", 50, attribution.word_tokens)
    want = [make()(pd.DataFrame({"text": [(TEXT + "good good.")[a:b]]}))[0]["good"] for a, b in spans]
    assert got[1].chunks == len(spans) > 3 and got[1].scores["good"] == pytest.approx(sum(want) / len(want)) and got[1].label == "good"
    assert got[2].label == "good" and got[2].scores == {"good": 0.5, "bad": 0.5} and 3 not in got and 4 not in got


class Capitals:
    def __call__(self, batch):
        found = [[{"entity_type": "CAP", "start": m.start(), "end": m.end(), "score": 0.5} for m in attribution.re.finditer(r"\b[A-Z]\w*", t or "")] for t in batch["text"]]
        return pd.Series(found, index=batch.index)


def test_chunk_spans(spark):
    rows = spark.createDataFrame([(1, "Stone walks. River light. A tail."), (2, None)], "id long, t string")
    got = sorted((r.id, r.text, r.start, r.end) for r in stages.chunk_spans(rows, "id", "t", Capitals, 4).collect())
    assert got == [(1, "River", 13, 18), (1, "Stone", 0, 5)]


class FirstWords:
    def __call__(self, batch):
        return pd.Series([" ".join(t.split()[:6]) + "." for t in batch["text"]], index=batch.index)


def test_reduced(spark):
    rows = spark.createDataFrame([(1, TEXT), (2, "Short one."), (3, ""), (4, None)], "id long, t string")
    got = {r.id: (r.summary, r.chunks, r.passes) for r in stages.reduced(rows, "id", "t", FirstWords, 20).collect()}
    texts, passes, first = TEXT, 0, None
    while True:
        spans = attribution.packed(texts, 20, attribution.word_tokens)
        first = first or len(spans)
        texts = " ".join(" ".join(texts[a:b].split()[:6]) + "." for a, b in spans)
        passes += 1
        if len(spans) == 1 or passes == stages.MOST_PASSES:
            break
    assert got[1] == (texts, first, passes) and passes > 1 and got[2] == ("Short one..", 1, 1) and got[3] == got[4] == ("", 0, 0)
    forced = stages.reduced(rows.where("id = 1"), "id", "t", FirstWords, 20, passes=1).first()
    assert forced.passes == 1 and len(forced.summary) > len(texts)


def test_pairs_and_companies(spark):
    spans = spark.createDataFrame([(1, "Apple Inc."), (1, "Apple"), (1, "Nobody"), (2, "Google")], "id long, text string")
    names = spark.createDataFrame([("apple", "AAPL"), ("google", "GOOG")], "key string, ticker string")
    scores = spark.createDataFrame([(1, "AAPL", 0.9)], "id long, ticker string, relevance double")
    got = {(r.id, r.ticker): (r.mentions, r.is_main) for r in stages.companies_of(spans, "id", names, scores, 0.5).collect()}
    assert got == {(1, "AAPL"): (2, 1), (2, "GOOG"): (1, 0)}
    universe = spark.createDataFrame([("AAPL", "Apple"), ("GOOG", "Google")], "ticker string, company string")
    items = spark.createDataFrame([("body", "a", ["GOOG", "ZZZ", "AAPL"]), ("body", "b", []), ("body", "c", ["X", "Y"])], "item_kind string, item_id string, tickers array<string>")
    known = {r.item_id: ([k.ticker for k in r.known], r.dropped) for r in stages.known_pairs(items, ["item_kind", "item_id"], "tickers", universe).collect()}
    assert known == {"a": (["GOOG", "AAPL"], ["ZZZ"]), "b": ([], []), "c": ([], ["X", "Y"])}
    row = spark.range(1).select(stages.pair_text(F.lit("Two words"), F.lit("a b c d e"), 5).alias("a"), stages.pair_text(F.lit("w " * 9), F.lit("a b"), 5).alias("b")).first()
    assert row.a == "a b c" and row.b == ""


def test_pending_work(spark):
    summaries = spark.createDataFrame([("body", "h1", "s1"), ("body", "h2", "s2"), ("sub_news", "7", "s7"), ("sub_news", "8", "s8")], "item_kind string, item_id string, summary_text string")
    scopes = spark.createDataFrame([("h1", "single"), ("h2", "multi")], "body_hash string, scope string")
    subs = spark.createDataFrame([(7, "h2"), (8, "h2")], "id long, body_hash string")
    done = spark.createDataFrame([("sub_news", "8")], "item_kind string, item_id string")
    got = [tuple(r) for r in stages.pending_texts(summaries, scopes, subs, done).collect()]
    assert got == [("body", "h1", "h1", "s1"), ("sub_news", "7", "h2", "s7")]
    assert [r.item_id for r in stages.pending_texts(summaries, scopes, subs, done, limit=1).collect()] == ["h1"]
    items = spark.createDataFrame([("body", "h1"), ("sub_news", "7"), ("sub_news", "9")], "item_kind string, item_id string")
    assert {r.item_id: r.body_hash for r in stages.hashes_of_items(items, subs).collect()} == {"h1": "h1", "7": "h2", "9": None}
    companies = spark.createDataFrame([("body", "h1", "B", 0.9, 1), ("body", "h1", "A", 0.8, 1), ("body", "h1", "C", 0.1, 0)], "item_kind string, item_id string, ticker string, relevance_score double, is_main int")
    assert [[p.ticker for p in r.pairs] for r in stages.pending_scored_pairs(companies, summaries, done).collect()] == [["A", "B"]]


def test_fact_rows(spark):
    articles = spark.createDataFrame([("h1", "f", "p", "title")], "body_hash string, fetched_at string, pub_date string, title string")
    bodies = spark.createDataFrame([("h1", "text", "summary", "Energy")], "body_hash string, text string, text_source string, sector string")
    (r,) = stages.sector_rows(bodies, articles, "rev", {"scope": "s1"}, "now").collect()
    assert (r.item_id, r.ticker, r.category, r.sentiment_score, r.title, r.inputs) == ("h1", "", "", None, "title", {"scope": "s1"})
    assert stages.sector_rows(bodies, articles, "rev", {}, "now").schema.names == tables.schema("news_snapshot").names
    out = stages.outcomes(spark.createDataFrame([("done", True), ("review", None)], "status string, cut boolean"), {"done": F.col("status") == "done", "truncated": F.col("cut")}).first()
    assert tuple(out) == (2, 1, 1)


def test_options():
    assert commands.results_folder(None, {}) == commands.DEFAULT_RESULTS and commands.results_folder("x", {commands.RESULTS_ENV: "y"}) == "x" and commands.source_folder(None, {}) is None
    argv = commands.to_argv("summary", {"limit": "5", "items": "single", "status": True, "max-calls": None})
    assert argv == ["--step", "summary", "--limit", "5", "--items", "single", "--status"] and commands.from_argv(argv) == ("summary", {"limit": 5, "items": "single", "status": True})
    assert commands.from_argv(["--step=scope", "--limit=2"]) == ("scope", {"limit": 2})
    for step, options in (("scope", {"items": "single"}), ("nope", {}), ("scope", {"limit": 0}), ("scope", {"limit": "x"}), ("cut", {"reading": "words"}), ("scope", {"strange": 1}), ("scope", {"fetch": True}), ("scope", {"status": "yes"})):
        with pytest.raises(Refused):
            commands.checked(step, options)
    with pytest.raises(Refused):
        commands.checked("scope", {"reset": True}, request=True)
    for bad in (["--step"], ["--rese", "--step", "scope"], ["--step", "scope", "--step", "cut"], ["scope"], [], ["--step", "scope", "--status=1"]):
        with pytest.raises(Refused):
            commands.from_argv(bad)


def test_service():
    gate, seen = {"open": False}, []

    def slow(options):
        while not gate["open"]:
            time.sleep(0.01)
        return options

    def broken(options):
        raise RuntimeError("no")

    app = commands.Service({"scope": lambda o: seen.append(o) or 1, "cut": slow, "summary": broken}, {"scope": lambda: {"done": 3}}, {"double": lambda xs: [2 * x for x in xs]})

    def ask(method, path, body=None, raw=None):
        data, got = raw if raw is not None else json.dumps(body).encode() if body is not None else b"", {}
        env = {"REQUEST_METHOD": method, "PATH_INFO": path, "CONTENT_LENGTH": str(len(data)), "wsgi.input": io.BytesIO(data)}
        out = b"".join(app(env, lambda status, headers: got.update(status=int(status[:3]))))
        return got["status"], json.loads(out)

    def finished(name):
        app.jobs[name]["thread"].join(10)
        return ask("GET", f"/jobs/{name}")[1]

    assert ask("GET", "/health")[1]["ok"] and ask("GET", "/steps/scope/status") == (200, {"done": 3}) and ask("POST", "/models/double/predict", {"inputs": [1, 2]}) == (200, [2, 4])
    code, job = ask("POST", "/steps/scope/run", {"options": {"limit": 2}})
    assert code == 202 and finished(job["id"])["state"] == "done" and seen == [{"limit": 2}]
    code, job = ask("POST", "/pipeline/run", {"steps": [{"step": "cut"}, {"step": "scope"}]})
    assert ask("POST", "/steps/scope/run", {})[0] == 409 and ask("POST", f"/jobs/{job['id']}/cancel")[0] == 202
    gate["open"] = True
    assert finished(job["id"])["state"] == "cancelled" and len(seen) == 1
    code, job = ask("POST", "/steps/summary/run", {})
    assert finished(job["id"])["error"] == "RuntimeError: no"
    assert ask("POST", "/steps/scope/run", {"options": {"reset": True}})[0] == 409 and ask("POST", "/steps/scope/run", raw=b"{")[0] == 400 and ask("GET", "/nothing")[0] == 404
    assert ask("POST", "/models/double/predict", raw=b" " * (commands.MOST_BODY + 5))[0] == 413 and len(ask("GET", "/jobs")[1]) == 3
