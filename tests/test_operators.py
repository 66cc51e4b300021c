"""Operators on small fixtures: state, relations, periods, sampling, measuring, matching, parsing, storage."""

import os

import pytest
from pyspark.sql import functions as F

from quillmark.operators import attribution, audit, maintenance, matching, measure, parts, periods, relational, sampling, scorers, sheets, state
from quillmark.sources import tables


def test_pending_and_state(spark):
    arts = spark.createDataFrame([(3, "x  y"), (1, "x y"), (2, "z"), (4, None)], "id long, body string").where("body is not null")
    none = spark.createDataFrame([], "item_id string")
    todo = state.pending_bodies(arts, none, "id", "body").orderBy("id").collect()
    assert [r.id for r in todo] == [1, 2]
    done = spark.createDataFrame([(todo[0].body_hash,)], "item_id string")
    assert [r.id for r in state.pending_bodies(arts, done, "id", "body").collect()] == [2]
    row = lambda status, at: ("body", "h", "scope", "r", status, None, at)
    ddl = "item_kind string, item_id string, step string, model_revision string, status string, error string, finished_at string"
    s0 = spark.createDataFrame([], ddl + ", attempts int")
    s1 = state.advance(s0, spark.createDataFrame([row("failed", "1")], ddl))
    s2 = state.advance(s1, spark.createDataFrame([row("done", "2")], ddl)).first()
    assert (s2.status, s2.attempts, s2.finished_at) == ("done", 2, "2")


def test_failing_rows_get_their_error(spark):
    def score(pdf):
        if (pdf.x == 2).any():
            raise ValueError("two")
        return pdf[["x"]].assign(y=pdf.x * 10)

    rows = state.record_batch(spark, spark.createDataFrame([(1,), (2,), (3,)], "x long").coalesce(1), ["x"], score, "x long, y double").orderBy("x").collect()
    assert [r.y for r in rows] == [10.0, None, 30.0] and rows[1].error == "ValueError: two"


def test_relations(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k long, v string")
    b = spark.createDataFrame([(2, "z"), (3, None), (4, "w")], "k long, v string")
    assert {(r.k, r.kind) for r in relational.movement(a, b, "k", "v").collect()} == {(1, "lost"), (2, "changed"), (4, "gained")}
    assert tuple(relational.set_sizes(a, b, "k").first()) == (3, 3, 4, 2, 1, 1)
    with pytest.raises(relational.Refused):
        relational.require_unique(a.union(a), ["k"])
    with pytest.raises(relational.Refused):
        relational.require_same_keys(a, b, ["k"])
    assert relational.digest(a).first().digest == relational.digest(a.orderBy(F.desc("k"))).first().digest != relational.digest(b).first().digest
    assert relational.digest(a.limit(0)).first().n == 0


def test_late_rows_count_once(spark):
    grid = {"first": "2022-01-03", "days": 21, "zone": "UTC"}
    rows = spark.createDataFrame([(1, "2022-01-01 00:00:00"), (2, "2022-01-10 00:00:00"), (3, "2022-01-02 00:00:00")], "id long, d string").withColumn("d", F.to_timestamp("d"))
    first = periods.write_next(rows.where("id <> 3"), rows.limit(0), ["id"], "d", 0, **grid)
    second = periods.write_next(rows, first, ["id"], "d", 1, **grid)
    assert {(r.id, r.late) for r in first.collect()} == {(1, False)}
    assert {(r.id, r.late) for r in second.collect()} == {(2, False), (3, True)}


def test_sampling(spark):
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 4).cast("string").alias("s"))
    q = sampling.quota(rows, "s", "id", {"0": 3, "1": 40}, 1)
    assert {r.s: r["count"] for r in q.groupBy("s").count().collect()} == {"0": 3, "1": 25}
    assert {(r.s, r.drawn) for r in sampling.shortfalls(q, "s", {"1": 40, "3": 1}).collect()} == {("1", 25), ("3", 0)}
    assert sampling.group_folds(rows, "s", 3, 1).groupBy("s").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    assert sampling.seeded(rows, "id", 5, 1).collect() == sampling.seeded(rows.repartition(7), "id", 5, 1).collect()


def test_auc_and_bootstrap(spark):
    import itertools
    import random

    rng = random.Random(1)
    data = [(rng.randrange(6) / 5, rng.randrange(2)) for _ in range(60)]
    df = spark.createDataFrame(data, "s double, y int")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = sum((p > n) + (p == n) / 2 for p, n in itertools.product(pos, neg)) / len(pos) / len(neg)
    assert measure.roc_auc(df, "s", "y").first().auc == pytest.approx(want)
    b = measure.bootstrap(df.withColumn("c", F.monotonically_increasing_id()), "c", F.col("y"), F.lit(1)).first()
    assert b.low <= b.point <= b.high and b.point == pytest.approx(len(pos) / 60)
    sweep = {r.cut: (r.tp, r.fp, r.fn, r.tn) for r in measure.at_thresholds(df, "s", "y", [0.3, 0.9]).collect()}
    assert sweep[0.3] == (sum(s >= 0.3 for s in pos), sum(s >= 0.3 for s in neg), sum(s < 0.3 for s in pos), sum(s < 0.3 for s in neg))


def test_auc_of_many_distinct_scores(spark):
    rows = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("h"), "id")
    rows = rows.select((F.col("h") / (1 << 40)).alias("s"), F.expr("cast(h % 7 < 2 + id % 3 as int)").alias("y")).unionByName(spark.createDataFrame([(None, 1), (2.0, 0), (2.0, 1)], "s double, y int"))
    pdf = rows.toPandas().dropna()
    rank = pdf.s.rank(method="average")
    pos = int((pdf.y == 1).sum())
    want = (rank[pdf.y == 1].sum() - pos * (pos + 1) / 2) / pos / (len(pdf) - pos)
    for n in (1, 4, 13):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = measure.roc_auc(rows.repartition(5), "s", "y").first()
        assert got.auc == pytest.approx(want, abs=1e-12) and (got.positives, got.negatives) == (pos, len(pdf) - pos)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert measure.roc_auc(rows.limit(0), "s", "y").first().auc is None


def test_resampled_intervals(spark):
    data = [(f"c{k % 9}", "ab"[k % 2], k % 3 == 0, k % 4 == 0) for k in range(60)]
    df = spark.createDataFrame(data, "c string, s string, x boolean, y boolean")
    one = lambda c: F.col(c).cast("int")
    got = measure.resampled(df, "c", one("x"), F.lit(1), stratum="s").first()
    assert got.point == pytest.approx(1 / 3) and got.low <= got.point <= got.high and got.low < got.high
    census = measure.resampled(df, "c", one("x"), F.lit(1), stratum="s", census=["a", "b"]).first()
    assert census.low == census.point == census.high
    gain = measure.resampled(df, "c", one("x"), F.lit(1), (one("y"), F.lit(1))).first()
    assert gain.point == pytest.approx(1 / 3 - 1 / 4) and gain.low < gain.point < gain.high
    nothing = measure.resampled(df.limit(0), "c", one("x"), F.lit(1)).first()
    assert nothing.point is None and nothing.low is None


ENTITIES = [("ABT", "Abbott Laboratories"), ("META", "Meta Platforms Inc."), ("JBHT", "J.B. Hunt Transport"), ("WMB", "Williams Companies"), ("GOOG", "Alphabet Inc. (Class C)"), ("GOOGL", "Alphabet Inc. (Class A)")]


def test_matcher(spark):
    d = matching.Dictionary(ENTITIES, common=frozenset({"williams"}))
    found = lambda t: [(m.entity, m.kind) for m in d.mentions(t)]
    assert found("Meta rose; Abbott Laboratories fell; alphabet too.") == [("META", "alias"), ("ABT", "name"), ("GOOG", "name")]
    assert found("Williams said so.") == [] and [e for e, _ in found("Williams (NYSE: WMB) said so.")] == ["WMB", "WMB"]
    assert d.counts("Meta analysts cheer. Alphabet, Alphabet.") == {"GOOG": 2}
    assert d.counts("Nobody here.", ["Meta Platforms", "Williams", "unknown"]) == {"META": 1} and d.counts("$WMB", ["Williams", "Williams"]) == {"WMB": 2}
    assert d.entity_of("JB Hunt Transport") == "JBHT" and d.entity_of("META") == "META" and d.entity_of("") is None and d.entity_of("meta") is None
    assert [m.kind for m in d.firm("Williams and Meta and Meta Platforms and $META")] == ["name", "ticker"] and d.explicit("$META (NYSE: ABT) META") == 2
    rows = spark.createDataFrame([(1, "Meta and Meta"), (2, None)], "id long, t string")
    assert [(r.id, r.entity, r.n) for r in matching.entity_counts(rows, "id", "t", d).collect()] == [(1, "META", 2)]
    assert matching.mention_spans(rows, "id", "t", d).count() == 2


@pytest.mark.parametrize(
    "key,yes,no",
    [
        ("j b hunt transport", ["J.B. Hunt Transport", "JB Hunt Transport", "J. B. Hunt-Transport"], ["j.b. hunt transport", "J.B. Hunt\nTransport"]),
        ("casey s general stores", ["Casey's General Stores", "CASEY’S GENERAL STORES"], ["Caseys General Stores", "Casey's General. Stores"]),
        ("estee lauder", ["Estée Lauder", "Este\u0301e Lauder", "ESTEE  LAUDER"], ["Estee, Lauder"]),
        ("yum brands", ["Yum! Brands", "Yum Brands"], ["Yum? Brands"]),
        ("coca cola", ["Coca-Cola", "coca cola"], ["CocaCola"]),
        ("a o", ["A.O.", "A. O", "AO"], ["a o"]),
    ],
)
def test_name_patterns(key, yes, no):
    pattern = matching.re.compile(matching.name_pattern(key), matching.re.I)
    assert all(pattern.fullmatch(t) for t in yes) and not any(pattern.fullmatch(t) for t in no)
    d = matching.Dictionary([("X", key)])
    assert all([m.entity for m in d.forms(f"see {t} there") if m.kind == "name"] == ["X"] for t in yes)


def test_forms_of_names():
    assert [matching.initials(k.split()) for k in ("j b hunt", "casey s general", "3m")] == [2, 0, 0]
    form = matching.re.compile(matching.form_pattern(["Block", "Inc"]))
    assert form.match("Block, Inc") and form.match("Block Inc") and not matching.re.compile(matching.form_pattern(["Jack", "Henry"])).match("Jack, Henry")
    d = matching.Dictionary([("TTWO", "Take-Two Interactive"), ("MTCH", "Match Group"), ("NDAQ", "Nasdaq Inc.")], generic=frozenset({"take"}), word_names=frozenset({"match"}), unsafe=frozenset({"NDAQ"}), short={"Take-Two": "TTWO"})
    found = lambda t, **k: [(m.entity, m.kind) for m in d.forms(t, **k)]
    assert found("Take-Two won a match, Match said on Nasdaq") == [("TTWO", "short"), ("MTCH", "name")]
    assert found("Take-Two Interactive") == [("TTWO", "name")] and found("Take-Two", aliases=False) == [] and found("$NDAQ") == [("NDAQ", "ticker")]
    assert d.entity_of("take two") == "TTWO" and d.entity_of("Take two, ") == "TTWO"


@pytest.mark.parametrize(
    "text,branch",
    [
        ("He is long stock META.", "genre"), ("He is long stock $META.", None), ("The firm makes a market in META shares", "genre"), ("Disclosure: none on META", "genre"), ("Trader A owns (META), B owns ABT;", "owns"),
        ("The bank has received compensation for services it gave to that company ( META )", "genre"), ("holds ABT, WMB, (META), XXX; YYY", "list"), ("ABT, META fell", None),
        ("AAA, BBB, CCC, META, DDD, EEE", None), ("META rose on strong sales", None),
    ],
)
def test_disclosures(text, branch):
    d = matching.Dictionary(ENTITIES)
    (m,) = [m for m in d.forms(text) if m.kind == "ticker" and m.entity == "META"]
    assert d.disclosed(text, m) == branch


def test_settled_spans_equal_a_plain_sweep(spark):
    import random

    rng = random.Random(6)
    data = []
    for i in range(60):
        own = {(a, a + rng.randrange(1, 6), rng.choice("xy")) for a in (rng.randrange(20) for _ in range(rng.randrange(9)))}
        data.append((i, [(a, b, e, "name", None) for a, b, e in own]))
    df = spark.createDataFrame(data, f"id long, spans {matching._SPANS}")
    got = {r.id: [(s.start, s.end, s.entity) for s in r.s] for r in df.select("id", matching.settled(F.col("spans")).alias("s")).collect()}
    for i, own in data:
        free, want = set(range(40)), []
        for a, b, e, *_ in sorted(own, key=lambda s: (s[0], -s[1], s[2])):
            if a >= (max(want)[1] if want else 0) and set(range(a, b)) <= free:
                want.append((a, b, e))
                free -= set(range(a, b))
        assert got[i] == want


def test_footers(spark):
    story = "x" * 300
    cases = {
        story + "\nMore from us\nA link\nRead more here\nReporting by A. B.\nCopyright 2020": story,
        "short\nCopyright 2020": "short\nCopyright 2020",
        story + "\nMore from us\nA link\nA quote ends here.\nafter": story + "\nA quote ends here.\nafter",
        story + "\nDisclosure: late\nall goes": story,
        "Disclosure: early\n" + story: "Disclosure: early\n" + story,
        "a\nJane Doe contributed to this report\n" + story: "a\n" + story,
        story + "\nReporting by " + "y" * 200: story + "\nReporting by " + "y" * 200,
        story + "\nDisclaimer: " + "y" * 400: story,
        story + "\n\n  \n": story,
        "": "",
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "id long, t string")
    got = {r.id: r.kept_text for r in attribution.strip_footer(rows, "id", "t").collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert attribution.strip_footer(spark.createDataFrame([(1, None)], "id long, t string"), "id", "t").first().kept_text == ""


def test_headers_and_clauses(spark):
    d = matching.Dictionary([("AAPL", "Apple"), ("MSFT", "Microsoft"), ("UAL", "United Airlines Holdings"), ("WEN", "Wendy's"), ("AMZN", "Amazon.com")])
    owners = lambda t, **k: attribution.header_owners(t, d, **k)
    assert owners("Apple, Microsoft - They rose.") == ["AAPL", "MSFT"] and owners("Nobody Known - They rose.") == [] and owners("No header here") is None
    assert owners("DETROIT - Ford rose") is None and owners("Apple - rose and fell") is None and owners("a cat and Apple - They rose") is None
    assert owners("Wendy's (WEN) - Sales fell", bracketed=True) == ["WEN"] and owners("Memory stocks - The group fell", wide=True) == [] and owners("SAP - Sales fell", wide=True) == []
    assert owners("Amazon.com - Sales fell") is None and owners("Amazon.com - Sales fell", wide=True) == ["AMZN"] and owners("FDA - The agency", wide=True) is None
    assert attribution.clauses("Apple rose three percent, Microsoft fell", d) == ["Apple rose three percent,", "Microsoft fell"]
    assert attribution.clauses("Apple and Microsoft announced it", d) == ["Apple and Microsoft announced it"]
    how = attribution.Reading(headers=True, named_after=True, per_sentence=True, wide=True)
    text = "- Apple - Sales rose. Microsoft - Sales fell; so did Apple."
    assert attribution.owned_line(text, d, how) == [("Apple - Sales rose.", ["AAPL"]), ("Microsoft - Sales fell", ["MSFT"]), ("so did Apple.", ["AAPL", "MSFT"])]
    assert attribution.owned_line("Airlines stocks - The group fell. United Airlines slipped.", d, how) == [("Airlines stocks - The group fell.", []), ("United Airlines slipped.", ["UAL"])]
    rows = spark.createDataFrame([(1, "Apple rose a lot today, Microsoft fell\nplain"), (2, None)], "id long, t string")
    assert [(r.position, r.piece, r.owners) for r in attribution.owned_pieces(rows, "id", "t", d).collect()] == [(0, "Apple rose a lot today,", None), (1, "Microsoft fell", None), (2, "plain", None)]


def test_parsers():
    text = "One two three. Four five. " + "Six " * 7 + "end."
    spans = attribution.packed(text, 6, attribution.word_tokens)
    assert [text[a:b] for a, b in spans][0] == "One two three." and all(len(attribution.word_tokens(text[a:b])) <= 6 for a, b in spans)
    tags = attribution.spans_of_tags(["O", "B-ORG", "O", "I-ORG", "B-PER"], [(0, 1), (2, 4), (4, 6), (7, 9), (10, 12)], [1, 0.8, 0.1, 0.6, 1], [0, 1, 1, 2, 3])
    assert [(t["entity_type"], t["start_char"], t["end_char"]) for t in tags] == [("ORG", 2, 9), ("PER", 10, 12)] and tags[0]["score"] == pytest.approx(0.7)


def test_lead(spark):
    rows = [("One. Two!  Three? Four. Five.", "One. Two!  Three?"), ("One. two. Three.", "One. two. Three."), ("", ""), ("a\nb. C. D. E", "a\nb. C. D.")]
    got = spark.createDataFrame(rows, "t string, want string").select(scorers.lead(F.col("t")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_code_identity():
    code = "A = 1\ndef f():\n    '''doc'''\n    return g() + A\ndef g(): return 1\ndef h(): return 2\n"
    assert list(scorers.reached(code, ["f"])) == ["A", "f", "g"]
    assert scorers.normalized_code("def f():\n  'd'\n  return 1") == scorers.normalized_code("def f():\n    # c\n    return 1")
    assert scorers.revision("p-", a=1) != scorers.revision("p-", a=2)
    assert scorers.choose_settings({"a": [0.5, 0.5], "b": [0.9, 0.9]}, "a") == "b" and scorers.choose_settings({"a": [0.5, 0.7], "b": [0.65, 0.62]}, "a") == "a"


def test_store_and_purge(spark, tmp_path):
    rows = spark.createDataFrame([("h1", "r1", "single", {"single": 0.9}), ("h2", "r2", "multi", None)], "body_hash string, model_revision string, scope string, scores map<string,double>")
    tables.append(rows, str(tmp_path), "body_scope")
    store = tables.store(spark, str(tmp_path))
    assert store["body_scope"].count() == 2 and store["news_snapshot"].isEmpty() and len(store) == 20
    plan = maintenance.purge_plan({"body_scope": store["body_scope"]}, "model_revision", ["r2"])
    assert plan["drop"] == {"body_scope": {"r1": 1}}
    kept = maintenance.purge({"body_scope": store["body_scope"]}, "model_revision", plan, plan["digest"])["body_scope"]
    assert [r.body_hash for r in kept.collect()] == ["h2"]
    with pytest.raises(relational.Refused):
        maintenance.purge({"body_scope": store["body_scope"]}, "model_revision", plan, "another")
    ids = {"body_scope": "n"}
    numbered = lambda df: {"body_scope": df.withColumn("n", F.length("scope"))}
    assert maintenance.verify_copy(numbered(store["body_scope"]), numbered(store["body_scope"]), ids) == []
    assert maintenance.verify_copy(numbered(store["body_scope"]), numbered(kept), ids)


def test_csv_guards(spark, tmp_path):
    path = tmp_path / "marks.csv"
    path.write_text("﻿article_id,review_order,mark\na,1,yes\nb,2,no\nc,3,\n", encoding="utf-8")
    rows, n = tables.read_marked_prefix(spark, str(path), "mark", ["yes", "no"], 2)
    assert n == 2 and rows.count() == 2
    with pytest.raises(relational.Refused):
        tables.read_marked(spark, str(path), "mark", ["yes", "no"])
    with pytest.raises(relational.Refused):
        tables.read_marked_prefix(spark, str(path), "mark", ["yes"], 1)
    assert tables.documents_of('a {"x": 1} b [2] {bad') == ([{"x": 1}, [2]], "a  b  {bad")
    with pytest.raises(relational.Refused):
        tables.check_schema(rows, ["absent"])
    assert len(tables.file_identity(spark, str(path))) == 16
    with maintenance.single_writer(spark, str(tmp_path)), pytest.raises(relational.Refused), maintenance.single_writer(spark, str(tmp_path)):
        pass


def test_jobs(spark):
    jobs = maintenance.Jobs(spark, {"a": lambda: 1, "b": lambda: jobs.cancel()})
    assert jobs.run(["a", "b", "a"]) == {"a": 1, "b": None} and jobs.log[-1] == ("a", "cancelled")
    with pytest.raises(relational.Refused):
        jobs.run(["c"])


def test_sheet_cells(spark):
    cells = [("Booking Holdings, Inc., Apple", ["Booking Holdings, Inc.", "Apple"]), ("Apple,\n Google ,, LLC", ["Apple", "Google, LLC"]), ("", []), (None, []), ("Inc.", ["Inc."]), ("A: x, Corp, B:y", ["A: x, Corp", "B:y"])]
    got = spark.createDataFrame([(k, c) for k, (c, _) in enumerate(cells)], "id long, cell string").select("id", sheets.split_list(F.col("cell")).alias("items")).collect()
    assert {r.id: r.items for r in got} == {k: want for k, (_, want) in enumerate(cells)}
    marks = spark.createDataFrame([("AAPL:product, MSFT:other, AAPL:Legal, none",)], "cell string").select(sheets.label_map(F.col("cell")).alias("m")).first().m
    assert marks == {"AAPL": ["product", "legal"], "MSFT": ["other"]}
    rules = {"single": "one", "multi": "many", "sector": "any", "market": "none"}
    rows = spark.createDataFrame([("single", 1, 0), (" Single", 2, 0), ("multi", 1, 0), ("sector", 0, 0), ("market", 1, 0), ("x", 0, 0)], "s string, c int, n int")
    assert [len(r[0]) for r in rows.select(sheets.scope_problems(F.col("s"), F.col("c"), F.col("n"), rules)).collect()] == [0, 1, 1, 1, 1, 1]
    old = spark.createDataFrame([(1, "Apple:x; Microsoft", "apple;Google")], "id long, labels string, companies string")
    new = sheets.migrated(old, "id", "labels", "companies").first()
    assert new.labels == "Apple:x, Microsoft, Google" and len(new.problems) == 3


def test_name_book(spark):
    universe = spark.createDataFrame(
        [("AAPL", "Apple Inc.", "AAPL"), ("GOOG", "Alphabet Inc.", "GOOG"), ("GOOGL", "Alphabet Inc.", "GOOG"), ("HD", "Home Depot", "HD"), ("GM", "General Motors", "GM"), ("GIS", "General Mills", "GIS"), ("F", "Ford Motor", "F"), ("SNA", "Snap-on", "SNA"), ("FOX", "Fox Corp Class B", "FOX"), ("FOXA", "Fox Corp Class A", "FOX")],
        "id string, name string, canonical string",
    )
    nick = spark.createDataFrame([("GOOG", "Google"), ("XYZ", "Nobody"), ("HD", "The Home Depot")], "id string, form string")
    brand = spark.createDataFrame([("GOOG", "YouTube"), ("F", "Google")], "id string, form string")
    book = sheets.name_book(universe, nick, brand, {"FOX": "FOXA"})
    texts = {
        "AAPL": ("AAPL", None, ""), "aapl": ("AAPL", None, "ticker, other case"), "$AAPL": ("AAPL", None, ""), "Apple": ("AAPL", None, ""), "Home": ("HD", None, "first word"), "YouTube": ("GOOG", None, "brand"),
        "General": (None, "ambiguous: GIS, GM", ""), "Google": (None, "ambiguous: F, GOOG", ""), "F": ("F", None, "word ticker"), "Snap": (None, "unknown", ""), "Fox": ("FOXA", None, ""), "": (None, "empty", ""), "GOOGL": ("GOOG", None, ""),
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.found, r.why, r.note) for r in sheets.looked_up(rows, "t", book, universe).collect()}
    assert got == texts
    assert sheets.disagreements(sheets.name_book(universe, class_of={"FOX": "FOXA"}), universe, {"FOX": "FOXA"}).isEmpty()
    assert {r.name for r in sheets.disagreements(sheets.name_book(universe, spark.createDataFrame([("F", "Apple")], "id string, form string")), universe).collect()} == {"Apple Inc."}


def test_jobs_in_parts(spark, tmp_path):
    rows = spark.range(3, 40).select((F.col("id") * 7).alias("k"), F.col("id").cast("string").alias("v"))
    make = lambda r=rows, size=10, **c: parts.Job(spark, str(tmp_path / "job"), r, "k", size, c)
    work = lambda r: r.withColumn("w", F.length("v"))
    job = make(revision="a")
    assert job.parts == 4 and job.run(work, most=2) == [0, 1] and [job.state(p) for p in range(4)] == ["done", "done", "open", "open"]
    with pytest.raises(relational.Refused):
        job.result()
    again = make(revision="a")
    assert again.run(work) == [2, 3] and again.run(work) == []
    assert sorted((r.k, r.part, r.w) for r in again.result().collect()) == [(7 * i, (i - 3) // 10, len(str(i))) for i in range(3, 40)]
    rows.limit(3).write.mode("overwrite").parquet(str(tmp_path / "job" / "part-000001"))
    assert again.state(1) == "invalid" and again.run(work) == [1]
    again.redo([3])
    assert again.state(3) == "open" and again.run(work, stop=lambda: True) == [] and again.run(work) == [3]
    for other in ({"revision": "b"}, {"revision": "a", "size": 9}, {"revision": "a", "r": rows.limit(30)}):
        with pytest.raises(relational.Refused):
            make(**other)
    with pytest.raises(relational.Refused):
        again.redo([0]) or again.run(lambda r: r.limit(1))
    with pytest.raises(relational.Refused):
        parts.Job(spark, str(tmp_path / "twice"), rows.unionByName(rows), "k", 5, {})
    with pytest.raises(relational.Refused):
        relational.require_rows(rows, {"long": "length(v) < 2"}, "k")


def test_audit_expressions(spark):
    rows = spark.createDataFrame([(["Alpha", "Beta Co"], ["alpha inc", "Beta", "x"]), (["a"], []), ([], ["a"])], "m array<string>, e array<string>")
    assert [r[0] for r in rows.select(audit.containing(F.col("m"), F.col("e"))).collect()] == [2, 0, 0]
    s = spark.createDataFrame([(1, "A", [["A"], ["A", "B"], ["B"], [], ["C"]])], "id long, own string, named array<array<string>>")
    assert tuple(audit.sentence_measures(s, "id", "named", "own").first()) == (1, 5, 1, 1, 2, 1, 2)
    pieces = spark.createDataFrame([("a", "x" * 95, 100), ("a", "tiny", 100), ("b", "y" * 50, 50)], "g string, p string, n int")
    assert {r.g: r.flags for r in audit.quality_flags(pieces, "g", "p", "n").collect()} == {"a": "tiny+whole", "b": ""}
    marks = spark.createDataFrame([("k1", ["x", "y"], True), ("k2", ["x"], False)], "k string, o array<string>, r boolean")
    omitted = spark.createDataFrame([("y", "k2")], "owner string, k string")
    assert {r.owner: (r.n, r.right) for r in audit.owners_with_omitted(marks, "o", "r", omitted, "k").collect()} == {"x": (2, 1), "y": (2, 1)}
    runs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, l string")
    assert tuple(audit.changed_labels(runs, runs.where("k < 3").withColumn("l", F.lit("a")), "k", "l").first()) == (2, 1, 1)
    d = spark.createDataFrame([("i", 0.9, True), ("i", 0.2, False), ("j", 0.8, False), ("j", 0.1, True), ("k", 0.3, False)], "i string, s double, y boolean")
    assert tuple(audit.decided(d, "i", "y", "s", 0.5).first()) == (pytest.approx(1 / 3), pytest.approx(1 / 3), pytest.approx(1 / 3), pytest.approx(1 / 3))
    pool = spark.createDataFrame([(1, "A Title!"), (2, "other")], "id long, t string")
    seen = spark.createDataFrame([("a title",)], "t string")
    assert [r.id for r in audit.without_copies(pool, "t", seen).collect()] == [2]
    audit.check_draw(pool.where("id = 2"), "id", pool.where("id = 1"), "t", seen)
    with pytest.raises(relational.Refused, match="titles"):
        audit.check_draw(pool, "id", pool.limit(0), "t", seen)
    lengths = spark.range(500).select("id", (F.col("id") * 37 % 101).alias("n"))
    batches = audit.length_batches(lengths, "id", "n", 10, 5, 1)
    worst = batches.groupBy("pool", "batch").agg(F.count("*").alias("c"), (F.max("n") - F.min("n")).alias("spread")).collect()
    assert max(r.c for r in worst) == 10 and sum(r.c for r in worst) == 500 and max(r.spread for r in worst) < 60
    texts = spark.createDataFrame([(k, "common words here " + ("odd strange text" if k == 3 else "and more of them")) for k in range(9)] + [(9, None)], "id long, t string")
    near = audit.representative(texts, "id", "t", 3).collect()
    assert len(near) == 3 and 3 not in {r.id for r in near}
    e = audit.entity_measures(spark.createDataFrame([(1, ["a", "b"], ["b"], "a")], "id long, s array<string>, y array<string>, m string"), "id", "s", "y", "m").first()
    assert (e.main_kept, e.recall) == (False, 0.5)
    assert spark.range(1).select(audit.sensitivity(F.lit(0.2), F.lit(0.5), F.lit(0.1)).alias("v")).first().v == pytest.approx(0.1 / 0.18)


def test_copies_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    sets = [(k, sorted({rng.choice("abcdefgh") + str(rng.randrange(6)) for _ in range(rng.randrange(1, 14))} | {"hot"})) for k in range(60)]
    sets += [(100 + k, [x for x in s if rng.random() < 0.95] + ["more"]) for k, s in sets[:25]] + [(200, ["hot"]), (201, [])]
    df = spark.createDataFrame(sets, "id long, s array<string>")
    got = {(r.id, r.other_id, r.shared, r.own) for r in relational.copies_of(df, df, "id", "s").collect()}
    want = {(i, j, len(set(a) & set(b)), len(set(a))) for i, a in sets for j, b in sets if i != j and a and len(set(a) & set(b)) >= 0.8 * len(set(a))}
    assert got == want and len(want) > 25


def test_slices_of_all_rows(spark):
    rows = spark.range(0, 2500, 7).withColumn("v", F.lit(1))
    got = {r.id: r.part for r in sampling.slices(rows.repartition(5), ["id"], 100).collect()}
    assert got == {7 * k: k // 100 for k in range(len(got))}


def test_streamed_bodies_take_the_least_id_of_all_files(spark, tmp_path):
    from quillmark.streaming import streams

    source = str(tmp_path / "docs")
    for k, rows in enumerate([[(7, "a  b"), (8, None), (9, "c")], [(3, "a b"), (4, None), (5, "d"), (10, "c ")]]):
        spark.createDataFrame(rows, "id long, t string").coalesce(1).write.mode("append").parquet(source)
        for f in (tmp_path / "docs").glob("*.parquet"):
            if f.stat().st_mtime > 2_000:  # the first files written are the oldest
                os.utime(f, (1_000 + k, 1_000 + k))
    got = streams.pending_bodies(spark, source, str(tmp_path / "work"), "id", "t")
    assert len(list((tmp_path / "work" / "bodies").glob("batch=*"))) == 2
    assert sorted(r.id for r in got.collect()) == [3, 4, 5, 9] and got.where("body_hash is null").count() == 1


def test_jobs_do_many_parts_in_one_pass(spark, tmp_path):
    rows = spark.range(0, 4000, 2).select(F.col("id").alias("k"))
    calls = []
    work = lambda r: calls.append(1) or r.withColumn("w", F.col("k") + 1)
    job = parts.Job(spark, str(tmp_path / "job"), rows, "k", 10, {})
    assert job.run(work, most=1) == [0] and job.run(work) == list(range(1, 200)) and len(calls) == 2
    job.redo([0, 5, 6, 199])
    assert job.run(work, together=2) == [0, 5, 6, 199] and len(calls) == 4
    assert sorted(map(tuple, job.result().collect())) == [(2 * k, 2 * k + 1, k // 10) for k in range(2000)]
    assert job.result().columns == ["k", "w", "part"] and not list((tmp_path / "job").glob("draft*"))
    job.redo([7])
    with pytest.raises(relational.Refused):  # a row too many
        job.run(lambda r: r.unionByName(spark.createDataFrame([(-5,)], "k long")))
    assert job.run(lambda r: r.withColumn("x", F.lit(1))) == [7]
    with pytest.raises(relational.Refused):  # columns that differ from those of the other parts
        job.result()


def test_resampled_draws_are_not_sent_through_the_driver(spark):
    import hashlib
    import re

    data = [(f"c{k}", "abz"[k % 3], k % 5 == 0) for k in range(90)]
    df = spark.createDataFrame(data, "c string, s string, x boolean")
    out = measure.resampled(df, "c", F.col("x").cast("int"), F.lit(1), draws=40, seed=3, stratum="s", census=["z"])
    got = out.collect()[0]
    assert not re.search(r"BroadcastHashJoin \[_stratum#\d+, ", out._jdf.queryExecution().executedPlan().toString())
    drawn = lambda d, s, i, n: int(int(hashlib.md5(f"3:{d}:{s}:{i}".encode()).hexdigest()[:12], 16) / 16**12 * n)
    by = {s: [x for _, x in sorted((c, x) for c, t, x in data if t == s)] for s in "abz"}
    values = sorted((sum(by["z"]) + sum(by[s][drawn(d, s, i, 30)] for s in "ab" for i in range(30))) / 90 for d in range(1, 41))
    assert (got.point, got.low, got.high) == pytest.approx((18 / 90, values[round(0.025 * 39)], values[round(0.975 * 39)]))
