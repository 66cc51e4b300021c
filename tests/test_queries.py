"""Every registered query against its SQL twin on the smallest tables, and the contract of the entry module."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
OWN = [n for n in entry.catalogue.queries()]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(cursor_columns, values):
    order = sorted(range(len(cursor_columns)), key=lambda k: cursor_columns[k])
    plain = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(plain(r[k]) for k in order) for r in values), key=repr)


@pytest.mark.parametrize("name", [n for n in OWN if n in entry.catalogue.oracle_sql()])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cur.fetchall())


@pytest.mark.parametrize("name", [n for n in OWN if n not in entry.catalogue.oracle_sql()])
def test_query_without_sql_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_upsert_latest_replaces_stored_rows(spark, monkeypatch):
    from quillmark.operators import state

    calls, real = [], state.upsert
    monkeypatch.setattr(state, "upsert", lambda current, changes, key, order: calls.append((current, changes, key)) or real(current, changes, key, order))
    out = entry.queries()["upsert_latest"](spark, SF)
    current, changes, key = calls[-1]
    stored = current.count()
    replaced = current.join(changes.select(*key).distinct(), key, "left_semi").count()
    assert 0 < replaced and changes.count() > 0 and out.count() >= stored


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_streams_equal_batch(spark):
    from quillmark.operators import periods
    from quillmark.plans.facts import WEEK

    got = {tuple(r) for r in entry.queries()["stream_periods"](spark, SF).collect()}
    rows_ = spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_type", "cast(ts as timestamp) d")
    want = {(r.period, r.event_type, r["count"]) for r in periods.assign(rows_, "d", **WEEK).groupBy("period", "event_type").count().collect()}
    assert got == want
    bodies = {tuple(r) for r in entry.queries()["stream_pending_bodies"](spark, SF).collect()}
    assert bodies == {tuple(r) for r in entry.queries()["unique_bodies"](spark, SF).select("body_hash", "doc_id").collect()}


PROBE = """
import __spark_entry__ as entry
own = set(entry.catalogue.queries())
print(sorted(set(entry.queries()) - own), set(entry.oracle_sql()) <= set(entry.queries()))
"""


@pytest.mark.parametrize("gone", ["folders", "all", "dependency"])
def test_entry_without_training_operators(tmp_path, gone):
    """In a real copy: without the folders, without the pipeline too, and with a library missing that only they need."""
    here = Path(entry.__file__).parent
    shutil.copytree(here / "quillmark", tmp_path / "quillmark", ignore=shutil.ignore_patterns("__pycache__", *([] if gone == "dependency" else ["llm"])))
    for name in ("__spark_entry__.py", *([] if gone == "all" else ["corpus_pipeline.py"])):
        if (here / name).exists():
            shutil.copy(here / name, tmp_path / name)
    if gone == "dependency":
        (tmp_path / "public_tokenizers.py").write_text("raise ImportError('not here')")
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([str(tmp_path), *[p for p in sys.path if p and Path(p).resolve() != here]])}
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.split("\n")[0] == "[] True", done.stderr
