"""Queries over marked sheets, and runs in parts that can be resumed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators import parts, sheets

from .facts import _work
from .registry import query, table


def _universe(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    ident = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    return nation.select(ident.alias("id"), F.initcap(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("name"), ident.alias("canonical"))


#: A supplier's cell: its nation by name, a nation by identifier, one in lower case, and a company nobody knows, whose legal form follows a comma.
_CELL = "'nation ' || s_nationkey || ', N' || (s_suppkey % 25) || ', n' || (s_suppkey % 7) || ', nowhere ' || s_suppkey || ', Inc.'"


@query("""WITH s AS (SELECT s_suppkey, ['N' || s_nationkey, 'N' || (s_suppkey % 25), 'N' || (s_suppkey % 7)] AS l FROM supplier)
SELECT s_suppkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ', ') || ', nowhere ' || s_suppkey || ', Inc.' AS mentions, 'mentions: ''nowhere ' || s_suppkey || ', Inc.'' unknown' AS problems,
'mentions: ''n' || (s_suppkey % 7) || ''' -> N' || (s_suppkey % 7) || ' (ticker, other case)' AS confirm FROM s""")
def sheet_lists(spark, sf):
    """List cells with names rewritten to identifiers."""
    universe = _universe(spark, sf)
    rows = table(spark, sf, "supplier").select("s_suppkey", F.expr(_CELL).alias("mentions"))
    out = sheets.rewritten_list(rows, "s_suppkey", "mentions", sheets.name_book(universe), universe)
    return out.select("s_suppkey", "mentions", F.array_join("problems", ";").alias("problems"), F.array_join("confirm", ";").alias("confirm"))


@query("""SELECT s_suppkey, 'N' || s_nationkey || ':x, N' || s_nationkey || ':y' || CASE WHEN s_nationkey = 3 THEN ':z' ELSE '' END || ', Nobody:z' AS labels,
CASE WHEN s_nationkey = 3 THEN 'labels: ''N3:y'' unknown;' ELSE '' END || 'labels: ''Nobody'' unknown' AS problems FROM supplier WHERE s_nationkey <> 3
UNION ALL SELECT s_suppkey, 'N3:x, N3:y:z, Nobody:z', 'labels: ''N3:y'' unknown;labels: ''Nobody'' unknown' FROM supplier WHERE s_nationkey = 3""")
def sheet_labels(spark, sf):
    """Cells of names with labels, a company's labels brought together; a name that holds a colon is not known."""
    universe = _universe(spark, sf)
    cell = "'Nation ' || s_nationkey || ':x, Nobody:z, n' || s_nationkey || ':y' || CASE WHEN s_nationkey = 3 THEN ':z' ELSE '' END"
    cell = "CASE WHEN s_nationkey = 3 THEN 'Nation 3:x, N3:y:z, Nobody:z' ELSE " + cell + " END"
    rows = table(spark, sf, "supplier").select("s_suppkey", F.expr(cell).alias("labels"))
    out = sheets.rewritten_labels(rows, "s_suppkey", "labels", sheets.name_book(universe), universe)
    return out.select("s_suppkey", "labels", F.array_join("problems", ";").alias("problems"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(10000000 + n_regionkey * 1000000 + n_nationkey AS VARCHAR) || ',' ELSE '' END || CAST(10 + n_regionkey AS VARCHAR) || ',' || CAST(10000000 + n_regionkey * 1000000 + n_nationkey AS VARCHAR) AS codes,
'''bogus'' is not a code, name or ticker' || CASE WHEN s_suppkey % 2 = 0 THEN ';' || CAST(10000000 + n_regionkey * 1000000 + n_nationkey AS VARCHAR) || ': listed twice' ELSE '' END AS problems FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def sheet_codes(spark, sf):
    """Cells with nodes of a hierarchy: a name that holds a comma, a code of a higher level, a member's identifier, and what is none."""
    nation = table(spark, sf, "nation")
    codes = nation.select((10000000 + F.col("n_regionkey") * 1000000 + F.col("n_nationkey")).cast("string").alias("code"), F.concat("n_name", F.lit(", Goods & Wares")).alias("name"))
    members = nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"), F.concat("n_name", F.lit(", goods and wares")).alias("node"))
    cell = "CASE WHEN s_suppkey % 2 = 0 THEN n_name || ', goods and wares, ' ELSE '' END || (10 + n_regionkey) || ', bogus, n' || n_nationkey"
    rows = table(spark, sf, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", F.expr(cell).alias("sub"))
    out = sheets.resolved_codes(rows, "s_suppkey", "sub", codes, members)
    return out.select("s_suppkey", F.array_join("codes", ",").alias("codes"), F.array_join("problems", ";").alias("problems"))


@query("""WITH r AS (SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id, quality, toxic FROM labels WHERE toxic = 1 AND quality = 0 UNION ALL SELECT -1 - page_id, 1, 0 FROM pages),
b AS (SELECT doc_id, count(*) AS n, bool_or(quality = 1) AS tagged, bool_or(toxic = 1) AS bad FROM r GROUP BY doc_id)
SELECT CAST(coalesce(b.doc_id, d.doc_id) AS VARCHAR) AS id, CASE WHEN b.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'unknown' WHEN n > 1 THEN 'duplicated' WHEN NOT tagged THEN 'untagged' WHEN bad THEN 'bad' ELSE 'good' END AS state
FROM b FULL JOIN (SELECT DISTINCT doc_id FROM documents) d ON b.doc_id = d.doc_id""")
def sheet_report(spark, sf):
    """A returned sheet (labels, some twice, and rows of no document) against the ids it was given for."""
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    strange = table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    rows = labels.unionByName(labels.where("toxic = 1 and quality = 0")).unionByName(strange)
    rows = rows.withColumn("problems", F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>")))
    return sheets.file_report(rows, "doc_id", F.col("quality") == 1, "problems", table(spark, sf, "documents").select("doc_id"))


@query("SELECT doc_id, CAST((rank - 1) // 300 AS INTEGER) AS part, length(text) AS chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rank FROM documents)")
def resumed_parts(spark, sf):
    """A job over documents in parts of 300: stopped after the first part, resumed, one part done again, all read together."""
    folder = _work(spark, uuid.uuid4().hex)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    job = parts.Job(spark, folder, docs, "doc_id", 300, {"measure": "chars"})
    run = lambda rows: rows.select("doc_id", F.length("text").alias("chars"))
    job.run(run, most=1)
    job.run(run)
    job.redo([0])
    job.run(run)
    return job.result().select("doc_id", "part", "chars")
