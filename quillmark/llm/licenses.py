"""Operator 1, licence scans: canonical digest lookup of whole texts.

A text is brought to a canonical form: ASCII letters in lower case; lines of copyright notices removed; typographic
quotes and dashes as ASCII; every run of punctuation and white space one space; equivalent spellings as one. Its
SHA-256 is joined with the digests of known licences, made by the same expressions from their texts. A match means
that the whole text is that licence, up to those differences. Lines that name a licence are looked up likewise, each as
a text of its own, among the usual notices of known licences.

A null text is empty. A text that is empty in canonical form matches nothing. If several known licences share a
digest, the smallest identifier counts. Repeated rows match alike. Extra columns are not read.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .license_texts import KNOWN, KNOWN_DIGESTS, notices

#: Licences up to which the known digests are sent to every task; beyond, the join shuffles.
MOST_BROADCAST = 200_000
_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Equivalent words of the public SPDX matching guidelines, and the form that stands for each.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "copyright holder": "copyright owner", "copyright holders": "copyright owners", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "licences": "licenses",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "non commercial": "noncommercial", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "per cent": "percent", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "sub license": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "wilfull", "https": "http",
}
#: Words after "copyright" in running text, so that a line which a wrapped text begins with both is no notice.
_BODY = (
    "and|are|as|assignments?|disclaimers?|doctrines?|except|exceptions?|from|holders?(?:hips?)?|if|in|interests?|is|laws?|licen[cs]es?|notices?|of|on|or|owners?(?:hips?)?"
    "|permissions?|protection|resulting|statements?|than|that|the[ \t]+(?:software|library|program)|to|treat(?:y|ies)|under|when|which|with"
)
#: A line of running text, which stays as group 1; or one that states a copyright: the word, the sign or "(c)" first, then a
#: year, a name, a bracket, a colon or the sign. Read by Java and RE2, so without looking ahead.
_NOTICE = (
    f"((?:^|\n)[^a-z0-9\n]*copyright[ \t]+(?:{_BODY})\\b[^\n]*)|(?:^|\n)[^a-z0-9\n]*(?:(?:portions[ \t]+(?:are[ \t]+)?)?copyright(?:[ \t]*(?:\\(c\\)|©|[0-9:<{{\\[])"
    "|[ \t]+[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f])|\\(c\\)[ \t]*(?:[0-9]|copyright)|©|all rights reserved)[^\n]*"
)
#: Runs of ASCII characters that are no letter or digit, and of general punctuation.
_GAPS = "[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f\u00a0\u00a9\u00ab\u00b7\u00bb\u2010-\u2015\u2018-\u201f\u2022\u2026]+"


#: The words that have another form, for texts that have none of them to skip the replacements.
_SPELT = " (?:" + "|".join(sorted({w.split(" ")[0] for w in EQUIVALENT if " " not in w} | {w.replace(" ", "  ") for w in EQUIVALENT if " " in w} | {"sub  licence"})) + ") "
#: A line without these cannot be a notice.
_NAMING = ("licen", "spdx", "creative commons")


def canonical(text: Column) -> Column:
    t = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWERED)
    # most texts have no such line; they skip the pattern
    t = F.when(t.contains("copyright") | t.contains("(c)") | t.contains("©") | t.contains("all rights reserved"), F.regexp_replace(t, _NOTICE, "$1")).otherwise(t)
    # two blanks between words, so that each word has its own on both sides
    t = F.concat(F.lit(" "), F.trim(F.regexp_replace(t, _GAPS, "  ")), F.lit(" "))
    same = t
    for other, stands in EQUIVALENT.items():
        same = F.replace(same, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {stands.replace(' ', '  ')} "))
    return F.replace(F.trim(F.when(t.rlike(_SPELT), same).otherwise(t)), F.lit("  "), F.lit(" "))


def _notice_digests(spark: SparkSession) -> dict[str, str]:
    """Digests of the notices, which are a fixed list, to licence identifiers."""
    rows = spark.createDataFrame(sorted(notices()), "license_id string, text string").select("license_id", F.sha2(canonical(F.col("text")), 256).alias("digest"))
    return {r.digest: r.license_id for r in rows.orderBy(F.desc("license_id")).collect()}


def notice_ids(text: Column, digests: dict[str, str]) -> Column:
    """Licences that lines of a text name, ascending and joined by commas."""
    known = F.create_map(*[F.lit(x) for kv in sorted(digests.items()) for x in kv])
    naming = lambda line: functools.reduce(Column.__or__, [F.lower(line).contains(w) for w in _NAMING])
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), naming)
    found = F.transform(lines, lambda line: F.try_element_at(known, F.sha2(canonical(line), 256)))
    ids = F.array_join(F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))), ",")
    return F.when(naming(F.coalesce(text, F.lit(""))), ids).otherwise("")


def known_digests(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """(digest, license_id). ``texts``: a table (license_id, text) in place of the built-in licences."""
    if texts is None:
        texts = spark.createDataFrame(sorted(KNOWN.items()), "license_id string, text string")
        more = spark.createDataFrame([(d, i) for i, d in sorted(KNOWN_DIGESTS.items())], "digest string, license_id string")
    else:
        more = spark.createDataFrame([], "digest string, license_id string")
    form = canonical(F.col("text"))
    made = texts.select(F.sha2(form, 256).alias("digest"), F.col("license_id").cast("string").alias("license_id"), form.alias("form")).where("form != ''")
    return made.select("digest", "license_id").unionByName(more).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(spark: SparkSession, docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, canonical_chars, digest, license_id (null where no licence is known), notice_ids (of lines)."""
    known = known_digests(spark, texts).withColumnRenamed("digest", "_known")
    known = F.broadcast(known) if common.fits(known, MOST_BROADCAST) else known
    rows = docs.select("doc_id", canonical(F.col("text")).alias("form"), notice_ids(F.col("text"), _notice_digests(spark)).alias("notice_ids"))
    rows = rows.select("doc_id", F.length("form").cast("long").alias("canonical_chars"), F.sha2("form", 256).alias("digest"), "notice_ids")
    return rows.join(known, F.col("digest") == F.col("_known"), "left").select("doc_id", "canonical_chars", "digest", "license_id", "notice_ids")


def _sql_form(text: str) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWERED}')"
    notice = _NOTICE.replace("\n", "\\n").replace("\t", "\\t")
    gaps = "".join(f"\\x{{{ord(c):x}}}" if ord(c) > 127 else c for c in _GAPS)
    form = f"(' ' || trim(regexp_replace(regexp_replace({lowered}, {quoted(notice)}, '\\1', 'g'), {quoted(gaps)}, '  ', 'g')) || ' ')"
    for other, stands in EQUIVALENT.items():
        form = f"replace({form}, {quoted(' ' + other.replace(' ', '  ') + ' ')}, {quoted(' ' + stands.replace(' ', '  ') + ' ')})"
    return f"replace(trim({form}), '  ', ' ')"


def sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    texts = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in sorted(KNOWN.items()))
    digests = ", ".join(f"({quoted(i)}, {quoted(d)})" for i, d in sorted(KNOWN_DIGESTS.items()))
    lines = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in sorted(notices()))
    return f"""
WITH texts(license_id, text) AS (VALUES {texts}),
known AS (SELECT digest, MIN(license_id) AS license_id FROM (
  SELECT sha256(form) AS digest, license_id FROM (SELECT license_id, {_sql_form("text")} AS form FROM texts) WHERE form <> ''
  UNION ALL SELECT digest, license_id FROM (VALUES {digests}) AS t(license_id, digest)) GROUP BY digest),
notices(license_id, text) AS (VALUES {lines}),
named AS (SELECT form, MIN(license_id) AS license_id FROM (SELECT license_id, {_sql_form("text")} AS form FROM notices) GROUP BY form),
rows AS (SELECT *, ROW_NUMBER() OVER () AS row_no FROM documents),
lines AS (SELECT row_no, {_sql_form("line")} AS form FROM (SELECT row_no, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM rows) WHERE regexp_matches(line, '(?i)licen|spdx|creative commons')),
found AS (SELECT row_no, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids FROM lines JOIN named USING (form) GROUP BY row_no),
forms AS (SELECT doc_id, row_no, {_sql_form("text")} AS form FROM rows)
SELECT doc_id, CAST(length(form) AS BIGINT) AS canonical_chars, sha256(form) AS digest, license_id, coalesce(notice_ids, '') AS notice_ids
FROM forms LEFT JOIN known ON sha256(form) = known.digest LEFT JOIN found USING (row_no)
"""
