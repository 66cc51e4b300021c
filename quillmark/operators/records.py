"""Rows as they are read and written: scope and ticker rules, texts of companies, replies, runs, sheets of reviews, tables by name."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions import text as T
from quillmark.operators import matching
from quillmark.operators.relational import Refused, require_same_keys, require_unique

# Scopes about no company, words of a disclosure, headers inside a paragraph and their limits, a chat reply.
COMPANY_LESS = ("sector", "market_economy", "investing_general", "market", "economy")
DISCLOSURE_WORDS = (
    "(?i)\\b(?:or\\s+(?:its\\s+)?affiliates|an\\s+associate\\s+of|is\\s+a\\s+trustee\\s+of|investment\\s+banking\\s+client|within\\s+the\\s+past\\s+12\\s+months|employees?\\s+of\\s+\\w+\\s+own)\\b"
)
HEADED = "^\\s*([A-Z0-9][^\\n—–]{1,70}?)\\s*(\\([^)]{1,30}\\))?\\s*(?:[—–]|\\s-\\s|\\s--\\s)\\s*(?=\\S)"
INLINE = "(?<=[.!?\"”’])\\s+(?=[A-Z0-9][\\w&.'’-]*(?:(?:\\s?,\\s?|\\s)[\\w&.'’-]+){0,6}\\s?[—–]\\s?[A-Z0-9$])"
MOST_NAME_WORDS = 7
REPLY = "model string, choices array<struct<finish_reason:string,message:struct<content:string>>>, usage struct<prompt_tokens:bigint,completion_tokens:bigint>"
#: Verdicts of judges, by task.
VERDICTS = {
    "category": "label string, second string, rationale string", "faithfulness": "faithful boolean, one_story boolean, complete boolean, rationale string",
    "summary": "claims array<struct<text:string,status:string>>, main_kept boolean", "entities": "found array<string>, missed array<string>, wrong array<string>", "sentiment": "label string, rationale string",
}


def _blank(c: Column) -> Column:
    return F.coalesce(T.strip(c), F.lit("")) == ""


def reads_as_pair(scope: Column, ticker: Column) -> Column:
    """Whether a text is read with a company: it has a ticker, and its scope is not about none."""
    return ~_blank(ticker) & ~F.lower(T.strip(F.coalesce(scope, F.lit("")))).isin(*COMPANY_LESS)


def agrees_with_ticker(scope: Column, ticker: Column) -> Column:
    """A scope that is known has a ticker unless it is about no company."""
    without = F.lower(T.strip(scope)).isin(*COMPANY_LESS)
    return _blank(scope) | (_blank(ticker) == without)


def names_subject(text: Column, company: Column, ticker: Column) -> Column:
    """Whether a text names a company: its ticker as a word, or its name."""
    padded = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}_]+", " "), F.lit(" "))
    word = F.concat(F.lit(" "), F.regexp_replace(F.lower(T.strip(ticker)), "[^\\p{L}\\p{N}_]+", " "), F.lit(" "))
    key = T.normalize_name(company)
    by_ticker, by_name = ~_blank(ticker) & padded.contains(word), ~_blank(key) & T.normalize_name(text).contains(key)
    return F.coalesce(by_ticker, F.lit(False)) | F.coalesce(by_name, F.lit(False))


def contains_name(text: Column, name: Column) -> Column:
    return F.coalesce(~_blank(name) & F.lower(text).contains(F.lower(name)), F.lit(False))


def named_in(mentions: Column, wanted: Column) -> Column:
    return F.coalesce(F.arrays_overlap(mentions, wanted), F.lit(False))


def paragraphs(body: Column) -> Column:
    """Paragraphs, also where a header begins inside one; short ones and those that begin with a dash go."""
    parts = F.transform(F.split(F.regexp_replace(body, INLINE, "\n"), "\n+"), T.strip)
    return F.filter(parts, lambda p: (F.length(p) >= T.LEAST_SEGMENT) & ~p.rlike("^[—–]"))


def header_name(paragraph: Column) -> Column:
    """The name before a dash, with its ticker in brackets; null without a header or for a long name."""
    name, tick = F.regexp_extract(paragraph, HEADED, 1), F.coalesce(F.regexp_extract(paragraph, HEADED, 2), F.lit(""))
    ok = paragraph.rlike(HEADED) & (F.size(T.words(name)) <= MOST_NAME_WORDS)
    return F.when(ok, F.trim(F.concat(name, F.lit(" "), tick)))


def direct_mentions(rows: DataFrame, id_col: str, text: str, dictionary: matching.Dictionary) -> DataFrame:
    """(id, entity, n): mentions with a capital or a digit first, outside disclosures, lists of tickers and their boilerplate."""
    found = matching.found_spans(rows, id_col, text, dictionary)
    own = rows.select(F.col(id_col).alias("_i"), F.col(text).alias("_t"))
    each = found.join(own, F.col(id_col) == F.col("_i")).select(id_col, "_t", F.explode("spans").alias("s"))
    around = F.substring("_t", F.greatest(F.lit(1), F.col("s.start") + 1 - matching.WINDOW), F.col("s.end") - F.col("s.start") + 2 * matching.WINDOW)
    shown = F.substring("_t", F.col("s.start") + 1, F.lit(1)).rlike("^[\\p{Lu}\\p{N}$(]")
    kept = each.where(shown & F.col("s.disclosed").isNull() & ~around.rlike(DISCLOSURE_WORDS))
    return kept.groupBy(id_col, F.col("s.entity").alias("entity")).agg(F.count("*").alias("n"))


def company_texts(sentences: DataFrame, body: str, order: Sequence[str], named: str, chosen: str, score: str, threshold: float = 0.5) -> DataFrame:
    """(body, ticker, text): a company's sentences in order: those that name it, and those of no name that a model gives it.

    ``named``: an array of tickers; ``chosen``: the model's ticker for a sentence without one, at ``threshold`` or above.
    """
    given = F.when((F.size(named) == 0) & (F.col(score) >= threshold) & F.col(chosen).isNotNull(), F.array(chosen)).otherwise(F.col(named))
    each = sentences.withColumn("ticker", F.explode(given))
    joined = F.sort_array(F.collect_list(F.struct(*order, F.col("sentence").alias("_s"))))
    return each.groupBy(body, "ticker").agg(F.array_join(F.transform(joined, lambda x: x["_s"]), " ").alias("text"))


def run_time_decisions(sentences: DataFrame, candidates: DataFrame, names: DataFrame, body: str) -> DataFrame:
    """One row a (sentence without a name, candidate of its body): candidate, name, context (the sentence before), recent (the last company it names).

    ``sentences``: (body, position, sentence, mentions); ``candidates``: (body, ticker); ``names``: (ticker, name).
    """
    w = Window.partitionBy(body).orderBy("position")
    seen = sentences.withColumn("context", F.coalesce(F.lag("sentence").over(w), F.lit(""))).withColumn("_m", F.lag("mentions").over(w))
    bare = seen.where(F.size("mentions") == 0).withColumn("recent", F.coalesce(F.try_element_at("_m", F.lit(-1)), F.lit("")))
    known = candidates.join(names, "ticker").select(F.col(body).alias("_b"), F.col("ticker").alias("candidate"), "name")
    return bare.join(known, F.col(body) == F.col("_b")).select(body, "position", "candidate", "name", "context", "sentence", "recent")


def parsed_reply(reply: Column) -> Column:
    """A chat completion as (text, model, prompt_tokens, completion_tokens, error); what is none has an error and no text."""
    def read(d: Column) -> Column:
        text, usage = T.strip(d["choices"][0]["message"]["content"]), d["usage"]
        counted = usage["prompt_tokens"].isNotNull() & usage["completion_tokens"].isNotNull()
        error = (
            F.when(d.isNull() | text.isNull(), "the reply is not a chat completion").when(~F.coalesce(counted, F.lit(False)), "the reply has no usage")
            .when(d["choices"][0]["finish_reason"] == "length", "the reply was cut at the token limit").when(text == "", "the reply was empty")
        )
        return F.struct(F.when(error.isNull(), text).alias("text"), F.coalesce(d["model"], F.lit("")).alias("model"), usage["prompt_tokens"].alias("prompt_tokens"), usage["completion_tokens"].alias("completion_tokens"), error.alias("error"))

    return T.bound(F.from_json(F.when(reply.rlike("^\\s*\\{"), reply), REPLY), read)


def usage_of(calls: DataFrame) -> DataFrame:
    """Calls, tokens (0 where there are none) and the models seen."""
    return calls.agg(F.count("*").alias("calls"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens")], F.sort_array(F.collect_set("model")).alias("models"))


def decoded_scores(stored: Column) -> Column:
    """Stored scores as a map; refused (an error of the query) if the text is no object of numbers."""
    read = F.from_json(stored, "map<string,double>")
    return F.when(stored.isNull() | read.isNotNull(), read).otherwise(F.raise_error(F.concat(F.lit("scores are no object: "), F.substring(stored, 1, 80))).cast("map<string,double>"))


def verdict(reply: Column, task: str) -> Column:
    """A judge's reply by its task's schema; null if it does not parse."""
    return F.from_json(F.nullif(F.regexp_extract(reply, "(?s)\\{.*\\}", 0), F.lit("")), VERDICTS[task])


def claim_counts(claims: Column) -> Column:
    """Supported, contradicted and unsupported claims, and all."""
    n = lambda s: F.size(F.filter(claims, lambda c: c["status"] == s))
    return F.struct(n("supported").alias("supported"), n("contradicted").alias("contradicted"), n("unsupported").alias("unsupported"), F.size(claims).alias("claims"))


def weighted_mean(value: str, weight: str) -> Column:
    w = F.when(F.col(value).isNotNull(), F.col(weight))
    return F.sum(F.col(value).cast("double") * w) / F.nullif(F.sum(w), F.lit(0))


def selection_score(rates: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mean over classes and figures, an undefined one as 0."""
    means = [F.avg(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))) for c in columns]
    return rates.agg((sum(means[1:], means[0]) / len(columns)).alias("score"))


def pin_decision(verdicts: Mapping[str, str], score: str, guarded: Sequence[str]) -> tuple[bool, str]:
    """A candidate is taken if its score's gain is better and no guarded gain is worse or undefined; and why."""
    if verdicts[score] != "better":
        return False, f"the {score} gain is {verdicts[score]}, not better"
    failing = [f"the {name} gain is {verdicts[name]}" for name in guarded if verdicts[name] in ("not better", "undefined")]
    return (False, failing[0]) if failing else (True, f"the {score} gain is better and no guarded gain fails")


def at_most(share: float | None, bar: float, what: str) -> bool:
    """A rule on a point estimate; without one there is no rule."""
    if share is None or share != share:
        raise Refused(f"no {what} was judged: the rule has no figure")
    return share <= bar


def next_run(runs: DataFrame, run: Mapping[str, object]) -> tuple[int, DataFrame]:
    """The id after the largest, and the table with the new run. For a table that one writer holds."""
    number = (runs.agg(F.max("id")).first()[0] or 0) + 1
    row = {**{f.name: None for f in runs.schema}, **run, "id": number}
    return number, runs.unionByName(runs.sparkSession.createDataFrame([tuple(row[f.name] for f in runs.schema)], runs.schema))


def updated(rows: DataFrame, key: str, value: object, changes: Mapping[str, object]) -> DataFrame:
    """``rows`` with new values where the key has a value; refused if no row has it."""
    if not rows.where(F.col(key) == F.lit(value)).limit(1).count():
        raise Refused(f"no row with {key} {value!r}")
    return rows.select(*[F.when(F.col(key) == F.lit(value), F.lit(changes[f.name]).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in changes else F.col(f.name) for f in rows.schema])


def before(rows: DataFrame, column: str, value: str, revision: str | None = None) -> DataFrame:
    """What stays when the periods from ``value`` on are deleted, of one revision or of all."""
    gone = F.col(column) >= value
    return rows.where(~F.coalesce(gone & (F.col("model_revision") == revision) if revision is not None else gone, F.lit(False)))


def pruned_references(rows: DataFrame, column: str, parents: DataFrame, key: str, present: Sequence[str], absent: Sequence[str] = ()) -> DataFrame:
    """How many rows of each revision refer to a parent of a revision that is not kept."""
    owners = parents.select(F.col(key).cast("string").alias("_k"), F.col("model_revision").alias("_r"))
    met = rows.join(owners, F.col(column).cast("string") == F.col("_k"))
    lost = met.where(~F.col("_r").isin(*present) if present else F.lit(True))
    return (lost.where(~F.col("_r").isin(*absent)) if absent else lost).groupBy("_r").agg(F.count("*").alias("n")).withColumnRenamed("_r", "revision")


def with_overrides(constants: Mapping[str, str], table: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): constants, with the rows of a table in place of theirs or besides."""
    fixed = table.sparkSession.createDataFrame(sorted(constants.items()), "_k string, _v string")
    both = table.select(F.col(key).cast("string").alias("_tk"), F.col(value).cast("string").alias("_tv")).join(fixed, F.col("_tk") == F.col("_k"), "full")
    return both.select(F.coalesce("_tk", "_k").alias(key), F.coalesce("_tv", "_v").alias(value))


def with_translations(rows: DataFrame, key: str, translations: DataFrame, columns: Mapping[str, str], after: str) -> DataFrame:
    """Translated columns (new name to the translations' name) put behind one column; empty where there is none."""
    known = translations.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{n}") for n, c in columns.items()])
    joined = rows.join(known, F.col(key) == F.col("_k"), "left")
    names = rows.columns
    at = names.index(after) + 1
    return joined.select(*names[:at], *[F.coalesce(f"_{n}", F.lit("")).alias(n) for n in columns], *names[at:])


def zipped(a: DataFrame, b: DataFrame, key: str, position: str) -> DataFrame:
    """Two reviews of the same rows in the same order, side by side; refused if keys or places differ."""
    require_unique(a, [key])
    require_unique(b, [key])
    require_same_keys(a, b, [key])
    other = b.select(F.col(key).alias("_k"), F.col(position).alias("_p"), *[F.col(c) for c in b.columns if c not in (key, position) and c not in a.columns])
    both = a.join(other, F.col(key) == F.col("_k"))
    if both.where(~F.col(position).eqNullSafe(F.col("_p"))).limit(1).count():
        raise Refused("the reviews list the same rows in another order")
    return both.drop("_k", "_p")


def checked_marks(marks: DataFrame, texts: DataFrame, key: str, text: str, hash_col: str) -> DataFrame:
    """Marks with their texts and a state: ok, another text than was marked, or no text."""
    own = texts.select(F.col(key).alias("_k"), F.col(text).alias(text))
    both = marks.join(own, F.col(key) == F.col("_k"), "left")
    state = F.when(F.col("_k").isNull(), "no text").when(T.text_hash(F.col(text)) == F.col(hash_col), "ok").otherwise("other text")
    return both.withColumn("state", state).drop("_k")


def format_problems(rows: DataFrame, columns: Sequence[str], filled: Sequence[str]) -> list[str]:
    """What keeps rows from being a sheet: no rows, other columns or another order, and texts that are not filled."""
    found = [] if list(rows.columns) == list(columns) else [f"columns are {', '.join(rows.columns)}, not {', '.join(columns)}"]
    have = [c for c in filled if c in rows.columns]
    counts = rows.agg(F.count("*").alias("_n"), *[F.count_if(_blank(F.col(c))).alias(c) for c in have]).first()
    return ["no rows"] * (counts._n == 0) + found + [f"{c} is empty for {counts[c]} rows" for c in have if counts[c]]


def require_format(rows: DataFrame, name: str, columns: Sequence[str], filled: Sequence[str]) -> None:
    if problems := format_problems(rows, columns, filled):
        raise Refused(f"{name} is not written: " + "; ".join(problems))


def write_review(review: DataFrame, key: DataFrame, folder: str, names: tuple[str, str], tag: str) -> None:
    """A review and its key, both or neither; refused if a review there has a tag."""
    spark = review.sparkSession
    jvm = spark.sparkContext._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}") for n in names]
    fs = paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(paths[0]):
        old = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{folder}/{names[0]}")
        if tag in old.columns and (n := old.where(~_blank(F.col(tag))).count()):
            raise Refused(f"{names[0]} holds {n} tags")
    drafts = [jvm.org.apache.hadoop.fs.Path(f"{folder}/.draft-{n}") for n in names]
    for rows, draft in zip((review, key), drafts, strict=True):
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(draft.toString())
    for draft, path in zip(drafts, paths, strict=True):
        fs.delete(path, True)
        if not fs.rename(draft, path):
            raise Refused(f"{path.toString()} could not be written")


def relation(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """A table by a name that is allowed."""
    if name not in tables:
        raise Refused(f"no relation {name!r}: one of {', '.join(sorted(tables))}")
    return tables[name]


def matched_flags(rows: DataFrame, key: str, classes: DataFrame, flags: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows with the class their key has in another table (empty if none) and a flag for each set of classes."""
    known = classes.select(F.col(key).alias("_k"), F.col("match_class")).dropDuplicates(["_k"])
    out = rows.join(known, F.col(key) == F.col("_k"), "left").drop("_k").withColumn("match_class", F.coalesce("match_class", F.lit("")))
    return out.select("*", *[F.col("match_class").isin(*own).alias(n) for n, own in flags.items()])


def universe_rows(articles: DataFrame) -> DataFrame:
    """One row a ticker: the least of each attribute that is not empty, so that the choice does not hang on the engine."""
    least = lambda c: F.min(F.when(~_blank(F.col(c)), F.col(c))).alias(c)
    return articles.where(~_blank(F.col("ticker"))).groupBy("ticker").agg(*[least(c) for c in ("company", "gics_sector", "gics_sub_industry")])


def node_rows(universe: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct (sector, sub-industry) with the code of the sub-industry, empty if there is none."""
    from quillmark.operators.sheets import node_key

    known = codes.select(node_key(F.col("name")).alias("_k"), "code").groupBy("_k").agg(F.min("code").alias("code"))
    nodes = universe.where(~_blank(F.col("gics_sub_industry"))).select("gics_sector", "gics_sub_industry").distinct()
    return nodes.join(known, node_key(F.col("gics_sub_industry")) == F.col("_k"), "left").select("gics_sector", "gics_sub_industry", F.coalesce("code", F.lit("")).alias("code"))


def now_text() -> Column:
    """The moment the query began, in UTC, to the second."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def missing_years(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.count_if(~F.coalesce(F.col(column).cast("string"), F.lit("")).rlike("^[0-9]{4}")).alias("without_year"))


def sentences_of_tokens(rows: DataFrame, group: Sequence[str], order: str, token: str, label: str) -> DataFrame:
    """Token rows as one row a sentence with its tokens and labels in order; null tokens go."""
    own = F.sort_array(F.collect_list(F.struct(order, F.col(token).alias("t"), F.col(label).alias("l"))))
    by = rows.where(F.col(token).isNotNull()).groupBy(*group).agg(own.alias("_x"))
    return by.select(*group, F.transform("_x", lambda x: x["t"]).alias("tokens"), F.transform("_x", lambda x: x["l"]).alias("labels"))


def training_identity(train: DataFrame, validation: DataFrame, key: str, label: str, recipe: Mapping[str, object]) -> str:
    """A hash of what a training's results depend on: its examples, in any order, and its recipe."""
    def part(rows: DataFrame) -> list:
        h = F.xxhash64(F.col(key).cast("string"), F.col(label).cast("string")).cast("decimal(38,0)")
        r = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("h")).first()
        return [r.n, r.h]

    return hashlib.sha256(json.dumps({"train": part(train), "validation": part(validation), "recipe": dict(recipe)}, sort_keys=True, default=str).encode()).hexdigest()


def folder_identity(spark: SparkSession, folder: str, needed: Sequence[str], ignored: Sequence[str] = ()) -> str:
    """A hash of the names and contents of a folder's files; refused if it lacks one that is needed."""
    files = spark.read.format("binaryFile").load(f"{folder}/*").select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.sha2("content", 256).alias("h"))
    found = {r.name: r.h for r in files.collect() if r.name not in ignored}  # a model's few files
    if lacking := [n for n in needed if n not in found]:
        raise Refused(f"{folder} has no {', '.join(lacking)}")
    return hashlib.sha256(json.dumps(sorted(found.items())).encode()).hexdigest()[:16]
