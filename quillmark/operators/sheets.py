"""Sheets that people mark: list cells, names to identifiers, codes of a hierarchy, and the checks of whole files.

Cells are taken apart by array expressions. Names are looked up by a join with a book of keys, a table made from the
universe and its other names, so a sheet of any size and a universe of any size meet by hash. What a person typed and
nothing knows stays as typed and is reported.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import text as T

#: Words that are also identifiers, and first words that name somebody outside the universe.
WORD_IDS = (
    "ALL", "ARE", "COO", "MET", "FANG", "RMD", "APP", "MAS", "AFL", "PEG", "BALL", "BEN", "CAT", "COST", "DAY", "FAST", "HAS", "KEY", "LOW", "MAR", "NOW", "PEAK", "TECH", "WELL", "DOW",
    "FOX", "FOXA", "IT", "ON", "BE", "ES", "EG", "ED", "PM",
)
NOT_FIRST_WORDS = ("snap", "motorola")
LEAST_FIRST_WORD = 3
CODE_LENGTHS = (2, 4, 6, 8)
MOST_JOINED = 4


def split_list(cell: Column) -> Column:
    """Items between commas or line feeds; a piece that is only a legal form goes on with the item before it."""
    pieces = F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), "[,\n]"), T.strip), lambda p: p != "")
    alone = lambda p: T.normalize_name(F.split(p, ":")[0]) == ""
    # each piece with the number of items that have begun by then; pieces of one number are one item
    begun = F.transform(pieces, lambda p, i: F.when((i > 0) & alone(p), 0).otherwise(1))

    def grouped(x: Column) -> Column:
        count = F.aggregate(x["begun"], F.lit(0), lambda a, b: a + b)
        number = F.transform(x["begun"], lambda _, i: F.aggregate(F.slice(x["begun"], 1, i + 1), F.lit(0), lambda a, b: a + b))
        own = lambda k: F.filter(F.arrays_zip(x["pieces"].alias("p"), number.alias("n")), lambda z: z["n"] == k)
        items = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.transform(own(k), lambda z: z["p"]), ", "))
        return F.when(count > 0, items).otherwise(F.array().cast("array<string>"))

    return T.bound(F.struct(pieces.alias("pieces"), begun.alias("begun")), grouped)


def folded_key(name: Column) -> Column:
    """The key of a name on a sheet: quotes, accents and dashes folded, a possessive written together."""
    plain = F.translate(F.lower(name), "’é–", "'e-")
    return F.trim(T.normalize_name(F.replace(F.regexp_replace(plain, "'s\\b", "s"), F.lit("'"), F.lit(""))))


def name_book(universe: DataFrame, nicknames: DataFrame | None = None, brands: DataFrame | None = None, class_of: Mapping[str, str] | None = None) -> DataFrame:
    """(key, ids, note): what each key leads to. ``universe``: (id, name, canonical); the others: (id, form).

    A first word leads to the names that begin with it, unless it is a name; a nickname settles how a key was inferred, a
    brand is for its owner to confirm. ``class_of`` sends a share class to the one that its names stand for.
    """
    spark = universe.sparkSession
    classes = spark.createDataFrame(list((class_of or {}).items()) or [("", "")], "_from string, _to string")
    own = universe.join(F.broadcast(classes), F.col("canonical") == F.col("_from"), "left").select("id", "name", F.coalesce("_to", "canonical").alias("target"))
    names = own.select(folded_key(F.col("name")).alias("key"), "target", F.lit("").alias("note")).where("key <> ''")
    head = F.split("key", " ")[0]
    firsts = names.where((F.size(F.split("key", " ")) > 1) & (F.length(head) >= LEAST_FIRST_WORD) & ~head.isin(*NOT_FIRST_WORDS))
    firsts = firsts.select(head.alias("key"), "target", F.lit("first word").alias("note")).join(names.select("key"), "key", "left_anti")
    parts = names.unionByName(firsts)
    for table, note in ((nicknames, ""), (brands, "brand")):
        if table is not None:
            forms = table.join(own.select(F.col("id").alias("_id"), "target"), F.upper("id") == F.upper("_id"))
            parts = parts.unionByName(forms.select(folded_key(F.col("form")).alias("key"), "target", F.lit(note).alias("note")).where("key <> ''"))
    # a key that a name or a nickname has needs no confirmation
    note = F.when(F.bool_or(F.col("note") == ""), "").otherwise(F.min(F.col("note")))
    return parts.groupBy("key").agg(F.sort_array(F.collect_set("target")).alias("ids"), note.alias("note"))


def looked_up(rows: DataFrame, text: str, book: DataFrame, universe: DataFrame) -> DataFrame:
    """``rows`` with found (an id or null), why (there is none) and note (for the owner to confirm).

    In this order: an identifier in capitals, a key of the book, an identifier in another case.
    """
    raw = F.regexp_replace(T.strip(F.col(text)), "^\\$+|\\$+$", "")
    ids = universe.select(F.upper("id").alias("_id"), F.col("canonical").alias("_canonical")).dropDuplicates(["_id"])
    keys = book.select(F.col("key").alias("_key"), F.col("ids").alias("_ids"), F.col("note").alias("_note"))
    out = rows.withColumn("_raw", raw).withColumn("_k", folded_key(F.col("_raw"))).join(ids, F.upper("_raw") == F.col("_id"), "left").join(keys, F.col("_k") == F.col("_key"), "left")
    capital = (F.col("_raw") == F.upper("_raw")) & (F.col("_raw") != F.lower("_raw"))
    written = F.col("_id").isNotNull() & capital
    one, many = F.coalesce(F.size("_ids"), F.lit(0)) == 1, F.coalesce(F.size("_ids"), F.lit(0)) > 1
    word = (F.length("_raw") == 1) | F.col("_raw").isin(*WORD_IDS)
    empty = F.col("_raw") == ""
    found = F.when(empty, None).when(written, F.col("_canonical")).when(one, F.col("_ids")[0]).when(many, None).otherwise(F.col("_canonical"))
    why = F.when(empty, "empty").when(written | one, None).when(many, F.concat(F.lit("ambiguous: "), F.array_join("_ids", ", "))).when(F.col("_id").isNull(), "unknown")
    note = F.when(empty, "").when(written, F.when(word, "word ticker").otherwise("")).when(one, F.col("_note")).when(many, "").when(F.col("_id").isNotNull(), "ticker, other case").otherwise("")
    return out.withColumn("found", found).withColumn("why", why).withColumn("note", note).drop("_raw", "_k", "_id", "_canonical", "_key", "_ids", "_note")


def _pieces(rows: DataFrame, id_col: str, cell: str) -> DataFrame:
    return rows.select(id_col, F.posexplode(split_list(F.col(cell))).alias("position", "piece"))


def rewritten_list(rows: DataFrame, id_col: str, cell: str, book: DataFrame, universe: DataFrame) -> DataFrame:
    """(id, cell, problems, confirm): a list cell as identifiers, each once, then what is not known as it was typed."""
    found = looked_up(_pieces(rows, id_col, cell), "piece", book, universe)
    first = found.where("found is not null").groupBy(id_col, "found").agg(F.min("position").alias("position"))
    known = first.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("position", "found"))).alias("known"))
    quoted = F.concat(F.lit(f"{cell}: '"), F.col("piece"), F.lit("'"))
    rest = found.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.when(F.col("found").isNull(), F.struct("position", F.col("piece").alias("piece"))))).alias("kept"),
        F.sort_array(F.collect_list(F.when(F.col("found").isNull(), F.struct("position", F.concat(quoted, F.lit(" "), "why").alias("t"))))).alias("problems"),
        F.sort_array(F.collect_list(F.when(F.col("note") != "", F.struct("position", F.concat(quoted, F.lit(" -> "), "found", F.lit(" ("), "note", F.lit(")")).alias("t"))))).alias("confirm"),
    )
    none = F.array().cast("array<string>")
    texts = lambda c, f: F.coalesce(F.transform(c, lambda x: x[f]), none)
    out = rows.select(id_col).join(rest, id_col, "left").join(known, id_col, "left")
    return out.select(id_col, F.array_join(F.concat(texts("known", "found"), texts("kept", "piece")), ", ").alias(cell), texts("problems", "t").alias("problems"), texts("confirm", "t").alias("confirm"))


def labelled(cell: Column) -> Column:
    """Items ``name:label`` as (name, label, whole); the last colon parts them, without one the label is null."""
    cut = lambda p: F.struct(
        T.strip(F.when(p.contains(":"), F.regexp_extract(p, "(?s)^(.*):", 1))).alias("name"), T.strip(F.when(p.contains(":"), F.regexp_extract(p, "(?s):([^:]*)$", 1))).alias("label"), p.alias("whole")
    )
    return F.transform(split_list(cell), cut)


def rewritten_labels(rows: DataFrame, id_col: str, cell: str, book: DataFrame, universe: DataFrame) -> DataFrame:
    """(id, cell, problems): ``name:label`` items with identifiers, a company's labels together, then what is not known as typed."""
    items = rows.select(id_col, F.posexplode(labelled(F.col(cell))).alias("position", "x")).select(id_col, "position", "x.*")
    found = looked_up(items.withColumn("name", F.coalesce("name", F.lit(""))), "name", book, universe)
    found = found.withColumn("found", F.when(F.col("label").isNotNull(), F.col("found")))
    first = found.where("found is not null").groupBy(id_col, "found").agg(F.min("position").alias("_first"))
    ordered = found.join(first, [id_col, "found"], "left")
    said = F.when(F.col("found").isNotNull(), F.concat("found", F.lit(":"), "label")).otherwise(F.col("whole"))
    why = F.when(F.col("label").isNull(), F.concat(F.lit(f"{cell}: '"), "whole", F.lit("' has no label"))).when(F.col("found").isNull(), F.concat(F.lit(f"{cell}: '"), "name", F.lit("' "), "why"))
    out = ordered.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col("found").isNull().alias("u"), F.coalesce("_first", "position").alias("f"), "position", said.alias("t")))).alias("ts"),
        F.sort_array(F.collect_list(F.when(why.isNotNull(), F.struct("position", why.alias("t"))))).alias("ps"),
    )
    none = F.array().cast("array<string>")
    texts = lambda c: F.coalesce(F.transform(c, lambda x: x["t"]), none)
    return rows.select(id_col).join(out, id_col, "left").select(id_col, F.array_join(texts("ts"), ", ").alias(cell), texts("ps").alias("problems"))


def label_map(cell: Column) -> Column:
    """``A:x, A:y, B:z`` as a map of arrays, in order; items without a label are left out."""
    items = F.filter(labelled(cell), lambda x: x["label"].isNotNull())
    names = F.array_distinct(F.transform(items, lambda x: x["name"]))
    of = lambda n: F.transform(F.filter(items, lambda x: x["name"] == n), lambda x: F.lower(x["label"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n, of(n))))


def node_key(name: Column) -> Column:
    """The key of a node's name: case, marks and ``&`` or ``and`` do not matter."""
    return F.trim(F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit("and")), "[^a-z0-9]+", " "))


def resolved_codes(rows: DataFrame, id_col: str, cell: str, codes: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, codes, problems): nodes of a hierarchy given as codes of any level, names, or identifiers of their members.

    ``codes``: (code, name) of the lowest level; ``companies``: (id, name of its node). A name may hold commas: the longest
    run of pieces that is a node is one, tried from each piece that no run before it took.
    """
    pieces = rows.select(id_col, split_list(F.col(cell)).alias("ps"))
    at = pieces.select(id_col, "ps", F.explode(F.sequence(F.lit(1), F.greatest(F.size("ps"), F.lit(1)))).alias("i")).where(F.col("i") <= F.size("ps"))
    runs = at.select(id_col, "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(MOST_JOINED), F.size("ps") - F.col("i") + 1))).alias("n"), "ps")
    runs = runs.select(id_col, "i", "n", F.array_join(F.slice("ps", F.col("i"), F.col("n")), ", ").alias("t"))
    prefixes = codes.select(F.explode(F.array(*[F.substring("code", 1, n) for n in CODE_LENGTHS])).alias("_code")).distinct()
    names = codes.select(node_key(F.col("name")).alias("_key"), F.col("code").alias("_of")).groupBy("_key").agg(F.min("_of").alias("_of"))
    members = companies.select(F.upper("id").alias("_id"), node_key(F.col("node")).alias("_member")).join(names.select(F.col("_key").alias("_mk"), F.col("_of").alias("_mof")), F.col("_member") == F.col("_mk"))
    members = members.groupBy("_id").agg(F.min("_mof").alias("_mof"))
    found = runs.join(prefixes, F.col("t") == F.col("_code"), "left").join(names, node_key(F.col("t")) == F.col("_key"), "left").join(members, F.upper("t") == F.col("_id"), "left")
    hit = found.select(id_col, "i", "n", F.coalesce("_code", "_of", "_mof").alias("code")).where("code is not null")
    best = hit.groupBy(id_col, "i").agg(F.max(F.struct("n", "code")).alias("b"))
    marked = at.select(id_col, "i", F.element_at("ps", F.col("i")).alias("piece")).join(best, [id_col, "i"], "left")
    listed = marked.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("b.n", F.lit(1)).alias("n"), F.col("b.code").alias("code"), "piece"))).alias("xs"))
    # a run hides the pieces it takes
    end = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1))["i"] + F.try_element_at(a, F.lit(-1))["n"], F.lit(0))
    taken = F.aggregate("xs", F.slice("xs", 1, 0), lambda a, x: F.when(x["i"] >= end(a), F.concat(a, F.array(x))).otherwise(a))
    out = listed.withColumn("xs", taken)
    none = F.array().cast("array<string>")
    got = F.transform(F.filter("xs", lambda x: x["code"].isNotNull()), lambda x: x["code"])
    bad = F.transform(F.filter("xs", lambda x: x["code"].isNull()), lambda x: F.concat(F.lit("'"), x["piece"], F.lit("' is not a code, name or ticker")))
    twice = F.transform(F.filter(F.array_distinct(got), lambda c: F.size(F.filter(got, lambda d: d == c)) > 1), lambda c: F.concat(c, F.lit(": listed twice")))
    out = out.select(id_col, got.alias("codes"), F.concat(bad, twice).alias("problems"))
    return rows.select(id_col).join(out, id_col, "left").select(id_col, F.coalesce("codes", none).alias("codes"), F.coalesce("problems", none).alias("problems"))


def scope_problems(scope: Column, companies: Column, nodes: Column, scopes: Mapping[str, str]) -> Column:
    """What a scope's number of companies breaks. ``scopes``: each scope's rule: one, many, none or any; "sector" among them needs a node."""
    rule = F.create_map(*[F.lit(x) for kv in scopes.items() for x in kv])[F.lower(T.strip(scope))]
    checks = (
        (rule.isNull(), "scope is not known"), ((rule == "one") & (companies != 1), "needs exactly 1 labelled company"), ((rule == "many") & (companies < 2), "needs 2 or more labelled companies"),
        ((rule == "none") & (companies > 0), "analyses no company"), ((F.lower(T.strip(scope)) == "sector") & (nodes == 0), "a sector body needs a node"),
    )
    return F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in checks]), lambda x: x.isNotNull())


def file_report(rows: DataFrame, id_col: str, tagged: Column, problems: str, expected: DataFrame) -> DataFrame:
    """One row an id, typed or expected, with its state: good, bad, untagged, missing, duplicated or unknown."""
    own = rows.select(F.col(id_col).cast("string").alias("id"), F.coalesce(tagged, F.lit(False)).alias("_tagged"), (F.size(problems) > 0).alias("_bad"))
    by = own.groupBy("id").agg(F.count("*").alias("n"), F.bool_or("_tagged").alias("_tagged"), F.bool_or("_bad").alias("_bad"))
    wanted = expected.select(F.col(expected.columns[0]).cast("string").alias("_e")).distinct()
    both = by.join(wanted, F.col("id") == F.col("_e"), "full")
    state = (
        F.when(F.col("id").isNull() & F.col("_e").isNotNull(), "missing").when(F.col("_e").isNull(), "unknown").when(F.col("n") > 1, "duplicated")
        .when(~F.col("_tagged"), "untagged").when(F.col("_bad"), "bad").otherwise("good")
    )
    return both.select(F.coalesce("id", "_e").alias("id"), state.alias("state"))


def migrated(rows: DataFrame, id_col: str, labels: str, legacy: str) -> DataFrame:
    """(id, labels, problems): a sheet of the first format, in which companies had a column of their own and semicolons parted items."""
    items = lambda c: split_list(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit(";"), F.lit(",")))
    name = lambda p: F.lower(T.strip(F.when(p.contains(":"), F.regexp_extract(p, "(?s)^(.*):", 1)).otherwise(p)))
    own = rows.select(id_col, items(labels).alias("ls"), items(legacy).alias("cs"))
    own = own.withColumn("new", F.filter("cs", lambda c: ~F.array_contains(F.transform("ls", name), F.lower(c))))
    all_ = F.concat("ls", "new")
    unlabelled = F.transform(F.filter(all_, lambda p: ~p.contains(":")), lambda p: F.concat(F.lit("'"), p, F.lit("' has no label")))
    return own.select(id_col, F.array_join(all_, ", ").alias(labels), F.concat(F.transform("new", lambda c: F.concat(F.lit("'"), c, F.lit("' had no entry"))), unlabelled).alias("problems"))


def disagreements(book: DataFrame, universe: DataFrame, class_of: Mapping[str, str] | None = None) -> DataFrame:
    """Names of the universe that do not lead to their own identifier: (id, name, found, why)."""
    classes = universe.sparkSession.createDataFrame(list((class_of or {}).items()) or [("", "")], "_from string, _to string")
    want = universe.join(F.broadcast(classes), F.col("canonical") == F.col("_from"), "left").withColumn("_want", F.coalesce("_to", "canonical"))
    found = looked_up(want, "name", book, universe)
    return found.where(~F.col("found").eqNullSafe(F.col("_want"))).select("id", "name", "found", "why")


def partial_columns(rows: DataFrame, columns: Sequence[str]) -> list[str]:
    """What keeps a table from being a sheet: other columns, another order, or a row without one of the shown texts."""
    if list(rows.columns) != list(columns):
        return [f"columns are {', '.join(rows.columns)}, not {', '.join(columns)}"]
    return []
