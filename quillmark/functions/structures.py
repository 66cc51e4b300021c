"""Array, map and JSON expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNTS = "map<string,struct<total:bigint,neutral:bigint,positive:bigint,negative:bigint>>"


def class_scores(stored: Column) -> Column:
    """A stored score object without its reserved keys."""
    return F.map_filter(F.from_json(stored, "map<string,double>"), lambda k, _: ~k.startswith("_"))


def stored_number(stored: Column, key: str) -> Column:
    return F.coalesce(F.get_json_object(stored, f"$.{key}").cast("int"), F.lit(0))


def first_object(reply: Column, schema: str) -> Column:
    """The outermost braces of a reply, read by a schema; null if they do not parse."""
    return F.from_json(F.nullif(F.regexp_extract(reply, "(?s)\\{.*\\}", 0), F.lit("")), schema)


def parse_labels(cell: Column, labels: Sequence[str], ignored: Sequence[str] = ("uncertain",)) -> Column:
    known = F.filter(F.transform(F.split(cell, "[,;]"), lambda x: F.trim(x)), lambda x: x.isin(*labels))
    return F.array_distinct(F.filter(known, lambda x: ~x.isin(*ignored)))


def ranked(scores: Column) -> Column:
    """Entries of a score map, highest first, then by name."""
    return F.array_sort(F.map_entries(scores), lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))


def predict_set(scores: Column, least: float, share: float, most: int = 3) -> Column:
    """The top label and others at or above a score and a share of the top's."""
    order = ranked(scores)
    top = order[0]["value"]
    more = F.filter(F.slice(order, 2, 1000), lambda e: (e["value"] >= least) & (e["value"] >= top * share))
    return F.transform(F.slice(F.concat(F.slice(order, 1, 1), more), 1, most), lambda e: e["key"])


def set_by_thresholds(scores: Column, cuts: Mapping[str, float], most: int = 3) -> Column:
    """Labels at or above their own cut; the top label if there are none."""
    cut = F.create_map(*[x for k, v in cuts.items() for x in (F.lit(k), F.lit(v))])
    order = ranked(scores)
    over = F.filter(order, lambda e: e["value"] >= F.coalesce(F.try_element_at(cut, e["key"]), F.lit(0.5)))
    return F.transform(F.when(F.size(over) > 0, F.slice(over, 1, most)).otherwise(F.slice(order, 1, 1)), lambda e: e["key"])


def merged(scores: Column, mapping: Mapping[str, Sequence[str]]) -> Column:
    """Columns of labels that stand for several: the largest of theirs."""
    return F.create_map(*[x for label, own in mapping.items() for x in (F.lit(label), F.greatest(*[scores[o] for o in own]) if len(own) > 1 else scores[own[0]])])


def merge_labels(labels: Column, renamed: Mapping[str, str]) -> Column:
    names = F.create_map(*[F.lit(x) for kv in renamed.items() for x in kv])
    return F.array_distinct(F.transform(labels, lambda x: F.coalesce(F.try_element_at(names, x), x)))


def group_share(scores: Column, group_of: Mapping[str, str], label: Column) -> Column:
    """The share of all score mass that the label's group holds."""
    groups = F.create_map(*[F.lit(x) for kv in group_of.items() for x in kv])
    mass = lambda entries: F.aggregate(entries, F.lit(0.0), lambda s, e: s + e["value"])
    entries = F.map_entries(scores)
    own = F.filter(entries, lambda e: groups[e["key"]] == groups[label])
    total = mass(entries)
    return mass(own) / F.when(total == 0, 1.0).otherwise(total)


def gate(scores: Column, sectors: Sequence[str], votes_top: Column, margin: float) -> Column:
    """Status, class, candidate and margin: a sector leads by the margin, or its companies vote for it."""
    order = ranked(scores)
    lead = order[0]["value"] - order[1]["value"]
    ok = order[0]["key"].isin(*sectors) & ((lead >= margin) | (votes_top == order[0]["key"]))
    return F.struct(F.when(ok, "assigned").otherwise("out_of_scope").alias("status"), F.when(ok, order[0]["key"]).otherwise("").alias("sector"), order[0]["key"].alias("candidate"), lead.alias("margin"))


def counts_rows(counts: Column) -> Column:
    """Rows (key, value) of stored nested counts; use with ``explode``."""
    return F.map_entries(F.from_json(counts, COUNTS))


def null_if_nan(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def not_in_disclosure(spans: Column, windows: Column) -> Column:
    """Spans that no window contains."""
    return F.filter(spans, lambda s: ~F.exists(windows, lambda w: (w["start"] <= s["start"]) & (s["end"] <= w["end"])))
