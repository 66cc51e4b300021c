"""Text expressions: hashes, keys, splits and rule predicates as columns, all inside code generation."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as Python's ``str.split`` reads it; Java's ``\s`` is ASCII only.
SPACE = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
NO_SPACE = "[^" + SPACE[1:]
SENTENCE_BREAK = "(?<=[.!?])\\s+(?=[A-Z0-9\"'])"

#: Legal-form words dropped from a company name.
LEGAL_WORDS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "companies", "ltd", "limited", "plc", "llc", "lp", "holdings", "holding", "group", "sa", "nv", "ag", "se",
    "the", "class",
)
#: Words of a text on the market or the economy that names no company.
MARKET_TERMS = (
    "s&p 500", "dow jones", "nasdaq composite", "wall street", "stock market", "stocks", "index", "indexes", "indices", "futures", "rally", "sell-off", "selloff",
    "bull market", "bear market",
)
ECONOMY_TERMS = (
    "federal reserve", "fed", "inflation", "interest rates", "rate cut", "rate hike", "gdp", "recession", "unemployment", "jobs report", "payrolls",
    "consumer price index", "cpi", "treasury yields", "economy", "economic", "tariffs",
)
#: Headlines of round-ups, site furniture, and notes that imply a scope.
ROUNDUP = (
    "(?i)biggest moves|early movers|\\bmovers\\b|stocks making|after[- ]hours buzz|premarket|pre-market|midday|stocks to watch|things to (?:know|watch)|what to watch|"
    "week ahead|market wrap|morning brief|top stocks|stocks? (?:that|to) buy|these stocks|stock picks"
)
BOILERPLATE = (
    "(?i)[^.\\n]*(?:compiled by FactSet|according to FactSet|FactSet (?:data|estimates)|data (?:from|by|provided by) FactSet|Got a confidential news tip|Sign up for|"
    "Subscribe to|Click here|Disclosure:|Related Tickers)[^.\\n]*[.\\n]?"
)
MULTI_NOTE = "(?i)multiple companies|many companies|other company|two companies|two stocks|comparison"
SECTOR_NOTE = "(?i)sector|industry"
MARKET_NOTE = "(?i)econom|s&p ?500|market (?:trent|trend|behavior)|marked behavior"
UNRELATED_LABELS = ("unrelated", "non-related", "not-related")
SUMMARY_CHARS = 2000
LEAST_SEGMENT = 20
CHUNK_WORDS = 120


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends. Single spaces, which are most runs, are passed over."""
    return F.trim(F.regexp_replace(text, f"{SPACE.replace('x20', 'x1f')}{SPACE}*| {SPACE}+", " "))


def strip(text: Column) -> Column:
    """A run of white space is read once: only its first character can begin a match at the end."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}(?<!{SPACE}{SPACE}){SPACE}*+\\z", "")


def body_hash(text: Column) -> Column:
    """Copies that differ only in spacing share it."""
    return F.sha2(collapse(text), 256)


def short_hash(text: Column) -> Column:
    return F.substring(body_hash(text), 1, 32)


def text_hash(text: Column) -> Column:
    return F.sha2(strip(text), 256)


def source_hash(title: Column, text: Column) -> Column:
    return F.sha2(F.concat(title, F.lit("\n"), text), 256)


def _accent_table() -> tuple[str, str]:
    """Letters that decompose to one ASCII letter and marks, and those letters."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(a, b[0]) for a, b in pairs if len(b) > 1 and b[0].isascii() and all(unicodedata.combining(x) for x in b[1:])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accent_table()


def fold_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, ACCENTED, PLAIN), "[\\u0300-\\u036f]", "")


def _without(words: Column, dropped: Iterable[str]) -> Column:
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*dropped)), " ")


def normalize_name(name: Column) -> Column:
    """A company name without accents, share class, punctuation and legal-form words."""
    lowered = F.regexp_replace(F.replace(F.lower(fold_accents(name)), F.lit(".com"), F.lit("")), "\\bclass\\s+[a-z]\\b", " ")
    return _without(F.split(F.regexp_replace(lowered, "[^a-z0-9& ]+", " "), " +"), LEGAL_WORDS)


def squash_initials(key: Column) -> Column:
    return F.regexp_replace(key, "\\b([a-z0-9]) (?=[a-z0-9]\\b)", "$1")


def form_key(form: Column) -> Column:
    """The key of a short form: lower case, one space for spaces, commas, hyphens, apostrophes."""
    return F.trim(F.regexp_replace(F.lower(form), "[ \\xa0\\t,'`\\u00b4\\u2019\\u2013\\u2014-]+", " "))


def title_key(title: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", " "))


def slug_of(url: Column) -> Column:
    """The last path segment without query, fragment and ``.html``."""
    path = F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "/+$", "")
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), "\\.html?$", "")


def company_name(name: Column) -> Column:
    return F.split(name, " \\(").getItem(0)


def company_segment(name: Column) -> Column:
    return F.substring(collapse(name), 1, 80)


def fragment(title: Column, text: Column, chars: int = 800) -> Column:
    return F.concat(title, F.lit(". "), F.substring(text, 1, chars))


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, SENTENCE_BREAK), lambda s: s != "")


def segments(text: Column) -> Column:
    """Paragraphs of some length, in order: from the first to the last character of a line that is not white space."""
    return F.regexp_extract_all(text, F.lit(f"{NO_SPACE}[^\\n]{{{LEAST_SEGMENT - 2}}}[^\\n]*{NO_SPACE}"), F.lit(0))


def segment_text(text: Column, index: int) -> Column:
    return F.try_element_at(segments(text), F.lit(index + 1))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def bound(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, also where ``f`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), f), 1)


def word_chunks(text: Column, size: int = CHUNK_WORDS) -> Column:
    """Consecutive runs of ``size`` words."""
    def cut(w: Column) -> Column:
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, F.lit(size)), " "))

    return bound(words(text), cut)


def runs(text: Column, width: int) -> Column:
    """All runs of ``width`` words, joined by single spaces."""
    none = F.array().cast("array<string>")
    starts = lambda w: F.sequence(F.lit(1), F.size(w) - width + 1)
    return bound(words(text), lambda w: F.when(F.size(w) >= width, F.transform(starts(w), lambda i: F.array_join(F.slice(w, i, F.lit(width)), " "))).otherwise(none))


def shingles(text: Column, width: int = 8, sample: int = 8) -> Column:
    """A 1-in-``sample`` choice of the CRC32 of runs of ``width`` words."""
    hashes = F.transform(runs(F.lower(text), width), lambda r: F.crc32(r))
    return F.array_distinct(F.filter(hashes, lambda h: F.pmod(h, F.lit(sample)) == 0))


def whole_word(terms: Sequence[str]) -> str:
    """A pattern of any of the terms as whole words, longest first."""
    return "(?i)(?<![\\w&])(?:" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) + ")(?![\\w&])"


def keyword_hits(text: Column, terms: Sequence[str]) -> Column:
    return F.regexp_count(text, F.lit(whole_word(terms))) if terms else F.lit(0)


def strip_boilerplate(text: Column) -> Column:
    """Tried only where a stretch between full stops and line ends begins, which is where every match begins: a stretch is read once."""
    return F.regexp_replace(text, BOILERPLATE.replace("(?i)", "(?i)(?:\\A|(?<=[.\\n]))", 1), " ")


def is_roundup(title: Column, slug: Column, title_companies: Column, ticker_forms: Column) -> Column:
    return title.rlike(ROUNDUP) | F.replace(slug, F.lit("-"), F.lit(" ")).rlike(ROUNDUP) | (title_companies >= 3) | (ticker_forms >= 5)


def keyword_scope(text: Column, sector_terms: Sequence[str] = (), least: int = 2) -> Column:
    """Of a text that names no company: the scope with most keyword hits; a tie goes to economy, then market."""
    economy, market, sector = keyword_hits(text, ECONOMY_TERMS), keyword_hits(text, MARKET_TERMS), keyword_hits(text, sector_terms)
    best = F.greatest(economy, market, sector)
    return F.when(best < least, "no_company").when(economy == best, "economy").when(market == best, "market").otherwise("sector")


def scope_of(companies: Column, total: Column, top: Column, roundup: Column, text: Column, sector_terms: Sequence[str] = ()) -> Column:
    """The rule-based scope from mention counts."""
    return (
        F.when(roundup, "roundup").when(total == 0, keyword_scope(text, sector_terms)).when(companies == 1, "single").when(2 * top > total, "multi_dominated").otherwise("multi")
    )


def gold_scope(label: Column, note: Column) -> Column:
    label = F.lower(strip(label))
    return (
        F.when(label.isin(*UNRELATED_LABELS), "unrelated").when(note.rlike(MARKET_NOTE), "market_economy").when(note.rlike(SECTOR_NOTE), "sector")
        .when((label == "miscellany") | note.rlike(MULTI_NOTE), "multi").when(label == "other", "investing_general").otherwise("single")
    )


def combine_scope(topic: Column, single_multi: Column) -> Column:
    """The second stage decides only where the first says company."""
    return F.when(topic != "company", topic).otherwise(single_multi)


def needs_summary(text: Column, chars: int = SUMMARY_CHARS) -> Column:
    return F.when(F.length(text) > chars, "summary").otherwise("original")


def spreadsheet_safe(cell: Column) -> Column:
    """A cell that a spreadsheet would run as a formula, quoted."""
    return F.when(cell.rlike("^\\s*[=+\\-@\\t\\r]"), F.concat(F.lit("'"), cell)).otherwise(cell)


def split_list(cell: Column) -> Column:
    return F.filter(F.transform(F.split(cell, ","), strip), lambda x: x != "")


def bare_digit(text: Column) -> Column:
    return text.rlike("^[0-9]$")


def length_bucket(n: Column, edges: Sequence[int]) -> Column:
    """The number of edges at or below ``n``."""
    return sum((F.when(n >= e, 1).otherwise(0) for e in edges), F.lit(0))


def count_bucket(n: Column) -> Column:
    return F.when(n <= 2, n.cast("string")).when(n <= 5, "3-5").when(n <= 10, "6-10").otherwise("11+")


def is_fragment(piece: Column) -> Column:
    return (F.length(piece) < 80) & ~piece.rlike("[.!?][\"')”]?$")


def singular(word: Column) -> Column:
    return F.regexp_replace(word, "s$", "")


def year_or_unknown(date: Column) -> Column:
    return F.when(date.rlike("^[0-9]{4}"), F.substring(date, 1, 4)).otherwise("unknown")


def summary_input(row: dict[str, Column]) -> Column:
    """The template of one record for a summary: metadata, features, body."""
    return F.concat(
        F.lit("METADATA:\nTicker-"), row["ticker"], F.lit("\nCompany-"), row["company"], F.lit("\n\nNLP FEATURES:\nSentiment-"), row["label"], F.lit(" Confidence-"),
        row["score"].cast("string"), F.lit("\nEntities-"), row["entities"], F.lit("\n\nTEXT BODY:\nTitle-"), row["title"], F.lit("\nBody-"), row["body"],
    )


def mask(text: Column, pattern: str, token: str = "[COMPANY]") -> Column:
    return F.regexp_replace(text, pattern, token.replace("$", "\\$"))
