"""Date expressions. The session's zone is UTC; dates are text ``yyyy-MM-ddTHH:mm:ssZ`` where they are stored."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STAMP_SHAPE = "^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z$"
ZONED = "^\\d{4}-\\d{2}-\\d{2}[T ]\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,6})?)?(Z|[+-]\\d{2}:?\\d{2})$"
#: Fixed values of the period grid: the first end, the length, and the wall time of a cut.
FIRST_END = "2022-01-03"
PERIOD_DAYS = 21
CUT_HOUR = 15
ZONE = "America/New_York"


def stamp_ok(value: Column) -> Column:
    return value.rlike(STAMP_SHAPE)


def stamp(moment: Column) -> Column:
    return F.date_format(moment, STAMP)


def crawl_date(value: Column) -> Column:
    """An ISO date with a zone as a UTC stamp; without a zone, or no date, the empty text."""
    return F.when(stamp_ok(value), value).otherwise(F.coalesce(F.when(value.rlike(ZONED), stamp(F.try_to_timestamp(value))), F.lit("")))


def pub_date(value: Column) -> Column:
    """ISO 8601 or RFC 2822 as a UTC stamp; without a zone it is UTC; outside 1990 to 2100 it is none."""
    v = F.trim(value)
    plain = F.regexp_replace(v, "^[A-Za-z]{3},? +", "")
    numbered = F.regexp_replace(plain, " (GMT|UTC|UT|Z)$", " +0000")
    parsed = F.coalesce(
        F.when(v.rlike("^\\d{4}-"), F.try_to_timestamp(v)),
        F.when(numbered.rlike("^\\d{1,2} [A-Za-z]{3} \\d{4} "), F.coalesce(F.try_to_timestamp(numbered, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(numbered, F.lit("d MMM yyyy HH:mm:ss")))),
    )
    return F.when(stamp_ok(v), v).otherwise(F.coalesce(F.when(F.year(parsed).between(1990, 2100), stamp(parsed)), F.lit("")))


def published_after_crawl(published: Column, crawled: Column) -> Column:
    late = F.try_to_timestamp(published) > F.try_to_timestamp(crawled) + F.expr("INTERVAL 1 DAY")
    return (published != "") & (crawled != "") & F.coalesce(late, F.lit(False))


def effective_date(published: Column, crawled: Column) -> Column:
    return F.when(published != "", published).otherwise(crawled)


def date_source(published: Column, future: Column) -> Column:
    return F.when(published != "", "published").when(future, "crawled_future_pub").otherwise("crawled")


def period_date(index: Column, first: str = FIRST_END, days: int = PERIOD_DAYS) -> Column:
    return F.date_add(F.lit(first).cast("date"), (index * days).cast("int"))


def cut_utc(index: Column, zone: str = ZONE, first: str = FIRST_END, days: int = PERIOD_DAYS) -> Column:
    """The end of a period: the cut hour by the zone's wall clock, as a UTC timestamp."""
    local = period_date(index, first, days).cast("timestamp") + F.make_interval(hours=F.lit(CUT_HOUR))
    return F.to_utc_timestamp(local, zone)


def index_of(day: Column, first: str = FIRST_END, days: int = PERIOD_DAYS) -> Column:
    """The index of the period that ends on ``day``; null off the grid."""
    delta = F.datediff(day, F.lit(first).cast("date"))
    return F.when((delta >= 0) & (delta % days == 0), F.floor(delta / days))


def period_of(moment: Column, zone: str = ZONE, first: str = FIRST_END, days: int = PERIOD_DAYS) -> Column:
    """The first period whose cut is at or after ``moment``: windows are open at the start and closed at the end."""
    guess = F.greatest(F.lit(0), F.floor((F.datediff(moment.cast("date"), F.lit(first).cast("date")) - 1) / days))
    step = lambda k: F.when(cut_utc(guess + k, zone, first, days) >= moment, guess + k)
    return F.coalesce(step(0), step(1), guess + 2).cast("int")


def last_index(now: Column, zone: str = ZONE, first: str = FIRST_END, days: int = PERIOD_DAYS) -> Column:
    """The last period whose cut has passed; -1 if none has."""
    near = F.floor(F.datediff(now.cast("date"), F.lit(first).cast("date")) / days)
    ok = lambda k: F.when((near + k >= 0) & (cut_utc(near + k, zone, first, days) <= now), near + k)
    return F.coalesce(ok(1), ok(0), ok(-1), F.lit(-1)).cast("int")


def year_of(date: Column) -> Column:
    return F.when(date.rlike("^[0-9]{4}"), F.substring(date, 1, 4).cast("int"))


def year_month(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")
