"""Queries over orders, events and dimensions: periods, state, revisions, golden reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions import dates as D
from quillmark.functions import stats as S
from quillmark.functions import structures as N
from quillmark.operators import periods, relational, sampling, state

from . import corpus
from .registry import query, table

#: A 21-day grid over the orders, in UTC so that DuckDB needs no zone tables; the zone rule has tests of its own.
GRID = {"first": "1992-01-06", "days": 21, "zone": "UTC"}
WEEK = {"first": "2024-01-01", "days": 7, "zone": "UTC"}
_PERIOD = "CAST(greatest(0, ceil((epoch({d}) - epoch(TIMESTAMP '{f} 15:00:00')) / ({n} * 86400.0))) AS INTEGER)"


def _at(date: str, grid=GRID) -> str:
    return _PERIOD.format(d=date, f=grid["first"], n=grid["days"])


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    """Order facts with a company (customer), its sector (nation) and made-up labels."""
    orders = table(spark, sf, "orders").withColumn("date", F.col("o_orderdate").cast("timestamp"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("company"), F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("sector"))
    category = F.expr("CASE WHEN o_orderpriority LIKE '1%' THEN 'product_innovation' WHEN o_orderpriority LIKE '2%' THEN 'earnings_performance' ELSE 'market_analyst_sentiment' END")
    sentiment = F.expr("CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'neutral' ELSE 'negative' END")
    return orders.join(customers, "o_custkey").join(nations, "n_nationkey").select("o_orderkey", "date", "company", "sector", category.alias("category"), sentiment.alias("sentiment"))


_FACTS = f"""facts AS (SELECT o_orderkey, o_orderdate AS date, c_mktsegment AS company, n_name AS sector, {_at('o_orderdate')} AS period,
CASE WHEN o_orderpriority LIKE '1%' THEN 'other' WHEN o_orderpriority LIKE '2%' THEN 'earnings_performance' ELSE 'market_analyst_sentiment' END AS category,
CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'neutral' ELSE 'negative' END AS sentiment
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""
_COUNTS = "count(*) AS total, count(*) FILTER (WHERE sentiment = 'neutral') AS neutral, count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment = 'negative') AS negative"


def _cells(spark, sf) -> DataFrame:
    return periods.tally(periods.assign(_facts(spark, sf), "date", **GRID), "company", "sector", "category", "sentiment")


@query("SELECT event_type, user_id, event_id, ts FROM events QUALIFY ts = max(ts) OVER (PARTITION BY event_type)")
def latest_runs(spark, sf):
    return relational.latest(table(spark, sf, "events"), ["event_type"], "ts").select("event_type", "user_id", "event_id", "ts")


@query("SELECT event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 2")
def previous_headline(spark, sf):
    rows = relational.nth_latest(table(spark, sf, "events"), ["event_type"], [F.desc("ts"), F.desc("event_id")], 2)
    return rows.select("event_type", "event_id", "value")


@query("SELECT event_type, count(*) AS n, count(DISTINCT CAST(user_id AS VARCHAR) || ':' || event_type) AS keys, max(ts) AS newest FROM events GROUP BY event_type")
def status_counts(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct(F.concat_ws(":", F.col("user_id").cast("string"), "event_type")).alias("keys"), F.max("ts").alias("newest"))


@query("""WITH p AS (SELECT doc_id, CASE WHEN doc_id NOT IN (SELECT page_id FROM pages) THEN 'no_text' WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN 'no_category'
WHEN doc_id NOT IN (SELECT conv_id FROM conversations) THEN 'no_sentiment' END AS waiting FROM documents WHERE doc_id % 10 <> 3) SELECT coalesce(waiting, 'ready') AS waiting, count(*) AS n FROM p GROUP BY 1""")
def ready_waiting(spark, sf):
    """Pairs by the first thing they wait for; every tenth is written already."""
    item = lambda df, key, *more: df.select(F.lit("body").alias("item_kind"), F.col(key).cast("string").alias("item_id"), F.lit("X").alias("ticker"), *more)
    docs = table(spark, sf, "documents")
    out = state.ready_and_waiting(
        item(docs, "doc_id"), item(table(spark, sf, "pages"), "page_id", F.col("url").alias("summary_text")), item(table(spark, sf, "labels"), "doc_id", F.col("quality").alias("category")),
        item(table(spark, sf, "conversations"), "conv_id", F.col("role").alias("sentiment")), item(docs.where("doc_id % 10 = 3"), "doc_id"),
    )
    return out.groupBy(F.coalesce("waiting", F.lit("ready")).alias("waiting")).agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, coalesce(min(CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END), '') AS pub, strftime(min(o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS crawled,
arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, bool_or(o_totalprice > 300000) AS flag FROM orders GROUP BY o_custkey""")
def earliest_dates(spark, sf):
    stamp = D.stamp(F.col("o_orderdate").cast("timestamp"))
    dates = {"pub": F.when(F.col("o_orderstatus") != "P", stamp).otherwise(""), "crawled": stamp}
    return relational.earliest(table(spark, sf, "orders"), "o_custkey", "o_orderkey", dates, "o_orderpriority", F.col("o_totalprice") > 300000)


@query("""SELECT date_source, count(*) AS n FROM (SELECT CASE WHEN pub <> '' AND NOT late THEN 'published' WHEN late THEN 'crawled_future_pub' ELSE 'crawled' END AS date_source FROM (
SELECT CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'x' END AS pub, o_orderstatus <> 'P' AND o_orderkey % 5 = 0 AS late FROM orders)) GROUP BY date_source""")
def date_source(spark, sf):
    """Every fifth publication date is set two days after its crawl, and so does not count."""
    crawled = D.stamp(F.col("o_orderdate").cast("timestamp"))
    shifted = D.stamp(F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 2 DAY"))
    pub = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderkey") % 5 == 0, shifted).otherwise(crawled)
    rows = table(spark, sf, "orders").select(D.pub_date(pub).alias("pub"), D.crawl_date(crawled).alias("crawled"))
    rows = rows.withColumn("future", D.published_after_crawl(F.col("pub"), F.col("crawled")))
    rows = rows.withColumn("pub", F.when(F.col("future"), "").otherwise(F.col("pub")))
    return rows.groupBy(D.date_source(F.col("pub"), F.col("future")).alias("date_source")).agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE json_extract_string(props, '$.k') IS DISTINCT FROM '7') AS k, count(*) FILTER (WHERE json_extract_string(props, '$.missing') IS DISTINCT FROM 'x') AS missing FROM events")
def stale_rows(spark, sf):
    return state.stale(table(spark, sf, "events"), {"k": "7", "missing": "x"}, "props")


@query("SELECT coalesce(json_extract_string(props, '$.k'), 'unknown') AS date_source, count(*) AS n FROM events GROUP BY 1")
def snapshot_date_sources(spark, sf):
    return table(spark, sf, "events").groupBy(F.coalesce(F.get_json_object("props", "$.k"), F.lit("unknown")).alias("date_source")).agg(F.count("*").alias("n"))


@query(f"SELECT {_at('o_orderdate')} AS period, count(*) AS n, min(o_orderkey) AS least FROM orders GROUP BY 1")
def period_assign(spark, sf):
    rows = periods.assign(table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("timestamp")), "d", **GRID)
    return rows.groupBy("period").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"))


@query(f"WITH {_FACTS} SELECT period, 'company' AS kind, company AS key, category, {_COUNTS} FROM facts GROUP BY period, company, category UNION ALL SELECT period, 'sector', sector, category, {_COUNTS} FROM facts GROUP BY period, sector, category")
def period_counts_company_sector(spark, sf):
    return _cells(spark, sf)


@query(f"""WITH e AS (SELECT *, {_at('ts', WEEK)} AS date_period, greatest({_at('ts', WEEK)}, {_at("ts + to_days(CAST(event_id % 10 AS INTEGER))", WEEK)}) AS period FROM events)
SELECT period, event_type, count(*) AS n, count(*) FILTER (WHERE period > date_period) AS late FROM e GROUP BY period, event_type""")
def period_late_items(spark, sf):
    """Events that arrive up to nine days after their date count in the window that is open then."""
    rows = table(spark, sf, "events").withColumn("d", F.col("ts").cast("timestamp")).withColumn("a", F.col("ts").cast("timestamp") + F.make_dt_interval(days=(F.col("event_id") % 10).cast("int")))
    out = periods.assign(rows, "d", "a", **WEEK)
    return out.groupBy("period", "event_type").agg(F.count("*").alias("n"), F.sum(F.col("late").cast("int")).alias("late"))


@query(f"""SELECT 3 AS period, event_type, count(*) AS n, count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-15 15:00:00') AS late FROM events
WHERE ts <= TIMESTAMP '2024-01-22 15:00:00' AND NOT ({_at('ts', WEEK)} < 3 AND event_id % 4 <> 0) GROUP BY event_type""")
def period_write_next(spark, sf):
    """The fourth window, when three quarters of the earlier rows are counted already."""
    rows = table(spark, sf, "events").withColumn("d", F.col("ts").cast("timestamp"))
    counted = periods.assign(rows, "d", **WEEK).where("period < 3 and event_id % 4 <> 0")
    out = periods.write_next(rows, counted, ["event_id"], "d", 3, **WEEK)
    return out.groupBy("period", "event_type").agg(F.count("*").alias("n"), F.sum(F.col("late").cast("int")).cast("long").alias("late"))


@query(f"""SELECT CAST(p AS INTEGER) AS period FROM (SELECT unnest(range(0, CAST(floor((epoch(max(ts)) - epoch(TIMESTAMP '2024-01-01 15:00:00')) / 604800.0) AS BIGINT) + 1)) AS p FROM events) WHERE p % 2 = 1""")
def period_catch_up(spark, sf):
    rows = table(spark, sf, "events")
    now = rows.agg(F.max("ts").cast("timestamp").alias("now"))
    written = spark.range(0, 1000, 2).select(F.col("id").cast("int").alias("period"))
    return periods.to_write(written, D.last_index(F.col("now"), **WEEK), now)


@query("SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'override' ELSE n_name END AS sector FROM customer JOIN nation ON n_nationkey = c_nationkey")
def sector_override(spark, sf):
    base = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("n_name").alias("sector"))
    return relational.override(base, base.where("c_custkey % 9 = 0").select("c_custkey", F.lit("override").alias("sector")), "c_custkey", "sector")


def _summaries(spark, sf) -> DataFrame:
    return periods.summaries(_cells(spark, sf))


@query(f"WITH {_FACTS} SELECT period, company AS ticker, category, {_COUNTS} FROM facts GROUP BY period, company, category")
def golden_json_explode(spark, sf):
    """Stored nested counts back to rows."""
    rows = _summaries(spark, sf).where("kind = 'company'").select("period", F.col("key").alias("ticker"), F.explode(N.counts_rows(F.col("counts"))).alias("c"))
    return rows.select("period", "ticker", F.col("c.key").alias("category"), "c.value.*")


@query(f"WITH {_FACTS} SELECT period, company AS ticker, count(*) AS news, round((count(*) FILTER (WHERE sentiment = 'positive') - count(*) FILTER (WHERE sentiment = 'negative')) * 1.0 / nullif(count(*), 0), 9) AS net_sentiment FROM facts GROUP BY period, company")
def golden_net_sentiment(spark, sf):
    sums = golden_json_explode(spark, sf).groupBy("period", "ticker").agg(F.sum("total").alias("news"), F.sum(F.col("positive") - F.col("negative")).alias("net"))
    return sums.select("period", "ticker", "news", F.round(S.ratio(F.col("net"), F.col("news")), 9).alias("net_sentiment"))


@query(f"WITH {_FACTS} SELECT period, CASE WHEN sector IN (SELECT n_name FROM nation WHERE n_nationkey < 20) THEN lower(sector) ELSE 'unclassified' END AS sector, category, CAST(sum(total) AS BIGINT) AS total FROM (SELECT period, sector, category, count(*) AS total FROM facts GROUP BY period, sector, category) GROUP BY 1, 2, 3")
def golden_counts_per_sector(spark, sf):
    names = table(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_name").alias("key"), F.lower("n_name").alias("name"))
    rows = _summaries(spark, sf).where("kind = 'sector'").select("period", "key", F.explode(N.counts_rows(F.col("counts"))).alias("c"))
    rows = rows.join(F.broadcast(names), "key", "left")  # a dimension of at most 20 rows
    return rows.groupBy("period", F.coalesce("name", F.lit("unclassified")).alias("sector"), F.col("c.key").alias("category")).agg(F.sum("c.value.total").alias("total"))


@query("SELECT o_orderkey, o_orderdate AS date, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-02-01' ORDER BY o_orderdate, o_orderkey")
def golden_range(spark, sf):
    rows = table(spark, sf, "orders").where("o_orderdate >= timestamp_ntz'1995-01-01' and o_orderdate < timestamp_ntz'1995-02-01'")
    return rows.select("o_orderkey", F.col("o_orderdate").alias("date"), "o_orderpriority").orderBy("date", "o_orderkey")


@query(f"WITH {_FACTS} SELECT DISTINCT period, strftime(TIMESTAMP '{GRID['first']} 15:00:00' + to_days(CAST(21 * period AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS period_end, CASE WHEN period > 0 THEN strftime(TIMESTAMP '{GRID['first']} 15:00:00' + to_days(CAST(21 * (period - 1) AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') END AS period_start FROM facts")
def golden_periods(spark, sf):
    rows = periods.assign(_facts(spark, sf), "date", **GRID).select("period").distinct()
    end = lambda k: D.stamp(D.cut_utc(k, **GRID))
    return rows.select("period", end(F.col("period")).alias("period_end"), F.when(F.col("period") > 0, end(F.col("period") - 1)).alias("period_start"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND CAST(o_custkey % 7 AS INTEGER) + 1 = l_linenumber")
def golden_item_join(spark, sf):
    """A composite equi-join of items and facts."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    facts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), ((F.col("o_custkey") % 7).cast("int") + 1).alias("l_linenumber"), "o_orderstatus")
    return items.join(facts, ["l_orderkey", "l_linenumber"])


@query(f"WITH {_FACTS}, c AS (SELECT 'company' AS kind, company AS key, {_COUNTS} FROM facts WHERE period = 20 GROUP BY company UNION ALL SELECT 'sector', sector, {_COUNTS} FROM facts WHERE period = 20 GROUP BY sector) SELECT kind, key, kind || ' ' || key || ': ' || total || ' (+' || positive || ' / -' || negative || ')' AS line FROM c")
def period_render(spark, sf):
    return periods.render(_cells(spark, sf), 20)


@query(f"SELECT period, ticker, count(*) AS not_counted FROM (SELECT {_at('o_orderdate')} AS period, o_orderpriority AS ticker FROM orders WHERE o_orderstatus = 'O') GROUP BY period, ticker")
def period_gaps(spark, sf):
    pairs = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("timestamp").alias("d"))
    return periods.gaps(pairs.drop("o_orderstatus"), pairs.where("o_orderstatus <> 'O'").drop("o_orderstatus"), ["o_orderkey"], "d", **GRID)


@query("""SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events GROUP BY user_id, event_type""")
def upsert_latest(spark, sf):
    """The later half of the events upserted into the state after the earlier half."""
    rows = table(spark, sf, "events").withColumn("seq", F.struct("ts", "event_id"))
    key, half = ["user_id", "event_type"], "coalesce(ts < timestamp_ntz'2024-01-15', true)"
    stored = state.upsert(rows.limit(0), rows.where(half), key, "seq")
    return state.upsert(stored, rows.where(f"not ({half})"), key, "seq").select("user_id", "event_type", "value", "ts")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type <> (SELECT min(event_type) FROM events) GROUP BY event_type")
def partition_reset(spark, sf):
    rows = table(spark, sf, "events")
    least = rows.agg(F.min("event_type").alias("t")).first().t
    return state.reset(rows, least, "event_type").groupBy("event_type").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT CAST(user_id AS VARCHAR) AS item_id, event_type AS step, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS finished_at, count(*) AS attempts FROM events GROUP BY 1, 2)
SELECT item_id, step, finished_at, CAST(attempts AS INTEGER) AS attempts FROM s""")
def step_state(spark, sf):
    """State after two batches of outcomes: attempts add up and the latest outcome holds."""
    rows = table(spark, sf, "events").select(
        F.lit("body").alias("item_kind"), F.col("user_id").cast("string").alias("item_id"), F.col("event_type").alias("step"), F.lit("r1").alias("model_revision"),
        F.lit("done").alias("status"), F.lit(None).cast("string").alias("error"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("finished_at"), "ts",
    )
    half = "ts < timestamp_ntz'2024-01-15'"
    empty = rows.limit(0).drop("ts").withColumn("attempts", F.lit(0))
    one = state.advance(empty, rows.where(half).drop("ts"))
    return state.advance(one, rows.where(f"not ({half})").drop("ts")).select("item_id", "step", "finished_at", "attempts")


@query("SELECT event_type AS model_revision, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS first_seen FROM events GROUP BY event_type")
def revisions(spark, sf):
    rows = table(spark, sf, "events").select(F.lit("s").alias("step"), F.col("event_type").alias("model_revision"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("finished_at"))
    return state.revisions(rows, "s")


@query("""WITH v AS (SELECT n_name AS nation, n_regionkey AS sector, s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey),
c AS (SELECT sector, sum(least(n, 3)) AS votes FROM (SELECT sector, nation, count(*) AS n FROM v GROUP BY sector, nation) GROUP BY sector)
SELECT CAST(max(votes) AS BIGINT) AS best, CASE WHEN count(*) FILTER (WHERE votes = (SELECT max(votes) FROM c)) > 1 THEN '' ELSE arg_max(CAST(sector AS VARCHAR), votes) END AS top FROM c""")
def vote_top(spark, sf):
    """Suppliers of a nation are its mentions, three at most; regions are sectors; a tie elects nobody."""
    from quillmark.operators.matching import votes

    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    counts = rows.groupBy(F.lit(1).alias("id"), F.col("n_name").alias("entity")).agg(F.count("*").alias("n"))
    groups = table(spark, sf, "nation").select(F.col("n_name").alias("entity"), F.col("n_regionkey").cast("string").alias("sector"))
    return votes(counts, groups, "id").select("best", "top")


@query(f"SELECT {_at('ts', WEEK)} AS period, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_periods(spark, sf):
    import uuid

    from quillmark.streaming import streams

    return streams.period_counts(spark, f"{sf}/events.parquet", _work(spark, uuid.uuid4().hex), "ts", "event_type", **WEEK)


@query(corpus.UNIQUE_BODIES)
def stream_pending_bodies(spark, sf):
    import uuid

    from quillmark.streaming import streams

    return streams.pending_bodies(spark, f"{sf}/documents.parquet", _work(spark, uuid.uuid4().hex), "doc_id", "text")


def _work(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint folder; in a local session without one, a temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        import tempfile

        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quillmark-")
    return f"{base.rstrip('/')}/quillmark-stream/{name}"


@query("SELECT count(*) AS n, min(o_orderkey) AS least, max(o_orderkey) AS most, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders")
def store_fingerprint(spark, sf):
    return relational.fingerprint(table(spark, sf, "orders"), "o_orderkey").withColumn("total", F.col("total").cast("long"))


@query("""SELECT * FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderstatus = 'P' DESC, md5('7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS r FROM orders) WHERE r <= 25""")
def stratified_quota(spark, sf):
    """25 of each stratum, some first."""
    rows = sampling.quota(table(spark, sf, "orders"), "o_orderpriority", "o_orderkey", 25, 7, F.col("o_orderstatus") == "P")
    w = Window.partitionBy("o_orderpriority").orderBy(F.desc(F.col("o_orderstatus") == "P"), sampling.order("o_orderkey", 7), "o_orderkey")
    return rows.select("o_orderpriority", "o_orderkey", F.row_number().over(w).cast("long").alias("r"))


@query("SELECT o_orderkey FROM orders ORDER BY md5('11:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 200")
def hash_sample(spark, sf):
    return sampling.seeded(table(spark, sf, "orders"), "o_orderkey", 200, 11).select("o_orderkey")


@query("SELECT o_orderkey, CAST(CAST('0x' || substr(md5('5:' || CAST(o_custkey AS VARCHAR)), 1, 12) AS BIGINT) % 5 AS INTEGER) AS fold FROM orders")
def group_kfold(spark, sf):
    return sampling.group_folds(table(spark, sf, "orders"), "o_custkey", 5, 5).select("o_orderkey", "fold")


@query("""SELECT p_partkey, CASE WHEN part_at < 0.1 THEN 'test' WHEN part_at < 0.2 THEN 'validation' ELSE 'train' END AS split FROM (SELECT p_partkey, (row_number() OVER (PARTITION BY p_brand ORDER BY md5('3:' || CAST(p_partkey AS VARCHAR)), p_partkey) - 1) / CAST(count(*) OVER (PARTITION BY p_brand) AS DOUBLE) AS part_at FROM part)""")
def stratified_split(spark, sf):
    return sampling.split(table(spark, sf, "part"), "p_brand", "p_partkey", 0.1, 0.1, 3).select("p_partkey", "split")


@query("SELECT p_partkey, CAST(ceil(row_number() OVER (PARTITION BY p_brand ORDER BY md5('4:' || CAST(p_partkey AS VARCHAR)), p_partkey) / 10.0) AS INTEGER) AS block FROM part")
def balanced_blocks(spark, sf):
    return sampling.blocks(table(spark, sf, "part"), "p_brand", "p_partkey", 10, 4).select("p_partkey", "block")


@query("SELECT p_partkey FROM part WHERE p_partkey % 16 = 3")
def systematic_sample(spark, sf):
    """Every sixteenth part (the sampling operator's own residue)."""
    return sampling.systematic(table(spark, sf, "part"), "p_partkey", 16, 3).select("p_partkey")
