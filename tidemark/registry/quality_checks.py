"""Data-quality operators on the benchmark tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import quality as q
from ..session import stored
from ..sources.tables import as_catalogue
from .base import TABLES, cents, query, sql_cents, table
from .shaping import BUCKETED_SQL, DAILY_DIMENSIONS_SQL, bucketed, daily_dimensions

LINE = ["l_orderkey", "l_linenumber"]


# --- duplicates -----------------------------------------------------------

@query("key_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def key_duplicates(spark, d):
    return q.key_duplicates(table(spark, d, "lineitem"), LINE)


@query("top_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 50""")
def top_duplicates(spark, d):
    return q.key_duplicates(table(spark, d, "lineitem"), LINE, top=50)


@query("duplicate_summary", """
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
       count(*) FILTER (n > 1) AS duplicate_groups,
       CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS extra_rows,
       count(*) FILTER (lang IS NULL OR quality IS NULL) AS keys_with_gap,
       CAST(coalesce(sum(n) FILTER (lang IS NULL OR quality IS NULL), 0) AS BIGINT) AS rows_with_gap
FROM (SELECT lang, source, quality, count(*) AS n
      FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2, 3)""")
def duplicate_summary(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(table(spark, d, "labels"), "doc_id", "left")
    return q.key_duplicate_summary(labelled, ["lang", "source", "quality"])


@query("mark_duplicates", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_day,
       {sql_cents('l_extendedprice')} AS price_cents,
       count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem""")
def mark_duplicates(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("ship_day"),
        cents("l_extendedprice").alias("price_cents"))
    return q.mark_duplicates(rows, LINE)


@query("duplicate_days", f"""
SELECT ship_day, count(*) AS rows, count(DISTINCT l_partkey) AS distinct_values,
       count(*) FILTER (n > 1) AS dup_rows, CAST(sum(price_cents) AS BIGINT) AS price_cents
FROM (SELECT CAST(l_shipdate AS DATE) AS ship_day, l_partkey, {sql_cents('l_extendedprice')} AS price_cents,
             count(*) OVER (PARTITION BY CAST(l_shipdate AS DATE), l_returnflag, l_partkey) AS n
      FROM lineitem)
GROUP BY 1""")
def duplicate_days(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("ship_day"), "l_returnflag", "l_partkey",
        cents("l_extendedprice").alias("price_cents"))
    return q.duplicate_days(rows, "ship_day", ["l_returnflag"], "l_partkey", ["price_cents"])


# --- comparison -----------------------------------------------------------

def _daily(spark, d):
    return table(spark, d, "events").select(
        F.col("ts").cast("date").alias("day"), "event_type", "value",
        cents("value").alias("value_cents"))


@query("old_vs_new", f"""
WITH e AS (SELECT CAST(ts AS DATE) AS day, event_type, value, {sql_cents('value')} AS c FROM events),
n AS (SELECT day, event_type, count(*) AS new_rows, CAST(sum(c) AS BIGINT) AS new_value_cents
      FROM e WHERE value > 10 GROUP BY 1, 2),
o AS (SELECT day, event_type, count(*) AS old_rows, CAST(sum(c) AS BIGINT) AS old_value_cents
      FROM e WHERE value < 40 OR event_type = 'view' GROUP BY 1, 2)
SELECT * FROM n FULL JOIN o USING (day, event_type)""")
def old_vs_new(spark, d):
    rows = _daily(spark, d)
    return q.compare_full(rows.filter((F.col("value") < 40) | (F.col("event_type") == "view")),
                          rows.filter(F.col("value") > 10), ["day", "event_type"], ["value_cents"])


@query("reconcile", f"""
WITH mart AS (SELECT day, dimension_type, CAST(sum(value_cents) AS BIGINT) AS m
              FROM ({BUCKETED_SQL}) GROUP BY 1, 2),
raw AS (SELECT day, dimension_type, CAST(sum(value_cents) AS BIGINT) AS r
        FROM ({DAILY_DIMENSIONS_SQL}) GROUP BY 1, 2)
SELECT dimension_type, count(*) AS compared, count(*) FILTER (m <> r) AS mismatched
FROM mart JOIN raw USING (day, dimension_type) GROUP BY 1""")
def reconcile(spark, d):
    """The bucketed mart must add up to the raw rows, day by day."""
    rows = stored(daily_dimensions(spark, d), "dimensions")
    return q.reconcile(bucketed(spark, d, rows), rows,
                       ["day", "dimension_type"], "value_cents", ["dimension_type"])


TRUTH_SQL = """
WITH truth AS (SELECT CAST(ts AS DATE) AS day, count(*) AS true_rows,
                      count(DISTINCT user_id) * (day(ts) % 7) AS true_users FROM events GROUP BY 1, day(ts)),
new AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users
        FROM events WHERE value > 5 GROUP BY 1),
old AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users
        FROM events WHERE event_type = 'view' AND value > 30 AND day(ts) > 9 GROUP BY 1)
"""


def _truth(spark, d):
    rows = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    counts = [F.count("*").alias("n"), F.count_distinct("user_id").alias("users")]
    truth = rows.groupBy("day").agg(*counts).select(
        "day", F.col("n").alias("true_rows"),
        (F.col("users") * (F.dayofmonth("day") % 7)).alias("true_users"))
    old = rows.filter((F.col("event_type") == "view") & (F.col("value") > 30)
                      & (F.dayofmonth("day") > 9))
    actuals = {"new": rows.filter(F.col("value") > 5).groupBy("day").agg(*counts),
               "old": old.groupBy("day").agg(*counts)}
    return q.versus_truth(truth, actuals, ["day"], {"true_rows": "n", "true_users": "users"})


def _pct(value: str, base: str) -> str:
    return f"100.0::DOUBLE * ({value} - {base}) / nullif({base}, 0)::DOUBLE"


@query("ground_truth", f"""{TRUTH_SQL}
SELECT truth.day, true_rows, true_users, new.n AS new_n, new.users AS new_users, old.n AS old_n,
       old.users AS old_users, {_pct('new.n', 'true_rows')} AS new_n_pct,
       {_pct('new.users', 'true_users')} AS new_users_pct, {_pct('old.n', 'true_rows')} AS old_n_pct,
       {_pct('old.users', 'true_users')} AS old_users_pct
FROM truth LEFT JOIN new ON new.day = truth.day LEFT JOIN old ON old.day = truth.day""")
def ground_truth(spark, d):
    """Known daily figures against two measurements; base 0 and missing days give NULL."""
    return _truth(spark, d)


@query("ground_truth_totals", f"""{TRUTH_SQL}
SELECT count(*) AS days, CAST(sum(true_rows) AS BIGINT) AS true_rows,
       CAST(sum(true_users) AS BIGINT) AS true_users, CAST(sum(old.n) AS BIGINT) AS n,
       CAST(sum(old.users) AS BIGINT) AS users,
       100.0::DOUBLE * CAST(sum(old.n) - sum(true_rows) AS BIGINT) / CAST(sum(true_rows) AS DOUBLE) AS n_pct,
       100.0::DOUBLE * CAST(sum(old.users) - sum(true_users) AS BIGINT)
         / CAST(sum(true_users) AS DOUBLE) AS users_pct
FROM truth JOIN old ON old.day = truth.day""")
def ground_truth_totals(spark, d):
    return q.truth_totals(_truth(spark, d), "old", {"true_rows": "n", "true_users": "users"})


# --- fill and profile -----------------------------------------------------

_FILLED = ["text", "source", "n_chars", "quality", "toxic"]


@query("fill_rate", " UNION ALL ".join(f"""
SELECT lang, '{f}' AS field, count(*) AS filled
FROM documents LEFT JOIN labels USING (doc_id)
WHERE {f} IS NOT NULL AND CAST({f} AS VARCHAR) <> '' GROUP BY 1""" for f in _FILLED))
def fill_rate(spark, d):
    labelled = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return q.fill_rate(labelled, ["lang"], _FILLED)


_PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]


@query("numeric_profile", " UNION ALL ".join(f"""
SELECT l_returnflag, '{f}' AS field, CAST(min(v) AS DOUBLE) AS min,
       CAST(max(v) FILTER (i = n // 2 + 1) AS DOUBLE) AS median, CAST(max(v) AS DOUBLE) AS max,
       max(n) AS n
FROM (SELECT l_returnflag, {f} AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY {f}) AS i,
             count(*) OVER (PARTITION BY l_returnflag) AS n
      FROM lineitem WHERE {f} IS NOT NULL)
GROUP BY 1""" for f in _PROFILED))
def numeric_profile(spark, d):
    return q.numeric_profile(table(spark, d, "lineitem"), ["l_returnflag"], _PROFILED)


@query("metric_coverage", """
SELECT l_returnflag, count(*) AS rows_total, count(*) FILTER (l_quantity <> 0) AS l_quantity,
       count(*) FILTER (l_extendedprice <> 0) AS l_extendedprice,
       count(*) FILTER (l_discount <> 0) AS l_discount, count(*) FILTER (l_tax <> 0) AS l_tax
FROM lineitem GROUP BY 1""")
def metric_coverage(spark, d):
    return q.metric_coverage(table(spark, d, "lineitem"), ["quantity", "price", "discount", "tax"],
                             ["l_returnflag"])


# --- freshness and catalogue ----------------------------------------------

_DATED = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


@query("freshness", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", max(CAST({c} AS DATE)) AS max_date, CAST(NULL AS TIMESTAMP) AS max_synced,
       count(*) AS row_count FROM {t}""" for t, c in _DATED.items()))
def freshness(spark, d):
    return q.freshness({t: table(spark, d, t) for t in _DATED})


@query("freshness_by_group", """
SELECT 'orders' AS "table", o_orderstatus AS "group", max(CAST(o_orderdate AS DATE)) AS max_date,
       CAST(NULL AS TIMESTAMP) AS max_synced, count(*) AS row_count FROM orders GROUP BY 2""")
def freshness_by_group(spark, d):
    return q.freshness({"orders": table(spark, d, "orders")}, by="o_orderstatus")


_WIDTH = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
          "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2,
          "labels": 3, "conversations": 4}


@query("table_profile", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", {_WIDTH[t]}::BIGINT AS columns, count(*) AS row_count FROM {t}"""
    for t in TABLES))
def table_profile(spark, d):
    return q.table_profile(as_catalogue(d, TABLES).load_all(spark))


@query("column_finder", """
SELECT 'lineitem' AS "table", 'l_extendedprice, l_discount' AS columns, 'l_shipdate' AS dated_by,
       count(*) AS row_count, min(CAST(l_shipdate AS DATE)) AS first_date,
       max(CAST(l_shipdate AS DATE)) AS last_date FROM lineitem
UNION ALL
SELECT 'orders', 'o_totalprice', 'o_orderdate', count(*), min(CAST(o_orderdate AS DATE)),
       max(CAST(o_orderdate AS DATE)) FROM orders
UNION ALL
SELECT 'part', 'p_retailprice', NULL, count(*), NULL, NULL FROM part""")
def column_finder(spark, d):
    """Numeric columns found by name in every table, with the rows and dates behind them."""
    return q.found_column_profile({t: table(spark, d, t) for t in TABLES}, "price|discount",
                                  ["ts", "o_orderdate", "l_shipdate"])


@query("column_samples", """
SELECT 'lineitem' AS "table", row_number() OVER (ORDER BY day DESC, l_extendedprice DESC, l_discount DESC) AS position,
       day, '{"l_extendedprice":' || l_extendedprice || ',"l_discount":' || l_discount || '}' AS values
FROM (SELECT CAST(l_shipdate AS DATE) AS day, l_extendedprice, l_discount FROM lineitem
      ORDER BY day DESC, l_extendedprice DESC, l_discount DESC LIMIT 5)
UNION ALL
SELECT 'orders', row_number() OVER (ORDER BY day DESC, o_totalprice DESC), day, '{"o_totalprice":' || o_totalprice || '}'
FROM (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders ORDER BY day DESC, o_totalprice DESC LIMIT 5)""")
def column_samples(spark, d):
    """The five newest rows behind the columns found by name."""
    return q.found_column_samples({t: table(spark, d, t) for t in TABLES}, "price|discount",
                                  ["ts", "o_orderdate", "l_shipdate"])


@query("synced_freshness", """
SELECT 'orders' AS "table", max(CAST(o_orderdate AS DATE)) AS max_date,
       max(o_orderdate + INTERVAL (o_orderkey % 24) HOUR) AS max_synced, count(*) AS row_count FROM orders
UNION ALL
SELECT 'events', max(CAST(ts AS DATE)), max(ts), count(*) FROM events""")
def synced_freshness(spark, d):
    """Newest business date beside the newest sync, which is no business date."""
    orders = table(spark, d, "orders").select(
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int")))
        .alias("_fivetran_synced"), "o_orderdate")
    return q.freshness({"orders": orders, "events": table(spark, d, "events").withColumn("_fivetran_synced", F.col("ts"))})


_DUMPED = {"documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
           "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
           "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}}


@query("schema_dump", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", {i}::BIGINT AS position, '{c}' AS "column", '{kind}' AS type,
       count(*) FILTER ({c} IS NOT NULL AND CAST({c} AS VARCHAR) <> '') AS filled FROM {t}"""
    for t, cols in _DUMPED.items() for i, (c, kind) in enumerate(cols.items(), 1)))
def schema_dump(spark, d):
    """The columns of raw tables with their types, and how many rows fill them."""
    frames = {t: table(spark, d, t) for t in _DUMPED}
    filled = reduce(lambda a, b: a.unionByName(b), [
        q.fill_rate(df).select(F.lit(t).alias("table"), F.col("field").alias("column"), "filled") for t, df in frames.items()])
    return q.schema_rows(frames).join(filled, ["table", "column"], "left").select(
        "table", "position", "column", "type", F.coalesce("filled", F.lit(0)).alias("filled"))


# --- declared tests -------------------------------------------------------

@query("data_tests", """
SELECT 'not_null' AS test, 'doc_id' AS "column", count(*) FILTER (doc_id IS NULL) AS failures FROM j
UNION ALL SELECT 'not_null', 'quality', count(*) FILTER (quality IS NULL) FROM j
UNION ALL SELECT 'accepted_values', 'lang', count(*) FILTER (lang NOT IN ('en', 'fr')) FROM j
UNION ALL SELECT 'accepted_values', 'quality', count(*) FILTER (quality NOT IN (1)) FROM j
""".replace("FROM j", "FROM documents LEFT JOIN labels USING (doc_id)"))
def data_tests(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return q.run_tests(docs.join(table(spark, d, "labels"), "doc_id", "left"), [
        q.NotNull("doc_id"), q.NotNull("quality"), q.Accepted("lang", ("en", "fr")),
        q.Accepted("quality", (1,))])
