"""Projection, union, window and aggregate operators on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (clip, coerce_cell, coerce_typed, date_parts, extract_or_null, iso_text,
                         null_as_zero_sum, parse_day, parse_mixed_date, recovered_sessions,
                         round_to_long, safe_ratio)
from ..functions.cells import SinkField
from ..operators.breakdown import daily_summary, topn_other
from ..operators.latest import latest_per_key
from ..operators.quality import month_counts as by_month
from ..operators.quality import newest_rows, value_counts
from ..operators.shape import (aligned_union, differs_from, latest_day_rows, not_deleted,
                               real_loads, rolling_window)
from ..schemas import layout
from ..session import stored
from .base import cents, query, sql_cents, table

def event_day():
    return F.col("ts").cast("date")


# --- one row per key ------------------------------------------------------

@query("latest_per_key", f"""
SELECT user_id, event_type, event_id, {sql_cents('value')} AS value_cents
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def latest(spark, d):
    newest = latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts"],
                            ["event_id"])
    return newest.select("user_id", "event_type", "event_id", cents("value").alias("value_cents"))


@query("latest_per_key_ties", f"""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
       {sql_cents('o_totalprice')} AS total_cents
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
      FROM orders)
WHERE rn = 1""")
def latest_ties(spark, d):
    newest = latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"],
                            ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date")
                         .alias("order_day"), cents("o_totalprice").alias("total_cents"))


@query("earliest_per_key", f"""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
       {sql_cents('o_totalprice')} AS total_cents
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC) AS rn
      FROM orders)
WHERE rn = 1""")
def earliest(spark, d):
    oldest = latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"],
                            ["o_orderkey"], ascending=True)
    return oldest.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date")
                         .alias("order_day"), cents("o_totalprice").alias("total_cents"))


@query("dedup_left_join", f"""
SELECT c_custkey, c_mktsegment, o.o_orderkey AS last_order, CAST(o.o_orderdate AS DATE) AS last_day,
       {sql_cents('o.o_totalprice')} AS last_cents
FROM customer c LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM orders) o ON o.o_custkey = c.c_custkey AND o.rn = 1""")
def dedup_left_join(spark, d):
    newest = latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"],
                            ["o_orderkey"])
    customers = table(spark, d, "customer")
    return customers.join(newest, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_mktsegment", F.col("o_orderkey").alias("last_order"),
        F.col("o_orderdate").cast("date").alias("last_day"),
        cents("o_totalprice").alias("last_cents"))


# --- breakdowns -----------------------------------------------------------

DAILY_DIMENSIONS_SQL = f"""
SELECT CAST(ts AS DATE) AS day, 'Type' AS dimension_type, event_type AS dimension_value,
       count(*) AS users, CAST(sum({sql_cents('value')}) AS BIGINT) AS value_cents
FROM events GROUP BY ALL
UNION ALL
SELECT CAST(ts AS DATE), 'User', CAST(user_id AS VARCHAR), count(*),
       CAST(sum({sql_cents('value')}) AS BIGINT)
FROM events GROUP BY ALL"""

BUCKETED_SQL = f"""
SELECT day, dimension_type,
       CASE WHEN dimension_type = 'User' AND rank_in_day > 10 THEN '(other)'
            ELSE dimension_value END AS dimension_value,
       CAST(sum(users) AS BIGINT) AS users, CAST(sum(value_cents) AS BIGINT) AS value_cents
FROM (SELECT *, row_number() OVER (PARTITION BY day, dimension_type
                                   ORDER BY users DESC NULLS LAST,
                                            dimension_value ASC NULLS FIRST) AS rank_in_day
      FROM ({DAILY_DIMENSIONS_SQL}))
GROUP BY 1, 2, 3"""


def daily_dimensions(spark, d):
    """Daily counts by type and by user: one row per day, dimension type and value."""
    events = table(spark, d, "events").select(event_day().alias("day"), "event_type", "user_id",
                                              cents("value").alias("value_cents"))
    sides = [("Type", F.col("event_type")), ("User", F.col("user_id").cast("string"))]
    parts = [events.groupBy("day", F.lit(kind).alias("dimension_type"),
                            value.alias("dimension_value"))
             .agg(F.count("*").alias("users"), F.sum("value_cents").alias("value_cents"))
             for kind, value in sides]
    return parts[0].unionByName(parts[1])


def bucketed(spark, d, rows=None):
    rows = stored(daily_dimensions(spark, d), "dimensions") if rows is None else rows
    return topn_other(rows, ["day"], "dimension_type", "dimension_value",
                      "users", {"User": 10}, ["users", "value_cents"])


query("topn_other", BUCKETED_SQL)(bucketed)


@query("weighted_rate", f"""
SELECT l_returnflag, l_linestatus,
       CAST(sum({sql_cents('l_extendedprice')}) AS BIGINT) AS price_cents,
       CAST(sum({sql_cents('l_extendedprice')} * {sql_cents('l_discount')}) AS BIGINT) AS weighted,
       CAST(sum({sql_cents('l_extendedprice')} * {sql_cents('l_discount')}) AS DOUBLE)
         / CAST(sum({sql_cents('l_extendedprice')}) AS DOUBLE) AS discount_pct
FROM lineitem GROUP BY 1, 2""")
def weighted_rate(spark, d):
    """Ratio of sums: the average discount weighted by price, never an average of rates."""
    price, pct = cents("l_extendedprice"), cents("l_discount")
    sums = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(price).alias("price_cents"), F.sum(price * pct).alias("weighted"))
    return sums.withColumn("discount_pct", safe_ratio(F.col("weighted"), F.col("price_cents")))


@query("safe_ratio", f"""
SELECT o_orderkey, {sql_cents('o_totalprice')} AS total_cents,
       coalesce(l.returned, 0) AS returned,
       CASE WHEN coalesce(l.returned, 0) = 0 THEN NULL
            ELSE CAST({sql_cents('o_totalprice')} AS DOUBLE) / CAST(l.returned AS DOUBLE) END
         AS cents_per_returned,
       CAST(round(CASE WHEN l.rate = 0 THEN NULL ELSE CAST(l.returned AS DOUBLE) / l.rate END)
            AS BIGINT) AS recovered_lines
FROM orders LEFT JOIN (
  SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE)
           / CAST(count(*) AS DOUBLE) AS rate
  FROM lineitem GROUP BY 1) l ON l.l_orderkey = o_orderkey""")
def ratio_per_order(spark, d):
    returned = F.count_if(F.col("l_returnflag") == "R")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        returned.alias("_returned"), safe_ratio(returned, F.count("*")).alias("_rate"))
    joined = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    some = F.coalesce("_returned", F.lit(0))
    return joined.select(
        "o_orderkey", cents("o_totalprice").alias("total_cents"), some.alias("returned"),
        safe_ratio(cents("o_totalprice"), some).alias("cents_per_returned"),
        recovered_sessions(F.col("_returned"), F.col("_rate")).alias("recovered_lines"))


# --- unions and projections -----------------------------------------------

PARTY = layout("""
kind string
party_key bigint
name string
amount_cents bigint
segment string
nation_key bigint
""")


@query("aligned_union", f"""
SELECT 'Customer' AS kind, c_custkey AS party_key, c_name AS name,
       {sql_cents('c_acctbal')} AS amount_cents, c_mktsegment AS segment,
       CAST(c_nationkey AS BIGINT) AS nation_key FROM customer
UNION ALL
SELECT 'Supplier', s_suppkey, s_name, {sql_cents('s_acctbal')}, NULL, CAST(s_nationkey AS BIGINT)
FROM supplier
UNION ALL
SELECT 'Part', p_partkey, p_name, {sql_cents('p_retailprice')}, p_type, NULL FROM part""")
def three_parties(spark, d):
    """Three tables in one layout; the branches name their columns in any order."""
    customers = table(spark, d, "customer").select(
        F.lit("Customer").alias("kind"), F.col("c_custkey").alias("party_key"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("name"), cents("c_acctbal").alias("amount_cents"))
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.lit("Supplier").alias("kind"),
        F.col("s_name").alias("name"), cents("s_acctbal").alias("amount_cents"),
        F.col("s_nationkey").alias("nation_key"))
    parts = table(spark, d, "part").select(
        F.lit("Part").alias("kind"), F.col("p_partkey").alias("party_key"),
        F.col("p_name").alias("name"), cents("p_retailprice").alias("amount_cents"),
        F.col("p_type").alias("segment"))
    return aligned_union([customers, suppliers, parts], PARTY)


@query("class_tags", """
SELECT p_partkey,
       CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Compact'
            WHEN p_type = 'LARGE' THEN 'Bulk'
            WHEN p_type = 'ECONOMY' THEN 'Budget' ELSE 'Unknown' END AS content_class,
       CASE WHEN p_size > 25 THEN 'https://parts.example/' || p_name END AS page_url
FROM part
WHERE coalesce(p_type, '') <> 'PROMO'
  AND coalesce(CASE WHEN p_size > 45 THEN true WHEN p_size > 40 THEN NULL ELSE false END, false)
      = false
  AND (p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') OR p_size > 5)""")
def class_tags(spark, d):
    kind = (F.when(F.col("p_type").isin("SMALL", "MEDIUM"), "Compact")
            .when(F.col("p_type") == "LARGE", "Bulk")
            .when(F.col("p_type") == "ECONOMY", "Budget").otherwise("Unknown"))
    deleted = F.when(F.col("p_size") > 45, True).when(F.col("p_size") > 40, F.lit(None)) \
        .otherwise(False)
    wanted = F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3") | (F.col("p_size") > 5)
    kept = table(spark, d, "part").filter(
        differs_from(F.col("p_type"), "PROMO") & not_deleted(deleted) & wanted)
    return kept.select("p_partkey", kind.alias("content_class"),
                       F.when(F.col("p_size") > 25,
                              F.concat(F.lit("https://parts.example/"), "p_name")).alias("page_url"))


@query("fallback_metrics", """
SELECT l_returnflag, l_linestatus,
       CAST(sum(coalesce(reach, impressions, views, 0)) AS BIGINT) AS audience,
       CAST(sum(coalesce(reach, 0) + coalesce(impressions, 0) + coalesce(views, 0)) AS BIGINT)
         AS interactions,
       CAST(sum(derived) AS BIGINT) AS derived_clicks
FROM (SELECT l_returnflag, l_linestatus,
             CASE WHEN l_partkey % 3 <> 0 THEN CAST(round(l_quantity) AS BIGINT) END AS reach,
             CASE WHEN l_suppkey % 2 = 0 THEN CAST(round(l_extendedprice) AS BIGINT) END AS impressions,
             CASE WHEN l_orderkey % 5 <> 0 THEN CAST(round(l_extendedprice * l_discount) AS BIGINT) END
               AS views,
             CAST(round(l_quantity * l_tax) AS BIGINT) AS derived
      FROM lineitem)
GROUP BY 1, 2""")
def fallback_metrics(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.when(F.col("l_partkey") % 3 != 0, round_to_long(F.col("l_quantity"))).alias("reach"),
        F.when(F.col("l_suppkey") % 2 == 0, round_to_long(F.col("l_extendedprice")))
        .alias("impressions"),
        F.when(F.col("l_orderkey") % 5 != 0,
               round_to_long(F.col("l_extendedprice") * F.col("l_discount"))).alias("views"),
        round_to_long(F.col("l_quantity") * F.col("l_tax")).alias("derived"))
    three = [F.col(c) for c in ("reach", "impressions", "views")]
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.coalesce(*three, F.lit(0))).alias("audience"),
        F.sum(null_as_zero_sum(*three)).alias("interactions"),
        F.sum("derived").alias("derived_clicks"))


# --- windows and limits ---------------------------------------------------

@query("rolling_window", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, {sql_cents('o_totalprice')} AS total_cents
FROM orders WHERE o_orderdate >= DATE '2000-08-01' - 365
ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 1000""")
def year_to(spark, d):
    recent = rolling_window(table(spark, d, "orders"), "o_orderdate", 365, "2000-08-01", limit=1000,
                            order_by=[F.col("o_orderdate").desc(), F.col("o_orderkey").asc()])
    return recent.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"),
                         cents("o_totalprice").alias("total_cents"))


@query("recent_topk", f"""
SELECT event_id, user_id, event_type, {sql_cents('value')} AS value_cents
FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 50""")
def recent_topk(spark, d):
    return newest_rows(table(spark, d, "events"), 50, ["ts", "event_id"]).select(
        "event_id", "user_id", "event_type", cents("value").alias("value_cents"))


@query("latest_day_rows", f"""
SELECT event_id, CAST(ts AS DATE) AS day, 'last full day' AS part, event_type, 1::BIGINT AS n,
       {sql_cents('value')} AS value_cents
FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events WHERE ts < DATE '2024-01-30')
UNION ALL
SELECT NULL, CAST(ts AS DATE), 'last 7 days', event_type, count(*),
       CAST(sum({sql_cents('value')}) AS BIGINT)
FROM events WHERE ts >= DATE '2024-01-30' - 7 GROUP BY ALL""")
def last_days(spark, d):
    events = table(spark, d, "events").withColumn("day", event_day())
    full = latest_day_rows(events, "day", F.lit("2024-01-30").cast("date")).select(
        "event_id", "day", F.lit("last full day").alias("part"), "event_type",
        F.lit(1).cast("bigint").alias("n"), cents("value").alias("value_cents"))
    week = rolling_window(events, "ts", 7, "2024-01-30").groupBy("day", "event_type").agg(
        F.count("*").alias("n"), F.sum(cents("value")).alias("value_cents")).select(
        F.lit(None).cast("bigint").alias("event_id"), "day", F.lit("last 7 days").alias("part"),
        "event_type", "n", "value_cents")
    return full.unionByName(week)


# --- aggregates -----------------------------------------------------------

@query("month_counts", """
SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n
FROM orders GROUP BY 1, 2""")
def month_counts(spark, d):
    return by_month(table(spark, d, "orders"), "o_orderdate", ["o_orderstatus"])


@query("distinct_counts", """
SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types,
       count(DISTINCT CAST(ts AS DATE)) AS days, min(CAST(ts AS DATE)) AS first_day,
       max(CAST(ts AS DATE)) AS last_day, count(*) AS n FROM events""")
def distinct_counts(spark, d):
    return table(spark, d, "events").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"),
        F.count_distinct(event_day()).alias("days"), F.min(event_day()).alias("first_day"),
        F.max(event_day()).alias("last_day"), F.count("*").alias("n"))


@query("ordered_listagg", """
SELECT p_type, string_agg(p_brand, ', ' ORDER BY p_brand) AS brands, count(*) AS n
FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY 1""")
def brands_per_type(spark, d):
    """Names are made distinct first, so a list holds the brands, not the parts."""
    pairs = table(spark, d, "part").select("p_type", "p_brand").distinct()
    return pairs.groupBy("p_type").agg(
        F.array_join(F.array_sort(F.collect_list("p_brand")), ", ").alias("brands"),
        F.count("*").alias("n"))


@query("newest_per_load", f"""
SELECT loaded_on, count(*) AS n, max(CAST(shown AS DATE)) AS newest_day
FROM (SELECT CAST(ts AS DATE) AS loaded_on, strftime(ts, '%Y-%m-%d') AS shown FROM events)
GROUP BY 1 ORDER BY n DESC, loaded_on DESC LIMIT 6""")
def newest_per_load(spark, d):
    """Newest date parsed from text in each load, largest loads first."""
    loads = table(spark, d, "events").select(event_day().alias("loaded_on"),
                                             F.date_format("ts", "M/d/yy").alias("shown"))
    return (loads.groupBy("loaded_on")
            .agg(F.count("*").alias("n"), F.max(parse_mixed_date(F.col("shown"))).alias("newest_day"))
            .orderBy(F.col("n").desc(), F.col("loaded_on").desc()).limit(6))


@query("most_common", """
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2""")
def most_common(spark, d):
    return value_counts(table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"])


@query("daily_average", f"""
SELECT CAST(ts AS DATE) AS day, CAST(sum({sql_cents('value')}) AS BIGINT) AS value_cents,
       count(DISTINCT user_id) AS users,
       CAST(sum({sql_cents('value')}) AS DOUBLE) / count(DISTINCT user_id) AS cents_per_user
FROM events GROUP BY 1""")
def daily_average(spark, d):
    daily = table(spark, d, "events").groupBy(event_day().alias("day")).agg(
        F.sum(cents("value")).alias("value_cents"), F.count_distinct("user_id").alias("users"))
    return daily.withColumn("cents_per_user", safe_ratio(F.col("value_cents"), F.col("users")))


# --- JSON -----------------------------------------------------------------

@query("json_scalar", """
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       count(json_extract_string(props, '$.k')) AS with_k,
       count(json_extract_string(props, '$.missing')) AS with_missing
FROM events GROUP BY 1""")
def json_scalar(spark, d):
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").groupBy("event_type").agg(
        F.sum(k.try_cast("bigint")).alias("sum_k"), F.count(k).alias("with_k"),
        F.count(F.get_json_object("props", "$.missing")).alias("with_missing"))


@query("value_breakdown", """
SELECT day, CAST(sum(n) AS BIGINT) AS record_count,
       '{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}'
         AS event_type_counts
FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)
GROUP BY 1""")
def value_breakdown(spark, d):
    """One summary row per day; a field the table lacks is skipped."""
    return daily_summary(table(spark, d, "events").withColumn("day", event_day()),
                         ["event_type", "not_a_column"], ["day"])


# --- dates, cells, text ---------------------------------------------------

@query("mixed_date_parse", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS lenient,
       CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
       CAST(weekofyear(o_orderdate) AS BIGINT) AS week_of_year, monthname(o_orderdate) AS month_name,
       dayname(o_orderdate) AS day_of_week,
       CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS BIGINT) AS days_ago
FROM orders""")
def mixed_dates(spark, d):
    """Order dates written three ways by key, read back; short years are of the 1900s or 2000s."""
    shown = (F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "M/d/yy"))
             .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    rows = table(spark, d, "orders").select("o_orderkey", shown.alias("shown"))
    parsed = rows.select("o_orderkey", parse_mixed_date(F.col("shown")).alias("parsed"),
                         parse_day(F.col("shown")).alias("lenient"))
    return date_parts(parsed, "parsed", "2002-01-01")


@query("cell_coercion", """
SELECT p_partkey, 'currency' AS price_kind, round(p_retailprice, 2) AS price,
       'percent' AS size_kind, CAST(p_size AS DOUBLE) / 100 AS size_share,
       'integer' AS key_kind, p_partkey AS key_value, 'text' AS name_kind, p_name AS name,
       'date' AS day_kind, '2024-' || lpad(CAST(1 + p_size % 12 AS VARCHAR), 2, '0') || '-28' AS day
FROM part""")
def cells(spark, d):
    """Untyped cells: dollars, percentages, grouped integers, dates and plain text."""
    cell = {
        "price": F.concat(F.lit("$"), F.format_number("p_retailprice", 2)),
        "share": F.concat(F.col("p_size").cast("string"), F.lit("%")),
        "key": F.format_number("p_partkey", 0), "label": F.col("p_name"),
        "day": F.concat((F.col("p_size") % 12 + 1).cast("string"), F.lit("/28/2024"))}
    return table(spark, d, "part").select(
        "p_partkey", *[coerce_cell(c).alias(n) for n, c in cell.items()]).select(
        "p_partkey", F.col("price.kind").alias("price_kind"),
        F.col("price.double_value").alias("price"), F.col("share.kind").alias("size_kind"),
        F.col("share.double_value").alias("size_share"), F.col("key.kind").alias("key_kind"),
        F.col("key.long_value").alias("key_value"), F.col("label.kind").alias("name_kind"),
        F.col("label.text_value").alias("name"), F.col("day.kind").alias("day_kind"),
        F.col("day.iso_date").alias("day"))


@query("typed_coercion", """
SELECT p_partkey, '2024-' || lpad(CAST(1 + p_size % 12 AS VARCHAR), 2, '0') || '-28' AS day,
       round(p_retailprice, 2) AS price, CAST(round(p_retailprice) AS BIGINT) AS whole_price,
       NULL::BIGINT AS bad_number, p_name AS label
FROM part""")
def typed_fields(spark, d):
    """Text columns fitted to declared fields; the undeclared column is dropped."""
    shown = table(spark, d, "part").select(
        F.format_number("p_partkey", 0).alias("p_partkey"),
        F.when(F.col("p_size") % 2 == 0,
               F.concat((F.col("p_size") % 12 + 1).cast("string"), F.lit("/28/2024")))
        .otherwise(F.concat(F.lit("2024/"), (F.col("p_size") % 12 + 1).cast("string"), F.lit("/28")))
        .alias("day"),
        F.format_number("p_retailprice", 2).alias("price"),
        F.format_number(F.round("p_retailprice"), 1).alias("whole_price"),
        F.col("p_name").alias("bad_number"), F.col("p_name").alias("label"),
        F.col("p_brand").alias("undeclared"))
    return coerce_typed(shown, [
        SinkField("p_partkey", "number"), SinkField("day", "date"),
        SinkField("price", "number", 2), SinkField("whole_price", "number"),
        SinkField("bad_number", "number"), SinkField("label", "text"),
        SinkField("absent", "text")])


@query("regex_extract", """
SELECT page_id, nullif(regexp_extract(url, '://([^/]+)/', 1), '') AS host,
       nullif(regexp_extract(url, '://[^/]+/([a-z]{2})/', 1), '') AS lang,
       nullif(regexp_extract(url, 'utm_source=([a-z]+)', 1), '') AS campaign
FROM pages""")
def url_parts(spark, d):
    return table(spark, d, "pages").select(
        "page_id", extract_or_null(F.col("url"), r"://([^/]+)/").alias("host"),
        extract_or_null(F.col("url"), r"://[^/]+/([a-z]{2})/").alias("lang"),
        extract_or_null(F.col("url"), "utm_source=([a-z]+)").alias("campaign"))


@query("clipped_names", """
SELECT c_custkey, left(c_name, 12) AS short_name, left(c_mktsegment, 4) AS short_segment FROM customer""")
def clipped_names(spark, d):
    """Names cut to a target's field length; the cut is what the function is for."""
    return table(spark, d, "customer").select(
        "c_custkey", clip(F.col("c_name"), 12).alias("short_name"),
        clip(F.col("c_mktsegment"), 4).alias("short_segment"))


@query("iso_render", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS naive_text,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS instant_text,
       o_orderstatus
FROM orders""")
def iso_render(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", iso_text(F.col("o_orderdate").cast("date"), "date").alias("day_text"),
        iso_text(F.col("o_orderdate"), "timestamp_ntz").alias("naive_text"),
        iso_text(F.col("o_orderdate").cast("timestamp"), "timestamp").alias("instant_text"),
        iso_text(F.col("o_orderstatus"), "string").alias("o_orderstatus"))


# --- filters on loads, literal rows ---------------------------------------

@query("clean_loads", """
SELECT day, event_type, record_count, source_filename
FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS record_count,
             CASE WHEN event_type = 'error' THEN 'error_' || strftime(CAST(ts AS DATE), '%Y%m%d') || '_000000.csv'
                  WHEN event_type = 'signup' AND day(ts) = 1 THEN NULL
                  ELSE 'Daily_' || event_type || '.csv' END AS source_filename
      FROM events GROUP BY ALL)
WHERE record_count > 1 AND NOT regexp_matches(source_filename, '^[a-z0-9_]+_[0-9]{8}_[0-9]{6}[.]csv$')""")
def clean_loads(spark, d):
    loads = table(spark, d, "events").groupBy(event_day().alias("day"), "event_type").agg(
        F.count("*").alias("record_count"))
    name = (F.when(F.col("event_type") == "error",
                   F.concat(F.lit("error_"), F.date_format("day", "yyyyMMdd"), F.lit("_000000.csv")))
            .when((F.col("event_type") == "signup") & (F.dayofmonth("day") == 1), F.lit(None))
            .otherwise(F.concat(F.lit("Daily_"), "event_type", F.lit(".csv"))))
    return real_loads(loads.withColumn("source_filename", name), name_col="source_filename")


@query("literal_truth", """
SELECT t.day, t.expected FROM (VALUES (DATE '2024-01-05', 300), (DATE '2024-01-30', 310),
  (DATE '2024-02-03', 290), (DATE '2024-02-04', 295)) AS t(day, expected)
WHERE t.day NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events)""")
def literal_truth(spark, d):
    """Hand-written day rows minus the days that have events."""
    schema = T.StructType([T.StructField("day", T.StringType()),
                           T.StructField("expected", T.IntegerType())])
    truth = spark.createDataFrame([("2024-01-05", 300), ("2024-01-30", 310), ("2024-02-03", 290),
                                   ("2024-02-04", 295)], schema)
    truth = truth.select(F.col("day").cast("date").alias("day"), "expected")
    days = table(spark, d, "events").select(event_day().alias("day")).distinct()
    return truth.join(days, "day", "left_anti")
