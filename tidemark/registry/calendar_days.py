"""Day coverage operators on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.calendar import (copy_days, copy_report, coverage, day_ranges, delivery_gaps, gap_summary,
                                  missing_days, missing_ranges, value_runs)
from .base import query, table

FIRST, LAST = "2024-01-01", "2024-01-30"


def events(spark, d):
    return table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("day"))


DAYS_SQL = "SELECT CAST(unnest(generate_series(DATE '{}', DATE '{}', INTERVAL 1 DAY)) AS DATE) AS day"
JANUARY_SQL = DAYS_SQL.format(FIRST, LAST)


@query("coverage_ranges", f"""
WITH days AS ({DAYS_SQL.format('1995-01-01', '2001-08-01')}),
sources AS (SELECT DISTINCT o_orderpriority FROM orders),
have AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders),
missing AS (
  SELECT s.o_orderpriority, d.day,
         (d.day - DATE '1990-01-01') - row_number() OVER (PARTITION BY s.o_orderpriority ORDER BY d.day)
           AS grp
  FROM sources s CROSS JOIN days d
  LEFT JOIN have h ON h.o_orderpriority = s.o_orderpriority AND h.day = d.day WHERE h.day IS NULL),
ranges AS (
  SELECT o_orderpriority, min(day) || '..' || max(day) || ' (' || count(*) || 'd)' AS r,
         count(*) AS n FROM missing GROUP BY o_orderpriority, grp),
texts AS (SELECT o_orderpriority, string_agg(r, ', ' ORDER BY r) AS missing_ranges,
                 CAST(sum(n) AS BIGINT) AS days_missing FROM ranges GROUP BY 1)
SELECT s.o_orderpriority, (SELECT count(*) FROM days) - coalesce(t.days_missing, 0) AS days_present,
       coalesce(t.days_missing, 0) AS days_missing,
       (SELECT min(day) FROM have h WHERE h.o_orderpriority = s.o_orderpriority) AS first_date,
       (SELECT max(day) FROM have h WHERE h.o_orderpriority = s.o_orderpriority) AS last_date,
       t.missing_ranges
FROM sources s LEFT JOIN texts t USING (o_orderpriority)""")
def coverage_ranges(spark, d):
    return coverage(table(spark, d, "orders"), "o_orderdate", ["o_orderpriority"],
                    "1995-01-01", "2001-08-01")


@query("gap_ranges", f"""
WITH days AS ({JANUARY_SQL}), have AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
missing AS (
  SELECT u.user_id, d.day,
         (d.day - DATE '1990-01-01') - row_number() OVER (PARTITION BY u.user_id ORDER BY d.day) AS grp
  FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN days d
  LEFT JOIN have h ON h.user_id = u.user_id AND h.day = d.day WHERE h.day IS NULL)
SELECT user_id, min(day) AS range_start, max(day) AS range_end, count(*) AS days
FROM missing GROUP BY user_id, grp""")
def gap_ranges(spark, d):
    return missing_ranges(events(spark, d), "day", ["user_id"], FIRST, LAST)


@query("presence_ranges", """
SELECT user_id, event_type, min(day) AS range_start, max(day) AS range_end, count(*) AS days
FROM (SELECT *, (day - DATE '1990-01-01')
               - row_number() OVER (PARTITION BY user_id, event_type ORDER BY day) AS grp
      FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events))
GROUP BY user_id, event_type, grp""")
def presence_ranges(spark, d):
    return day_ranges(events(spark, d), ["user_id", "event_type"])


@query("missing_days", f"""
SELECT t.event_type, t.user_id, d.day
FROM (SELECT DISTINCT event_type, user_id FROM events) t CROSS JOIN ({JANUARY_SQL}) d
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = t.event_type
                  AND e.user_id = t.user_id AND CAST(e.ts AS DATE) = d.day)""")
def absent_days(spark, d):
    return missing_days(events(spark, d), "day", ["event_type", "user_id"], FIRST, LAST)


GAPS_SQL = f"""
WITH days AS ({JANUARY_SQL}),
bought AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
seen AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value > 20) AS processed
         FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT u.user_id, d.day, s.day IS NOT NULL AS delivered, coalesce(s.processed, false) AS processed
FROM (SELECT DISTINCT user_id FROM bought) u CROSS JOIN days d
LEFT JOIN bought b ON b.user_id = u.user_id AND b.day = d.day
LEFT JOIN seen s ON s.user_id = u.user_id AND s.day = d.day
WHERE b.day IS NULL"""


def _bought_and_seen(spark, d):
    rows = events(spark, d)
    return (rows.filter(F.col("event_type") == "purchase"),
            rows.filter(F.col("event_type") == "view")
            .withColumn("processed", F.col("value") > 20))


@query("anti_semi_days", GAPS_SQL)
def anti_semi_days(spark, d):
    """Days without a purchase per user, told apart by whether the user viewed that day."""
    bought, seen = _bought_and_seen(spark, d)
    return delivery_gaps(bought, seen, ["user_id"], FIRST, LAST)


@query("gap_summary", f"""
SELECT user_id, count(*) AS days_missing,
       count(*) FILTER (delivered) AS missing_with_delivery,
       count(*) FILTER (NOT delivered) AS missing_without_delivery,
       count(*) FILTER (processed) AS processed_but_missing
FROM ({GAPS_SQL}) GROUP BY 1""")
def gaps_per_user(spark, d):
    bought, seen = _bought_and_seen(spark, d)
    return gap_summary(bought, seen, ["user_id"], FIRST, LAST)


@query("value_runs", """
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
marked AS (
  SELECT *, CASE WHEN n = lag(n) OVER (PARTITION BY user_id ORDER BY day) THEN 0 ELSE 1 END AS starts
  FROM daily),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS run
  FROM marked)
SELECT user_id, min(day) AS run_start, max(day) AS run_end, min(n) AS n,
       CAST(max(day) - min(day) + 1 AS BIGINT) AS days, max(day) - min(day) + 1 > 2 AS same_value,
       min(day) AS loaded_from, max(day) AS loaded_to, count(DISTINCT n || '.csv') AS files,
       min(n || '.csv') AS example_file
FROM numbered GROUP BY user_id, run""")
def runs(spark, d):
    daily = events(spark, d).groupBy("user_id", "day").agg(F.count("*").alias("n"))
    loads = daily.withColumns({"loaded_on": F.col("day"),
                               "file": F.concat(F.col("n").cast("string"), F.lit(".csv"))})
    return value_runs(loads, ["user_id"], "day", "n", "loaded_on", "file")


@query("copy_report", f"""
WITH c AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2, 3),
spans AS (SELECT event_type, user_id, day, lead(day) OVER (PARTITION BY event_type, user_id ORDER BY day) AS following
          FROM (SELECT event_type, user_id, day FROM c WHERE day BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
                UNION ALL SELECT DISTINCT event_type, user_id, DATE '{FIRST}' - 1 FROM c)),
gaps AS (SELECT event_type, user_id, day + 1 AS a, coalesce(following, DATE '{LAST}' + 1) - 1 AS b FROM spans
         WHERE coalesce(following, DATE '{LAST}' + 1) - day > 1)
SELECT event_type, user_id, count(*) FILTER (day BETWEEN DATE '{FIRST}' AND DATE '{LAST}') AS days_present,
       CAST(DATE '{LAST}' - DATE '{FIRST}' + 1 - count(*) FILTER (day BETWEEN DATE '{FIRST}' AND DATE '{LAST}') AS BIGINT) AS days_missing,
       min(day) AS first_date, max(day) AS last_date,
       any_value(missing) AS missing_ranges,
       CAST(sum(n) AS BIGINT) AS records, count(*) FILTER (n > 1) AS repeated_days,
       CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS extra_records
FROM c LEFT JOIN (
  SELECT event_type, user_id, string_agg(a || '..' || b || ' (' || (b - a + 1) || 'd)', ', ' ORDER BY a) AS missing
  FROM gaps GROUP BY 1, 2) USING (event_type, user_id)
GROUP BY event_type, user_id""")
def copy_report_by_source(spark, d):
    """Every user's events of each type against the calendar: coverage, ranges and repeated days."""
    return copy_report(events(spark, d), "day", ["event_type", "user_id"], FIRST, LAST)


@query("copy_compare", f"""
WITH copy AS (SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day FROM events),
sources AS (SELECT DISTINCT event_type, user_id FROM copy)
SELECT s.event_type, s.user_id, strftime(d.day, '%Y-%m') AS month, count(c.day) AS have,
       count(*) - count(c.day) AS missing
FROM sources s CROSS JOIN ({JANUARY_SQL}) d
LEFT JOIN copy c ON c.event_type = s.event_type AND c.user_id = s.user_id AND c.day = d.day
GROUP BY ALL""")
def copy_compare(spark, d):
    """Days of every user's events of each type against the calendar, by month."""
    return copy_days(events(spark, d), "day", ["event_type", "user_id"], FIRST, LAST)
