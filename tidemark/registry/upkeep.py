"""Stored tables kept up to date part by part, compared range by range, and counted from sketches and footers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import web
from ..session import scratch_path, stored
from ..sources.checksums import differing_rows, write_summed
from ..sources.footers import footer_bounds
from ..sources.parts import changed_days, merge_latest, read_parts
from ..sources.sketches import error_bound, rolling_distinct, rolling_exact, sketch_days
from . import models, raw
from .base import cents, query, sql_cents, table

_POST_KEYS = ["page_id", "post_id"]
_LATE, _MIDDLE = dt.date(2024, 1, 20), dt.date(2024, 1, 10)


@query("incremental_latest", f"""
SELECT page_id, post_id, date_day, likes, clicks, media_views FROM {models.newest(raw.FACEBOOK, 'page_id, post_id', 'date_day')}""")
def incremental_latest(spark, d):
    """Post versions delivered in three batches, the newest days first, each merged into a stored snapshot."""
    log = stored(raw.facebook(spark, d), "posts")
    root = scratch_path(spark, "latest")
    day = F.col("date_day")
    for batch in (log.where(day >= F.lit(_LATE)), log.where(day < F.lit(_MIDDLE)), log.where((day >= F.lit(_MIDDLE)) & (day < F.lit(_LATE)))):
        merge_latest(batch, root, _POST_KEYS, ["date_day"], buckets=16)
    return read_parts(spark, root).select(*_POST_KEYS, "date_day", "likes", "clicks", "media_views")


@query("rolling_rebuild", f"{models.BREAKDOWN} ")
def rolling_rebuild(spark, d):
    """A breakdown stored when the last days were incomplete, then built again for the days delivered anew."""
    reports = {n: stored(getattr(raw, n)(spark, d), n) for n in ("device", "city", "page", "campaign", "site")}
    root = scratch_path(spark, "breakdown")
    new = {n: df.where(F.col("date") >= F.lit(_LATE)) for n, df in reports.items()}
    stale = {n: df.where((F.col("date") < F.lit(_LATE)) | (F.col("new_users") > 1) if "new_users" in df.columns else F.col("date").isNotNull())
             for n, df in reports.items()}
    web.rebuild_breakdown(stale, changed_days(stale.values()), root)
    web.rebuild_breakdown(reports, changed_days(new.values()), root)
    return web.stored_breakdown(spark, root, models.AS_OF)


# --- a copy compared with its source, range by range ------------------------

_LOST, _CHANGED = dt.date(1995, 3, 15), dt.date(1996, 7, 1)
_ORDERS = "o_orderkey, o_custkey, o_orderstatus, cents, day"


@query("localised_diff", f"""
WITH source AS (SELECT o_orderkey, o_custkey, o_orderstatus, {sql_cents('o_totalprice')} AS cents, CAST(o_orderdate AS DATE) AS day FROM orders),
copy AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN day = DATE '{_CHANGED}' THEN cents + 100 ELSE cents END AS cents, day
         FROM source WHERE day <> DATE '{_LOST}'),
both_sides AS (SELECT *, 1 AS l, 0 AS r FROM source UNION ALL SELECT *, 0, 1 FROM copy)
SELECT {_ORDERS}, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
FROM both_sides GROUP BY {_ORDERS} HAVING sum(l) <> sum(r)""")
def localised_diff(spark, d):
    """All orders against a copy that lost one day and has other prices on another."""
    source = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", cents("o_totalprice").alias("cents"),
                                              F.col("o_orderdate").cast("date").alias("day"))
    copy = source.where(F.col("day") != F.lit(_LOST)).withColumn(
        "cents", F.col("cents") + F.when(F.col("day") == F.lit(_CHANGED), 100).otherwise(0))
    left, right = scratch_path(spark, "source"), scratch_path(spark, "copy")
    write_summed(source, left, ["o_orderkey"])
    write_summed(copy, right, ["o_orderkey"])
    return differing_rows(spark, left, right)


# --- distinct users of spans, from sketches of days -------------------------

_SPAN = 7


@query("rolling_users", f"""
WITH e AS (SELECT DISTINCT CAST(ts AS DATE) AS date, event_type, user_id FROM events),
ends AS (SELECT DISTINCT date AS until FROM e)
SELECT ends.until, e.event_type, count(DISTINCT e.user_id) AS users, TRUE AS estimate_holds
FROM ends JOIN e ON e.date BETWEEN ends.until - {_SPAN - 1} AND ends.until GROUP BY ends.until, e.event_type""")
def rolling_users(spark, d):
    """Users of each seven days per kind of event, counted, and whether the stored sketches' estimate is in its bound.

    Days are sketched as they are delivered: all of them, then the last ones again.
    """
    events = stored(table(spark, d, "events").select(F.col("ts").cast("date").alias("date"), "event_type", "user_id"), "events")
    root = scratch_path(spark, "sketches")
    days = changed_days([events])
    sketch_days(events, root, ["event_type"], "user_id", days)
    sketch_days(events, root, ["event_type"], "user_id", days[-3:])
    span = {"span": _SPAN, "first": days[0], "last": days[-1]}
    guess = rolling_distinct(spark, root, ["event_type"], **span).withColumnRenamed("n_distinct", "guess")
    exact = rolling_exact(events, ["event_type"], "user_id", **span).withColumnRenamed("n_distinct", "users")
    delivered = exact.join(events.select(F.col("date").alias("until")).distinct(), "until", "left_semi")
    off = F.abs(F.col("guess") - F.col("users"))
    return delivered.join(guess, ["until", "event_type"], "left").select(
        "until", "event_type", "users", F.coalesce(off <= F.col("users") * error_bound(sigmas=4), F.lit(False)).alias("estimate_holds"))


@query("footer_freshness", """
SELECT 'events' AS "table", CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS min_value, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS max_value, count(*) AS row_count FROM events
UNION ALL SELECT 'orders', CAST(min(o_orderkey) AS VARCHAR), CAST(max(o_orderkey) AS VARCHAR), count(*) FROM orders
UNION ALL SELECT 'customer', NULL, NULL, count(*) FROM customer""")
def footer_freshness(spark, d):
    """Newest day, largest key and sizes of tables, answered by their footers."""
    path = scratch_path(spark, "events")
    table(spark, d, "events").select(F.col("ts").cast("date").alias("day"), "user_id").write.parquet(path)
    return footer_bounds(spark, {"events": (path, "day"), "orders": (f"{d}/orders.parquet", "o_orderkey"),
                                 "customer": (f"{d}/customer.parquet", None)})
