"""Report ingest operators on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.links import extract_links, pick_link
from ..operators.shape import ordered_scan, zone_date
from ..session import scratch_path
from ..sources import reports, typed
from ..sources.ingest import ingest, read_raw
from ..streaming.incremental import load_new_files, loaded
from .base import cents, query, sql_cents, table

# --- message log ----------------------------------------------------------

CONFIGS = [
    reports.ReportConfig("daily", "the", r"daily_.*\.csv", "daily_rows", "daily", ("role",)),
    reports.ReportConfig("weekly", "is", r"weekly_.*\.csv", "weekly_rows", "weekly"),
    reports.ReportConfig("other", "und", r"other_.*\.csv", "other_rows", "weekly"),
]


def message_log(spark, d):
    """Conversation turns as messages: the text is the subject, the role the sender."""
    name = F.when(F.col("turn") % 2 == 0, "Daily_").otherwise("weekly_")
    part = F.struct(F.concat(name, F.col("conv_id").cast("string"), F.lit(".csv")).alias("filename"),
                    F.col("role").alias("body"))
    note = F.struct(F.lit("note.txt").alias("filename"), F.lit("n").alias("body"))
    return table(spark, d, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("message_id"), F.col("role").alias("sender"), F.col("text").alias("subject"),
        (F.col("conv_id") * 1000).alias("internal_date_ms"), F.array(note, part).alias("parts"))


@query("report_select", """
WITH log AS (SELECT conv_id || '-' || turn AS message_id, conv_id, turn, role, text FROM conversations),
routed AS (
  SELECT *, 'daily' AS report, 'daily_rows' AS "table", 'daily' AS schedule FROM log WHERE lower(text) LIKE '%the%'
  UNION ALL SELECT *, 'weekly', 'weekly_rows', 'weekly' FROM log WHERE lower(text) LIKE '%is%'
  UNION ALL SELECT *, 'other', 'other_rows', 'weekly' FROM log WHERE lower(text) LIKE '%und%')
SELECT message_id, report, "table", schedule,
       CASE WHEN report = 'daily' AND turn % 2 = 0 THEN 'Daily_' || conv_id || '.csv'
            WHEN report = 'weekly' AND turn % 2 = 1 THEN 'weekly_' || conv_id || '.csv' END AS attachment,
       coalesce(CASE WHEN report = 'daily' AND turn % 2 = 0 THEN 'Daily_' || conv_id || '.csv'
                     WHEN report = 'weekly' AND turn % 2 = 1 THEN 'weekly_' || conv_id || '.csv' END,
                report || '_' || strftime(received, '%Y%m%d_%H%M%S') || '.csv') AS filename
FROM (SELECT *, CASE WHEN conv_id = 0 THEN TIMESTAMP '2024-06-01 12:30:00'
                     ELSE make_timestamp(conv_id * 1000000) END AS received FROM routed)
WHERE role = 'user' AND message_id NOT IN (SELECT message_id FROM log WHERE turn = 2)""")
def report_select(spark, d):
    """Unprocessed messages of one sender, routed to reports, with their attachment."""
    log = message_log(spark, d)
    ledger = log.filter(F.col("message_id").endswith("-2"))
    chosen = reports.select_reports(log, CONFIGS, ledger, "all", "user")
    part = reports.pick_report_attachment(F.col("parts"), F.col("report"), CONFIGS)
    now = F.lit("2024-06-01 12:30:00").cast("timestamp")
    received = reports.received_at(F.col("internal_date_ms"), now)
    header = F.concat(F.lit('attachment; filename="'), part["filename"], F.lit('"'))
    return chosen.select(
        "message_id", "report", "table", "schedule", part["filename"].alias("attachment"),
        reports.resolve_filename(header, F.lit("https://x.example/get?id=1"), F.col("report"), received)
        .alias("filename"))


@query("message_scan", """
SELECT conv_id || '-' || turn AS message_id, CAST(make_timestamp(conv_id * 1000000) + INTERVAL 9 HOUR AS DATE) AS site_day
FROM conversations WHERE role = 'user' AND contains(lower(text), 'the') AND turn % 2 = 0""")
def message_scan(spark, d):
    """Messages of one sender and subject that have an attachment, by the day of the site's zone."""
    log = message_log(spark, d).withColumn("parts", F.when(F.col("message_id").rlike("[02468]$"), F.col("parts")))
    found = reports.messages(log, "USER", "The", with_attachment=True)
    return found.select("message_id", zone_date(F.timestamp_millis("internal_date_ms"), "Asia/Tokyo").alias("site_day"))


@query("full_scan", """
SELECT page_id, url, row_number() OVER (ORDER BY url DESC, page_id) AS position FROM pages ORDER BY url DESC, page_id LIMIT 500""")
def full_scan(spark, d):
    """Pages in the order of a download with a row limit; an empty table would be an error."""
    pages = ordered_scan(table(spark, d, "pages").select("page_id", "url"), [F.col("url").desc(), F.col("page_id").asc()], 500)
    place = F.row_number().over(Window.orderBy(F.col("url").desc(), F.col("page_id").asc()))
    return pages.withColumn("position", place.cast("bigint"))


@query("run_summary", """
SELECT r.report, count(c.conv_id) AS emails_found, CAST(coalesce(sum(length(c.text)), 0) AS BIGINT) AS rows_loaded,
       count(c.conv_id) FILTER (c.turn = 1) AS errors,
       CASE WHEN count(c.conv_id) FILTER (c.turn = 1) = 0 THEN 'OK' ELSE 'ERRORS' END AS status
FROM (VALUES ('daily'), ('weekly'), ('other')) r(report)
LEFT JOIN conversations c ON c.role = CASE r.report WHEN 'daily' THEN 'user' WHEN 'weekly' THEN 'assistant' END
GROUP BY 1""")
def run_summary(spark, d):
    outcomes = table(spark, d, "conversations").select(
        F.when(F.col("role") == "user", "daily").when(F.col("role") == "assistant", "weekly")
        .alias("report"), F.length("text").cast("bigint").alias("rows_loaded"),
        F.when(F.col("turn") == 1, "failed").alias("error"))
    return reports.run_summary(outcomes, CONFIGS)


# --- bodies ---------------------------------------------------------------

@query("quarantine", """
SELECT body, verdict, count(*) AS n, count(*) FILTER (csv_like) AS csv_like
FROM (
  SELECT body, CASE WHEN regexp_matches(lower(ltrim(left(text, 512), ' ' || chr(9) || chr(10) || chr(13))), '^(<!doctype|<html)')
                    THEN 'rejected' ELSE 'accepted' END AS verdict,
         contains(left(text, 200), ',') AND NOT contains(lower(left(text, 200)), '<html') AS csv_like
  FROM (SELECT 'page' AS body, html AS text FROM pages
        UNION ALL SELECT 'document', text FROM documents))
GROUP BY 1, 2""")
def quarantine(spark, d):
    """Pages and documents as delivered bodies: web pages are rejected."""
    bodies = table(spark, d, "pages").select(F.lit("page").alias("body"), F.col("html").alias("text")) \
        .unionByName(table(spark, d, "documents").select(F.lit("document").alias("body"), "text"))
    return reports.judged(bodies, "text").groupBy("body", "verdict").agg(
        F.count("*").alias("n"), F.count_if(reports.looks_csv(F.col("text"))).alias("csv_like"))


_HREFS = """list_transform(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>'),
            lambda x: regexp_extract(x, 'href="([^"]*)"', 1))"""
_WORDS = "contains(lower(x), 'download') OR contains(lower(x), 'export') OR contains(lower(x), 'report')" \
         " OR contains(lower(x), 'csv')"
_SKIP = " OR ".join(f"contains(lower(x), '{w}')" for w in
                    ("mailto:", "unsubscribe", "preferences", "manage", "#"))


@query("html_links", f"""
SELECT page_id, CAST(len(hrefs) AS BIGINT) AS links, array_to_string(hrefs, ' ') AS hrefs,
       coalesce(list_filter(hrefs, lambda x: {_WORDS})[1], list_filter(hrefs, lambda x: NOT ({_SKIP}))[1]) AS download
FROM (SELECT page_id, {_HREFS} AS hrefs FROM pages)""")
def html_links(spark, d):
    links = table(spark, d, "pages").select("page_id", extract_links(F.col("html")).alias("links"))
    return links.select(
        "page_id", F.size("links").cast("bigint").alias("links"),
        F.array_join(F.transform("links", lambda a: a["href"]), " ").alias("hrefs"),
        pick_link(F.col("links")).alias("download"))


# --- headers and types ----------------------------------------------------

_RAW_HEADERS = ["Order Key", " Customer # ", "2024 Total", "% Paid?", "Order Date", "Stamp", "", "Mixed"]


def _text_orders(spark, d):
    text = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)),
        F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit("%")),
        F.date_format("o_orderdate", "M/d/yy"),
        F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a"), F.lit("  "),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string"))
        .otherwise(F.col("o_orderstatus")))
    return text.toDF(*reports.normalise_headers(_RAW_HEADERS))


@query("header_and_types", """
SELECT * FROM (VALUES ('order_key', 'double'), ('customer', 'double'), ('_2024_total', 'double'),
  ('paid', 'double'), ('order_date', 'date'), ('stamp', 'timestamp'), ('col', 'string'),
  ('mixed', 'string')) AS t("column", type)
WHERE (SELECT count(*) FROM orders) > 0""")
def header_and_types(spark, d):
    """Names and types of a text copy of the orders, all rows deciding."""
    return typed.infer_types(_text_orders(spark, d))


@query("sampled_types", """
SELECT * FROM (VALUES ('order_key', 'double'), ('mixed', 'string'), ('late_text', 'double')) AS t("column", type)
WHERE (SELECT count(*) FROM orders) > 0""")
def sampled_types(spark, d):
    """Types by the first 100 filled cells in row order: text after them is not seen."""
    rows = _text_orders(spark, d).select(
        "order_key", "mixed", F.col("order_key").cast("bigint").alias("i"))
    late = F.when(F.col("i") > 1000, F.col("mixed")).otherwise(F.col("order_key"))
    return typed.infer_types(rows.withColumn("late_text", late), 100, "i")


@query("typed_rejects", """
SELECT 'mixed' AS "column", o_orderstatus AS value, count(*) AS rows
FROM orders WHERE o_orderkey % 2 <> 0 GROUP BY 2""")
def typed_rejects(spark, d):
    """Cells that do not fit the frozen type of their column, by value."""
    kinds = {"order_key": "double", "customer": "double", "_2024_total": "double", "paid": "double",
             "order_date": "date", "stamp": "timestamp", "mixed": "double"}
    return typed.coerce(_text_orders(spark, d), kinds)[1]


@query("schema_merge", f"""
SELECT o_orderstatus, count(*) AS n, count(total) AS with_total, count(note) AS with_note,
       CAST(sum({sql_cents('total')}) AS BIGINT) AS total_cents
FROM (SELECT o_orderstatus, o_totalprice AS total, NULL AS note FROM orders
      UNION ALL SELECT c_mktsegment, NULL, c_name FROM customer)
GROUP BY 1""")
def schema_merge(spark, d):
    """A second load brings a new column and lacks an old one."""
    from ..operators.shape import align
    old = table(spark, d, "orders").select("o_orderstatus", F.col("o_totalprice").alias("total"))
    new = table(spark, d, "customer").select(F.col("c_name").alias("note"),
                                             F.col("c_mktsegment").alias("o_orderstatus"))
    merged = typed.merge_schema(old.schema, new.schema)
    both = align(old, merged).unionByName(align(new, merged))
    return both.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.count("total").alias("with_total"),
        F.count("note").alias("with_note"), F.sum(cents("total")).alias("total_cents"))


# --- files ----------------------------------------------------------------

_NOW = "2024-06-01 12:30:00"


def _written(spark, df, name: str, parts: int) -> list[str]:
    """Write CSV report files and list them."""
    path = scratch_path(spark, name)
    df.repartition(parts).write.option("header", True).csv(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return [r["path"] for r in files.select("path").collect()]


@query("ingest_roundtrip", f"""
SELECT o_orderstatus AS status, count(*) AS n, CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) AS total_cents,
       min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day,
       'double' AS price_type, 'date' AS day_type, 4::BIGINT AS files, 0::BIGINT AS second_run
FROM orders GROUP BY 1""")
def ingest_roundtrip(spark, d):
    """Orders as CSV reports: written, selected, typed, stored; a second run loads nothing."""
    text = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_orderstatus").alias("Status"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("Total Price"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("Order Date"))
    paths = _written(spark, text, "reports", 4)
    schema = T.StructType([T.StructField("message_id", T.StringType()),
                           T.StructField("sender", T.StringType()),
                           T.StructField("subject", T.StringType()),
                           T.StructField("internal_date_ms", T.LongType()),
                           T.StructField("path", T.StringType())])
    log = spark.createDataFrame(
        [(f"m{i}", "reports@x.example", "Weekly: Order Report", 1717200000000 + i, p)
         for i, p in enumerate(paths)], schema)
    configs = [reports.ReportConfig("orders", "order report", r".*\.csv", "orders", "weekly")]
    root = scratch_path(spark, "raw")
    now = F.lit(_NOW).cast("timestamp")
    ingest(spark, log, configs, root, f"{root}/_ledger", now, "weekly")
    again = ingest(spark, log, configs, root, f"{root}/_ledger", now, "weekly")
    stored_rows = read_raw(spark, f"{root}/orders")
    kinds = typed.types_of(stored_rows.schema)
    files = stored_rows.agg(F.count_distinct("_gmail_message_id")).scalar()
    second = again.agg(F.count("*")).scalar()
    sums = stored_rows.groupBy("status").agg(
        F.count("*").alias("n"), F.sum(cents("total_price")).alias("total_cents"),
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    return sums.withColumns({"price_type": F.lit(kinds["total_price"]), "day_type": F.lit(kinds["order_date"]),
                             "files": files, "second_run": second})


@query("summary_ingest", """
SELECT event_type, record_count, '{' || string_agg('"' || day || '":' || n, ',' ORDER BY day) || '}' AS day_counts
FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
             CAST(sum(count(*)) OVER (PARTITION BY event_type) AS BIGINT) AS record_count
      FROM events GROUP BY 1, 2) GROUP BY 1, 2""")
def summary_ingest(spark, d):
    """Events as daily list files: one summary row per file is stored, not the rows."""
    text = table(spark, d, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("Day"),
                                            F.col("event_type").alias("Kind"))
    path = scratch_path(spark, "lists")
    text.repartition("event_type").write.partitionBy("event_type").option("header", True).csv(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    listing = files.select("path").select(
        F.regexp_extract("path", "event_type=([a-z]+)", 1).alias("message_id"),
        F.lit("reports@x.example").alias("sender"), F.lit("Daily List").alias("subject"),
        F.lit(1717200000000).alias("internal_date_ms"), "path")
    configs = [reports.ReportConfig("list", "daily list", r".*\.csv", "lists", "daily", ("day", "nothing"))]
    root = scratch_path(spark, "raw")
    ingest(spark, listing, configs, root, f"{root}/_ledger", F.lit(_NOW).cast("timestamp"), "daily")
    return read_raw(spark, f"{root}/lists").select(
        F.col("_gmail_message_id").alias("event_type"), "record_count", "day_counts")


@query("incremental_ingest", f"""
SELECT event_type, count(*) AS n, CAST(sum({sql_cents('value')}) AS BIGINT) AS value_cents, 0 AS second_run
FROM events GROUP BY 1""")
def incremental_ingest(spark, d):
    """Event files through the file stream; the second run finds nothing new."""
    header = ["Event ID", "Event Type", "Value"]
    text = table(spark, d, "events").select(
        F.col("event_id").alias(header[0]), F.col("event_type").alias(header[1]),
        F.col("value").alias(header[2]))
    root = scratch_path(spark, "stream")
    text.repartition(3).write.option("header", True).csv(f"{root}/in")
    kinds = {"event_id": "bigint", "event_type": "string", "value": "double"}

    def run() -> int:
        return load_new_files(spark, f"{root}/in", header, kinds, f"{root}/raw", f"{root}/state")
    run()
    second = run()
    return loaded(spark, f"{root}/raw").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(cents("value")).alias("value_cents"),
        F.lit(second).alias("second_run"))
