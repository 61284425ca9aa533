"""E-mail campaigns, forms and mailing-list totals out of append-only reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_mixed_date
from ..functions.numbers import round_to_long, safe_ratio
from ..operators.latest import latest_per_key
from ..operators.quality import Accepted, NotNull
from ..operators.shape import align, aligned_union, real_loads
from ..schemas import CAMPAIGN_ITEMS, DAILY_TOTALS

LOADED = "_import_timestamp"
STAGED_ITEMS = T.StructType([*CAMPAIGN_ITEMS.fields,
                             T.StructField(LOADED, T.TimestampType()),
                             T.StructField("_source_filename", T.StringType())])


def whole(df: DataFrame, name: str) -> Column:
    """A count column that may arrive as text or double."""
    return round_to_long(F.col(name).cast("double"))


def _dated(first: str, last: str) -> dict[str, Column]:
    start, end = parse_mixed_date(F.col(first)), parse_mixed_date(F.col(last))
    return {"first_date": start, "last_date": end,
            "days_active": F.datediff(end, start).cast("bigint"),
            "year": F.year(start).cast("bigint"), "month": F.month(start).cast("bigint"),
            "month_name": F.date_format(start, "MMMM")}


def _staged(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return align(df.select(*[c.alias(n) for n, c in columns.items()],
                           LOADED, "_source_filename"), STAGED_ITEMS)


def staged_emails(report: DataFrame) -> DataFrame:
    """Newest snapshot of each e-mail; engagement rate = opens + clicks."""
    df = latest_per_key(report, ["email_name"], [LOADED])
    rate = F.round(F.col("unique_open_rate").cast("double")
                   + F.col("unique_click_rate").cast("double"), 4)
    return _staged(df, {
        "type": F.lit("Email"),
        "name": F.coalesce(F.col("email_name").cast("string"), F.lit("(Unnamed Email)")),
        **_dated("first_sent_date", "last_sent_date"),
        "recipients": whole(df, "recipients"),
        **{c: F.col(c) for c in ("unique_open_rate", "unique_click_rate", "bounce_rate",
                                 "unsubscribe_rate", "amount_raised", "avg_contribution_amount",
                                 "conversion_rate", "recipient_list", "excluded_list")},
        "total_contributions": whole(df, "total_contributions"),
        "engagement_rate": rate})


def staged_forms(report: DataFrame) -> DataFrame:
    """Newest snapshot of each form; engagement rate = conversion rate."""
    df = latest_per_key(report, ["form_name"], [LOADED])
    return _staged(df, {
        "type": F.lit("Form"),
        "name": F.coalesce(F.col("form_name").cast("string"), F.lit("(Unnamed Form)")),
        **_dated("first_submission_date", "last_submission_date"),
        "submissions": whole(df, "number_of_submissions"),
        "views": whole(df, "number_of_views"),
        "form_type": F.col("form_type"), "form_status": F.col("form_status"),
        "conversion_rate": F.col("conversion_rate"), "engagement_rate": F.col("conversion_rate"),
        "total_contributions": whole(df, "number_of_contributions"),
        "amount_raised": F.col("total_contribution_amount"),
        "avg_contribution_amount": F.col("average_contribution_amount"),
        "recurring_commitments": whole(df, "number_of_recurring_commitments"),
        "new_contacts": whole(df, "number_of_new_contacts")})


def campaign_items(emails: DataFrame, forms: DataFrame) -> DataFrame:
    """E-mails and forms in one 26-column table; order it when reading."""
    meta = [LOADED, "_source_filename"]
    return aligned_union([staged_emails(emails).drop(*meta), staged_forms(forms).drop(*meta)],
                         CAMPAIGN_ITEMS)


CAMPAIGN_TESTS = [NotNull("type"), Accepted("type", ("Email", "Form")), NotNull("name")]


def daily_totals(lists: Mapping[str, DataFrame], grain: str = "received_at") -> DataFrame:
    """Subscription totals per day and mailing list, 8 columns.

    ``lists`` maps the list name to its summary rows.  Among several loads of a
    delivery the newest counts.  With grain ``received_at`` two deliveries of
    one day both stay, with ``day`` only the newest load of the day does.
    """
    if grain not in ("received_at", "day"):
        raise ValueError("grain is 'received_at' or 'day'")

    def status(name: str) -> Column:
        value = F.get_json_object("subscription_status_counts", f"$.{name}")
        return F.coalesce(value.try_cast("bigint"), F.lit(0))
    rows = None
    for name, df in lists.items():
        part = real_loads(df).select(
            F.col("_email_date").cast("timestamp").alias("_at"), LOADED,
            F.lit(name).alias("source_table"), F.col("record_count").alias("total_records"),
            status("Subscribed").alias("subscribed"), status("Unsubscribed").alias("unsubscribed"))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.withColumn("_email_date", F.col("_at").cast("date"))
    newest = latest_per_key(rows, ["_at" if grain == "received_at" else "_email_date",
                                   "source_table"], [LOADED])
    unknown = F.col("total_records") - F.col("subscribed") - F.col("unsubscribed")

    def percent(name: str) -> Column:
        return F.round(safe_ratio(F.col(name), F.col("total_records")) * 100, 2)
    return align(newest.withColumns({
        "status_unknown": unknown, "pct_subscribed": percent("subscribed"),
        "pct_unsubscribed": percent("unsubscribed")}).drop("_at", LOADED), DAILY_TOTALS)


def unreadable_counts(lists: Mapping[str, DataFrame], names=("Subscribed", "Unsubscribed")):
    """Per list: loads whose JSON has a count that is not a whole number."""
    out = None
    for name, df in lists.items():
        bad = F.lit(False)
        for n in names:
            value = F.get_json_object("subscription_status_counts", f"$.{n}")
            bad = bad | (value.isNotNull() & value.try_cast("bigint").isNull())
        part = df.agg(F.count_if(bad).alias("unreadable")).select(
            F.lit(name).alias("source_table"), "unreadable")
        out = part if out is None else out.unionByName(part)
    return out


def daily_totals_tests(list_names) -> list:
    return [NotNull("_email_date"), NotNull("source_table"),
            Accepted("source_table", tuple(list_names)), NotNull("total_records")]


# The staging tests: both staged tables need a type and a name.
STAGED_TESTS = [NotNull("type"), NotNull("name")]
