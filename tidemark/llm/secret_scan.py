"""Secret scans: known shapes of keys, and windows of high entropy.

Known shapes are regular expressions.  Beyond them, long unbroken strings with a digit or with
letters of both cases mixed are candidates, without the words and short numbers of a path before them: a window slides over each, the counts of its characters
are kept up by adding one and taking one away, and so is the sum of n log n, from
which the window's Shannon entropy follows.  Strings of hexadecimal digits
and other strings have thresholds of their own.  The allow-list drops well-known
harmless shapes.  All of it is DataFrame functions; no row leaves its task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import listed, outside, tagged, with_spans

# fixed values of the contract
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KNOWN = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
ASSIGNED_LENGTH = 6

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# entropy in bits that a window must reach; 20 different characters have 4.32
LEAST_BITS = {"hex": 3.0, "other": 3.6}
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",        # UUID
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx|your[_-]",  # fill-in values
    r"(?i)0123456789|123456789|abcdefghijk",                         # counting
    r"^[0-9+/_=-]+$",                                                # digits and rules only
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T_-]",                             # time stamps
    # paths and names of words and short numbers
    r"^(?:(?:[A-Za-z]++[0-9]{0,4}+|[0-9]{1,4}+)[/_=-]++)++(?:[A-Za-z]++[0-9]{0,4}+|[0-9]{1,4}+)?$",
)
# words and short numbers in front, as of a path: what stands behind them is judged by itself
LEAD = r"^(?:(?:[A-Za-z]++[0-9]{0,4}+|[0-9]{1,4}+)[/=-]++)++"
SWITCHES = 6                            # without a digit, one in so many characters must be a small letter before a capital
SCALE = 1_000_000                       # n log2 n as whole numbers: sums don't depend on their order
WEIGHT = [round(n * math.log2(n) * SCALE) if n else 0 for n in range(WINDOW + 2)]


def hot_ranges(value: Column) -> Column:
    """(start, end) of the part of a string whose windows reach the entropy; null without one.

    The state holds the counts of the string's distinct characters, the sum of
    n log n over the window, and the first and last window that was hot.
    """
    chars = F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(value, i, F.lit(1)))
    bits = F.when(value.rlike("^[0-9a-fA-F]+$"), LEAST_BITS["hex"]).otherwise(LEAST_BITS["other"])
    packed = F.struct(chars.alias("chars"), F.array_distinct(chars).alias("letters"),
                      ((math.log2(WINDOW) - bits) * WINDOW * SCALE).cast("bigint").alias("most"))
    weight = F.array(*(F.lit(w).cast("bigint") for w in WEIGHT))

    def slide(p: Column) -> Column:
        def moved(counts: Column, place: Column, by: int) -> Column:
            return F.transform(counts, lambda n, k: F.when(k == place, n + by).otherwise(n))

        def step(a: Column, i: Column) -> Column:
            came = F.array_position(p["letters"], F.get(p["chars"], i)).cast("int") - 1
            gone = F.when(i >= WINDOW, F.array_position(p["letters"], F.get(p["chars"], i - WINDOW)).cast("int") - 1)
            n = F.get(a["counts"], came)
            more = a["sum"] + F.get(weight, n + 1) - F.get(weight, n)
            added = moved(a["counts"], came, 1)
            return take(F.struct(added.alias("counts"), more.alias("sum"), gone.alias("gone"),
                                 a["first"].alias("first"), a["last"].alias("last")), i)

        def take(b: Column, i: Column) -> Column:
            """Remove the character that left the window, then judge the window."""
            return F.get(F.transform(F.array(b), lambda c: judged(c, i)), 0)

        def judged(c: Column, i: Column) -> Column:
            m = F.get(c["counts"], c["gone"])
            total = F.when(c["gone"].isNull(), c["sum"]).otherwise(c["sum"] + F.get(weight, m - 1) - F.get(weight, m))
            counts = F.when(c["gone"].isNull(), c["counts"]).otherwise(moved(c["counts"], c["gone"], -1))
            hot = (i >= WINDOW - 1) & (total <= p["most"])
            return F.struct(counts.alias("counts"), total.alias("sum"),
                            F.when(hot & c["first"].isNull(), i - (WINDOW - 1)).otherwise(c["first"]).alias("first"),
                            F.when(hot, i + 1).otherwise(c["last"]).alias("last"))

        zero = F.struct(F.transform(p["letters"], lambda _: F.lit(0)).alias("counts"),
                        F.lit(0).cast("bigint").alias("sum"), F.lit(None).cast("int").alias("first"),
                        F.lit(None).cast("int").alias("last"))
        return F.aggregate(F.sequence(F.lit(0), F.size(p["chars"]) - 1), zero, step)

    return F.get(F.transform(F.array(packed), slide), 0)


def find_secrets(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` plus ``assign``, ``access``, ``hex`` and ``entropy``: arrays of spans.

    Every row is handled by itself: repeated rows repeat, null and empty texts
    have empty arrays, columns of those names are replaced.  The allow-list is tested on what
    is judged, so ``sample/`` or ``your-`` before a key hides nothing.  An entropy span
    that overlaps a known shape is left out, as that one reports it.
    """
    docs = docs.drop(*KNOWN, "entropy")
    found = with_spans(docs, "text", {**KNOWN, "entropy": CANDIDATE})
    harmless = F.lit(False)
    found = found.withColumn("assign", F.filter("assign", lambda s: F.length(
        F.regexp_extract(s["value"], ASSIGN, 1)) >= ASSIGNED_LENGTH))
    base = F.concat(*(F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in KNOWN))

    def judged(s: Column) -> Column:
        rest = F.regexp_replace(s["value"], LEAD, "")
        value = F.when(F.length(rest) >= WINDOW, rest).otherwise(s["value"])
        return F.struct((s["end"] - F.length(value)).alias("start"), value.alias("value"), s["before"].alias("before"), s["after"].alias("after"))

    def suspicious(s: Column) -> Column:
        bad = harmless
        for pattern in allowed:
            bad = bad | s["value"].rlike(pattern)
        mixed = F.regexp_count(s["value"], F.lit("[a-z][A-Z]")) * SWITCHES >= F.length(s["value"])
        return (s["value"].rlike("[0-9]") | mixed) & ~bad

    found = found.withColumn("entropy", F.filter(F.transform("entropy", judged), suspicious))
    found = found.withColumn("entropy", F.transform("entropy", lambda s: F.struct(
        s["start"].alias("at"), s["value"].alias("text"), s["before"].alias("before"), s["after"].alias("after"),
        hot_ranges(s["value"]).alias("hot"))))
    found = found.withColumn("entropy", F.transform(
        F.filter("entropy", lambda s: s["hot"]["first"].isNotNull()),
        lambda s: F.struct((s["at"] + s["hot"]["first"]).alias("start"), (s["at"] + s["hot"]["last"]).alias("end"),
                           F.substring(s["text"], s["hot"]["first"] + 1, s["hot"]["last"] - s["hot"]["first"]).alias("value"),
                           s["before"].alias("before"), s["after"].alias("after"))))
    return found.withColumn("entropy", outside(F.col("entropy"), base))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the digest of the known shapes and the list of all spans, per row."""
    known = F.concat(*(tagged(k, n) for n, k in enumerate(KNOWN)))
    return found.select(
        "doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k in KNOWN),
        F.sha2(listed(known).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat(known, tagged("entropy", len(KNOWN)))).alias("spans"),
        F.size("entropy").cast("bigint").alias("n_entropy"))
