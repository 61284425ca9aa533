"""Places of regular expressions in texts, with DataFrame functions only.

Spark's regex functions return matches without their places.  Here every
match is put between two marks, the text is split at the marks, and running
sums of the pieces' lengths are the places, in code points.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, STAND_IN = "\ue000", "\ue001"     # a mark inside a text is read as the other one: same length, no pattern has either
BLOCK = 256                             # lengths are summed by blocks, so that many matches stay cheap
CONTEXT = 32


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)


def with_spans(df: DataFrame, text: str, patterns: Mapping[str, str]) -> DataFrame:
    """One column per pattern: its leftmost non-overlapping matches, in order.

    Each is an array of (start, end, value, before, after): places are code points
    from 0, the end exclusive; ``before`` and ``after`` hold up to 32 characters
    around it, not beyond the neighbouring match.  A null text has no match.
    """
    names = list(patterns)
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(STAND_IN))
    df = df.withColumn("_safe", safe)
    df = df.withColumns({f"_p_{n}": F.split(F.regexp_replace("_safe", f"({patterns[n]})", f"{MARK}$1{MARK}"), MARK, -1)
                         for n in names}).drop("_safe")
    df = df.withColumns({f"_l_{n}": F.when(F.size(f"_p_{n}") > 1,
                                           F.transform(f"_p_{n}", lambda p: F.length(p).cast("bigint"))) for n in names})

    def block_starts(n: str) -> Column:
        lengths = F.col(f"_l_{n}")
        none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
        return F.when(lengths.isNotNull(), F.aggregate(blocks, none, lambda a, b: F.struct(
            (a["at"] + _sum(F.slice(lengths, b * BLOCK + 1, BLOCK))).alias("at"),
            F.array_append(a["starts"], a["at"]).alias("starts")))["starts"])

    df = df.withColumns({f"_b_{n}": block_starts(n) for n in names})

    def spans(n: str) -> Column:
        parts, lengths, starts = F.col(f"_p_{n}"), F.col(f"_l_{n}"), F.col(f"_b_{n}")

        def one(i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            start = F.get(starts, block) + _sum(F.slice(lengths, block * BLOCK + 1, i - block * BLOCK))
            value, before, after = F.get(parts, i), F.get(parts, i - 1), F.get(parts, i + 1)
            return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
                            F.right(before, F.lit(CONTEXT)).alias("before"), F.left(after, F.lit(CONTEXT)).alias("after"))

        empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>")
        return F.when(lengths.isNull(), empty).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), one))

    df = df.withColumns({n: spans(n) for n in names})
    return df.drop(*(f"_{k}_{n}" for n in names for k in "plb"))


def tagged(name: str, order: int) -> Column:
    """The spans of a kind as (start, rank of the kind, end, kind)."""
    return F.transform(name, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rank"),
                                                s["end"].alias("end"), F.lit(name).alias("kind")))


def listed(spans: Column) -> Column:
    """kind:start:end, by start, then rank, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def outside(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))
