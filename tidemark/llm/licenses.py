"""License scans by diagonal voting.

Texts and templates are word sequences.  Every word is hashed once, and the rolling hash of each
run of three words is a polynomial of theirs, by two primes side by side (61 bits).  The hashes of all texts
are joined with the places of the same runs in the templates, which are few
and fixed, so they are broadcast.  A hit at text place p and template place q
votes for the diagonal p - q.  Votes are summed per text, template and
diagonal; neighbouring diagonals (a word put in or left out) are merged; a merged
place is kept if its words cover enough of the template in the template's
order.  A base phrase is a template that must be covered whole on one diagonal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRAM = 3
PRIME, OTHER = (1 << 31) - 1, (1 << 30) - 35        # moduli of the rolling hashes; products of two residues fit a long
BASE = 1_000_003
NO_GRAM = -1                    # stands for the text itself; rolling hashes are not negative
SHIFT = 6                       # diagonals up to this far apart are one place
COVER = 0.6                     # share of a template's runs that a place must hold

# fixed values of the contract
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Openings of well-known public licence notices, as published with the licences.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
           "associated documentation files the software to deal in the software without restriction",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in "
                "compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted "
           "provided that the following conditions are met",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
           "general public license as published by the free software foundation",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
}
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case only; other letters stay as they are."""
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.filter(F.split(lower, SEPARATORS), lambda w: w != "")


def rolling_hashes(w: Column, n_words: Column) -> Column:
    """The hash of each run of ``GRAM`` words, in order; none for fewer words.

    A run's hash is the sum of its words' hashes times falling powers of ``BASE``, modulo each prime.
    """
    powers = [[pow(BASE, GRAM - 1 - k, p) for k in range(GRAM)] for p in (PRIME, OTHER)]

    def residue(h: Column, at: Column, prime: int, power: list[int]) -> Column:
        total = F.lit(0).cast("bigint")
        for k in range(GRAM):
            total = (total + F.pmod(F.get(h, at + k), F.lit(prime)) * F.lit(power[k])) % F.lit(prime)
        return total

    def run(h: Column, at: Column) -> Column:
        return F.shiftleft(residue(h, at, PRIME, powers[0]), 30).bitwiseOR(residue(h, at, OTHER, powers[1]))

    hashed = F.transform(w, lambda x: F.xxhash64(x))
    # bound once: a lambda that names an array of expressions would hash the words anew for each run
    rolled = F.transform(F.array(hashed), lambda h: F.transform(F.sequence(F.lit(0), n_words - GRAM), lambda i: run(h, i)))
    return F.when(n_words >= GRAM, F.get(rolled, 0))


def _template_rows(phrases: dict[str, str], templates: dict[str, str]) -> list[tuple]:
    rows = []
    for n, (label, text, is_phrase) in enumerate([(v, k, True) for k, v in phrases.items()]
                                                 + [(k, v, False) for k, v in templates.items()]):
        w = text.split()
        if len(w) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text}")
        rows += [(n, label, is_phrase, len(w) - GRAM + 1, q, " ".join(w[q:q + GRAM])) for q in range(len(w) - GRAM + 1)]
    return rows


def template_grams(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """The places of all runs of all templates, with the same hashes as texts have."""
    rows = spark.createDataFrame(_template_rows(phrases, templates), "template int, label string, is_phrase boolean, runs int, q int, gram string")
    return rows.withColumn("gram", F.get(rolling_hashes(F.split("gram", " "), F.lit(GRAM)), 0))


def find_places(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per distinct (doc_id, text): ``copies``, ``n_words`` and ``places``.

    ``copies`` is how often the row occurs.  A place is (label, is_phrase, start,
    end, cover), in words from 0, the end exclusive.  Null text: empty; a text of fewer words than a run has
    no place.  A null id is an id like others; only ``doc_id`` and ``text`` are read.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.length(text).alias("n_chars"), words(text).alias("w"))
    sized = split.withColumn("n_words", F.size("w"))
    # place -1 stands for the text itself, so that every text comes through the join with its length
    grams = rolling_hashes(F.col("w"), F.col("n_words"))
    marker = F.lit(NO_GRAM).cast("bigint")
    every = sized.select("doc_id", "text_hash", "n_chars", "n_words", F.posexplode(
        F.concat(F.array(marker), F.coalesce(grams, F.array().cast("array<bigint>")))).alias("at", "gram"))
    known = template_grams(docs.sparkSession, phrases, templates)
    known = known.unionByName(known.limit(1).select(
        F.lit(-1).alias("template"), F.lit("").alias("label"), F.lit(False).alias("is_phrase"), F.lit(1).alias("runs"),
        F.lit(-1).alias("q"), marker.alias("gram")))
    hits = every.join(F.broadcast(known), "gram").withColumn("p", F.col("at") - 1)
    key = ["doc_id", "text_hash", "n_chars", "n_words"]
    one = [*key, "template", "label", "is_phrase", "runs"]
    diagonals = (hits.withColumn("diagonal", F.when(F.col("template") >= 0, F.col("p") - F.col("q")))
                 .groupBy(*one, "diagonal")
                 .agg(F.count("*").alias("votes"), F.collect_set("q").alias("qs")))
    return _merged(diagonals, key, one)


def _merged(diagonals: DataFrame, key: list[str], one: list[str]) -> DataFrame:
    """Neighbouring diagonals of a template joined to places, and these gathered per text."""
    own = Window.partitionBy(*one).orderBy("diagonal")
    # phrases are not merged: each diagonal is a place of its own
    chained = diagonals.withColumn("fresh", (F.col("is_phrase") | F.lag("diagonal").over(own).isNull() | (
        F.col("diagonal") - F.lag("diagonal").over(own) > SHIFT)).cast("int"))
    chained = chained.withColumn("place", F.sum("fresh").over(own))
    places = chained.groupBy(*one, "place").agg(
        F.min(F.col("diagonal") + F.array_min("qs")).alias("start"),
        (F.max(F.col("diagonal") + F.array_max("qs")) + GRAM).alias("end"),
        F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs"), F.max("votes").alias("votes"))
    # verified: enough different runs of the template, in a stretch not much longer than it
    covered = F.size("qs") / F.col("runs")
    good = F.when(F.col("is_phrase"), covered == 1).otherwise(
        (covered >= COVER) & (F.col("end") - F.col("start") <= 2 * (F.col("runs") + GRAM)))
    return (places.groupBy(*key).agg(
        F.max(F.when(F.col("template") < 0, F.col("votes"))).alias("copies"),
        F.array_sort(F.collect_list(F.when((F.col("template") >= 0) & good, F.struct(
            "start", "end", "label", "is_phrase", covered.alias("cover"))))).alias("places")))


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Digest per row: counts, first and last base place, labels and a score.

    Repeated rows get a row each.  Needs ``doc_id`` and ``text`` only.
    """
    found = find_places(docs, phrases, templates)
    base = F.filter("places", lambda p: p["is_phrase"])

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    starts = F.transform(base, lambda p: p["start"].cast("bigint"))
    wide = found.select(
        "doc_id", "copies", F.col("n_words").cast("bigint").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["cover"])), F.lit(0.0)).alias("score"))
    return (wide.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
            .drop("copy", "copies"))
