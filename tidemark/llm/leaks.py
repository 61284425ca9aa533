"""Benchmark decontamination with template windows.

Texts are brought to a form in which numbers, names and units are typed
placeholders: ``Ann has 12 kg`` and ``Bob has 7 lb`` have the same template.  A capitalised
word that may only open a sentence is itself in one form and a name in a second one.  Hashes of
all windows of eight tokens of all documents are joined with those of the benchmark
items.  Hits are summed per document, item and diagonal.  Every diagonal is judged by itself,
together with those of its neighbours that do not contradict it.  A document holds an item if
windows with the item's own values, wherever they are, cover enough of it, or if those of
one place do and replace its values consistently: one value always by the same other one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 8
LEAST_TOKENS = 3                # shorter items would be found anywhere; they must be a whole sentence
COVER = 0.3                     # share of an item's windows
SHIFT = 6                       # diagonals up to this far from another one can count with it
BROADCAST_WINDOWS = 200_000     # benchmark windows that are broadcast at most; beyond it, a shuffled join
MARKS = 1 << 16                 # bytes of a table of marks at most; a fuller one only lets more windows through to the join

# private characters, taken out of texts first
NUMBER, NAME, UNIT, JOINER, OPENER = "\ue010", "\ue011", "\ue012", "\ue013", "\ue014"
UNITS = ("km|m|cm|mm|mi|miles?|feet|ft|inch(?:es)?|kg|g|mg|lbs?|pounds?|tons?|l|ml|litres?|liters?|gallons?|"
         "s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|mph|kmh|watts?|kw|volts?|euros?|"
         "dollars?|cents?|percent|degrees?")


def tokens(text: Column) -> Column:
    """Lower-case words; numbers, names, units and other capitalised words have their mark in front.

    A name is a capitalised word after a lower-case letter, comma or semicolon and a
    space, elsewhere it is marked as an opener; a unit stands after a number, a currency sign before one.
    """
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{NUMBER}-{OPENER}]", " ")
    t = F.regexp_replace(t, r"(?<=[0-9])[.,](?=[0-9])", JOINER)
    t = F.regexp_replace(t, r"(?<=[\p{Ll},;] )\p{Lu}\p{L}*+", f"{NAME}$0")
    t = F.regexp_replace(t, f"[0-9][0-9{JOINER}]*+", f" {NUMBER}$0 ")
    t = F.regexp_replace(t, f"(?i)({NUMBER}[0-9{JOINER}]*+ {{1,2}})({UNITS}|%)(?![\\p{{L}}])", f"$1{UNIT}$2")
    t = F.regexp_replace(t, f"[$€£](?= ? {NUMBER})", f" {UNIT}$0")
    t = F.regexp_replace(t, f"(?=\\p{{Lu}})(?<![\\p{{L}}\\p{{M}}{NUMBER}-{OPENER}0-9])\\p{{Lu}}\\p{{L}}*+", f"{OPENER}$0")
    return F.filter(F.split(F.lower(t), f"(?:[^\\p{{L}}\\p{{M}}{NUMBER}-{OPENER}0-9%$€£]|(?<!{UNIT})[%$€£])++"), lambda w: w != "")


def _is_slot(token: Column) -> Column:
    return token.between(NUMBER, UNIT + "\U0010ffff")


def marked(hashes: DataFrame) -> bytearray:
    """A byte for each of the low bits a hash of the one column can have: 1 for those that occur.

    The driver holds the table and every task gets it, so it has ``MARKS`` bytes at most, however many hashes there are.
    """
    size = 1 << min(max((8 * hashes.count()).bit_length(), 10), MARKS.bit_length() - 1)
    out = bytearray(size)
    for r in hashes.select(F.col(hashes.columns[0]).bitwiseAND(F.lit(size - 1)).cast("int").alias("low")).distinct().collect():
        out[r["low"]] = 1
    return out


def _has_mark(marks: Column, value: Column) -> Column:
    low = value.bitwiseAND(F.octet_length(marks) - 1).cast("int")
    return F.substring(marks, low + 1, F.lit(1)) == F.lit(bytearray(b"\1"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _opens(token: Column) -> Column:
    return token.startswith(OPENER)


def _word(token: Column) -> Column:
    return F.substring(token, 2, 1 << 30)


def form_hash(token: Column, opener=_word) -> Column:
    """Hash of what a token is in a template: its mark if it is a placeholder, ``opener`` of it if it opens a sentence."""
    return F.xxhash64(F.when(_is_slot(token), F.left(token, F.lit(1))).when(_opens(token), opener(token)).otherwise(token))


@dataclass(frozen=True)
class Asked:
    """Marks of the templates asked for and of the tokens they are made of."""

    templates: bytearray
    vocabulary: bytearray

    def beside(self, df: DataFrame) -> DataFrame:
        """``df`` and both tables, as columns whose value a plan names but doesn't hold.

        As literals they stood in every text of the plan, which the driver writes anew whenever
        a stage ends, once for each level of the expression around them.
        """
        one = df.sparkSession.createDataFrame([(self.templates, self.vocabulary)], "templates binary, vocabulary binary")
        return df.select("*", one.select("templates").scalar().alias("_templates"), one.select("vocabulary").scalar().alias("_vocabulary"))


def _known(tokens: Column, vocabulary: Column) -> Column:
    """A byte for each token: ``1`` if it may be part of a template, else ``0``.  Bytes, as a place in them is found at once."""
    return F.array_join(F.transform(tokens, lambda t: F.when(_opens(t) | _has_mark(vocabulary, form_hash(t)), "1").otherwise("0")), "").cast("binary")


def with_windows(df: DataFrame, widths: list[int], keep: list[str], asked: Asked | None = None) -> DataFrame:
    """One row per window and form: ``at``, ``width``, ``named``, ``template`` (hash), ``slots`` (its values).

    In the second form (``named``) openers are names; it is there for windows with an opener,
    unless they were all placeholders, which any text could fill.  With ``asked``, windows with a token
    that no template has, and those whose template has no mark, are left out before they become rows;
    nothing else is worked out for a text without a run of known tokens.
    """
    def found(t: Column, known: Column | None, width: int, marks: Column | None) -> Column:
        def hashed(tokens: Column, opener) -> Column:
            return F.xxhash64(F.transform(tokens, lambda x: form_hash(x, opener)))

        def wanted(template: Column) -> Column:
            return F.lit(True) if marks is None else _has_mark(marks, template)

        def row(c: Column, named: bool) -> Column:
            opener = (lambda x: F.concat(F.lit(NAME), _word(x))) if named else (lambda x: F.lit(""))
            slots = F.transform(c["tokens"], lambda x: F.when(_is_slot(x), x).when(_opens(x), opener(x)).otherwise(F.lit("")))
            return F.struct(c["at"].alias("at"), F.size(t).alias("n_tokens"), F.lit(width).alias("width"), F.lit(named).alias("named"),
                            c["named" if named else "plain"].alias("template"), F.array_remove(slots, "").alias("slots"))

        places = F.sequence(F.lit(0), F.size(t) - width)
        if known is not None:
            places = F.filter(places, lambda i: F.substring(known, i + 1, F.lit(width)) == ones(width))
        cut = F.transform(places, lambda i: F.struct(i.alias("at"), F.slice(t, i + 1, width).alias("tokens")))
        hashes = F.transform(cut, lambda c: F.struct(
            c["at"].alias("at"), c["tokens"].alias("tokens"), hashed(c["tokens"], _word).alias("plain"),
            F.when(F.exists(c["tokens"], _opens) & F.exists(c["tokens"], lambda x: ~_is_slot(x) & ~_opens(x)),
                   hashed(c["tokens"], lambda x: F.lit(NAME))).alias("named")))
        return F.when(F.size(t) >= width, F.concat(
            F.transform(F.filter(hashes, lambda c: wanted(c["plain"])), lambda c: row(c, False)),
            F.transform(F.filter(hashes, lambda c: c["named"].isNotNull() & wanted(c["named"])), lambda c: row(c, True)))).otherwise(empty)

    empty = F.array().cast("array<struct<at:int,n_tokens:int,width:int,named:boolean,template:bigint,slots:array<string>>>")

    def ones(n: int) -> Column:
        return F.lit(bytearray(b"1" * n))

    def windows(t: Column) -> Column:
        if asked is None:
            return F.concat(*(found(t, None, w, None) for w in widths))
        # each table is bound once a row: a column's bytes would be copied for every token
        return _let(F.col("_vocabulary"), lambda vocabulary: _let(_known(t, vocabulary), lambda known: F.when(
            F.contains(known, ones(min(widths))),
            _let(F.col("_templates"), lambda marks: F.concat(*(found(t, known, w, marks) for w in widths)))).otherwise(empty)))

    df = df if asked is None else asked.beside(df.select(*keep, "text"))
    return (df.select(*keep, F.explode(_let(tokens(F.col("text")), windows)).alias("w"))
            .select(*keep, "w.n_tokens", "w.at", "w.width", "w.named", "w.template", "w.slots"))


def short_leaks(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Rows as of :func:`find_leaks` for items of under ``LEAST_TOKENS`` tokens: documents with a sentence that is the item.

    A sentence ends at the text's end, at a line's, or at a full stop, question or exclamation mark before space.
    """
    def whole(text: Column) -> Column:
        return F.regexp_replace(F.array_join(tokens(text), " "), f"[{NUMBER}{NAME}{UNIT}{OPENER}]", "")

    asked = items.where(F.size(tokens(F.col("text"))).between(1, LEAST_TOKENS - 1)).select("item_id", whole(F.col("text")).alias("whole"))
    sentences = F.transform(F.split(F.coalesce("text", F.lit("")), r"[.!?]++(?=\s|$)|[\r\n]++"), whole)
    said = texts.select("doc_id", "text_hash", F.explode(F.array_distinct(sentences)).alias("whole"))
    return (said.join(asked.distinct(), "whole").select("doc_id", "text_hash", "item_id").distinct()
            .select("*", F.lit(1.0).alias("cover"), F.lit(True).alias("same_values")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """One row per document and item it holds: ``doc_id``, ``text_hash``, ``item_id``, ``cover``, ``same_values``.

    ``text_hash`` tells apart rows of one id; rows alike in both count once.
    ``cover`` is the largest share of the item's windows found in one place (or of those with
    its own values in all places), ``same_values`` whether all placeholders of a place that
    holds the item have the item's own values.  Null texts are empty; items of under eight tokens are one
    window, those of one or two must be a whole sentence, those without any are left out.
    """
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    sizes = [r["n"] for r in items.select(F.least(F.size(tokens(F.col("text"))), F.lit(WIDTH)).alias("n")).distinct().collect()]
    widths = sorted((n for n in sizes if n >= LEAST_TOKENS), reverse=True) or [WIDTH]     # at most six
    asked = (with_windows(items, widths, ["item_id"])
             .where(F.col("width") == F.least(F.col("n_tokens"), F.lit(WIDTH)))
             .select("item_id", (F.col("n_tokens") - F.col("width") + 1).alias("windows"), F.col("at").alias("q"),
                     "width", "template", F.col("named").alias("own_named"), F.col("slots").alias("own")))
    marks = None
    if asked.count() <= BROADCAST_WINDOWS:
        words = items.select(F.explode(tokens(F.col("text"))).alias("t")).select(
            F.explode(F.array(form_hash(F.col("t")), F.xxhash64(F.lit(NAME)))).alias("hash")).distinct()
        marks = Asked(marked(asked.select("template").distinct()), marked(words))
        asked = F.broadcast(asked)
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    hits = with_windows(texts, widths, ["doc_id", "text_hash"], marks).join(asked, ["template", "width"])
    none = F.array().cast("array<string>")
    pairs = F.transform(F.arrays_zip(F.coalesce("own", none).alias("own"), F.coalesce("slots", none).alias("now")),
                        lambda p: F.struct(p["own"].alias("own"), p["now"].alias("now")))
    hits = hits.withColumn("pairs", pairs).where(F.size(F.coalesce("own", none)) == F.size(F.coalesce("slots", none)))
    # the first form is judged alone too: openers may differ where nothing was replaced
    forms = F.when(F.col("named") | F.col("own_named"), F.array(F.lit(True))).otherwise(F.array(F.lit(False), F.lit(True)))
    hits = hits.withColumn("both_forms", F.explode(forms))
    one = ["doc_id", "text_hash", "item_id", "windows"]
    same = F.forall("pairs", lambda p: p["own"] == p["now"])
    diagonals = (hits.withColumn("diagonal", F.col("at") - F.col("q")).groupBy(*one, "both_forms", "diagonal")
                 .agg(F.collect_set("q").alias("qs"), F.collect_set(F.when(same, F.col("q"))).alias("same_qs"),
                      F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")))
    around = Window.partitionBy(*one, "both_forms").orderBy("diagonal").rangeBetween(-SHIFT, SHIFT)
    near = F.collect_list(F.struct("diagonal", "qs", "pairs")).over(around)

    def consistent(pairs: Column) -> Column:
        return F.size(F.array_distinct(F.transform(pairs, lambda p: p["own"]))) == F.size(pairs)

    def added(a: Column, d: Column) -> Column:
        pairs = F.array_distinct(F.concat(a["pairs"], d["pairs"]))
        return F.when(consistent(pairs), F.struct(pairs.alias("pairs"), F.array_union(a["qs"], d["qs"]).alias("qs"))).otherwise(a)

    # the diagonal itself, then the fullest of its neighbours first
    ranked = F.array_sort(F.transform("near", lambda d: F.struct(
        (d["diagonal"] != F.col("diagonal")).alias("other"), (-F.size(d["qs"])).alias("fewer"), d["diagonal"].alias("diagonal"),
        d["qs"].alias("qs"), d["pairs"].alias("pairs"))))
    nothing = F.struct(F.array().cast("array<struct<own:string,now:string>>").alias("pairs"), F.array().cast("array<int>").alias("qs"))
    places = diagonals.withColumn("near", near).withColumn("fit", F.aggregate(ranked, nothing, added))
    plain = F.forall("pairs", lambda p: p["own"] == p["now"])
    fit, own_values = F.size("fit.qs"), F.forall("fit.pairs", lambda p: p["own"] == p["now"])
    judged = (places.select(*one, F.size(F.array_distinct(F.flatten(F.col("near.qs")))).alias("found"), fit.alias("fit"),
                            F.when(own_values, fit).alias("fit_same"), "same_qs", plain.alias("plain"))
              .groupBy(*one).agg(F.max("found").alias("found"), F.max("fit").alias("fit"), F.max("fit_same").alias("fit_same"),
                                 F.size(F.array_distinct(F.flatten(F.collect_set("same_qs")))).alias("same"), F.min("plain").alias("plain")))

    def share(count: str) -> Column:
        return F.col(count) / F.col("windows")

    held = judged.where((share("same") >= cover) | (share("fit") >= cover))
    found = held.select("doc_id", "text_hash", "item_id", F.round(F.greatest(share("found"), share("same")), 6).alias("cover"),
                       (F.col("plain") | F.coalesce(share("fit_same") >= cover, F.lit(False))).alias("same_values"))
    return found.unionByName(short_leaks(texts, items)) if any(0 < n < LEAST_TOKENS for n in sizes) else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """The rows of ``docs`` that hold no item.

    Rows alike in id and text go or stay together; a null or empty text holds nothing and stays, a null id is an id like
    others.  An empty table, or an empty benchmark, changes nothing.  Other columns pass through; none may be called
    ``_id``, ``_hash`` or ``_own_hash``.
    """
    leaks = find_leaks(docs, benchmark, cover).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    keyed = docs.withColumn("_own_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.join(leaks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash")),
                      "left_anti").drop("_own_hash")
