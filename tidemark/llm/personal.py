"""Personal data: known shapes, and further candidates judged by boosted trees.

Known shapes (mail address, IP address, card number, phone number) are regular
expressions with a check of their own, and always reported.  High-recall
generators propose further spans, which may overlap: numbers that
failed a check, national phone numbers, social security numbers, account
numbers, spelled-out mail addresses.  A candidate is described by its format and
what stands around it.  The trees learn from the candidates of three quarters of the documents which
descriptions go with a proven format (a check sum, a valid range).  The description
leaves the proof itself out: where the number of digits is the proof, it is no feature.  Thresholds
are calibrated on the other quarter, which the trees have not seen: per kind, the smallest score at
which enough of the chosen candidates are proven.  DataFrame functions only; the driver
sees counts per part and combination of features, at most twice ``CELLS`` of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import boosting
from .spans import listed, outside, tagged, with_spans

# Fixed values of the contract, written so that no match is searched twice and no
# repetition recurses: possessive where what follows cannot match inside.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "tel": r"(?<![0-9+.-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{2,4}[\x20.-]?[0-9]{2,5}(?:[\x20.-][0-9]{2,4})?(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT|@)[\])]\x20?[A-Za-z0-9-]{1,63}"
            r"(?:\x20?(?:\.|[\[(](?:dot|DOT|\.)[\])])\x20?[A-Za-z0-9-]{2,63}){1,4}",
}
KINDS = ("email", "ip", "card", "phone", "tel", "ssn", "iban", "mail")
CUES = (r"(?i)phone|mobile|call|tel\b|tel[.:]|fax", r"(?i)mail|contact|write to", r"(?i)card|visa|account|iban|bank",
        r"(?i)ssn|social|security|passport|id\b")
# levels: kind 8, digits 6, rules 4, before 4, after 4, cue 5
FEATURES = ("kind", "digits", "rules", "before", "after", "cue")
CELLS = 8 * 6 * 4 * 4 * 4 * 5
PRECISION = 0.9
BY_DIGITS = ("phone", "tel")     # kinds proven by their number of digits
PARTS = 4                       # of which one calibrates


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum of card numbers."""
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.get(
        F.array(*map(F.lit, (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
        F.substring(digits, i, F.lit(1)).cast("int") + F.when((n - i) % 2 == 1, 10).otherwise(0)))
    return (n > 0) & (total % 10 == 0)


def remainder_97(value: Column) -> Column:
    """Of an account number whose first four characters go last and letters count from 10."""
    moved = F.concat(F.substr(value, F.lit(5)), F.left(value, F.lit(4)))
    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), lambda a, i: F.when(
        F.substring(moved, i, F.lit(1)).rlike("[0-9]"), (a * 10 + F.substring(moved, i, F.lit(1)).try_cast("int")) % 97)
        .otherwise((a * 100 + F.ascii(F.substring(moved, i, F.lit(1))) - 55) % 97))


def proven(kind: str, value: Column) -> Column:
    """Whether the value itself shows that it is of its kind."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(14, 19) & F.when(F.length(digits) <= 19, luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    if kind == "tel":
        # the generator is wide: three, two and four digits with hyphens are the form of another kind
        return F.length(_digits(value)).between(9, 11) & ~value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    if kind == "ssn":
        return ~value.rlike("^(000|666|9)|-00-|-0000$")
    if kind == "iban":
        compact = F.replace(value, F.lit(" "), F.lit(""))
        return F.length(compact).between(15, 34) & (remainder_97(compact) == 1)
    if kind == "mail":
        return value.rlike(r"[A-Za-z]{2,}$")
    return F.lit(True)


def _side(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[A-Za-z0-9]$"), 2).otherwise(3))


def _described(kind: str) -> Column:
    """The spans of a generator as candidates: place, features and proof."""
    def one(s: Column) -> Column:
        n = F.length(_digits(s["value"]))
        if kind in BY_DIGITS:
            n = F.lit(0)
        cue = F.lit(0)
        for level, words in reversed(list(enumerate(CUES, 1))):
            cue = F.when(s["before"].rlike(words), level).otherwise(cue)
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
            F.when(n == 0, 0).when(n < 7, 1).when(n < 10, 2).when(n < 14, 3).when(n < 20, 4).otherwise(5).alias("digits"),
            F.when(s["value"].rlike(r"[().]"), 3).when(s["value"].contains("-"), 2).when(s["value"].contains(" "), 1)
            .otherwise(0).alias("rules"),
            _side(F.right(s["before"], F.lit(1))).alias("before"), _side(F.left(s["after"], F.lit(1))).alias("after"),
            cue.alias("cue"), proven(kind, s["value"]).alias("proven"))
    return F.transform(kind, one)


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` plus an array of spans per known kind and ``candidates`` with features and proof.

    Rows are handled one by one: repeated rows repeat; a null or empty text has
    empty arrays; columns of those names are replaced.
    """
    docs = docs.drop(*KINDS, "candidates")
    found = with_spans(docs, "text", {**BASE, **MORE})
    found = found.withColumn("candidates", F.concat(*(_described(k) for k in KINDS)))

    def sure(kind: str) -> Column:
        return F.filter(kind, lambda s: proven(kind, s["value"]))

    return found.withColumns({k: sure(k) for k in BASE}).drop(*MORE)


@dataclass(frozen=True)
class Model:
    trees: boosting.Trees
    thresholds: dict[int, float]          # by kind


def fit(found: DataFrame, precision: float = PRECISION) -> Model:
    """Trees from the candidates of most documents, thresholds from those of the others.

    Documents with the same id are in the same part; rows without id are in one part together.  A kind of which the
    calibrating part has too few candidates to show the precision has no threshold, and none is chosen.
    """
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % PARTS == PARTS - 1).alias("held")
    rows = (found.select(held, F.explode("candidates").alias("c"))
            .groupBy("held", *(f"c.{f}" for f in FEATURES))
            .agg(F.count("*").alias("n"), F.sum(F.col("c.proven").cast("int")).alias("positive")).collect())
    cells = sorted((r.asDict() for r in rows), key=lambda c: [c[f] for f in FEATURES])
    trees = boosting.fit([c for c in cells if not c["held"]], FEATURES)
    limits = {}
    for kind in range(len(KINDS)):
        own = [c for c in cells if c["held"] and c["kind"] == kind]
        limits[kind] = boosting.threshold(own, [trees.score(c) for c in own], precision)
    return Model(trees, limits)


def judged(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with ``extra``: candidates at their kind's threshold, outside the known spans.

    Of two chosen candidates that overlap, the higher score stays, then the earlier, then the longer.  Rows are
    judged one by one: repeated rows alike; a null or empty text has no candidates and no ``extra``.
    """
    base = F.concat(*(F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in BASE))
    limits = F.array(*(F.lit(float(model.thresholds[k])) for k in range(len(KINDS))))
    found = found.withColumn("extra", F.transform("candidates", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
        F.round(model.trees.column(lambda f: c[f]), 9).alias("score"))))
    found = found.withColumn("extra", F.filter("extra", lambda c: c["score"] >= F.round(F.get(limits, c["kind"]), 9)))
    found = found.withColumn("extra", outside(F.col("extra"), base))

    def better(o: Column, c: Column) -> Column:
        rank = lambda s: F.struct(-s["score"], s["start"], -s["end"], s["kind"])
        return (o["start"] < c["end"]) & (c["start"] < o["end"]) & (rank(o) < rank(c))

    return found.withColumn("extra", F.filter("extra", lambda c: ~F.exists("extra", lambda o: better(o, c))))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the digest of the known spans and the list of all spans, per row of :func:`judged`."""
    known = F.concat(*(tagged(k, n) for n, k in enumerate(BASE)))
    names = F.array(*map(F.lit, KINDS))
    extra = F.transform("extra", lambda c: F.struct(
        c["start"].alias("start"), (c["kind"] + len(BASE)).alias("rank"), c["end"].alias("end"),
        F.concat(F.lit("likely-"), F.get(names, c["kind"])).alias("kind")))
    return found.select(
        "doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE),
        F.sha2(listed(known).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat(known, extra)).alias("spans"), F.size("extra").cast("bigint").alias("n_likely"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Known and chosen spans of every row, without the texts.

    Texts are read once: spans and features are written to the shared folder, which the fit
    and the choice both read.
    """
    found = stored(with_candidates(docs.select("doc_id", "text")).drop("text"), "personal")
    return judged(found, fit(found))


def redact(judged_docs: DataFrame, to: str = "▮") -> DataFrame:
    """``text`` with every known or chosen span replaced, each by one mark.

    Needs the text beside the spans.  Overlapping spans are replaced as one.  A null text becomes empty.
    """
    spans = F.array_sort(F.concat(*(F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
                                    for k in (*BASE, "extra"))))
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    done = judged_docs.withColumn("_spans", spans)
    cut = F.aggregate("_spans", state, lambda a, s: F.when(s["start"] < a["at"], F.struct(
        F.greatest(a["at"], s["end"]).alias("at"), a["parts"].alias("parts"))).otherwise(F.struct(
            s["end"].alias("at"), F.array_append(a["parts"], F.substr("text", (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))).alias("parts"))))
    done = done.withColumn("_cut", cut)
    tail = F.substr("text", (F.col("_cut.at") + 1).cast("int"))
    return done.withColumn("text", F.concat(F.array_join(F.array_append("_cut.parts", tail), to))).drop("_spans", "_cut")
