"""Links of an HTML body, and the choice of the download link among them."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squash

# Words that mark a download link, and links never to follow.
HREF_WORDS = ["download", "export", "report", "csv"]
SKIPPED_WORDS = ["mailto:", "unsubscribe", "preferences", "manage", "#"]


# An anchor reaches to the next end tag; another start tag before that begins anew.
# Possessive, so that no body is searched twice.
_ANCHOR = r"(?is)<a(?=[\s>/])[^>]*+>(?:(?!<a[\s>/]|</a)[\s\S])*+</a"
_HREF = r"""(?is)[\s"'/]href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
# Named character references, and numbers that mean another character.
# By first letter, so that a lookup passes few of the two thousand names; some may end without a semicolon.
_NAMED = json.dumps({first: {f"&{name}": char for name, char in html5.items() if name[0] == first}
                     for first in sorted({name[0] for name in html5})})
_OPEN = "^&(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
_MOVED = json.dumps({str(k): bytes([k]).decode("cp1252", "ignore") or chr(k) for k in range(0x80, 0xA0)} | {"13": "\r"})
_PIECES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*[;=]?)|[^&]+|&"


def _plain(text: Column, in_address: bool = False) -> Column:
    """``text`` with its character references decoded, once.

    A name without semicolon is decoded where HTML knows it so (``&copy``).  In a text the longest such name that a
    word begins with counts; in an address the whole word must be one and no ``=`` may follow, which keeps
    parameters (``&copy=1``) as they are.
    """
    named = F.from_json(F.lit(_NAMED), "map<string,map<string,string>>")
    moved = F.from_json(F.lit(_MOVED), "map<string,string>")

    def meaning(name: Column) -> Column:
        return F.try_element_at(F.try_element_at(named, F.substring(name, 2, 1)), name)

    def word(p: Column) -> Column:
        if in_address:
            return F.coalesce(meaning(p), p)
        known = F.regexp_extract(p, _OPEN, 0)
        return F.coalesce(meaning(p), F.concat(meaning(known), F.substr(p, F.length(known) + 1)), p)

    def char(number: Column) -> Column:
        good = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        code = F.when(good, number).otherwise(F.lit(0xFFFD))
        return F.coalesce(F.try_element_at(moved, code.cast("string")), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def piece(p: Column) -> Column:
        digits = F.regexp_replace(F.regexp_extract(p, "^&#[xX]?([0-9a-fA-F]+)", 1), "^0+", "")
        base = F.when(p.rlike("^&#[xX]"), F.lit(16)).otherwise(F.lit(10))
        number = F.when(F.length(digits) > 8, F.lit(0)).otherwise(F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint"))
        return F.when(p.rlike("^&#[0-9xX]"), char(F.coalesce(number, F.lit(0)))).otherwise(
            F.when(p.rlike("^&[A-Za-z]"), word(p)).otherwise(p))

    return F.when(text.contains("&"), F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)), piece), "")).otherwise(text)


def extract_links(html: Column) -> Column:
    """Links in document order as ``array<struct<href, text>>``.

    Comments are not read.  Tags inside a link are left out of its text; a link without
    an address has an empty one; of a repeated attribute the last counts.
    """
    body = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", "")

    def link(anchor: Column) -> Column:
        tag = F.regexp_extract(anchor, "(?s)^(<[^>]*>)", 1)
        hrefs = F.transform(F.regexp_extract_all(tag, F.lit(_HREF), F.lit(0)), lambda h: F.concat(
            *(F.regexp_extract(h, _HREF, group) for group in (1, 2, 3))))
        inner = F.regexp_replace(F.regexp_replace(anchor, "(?i)</a$", ""), "<[^>]*>", "")
        return F.struct(F.coalesce(_plain(F.get(F.reverse(hrefs), F.lit(0)), in_address=True), F.lit("")).alias("href"),
                        squash(_plain(inner)).alias("text"))

    return F.transform(F.regexp_extract_all(body, F.lit(_ANCHOR), F.lit(0)), link)


def pick_link(links: Column) -> Column:
    """The download link: by text, else by a word of its address, else the first usable one."""
    by_text = F.filter(links, lambda a: F.lower(a["text"]).contains("download") & (a["href"] != ""))

    def has_any(a: Column, words: list[str]) -> Column:
        href = F.lower(a["href"])
        test = F.lit(False)
        for word in words:
            test = test | href.contains(word)
        return test

    by_word = F.filter(links, lambda a: has_any(a, HREF_WORDS))
    usable = F.filter(links, lambda a: ~has_any(a, SKIPPED_WORDS))
    return F.coalesce(*[F.get(tier, F.lit(0))["href"] for tier in (by_text, by_word, usable)])
