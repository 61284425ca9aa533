"""DuckDB SQL that gives the same rows as some of the operators."""

from __future__ import annotations

import math
import re

from . import licenses, secret_scan

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MARK = "chr(57344)"


def _either_case(pattern: str) -> str:
    """``(?i:...)`` spelled out for a-z: DuckDB's own folds other letters too."""
    return re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]) + ")", pattern)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
flat AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM docs WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT docs.doc_id, count(x) AS n FROM docs LEFT JOIN flat ON flat.doc_id = docs.doc_id GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT sizes.doc_id, n AS n_shingles, min(reach.b) AS component_id
FROM sizes JOIN reach ON reach.a = sizes.doc_id GROUP BY 1, 2"""


def _spans(kind: str, pattern: str, where: str = "true") -> str:
    """(doc_id, kind, start, stop, value) of the matches of a pattern."""
    return f"""
  SELECT doc_id, {_text(kind)} AS kind, CAST(after - length(value) AS BIGINT) AS start, CAST(after AS BIGINT) AS stop, value FROM (
    SELECT doc_id, i, value, sum(length(value)) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM (
      SELECT doc_id, unnest(parts) AS value, generate_subscripts(parts, 1) AS i FROM (
        SELECT doc_id, string_split(regexp_replace(t, {_text(f'({pattern})')}, {_MARK} || '\\1' || {_MARK}, 'g'), {_MARK}) AS parts FROM safe)
      WHERE len(parts) > 1))
  WHERE i % 2 = 0 AND ({where})"""


def _secrets() -> str:
    w, scale = secret_scan.WINDOW, secret_scan.SCALE
    most = {k: int((math.log2(w) - bits) * w * scale) for k, bits in secret_scan.LEAST_BITS.items()}
    # possessive quantifiers are only for speed
    plain = [re.sub(r"([+}])\+", r"\1", p) for p in secret_scan.ALLOWED]
    lead = _text(re.sub(r"([+}])\+", r"\1", secret_scan.LEAD))
    harmless = " OR ".join(f"regexp_matches(value, {_text(p)})" for p in plain)
    weight = "[" + ", ".join(map(str, secret_scan.WEIGHT)) + "]"
    shapes = {k: _either_case(p) for k, p in secret_scan.KNOWN.items()}
    base = " UNION ALL ".join(
        "SELECT *, {} AS rank FROM ({})".format(n, _spans(k, p, f"length(regexp_extract(value, {_text(p)}, 1)) >= {secret_scan.ASSIGNED_LENGTH}"
                                                          if k == "assign" else "true"))
        for n, (k, p) in enumerate(shapes.items()))
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*secret_scan.KNOWN, "entropy"))
    known = ", ".join(f"'{k}'" for k in secret_scan.KNOWN)
    shown = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    return f"""
WITH safe AS (SELECT doc_id, replace(coalesce(text, ''), {_MARK}, chr(57345)) AS t FROM documents),
base AS ({base}),
strings AS (SELECT *, regexp_replace(value, {lead}, '') AS rest FROM ({_spans('entropy', secret_scan.CANDIDATE)})),
judged AS (SELECT doc_id, kind, stop, CASE WHEN length(rest) >= {w} THEN rest ELSE value END AS value FROM strings),
candidates AS (SELECT *, stop - length(value) AS start, row_number() OVER () AS c FROM judged
  WHERE (regexp_matches(value, '[0-9]') OR len(regexp_extract_all(value, '[a-z][A-Z]')) * {secret_scan.SWITCHES} >= length(value)) AND NOT ({harmless})),
windows AS (SELECT c, i, value, substr(value, CAST(i + 1 AS BIGINT), {w}) AS s
  FROM (SELECT c, value, unnest(range(length(value) - {w - 1})) AS i FROM candidates)),
hot AS (SELECT c, min(i) AS lo, max(i) + {w} AS hi FROM windows
  WHERE list_sum(list_transform(list_distinct(string_split(s, '')), lambda x: {weight}[length(s) - length(replace(s, x, '')) + 1]))
    <= CASE WHEN regexp_matches(value, '^[0-9a-fA-F]+$') THEN {most['hex']} ELSE {most['other']} END GROUP BY 1),
entropy AS (SELECT doc_id, kind, start + lo AS start, start + hi AS stop, value, {len(secret_scan.KNOWN)} AS rank FROM candidates JOIN hot USING (c)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM entropy e WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND b.start < e.stop AND e.start < b.stop)),
found AS (SELECT doc_id, {counts}, {shown} FILTER (kind IN ({known})) AS known, {shown} AS spans FROM spans GROUP BY 1)
SELECT documents.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in (*secret_scan.KNOWN, 'entropy'))},
  sha256(coalesce(known, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN found ON found.doc_id = documents.doc_id"""


SECRETS = _secrets()


def _licenses() -> str:
    rows = ", ".join(f"({t}, {_text(label)}, {str(phrase).lower()}, {runs}, {q}, {_text(gram)})" for t, label, phrase, runs, q, gram
                     in licenses._template_rows(licenses.PHRASES, licenses.TEMPLATES))
    k = licenses.GRAM
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (SELECT doc_id, i - 1 AS p, {gram} AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM docs)),
templates(template, label, is_phrase, runs, q, gram) AS (VALUES {rows}),
hits AS (SELECT doc_id, template, label, is_phrase, runs, q, p, p - q AS diagonal FROM grams JOIN templates USING (gram)),
marked AS (SELECT *, CASE WHEN is_phrase OR lag(diagonal) OVER o IS NULL OR diagonal - lag(diagonal) OVER o > {licenses.SHIFT} THEN 1 ELSE 0 END AS fresh
  FROM (SELECT DISTINCT doc_id, template, is_phrase, diagonal FROM hits) WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS place FROM marked),
places AS (SELECT doc_id, template, label, h.is_phrase, place, min(p) AS start, max(p) + {k} AS stop, max(runs) AS runs,
    CAST(count(DISTINCT q) AS DOUBLE) / max(runs) AS cover
  FROM hits h JOIN numbered USING (doc_id, template, diagonal) GROUP BY 1, 2, 3, 4, 5),
good AS (SELECT * FROM places WHERE CASE WHEN is_phrase THEN cover = 1
  ELSE cover >= {licenses.COVER} AND stop - start <= 2 * (runs + {k}) END)
SELECT docs.doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, count(*) FILTER (is_phrase) AS n_base,
  CAST(min(start) FILTER (is_phrase) AS BIGINT) AS first_word, CAST(max(start) FILTER (is_phrase) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_phrase), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(cover), 0.0::DOUBLE) AS score
FROM docs LEFT JOIN good ON good.doc_id = docs.doc_id GROUP BY docs.doc_id"""


LICENSES = _licenses()


# crc32 of the decimal id, bit by bit
_CRC = """xor(list_reduce(flatten([[(ascii(x) >> k) & 1 for k in range(8)] for x in string_split(CAST({0} AS VARCHAR), '')]),
  lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)), CAST(4294967295 AS BIGINT)), 4294967295)"""

TRIE = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, count(*) AS own, {_CRC.format('conv_id')} % 4 AS h, conv_id - conv_id % 20 AS donor FROM turns GROUP BY 1),
plan AS (SELECT c.*, least(c.h, coalesce(d.own, 0)) AS heads FROM convs c LEFT JOIN convs d ON d.conv_id = c.donor),
rebuilt AS (
  SELECT plan.conv_id, place, role, text FROM plan JOIN turns ON turns.conv_id = donor WHERE place < heads
  UNION ALL SELECT conv_id, place - h + heads, role, text FROM plan JOIN turns USING (conv_id) WHERE place >= h),
placed AS (SELECT conv_id, place + 1 AS depth, len(regexp_extract_all(text, '[^ 	-
]+')) AS words,
    string_agg(md5(role || chr(0) || text), '' ORDER BY place) OVER (PARTITION BY conv_id ORDER BY place) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
nodes AS (SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM placed GROUP BY 1),
above AS (SELECT *, left(path, greatest(length(path) - 32, 0)) AS parent FROM nodes),
kids AS (SELECT parent AS path, count(*) AS n FROM above WHERE depth > 0 GROUP BY 1),
own AS (SELECT a.*, coalesce(kids.n, 0) AS n_children FROM above a LEFT JOIN kids ON kids.path = a.path),
under AS (SELECT p.path, count(*) FILTER (o.n_children = 0) AS n_leaves, sum((o.n_convs - 1) * o.words) AS saved
  FROM own o JOIN placed p ON p.conv_id = o.conv_id AND p.depth <= o.depth GROUP BY 1),
ends AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM placed GROUP BY 1) GROUP BY 1)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own JOIN under USING (path) LEFT JOIN ends ON ends.path = own.path
LEFT JOIN nodes up ON up.path = own.parent AND own.depth > 0"""


SEARCH = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
counts AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM docs),
items AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT item, item_id, t, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS t FROM items) GROUP BY 1, 2, 3),
held AS (SELECT r, doc_id, CAST(len AS BIGINT) AS len, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS len, unnest(w) AS t FROM docs) GROUP BY 1, 2, 3, 4),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM held, counts GROUP BY t, n),
scores AS (SELECT item, item_id, r, doc_id,
    CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len * n) // l)))) AS BIGINT) AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t), counts GROUP BY 1, 2, 3, 4)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10"""
