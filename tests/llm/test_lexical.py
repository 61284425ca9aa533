"""Ranked search against brute force, and what Block-Max MaxScore leaves unread."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    """Scores of every document, by the formula."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item, text in {i for i in items if i[1] is not None}:
        asked = Counter(terms(text))
        scored = []
        for i, b in bags:
            m = 25 + (75 * sum(b.values()) * n_docs) // length if b else 0
            s = sum(q * weight[t] * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t, q in asked.items() if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return Counter(out)


def found(docs, items, **options):
    df = lexical.ranked_search(docs, items, **options)
    assert df.columns == ["item_id", "rank", "doc_id", "score"] and dict(df.dtypes)["rank"] == "int"
    return Counter(tuple(r) for r in df.collect())


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    words = ["the", "of", "Éa", "x1"] * 40 + [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(n)]
    items = [(k, " ".join(rng.choice(words) for _ in range(8))) for k in range(25)]
    return docs, items


@pytest.mark.parametrize("parts, item_bytes", [(1, 1 << 20), (6, 120)])
def test_ranks_are_those_of_brute_force(frame, monkeypatch, parts, item_bytes):
    docs, items = corpus()
    docs += docs[:30] + [(None, "w1 w2 w3"), (700, None), (701, ""), (702, "- .,"), (703, "W1w2\tTHE " + "the " * 90_000)]
    items += [(90, None), (91, ""), (92, "nothing_like zzz"), (93, "w1 w1 w1 the"), (93, "w2"), (93, "w2"), (None, "w3")]
    monkeypatch.setattr(lexical, "ITEM_BYTES", item_bytes)          # several blocks of items
    df = frame(docs, DOCS).withColumns({"term": F.lit("clash"), "item_id": F.lit(1)}).repartition(parts)
    assert found(df, frame(items, ITEMS).withColumn("block", F.lit("clash"))) == brute(docs, items)


def test_many_equal_scores(frame):
    docs = [(i, "same words here") for i in range(500, 0, -1)] + [(1000 + i, f"other {i}") for i in range(900)]
    items = [(1, "same here")]
    assert found(frame(docs, DOCS).repartition(5), frame(items, ITEMS)) == brute(docs, items)


def test_empty_tables(frame):
    assert found(frame([], DOCS), frame([(1, "x")], ITEMS)) == Counter()
    assert found(frame([(1, "x")], DOCS), frame([], ITEMS)) == Counter()
    assert found(frame([(1, None), (2, "..")], DOCS), frame([(1, "x")], ITEMS)) == Counter()


def test_numbers_survive_packing():
    rng = np.random.default_rng(2)
    values = np.concatenate([[0, 127, 128, 16383, 16384, (1 << 35) - 1], rng.integers(0, 1 << 20, 500)])
    data, size = lexical.packed(values)
    assert size.sum() == len(data) and (lexical.unpacked(data) == values).all()
    assert len(lexical.unpacked(np.empty(0, np.uint8))) == 0


def test_blocks_are_left_compressed():
    """A rare term fills the heap; of the frequent term's blocks only those with a candidate are read."""
    n = 5000
    texts = [b"the " * (1 + i % 3) + (b"rare word" if i % 1000 == 7 else b"filler") for i in range(n)]
    length = sum(lexical.n_terms(t) for t in texts)
    rows = lexical.segment_rows(0, list(range(n)), texts, n, length).to_pylist()
    segment = lexical.Segment(rows[0]["ids"], rows[0]["norms"])
    segment.rows = [(r["term"], r["first"], r["last"], r["n"], r["top"], r["postings"]) for r in rows[1:]]
    segment.close()
    blocks = len(segment.rows)
    query = [(int(h), lexical.weight(n, sum(r["n"] for r in rows[1:] if r["term"] == int(h))))
             for h in lexical.term_hashes([b"the rare word"])[0].view(np.int64)]
    got = lexical.search_segment(segment, query, [], top=5)
    assert {d for _, _, d in got} == {7, 1007, 2007, 3007, 4007}
    assert 0 < segment.read <= 2 + 5 < blocks / 10
    before = segment.read
    worse = [(-s - 1, False, d) for (s, _, d) in [(10**12, 0, k) for k in range(5)]]
    assert lexical.search_segment(segment, query, worse, top=5) == worse and segment.read == before


def test_a_list_holds_all_its_postings():
    docs, _ = corpus(5, 300)
    texts = [t.encode() for _, t in docs]
    rows = lexical.segment_rows(3, [i for i, _ in docs], texts, 300, sum(map(lexical.n_terms, texts))).to_pylist()
    segment = lexical.Segment(rows[0]["ids"], rows[0]["norms"])
    segment.rows = [(r["term"], r["first"], r["last"], r["n"], r["top"], r["postings"]) for r in rows[1:]]
    segment.close()
    the = int(lexical.term_hashes([b"the"])[0].view(np.int64)[0])
    a, b = segment.lists[the]
    segment.decompress(np.arange(a, b))
    got = segment.doc[segment.begin[a]:segment.begin[b]].tolist()
    assert got == [k for k, (_, t) in enumerate(docs) if "the" in terms(t)]
    for k in range(a, b):
        at = slice(segment.begin[k], segment.begin[k + 1])
        assert segment.gain[at].max() == segment.top[k] and segment.doc[at][0] == segment.first[k] and segment.doc[at][-1] == segment.last[k]
