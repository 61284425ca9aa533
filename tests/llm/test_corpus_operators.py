"""Operators that compare rows: lines, near copies, fingerprints, leaks, quality, and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import leaks, lines, minhash, quality, setjoin, shingles
from tidemark.llm.components import connected_components
from tidemark.session import stored

from ..conftest import rows_of

DOCS = "doc_id bigint, text string, n bigint, component string"
FOLDER = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def docs(frame, rows):
    return frame([(i, t, 1, "kept") for i, t in rows], DOCS)


# --- shingles and components ----------------------------------------------

def plain_set(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(tokens) < 5:
        return frozenset([tuple(tokens)] if tokens else [])
    return frozenset(tuple(tokens[i:i + 5]) for i in range(len(tokens) - 4))


def test_shingle_hashes_tell_shingles_apart():
    texts = ["", " \t\n ", "one", "one two", "two one", "a b c d e", "A b C\nd\te", "a b c d e f", "É x é x É x", "x" * 3000,
             "a\x0bb\x1cc", "a b c d e " * 50]
    sets = shingles.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain_set(texts[i]) & plain_set(texts[j]))
    alone = [shingles.shingle_sets([t.encode()])[0] for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(sets, alone))


def test_components_of_chains_and_stars(frame):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(500, 499), (499, 500), (500, 500)]
    got = dict(rows_of(connected_components(frame(edges, "a bigint, b bigint"))))
    assert {n: c for n, c in got.items() if n >= 100 and n < 141} == {n: 100 for n in range(100, 141)}
    assert {got[n] for n in range(7, 60)} == {7} and got[499] == got[500] == 499
    assert connected_components(frame([], "a bigint, b bigint")).count() == 0


# --- n-gram Jaccard join --------------------------------------------------

def near_copies(seed=3):
    """Random texts, copies with edits of all strengths, hot groups, and a passage in many texts."""
    rng = random.Random(seed)
    rows, passage = [], words(rng, 40)
    for _ in range(60):
        base = words(rng, rng.randint(1, 120))
        rows.append(base)
        for _ in range(rng.randint(0, 4)):
            w = base.split()
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = words(rng, 1)
            rows.append(" ".join(w) if rng.random() < 0.7 else " ".join(w).upper() + "\n")
    hot = words(rng, 60)
    rows += [hot] * 40 + [hot.rsplit(" ", k % 14)[0] for k in range(60)] + [f"{passage} {words(rng, 30)}" for _ in range(60)]
    rows += ["", None, "   ", "one two", "ONE  two", words(rng, 6000)]
    rows.append(rows[-1] + " more words at the end")
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


def plain_components(rows):
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    sets = {i: plain_set(t) for i, t in rows}
    holders = defaultdict(set)
    for i, s in sets.items():
        others = Counter(o for x in s for o in holders[x])
        for o, common in others.items():
            if 100 * common >= 80 * (len(s) + len(sets[o]) - common):
                a, b = find(i), find(o)
                parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].add(i)
    return {i: (len(sets[i]), find(i)) for i, _ in rows}


@pytest.mark.parametrize("small,pieces,heavy", [(setjoin.SMALL, setjoin.PIECE, setjoin.ABOVE), (3, 4, 0), (64, 4, 10**9)])
def test_components_equal_brute_force(frame, monkeypatch, small, pieces, heavy):
    monkeypatch.setattr(setjoin, "SMALL", small)
    monkeypatch.setattr(setjoin, "PIECE", pieces)
    monkeypatch.setattr(setjoin, "ABOVE", heavy)
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.similar_components(docs(frame, rows)).collect()}
    assert got == plain_components(rows)


def test_rows_without_id_and_repeated_rows(frame):
    text = "a b c d e f g"
    rows = [(4, text), (4, text), (None, text.upper()), (None, "other words"), (2, None), (9, text), (3, "")]
    df = docs(frame, rows)
    got = Counter(tuple(r) for r in setjoin.similar_components(df).collect())
    assert got == Counter([(4, 3, 4), (4, 3, 4), (None, 3, 4), (None, 1, None), (2, 0, 2), (9, 3, 4), (3, 0, 3)])
    kept = Counter(r.doc_id for r in setjoin.keep_one(df).collect())
    assert kept[4] == 1 and kept[9] == 0 and kept[2] == kept[3] == 1 and kept[None] == 2
    assert setjoin.similar_components(df.limit(0)).count() == 0 and setjoin.keep_one(df.limit(0)).count() == 0


def test_ids_shared_by_different_texts_lose_none(frame):
    """Rows of one id and unlike texts are documents of their own, whatever the order of the rows."""
    near = " ".join(f"w{i}" for i in range(40))
    rows = [(1, "a b c d e f g", 1), (1, "quite another text of seven words", 2), (1, near + " end", 3), (2, near, 4),
            (2, "a b c d e f g", 5), (5, near, 6), (None, near, 7), (3, None, 8), (3, "", 9)]
    for turn in (rows, rows[::-1]):
        df = frame(turn, "doc_id bigint, text string, number int").withColumn("row", F.lit("clash"))
        kept = setjoin.keep_one(df)
        assert kept.columns == df.columns
        got = sorted((r.number for r in kept.collect()))
        # of 1, 3, 4, 6 and of 1, 5 the first by id and text; of 8 and 9, one document, either
        assert got in ([1, 2, 3, 7, 8], [1, 2, 3, 7, 9])
    assert got == sorted(r.number for r in setjoin.keep_one(frame(rows, "doc_id bigint, text string, number int").withColumn("row", F.lit("clash"))).collect())


def test_walks_lose_no_pair():
    """Two trees emit every pair that the full comparison finds, whatever the blocks look like."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 120, dtype=np.uint64)
    sets = []
    for k in range(90):
        keep = rng.random(120) > 0.12 * (k % 3)
        sets.append(np.unique(np.concatenate((base[keep], rng.integers(0, 2**63, k % 25, dtype=np.uint64)))))
    size = np.array([len(s) for s in sets])
    bits = np.stack([setjoin.folded(setjoin.signature(s), setjoin.BITS) for s in sets])
    comp = np.arange(90) // 4
    items = np.arange(90)
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if comp[i] != comp[j]
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    one = setjoin.Tree(size, bits, comp, items)
    assert want and want <= {(min(p), max(p)) for p in setjoin.walk(one, one)}
    half = items % 2 == 0
    two = [setjoin.Tree(size[h], bits[h], comp[h], items[h]) for h in (half, ~half)]
    across = {p for p in want if p[0] % 2 != p[1] % 2}
    assert across <= {(min(p), max(p)) for p in setjoin.walk(*two)}


# --- line dedup -----------------------------------------------------------

def test_blocks_go_from_the_later_document(frame):
    rng = random.Random(8)
    a, b, c, short = words(rng, 60), words(rng, 25), words(rng, 25), words(rng, 5)
    rows = [(5, f"{short}\n{a}\nown one"), (7, f"first\n{a}\n{short}"), (9, f"{b}\n\n{c}"), (11, f"x\n{b}\n\n{c}\ny"), (12, f"{b}\nz\n{c}"),
            (13, f"{a}\n{a}"), (20, a), (None, f"{a}\nlast"), (21, None), (22, ""), (23, f"{short}\nmine"), (5, f"{short}\n{a}\nown one")]
    got = {(r.doc_id, r.n_lines): r for r in lines.dedup_lines(docs(frame, rows).withColumn("n_lines", F.lit("old"))).collect()}
    text = {k[0]: r.text for k, r in got.items()}
    assert text[5] == rows[0][1] and text[9] == rows[2][1]                  # the earliest keep theirs
    assert text[7] == f"first\n{short}" and text[11] == "x\ny"              # blocks of one line, and over a blank line
    assert text[12] == rows[4][1]                                           # 25 words each, apart: too short
    assert text[13] == a and text[20] == "" and text[None] == "last"        # a's first occurrence; its second is new
    assert text[21] is None and text[22] == "" and text[23] == rows[10][1]
    assert lines.dedup_lines(docs(frame, rows).limit(0)).count() == 0


def test_long_repeats_are_found_in_the_tables(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    seen, repeated = set(), 0
    for r in lines.dedup_lines(table).orderBy("doc_id").collect():
        own = [x.strip() for x in texts[r.doc_id].split("\n")]
        gone = {k for b in r.removed_blocks for k in range(b["first"], b["last"] + 1)}
        for k, line in enumerate(own):
            if len(line.split()) > 50 and line in seen:
                repeated += 1
                assert k in gone
            if k in gone and line:
                assert line in seen
        assert r.text == "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in gone)
        seen |= set(own)
    assert repeated > 5


def plain_blocks(rows, least=30):
    """Lines of each document in a block of enough words that stands in any one earlier document."""
    split = [(i, [x.strip() for x in t.split("\n")]) for i, t in sorted(rows)]
    gone = {}
    for k, (i, own) in enumerate(split):
        gone[i] = set()
        for _, other in split[:k]:
            for d in range(-len(other) + 1, len(own)):
                run = []
                for x in [*range(max(d, 0), min(len(own), len(other) + d)), None]:
                    if x is not None and own[x] == other[x - d]:
                        run.append(x)
                        continue
                    if sum(len(own[y].split()) for y in run) >= least:
                        gone[i] |= {y for y in run if own[y]}
                    run = []
    return gone


def removed_lines(df):
    return {r.doc_id: {k for b in r.removed_blocks for k in range(b["first"], b["last"] + 1)} for r in lines.dedup_lines(df).collect()}


def test_blocks_of_lines_that_have_different_earliest_holders(frame):
    rng = random.Random(12)
    a, b = words(rng, 29), words(rng, 29)
    short = [words(rng, rng.randint(1, 6)) for _ in range(12)]
    rows = [(1, a), (2, f"{a}\n{b}"), (3, f"{a}\n{b}")]
    got = removed_lines(docs(frame, rows))
    assert got == {1: set(), 2: set(), 3: {0, 1}}
    # passages of many lines, cut anywhere, between lines that stand in many documents
    passages = [[words(rng, rng.choice((1, 3, 9, 29, 40))) for _ in range(rng.randint(2, 9))] for _ in range(8)]
    rows = []
    for i in range(60):
        text = []
        for p in rng.sample(passages, rng.randint(0, 3)):
            text += rng.sample(short, rng.randint(0, 3)) + p[rng.randint(0, 2):len(p) - rng.randint(0, 2)] + [""] * rng.randint(0, 1)
        rows.append((i, "\n".join(text + [words(rng, 8)])))
    rows += [(60 + k, t) for k, (_, t) in enumerate(rows[:20])]
    split = {i: t.split("\n") for i, t in rows}
    got, want = removed_lines(docs(frame, rows)), plain_blocks(rows)
    assert sum(map(len, want.values())) > 300
    assert {i: {k for k in g if split[i][k]} for i, g in got.items()} == want


def test_whole_blocks_go_in_the_tables(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in table.collect()]
    split, got = {i: [x.strip() for x in t.split("\n")] for i, t in rows}, removed_lines(table)
    assert {i: {k for k in g if split[i][k]} for i, g in got.items()} == plain_blocks(rows)


def test_longest_increasing_runs():
    rng = random.Random(2)
    for _ in range(50):
        v = [rng.randrange(12) for _ in range(rng.randrange(1, 10))]
        best = max((len(s) for m in range(1 << len(v)) for s in [[v[i] for i in range(len(v)) if m >> i & 1]]
                    if all(x < y for x, y in zip(s, s[1:]))), default=0)
        got = lines.longest_increasing(v)
        assert len(got) == best and all(v[x] < v[y] and x < y for x, y in zip(got, got[1:]))


# --- fingerprints ---------------------------------------------------------

def test_next_documents_and_likeness(spark, frame):
    rng = random.Random(4)
    rows = [(k, words(rng, rng.randint(0, 200))) for k in (-5, 0, 3, 10**12, 8, 9, 2)] + [(4, None), (6, ""), (7, "é🙂")]
    got = {r.doc_id: r for r in minhash.compare_with_next(docs(frame, rows)).collect()}
    order = sorted(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after, r = text or "", after or "", got[i]
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        sets = [plain_set(x) for x in (text, edited, after)]
        for near, other in ((r.near_edited, sets[1]), (r.near_next, sets[2])):
            want = len(sets[0] & other) / max(1, len(sets[0] | other)) if sets[0] or other else 1.0
            assert abs(near - want) < 0.25
    same = minhash.fingerprints(docs(frame, [(1, "Some text here"), (2, "Some text here"), (3, None), (4, "")])).collect()
    assert same[0].fingerprint == same[1].fingerprint and same[2].fingerprint == same[3].fingerprint == "ffff" * minhash.LANES
    empty = docs(frame, rows).limit(0)
    assert minhash.compare_with_next(empty).count() == 0 and minhash.fingerprints(empty).count() == 0


def test_one_or_equal_or_missing_ids(frame):
    one = minhash.compare_with_next(docs(frame, [(3, "a b c d")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"a b a b ".replace(b"b a b ", b"ba b")).hexdigest() or one[0].n_chars == 7
    rows = [(None, "x y"), (1, "same id"), (1, "same id, later"), (2, "z")]
    got = minhash.compare_with_next(docs(frame, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter([None, 1, 1, 2])


def test_similar_documents_are_verified(frame):
    rng = random.Random(6)
    base = words(rng, 300).split()
    texts = [base, base[:290], base[:200] + words(rng, 100).split(), words(rng, 300).split(), base]
    got = {(r.a, r.b): r.jaccard for r in minhash.similar_documents(docs(frame, [(k, " ".join(t)) for k, t in enumerate(texts)])).collect()}
    assert set(got) == {(0, 1)}
    sets = [plain_set(" ".join(t)) for t in texts]
    assert abs(got[0, 1] - len(sets[0] & sets[1]) / len(sets[0] | sets[1])) < 1e-12


def test_similar_documents_equal_brute_force(frame):
    rng = random.Random(9)
    base, passage = words(rng, 200).split(), words(rng, 40)
    rows = []
    for _ in range(220):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append(" ".join(w))
    rows += [f"{passage} {words(rng, rng.randint(5, 40))}" for _ in range(60)]
    sets = [plain_set(t) for t in rows]
    want = {(i, j) for j in range(len(rows)) for i in range(j) if sets[i] != sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    first = {s: i for i, s in reversed(list(enumerate(sets)))}
    want = {p for p in want if all(first[sets[i]] == i for i in p)}
    got = {(r.a, r.b) for r in minhash.similar_documents(docs(frame, list(enumerate(rows)))).collect()}
    assert len(want) > 3000 and got == want


# --- leaks ----------------------------------------------------------------

ITEMS = [(1, "Ann Miller has 12 kg of apples and gives 5 kg to Bob Stone, how many are left for her"),
         (2, "the slow green turtle walks over seven hills before it reaches the quiet lake at night"),
         (3, "what is love"), (4, "hi"), (5, None), (6, "")]


def test_items_are_found_whole_shifted_and_with_other_values(frame):
    whole = ITEMS[0][1]
    other = whole.replace("12 kg", "30 lb").replace("5 kg", "9 lb").replace("Bob Stone", "Tom Reed")
    mixed = whole.replace("apples", "pears")
    rows = [(1, f"Some words. {whole}? More."), (2, f"text before, {other}."), (3, "nothing to see here, move on please"),
            (4, ITEMS[1][1].upper()), (5, "say what is love? yes"), (6, "hi hi hi"), (7, None), (8, ""),
            (9, ITEMS[1][1].split("hills")[0]), (10, mixed), (None, ITEMS[1][1])]
    bench = frame(ITEMS, "item_id bigint, text string")
    found = leaks.find_leaks(docs(frame, rows), bench)
    got = {(r.doc_id, r.item_id): (r.cover, r.same_values) for r in found.collect()}
    assert got[1, 1][0] > 0.9 and got[1, 1][1] and got[2, 1][0] > 0.9 and not got[2, 1][1]
    assert {(4, 2), (5, 3), (None, 2)} <= set(got) and not {k for k in got if k[0] in (3, 6, 7, 8, 9)}
    left = sorted((r.doc_id for r in leaks.without_leaks(docs(frame, rows), bench).collect()), key=str)
    assert set(left) == {3, 6, 7, 8, 9} | ({10} if (10, 1) not in got else set())
    assert leaks.find_leaks(docs(frame, rows).limit(0), bench).count() == 0
    assert leaks.find_leaks(docs(frame, rows), bench.limit(0)).count() == 0


def test_marks_are_not_written_into_the_plan(frame):
    bench = frame([(k, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(200)], "item_id bigint, text string")
    rows = [(k, "before " + " ".join(f"w{k}x{i}" for i in range(30))) for k in range(3)] + [(3, None), (4, "nothing")]
    left = leaks.without_leaks(docs(frame, rows), bench)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4]
    told = left._jdf.queryExecution()
    assert max(len(told.analyzed().toString()), len(told.executedPlan().toString())) < leaks.MARKS


def test_items_of_one_or_two_tokens_are_whole_sentences(frame):
    bench = frame([(1, "Two words"), (2, "Answer!"), (3, "..."), (4, "12 kg"), (5, "two words and a third one in it")], "item_id bigint, text string")
    rows = [(1, "two words"), (2, "Well. Two  words! Then more."), (3, "not two words here"), (4, "first\nanswer\nlast"),
            (5, "answered"), (6, "It has 12 kg"), (7, "12 kg."), (8, "13 kg"), (9, ""), (10, None), (1, "two words, third")]
    got = rows_of(leaks.find_leaks(docs(frame, rows), bench), "doc_id", "item_id", "cover", "same_values")
    assert got == [(1, 1, 1.0, True), (2, 1, 1.0, True), (4, 2, 1.0, True), (7, 4, 1.0, True)]
    left = [r.doc_id for r in leaks.without_leaks(docs(frame, rows), bench).collect()]
    assert sorted(left, key=str) == sorted([1, 3, 5, 6, 8, 9, 10], key=str)



def test_changed_values_must_be_consistent(frame):
    item = "Sam pays 40 dollars and later Sam pays 40 dollars again, so after that 40 dollars are still missing"
    clash = item.replace("40", "11", 1).replace("40", "22", 1).replace("40", "33", 1)
    bench = frame([(1, item)], "item_id bigint, text string")
    rows = [(1, item.replace("40", "75")), (2, clash), (3, item)]
    assert rows_of(leaks.find_leaks(docs(frame, rows), bench), "doc_id", "same_values") == [(1, False), (3, True)]


def test_every_occurrence_of_an_item_is_judged(frame):
    long = "Sam pays 40 dollars and later Sam pays 40 dollars again, so after that 40 dollars are still missing"
    clash = long.replace("40", "11", 1).replace("40", "22", 1).replace("40", "33", 1)
    gap = " " + " ".join(f"word{chr(97 + k)}" for k in range(20)) + " "
    short = "what is 3 plus 4"
    bench = frame([(1, long), (2, short)], "item_id bigint, text string")
    rows = [(1, f"{long}. {clash}"), (2, f"{clash}. {long}"), (3, f"{clash}. {clash}"), (4, "what is 5 plus 6? what is 7 plus 8?"),
            (5, "what is 5 plus 5? what is 3 plus 4?"), (6, f"{long.replace('40', '75')}{gap}{clash}"),
            (7, f"{clash}{gap}{long.replace('40', '75')}{gap}{clash}")]
    got = {(r.doc_id, r.item_id): r.same_values for r in leaks.find_leaks(docs(frame, rows), bench).collect()}
    assert got == {(1, 1): True, (2, 1): True, (4, 2): False, (5, 2): True, (6, 1): False, (7, 1): False}


def test_names_that_open_sentences(frame):
    item = "Ann has 12 apples. Ann eats 5 of them. Bob buys 7 more apples. Ann gives Bob 3. How many apples are left?"
    other = item.replace("Ann", "Tom").replace("Bob", "Sam")
    mixed = "Tom has 12 apples. Kim eats 5 of them. Sam buys 7 more apples. Joe gives Liz 3. How many apples are left?"
    train = "The train leaves at 8 and the bus at 9. The train needs 3 hours, the bus needs 4. When do both of them arrive?"
    bench = frame([(1, item), (2, "Ann has 12 kg"), (3, train), (4, "New York Times")], "item_id bigint, text string")
    rows = [(1, other), (2, f'He said: "{other}"\n{mixed}'), (3, mixed), (4, "Bob has 7 lb"), (5, "so we see that Bob has 7 lb of it"),
            (6, train.replace("The train", "A train", 1)), (7, item), (8, "United Arab Emirates"), (9, "New York Times"), (10, item.upper())]
    got = {(r.doc_id, r.item_id): r.same_values for r in leaks.find_leaks(docs(frame, rows), bench).collect()}
    assert {k: v for k, v in got.items() if k[1] != 2} == {
        (1, 1): False, (2, 1): False, (6, 3): True, (7, 1): True, (9, 4): True, (10, 1): True}
    assert {(4, 2), (5, 2)} <= set(got) and not got[4, 2]


def test_contained_items_are_found_in_the_tables(spark):
    table, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    got = set(rows_of(leaks.find_leaks(table, bench), "doc_id", "item_id"))
    texts = {r.doc_id: r.text for r in table.collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    want = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert want and want <= got
    for d, i in got - want:
        common = set(zip(*(items[i].lower().split()[k:] for k in range(4)))) & set(zip(*(texts[d].lower().split()[k:] for k in range(4))))
        assert len(common) >= 4


# --- quality --------------------------------------------------------------

def test_statistics_of_single_and_many_texts_agree():
    texts = [b"", b"A bc, DEF! 12\n\nx", "É ß".encode(), b"word " * 3000, b"\n\n", b"A bc, DEF! 12\n\nx"]
    many = quality.statistics(texts)
    assert np.allclose(many, np.vstack([quality.statistics([t]) for t in texts])) and not many[0].any() and np.isfinite(many).all()
    row = dict(zip(quality.NAMES, many[1]))
    assert (row["upper"], row["digit"], row["shout"]) == (4 / 16, 2 / 16, 1 / 16) and row["longest_word"] == 4


def test_forest_learns_and_walks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > -0.2)).astype(float)
    forest = quality.fit_forest(x[:2000], y[:2000], trees=40)
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def slow(row):
        total = forest.start
        for k in forest.roots:
            for _ in range(forest.depth):
                k = forest.left[k] if row[forest.feature[k]] <= forest.limit[k] else forest.right[k]
            total += forest.value[k]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(forest.score(x[:20]), [slow(r) for r in x[:20]])
    assert quality.fit_forest(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    table, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.classify(table, labels).withColumn("held_out", quality.held_out()).join(labels, "doc_id").where("held_out")
    right, n = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert n > 50 and right > 0.95


def test_scores_of_odd_rows(frame):
    df = docs(frame, [(1, None), (1, None), (2, ""), (None, "some text"), (3, "x" * 300_000)])
    labels = frame([(1, 0, 0), (1, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.classify(df.withColumn("score", F.lit("old")), labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score == got[2].score
    assert quality.classify(df.limit(0), labels.limit(0)).count() == 0


# --- pipeline -------------------------------------------------------------

def test_stages_work_on_odd_rows_and_names(spark, frame, tmp_path):
    folder = str(tmp_path / "in")
    rng = random.Random(3)
    base = words(rng, 80)
    rows = [(1, base, 5, "x"), (2, base + " end", None, None), (None, words(rng, 40), 1, "y"), (3, None, 1, "z"), (4, "", 1, None),
            (1, base, 5, "x"), (5, words(rng, 30000), 1, "w")]
    df = frame(rows, "doc_id bigint, text string, n_chars bigint, rest string").withColumns(
        {c: F.lit("kept") for c in ("score", "predicted", "removed_blocks", "_late", "n_lines", "component_id", "piece_ids", "_own_hash", "decoded")})
    df.write.parquet(f"{folder}/documents.parquet")
    frame([(1, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame([(1, words(rng, 20))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stored(stage(spark, table, folder), name)
        if k < 4:
            assert out.columns == table.columns and out.dtypes == table.dtypes, name
            assert {r["score"] for r in out.collect()} <= {"kept"}
        else:
            assert out.columns[:len(table.columns)] == table.columns and all(r.lossless for r in out.collect())
        empty = stage(spark, table.limit(0), folder)
        assert empty.count() == 0, name


def test_pipeline_against_its_parts(spark):
    """Every stage's decisions by brute force, on the table its predecessor left."""
    docs_ = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs_ = docs_, stored(stage(spark, docs_, FOLDER), name)
        kept.append((before.collect(), docs_.collect()))
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    first = {r.doc_id for r in kept[0][1]}
    assert len(first & bad) <= 0.1 * len(bad) and len(first & good) >= 0.97 * len(good)
    texts = {r.doc_id: r.text for r in kept[1][0]}
    seen = set()
    for r in sorted(kept[1][1], key=lambda r: r.doc_id):
        assert r.n_chars == len(r.text)
        own = r.text.split("\n")
        assert not [x for x in own if len(x.split()) > 50 and x.strip() in seen]
        seen |= {x.strip() for x in texts[r.doc_id].split("\n")}
    rows = [(r.doc_id, r.text) for r in kept[2][0]]
    assert {r.doc_id for r in kept[2][1]} == {c for _, c in plain_components(rows).values()}
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert not [r.doc_id for r in kept[3][1] if any(x in r.text for x in items)]
    assert all(r.lossless for r in kept[4][1]) and len(kept[4][1]) == len(kept[3][1])
