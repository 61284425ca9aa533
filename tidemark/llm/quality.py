"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text (shares of character classes, word and line lengths,
repetition) are computed for many texts at once in numpy.  The trees are fitted on
a bounded sample of labelled rows and flattened into arrays, which every task
walks for all its rows together.  Scores use the text only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended
from .shingles import chunks, shingle_hashes, word_hashes

THRESHOLD = 0.7
FIT_ROWS = 20_000               # labelled rows the trees are fitted on at most, chosen by a hash of the id
BINS, TREES, DEPTH, RATE, RIDGE, LEAST_ROWS = 64, 80, 4, 0.15, 1.0, 8

CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "stop": b".?", "comma": b",;:",
    "shout": b"!", "bar": b"|", "signs": b"#$%&*@^~", "math": b"<>=+{}[]\\/_", "dash": b"-", "quote": b"'\"()",
    "space": b" \t", "line": b"\n\r", "wide": range(128, 192), "lead": range(192, 256),
}
NAMES = (*CLASSES, "bytes", "words", "lines", "word_length", "word_spread", "longest_word", "short_words",
         "bytes_a_line", "new_words", "top_word", "new_shingles", "new_lines", "longest_line", "capitals")


def _distinct_and_top(values: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each group, and how often its most frequent one occurs."""
    distinct, top = np.zeros(len(per)), np.zeros(len(per))
    if len(values):
        group = np.repeat(np.arange(len(per)), per)
        order = np.lexsort((values, group))
        v, g = values[order], group[order]
        new = np.concatenate(([True], (v[1:] != v[:-1]) | (g[1:] != g[:-1])))
        at = np.flatnonzero(new)
        runs = np.diff(np.append(at, len(v)))
        distinct = np.bincount(g[at], minlength=len(per)).astype(float)
        np.maximum.at(top, g[at], runs)
    return distinct, top


def _lines(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and length of every line that isn't empty, and their number per text."""
    hashes, lengths, per = [], [], []
    for t in texts:
        own = [x for x in t.split(b"\n") if x.strip()]
        per.append(len(own))
        hashes += map(hash, own)
        lengths += map(len, own)
    return np.array(hashes, dtype=np.int64), np.array(lengths, dtype=np.int64), np.array(per, dtype=np.int64)


def _reduce(ufunc, values: np.ndarray, per: np.ndarray) -> np.ndarray:
    out = np.zeros(len(per))
    full = np.flatnonzero(per)
    if len(full):
        out[full] = ufunc.reduceat(values, (np.cumsum(per) - per)[full])
    return out


def statistics(texts: Sequence[bytes]) -> np.ndarray:
    """One row of statistics per text; an empty text has zeros."""
    out = np.zeros((len(texts), len(NAMES)))
    for start, stop in chunks(texts):
        out[start:stop] = _chunk_statistics(texts[start:stop])
    return out


def _chunk_statistics(texts: Sequence[bytes]) -> np.ndarray:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    kind = np.full(256, len(CLASSES), dtype=np.int64)
    for k, members in enumerate(CLASSES.values()):
        kind[list(members)] = k
    width = len(CLASSES) + 1
    doc = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(doc * width + kind[data], minlength=len(texts) * width).reshape(-1, width)
    cols = [counts[:, k] / np.maximum(sizes, 1) for k in range(len(CLASSES))]

    words, per_word = word_hashes(texts)
    gap = np.zeros(256, dtype=bool)
    gap[[9, 10, 11, 12, 13, 32]] = True
    lengths = _word_lengths(texts, gap)
    n = np.maximum(per_word, 1)
    mean = _reduce(np.add, lengths, per_word) / n
    spread = np.sqrt(np.maximum(_reduce(np.add, lengths.astype(float) ** 2, per_word) / n - mean ** 2, 0))
    distinct, top = _distinct_and_top(words, per_word)
    shingles, per_shingle = shingle_hashes(texts)
    new_shingles, _ = _distinct_and_top(shingles, per_shingle)
    line_hashes, line_lengths, per_line = _lines(texts)
    new_lines, _ = _distinct_and_top(line_hashes, per_line)
    letters = counts[:, 0] + counts[:, 1]
    cols += [np.log1p(sizes), np.log1p(per_word), np.log1p(per_line), mean, spread, _reduce(np.maximum, lengths, per_word),
             _reduce(np.add, (lengths <= 3).astype(float), per_word) / n, sizes / np.maximum(per_line, 1), distinct / n, top / n,
             new_shingles / np.maximum(per_shingle, 1), new_lines / np.maximum(per_line, 1),
             _reduce(np.maximum, line_lengths, per_line), counts[:, 0] / np.maximum(letters, 1)]
    return np.column_stack(cols)


def _word_lengths(texts: Sequence[bytes], gap: np.ndarray) -> np.ndarray:
    is_gap = gap[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], is_gap)).astype(np.int8)))
    return edge[1::2] - edge[0::2]


@dataclass(frozen=True)
class Forest:
    """All trees in arrays: a node tests ``feature`` <= ``limit``, then goes to ``left`` or ``right``; leaves point to themselves."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.limit[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Newton boosting of the logistic loss on histograms of at most ``BINS`` bins a feature."""
    nodes: dict[str, list] = {k: [] for k in ("feature", "limit", "left", "right", "value")}

    def node(feature=0, limit=np.inf, value=0.0):
        k = len(nodes["value"])
        for name, v in zip(nodes, (feature, limit, k, k, value)):
            nodes[name].append(v)
        return k

    positive = (y.sum() + 1) / (len(y) + 2)
    start, roots = float(np.log(positive / (1 - positive))), []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        width = BINS + 1
        total = np.full(len(y), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            pull, weight = y - p, p * (1 - p)

            def grow(rows, left, pull=pull, weight=weight):
                g, h = pull[rows].sum(), weight[rows].sum()
                best, chosen = 1e-6, None
                if left and len(rows) >= 2 * LEAST_ROWS:
                    for f, c in enumerate(cuts):
                        b = binned[rows, f]
                        gs = np.cumsum(np.bincount(b, pull[rows], width))[:len(c)]
                        hs = np.cumsum(np.bincount(b, weight[rows], width))[:len(c)]
                        ns = np.cumsum(np.bincount(b, minlength=width))[:len(c)]
                        gain = gs ** 2 / (hs + RIDGE) + (g - gs) ** 2 / (h - hs + RIDGE) - g ** 2 / (h + RIDGE)
                        gain[(ns < LEAST_ROWS) | (len(rows) - ns < LEAST_ROWS)] = -1
                        if len(gain) and gain.max() > best:
                            best, chosen = gain.max(), (f, int(gain.argmax()))
                if chosen is None:
                    step = RATE * g / (h + RIDGE)
                    total[rows] += step
                    return node(value=step)
                f, k = chosen
                here = node(f, cuts[f][k])
                yes = binned[rows, f] <= k
                nodes["left"][here] = grow(rows[yes], left - 1)
                nodes["right"][here] = grow(rows[~yes], left - 1)
                return here

            roots.append(grow(np.arange(len(y)), depth))
    if not roots:
        roots = [node()]
    return Forest(start, np.array(roots), *(np.array(nodes[k]) for k in nodes), depth)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Forest:
    """Trees from at most ``rows`` labels of documents outside the held-out part, chosen by the hash of their ids.

    Labels without id or quality, and documents without id, teach nothing.  Null and empty texts count as empty.  An id with several labels
    or several rows counts once for each pair of them.  Without labels every score is one half.  Only ``doc_id``
    and ``text`` of ``docs`` are read.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    chosen = known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics([(t or "").encode() for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array(list(x), pa.list_(pa.float64()))],
                                             ["doc_id", "quality", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    got = texts.mapInArrow(run, f"doc_id {kinds['doc_id']}, quality {kinds['quality']}, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(-1, len(NAMES))
    y = np.array(got.column("quality").to_pylist(), dtype=float)
    order = np.lexsort((*x.T, y, np.array(got.column("doc_id").to_pylist(), dtype=float)))
    return fit_forest(x[order], y[order])


def score(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 at the threshold or above).

    Null and empty texts are scored as empty; repeated rows repeat; columns of
    those names are replaced.
    """
    docs = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = forest.score(statistics([(t or "").encode() for t in b.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                [*b.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, extended(docs, "score double, predicted int"))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with the scores of trees fitted on them: see :func:`fit` and :func:`score` for nulls, repeats and clashes."""
    return score(docs, fit(docs, labels, **options))
