"""Words and five-word shingles of many texts at once, hashed in numpy.

Words are maximal runs of bytes outside space and 0x09-0x0D; only A-Z are
lower-cased, so working on UTF-8 bytes gives the same words as code points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WIDTH = 5
CHUNK_BYTES = 1 << 20            # text hashed at a time; a longer text is a chunk of its own

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_STEP = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit words (the splitmix64 finalizer)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def chunks(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of the texts that together hold about ``limit`` bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the number of words of each text."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    gap = np.zeros(256, dtype=bool)
    gap[[9, 10, 11, 12, 13, 32]] = True
    codes = mix(np.arange(1, 257, dtype=_U) * _BASE)[lower]
    is_gap = gap[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], is_gap)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    # sum of code * base^position, then shifted back to the word's own start
    with np.errstate(over="ignore"):
        power = np.full(len(data), _BASE)
        power[:1] = 1
        np.multiply.accumulate(power, out=power)
        total = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(codes[data] * power, out=total[1:])
        back = np.full(len(data), _U(_inverse(int(_BASE))))
        back[:1] = 1
        np.multiply.accumulate(back, out=back)
        words = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(_U))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, bounds)
    return words, np.diff(np.concatenate(([0], upto)))


def shingle_hashes(texts: Sequence[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and how many each text has.

    A text of fewer words has one: its whole sequence; without words, none.
    Repeated shingles are repeated here.
    """
    words, counts = word_hashes(texts)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    with np.errstate(over="ignore"):
        n = max(len(words) - width + 1, 0)
        rolled = np.zeros(n, dtype=_U)
        for k in range(width):
            rolled = rolled * _STEP + words[k:n + k]
        rolled = mix(rolled)
        full = np.maximum(counts - width + 1, 0)
        per = np.where(counts >= width, full, np.minimum(counts, 1))
        out = np.empty(int(per.sum()), dtype=_U)
        place = np.concatenate(([0], np.cumsum(per)))[:-1]
        long = np.flatnonzero(full)
        if len(long):
            lens = full[long]
            inner = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            out[np.repeat(place[long], lens) + inner] = rolled[np.repeat(offsets[long], lens) + inner]
        for d in np.flatnonzero((counts > 0) & (counts < width)):
            h = _U(counts[d])
            for w in words[offsets[d]:offsets[d + 1]]:
                h = h * _STEP + w
            out[place[d]] = mix(np.array([h ^ _BASE]))[0]
    return out, per


def shingle_sets(texts: Sequence[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, per = shingle_hashes(texts, width)
    ends = np.cumsum(per)
    return [np.unique(hashes[e - n:e]) for e, n in zip(ends, per)]
