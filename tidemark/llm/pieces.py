"""SentencePiece encoding by sampling, and decoding.

All pieces of the vocabulary that match a text form a lattice.  Forward filtering
sums the probability of all paths up to every place, backward sampling draws one
path from the end.  The draws are hashes of the row's key, the unit's
number in the row and the step, so a row gets the same pieces in any partition,
run or retry.  No piece has a space after another character, so the lattice
falls apart at spaces, and where no piece goes on from a letter to another sign, before
those: the parts are units, each filtered once however often it occurs.  The draws of all units of a chunk of
texts are made together, step by step, in numpy.

The vocabulary ranks its pieces by merge; their probabilities follow Zipf's law
over the rank.  Characters without a piece, and a literal U+2581, are written as
bytes, so decoding gives back the text exactly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import extended
from .shingles import chunks, mix

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LITERAL = "\ud800"              # stands for a U+2581 of the text; no text can hold it
SHARPNESS = 0.3                 # exponent on the probabilities: 1 and above nearer to the best path
CHUNK_BYTES = 1 << 18           # of texts encoded together; a longer text is a chunk of its own
SHORT = 64                      # longer units are filtered one by one
MOST_NODES = 700_000            # of remembered units, then they are forgotten


class Pieces:
    """A vocabulary as lattice weights."""

    def __init__(self, model: bytes, sharpness: float = SHARPNESS):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.byte_ids = [0] * 256
        self.texts: list[bytes] = [b""] * n
        self.ids: dict[str, int] = {}
        ranks = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.texts[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.texts[i] = piece.replace(SPACE, " ").encode()
                ranks.append((-sp.get_score(i), i))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("the vocabulary has pieces that reach over a space")
        places = {i: r for r, (_, i) in enumerate(sorted(ranks), 1)}
        total = sum(1 / (r + 2.7) for r in range(1, len(ranks) + 257))
        self.weight = [0.0] * n
        for i in range(n):
            self.weight[i] = sharpness * -math.log((places.get(i, len(ranks) + 128) + 2.7) * total)
        self.starts = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        self.sharpness, self.radix = sharpness, 0
        alone = "" if any("\n" in p for p in self.ids) else "\n"
        inner = f"[^{SPACE}{alone}]+"
        # where no piece goes on from a letter or digit to another sign, units end there too
        if not any(re.search(r"[^\W_](?=[\W_])", p) for p in self.ids):
            inner = rf"(?:[^\w{SPACE}{alone}]|_)*[^\W_]+|{SPACE}*(?:[^\w{SPACE}{alone}]|_)+"
        self.unit = re.compile(f"{SPACE}*{inner}|{SPACE}+" + (f"|{alone}" if alone else ""))

    def units(self, text: str) -> list[str]:
        """Runs between which no piece reaches; a space is put before the text."""
        return self.unit.findall(SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE))

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.texts.__getitem__, ids))[1:].decode("utf-8")

    def _trie(self) -> None:
        """Transitions (node, character) -> node in a hash table, and the piece each node spells."""
        nodes = {p: k for k, p in enumerate(sorted(self.starts), 1)}
        nodes[""] = 0
        letters = sorted({c for p in self.starts for c in p})
        self.letters = np.array([ord(c) for c in letters], dtype=np.int32)         # 0 stands for all others
        numbers = {c: k for k, c in enumerate(letters, 1)}
        self.radix = len(letters) + 1
        if len(nodes) * self.radix >= 1 << 31:
            raise ValueError("the vocabulary is too large for 32-bit transitions")
        self.bits = (4 * len(nodes)).bit_length()
        self.slot_keys = np.full(1 << self.bits, -1, dtype=np.int32)
        self.slot_nodes = np.zeros(1 << self.bits, dtype=np.int32)
        spelt = [p for p in nodes if p]
        keys = np.array([nodes[p[:-1]] * self.radix + numbers[p[-1]] for p in spelt], dtype=np.int32)
        children = np.array([nodes[p] for p in spelt], dtype=np.int32)
        slots = self._slots(keys)
        while len(keys):                    # of the keys that meet in a free slot one stays, the others go on
            free = np.flatnonzero(self.slot_keys[slots] < 0)
            taken, first = np.unique(slots[free], return_index=True)
            self.slot_keys[taken], self.slot_nodes[taken] = keys[free[first]], children[free[first]]
            rest = np.ones(len(keys), dtype=bool)
            rest[free[first]] = False
            keys, children = keys[rest], children[rest]
            slots = (slots[rest] + np.uint32(1)) & np.uint32((1 << self.bits) - 1)
        self.spelled = np.full(len(nodes), -1, dtype=np.int32)
        for p, i in self.ids.items():
            self.spelled[nodes[p]] = i
        self.longest = max(map(len, self.ids))
        # probabilities scaled by a constant per character, so that products over a unit stay in range
        self.scaled = np.exp(np.array(self.weight) + 5.0 * self.sharpness * np.array([len(t.decode("utf-8", "replace")) for t in self.texts]))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.view(np.uint32) * np.uint32(2654435769)) >> np.uint32(32 - self.bits)

    def _step(self, nodes: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which transitions there are, and where those lead."""
        keys = nodes * np.int32(self.radix) + letters
        slots = self._slots(keys)
        found = self.slot_keys[slots]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + np.uint32(1)) & np.uint32((1 << self.bits) - 1)
            found[open_] = self.slot_keys[slots[open_]]
            open_ = open_[(found[open_] != keys[open_]) & (found[open_] >= 0)]
        hit = found == keys
        return hit, self.slot_nodes[slots[hit]]

    def lattices(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """The lattices of many units of at most ``SHORT`` characters, one after the other.

        As :meth:`lattice`, with places of the whole; and which units have a character
        without a piece: their part is not to be used.
        """
        if not self.radix:              # decoding never needs it
            self._trie()
        text = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
        place = np.minimum(np.searchsorted(self.letters, text), len(self.letters) - 1)
        letter = np.where(self.letters[place] == text, place + 1, 0).astype(np.int32)
        lens = np.fromiter(map(len, units), np.int32, len(units))
        ends = np.cumsum(lens, dtype=np.int32)
        base = np.repeat(ends - lens, lens)
        left = np.repeat(ends, lens) - np.arange(len(text), dtype=np.int32)
        at, node, found = np.arange(len(text), dtype=np.int32), np.zeros(len(text), dtype=np.int32), []
        for size in range(1, self.longest + 1):
            go = left[at] >= size
            at, node = at[go], node[go]
            hit, node = self._step(node, letter[at + (size - 1)])
            at = at[hit]
            piece = self.spelled[node]
            known = piece >= 0
            if size == 1:
                bad = np.ones(len(text), dtype=bool)
                bad[at[known]] = False
            found.append((at[known], piece[known]))
        start = np.concatenate([f[0] for f in found])
        piece = np.concatenate([f[1] for f in found])
        size = np.repeat(np.arange(1, len(found) + 1, dtype=np.int32), [len(f[0]) for f in found])
        end = start + size - 1
        prev = np.where(start > base[start], start - 1, np.int32(-1))
        depth = (end - base[end]).astype(np.uint8)
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(SHORT + 1))
        # in order of depth, so that each step reads what the steps before have summed
        prevs, ends_, shares = prev[order], end[order], self.scaled[piece[order]]
        alpha = np.zeros(len(text) + 1)
        alpha[-1] = 1.0                 # the start, which -1 stands for
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if low < high:
                shares[low:high] *= alpha[prevs[low:high]]
                np.add.at(alpha, ends_[low:high], shares[low:high])
        with np.errstate(invalid="ignore", divide="ignore"):
            shares /= alpha[ends_]
        share = np.empty(len(end))
        share[order] = shares
        count = np.bincount(end, minlength=len(text))
        first = (np.cumsum(count) - count).astype(np.int32)
        out = [np.empty(len(end), np.int32), np.empty(len(end), np.int32), np.empty(len(end))]
        filled, run = np.zeros(len(text), dtype=np.int32), np.zeros(len(text))
        stop = len(end)
        for starts, _ in reversed(found):           # longest pieces first: they are the likeliest
            own = slice(stop - len(starts), stop)
            stop -= len(starts)
            at = end[own]
            slot = first[at] + filled[at]
            filled[at] += 1
            summed = run[at] + share[own]
            run[at] = summed
            out[0][slot], out[1][slot], out[2][slot] = prev[own], piece[own], summed
        full = count > 0
        out[2][(first + count - 1)[full]] = 2.0
        return (*out, first, np.add.reduceat(bad, ends - lens) > 0)

    def lattice(self, unit: str) -> tuple[list[int], list[int], list[float], list[int]]:
        """Edges grouped by the node they end in: previous node (-1: start), piece,
        cumulated probability; and the number of edges of each node.  Node k - 1 is the
        place after k characters; places inside a character's bytes follow at the end.
        """
        n, get, starts, weight = len(unit), self.ids.get, self.starts, self.weight
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
        total = [0.0] * (n + 1)
        inner: list[tuple[int, int]] = []           # nodes inside characters: previous node, byte piece
        for i in range(n):
            if i:
                own = into[i]
                if len(own) == 1:
                    total[i] = own[0][2]
                else:
                    top = max(e[2] for e in own)
                    total[i] = top + math.log(sum(math.exp(e[2] - top) for e in own))
            at, j = total[i], i + 1
            while j <= n:
                part = unit[i:j]
                if part not in starts:
                    break
                piece = get(part)
                if piece is not None:
                    into[j].append((i - 1, piece, at + weight[piece]))
                j += 1
            if get(unit[i]) is None:
                c = SPACE if unit[i] == LITERAL else unit[i]
                raw = [self.byte_ids[b] for b in c.encode()]
                before = i - 1
                for b in raw[:-1]:
                    inner.append((before, b))
                    before = n + len(inner) - 1
                into[i + 1].append((before, raw[-1], at + sum(weight[b] for b in raw)))
        prev, piece, cum, count = [], [], [], []
        for own in into[1:]:
            top, acc = max(e[2] for e in own), 0.0      # edges are in order of their start: longest first
            whole = sum(math.exp(e[2] - top) for e in own)
            for e in own:
                acc += math.exp(e[2] - top) / whole
                prev.append(e[0])
                piece.append(e[1])
                cum.append(acc)
            cum[-1] = 2.0
            count.append(len(own))
        for before, b in inner:
            prev.append(before)
            piece.append(b)
            cum.append(2.0)
            count.append(1)
        return prev, piece, cum, count


class _Growing:
    """A numpy array that is appended to."""

    def __init__(self, dtype):
        self.data, self.size = np.empty(1 << 12, dtype), 0

    def extend(self, values) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            self.data = np.concatenate((self.data, np.empty(max(end, len(self.data)), self.data.dtype)))
        self.data[self.size:end] = values
        self.size = end


class Sampler:
    """Draws segmentations; remembers the lattices of the units it has met."""

    def __init__(self, pieces: Pieces, seed: int = 0):
        self.pieces, self.seed = pieces, np.uint64(seed)
        self.forget()

    def forget(self) -> None:
        self.ends: dict[str, int] = {}
        self.prev, self.piece = _Growing(np.int32), _Growing(np.int32)
        self.cum, self.first = _Growing(np.float64), _Growing(np.int32)

    def learn(self, units: Sequence[str]) -> None:
        short = [u for u in units if len(u) <= SHORT]
        rest = [u for u in units if len(u) > SHORT]
        if short:
            prev, piece, cum, first, bad = self.pieces.lattices(short)
            nodes = np.cumsum(np.fromiter(map(len, short), np.int64, len(short))) + self.first.size - 1
            self.ends.update(zip(short, nodes.tolist()))
            rest += [u for u, b in zip(short, bad) if b]
            self._add(prev, piece, cum, first)
        for u in rest:
            prev, piece, cum, count = map(np.array, self.pieces.lattice(u))
            self.ends[u] = self.first.size + len(u) - 1
            self._add(prev, piece, cum, np.cumsum(count) - count)

    def _add(self, prev: np.ndarray, piece: np.ndarray, cum: np.ndarray, first: np.ndarray) -> None:
        node, edge = self.first.size, self.prev.size
        self.prev.extend(np.where(prev >= 0, prev + node, -1))
        self.piece.extend(piece)
        self.cum.extend(cum)
        self.first.extend(first + edge)

    def encode(self, texts: Sequence[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after the other, and how many each has."""
        units = [self.pieces.units(t) if t else [] for t in texts]
        if self.first.size > MOST_NODES:
            self.forget()
        ends, flat = self.ends, list(chain.from_iterable(units))
        places = list(map(ends.get, flat))
        missing = [k for k, p in enumerate(places) if p is None]
        if missing:
            self.learn(list({flat[k] for k in missing}))
            for k in missing:
                places[k] = ends[flat[k]]
        per = np.array([len(u) for u in units], dtype=np.int64)
        at = np.array(places, dtype=np.int32)
        prev, piece, cum, first = (g.data for g in (self.prev, self.piece, self.cum, self.first))
        number = np.arange(len(at)) - np.repeat(np.cumsum(per) - per, per)
        with np.errstate(over="ignore"):
            stream = mix(np.repeat(mix(keys + self.seed), per) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            live, steps, found = np.arange(len(at)), np.zeros(len(at), dtype=np.int64), []
            step = 0
            while len(live):
                step += 1
                draw = (mix(stream[live] + np.uint64(step)) >> np.uint64(11)) * 2.0 ** -53
                edge = first[at]
                while True:
                    on = cum[edge] <= draw
                    if not on.any():
                        break
                    edge += on
                found.append((live, piece[edge]))
                steps[live] = step
                back = prev[edge]
                going = back >= 0
                live, at = live[going], back[going]
        last = np.cumsum(steps)
        out = np.empty(int(steps.sum()), dtype=np.int32)
        for k, (who, ids) in enumerate(found):
            out[last[who] - 1 - k] = ids
        upto = np.concatenate(([0], last))[np.cumsum(per)]
        return out, np.diff(np.concatenate(([0], upto)))


def row_keys(values: Sequence) -> np.ndarray:
    """64-bit keys of ids; null has one of its own."""
    return mix(np.array([0x5EED if v is None else v & (2 ** 64 - 1) for v in values], dtype=np.uint64))


def _model(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())     # a fixed file, under 1 MB


def encode_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", seed: int = 0,
                  sharpness: float = SHARPNESS, check: bool = False) -> DataFrame:
    """``docs`` plus ``piece_ids``: a sampled segmentation of ``text``.

    It depends on the text, the integer ``key`` column and the seed only; repeated rows
    get equal ids.  Null text: null; empty text: no piece.  With ``check`` the ids are decoded
    where they were made, and ``lossless`` says whether that gave the text back.  Columns
    of those names are replaced.
    """
    added = ["piece_ids", "lossless"] if check else ["piece_ids"]
    docs = docs.drop(*added)
    model = _model(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(Pieces(model.value, sharpness), seed)
        for b in batches:
            texts, keys = b.column("text").to_pylist(), row_keys(b.column(key).to_pylist())
            for start, stop in chunks([t or "" for t in texts], CHUNK_BYTES):
                part = texts[start:stop]
                ids, per = sampler.encode(part, keys[start:stop])
                offsets = pa.array(np.concatenate(([0], np.cumsum(per))), pa.int32(),
                                   mask=np.array([t is None for t in part] + [False]))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                new = [lists]
                if check:
                    ends = np.cumsum(per).tolist()
                    new.append(pa.array([t is None or sampler.pieces.decode(ids[e - n:e].tolist()) == t
                                         for t, e, n in zip(part, ends, per.tolist())], pa.bool_()))
                rows = b.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], [*rows.schema.names, *added])

    return docs.mapInArrow(run, extended(docs, "piece_ids array<int>" + (", lossless boolean" if check else "")))


def decode_pieces(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` plus ``decoded``: the text of ``piece_ids``; null for null."""
    encoded = encoded.drop("decoded")
    model = _model(encoded, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model.value)
        for b in batches:
            texts = []
            for ids in b.column("piece_ids"):
                texts.append(None if not ids.is_valid else pieces.decode(ids.values.to_numpy().tolist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, extended(encoded, "decoded string"))
