"""Chat formatting: conversations as token ids with reserved ids between the segments.

A turn is written ``<|turn|>role<|text|>text<|end|>``.  The three marks are
reserved ids above the vocabulary.  Role and text are encoded apart from each
other and from the marks, so no token spans a mark and no text can produce one.
Control strings inside a segment are escaped before encoding: ``\\`` becomes
``\\\\`` and ``<|`` becomes ``\\<|``, which one pass of ``unescape`` takes back.
The loss mask is a running sum over +1 where an assistant text starts and -1
where it ends; it covers the text's tokens only.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MARKS = ("<|turn|>", "<|text|>", "<|end|>")
LEARNED_ROLE = "assistant"

FORMATTED = "ids array<int>, loss_mask array<tinyint>, formatted_chars bigint"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "\\<|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class Codec:
    """A byte-level vocabulary file as encoder and decoder, with ids for the marks."""

    def __init__(self, vocabulary: bytes, pattern: str):
        import tiktoken
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.first_mark = max(ranks.values()) + 2        # one id stays free for end of text

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids) -> str:
        return self.encoding.decode_bytes(list(ids)).decode("utf-8")


def format_turn(codec: Codec, role: str, text: str) -> tuple[list[int], np.ndarray, int]:
    """Ids and loss mask of one turn, and the length of its written form."""
    turn, middle, end = (codec.first_mark + k for k in range(3))
    role_text, body_text = escape(role), escape(text)
    head, body = codec.encode(role_text), codec.encode(body_text)
    ids = [turn, *head, middle, *body, end]
    steps = np.zeros(len(ids) + 1, dtype=np.int8)
    if role == LEARNED_ROLE:
        steps[len(head) + 2] += 1
        steps[len(ids) - 1] -= 1
    return ids, np.cumsum(steps[:-1], dtype=np.int8), sum(map(len, MARKS)) + len(role_text) + len(body_text)


def read_turn(codec: Codec, ids, mask) -> tuple[str, str, str]:
    """Role, text and learned text, from the ids and the mask alone."""
    ids, mask = np.asarray(ids), np.asarray(mask)
    turn, middle, end = (codec.first_mark + k for k in range(3))
    cut = int(np.flatnonzero(ids == middle)[0])
    if ids[0] != turn or ids[-1] != end or (ids >= turn).sum() != 3:
        raise ValueError("not one formatted turn")
    role = unescape(codec.decode(ids[1:cut]))
    text = unescape(codec.decode(ids[cut + 1:-1]))
    learned = unescape(codec.decode(ids[mask == 1]))
    return role, text, learned


def _pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())     # a fixed file, under 1 MB


def format_chat(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``turns`` (role, text and any other columns) plus ``ids``, ``loss_mask``, ``formatted_chars``.

    One row stays one row: a conversation's tokens are its rows' ids by turn.
    Null role or text: empty.  Columns that clash with the new ones are replaced.
    """
    added = ["ids", "loss_mask", "formatted_chars"]
    turns = turns.drop(*added)
    words, pattern = _vocabulary(turns, vocabulary), _pattern()
    kinds = [pa.list_(pa.int32()), pa.list_(pa.int8()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(words.value, pattern)
        for b in batches:
            done = [format_turn(codec, r or "", t or "") for r, t in
                    zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            new = [pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, *added])

    return turns.mapInArrow(run, extended(turns, FORMATTED))


def read_chat(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What the tokens say: ``role``, ``text`` and ``learned`` of every formatted row."""
    words, pattern = _vocabulary(formatted, vocabulary), _pattern()
    kept = [c for c in formatted.columns if c not in ("ids", "loss_mask", "role", "text", "learned")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(words.value, pattern)
        for b in batches:
            read = [read_turn(codec, i, m) for i, m in
                    zip(b.column("ids").to_pylist(), b.column("loss_mask").to_pylist())]
            new = [pa.array([r[k] for r in read], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *new],
                                             [*kept, "role", "text", "learned"])

    schema = extended(formatted.select(*kept), "role string, text string, learned string")
    return formatted.select(*kept, "ids", "loss_mask").mapInArrow(run, schema)


def conversation_digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per conversation: turns, their digest, and length and digest of the learned text.

    Needs ``conv_id`` and ``turn``.  Equal turns are ordered by role, then text; a
    null conversation id is a conversation of its own, null turns come first.
    Tokens are read back before the shuffle, evenly over all tasks.  The digest
    of a conversation needs its texts in order: they pass a task as a sorted
    stream, of which only two running hashes are held, whatever its length.
    """
    read = read_chat(formatted.select("conv_id", "turn", "ids", "loss_mask", "formatted_chars"), vocabulary)
    # the learned text is mostly the text itself or nothing: only others are moved
    read = read.select(
        "conv_id", "turn", "role", "text", "formatted_chars",
        (F.col("learned") == F.col("text")).alias("whole"),
        F.when(F.col("learned") != F.col("text"), F.nullif(F.col("learned"), F.lit(""))).alias("other"))
    ordered = (read.repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "text"))

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, kind = None, None, None

        def closed(rows):
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        def row():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for b in batches:
            kind, rows = b.schema.field("conv_id").type, []
            for conv, role, text, chars, whole, other in zip(*(b.column(c).to_pylist() for c in (
                    "conv_id", "role", "text", "formatted_chars", "whole", "other"))):
                if now != (conv,):
                    if now is not None:
                        rows.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                learned = text if whole else (other or "")
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += chars
            yield closed(rows)
        if now is not None:
            yield closed([row()])

    id_type = formatted.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {id_type}, n_turns bigint, turns_sha256 string, "
                                   "loss_chars bigint, loss_sha256 string, formatted_chars bigint")
