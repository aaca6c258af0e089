"""Chat formatting: conversations rendered with control strings, token ids, and a loss mask on the assistant's texts.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line end. The three control strings are tokens of their own, added
to the vocabulary of the tokenizer, so a token never reaches across the edge of a text. Wherever a role or text holds ``<``, any number of
``\\`` and ``|``, one ``\\`` more is put in; so no control string, nor that of any special token, can arise from a text, and taking
one ``\\`` away gives the text back.

Rows meet their conversation by one shuffle and stand there by turn. A whole conversation is rendered and encoded once, with
offsets; the loss mask comes from the sorted spans of the assistant's texts and the offsets of the tokens by binary search. A
conversation longer than ``PIECE_CHARS`` is cut between turns and gives several rows, numbered, so a task holds one such piece (or one
text, if that is longer), not a conversation. Edges of turns are edges of tokens, so the cuts change no token.

Cases: a null text or role counts as empty, an empty text of an assistant has no token under the mask; rows without a conversation form one
of their own, turns without a number come first; rows with equal turn numbers are ordered by role and text, repeated rows are
repeated turns. An empty table gives no rows. Any role may occur; only ``assistant`` is under the mask.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tabload.llm.common import small_batches

START, SEP, END = CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
TRAINED_ROLE = "assistant"
PIECE_CHARS = 1_000_000
BATCH_CHARS = 4_000_000  # of rendered text handed out at once

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile("(?s)" + re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END) + "\n")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The text of a conversation and the (start, end) of each text under the loss mask, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}{END}\n")
        at += len(parts[-1])
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(rendered)]


def mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the sorted spans."""
    if not len(spans):
        return np.zeros(len(starts), dtype=bool)
    first = np.searchsorted(spans[:, 1], starts, "right")  # the first span that ends after the token starts
    near = first < len(spans)
    return near & (spans[np.where(near, first, 0), 0] < ends)


def masked_texts(rendered: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """What the tokens under the mask cover, unescaped: one text for each stretch of them."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], loss.astype(np.int8), [0]))))
    first, last = edges[::2], edges[1::2] - 1
    return [unescape(rendered[a:b]) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)]


@dataclass
class Encoder:
    """A byte-level tokenizer of the tokenizers library with the control strings added."""

    library: tokenizers.Tokenizer

    @staticmethod
    def load(path: str) -> Encoder:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = tokenizers.Tokenizer.from_file(path)
        library.post_processor = tokenizers.processors.ByteLevel(trim_offsets=False)
        library.add_special_tokens([tokenizers.AddedToken(x, special=True, normalized=False) for x in CONTROLS])
        return Encoder(library)

    def encode(self, rendered: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) of each text; tokens that share a character all have its whole range."""
        out = []
        for found in self.library.encode_batch(rendered, add_special_tokens=False):
            offsets = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
            out.append((np.array(found.ids, dtype=np.int64), offsets[:, 0], offsets[:, 1]))
        return out


def format_conversations(rows: DataFrame, model: str, id_col: str = "conv_id", *more: str) -> DataFrame:
    """``id_col, *more, piece, n_turns, formatted, ids, starts, ends, loss`` per conversation, in order within each task.

    ``rows`` has ``turn, role, text``; conversations are told apart by ``id_col`` and ``more``.
    """
    keys = [id_col, *more]
    schema = StructType([
        *(rows.schema[key] for key in keys), StructField("piece", LongType()), StructField("n_turns", LongType()),
        StructField("formatted", StringType()), StructField("ids", ArrayType(IntegerType())),
        StructField("starts", ArrayType(LongType())), StructField("ends", ArrayType(LongType())), StructField("loss", ArrayType(BooleanType())),
    ])

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(model)
        pieces: list[tuple] = []  # (keys, number, turns)
        own, number, turns, chars = None, 0, [], 0

        def done() -> pa.RecordBatch:
            texts, spans = zip(*(render(found) for _, _, found in pieces), strict=True)
            encoded = encoder.encode(list(texts))
            counts = pa.array(np.concatenate(([0], np.cumsum([len(ids) for ids, _, _ in encoded]))), pa.int32())
            flat = [np.concatenate(x) for x in zip(*encoded, strict=True)]
            loss = np.concatenate([mask(a, b, span) for (_, a, b), span in zip(encoded, spans, strict=True)])
            columns = [pa.array([x[0][at] for x in pieces], batch.schema.field(at).type) for at in range(len(keys))]
            columns += [pa.array([x[1] for x in pieces]), pa.array([len(x[2]) for x in pieces], pa.int64()), pa.array(texts, pa.string())]
            lists = [*zip(flat, (pa.int32(), pa.int64(), pa.int64()), strict=True), (loss, pa.bool_())]
            columns += [pa.ListArray.from_arrays(counts, pa.array(values, kind)) for values, kind in lists]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        waiting = 0
        for batch in batches:
            for *key, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                size = len(role or "") + len(text or "")
                if turns and (key != own or chars + size > PIECE_CHARS):
                    pieces.append((own, number, turns))
                    number, turns, chars = number + 1, [], 0
                    if waiting + size > BATCH_CHARS:
                        yield done()
                        pieces, waiting = [], 0
                if key != own:
                    own, number = key, 0
                turns.append((role or "", text or ""))
                chars += size
                waiting += size
        if turns:
            pieces.append((own, number, turns))
        if pieces:
            yield done()

    small_batches()
    ordered = rows.select(*keys, "turn", "role", "text").repartition(*keys).sortWithinPartitions(*keys, "turn", "role", "text")
    return ordered.select(*keys, "role", "text").mapInArrow(formatted, schema)
