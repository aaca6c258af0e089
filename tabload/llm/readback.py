"""Digests of formatted conversations, read back from nothing but the formatted text, the offsets and the mask.

Cases: as in ``chat``. Pieces of one conversation are read one after the other, as ``chat.format_conversations`` hands them out, so
digests of a conversation of any length need no more memory than one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabload.llm import chat


class _Digests:
    """What is known of the conversation that is being read."""

    def __init__(self, key: list) -> None:
        self.key = key
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> None:
        for role, text in chat.parse(rendered):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for text in chat.masked_texts(rendered, starts, ends, loss):
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.formatted_chars += len(rendered)

    def row(self) -> tuple:
        return (*self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


def digests(formatted: DataFrame, id_col: str = "conv_id", *more: str) -> DataFrame:
    """``id_col, *more, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` per conversation.

    ``formatted`` comes straight from ``chat.format_conversations``: the pieces of a conversation stand together.
    """
    keys = [id_col, *more]
    schema = StructType([
        *(formatted.schema[key] for key in keys), StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Digests | None = None
        for batch in batches:
            found = []
            for at in range(len(batch)):
                key = [batch.column(name)[at].as_py() for name in keys]
                if own is None or key != own.key:
                    if own is not None:
                        found.append(own.row())
                    own = _Digests(key)
                values = [batch.column(name)[at].values.to_numpy(zero_copy_only=False) for name in ("starts", "ends", "loss")]
                own.add(batch.column("formatted")[at].as_py(), *values)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, batch.schema.field(name).type if name in keys else None) for x, name in zip(zip(*found, strict=True), schema.names, strict=True)],
                    schema.names,
                )
        if own is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], batch.schema.field(name).type if name in keys else None) for x, name in zip(own.row(), schema.names, strict=True)],
                schema.names,
            )

    return formatted.select(*keys, "formatted", "starts", "ends", "loss").mapInArrow(read, schema)
