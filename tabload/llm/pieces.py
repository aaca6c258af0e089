"""SentencePiece encoding and decoding with a distinct-chunk table.

No piece of the vocabularies this is for holds a whitespace marker after another character, so no merge
crosses the front of a run of markers: a text falls into chunks (markers and the characters up to the
next marker) that are segmented independently. Each task segments each distinct chunk of a batch
once, and the ids of the texts are put together by position. A vocabulary with such a piece, or with a normaliser
that changes characters, is refused.

Cases: a null text counts as empty, an empty text has no ids and decodes to the empty text. A text of any length is
encoded whole. The table of a task is emptied when it holds ``TABLE_CHARS`` characters; that changes nothing
but the time.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tabload.llm.common import ragged, slices, small_batches, tidy

MARK = "▁"
TABLE_CHARS = 3_000_000  # characters of distinct chunks a task keeps
SLICE_BYTES = 1_000_000  # of texts worked on at once
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class _Places(dict):
    """Numbers chunks in the order in which they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = place = len(self)
        return place


class ChunkTable:
    """Distinct chunks and their ids."""

    def __init__(self, model: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.model.get_piece_size()
        if any(MARK in self.model.id_to_piece(at).lstrip(MARK) for at in range(size)):
            raise ValueError("the vocabulary has pieces that cross a whitespace marker")
        if self.model.decode(self.model.encode("    ﬁ① ")) != "    ﬁ① ":
            raise ValueError("the model's normaliser changes characters or white space")
        self.clear()

    def clear(self) -> None:
        self.place = _Places()
        self.chars = 0
        self.ids = np.empty(0, dtype=np.int32)
        self.starts = np.empty(0, dtype=np.int64)
        self.lengths = np.empty(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        chunks: list[str] = []
        counts = np.empty(len(texts), dtype=np.int64)
        for at, text in enumerate(texts):
            before = len(chunks)
            if text:
                marked = text.replace(" ", MARK)
                chunks += self._chunks(marked)
            counts[at] = len(chunks) - before
        at = np.fromiter(map(self.place.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        self._learn()
        lengths = self.lengths[at]
        ids = self.ids[ragged(self.starts[at], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        edges = np.concatenate(([0], np.cumsum(counts)))
        found = np.diff(ends[edges])
        if self.chars > TABLE_CHARS:
            self.clear()
        return ids, found

    @staticmethod
    def _chunks(marked: str) -> list[str]:
        """The chunks of a text, each without its first marker, which the encoder puts in front of any text."""
        if MARK + MARK not in marked and marked[0] != MARK and marked[-1] != MARK:
            return marked.split(MARK)
        return [chunk[1:] for chunk in _CHUNK.findall(MARK + marked)]

    def _learn(self) -> None:
        """Segment the chunks that were numbered since the last call."""
        chunks = self.place.new
        if not chunks:
            return
        found = self.model.encode([chunk.replace(MARK, " ") for chunk in chunks], num_threads=1)
        # the encoder gives an empty text no marker, so the marker on its own is put in
        found = [ids or [self.model.piece_to_id(MARK)] for ids in found]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        first = len(self.ids) + np.cumsum(lengths) - lengths
        flat = np.fromiter(itertools.chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum()))
        self.ids = np.concatenate((self.ids, flat))
        self.starts = np.concatenate((self.starts, first))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.chars += sum(map(len, chunks))
        chunks.clear()


def tokenize(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids, decoded`` per row: the ids of the text as the library's encode gives them, and their text as its decode does.

    One Python step per task does both and hands out small batches, so neither the ids nor the texts of a large batch are
    held twice.
    """
    schema = StructType([
        docs.schema[id_col], StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType()),
    ])

    @tidy
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for batch in batches:
            keys, column = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for part in slices(sizes, SLICE_BYTES):
                texts = [x or "" for x in column[part].to_pylist()]
                ids, counts = table.encode(texts)
                ends = np.concatenate(([0], np.cumsum(counts)))
                decoded = [table.model.decode(ids[a:b].tolist()) if b > a else "" for a, b in zip(ends[:-1], ends[1:], strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys[part], lists, pa.array(decoded, pa.string())], schema.names)

    small_batches()
    return docs.select(id_col, text_col).mapInArrow(both, schema)


def decode(ids: Column, model: str) -> Column:
    """The text of an array of ids, as the library's decode gives it; null gives the empty text."""
    small_batches()

    @F.arrow_udf("string")
    @tidy
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            values, ends = batch.values.to_numpy(), batch.offsets.to_numpy()
            texts = (processor.decode(values[a:b].tolist()) if b > a else "" for a, b in zip(ends[:-1], ends[1:], strict=True))
            yield pa.array(texts, pa.string(), size=len(batch))

    return text_of(ids)
