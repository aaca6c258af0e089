"""Cross-tokenizer alignment: which tokens of a byte-level BPE and of a SentencePiece vocabulary cover the same bytes.

A text is read as a space and the text. Both tokenizers always end a token before a single space between two characters that are no
white space (the first takes the space to what follows; no piece of the second has its space marker after another character), so
a text is cut there and equal stretches of a task are encoded and aligned once. The stretches of a batch form two tables of tokens with
byte offsets. ``pandas.merge_asof``, keyed by the stretch, gives each token the token of the other side that covers its first byte;
the union of both directions is all overlaps. Offsets where both sides end cut the tokens into groups.

An id pair's count is the number of documents that hold it linked. Documents are aligned once and staged with their distinct pairs;
each task sums what its documents hold before anything is shuffled. The table of counts is broadcast up to ``BROADCAST_PAIRS`` pairs;
beyond that the pairs of the documents are joined with it by a shuffle. Results are the same either way.

Cases: texts that are null, empty, or that the pieces do not give back byte for byte (those with U+2581 in them) have no tokens: no ids,
no groups, all numbers zero. Strings of special tokens in a text are plain text. Rows repeated get repeated results and count as
documents of their own. Nulls in other columns pass through; a text of any length is aligned whole.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import re
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tabload.llm.common import Numbered, fresh, ragged, slices, small_batches
from tabload.llm.pieces import MARK
from tabload.session import stage

TABLE_CHARS = 2_500_000  # characters of distinct stretches a task keeps
SLICE_BYTES = 1_000_000  # of texts worked on at once
NEW_STRETCHES = 20_000  # stretches aligned at once
JOINED = 500  # stretches encoded as one text
ALONE = 100  # stretches encoded one by one where some of them cannot be joined
BROADCAST_PAIRS = 3_000_000
SIDE = 1 << 16  # ids of either vocabulary are below this

_CUT = re.compile(r" (?<=\S )(?=\S)")
_EDGE = re.compile(r"\s\s|\A\s|\s\Z")


def byte_alphabet() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: printable ones as they are, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(0x100 + at): byte for at, byte in enumerate(rest)}


class ByteSide:
    """A byte-level BPE of the tokenizers library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes_of = {
            at: bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
            for entry, at in self.library.get_vocab(with_added_tokens=True).items()
        }

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]


class PieceSide:
    """A SentencePiece model, which puts the space in front itself."""

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(at) for at in range(self.library.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("the vocabulary has pieces that cross a whitespace marker")
        self.bytes_of = {
            at: bytes([int(piece[3:5], 16)]) if self.library.is_byte(at) else piece.replace(MARK, " ").encode()
            for at, piece in enumerate(pieces)
        }

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


def tokens(keys: np.ndarray, counts: np.ndarray, ids: np.ndarray, size_of: np.ndarray) -> pd.DataFrame:
    """``key, id, start, end, at``: tokens with the byte offsets they cover, counted over all texts one after the other."""
    end = np.cumsum(size_of[ids])
    return pd.DataFrame({"key": np.repeat(keys, counts), "id": ids, "start": end - size_of[ids], "end": end, "at": np.arange(len(ids))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """``key, a, b``: positions of all pairs of tokens of one text whose byte ranges overlap, for texts equally long on both sides."""
    of_a = pd.merge_asof(a[["key", "start", "at"]], b[["key", "start", "at"]], on="start", by="key", suffixes=("_a", "_b"))
    later = b[~b["start"].isin(a["start"])]  # where both start, the first direction has found the pair
    of_b = pd.merge_asof(later[["key", "start", "at"]], a[["key", "start", "at"]], on="start", by="key", suffixes=("_b", "_a"))
    both = pd.concat([of_a, of_b[of_a.columns]], ignore_index=True)
    return both.rename(columns={"at_a": "a", "at_b": "b"}).sort_values(["a", "b"], ignore_index=True)[["key", "a", "b"]]


def _joined(parts: pa.Array, sizes: np.ndarray, by: str) -> pa.Array:
    """Consecutive strings, so many for each result, joined."""
    ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, parts), by)


def _numerals(ids: np.ndarray) -> pa.Array:
    return pa.array(ids).cast(pa.string())


@dataclass
class Aligned:
    """A batch of texts, aligned: tokens of both sides, overlaps and groups (one string for each text)."""

    a: pd.DataFrame
    b: pd.DataFrame
    pairs: pd.DataFrame
    n_groups: np.ndarray
    groups: pa.Array


def align(a: pd.DataFrame, b: pd.DataFrame, text_ends: np.ndarray) -> Aligned:
    """Align the tokens of texts that end at the given offsets; both sides of a text cover the same bytes."""
    ends = np.intersect1d(a["end"].to_numpy(), b["end"].to_numpy(), assume_unique=True)
    n_groups = np.diff(np.searchsorted(ends, text_ends, "right"), prepend=0)
    sides = []
    for side in (a, b):
        sizes = np.diff(np.searchsorted(side["end"].to_numpy(), ends, "right"), prepend=0)
        sides.append(_joined(_numerals(side["id"].to_numpy()), sizes, ","))
    groups = _joined(pc.binary_join_element_wise(*sides, "|"), n_groups, ";")
    return Aligned(a, b, overlaps(a, b), n_groups, groups)


class StretchTable:
    """Distinct stretches and their alignments."""

    def __init__(self, byte_model: str, piece_model: str) -> None:
        self.a, self.b = ByteSide(byte_model), PieceSide(piece_model)
        self.sizes = []
        for side in (self.a, self.b):
            size_of = np.zeros(max(side.bytes_of) + 1, dtype=np.int64)
            if len(size_of) > SIDE:
                raise ValueError(f"ids of {SIDE} and more are not provided for")
            for at, data in side.bytes_of.items():
                size_of[at] = len(data)
            self.sizes.append(size_of)
        self.clear()

    def clear(self) -> None:
        self.number = Numbered()
        self.known = 0
        self.chars = 0
        self.good = np.empty(0, dtype=bool)  # whether both sides give the bytes back
        self.numbers = np.empty((0, 3), dtype=np.int64)  # tokens of both sides, groups
        self.groups = pa.array([], pa.string())
        self.pairs = np.empty(0, dtype=np.uint32)  # id pairs of all overlaps, one stretch after the other
        self.starts = np.empty(0, dtype=np.int64)
        self.links = np.empty(0, dtype=np.int64)

    def _learn(self) -> None:
        """Align the stretches that have a number but no entry yet."""
        new = list(itertools.islice(self.number, self.known, None))
        for at in range(0, len(new), NEW_STRETCHES):
            self._add(new[at: at + NEW_STRETCHES])
        self.known += len(new)
        self.chars += sum(map(len, new))

    def _encode(self, new: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of the stretches on both sides, one after the other, how many each has, and whether they give its bytes back.

        Stretches without white space at their ends are encoded many at once, with spaces between them, and told apart by their
        bytes. Where that does not give back what went in, each is encoded for itself.
        """
        data = [b" " + x.encode() for x in new]
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        if not any(x == "" or x[0].isspace() or x[-1].isspace() for x in new):
            texts = [" ".join(new[at: at + JOINED]) for at in range(0, len(new), JOINED)]
            whole, flat, counts = b"".join(data), [], []
            for side, size_of in zip((self.a, self.b), self.sizes, strict=True):
                ids = list(itertools.chain.from_iterable(side.encode(texts)))
                flat.append(np.array(ids, dtype=np.int64))
                ends = np.concatenate(([0], np.cumsum(size_of[flat[-1]])))
                at = np.searchsorted(ends, np.concatenate(([0], np.cumsum(sizes))))
                if b"".join(map(side.bytes_of.__getitem__, ids)) != whole or (ends[at] != np.concatenate(([0], np.cumsum(sizes)))).any():
                    break
                counts.append(np.diff(at))
            else:
                return flat, counts, np.ones(len(new), dtype=bool)
        if len(new) > ALONE:
            halves = [self._encode(part) for part in (new[: len(new) // 2], new[len(new) // 2:])]
            (flat, counts, good), (flat_, counts_, good_) = halves
            both = lambda x, y: [np.concatenate(pair) for pair in zip(x, y, strict=True)]
            return both(flat, flat_), both(counts, counts_), np.concatenate((good, good_))
        found = [side.encode(new) for side in (self.a, self.b)]
        good = np.ones(len(new), dtype=bool)
        for side, ids in zip((self.a, self.b), found, strict=True):
            good &= [b"".join(map(side.bytes_of.__getitem__, own)) == x for own, x in zip(ids, data, strict=True)]
        found = [[own if ok else [] for own, ok in zip(ids, good, strict=True)] for ids in found]
        counts = [np.array(list(map(len, ids)), dtype=np.int64) for ids in found]
        return [np.array(list(itertools.chain.from_iterable(ids)), dtype=np.int64) for ids in found], counts, good

    def _add(self, new: list[str]) -> None:
        flat, counts, good = self._encode(new)
        keys = np.arange(len(new))
        a, b = (tokens(keys, *side) for side in zip(counts, flat, self.sizes, strict=True))
        aligned = align(a, b, np.concatenate(([0], a["end"].to_numpy()))[np.cumsum(counts[0])])
        key, left, right = (aligned.pairs[name].to_numpy() for name in ("key", "a", "b"))
        codes = flat[0][left] * SIDE + flat[1][right]
        links = np.bincount(key, minlength=len(new))
        self.starts = np.concatenate((self.starts, len(self.pairs) + np.cumsum(links) - links))
        self.pairs = np.concatenate((self.pairs, codes.astype(np.uint32)))
        self.links = np.concatenate((self.links, links))
        self.numbers = np.concatenate((self.numbers, np.stack([*counts, aligned.n_groups], axis=1)))
        self.good = np.concatenate((self.good, good))
        self.groups = pa.concat_arrays([self.groups, aligned.groups])

    def align_texts(self, texts: list[str]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links) of each text, its groups, and the distinct id pairs of all texts with their number of
        links; those of text i are at ``edges[i]`` to ``edges[i + 1]``: (numbers, groups, edges, pairs, times)."""
        counts, flat = np.zeros(len(texts), dtype=np.int64), []
        number = self.number
        for at, text in enumerate(texts):
            if text:
                # where white space stands alone and between other characters, every space is a cut
                parts = _CUT.split(text) if _EDGE.search(text) else text.split(" ")
                counts[at] = len(parts)
                flat.append(np.fromiter(map(number.__getitem__, parts), dtype=np.int64, count=len(parts)))
        at = np.concatenate(flat) if flat else np.empty(0, dtype=np.int64)
        self._learn()
        owner = np.repeat(np.arange(len(texts)), counts)
        bad = np.bincount(owner[~self.good[at]], minlength=len(texts)) > 0
        keep = ~bad[owner]
        at, owner = at[keep], owner[keep]
        sums = np.stack([np.bincount(owner, weights=x, minlength=len(texts)) for x in (*self.numbers[at].T, self.links[at])], axis=1).astype(np.int64)
        codes = self.pairs[ragged(self.starts[at], self.links[at])].astype(np.int64)
        held, times = np.unique(np.repeat(owner, self.links[at]) << 32 | codes, return_counts=True)
        edges = np.searchsorted(held >> 32, np.arange(len(texts) + 1))
        held = (held & 0xFFFFFFFF).astype(np.int64)
        groups = _joined(self.groups.take(pa.array(at)), np.bincount(owner, minlength=len(texts)), ";")
        found = sums, groups, edges, held, times
        if self.chars > TABLE_CHARS:
            self.clear()
        return found


def align_documents(
    docs: DataFrame, byte_model: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True,
) -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, groups, groups_sha256, pairs, times`` per row.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3`` (null unless ``keep_groups``, as it is twice as long as the text); ``pairs``
    are the distinct linked id pairs, a * 65,536 + b, and ``times`` how many links each has.
    """
    schema = StructType([
        docs.schema[id_col], *(StructField(name, LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")),
        StructField("groups", StringType()), StructField("groups_sha256", StringType()),
        StructField("pairs", ArrayType(LongType())), StructField("times", ArrayType(IntegerType())),
    ])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = StretchTable(byte_model, piece_model)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for part in slices(sizes, SLICE_BYTES):
                numbers, groups, edges, pairs, times = table.align_texts([x or "" for x in batch.column(1)[part].to_pylist()])
                digests = [hashlib.sha256(x.as_buffer()).hexdigest() if n else "" for x, n in zip(groups, numbers[:, 0], strict=True)]
                ends = pa.array(edges, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], *map(pa.array, numbers.T),
                     groups if keep_groups else pa.nulls(len(groups), pa.string()), pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(ends, pa.array(pairs, pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                    schema.names,
                )

    small_batches()
    return docs.select(id_col, text_col).mapInArrow(aligned, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: how many rows hold an id pair linked, and whether that is the most its first id has with any other."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            pairs, at = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
            return pairs, np.bincount(at, weights=np.concatenate([x[1] for x in parts])).astype(np.int64)

        waiting = 0
        for batch in batches:
            pairs, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            parts.append((pairs, n))
            waiting += len(pairs)
            if waiting > 2_000_000:
                parts = [summed()]
                waiting = 0
                if len(parts[0][0]) > 4_000_000:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, parts[0])), ["pair", "n"])
                    parts = []
        if parts:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, summed())), ["pair", "n"])

    summed = aligned.select("pairs").mapInArrow(held, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stage(summed, "pairs")
    first = F.floor(F.col("pair") / SIDE)
    most = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))  # at most one row for each id of the vocabulary
    return counts.join(F.broadcast(most), first == F.col("first")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, broadcast_pairs: int | None = None) -> DataFrame:
    """The rows of ``align_documents``, staged, with ``n_best`` (links whose count is their first id's highest) and ``count_sum``."""
    staged = stage(aligned.withColumn(fresh(aligned, "row"), F.monotonically_increasing_id()), "aligned")
    row = staged.columns[-1]
    counts = stage(pair_counts(staged), "counts")
    limit = BROADCAST_PAIRS if broadcast_pairs is None else broadcast_pairs
    if counts.count() > limit:
        return _by_join(staged, counts, row)
    table = counts.toArrow()  # at most ``limit`` pairs of ids
    order = np.argsort(table["pair"].to_numpy())
    shared = staged.sparkSession.sparkContext.broadcast(
        (table["pair"].to_numpy()[order].astype(np.uint32), table["n"].to_numpy()[order], table["best"].to_numpy()[order])
    )
    kept = [field for field in staged.schema.fields if field.name != row]
    schema = StructType([*kept, StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False)
            codes = pairs.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
            owner = np.repeat(np.arange(len(batch)), pc.list_value_length(pairs).to_numpy(zero_copy_only=False))
            at = np.searchsorted(known, codes)
            sums = np.zeros((2, len(batch)), dtype=np.int64)
            np.add.at(sums[0], owner, times * best[at])
            np.add.at(sums[1], owner, times * n[at])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, sums)], schema.names)

    return staged.mapInArrow(scored, schema)


def _by_join(staged: DataFrame, counts: DataFrame, row: str) -> DataFrame:
    each = staged.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("held")).select(
        row, F.col("held.pairs").alias("pair"), F.col("held.times").alias("many")
    )
    sums = each.join(counts, "pair").groupBy(row).agg(
        F.sum(F.when(F.col("best"), F.col("many")).otherwise(0)).alias("n_best"), F.sum(F.col("many") * F.col("n")).alias("count_sum")
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
    return staged.join(sums, row, "left").select(*staged.drop(row).columns, zero("n_best"), zero("count_sum"))
