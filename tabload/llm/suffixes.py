"""Suffix-array deduplication: bytes that a document with a smaller id already has are removed.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id, that is, where the longest
previous factor of a suffix reaches LENGTH. Suffixes with such a factor share LENGTH bytes, so only those that may do so are
brought together and ordered, not those of all documents at once:

1. The windows of LENGTH bytes of a text fall into runs that hold the same smallest hash of ``ANCHOR`` bytes (about one
   run per 16 bytes). Equal windows have equal anchors. A task keeps the first of the equal runs it sees and marks later
   ones as copies, so a passage in a third of all documents leaves a task once; runs are sent by anchor as hashes only.
2. Where runs meet, all but the first of equal ones are copies. A run whose anchor is nowhere else has no match.
   Different runs with one anchor (the edges of shared passages) are the only places left to look at.
3. The texts of those runs are sent by anchor. The suffixes of a group are sorted; the previous and the next smaller position, by
   document, of each suffix and the least common prefix on the way to them give its longest previous factor, as far as LENGTH.
   An anchor whose runs hold very many windows sends them one by one, each to the place of its own hash, of equal ones of a slice only
   the first, so no group is larger than ``CROWDED`` suffixes of different texts.

Hashes decide in step 2 (64 bits of the anchor and 64 of the run); bytes decide in step 3. Step 1 and 2 read the texts once
and write a few numbers per match; step 3 reads the matching texts again.

Cases: a null text counts as empty; matches never cross documents; a document is not compared with itself. Rows without an
id are neither trimmed nor count as earlier. The id names the document: rows repeated with one id and text get the same result. Texts of
any length are treated whole, as UTF-8 bytes. Other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabload.llm.common import bounded, fresh, ragged, slices, small_batches, tidy
from tabload.session import stage

LENGTH = 50
ANCHOR = 20
CROWDED = 50_000  # windows in the runs of one anchor beyond which they are sent one by one
CHUNK_BYTES = 250_000  # bytes hashed at once
KEPT_RUNS = 150_000  # runs a task gathers before it drops repeats and sends the rest
SORTED_WINDOWS = 100_000  # suffixes sorted at once; a group is never cut

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any stretch of a byte buffer, from sums of prefixes modulo 2^64."""

    byte_values = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    powers = np.ones(1, dtype=np.uint64)
    inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(Rolling.powers) < n:
            steps = np.full(n, _BASE), np.full(n, _INVERSE)
            for x in steps:
                x[0] = 1
            Rolling.powers, Rolling.inverses = (np.cumprod(x, dtype=np.uint64) for x in steps)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(Rolling.byte_values[data] * Rolling.powers[: n - 1], out=self.sums[1:])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:n]) * Rolling.inverses[:n])

    def stretches(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        own = (self.sums[stops] - self.sums[starts]) * Rolling.inverses[starts]
        return _mix(own + (stops - starts).astype(np.uint64) * np.uint64(0x8BB84B93962EACC9))


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (size - span)], x[size - span:]) if span < size else x


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, one row after the other, and where each row starts (and the last one stops)."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset: column.offset + len(column) + 1]
    held = column.buffers()[2]
    return np.frombuffer(held, dtype=np.uint8) if held is not None and held.size else np.empty(0, np.uint8), offsets.astype(np.int64)


def runs(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, in the documents ``edges[i]:edges[i + 1]`` of a buffer.

    Returns anchor hash, run hash, number of the document, start in the document and bytes of each run.
    """
    sizes = np.diff(edges)
    counts = np.maximum(sizes - LENGTH + 1, 0)
    if not counts.any():
        return tuple(np.empty(0, np.int64) for _ in range(5))
    rolling = Rolling(data[edges[0]: edges[-1]])
    low = _sliding_min(rolling.windows(ANCHOR), LENGTH - ANCHOR + 1)
    at = ragged(edges[:-1] - edges[0], counts)
    owner = np.repeat(np.arange(len(sizes)), counts)
    anchor = low[at]
    heads = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))))
    length = np.diff(np.append(heads, len(at))) + LENGTH - 1
    first, doc = at[heads], owner[heads]
    whole = rolling.stretches(first, first + length)
    return anchor[heads].view(np.int64), whole.view(np.int64), doc, first - (edges[:-1] - edges[0])[doc], length


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination starts in sorted keys."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _spans(ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of the stretches of each document."""
    order = np.lexsort((starts, ids))
    ids, starts, stops = ids[order], starts[order], stops[order]
    if not len(ids):
        return ids, starts, stops
    group = np.cumsum(np.concatenate(([0], ids[1:] != ids[:-1])))
    lift = group * (int(stops.max()) + 1)  # documents one after the other, so one running maximum serves all
    reach = np.maximum.accumulate(stops + lift)
    new = np.concatenate(([True], (starts + lift)[1:] > reach[:-1]))
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(ids)) - 1
    return ids[heads], starts[heads], reach[last] - lift[heads]


RUN_SCHEMA = "anchor bigint, run bigint, id bigint, start int, n int, copy boolean"


def _batch(anchor, run, ids, start, n, copy) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()), pa.array(run, pa.int64()), pa.array(ids, pa.int64()),
         pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(copy, pa.bool_())],
        ["anchor", "run", "id", "start", "n", "copy"],
    )


def _copies(ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
    """Stretches known to be copies; they travel by document, not by the anchor many documents share."""
    ids, starts, stops = _spans(ids, starts, stops)
    where = _mix(ids.view(np.uint64)).view(np.int64)
    return _batch(where, where, ids, starts, stops - starts, np.ones(len(ids), bool))


def _first_of_equal(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """What a task sends of the runs it gathered: the earliest of equal ones, and the others as copies."""
    anchor, run, ids, start, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((start, ids, run, anchor))
    anchor, run, ids, start, n = (x[order] for x in (anchor, run, ids, start, n))
    heads = _heads(anchor, run)
    first = np.repeat(ids[heads], np.diff(np.append(heads, len(ids))))
    copy = ids > first
    yield _copies(ids[copy], start[copy], start[copy] + n[copy])
    keep = ~copy
    yield _batch(anchor[keep], run[keep], ids[keep], start[keep], n[keep], np.zeros(int(keep.sum()), bool))


@tidy
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to runs."""
    parts, held = [], 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, edges = _buffer(batch.column(1))
        for part in slices(np.diff(edges).tolist(), CHUNK_BYTES):
            anchor, run, doc, start, n = runs(data, edges[part.start: part.stop + 1])
            parts.append((anchor, run, ids[part.start + doc], start, n))
            held += len(anchor)
            if held >= KEPT_RUNS:
                yield from _first_of_equal(parts)
                parts, held = [], 0
    if held:
        yield from _first_of_equal(parts)


@tidy
def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by anchor, run and id: copies, and runs to be looked at (copy is false).

    What is kept from batch to batch of an unfinished anchor is the first runs with its one hash or, once it has
    several, one stand-in for the first hash and one for the last, whatever the number of its rows.
    """
    held = [np.empty(0, np.int64)] * 5 + [np.empty(0, bool)] * 2  # anchor, run, id, start, n, copy, stand-in
    for batch in batches:
        new = [batch.column(at).to_numpy(zero_copy_only=False) for at in range(6)]
        rows = [np.concatenate(x) for x in zip(held, [*new, np.zeros(len(new[0]), bool)], strict=True)]
        out, held = _met(rows, last=False)
        yield out
    out, _ = _met(held, last=True)
    yield out


def _met(rows: list[np.ndarray], last: bool) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    anchor, run, ids, start, n, known, stand_in = rows
    if not len(anchor):
        return _batch(anchor, run, ids, start, n, known), rows
    heads = _heads(anchor, run)
    first = np.repeat(ids[heads], np.diff(np.append(heads, len(ids))))
    copy = known | (ids > first)
    tops = _heads(anchor)
    sizes = np.diff(np.append(tops, len(ids)))
    kinds = np.diff(np.append(np.searchsorted(heads, tops), len(heads)))
    apart = np.maximum.reduceat(ids, tops) > np.minimum.reduceat(ids, tops)
    several = (kinds > 1) & (apart | np.logical_or.reduceat(stand_in, tops))
    send = (copy | np.repeat(several, sizes)) & ~stand_in
    keep = np.zeros(len(ids), bool)
    if not last:
        tail = tops[-1]
        if kinds[-1] > 1:
            send[tail:] = ~stand_in[tail:]  # whether another document follows is not known yet
            marks = [tail, heads[-1]]
            held = [x[marks] for x in rows[:6]] + [np.ones(2, bool)]
        else:
            keep[tail:] = ~copy[tail:]
            held = [x[keep] for x in rows]
            send[tail:] = copy[tail:] & ~stand_in[tail:]
    else:
        held = [x[:0] for x in rows]
    return _batch(anchor[send], run[send], ids[send], start[send], n[send], copy[send]), held


PIECE_SCHEMA = "place bigint, piece binary, id bigint, start array<int>, n int"


def _pieces(place, pieces, ids, counts, starts, n) -> pa.RecordBatch:
    """Pieces of ``n`` bytes at so many starts each; a piece that is null stands for a stretch known to be a copy."""
    ends = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(place, pa.int64()), pieces, pa.array(ids, pa.int64()),
         pa.ListArray.from_arrays(ends, pa.array(starts, pa.int32())), pa.array(n, pa.int32())],
        ["place", "piece", "id", "start", "n"],
    )


def _windows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The LENGTH bytes from each place on, as one comparable value each."""
    rows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[at]
    return np.ascontiguousarray(rows).view(f"V{LENGTH}").reshape(-1)


def _one_by_one(data: np.ndarray, at: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows at places of a buffer, sent by their hash: of equal ones those of the smallest document, once; the others are copies."""
    low = int(at.min())
    rolled = Rolling(data[low: int(at.max()) + LENGTH]).windows(LENGTH)[at - low]
    order = np.lexsort((starts, ids, rolled))
    at, ids, starts, rolled = at[order], ids[order], starts[order], rolled[order]
    own = _windows(data, at)
    heads = _heads(rolled)
    sizes = np.diff(np.append(heads, len(at)))
    same = own == np.repeat(own[heads], sizes)  # windows that only share a hash with the first are sent, each for itself
    copy = same & (ids > np.repeat(ids[heads], sizes))
    docs, first, last = _spans(ids[copy], starts[copy], starts[copy] + LENGTH)
    where = _mix(docs.view(np.uint64)).view(np.int64)
    yield _pieces(where, pa.nulls(len(docs), pa.binary()), docs, np.ones(len(docs), np.int64), first, last - first)
    kept = np.flatnonzero(~copy)
    tops = np.flatnonzero(~same[kept] | np.isin(np.arange(len(kept)), _heads(rolled[kept], ids[kept])))
    row = kept[tops]
    pieces = pa.array([x.tobytes() for x in own[row]], pa.binary())
    yield _pieces(rolled[row].view(np.int64), pieces, ids[row], np.diff(np.append(tops, len(kept))), starts[kept], np.full(len(row), LENGTH))


@tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, runs to be looked at) to the bytes of those runs; crowded anchors send their windows one by one."""
    for batch in batches:
        data, edges = _buffer(batch.column(1))
        wanted = batch.column(2)
        ends = wanted.offsets.to_numpy().astype(np.int64)
        some = slice(ends[0], ends[-1])
        anchor, start, n = (wanted.values.field(name).to_numpy(zero_copy_only=False)[some].astype(np.int64) for name in ("anchor", "start", "n"))
        crowded = wanted.values.field("crowded").to_numpy(zero_copy_only=False)[some]
        owner = np.repeat(np.arange(len(batch)), np.diff(ends))
        ids = batch.column(0).to_numpy(zero_copy_only=False)[owner]
        at = edges[owner] + start
        whole = np.flatnonzero(~crowded)
        for part in slices(n[whole].tolist(), CHUNK_BYTES):
            own = whole[part]
            pieces = pa.array([data[a: a + size].tobytes() for a, size in zip(at[own].tolist(), n[own].tolist(), strict=True)], pa.binary())
            yield _pieces(anchor[own], pieces, ids[own], np.ones(len(own), np.int64), start[own], n[own])
        single = np.flatnonzero(crowded)
        first = ragged(np.zeros(len(single), np.int64), n[single] - LENGTH + 1)
        row = np.repeat(single, n[single] - LENGTH + 1)
        for low in range(0, len(row), SORTED_WINDOWS):
            own, shift = row[low: low + SORTED_WINDOWS], first[low: low + SORTED_WINDOWS]
            yield from _one_by_one(data, at[own] + shift, ids[own], start[own] + shift)


def _previous_smaller(doc: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """In suffix order: the common prefix of each suffix with the nearest one before it from a smaller document.

    ``shared[i]`` is the common prefix of the suffixes i - 1 and i. Only whether LENGTH is reached is told: a search stops below it.
    """
    before = np.arange(-1, len(doc) - 1)
    reach = shared.copy()
    while True:
        going = np.flatnonzero((before >= 0) & (reach >= LENGTH))
        going = going[doc[before[going]] >= doc[going]]
        if not len(going):
            return np.where(before >= 0, reach, 0)
        # what lies between a suffix and its pointer is not smaller, so the pointer of the pointer may follow
        at = before[going]
        reach[going] = np.minimum(reach[going], np.where(before[at] >= 0, reach[at], 0))
        before[going] = before[at]


def _later_windows(group: np.ndarray, pieces: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes with a longest previous factor of LENGTH bytes or more in their group: number of the piece and place in it.

    The suffixes are in the order of their group and first LENGTH bytes; the common prefixes of neighbours and the previous
    and next smaller positions give the factors.
    """
    data, edges = _buffer(pieces)
    counts = np.maximum(np.diff(edges) - LENGTH + 1, 0)
    at = ragged(edges[:-1], counts)
    owner = np.repeat(np.arange(len(ids)), counts)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    suffix = np.empty((len(at), LENGTH + 4), dtype=np.uint8)
    suffix[:, :4] = group[owner].astype(">u4").view(np.uint8).reshape(-1, 4)
    suffix[:, 4:] = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[at]
    order = np.argsort(suffix.view(f"S{LENGTH + 4}").reshape(-1), kind="stable")
    suffix = suffix[order]
    differ = suffix[1:] != suffix[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1) - 4, LENGTH)
    shared = np.concatenate(([0], np.maximum(shared, 0)))
    doc = ids[owner][order]
    after = _previous_smaller(doc[::-1], np.concatenate(([0], shared[:0:-1])))[::-1]
    where = order[np.maximum(_previous_smaller(doc, shared), after) >= LENGTH]
    return owner[where], at[where] - edges[owner[where]]


def _judged(rows: pa.Table) -> pa.RecordBatch:
    """The stretches of whole groups of pieces, sorted by place and id, that are later copies."""
    rows = rows.combine_chunks()
    place, ids, n = (rows[name].to_numpy().astype(np.int64) for name in ("place", "id", "n"))
    lists = rows["start"].combine_chunks() if rows["start"].num_chunks != 1 else rows["start"].chunk(0)
    starts, ends = lists.values.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
    copy = rows["piece"].is_null().to_numpy()
    first = starts[ends[:-1][copy]]
    out = [(ids[copy], first, first + n[copy])]
    which = np.flatnonzero(~copy)
    if len(which):
        pieces = rows["piece"].combine_chunks().take(pa.array(which))
        sizes = n[which] - LENGTH + 1
        tops = _heads(place[which])
        totals = np.add.reduceat(sizes, tops)
        stops = np.append(tops[1:], len(which))
        number = np.repeat(np.arange(len(tops)), stops - tops)
        for part in slices(totals.tolist(), SORTED_WINDOWS):
            some = slice(tops[part.start], stops[part.stop - 1])
            row, shift = _later_windows(number[some], pieces[some], ids[which[some]])
            row = which[some][row]
            counts = ends[row + 1] - ends[row]
            at = starts[ragged(ends[row], counts)] + np.repeat(shift, counts)
            out.append(_spans(np.repeat(ids[row], counts), at, at + LENGTH))
    docs, start, stop = _spans(*(np.concatenate(x) for x in zip(*out, strict=True)))
    return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], ["id", "start", "stop"])


def _first_pieces(rows: pa.Table) -> pa.Table:
    """Of rows of one place, sorted by id, the first with each piece."""
    rows = rows.filter(rows["piece"].is_valid())
    seen: dict[bytes, int] = {}
    for at, piece in enumerate(rows["piece"].to_pylist()):
        seen.setdefault(piece, at)
    return rows.take(pa.array(list(seen.values()), pa.int64()))


@tidy
def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by place and id to the stretches of their documents that are later copies.

    A group that may go on waits for its end. If it is a window sent for itself by very many slices it is judged as far as it
    has come, and only the first piece waits: what follows is from no smaller document.
    """
    held: pa.Table | None = None
    for batch in batches:
        new = pa.Table.from_batches([pa.RecordBatch.from_arrays(batch.columns, ["place", "piece", "id", "start", "n"])])
        rows = new if held is None else pa.concat_tables([held, new])
        place = rows["place"].to_numpy()
        done = int(np.searchsorted(place, place[-1])) if len(place) else 0
        if done:
            yield _judged(rows.slice(0, done))
        held = rows.slice(done)
        if held.num_rows > SORTED_WINDOWS // 10 and (held["n"].to_numpy() == LENGTH).all():
            yield _judged(held)
            held = _first_pieces(held)
    if held is not None and held.num_rows:
        yield _judged(held)


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, start, stop``: stretches of bytes that an earlier document has; they may overlap. Runs two jobs."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")).filter(
        F.col("id").isNotNull() & (F.octet_length("text") >= LENGTH)
    )
    small_batches()
    scanned = texts.mapInArrow(_scan, RUN_SCHEMA)
    met = scanned.repartition("anchor").sortWithinPartitions("anchor", "run", "id").mapInArrow(_meet, RUN_SCHEMA)
    met = stage(met, "runs")
    open_runs = met.filter(~F.col("copy"))
    # anchors with very many windows: at most one for each CROWDED windows of the open runs
    windows = F.sum(F.col("n") - LENGTH + 1)
    crowded = stage(open_runs.groupBy("anchor").agg(windows.alias("windows")).filter(F.col("windows") > CROWDED).select(F.col("anchor").alias("of")), "crowded")
    wanted = (
        open_runs.join(bounded(crowded, crowded.count()), F.col("anchor") == F.col("of"), "left")
        .groupBy("id")
        .agg(F.collect_list(F.struct("anchor", "start", "n", F.col("of").isNotNull().alias("crowded"))).alias("wanted"))
    )
    pieces = texts.join(wanted, "id").select("id", "text", "wanted").mapInArrow(_cut, PIECE_SCHEMA)
    sorted_pieces = pieces.repartition("place").sortWithinPartitions("place", "id")
    edges = stage(sorted_pieces.mapInArrow(_sort_suffixes, "id bigint, start int, stop int"), "edges")
    whole = met.filter("copy").select("id", "start", (F.col("start") + F.col("n")).alias("stop"))
    return whole.unionByName(edges)


def _without(texts: pa.Array, stretches: pa.Array, characters: bool) -> tuple[list[bytes | None], np.ndarray, np.ndarray, np.ndarray]:
    """What is kept of each text, and the united stretches: how many each text has, their starts and stops.

    With ``characters`` a stretch shrinks to the characters that lie in it whole. Null texts stay null.
    """
    offsets = stretches.offsets.to_numpy()
    flat = stretches.values
    starts, stops = (flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("start", "stop"))
    used = slice(offsets[0], offsets[-1])
    owner, starts, stops = _spans(np.repeat(np.arange(len(texts)), np.diff(offsets)), starts[used], stops[used])
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    kept: list[bytes | None] = []
    for doc, scalar in enumerate(texts):
        text = scalar.as_py()
        if text is None:
            kept.append(None)
            continue
        pieces, at = [], 0
        for start, stop in zip(starts[edges[doc]: edges[doc + 1]].tolist(), stops[edges[doc]: edges[doc + 1]].tolist(), strict=True):
            if characters:
                while start < stop and text[start] & 0xC0 == 0x80:
                    start += 1
                while start < stop < len(text) and text[stop] & 0xC0 == 0x80:
                    stop -= 1
            pieces.append(text[at:start])
            at = stop
        kept.append(b"".join([*pieces, text[at:]]))
    return kept, np.diff(edges), starts, stops


def _with_stretches(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with the list of its stretches (null: none), and the name of that column."""
    found = later_copies(docs, id_col, text_col)
    per_doc = found.groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    key, stretches = fresh(docs, "copy_of"), fresh(docs, "stretches")
    return docs.join(per_doc.toDF(key, stretches), F.col(id_col) == F.col(key), "left").drop(key), stretches


def remove_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str = "spans", kept_col: str = "kept",
) -> DataFrame:
    """``docs`` with the maximal removed stretches of bytes and the other bytes, in order.

    The two result columns take the place of columns of their names.
    """
    found, stretches = _with_stretches(docs, id_col, text_col)
    result = fresh(found, "result")

    @F.arrow_udf("struct<spans:array<struct<start:int,stop:int>>,kept:binary>")
    def cut(text: pa.Array, stretches: pa.Array) -> pa.Array:
        kept, counts, starts, stops = _without(text, stretches, characters=False)
        span = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], ["start", "stop"])
        ends = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, span), pa.array(kept, pa.binary())], ["spans", "kept"])

    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    touched = F.when(F.col(stretches).isNotNull(), text)  # a text without copies stays in the JVM
    return (
        found.withColumn(result, cut(touched, F.col(stretches)))
        .withColumns({
            spans_col: F.coalesce(F.col(f"{result}.spans"), F.expr("cast(array() as array<struct<start:int,stop:int>>)")),
            kept_col: F.coalesce(F.col(f"{result}.kept"), text),
        })
        .drop(stretches, result)
    )


def trim_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later copies cut out of their texts, in whole characters.

    A character goes if all its bytes go. Texts of which nothing is left go with their rows; a text that was empty or null stays.
    """
    found, stretches = _with_stretches(docs, id_col, text_col)

    @F.arrow_udf("string")
    @tidy
    def whole(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, stretches in batches:
            kept, *_ = _without(text, stretches, characters=True)
            yield pa.array([x if x is None else x.decode("utf-8", "replace") for x in kept], pa.string())

    touched = F.col(stretches).isNotNull()
    cut = whole(F.when(touched, F.col(text_col).cast("binary")), F.col(stretches))
    kept = F.when(touched, cut).otherwise(F.col(text_col))
    return (
        found.withColumn(text_col, kept)
        .filter(F.col(stretches).isNull() | (F.length(text_col) > 0))
        .drop(stretches)
    )
