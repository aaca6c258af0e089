"""SimHash near-duplicates, linked by generalised pigeonhole search in Hamming space.

A fingerprint has a bit set where over half of the text's shingle hashes have it. Two distinct fingerprints link at
``distance`` or fewer differing bits. The 64 bits are split into ``PARTS`` groups of 16; bits that vary together go into
the same group. By the generalised pigeonhole principle, a pair within distance t agrees in some group i up to
t_i bits whenever the sum of (t_i + 1) is t + 1; the t_i, which may be -1 (group not searched), are chosen by dynamic programming
on the exact number of pairs per group and distance, taken from the histogram of the group's values.

Every fingerprint is filed under its value in each searched group and probes all values up to t_i bits away; what meets
is verified on all 64 bits. A value that many fingerprints share or probe is dealt over a grid of blocks,
so no task gets an unbounded group, and a task emits only a spanning forest of the links it finds, never all pairs.
Equal fingerprints are one node from the start.

Cases: words are runs of anything but ASCII white space, A-Z lower-cased; shingles count as often as they
occur; a text with fewer words than a shingle has one shingle of all its words, one without words (also a null text) has
fingerprint zero and links like any other. Rows equal in all columns stay. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tabload.llm.common import ragged, slices, small_batches, tidy
from tabload.llm.graph import components, forest
from tabload.session import stage

SEED = 42
PARTS = 4
WIDTH = 64 // PARTS
BLOCK = 1024  # rows of one kind in a grid cell of a frequent value, about
SLICE_BYTES = 1_000_000
SLICE_PAIRS = 2_000_000
ROW_COST = 30.0  # of shuffling a probe, in verified pairs


def fingerprints(texts: list[bytes], words: int) -> np.ndarray:
    """Fingerprints (signed 64 bits) of UTF-8 texts from shingles of so many words."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for at, text in enumerate(texts):
        found = text.lower().split()
        if not found:
            continue
        joined = b" ".join(found)
        n = len(found) - words + 1
        if n <= 1:
            hashes.append(digest(joined, SEED))
            counts[at] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1)
        starts = np.concatenate(([0], ends[: n - 1])).tolist()
        stops = (ends[words - 1:] - 1).tolist()
        hashes += [digest(joined[s:e], SEED) for s, e in zip(starts, stops, strict=True)]
        counts[at] = n
    out = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.cumsum(counts[some]) - counts[some]
        set_in = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        over = (2 * set_in.astype(np.int64) > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out.view(np.int64)


def fingerprint(text: Column, words: int) -> Column:
    small_batches()

    @F.arrow_udf("bigint")
    @tidy
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [x or b"" for x in batch.to_pylist()]
            parts = [fingerprints(texts[part], words) for part in slices([len(x) for x in texts], SLICE_BYTES)]
            yield pa.array(np.concatenate(parts or [np.empty(0, np.int64)]), pa.int64())

    return hashed(text.cast("binary"))


@dataclass
class Layout:
    """Which bits form each group, and how far each group is searched."""

    groups: list[list[int]]
    reach: list[int]
    filed: np.ndarray  # blocks of filed fingerprints, by group and value
    probing: np.ndarray  # blocks of probes, by group and value

    def values(self, prints: np.ndarray, group: int) -> np.ndarray:
        return group_values(prints, self.groups[group])


def group_values(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    unsigned = prints.view(np.uint64)
    out = np.zeros(len(prints), dtype=np.int64)
    for at, bit in enumerate(bits):
        out |= ((unsigned >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << at
    return out


def masks(reach: int) -> np.ndarray:
    """All differences of up to ``reach`` bits of a group's value."""
    every = np.arange(1 << WIDTH)
    return every[np.bitwise_count(every) <= reach]


def correlated_groups(together: np.ndarray, n: int) -> list[list[int]]:
    """Bits in groups of equal size, each next bit the one most correlated with the bits already in the group.

    ``together[i, j]``: how many of the n fingerprints have both bits set.
    """
    share = np.diag(together) / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs((together / n - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = list(range(64)), []
    for _ in range(PARTS):
        first = max(left, key=lambda bit: (related[bit, left].max(), -bit))
        group = [first]
        left.remove(first)
        while len(group) < WIDTH:
            best = max(left, key=lambda bit: (related[bit, group].mean(), -bit))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def pairs_within(histogram: np.ndarray) -> np.ndarray:
    """Ordered pairs of members whose values differ in up to 0, 1, 2, ... bits, from the number of members per value."""
    held = histogram.astype(np.float64)
    for back in (False, True):  # the Walsh-Hadamard transform, squared, and back: a correlation over exclusive or
        step = 1
        while step < len(held):
            view = held.reshape(-1, 2, step)
            held = np.stack((view[:, 0] + view[:, 1], view[:, 0] - view[:, 1]), axis=1).reshape(-1)
            step *= 2
        held = held / len(held) if back else held * held
    bits = np.bitwise_count(np.arange(len(held)))
    return np.cumsum([held[bits == distance].sum() for distance in range(WIDTH + 1)])


def allocate(pairs: list[np.ndarray], n: int, distance: int) -> list[int]:
    """How far to search each group: least probes and pairs with the sum of (reach + 1) equal to distance + 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in pairs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for reach in range(-1, distance - used + 1):
                probes = sum(comb(WIDTH, bits) for bits in range(reach + 1))
                more = cost + (ROW_COST * n * (1 + probes) + group[reach] if reach >= 0 else 0.0)
                if (at := used + reach + 1) not in grown or more < grown[at][0]:
                    grown[at] = (more, [*chosen, reach])
        best = grown
    return best[distance + 1][1]


def plan_search(prints: DataFrame, distance: int) -> Layout | None:
    """Count over all fingerprints (column ``fp``), then choose groups and reaches.

    Driver state: 64 x 64 counts, then one count per group and value (at most 4 x 65,536).
    """
    @tidy
    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros((64, 64)), 0
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            bits = np.unpackbits(own.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            held += bits.T @ bits
            n += len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(64 * 64 + 1), pa.int32()), pa.array(np.append(held.reshape(-1), n).astype(np.int64))], ["at", "n"]
        )

    counted = prints.mapInArrow(together, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(64 * 64 + 1)
    flat[counted["at"].to_numpy()] = counted["n"].to_numpy()
    n = int(flat[-1])
    if n == 0:
        return None
    groups = correlated_groups(flat[:-1].reshape(64, 64), n)

    @tidy
    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(PARTS << WIDTH, dtype=np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for group, bits in enumerate(groups):
                held += np.bincount(group_values(own, bits) + (group << WIDTH), minlength=len(held))
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(held[used], pa.int64())], ["at", "n"])

    found = prints.mapInArrow(histogram, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    members = np.zeros(PARTS << WIDTH, dtype=np.int64)
    members[found["at"].to_numpy()] = found["n"].to_numpy()
    members = members.reshape(PARTS, 1 << WIDTH)
    reach = allocate([pairs_within(row) for row in members], n, distance)
    probes = np.zeros_like(members)
    every = np.arange(1 << WIDTH)
    for group, bits in enumerate(reach):
        if bits >= 0:
            probes[group] = sum(members[group][every ^ mask] for mask in masks(bits).tolist())
    return Layout(groups, reach, np.maximum(1, -(-members // BLOCK)), np.maximum(1, -(-probes // BLOCK)))


def _spread(prints: np.ndarray, blocks: np.ndarray, salt: int) -> np.ndarray:
    """The block of each fingerprint among so many."""
    mixed = (prints.view(np.uint64) ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)).astype(np.int64)) % blocks


def _rows(prints: np.ndarray, layout: Layout, far: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Grid cells with the fingerprints that are filed in them (False) or probe them (True)."""
    for group, bits in enumerate(layout.reach):
        if bits < 0:
            continue
        value = layout.values(prints, group)
        for mask in [None, *far[group].tolist()]:
            probing = mask is not None
            at = value ^ mask if probing else value
            down, across = layout.filed[group][at], layout.probing[group][at]
            copies = down if probing else across  # a filed row goes to every column of its block, a probe to every row
            which = np.repeat(np.arange(len(prints)), copies)
            other = ragged(np.zeros(len(prints), dtype=np.int64), copies)
            mine = (_spread(prints, across, 0xA5) if probing else _spread(prints, down, 0x3C))[which]
            row, column = (other, mine) if probing else (mine, other)
            yield ((group << WIDTH) + at[which] << 40) + (row << 20) + column, prints[which], probing


def _links(cells: np.ndarray, prints: np.ndarray, probing: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in complete cells, whose rows stand together, filed ones first."""
    starts = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1))
    sizes = np.diff(np.append(starts, len(cells)))
    filed = np.add.reduceat(~probing, starts, dtype=np.int64)
    probes = sizes - filed
    busy = (filed > 0) & (probes > 0)
    starts, filed, probes = starts[busy], filed[busy], probes[busy]
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part in slices((filed * probes).tolist(), SLICE_PAIRS):
        each = filed[part]
        own = ragged(starts[part], each)
        across = np.repeat(probes[part], each)
        a = prints[np.repeat(own, across)]
        b = prints[ragged(np.repeat(starts[part] + each, each), across)]
        near = (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= distance) & (b < a)
        if near.any():
            x, y = forest(a[near], b[near])
            left.append(x)
            right.append(y)
    return np.concatenate(left), np.concatenate(right)


def link_edges(prints: DataFrame, distance: int) -> DataFrame | None:
    """Edges ``a, b`` that connect the distinct fingerprints (column ``fp``) as all links within ``distance`` do."""
    layout = plan_search(prints, distance)
    if layout is None:
        return None
    shared = prints.sparkSession.sparkContext.broadcast(layout)  # 4 x 65,536 block counts, whatever the input

    @tidy
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        far = [masks(bits) if bits >= 0 else np.empty(0, np.int64) for bits in plan.reach]
        for batch in batches:
            for cell, own, probing in _rows(batch.column(0).to_numpy(zero_copy_only=False).copy(), plan, far):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(np.full(len(cell), probing)), pa.array(own)], ["cell", "probing", "fp"]
                )

    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)]
        for batch in _with_end(batches):
            if batch is not None:
                new = [batch.column(at).to_numpy(zero_copy_only=False) for at in range(3)]
                held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            cells = held[0]
            if not len(cells):
                continue
            done = len(cells) if batch is None else int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
            if done:
                a, b = _links(cells[:done], held[2][:done], held[1][:done], distance)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            held = [x[done:] for x in held]

    rows = prints.mapInArrow(expand, "cell bigint, probing boolean, fp bigint")
    return rows.repartition("cell").sortWithinPartitions("cell", "probing").mapInArrow(verify, "a bigint, b bigint")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, distance: int = 4,
) -> DataFrame:
    """``id, fp, component_id`` per row: the fingerprint, and the smallest id reachable over links."""
    hashed = stage(
        docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")), "simhash"
    )
    first = hashed.groupBy("fp").agg(F.min("id").alias("first"))
    edges = link_edges(hashed.select("fp").distinct(), distance)
    if edges is None:
        return hashed.withColumn("component_id", F.col("id"))
    roots = stage(components(edges), "roots")
    grouped = first.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    known = grouped.join(smallest, "root").select("fp", "component_id")
    return hashed.join(known, "fp").select("id", "fp", "component_id")
