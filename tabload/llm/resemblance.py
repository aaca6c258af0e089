"""Near-duplicate texts by the similarity (Jaccard) of their word shingles: SimHash and MinHash propose, exact sets decide.

A text's set of shingle hashes gives a SimHash fingerprint and ``BANDS`` MinHash keys of ``ROWS`` minima each. Fingerprints are linked at
``DISTANCE`` or fewer differing bits by the pigeonhole search of ``simhash``, and texts connected by that have a key in common. Fingerprints
of texts at a similarity of 0.8 differ in more bits, as a rule, than such a search reaches, so the MinHash keys stand beside them: a pair at
0.8 has one of those in common with probability 1 - (1 - 0.8^4)^20 = 0.99997, nearer ones with more. No pair is linked but by its exact sets.
First every text is compared with the smallest text of each of its keys, which is linear however many share a key.
Keys whose texts are not connected by that are compared pair by pair, crowded ones dealt over a grid of blocks.
Tasks emit spanning forests of their links. Equal sets are one node from the start.

Cases: words are runs of anything but ASCII white space, A-Z lower-cased; a text with fewer words than a shingle has one shingle
of all its words; texts without words (also null) are equal to each other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tabload.llm import simhash
from tabload.llm.common import small_batches, tidy
from tabload.llm.graph import components, forest
from tabload.session import stage

WORDS = 5
LEAST = 0.8
DISTANCE = 4  # differing bits of two fingerprints
BANDS = 20
ROWS = 4
BLOCK = 512  # texts of a key in one block of its grid, about
COLUMNS = 4096  # shingles compared in one piece
SEED = 42
_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text."""
    found = text.lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(b" ".join(found[at: at + words]), SEED) for at in range(max(1, len(found) - words + 1))]
    return np.unique(np.array(hashes, dtype=np.uint64))


def fingerprint(own: np.ndarray) -> int | None:
    """The SimHash of a set of shingle hashes (signed 64 bits): the bits that over half of them have; none of an empty set."""
    if not len(own):
        return None
    set_in = np.zeros(64, dtype=np.int64)
    for start in range(0, len(own), COLUMNS):
        part = np.ascontiguousarray(own[start: start + COLUMNS], dtype="<u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(own), bitorder="little").view("<i8")[0])


def bands(own: np.ndarray) -> list[int]:
    """The keys of a set of shingle hashes, one per band; none of an empty set."""
    if not len(own):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(own), COLUMNS):
        mixed = own[start: start + COLUMNS, None] * _FACTORS + _OFFSETS
        least = np.minimum(least, mixed.min(axis=0))
    rows = least.reshape(BANDS, ROWS)
    return [int(np.int64(np.uint64(xxhash.xxh64_intdigest(row.tobytes(), at)).view(np.int64))) for at, row in enumerate(rows)]


@tidy
def _sketch(batches: Iterator[pa.RecordBatch], words: int, kept: bool) -> Iterator[pa.RecordBatch]:
    """(id, text) to id, node, fingerprint and bands, or to node and set if the sets are kept."""
    for batch in batches:
        for start in range(0, len(batch), 256):
            part = batch.slice(start, 256)
            sets = [shingles(x or b"", words) for x in part.column(1).to_pylist()]
            nodes = pa.array([int(np.uint64(xxhash.xxh64_intdigest(x.tobytes(), SEED)).view(np.int64)) for x in sets], pa.int64())
            if kept:
                yield pa.RecordBatch.from_arrays([nodes, pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "own"])
            else:
                prints = pa.array([fingerprint(x) for x in sets], pa.int64())
                keys = pa.array([bands(x) for x in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), nodes, prints, keys], ["id", "node", "fp", "bands"])


@tidy
def _alike(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(a, b, own, other): the pairs whose sets are alike."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(common >= least * (len(x) + len(y) - common))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _cell(nodes: np.ndarray, down: np.ndarray, across: np.ndarray, sets: list[bytes], least: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one cell of a grid."""
    each = [np.frombuffer(x, np.uint64) for x in sets]
    size = np.array([len(x) for x in each])
    values, at, times = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(each)), size)
    shared = times[at] > 1
    place = (np.cumsum(times > 1) - 1)[at[shared]]
    owner = owner[shared]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    common = np.zeros((len(each), len(each)), dtype=np.float32)
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        a, b = np.searchsorted(place, (start, start + COLUMNS))
        has = np.zeros((len(each), COLUMNS), dtype=np.float32)
        has[owner[a:b], place[a:b] - start] = 1
        common += has @ has.T
    meet = np.triu(np.ones_like(common, dtype=bool), 1)
    if down[0] != across[0] or (down != across).any():
        meet &= down[:, None] != down[None, :]  # two blocks: pairs inside one are another cell's
    x, y = np.nonzero(meet & (common >= least * (size[:, None] + size[None, :] - common)))
    return forest(nodes[x], nodes[y])


def candidate_keys(found: DataFrame) -> DataFrame:
    """``node, band``: the keys of each node, its bands and one for what its fingerprint is connected with."""
    nodes = found.filter("fp is not null").select("node", "fp", "bands").dropDuplicates(["node"])
    keyed = nodes.select("node", F.explode("bands").alias("band"))
    prints = nodes.select("fp").distinct()
    edges = simhash.link_edges(prints, DISTANCE)
    if edges is None:
        return keyed
    roots = stage(components(edges), "prints").toDF("of", "root")
    near = nodes.join(roots, F.col("fp") == F.col("of"), "left").select(
        "node", F.xxhash64(F.lit("fingerprint"), F.coalesce("root", "fp")).alias("band")
    )
    return keyed.unionByName(near)


def link_edges(rows: DataFrame, found: DataFrame, words: int, least: float) -> DataFrame:
    """Edges ``a, b`` that connect the nodes of ``found`` as all links between texts with a common key do.

    Sets are made again from ``rows``, for texts with a common key only, so those of most texts never leave their task.
    """
    keyed = stage(candidate_keys(found), "keys")
    heads = keyed.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = stage(keyed.join(heads, "band"), "met")
    wanted = (
        found.join(met.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("id").alias("first"))
        .select("first").distinct()
    )
    texts = rows.join(wanted, F.col("id").eqNullSafe(F.col("first")), "left_semi")
    sets = stage(texts.mapInArrow(lambda batches: _sketch(batches, words, True), "node bigint, own binary").dropDuplicates(["node"]), "sets")
    # the head of a crowded key is joined in as many copies as its texts need blocks
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    pairs = met.filter("node <> head").groupBy(F.col("head").alias("a"), F.col("node").alias("b")).agg(F.max("n").alias("n"))
    copies = pairs.groupBy("a").agg(F.max("n").alias("n")).select("a", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("salt"))
    stars = (
        pairs.withColumn("salt", F.pmod(F.xxhash64("b"), blocks).cast("int"))
        .join(copies.join(sets.toDF("a", "own"), "a"), ["a", "salt"])
        .join(sets.toDF("b", "other"), "b").select("a", "b", "own", "other")
    )
    near = stage(stars.mapInArrow(lambda batches: _alike(batches, least), "a bigint, b bigint"), "stars")
    roots = components(near)
    rooted = met.join(roots.toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("band")
    dealt = (
        met.join(apart, "band", "left_semi").withColumn("blocks", F.when(F.col("n") > 2 * BLOCK, blocks).otherwise(1))
        .withColumn("down", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("across", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", F.least("down", "across").alias("low"), F.greatest("down", "across").alias("high"), "down", "across", "node")
        .join(sets, "node").select("band", "low", "high", "down", "across", "node", "own")
    )

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(rows: pa.Table) -> pa.RecordBatch:
            key, down, across, node = (rows.column(at).to_numpy() for at in (0, 3, 4, 5))
            low, high, own = rows.column(1).to_numpy(), rows.column(2).to_numpy(), rows.column(6).to_pylist()
            heads = np.flatnonzero(np.concatenate(([True], (np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0))))
            stops = np.append(heads[1:], len(key))
            out = [_cell(node[a:b], down[a:b], across[a:b], own[a:b], least) for a, b in zip(heads, stops, strict=True)]
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            new = pa.Table.from_batches([batch])
            rows = new if held is None else pa.concat_tables([held, new]).combine_chunks()
            if not len(rows):
                continue
            last = np.ones(len(rows), dtype=bool)
            for at in range(3):
                column = rows.column(at).to_numpy()
                last &= column == column[-1]
            end = int(np.argmax(last))  # the last cell may go on
            if end:
                yield done(rows.slice(0, end))
            held = rows.slice(end)
        if held is not None and len(held):
            yield done(held)

    cells = dealt.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    return near.unionByName(stage(cells.mapInArrow(compare, "a bigint, b bigint"), "pairs"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: float = LEAST,
) -> DataFrame:
    """``id, component_id`` per row: the smallest id reachable over links."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = dict(rows.dtypes)["id"]
    small_batches()
    found = stage(
        rows.mapInArrow(lambda batches: _sketch(batches, words, False), f"id {kind}, node bigint, fp bigint, bands array<bigint>"), "shingles"
    )
    firsts = found.groupBy("node").agg(F.min("id").alias("first"))
    roots = stage(components(link_edges(rows, found, words, least)), "roots")
    grouped = firsts.join(roots.toDF("of", "root"), F.col("node") == F.col("of"), "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    known = grouped.join(smallest, "root").select("node", "component_id")
    return found.select("id", "node").join(known, "node").select("id", "component_id")
