"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits the space by random directions, cut where the two sides of a sample, spill included, make the fewest
pairs, and goes on until about ``LEAF`` vectors are left per leaf. A vector near a split goes down both sides (spill), every time:
no side within the margin is left out. The margin follows from the depth, so that a vector is filed about ``COPIES`` times a tree.
Cuts go beside a crowd of near copies, and a node that no cut makes cheaper, as one that
is mostly crowd, is not split in this direction: crowds stay whole, whatever the number of levels. Vectors
are compared within leaves, all of them in double precision; what is at or above the threshold links. A pair is counted in the
first tree and leaf in which it meets, so counts need no list of pairs; a leaf emits, besides counts, only a
spanning forest of its links. In which leaves two vectors have met before is worked out again where they are compared, from the
trees, so a vector travels without its places. A leaf with far more vectors than
meant is dealt over a grid of blocks, so it is still compared whole.

The first levels are fitted on about ``SAMPLE`` vectors on the driver. Where the table asks for more levels than these can tell, each further
level is fitted in tasks: histograms of the projections of a sample that grows with the number of nodes, one cut per node. Only cuts
reach the driver, at most ``TREES * MOST_LEAVES`` of them; beyond ``LEAF * MOST_LEAVES`` vectors (10^8) leaves grow with the table.

Equal vectors are one from the start and count as often as they occur.

Cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; they are components
of their own. Vectors of different lengths do not link; each length has a forest of its own. Rows that share an id and a vector count as separate
vectors. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tabload.llm.common import ragged, small_batches
from tabload.llm.graph import components, forest
from tabload.session import stage

THRESHOLD = 0.9
TREES = 8
LEAF = 400  # vectors per leaf, about
SPILL = 0.4  # how near to a split a vector goes down both sides at most, in units of 1 / sqrt(dimensions), as projections shrink
COPIES = 4  # leaves of one tree that a vector is filed in, about
MOST_LEAVES = 1 << 18  # of one tree
NODE_SAMPLE = 64  # vectors per node that a further level is fitted on, about
BINS = np.linspace(-4.0, 4.0, 161)  # of the histograms for it, in units of 1 / sqrt(dimensions)
CUTS = np.linspace(0.2, 0.8, 25)  # quantiles of a node at which a cut is tried
SAMPLE = 20_000  # vectors the splits are fitted on, about
BLOCK = 1_000  # vectors of a leaf compared in one piece
DENSE = 0.02  # share of linked pairs from which a block counts as crowded
SEED = 7


def margin(depth: int, size: int) -> float:
    """How near to a cut a vector goes down both sides: a cut at the median of normal projections has about 0.8 of its vectors per unit there."""
    return min(SPILL, (COPIES ** (1 / max(1, depth)) - 1) / 0.8) / np.sqrt(size)


@dataclass
class Forest:
    """Splits of all trees: node i of a tree goes to 2i + 1 and 2i + 2."""

    directions: np.ndarray  # trees x depth x dimensions: one direction per level
    cuts: np.ndarray  # trees x inner nodes; infinite where a node is not split: all go to 2i + 1
    spill: float
    base: int = 0  # number of its first leaf among those of the forests of all lengths

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def leaves(self, units: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and leaves: every leaf of one tree that each vector is filed in."""
        row, node = np.arange(len(units)), np.zeros(len(units), dtype=np.int64)
        off = units @ self.directions[tree].T
        for level in range(self.depth):
            gap = off[row, level] - self.cuts[tree][node]
            twice = np.abs(gap) <= self.spill
            here = 2 * node + 1 + (gap > 0)
            there = 2 * node[twice] + 1 + (gap[twice] <= 0)
            row, node = np.concatenate((row, row[twice])), np.concatenate((here, there))
        return row, node - ((1 << self.depth) - 1)

    def nodes(self, off: np.ndarray, tree: int) -> np.ndarray:
        """The node each vector comes to without spill, below the last level."""
        node = np.zeros(len(off), dtype=np.int64)
        for level in range(self.depth):
            node = 2 * node + 1 + (off[:, level] > self.cuts[tree][node])
        return node


def _best(low: np.ndarray, high: np.ndarray, tried: np.ndarray) -> float:
    """The cut whose sides, which hold shares ``low`` and ``high``, make the fewest pairs; infinite if no cut saves any."""
    pairs = low**2 + high**2
    best = int(np.argmin(pairs))
    return float(tried[best]) if pairs[best] < 1 else np.inf


def best_cut(off: np.ndarray, spill: float) -> float:
    """Where to cut sorted projections."""
    tried = np.quantile(off, CUTS)
    return _best(np.searchsorted(off, tried + spill, "right") / len(off), 1 - np.searchsorted(off, tried - spill) / len(off), tried)


def best_bin(bins: np.ndarray, n: np.ndarray, spill: float) -> float:
    """Where to cut a histogram of projections (numbers of ``BINS``), in their units; projections count as the middle of their bin."""
    order = np.argsort(bins)
    middle = np.concatenate((BINS[:1], (BINS[:-1] + BINS[1:]) / 2, BINS[-1:]))[bins[order]]
    total = np.concatenate(([0], np.cumsum(n[order])))
    share = total / total[-1]
    tried = BINS[(BINS >= middle[np.searchsorted(share[1:], CUTS[0])]) & (BINS <= middle[np.searchsorted(share[1:], CUTS[-1])])]
    if not len(tried):
        return np.inf
    return _best(share[np.searchsorted(middle, tried + spill, "right")], 1 - share[np.searchsorted(middle, tried - spill)], tried)


def levels(total: int) -> int:
    """How many levels a table of so many vectors asks for."""
    depth = 0
    while total >> depth > LEAF and 1 << depth < MOST_LEAVES:
        depth += 1
    return depth


def _directions(size: int, depth: int) -> np.ndarray:
    found = np.random.default_rng(SEED).standard_normal((depth, TREES, size)).swapaxes(0, 1)  # the first levels do not depend on the depth
    return found / np.linalg.norm(found, axis=2, keepdims=True)


def fit(units: np.ndarray, total: int) -> Forest:
    """Trees for ``total`` vectors from a sample of unit vectors; no deeper than the sample can tell quantiles."""
    depth, size = levels(total), units.shape[1]
    spill = margin(depth, size)
    while depth and len(units) >> depth <= 8:
        depth -= 1
    trees = Forest(_directions(size, depth), np.full((TREES, max(1, (1 << depth) - 1)), np.inf), spill)
    for tree in range(TREES):
        off = units @ trees.directions[tree].T
        node = np.zeros(len(units), dtype=np.int64)
        for level in range(depth):
            for own in range((1 << level) - 1, (1 << (level + 1)) - 1):
                inside = np.sort(off[node == own, level])
                if len(inside) > 16 and len(inside) * total > LEAF * len(units):
                    trees.cuts[tree, own] = best_cut(inside, spill)
            node = 2 * node + 1 + (off[:, level] > trees.cuts[tree, node])
    return trees


def deepen(trees: Forest, vectors: DataFrame, size: int, total: int) -> Forest:
    """The levels that the driver's sample was too small for: one job each, over a sample of ``vectors`` (vec, embedding)."""
    spark = vectors.sparkSession
    for depth in range(trees.depth, levels(total)):
        share = min(1.0, (NODE_SAMPLE << depth) / total)
        below = Forest(_directions(size, depth + 1), trees.cuts, trees.spill)
        shared = spark.sparkContext.broadcast((trees, below))

        def histograms(batches: Iterator[pa.RecordBatch], depth: int = depth, shared=shared) -> Iterator[pa.RecordBatch]:
            known, wider = shared.value
            for batch in batches:
                units = _unit(_matrix(batch.column(0), size))
                for tree in range(TREES):
                    off = units @ wider.directions[tree].T
                    bins = np.searchsorted(BINS, off[:, depth] * np.sqrt(size))
                    code, n = np.unique((tree << 40) + (known.nodes(off, tree) << 8) + bins, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

        def cut(batches: Iterator[pa.RecordBatch], share: float = share, spill: float = trees.spill * np.sqrt(size)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for code, bins, n in zip(*(batch.column(at).to_pylist() for at in range(3)), strict=True):
                    n = np.array(n)
                    big = n.sum() > 16 and n.sum() > LEAF * share
                    found.append((code, best_bin(np.array(bins), n, spill) / np.sqrt(size) if big else np.inf))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], ["node", "cut"])

        chance = F.shiftrightunsigned(F.xxhash64("vec", F.lit(depth)), 32) / F.lit(float(1 << 32))
        sample = vectors.filter((F.size("embedding") == size) & (chance < share)).select("embedding")
        counted = sample.mapInArrow(histograms, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
        by_node = counted.groupBy(F.shiftright("code", 8).alias("node")).agg(F.collect_list(F.struct((F.col("code") % 256).alias("b"), "n")).alias("h"))
        found = by_node.select("node", "h.b", "h.n").mapInArrow(cut, "node bigint, cut double").toArrow()  # one row per node of this level
        cuts = np.full((TREES, (1 << (depth + 1)) - 1), np.inf)
        cuts[:, : trees.cuts.shape[1] if depth else 0] = trees.cuts[:, : (1 << depth) - 1]
        code = found["node"].to_numpy()
        cuts[code >> 32, code & 0xFFFFFFFF] = found["cut"].to_numpy()
        trees = Forest(below.directions, cuts, trees.spill)
    return trees


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: all components present and finite, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch by the length of their vectors, which stand in the last column."""
    sizes = pc.list_value_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        yield size, batch.filter(pa.array(sizes == size))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(-1, size)


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


CELL_SCHEMA = "cell bigint, low bigint, down int, across int, vec bigint, many bigint, vector binary"


def _file(batches: Iterator[pa.RecordBatch], forests: dict[int, Forest], kind: str, blocks: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """(vec, many, embedding) to one row per leaf and grid cell."""
    for size, batch in (part for whole in batches for part in _by_size(whole)):
        trees = forests[size]
        vec = batch.column(0).to_numpy(zero_copy_only=False)
        many = batch.column(1).to_numpy(zero_copy_only=False)
        rows = _matrix(batch.column(2), size)
        units = _unit(rows)
        row_bytes = np.array([x.tobytes() for x in rows.astype(kind)], dtype=object)  # as wide as the column is
        for tree in range(TREES):
            row, leaf = trees.leaves(units, tree)
            leaf = trees.base + (tree << trees.depth) + leaf
            n = np.fromiter((blocks.get(x, 1) for x in leaf.tolist()), dtype=np.int64, count=len(leaf))
            own = (vec[row].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n
            which = np.repeat(np.arange(len(row)), n)  # block b meets every block: cells (min, max)
            other = ragged(np.zeros(len(row), np.int64), n)
            mine = own[which]
            low, high = np.minimum(mine, other), np.maximum(mine, other)
            at = row[which]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf[which]), pa.array(low * (1 << 20) + high), pa.array(mine, pa.int32()), pa.array(other, pa.int32()),
                 pa.array(vec[at]), pa.array(many[at]), pa.array(row_bytes[at], pa.binary())],
                ["cell", "low", "down", "across", "vec", "many", "vector"],
            )


def _earlier(trees: Forest, units: np.ndarray, tree: int, leaf: int) -> np.ndarray:
    """In which leaves before this one each vector is: a bit for each such leaf that several of these vectors are in."""
    parts = [np.zeros((len(units), 0), dtype=bool)]
    for before in range(tree + 1):
        row, at = trees.leaves(units, before)
        if before == tree:
            row, at = row[at < leaf], at[at < leaf]
        _, column, n = np.unique(at, return_inverse=True, return_counts=True)
        place = np.cumsum(n > 1) - 1
        several = n[column] > 1
        bits = np.zeros((len(units), int((n > 1).sum())), dtype=bool)
        bits[row[several], place[column[several]]] = True
        parts.append(bits)
    return np.concatenate(parts, axis=1)


def _compare(rows: list[np.ndarray], forests: dict[int, Forest], kind: str, threshold: float) -> tuple[np.ndarray, ...]:
    """One grid cell: links per vector, and a spanning forest of its links."""
    cell, _, down, across, vec, many, vectors = rows
    size = len(vectors[0]) // np.dtype(kind).itemsize
    depth, at = forests[size].depth, int(cell[0]) - forests[size].base
    tree, leaf = at >> depth, at & ((1 << depth) - 1)
    units = _unit(np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vec), size).astype(np.float64))
    bits: np.ndarray | None = None
    # a cell off the diagonal of the grid compares its two blocks with each other, one on it the block with itself
    first = np.flatnonzero(down <= across)
    second = np.flatnonzero(down >= across)
    counts = np.zeros(len(vec), dtype=np.int64)
    edges = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for start in range(0, len(first), BLOCK):
        own = first[start: start + BLOCK]
        near = units[own] @ units[second].T >= threshold
        if not near.any():
            continue
        if bits is None:  # the leaves before this one are only looked up where something links
            bits = _earlier(forests[size], units, tree, leaf)
            packed = np.packbits(bits, axis=1)
        crowded = np.count_nonzero(near) > DENSE * near.size
        if crowded:  # where most pairs link, looking up all of them at once is cheaper than one by one
            near &= bits[own].astype(np.float32) @ bits[second].astype(np.float32).T < 0.5
        a, b = np.nonzero(near)
        a, b = own[a], second[b]
        if down[0] == across[0]:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 100_000):
            x, y = a[at: at + 100_000], b[at: at + 100_000]
            if not crowded:
                new = ~(packed[x] & packed[y]).any(axis=1)
                x, y = x[new], y[new]
            counts += np.bincount(x, weights=many[y], minlength=len(vec)).astype(np.int64)
            counts += np.bincount(y, weights=many[x], minlength=len(vec)).astype(np.int64)
            if len(x):
                edges.append(forest(vec[x], vec[y]))
    linked = np.flatnonzero(counts)
    left, right = (np.concatenate(x) for x in zip(*edges, strict=True))
    return vec[linked], counts[linked], left, right


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
) -> DataFrame:
    """``id, n_links, component_id, kept`` per row."""
    spark = rows.sparkSession
    small_batches()
    element = "float" if dict(rows.dtypes)[vector_col] == "array<float>" else "double"
    kind = "<f4" if element == "float" else "<f8"
    # adding zero turns -0.0 into 0.0, so equal vectors are equal bytes
    vector = F.transform(F.col(vector_col).cast(f"array<{element}>"), lambda x: x + F.lit(0.0).cast(element))
    own = stage(rows.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("embedding")), "vectors")
    good = own.filter(usable(F.col("embedding")))
    alone = own.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    distinct = stage(
        good.groupBy("embedding")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("many"))
        .select(F.xxhash64("embedding", F.lit(1)).alias("vec"), "first", "many", "embedding"),
        "distinct",
    )
    totals = {row["size"]: row["count"] for row in distinct.groupBy(F.size("embedding").alias("size")).count().orderBy("size").collect()}
    if not totals:
        return alone.withColumn("kept", F.lit(True))
    share = F.lit(min(1.0, SAMPLE / sum(totals.values())))
    sample = distinct.filter(F.shiftrightunsigned(F.xxhash64("vec"), 32) / F.lit(float(1 << 32)) < share)
    found = {size: batch for size, batch in _by_size(pa.RecordBatch.from_arrays(
        [sample.select("embedding").toArrow()["embedding"].combine_chunks()], ["embedding"]))}
    forests, leaves = {}, 0
    for size, total in totals.items():
        units = _unit(_matrix(found[size].column(0), size)) if size in found else np.zeros((0, size))
        forests[size] = deepen(fit(units, total), distinct, size, total)
        forests[size].base = leaves
        leaves += TREES << forests[size].depth
    shared = spark.sparkContext.broadcast(forests)  # TREES x 2^depth cuts a length, at most TREES * MOST_LEAVES
    narrow = distinct.select("vec", "many", "embedding")

    def sizes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(leaves, dtype=np.int64)
        for size, batch in (part for whole in batches for part in _by_size(whole)):
            own_units, trees = _unit(_matrix(batch.column(2), size)), shared.value[size]
            for tree in range(TREES):
                held += np.bincount(trees.base + (tree << trees.depth) + trees.leaves(own_units, tree)[1], minlength=len(held))
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["cell", "n"])

    filled = narrow.mapInArrow(sizes_of, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    full = filled.filter(F.col("n") > 2 * BLOCK).collect()  # leaves, whose number is bounded
    blocks = spark.sparkContext.broadcast({row["cell"]: -(-row["n"] // BLOCK) for row in full})

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _file(batches, shared.value, kind, blocks.value)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def done(rows_: list[np.ndarray]) -> pa.RecordBatch:
            heads = np.flatnonzero(np.concatenate(([True], (np.diff(rows_[0]) != 0) | (np.diff(rows_[1]) != 0))))
            stops = np.append(heads[1:], len(rows_[0]))
            out = [_compare([x[a:b] for x in rows_], shared.value, kind, threshold) for a, b in zip(heads, stops, strict=True)]
            vec, n, left, right = (np.concatenate(x) for x in zip(*out, strict=True))
            nothing = np.zeros(len(left), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((vec, left))), pa.array(np.concatenate((n, nothing))),
                 pa.array(np.concatenate((vec, right)))], ["a", "n", "b"],
            )

        for batch in batches:
            new = [batch.column(at).to_numpy(zero_copy_only=False) for at in range(7)]
            rows_ = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if not len(rows_[0]):
                continue
            last = (rows_[0] == rows_[0][-1]) & (rows_[1] == rows_[1][-1])
            end = int(np.argmax(last))  # the last cell may go on
            if end:
                yield done([x[:end] for x in rows_])
            held = [x[end:] for x in rows_]
        if held is not None and len(held[0]):
            yield done(held)

    cells = narrow.mapInArrow(spread, CELL_SCHEMA).repartition("cell", "low").sortWithinPartitions("cell", "low")
    links = stage(cells.mapInArrow(compare, "a bigint, n bigint, b bigint"), "links")
    counts = links.filter("n > 0").groupBy(F.col("a").alias("of")).agg(F.sum("n").alias("n"))
    roots = components(links.filter("a <> b").select("a", "b"))
    grouped = (
        distinct.join(counts, F.col("vec") == F.col("of"), "left")
        .join(roots, F.col("vec") == F.col("node"), "left")
        .select("embedding", "first", (F.col("many") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "vec").alias("root"))
    )
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    known = grouped.join(smallest, "root").select("embedding", "n_links", "component_id")
    answered = good.join(known, "embedding").select("id", "n_links", "component_id")
    return answered.unionByName(own.filter(~usable(F.col("embedding"))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )
