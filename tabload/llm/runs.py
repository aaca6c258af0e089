"""Periodic runs of words, found on a grammar of the texts.

A run is a stretch of words with smallest period q, at least ``min_length`` words and ``times`` periods long, that no neighbouring
word extends. Each task works on the texts of a slice together:

1. Only stretches whose every n-gram of ``window`` words occurs twice in its text can hold runs (``window`` follows from the two
   limits); the rest is left out. This loses no run.
2. Re-Pair: the word ids of these stretches are replaced pair by pair, the more frequent of overlapping pairs first, all places in
   a round at once, until no pair repeats. What is left of each stretch is folded into a tree, so that one nonterminal derives it.
3. A run crosses the boundary between the two halves of the smallest nonterminal around it. Each nonterminal is looked at once, at
   one of its places: periods are distances at which the words beside the boundary come again, their reach is found
   by longest common extensions (tables of equal stretches of 1, 2, 4 ... words).
4. What was found is translated to every place a nonterminal derives. Of intervals with one period those inside
   another are dropped: they are runs cut off by the edge of a nonterminal.

Cases: a null text counts as empty and has no words and no runs; nulls in the id column pass through. Rows repeated get repeated
results; what a row gets does not depend on the rows beside it. Runs with different smallest periods may overlap, all are
given. A text of any length is searched whole, in one task: it takes some hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tabload.llm.common import Numbered, ragged, slices, small_batches

MIN_LENGTH = 24
TIMES = 3
SLICE_BYTES = 1_000_000  # of texts searched together
LEVELS = 12  # stretches of up to 2 ** LEVELS words have tables; longer ones are compared step by step

WHITE = r"[\x20\x09-\x0D]+"  # what stands between words

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


@dataclass
class Grammar:
    """Symbols below ``terminals`` are words, symbol ``terminals + i`` derives ``left[i]`` and ``right[i]``."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    rounds: list[int]  # the number of nonterminals before each round and at the end
    roots: np.ndarray  # the symbol that derives each stretch

    def lengths(self) -> np.ndarray:
        size = np.ones(self.terminals + len(self.left), dtype=np.int64)
        for a, b in zip(self.rounds[:-1], self.rounds[1:], strict=True):
            size[self.terminals + a: self.terminals + b] = size[self.left[a:b]] + size[self.right[a:b]]
        return size


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _chosen(code: np.ndarray) -> np.ndarray:
    """The places of the pairs to be replaced in this round, no two of them overlapping."""
    pairs, which, count = np.unique(code, return_inverse=True, return_counts=True)
    order = np.lexsort((_mixed(pairs), np.log2(count).astype(np.int64)))
    rank = np.empty(len(pairs), dtype=np.int64)
    rank[order] = np.arange(1, len(pairs) + 1)
    rank[count < 2] = 0
    # equal pairs in a row ("a a a") stand together as one group; a group goes before both of its neighbours or waits
    head = np.flatnonzero(np.diff(code, prepend=code[0] - 1))
    own = rank[which[head]]
    sides = np.concatenate(([-1], own, [-1]))
    wins = (own > 0) & (own > sides[:-2]) & (own > sides[2:])
    places = (np.diff(head, append=len(code))[wins] + 1) // 2
    return np.repeat(head[wins], places) + 2 * ragged(np.zeros(len(places), dtype=np.int64), places)


def compress(words: np.ndarray, starts: np.ndarray, terminals: int) -> Grammar:
    """Re-Pair of stretches of words, each ended by a word that occurs nowhere else; ``starts`` are their beginnings."""
    symbols, stretch = words, np.repeat(np.arange(len(starts)), np.diff(starts, append=len(words)))
    left, right, rounds = [], [], [0]
    closing = np.zeros(len(words), dtype=bool)
    closing[np.append(starts[1:], len(words)) - 1] = True

    def replace(at: np.ndarray) -> None:
        nonlocal symbols, stretch, closing
        size = terminals + rounds[-1]
        pairs, new = np.unique(symbols[at] * np.int64(size) + symbols[at + 1], return_inverse=True)
        left.append(pairs // size)
        right.append(pairs % size)
        rounds.append(rounds[-1] + len(pairs))
        stays = np.ones(len(symbols), dtype=bool)
        stays[at + 1] = False
        symbols = symbols.copy()
        symbols[at] = size + new
        symbols, stretch, closing = symbols[stays], stretch[stays], closing[stays]

    while len(symbols) > 1:
        at = _chosen(symbols[:-1] * np.int64(terminals + rounds[-1]) + symbols[1:])
        if not len(at):
            break
        replace(at)
    symbols, stretch = symbols[~closing], stretch[~closing]
    closing = closing[~closing]
    while len(symbols) > len(starts):
        first = np.flatnonzero(np.diff(stretch, prepend=-1))
        place = np.arange(len(symbols)) - np.repeat(first, np.diff(first, append=len(symbols)))
        same = np.append(stretch[1:] == stretch[:-1], False)
        replace(np.flatnonzero((place % 2 == 0) & same))
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
    return Grammar(terminals, join(left), join(right), rounds, symbols)


class Extensions:
    """Longest common extensions of places in an array of words."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        self.tables = [words.astype(np.int32)]
        step = 1
        while len(self.tables) <= LEVELS and 2 * step <= longest:
            below = self.tables[-1]
            valid = len(words) - 2 * step + 1
            table = -1 - np.arange(len(words), dtype=np.int32)  # too near the end: equal to none
            code = below[:valid].astype(np.int64) * len(words) * 2 + below[step: step + valid]
            table[:valid] = np.unique(code, return_inverse=True)[1]
            self.tables.append(table)
            step *= 2

    def _reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        reach = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.tables) - 1, -1, -1):
            step, table = 1 << level, self.tables[level]
            open_ = np.flatnonzero(reach + step <= most)
            while len(open_):
                done = reach[open_]
                shift = -(done + step - 1) if back else done
                open_ = open_[table[a[open_] + shift] == table[b[open_] + shift]]
                reach[open_] += step
                if level < len(self.tables) - 1:
                    break
                open_ = open_[reach[open_] + step <= most[open_]]
        return reach

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from a and b on are equal, ``most`` at the most."""
        return self._reach(a, b, most, back=False)

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words up to a and b, both included, are equal."""
        return self._reach(a, b, most, back=True)


def _distances(gram: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place ``at[i]`` all places in [low[i], high[i]) with an equal gram: (i, place)."""
    order = np.argsort(gram, kind="stable")
    key = gram[order].astype(np.int64) * len(gram) + order
    base = gram[at].astype(np.int64) * len(gram)
    first = np.searchsorted(key, base + low)
    many = np.maximum(np.searchsorted(key, base + high) - first, 0)
    return np.repeat(np.arange(len(at)), many), order[ragged(first, many)]


def _smallest(longer: Extensions, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether stretches of at least two periods have no smaller period: no divisor of theirs is one."""
    least = np.arange(int(period.max(initial=1)) + 1)
    for prime in range(2, int(len(least) ** 0.5) + 1):
        if least[prime] == prime:
            multiples = least[prime * prime:: prime]
            multiples[multiples == np.arange(prime * prime, len(least), prime)] = prime
    good, rest = np.ones(len(period), dtype=bool), period.copy()
    while (rest > 1).any():
        factor = np.where(rest > 1, least[rest], 1)
        part = period // factor
        open_ = np.flatnonzero((factor > 1) & good)
        good[open_] &= longer.forward(start[open_], start[open_] + part[open_], period[open_]) < period[open_]
        rest //= factor
    return good


def _crossing(
    words: np.ndarray, grammar: Grammar, size: np.ndarray, starts: np.ndarray, min_length: int, times: int,
) -> tuple[np.ndarray, ...]:
    """Runs across the boundary of each nonterminal, within what it derives: (nonterminal, start in it, length, period)."""
    place = np.zeros(len(size), dtype=np.int64)
    place[grammar.roots] = starts
    for a, b in reversed(list(zip(grammar.rounds[:-1], grammar.rounds[1:], strict=True))):
        own = place[grammar.terminals + a: grammar.terminals + b]
        place[grammar.left[a:b]] = own
        place[grammar.right[a:b]] = own + size[grammar.left[a:b]]
    which = np.flatnonzero(size[grammar.terminals:] >= min_length)
    low = place[grammar.terminals + which]
    middle = low + size[grammar.left[which]]
    high = middle + size[grammar.right[which]]
    longer = Extensions(words, int(size.max()))
    # the longer side of a run reaches at least so many words past one period
    q = np.arange(1, min_length + 1)
    beside = int(np.maximum(-(-min_length // 2) - q, -(-times * q // 2) - q).min())
    level = min(beside.bit_length() - 1, len(longer.tables) - 1)
    gram, width = longer.tables[level], 1 << level
    furthest = 2 * (high - middle) // times
    i, again = _distances(gram, middle.clip(max=len(words) - 1), middle + 1, np.minimum(middle + furthest, high - width) + 1)
    right = (i, again - middle[i])
    # the other way round: grams that end before the boundary
    furthest = 2 * (middle - low) // times
    last = middle - width
    fits = last >= low
    j, again = _distances(gram, last.clip(min=0), np.maximum(last - furthest, low), np.where(fits, last, 0))
    left = (j, last[j] - again)
    out = []
    for (at, period), ahead in ((right, True), (left, False)):
        b, lo, hi = middle[at], low[at], high[at]
        here = b if ahead else b - period
        start = here - longer.backward(here - 1, here - 1 + period, here - lo)
        end = here + period + longer.forward(here, here + period, hi - here - period)
        good = np.flatnonzero((end - start >= np.maximum(min_length, times * period)))
        good = good[_smallest(longer, start[good], period[good])]
        out.append((which[at[good]], (start - lo)[good], (end - start)[good], period[good]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _everywhere(grammar: Grammar, size: np.ndarray, starts: np.ndarray, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Runs of nonterminals at all places that they derive: (stretch, start, length, period)."""
    owner, offset, length, period = found
    order = np.argsort(owner, kind="stable")
    owner, offset, length, period = owner[order], offset[order], length[order], period[order]
    holds = np.zeros(len(size), dtype=bool)
    holds[grammar.terminals + owner] = True
    for a, b in zip(grammar.rounds[:-1], grammar.rounds[1:], strict=True):
        holds[grammar.terminals + a: grammar.terminals + b] |= holds[grammar.left[a:b]] | holds[grammar.right[a:b]]
    stretch = np.arange(len(starts))[holds[grammar.roots]]
    symbol, at = grammar.roots[stretch], starts[stretch]
    out = []
    while len(symbol):
        own = symbol - grammar.terminals
        first = np.searchsorted(owner, own)
        many = np.searchsorted(owner, own, "right") - first
        which = ragged(first, many)
        out.append((np.repeat(stretch, many), np.repeat(at, many) + offset[which], length[which], period[which]))
        left, right = grammar.left[own], grammar.right[own]
        symbol = np.concatenate((left, right))
        at = np.concatenate((at, at + size[left]))
        stretch = np.concatenate((stretch, stretch))
        more = holds[symbol]
        symbol, at, stretch = symbol[more], at[more], stretch[more]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.empty(0, np.int64) for _ in range(4))


def _outermost(stretch: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which intervals lie inside no other one of the same stretch and period; of equal ones one."""
    order = np.lexsort((-length, start, period, stretch))
    group = np.cumsum(np.concatenate(([0], (np.diff(stretch[order]) != 0) | (np.diff(period[order]) != 0)))) if len(order) else order
    end = start[order] + length[order]
    span = int(end.max(initial=0)) + 1
    reached = np.maximum.accumulate(group * span + end) if len(order) else order
    inside = np.concatenate(([False], reached[:-1] >= group[1:] * span + end[1:])) if len(order) else order.astype(bool)
    return order[~inside]


def find(words: np.ndarray, ends: np.ndarray, min_length: int = MIN_LENGTH, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """Runs of texts given as word ids one after the other: (text, start, length, period) by text, start and period."""
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    q = np.arange(1, min_length + 1)
    window = 1 + int((np.maximum(min_length, times * q) - 2 * q).min())
    count = len(words) - window + 1
    if count < 1:
        return none
    text = np.searchsorted(ends, np.arange(len(words)), "right")
    # hashes of all n-grams; equal hashes of different n-grams keep a stretch too many, which does no harm
    single = _mixed(words + 1)
    hashes = _mixed(text[:count])
    for at in range(window):
        hashes = hashes * np.uint64(0xD1342543DE82EF95) + single[at: at + count]
    inside = text[:count] == text[window - 1:]
    ordered = np.sort(hashes[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return none
    place = np.searchsorted(twice, hashes).clip(max=len(twice) - 1)
    marked = np.flatnonzero(inside & (twice[place] == hashes))
    # stretches: marked n-grams that follow each other in one text
    fresh = np.concatenate(([True], (np.diff(marked) != 1) | (np.diff(text[marked]) != 0)))
    first = marked[fresh]
    last = marked[np.append(fresh[1:], True)] + window
    wide = last - first >= min_length
    first, last = first[wide], last[wide]
    if not len(first):
        return none
    sizes = last - first
    known, dense = np.unique(words[ragged(first, sizes)], return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    joined = np.empty(int((sizes + 1).sum()), dtype=np.int64)
    closing = starts + sizes
    joined[closing] = len(known) + np.arange(len(starts))
    joined[ragged(starts, sizes)] = dense
    grammar = compress(joined, starts, len(known) + len(starts))
    size = grammar.lengths()
    stretch, start, length, period = _everywhere(
        grammar, size, starts, _crossing(joined, grammar, size, starts, min_length, times)
    )
    keep = _outermost(stretch, start, length, period)
    stretch, start, length, period = stretch[keep], start[keep], length[keep], period[keep]
    owner = text[first[stretch]]
    begin = np.concatenate(([0], ends[:-1]))
    start = first[stretch] + start - starts[stretch] - begin[owner]
    order = np.lexsort((period, start, owner))
    return owner[order], start[order], length[order], period[order]


def _collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words outside of what runs repeat, joined by spaces."""
    if not len(start):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return b" ".join([words[at] for at in np.flatnonzero(np.cumsum(change)[:-1] == 0)])


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, times: int = TIMES,
) -> DataFrame:
    """``id_col, n_words, runs, collapsed`` per row: runs by start and period, and the text with each run cut to its first period.

    ``times`` is a whole number of at least 3.
    """
    if times < 3 or min_length < times:
        raise ValueError("runs are at least three periods long")
    schema = StructType([
        docs.schema[id_col], StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)),
        StructField("collapsed", StringType()),
    ])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for part in slices(sizes, SLICE_BYTES):
                # bytes.split() splits at just the six white-space bytes
                split = [(x or b"").split() for x in batch.column(1)[part].to_pylist()]
                ends = np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)))
                number = Numbered()
                ids = np.fromiter((number[w] for words in split for w in words), dtype=np.int64, count=int(ends[-1]))
                text, start, length, period = find(ids, ends, min_length, times)
                edges = np.searchsorted(text, np.arange(len(split) + 1))
                collapsed = [
                    _collapse(words, start[a:b], length[a:b], period[a:b])
                    for words, a, b in zip(split, edges[:-1].tolist(), edges[1:].tolist(), strict=True)
                ]
                runs = pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], RUN.names),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(np.diff(ends, prepend=0)), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    schema.names,
                )

    small_batches()
    return docs.select(id_col, F.col(text_col).cast("binary").alias("text")).mapInArrow(search, schema)


def greatest(runs: Column) -> Column:
    """The run with the most periods, by exact comparison; of equals the one that stands first. Null if there is none."""
    more = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.aggregate(
        runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda best, run: F.when(more(best, run), run).otherwise(best)
    )


def repeat_tail(text: Column, first: Column, period: Column) -> Column:
    """The words of a text, those from place ``first`` on replaced by the ``period`` words there over and over; joined by spaces.

    Whole slices are put together: a lambda over the places would split the text again for each of them.
    """
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    rest = (F.size(words) - first).cast("int")
    part = F.slice(words, (first + 1).cast("int"), period.cast("int"))
    tail = F.flatten(F.array_repeat(part, F.ceil(rest / period).cast("int")))
    return F.array_join(F.concat(F.slice(words, F.lit(1), first.cast("int")), F.slice(tail, F.lit(1), rest)), " ")
