"""Document fingerprints by one-permutation MinHash.

The shingles of a text are hashed once; the upper bits of a hash choose one of ``BINS`` bins, and each bin keeps its smallest hash.
An empty bin takes the value of another: it draws bins by hashes of its own number and the attempt until one is
not empty (optimal densification); after ``DRAWS`` attempts the non-empty bin with the smallest hash of both numbers is taken,
which is where a random order of all bins would end, so no text loops. Of each value, hashed with the number of its bin so that
values that fill many bins do not collide in all of them, the low ``BITS`` bits are stored, packed into 64-bit words. Two fingerprints agree in a bin by chance once in 2^BITS; ``likeness`` corrects for that.

All of it is built-in functions on arrays within a row: no shuffle, no Python.

Cases: words are runs of anything but ASCII white space, as they are written; a text with fewer words than a shingle is one
shingle; a text without words (also a null or empty one) has the fingerprint zero, like itself and unlike others. Equal texts
have equal fingerprints. Texts of any length are hashed whole. In ``splice_next`` rows that share an id have the same
next document, which is the smallest text of the next larger id (after the largest: of the smallest); a row without an id has none and
counts as followed by an empty text.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabload.llm.common import fresh

WORDS = 5
BINS = 256
BITS = 4  # a hexadecimal digit
DRAWS = 16
PER_WORD = 64 // BITS
_SHIFT = 64 - (BINS - 1).bit_length()
_EMPTY = (1 << _SHIFT) - 1  # what a bin holds that no shingle fell in
_SPACES = " \t\n\x0b\x0c\r"


def add_fingerprint(docs: DataFrame, text_col: str, name: str, words: int = WORDS) -> DataFrame:
    """``docs`` with the packed fingerprint of a text (array of ``BINS * BITS / 64`` bigint)."""
    step = fresh(docs, "mh")
    w, h, s, a, f, v, o = (f"{step}_{part}" for part in "whsafvo")
    trimmed = F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(_SPACES))
    # one empty value per bin sorts behind all others of its bin, so each bin has a first value
    empties = F.array(*[F.lit((at << _SHIFT) + _EMPTY) for at in range(-BINS // 2, BINS // 2)])
    gets = ", ".join(f"get({h}, i + {at})" for at in range(words))
    draws = ", ".join(f"get({v}, cast(pmod(xxhash64(i, {at}), {BINS}) as int))" for at in range(1, DRAWS + 1))
    last = f"array_min(transform({o}, j -> struct(xxhash64(i, j), get({v}, j)))).col2"
    chunk = f"slice({f}, w * {PER_WORD} + 1, {PER_WORD})"
    # One step each: what a lambda reads is computed before it. The optimiser puts a column that is named only once in
    # place of its name, and so into the lambda; each of these is named twice.
    return (
        docs.withColumn(w, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t\n\x0b\f\r]+")))
        .withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
        .withColumn(s, F.expr(f"""
            case when size({h}) = 0 then cast(array() as array<bigint>)
                 when size({h}) < {words} then array(xxhash64({h}))
                 else transform(sequence(0, size({h}) - {words}), i -> xxhash64({gets})) end"""))
        .withColumn(a, F.sort_array(F.concat(F.col(s), empties)))
        .withColumn(f, F.expr(f"filter({a}, (x, i) -> i = 0 or shiftright(x, {_SHIFT}) <> shiftright(get({a}, i - 1), {_SHIFT}))"))
        .withColumn(v, F.expr(f"transform({f}, x -> if((x & {_EMPTY}L) = {_EMPTY}L, null, x & {_EMPTY}L))"))
        .withColumn(o, F.expr(f"filter(sequence(0, {BINS - 1}), j -> get({v}, j) is not null)"))
        .withColumn(f, F.expr(f"""
            case when size({o}) = 0 then array_repeat(0L, {BINS})
                 else transform({v}, (x, i) -> xxhash64(coalesce(x, {draws}, {last}), i) & {(1 << BITS) - 1}L) end"""))
        .withColumn(name, F.expr(f"""
            transform(sequence(0, cast(size({f}) / {PER_WORD} as int) - 1),
                      w -> aggregate({chunk}, 0L, (held, x) -> shiftleft(held, {BITS}) | x))"""))
        .drop(w, h, s, a, f, v, o)
    )


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles (0 to 1) from two packed fingerprints."""
    ones = sum(1 << at for at in range(0, 64, BITS))
    spread = " | ".join(["z", *(f"shiftrightunsigned(z, {at})" for at in range(1, BITS))])
    different = f"aggregate(zip_with({a}, {b}, (x, y) -> x ^ y), 0, (n, z) -> n + bit_count(({spread}) & {ones}L))"
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (1 - F.expr(different) / BINS - chance) / (1 - chance))


def as_text(fingerprint: Column) -> Column:
    """Hexadecimal digits, one per bin."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above the key, found in two steps of about the root of their number."""
    step = max(1, isqrt(len(bounds)))
    groups = [bounds[at: at + step] for at in range(0, len(bounds), step)]
    count = lambda held: F.size(F.filter(held, lambda bound: bound <= key))
    coarse = count(F.array(*[F.lit(group[0]).cast("bigint") for group in groups]))
    lists = F.array(*[F.array(*[F.lit(bound).cast("bigint") for bound in group]) for group in groups])
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + count(F.get(lists, coarse - 1)))


def next_ids(ids: DataFrame, key: str) -> DataFrame | None:
    """``ids`` (distinct, not null) with ``next``, the next larger key; after the largest the smallest. None if there are no rows.

    Keys are cut into as many ranges as there are shuffle partitions at approximate quantiles (one job over the keys), so
    a window sees one range; only the first keys of the ranges are put in order in one place.
    """
    spark = ids.sparkSession
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [at / ranges for at in range(1, ranges)]
    bounds = ids.agg(F.percentile_approx(key, shares, 100 * ranges).alias("b")).first()["b"]
    if bounds is None:
        return None
    placed = ids.withColumn("range", _bucket(F.col(key), sorted(set(bounds))))
    inside = placed.withColumn("next", F.lead(key).over(Window.partitionBy("range").orderBy(key)))
    firsts = placed.groupBy("range").agg(F.min(key).alias("head"))
    order = Window.orderBy("range")  # one row per range
    after = firsts.select("range", F.coalesce(
        F.lead("head").over(order), F.first("head").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).alias("after"))
    return inside.join(F.broadcast(after), "range").select(*ids.columns, F.coalesce("next", "after").alias("next"))


def splice_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, edited, fp, next_fp`` per row.

    ``edited`` is the text with its last quarter of code points replaced by as many from the start of the next document.
    Texts are shuffled once, by id; a document sends its successor's predecessor only the start of its text and its fingerprint.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    known = rows.filter(F.col("id").isNotNull())
    lengths = known.groupBy("id").agg(F.max(quarter).alias("quarter"))
    following = next_ids(lengths, "id")
    none = F.lit(None).cast("array<bigint>")
    alone = add_fingerprint(rows.filter(F.col("id").isNull()), "text", "fp").select(
        "id", "text", F.lit("").alias("start"), "fp", none.alias("next_fp")
    )
    if following is None:
        joined = alone
    else:
        base = add_fingerprint(known, "text", "fp").repartition("id")
        first = base.groupBy("id").agg(F.min(F.struct("text", "fp")).alias("own"))
        sent = first.join(following.select(F.col("id").alias("to"), F.col("next").alias("id"), "quarter"), "id").select(
            "to", F.expr("left(own.text, quarter)").alias("start"), F.col("own.fp").alias("next_fp")
        )
        joined = base.join(sent, F.col("id") == F.col("to")).select("id", "text", "start", "fp", "next_fp").unionByName(alone)
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - quarter), F.substring("start", F.lit(1), quarter)
    )
    return joined.withColumn("edited", edited).drop("start")
