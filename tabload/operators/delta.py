"""Change detection against a snapshot, classification and merge.

Incoming and current rows are unique per key (incoming rows are versioned first), so no step has
a skewed key. The snapshot is the large side. Rows are classified against only those snapshot rows
whose key comes in while the incoming keys are few enough to broadcast, and the merge is a left join of the snapshot to the updates plus a union of the inserts, so a small delta
moves no snapshot row through a shuffle. A full outer join could do neither.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, FractionalType, StringType

from tabload.config import DeltaSpec
from tabload.functions import numbers, text
from tabload.operators.joins import anti, join_on, semi

CURRENT = "_cur_"


def compared_columns(incoming: DataFrame, current: DataFrame, spec: DeltaSpec) -> list[str]:
    skipped = {*spec.keys, *spec.ignore}
    return [c for c in incoming.columns if c in current.columns and c not in skipped]


def _differs(incoming: DataFrame, columns: list[str]) -> Column:
    """True where a shared column changed; fractions compare at four decimals, texts without
    outer blanks and quotes, and NULL equals NULL."""
    tests = []
    for name in columns:
        new, old = F.col(f"`{name}`"), F.col(f"`{CURRENT}{name}`")
        kind = incoming.schema[name].dataType
        if isinstance(kind, StringType):
            new, old = text.canonical(new), text.canonical(old)
        elif isinstance(kind, DecimalType):
            new, old = F.round(numbers.number_sentinel_to_null(new), 4), F.round(numbers.number_sentinel_to_null(old), 4)
        elif isinstance(kind, FractionalType):
            new, old = numbers.compare_number(new.cast("double")), numbers.compare_number(old.cast("double"))
        tests.append(~new.eqNullSafe(old))
    return reduce(lambda one, other: one | other, tests) if tests else F.lit(False)


def _label(new: Column, incoming: DataFrame, columns: list[str], spec: DeltaSpec) -> Column:
    """Operation of an incoming row next to its current one."""
    label = F.when(new, "insert")
    if spec.version in columns:
        # A replayed or late row never overwrites a newer one.
        label = label.when(F.col(spec.version) < F.col(f"{CURRENT}{spec.version}"), "stale")
    return label.when(_differs(incoming, columns), "update").otherwise("same")


def classify(incoming: DataFrame, current: DataFrame, spec: DeltaSpec, few_keys: bool = False) -> DataFrame:
    """Incoming rows with the operation each one needs: insert, update, same or stale.

    Stale rows carry a lower version than the current row; they are reported, not applied.

    Pass ``few_keys`` only after a check of the size of the incoming keys; they are then broadcast.
    """
    keys = list(spec.keys)
    columns = compared_columns(incoming, current, spec)
    hit = semi(current, F.broadcast(incoming.select(*keys)), keys, spec.null_keys) if few_keys else current
    old = hit.select(
        *keys, *[F.col(f"`{c}`").alias(f"{CURRENT}{c}") for c in columns], F.lit(True).alias("_held")
    )
    joined = join_on(incoming, old, keys, "left", spec.null_keys)
    label = _label(F.col("_held").isNull(), incoming, columns, spec)
    return joined.select(*[F.col(f"`{c}`") for c in incoming.columns], label.alias(spec.label))


def inserts(classified: DataFrame, spec: DeltaSpec) -> DataFrame:
    return classified.filter(F.col(spec.label) == "insert").drop(spec.label)


def updates(classified: DataFrame, spec: DeltaSpec) -> DataFrame:
    return classified.filter(F.col(spec.label) == "update").drop(spec.label)


def merge_snapshot(current: DataFrame, classified: DataFrame, spec: DeltaSpec, few_changes: bool = False) -> DataFrame:
    """The next snapshot: current rows with updates applied, plus inserts.

    A column the incoming rows lack keeps its current value, or becomes NULL in updated rows with
    ``absent_columns="null"``. Ignored columns keep their current value. Pass ``few_changes`` only
    after a check of the size of the updates; they are then broadcast.
    """
    keys = list(spec.keys)
    incoming_columns = [c for c in classified.columns if c != spec.label]
    held = {*keys, *spec.ignore}
    written = [c for c in incoming_columns if c in current.columns and c not in held]
    changes = updates(classified, spec).select(
        *keys, F.struct(*[F.col(f"`{c}`") for c in written], F.lit(True).alias("_hit")).alias("_new")
    )
    joined = join_on(current, F.broadcast(changes) if few_changes else changes, keys, "left", spec.null_keys)
    hit = F.col("_new").isNotNull()
    outputs = []
    for name in current.columns:
        old = F.col(f"`{name}`")
        if name in written:
            value = F.when(hit, F.col(f"_new.`{name}`")).otherwise(old)
        elif spec.absent_columns == "null" and name not in held:
            value = F.when(~hit, old)
        else:
            value = old
        outputs.append(value.alias(name))
    kept = joined.select(*outputs)
    added = inserts(classified, spec).select(
        *[
            (F.col(f"`{f.name}`") if f.name in incoming_columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in current.schema.fields
        ]
    )
    return kept.unionByName(added)


def upsert(current: DataFrame, incoming: DataFrame, spec: DeltaSpec) -> DataFrame:
    """The next snapshot straight from incoming rows: one join, for deltas as large as the snapshot.

    Gives the rows of ``merge_snapshot`` over ``classify``, without the classified rows in between.
    """
    keys = list(spec.keys)
    written = [c for c in incoming.columns if c in current.columns and c not in {*keys, *spec.ignore}]
    old = current.select(
        *[F.col(f"`{c}`").alias(f"{CURRENT}{c}") for c in current.columns], F.lit(True).alias("_held")
    )
    new = incoming.withColumn("_came", F.lit(True))
    equal = reduce(lambda one, other: one & other, [new[k].eqNullSafe(old[f"{CURRENT}{k}"]) for k in keys])
    joined = new.join(old, equal, "full_outer")
    op = _label(F.col("_held").isNull(), incoming, compared_columns(incoming, current, spec), spec)
    labelled = joined.withColumn("_op", F.when(F.col("_came").isNotNull(), op).otherwise("same"))
    outputs = []
    for f in current.schema.fields:
        before = F.col(f"`{CURRENT}{f.name}`")
        if f.name in written or f.name in keys:
            value = F.when(F.col("_op").isin("insert", "update"), F.col(f"`{f.name}`").cast(f.dataType)).otherwise(before)
        elif f.name in incoming.columns:
            value = F.when(F.col("_op") == "insert", F.col(f"`{f.name}`").cast(f.dataType)).otherwise(before)
        elif spec.absent_columns == "null" and f.name not in spec.ignore:
            value = F.when(F.col("_op") != "update", before)
        else:
            value = before
        outputs.append(value.alias(f.name))
    return labelled.select(*outputs)


def diff_report(incoming: DataFrame, current: DataFrame, spec: DeltaSpec) -> DataFrame:
    """Keys by where they occur: left_only (new or changed), both (equal) or right_only."""
    keys = list(spec.keys)
    columns = compared_columns(incoming, current, spec)
    old = current.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(f"`{c}`").alias(f"{CURRENT}{c}") for c in columns],
        F.lit(True).alias("_held"),
    )
    new = incoming.withColumn("_came", F.lit(True))
    equal = reduce(lambda one, other: one & other, [new[k].eqNullSafe(old[f"_key_{k}"]) for k in keys])
    joined = new.join(old, equal, "full_outer")
    place = (
        F.when(F.col("_came").isNull(), "right_only")
        .when(F.col("_held").isNull() | _differs(incoming, columns), "left_only")
        .otherwise("both")
    )
    return joined.select(
        *[F.when(F.col("_came").isNull(), F.col(f"_key_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        place.alias("side"),
    )


def bucket_digests(rows: DataFrame, bucket: Column, columns: list[str]) -> DataFrame:
    """``bucket, n_rows, digest``: a digest of the rows of each bucket that does not depend on their order.

    It holds the number of rows and the sum and exclusive or of their 64-bit hashes, so it is a partial aggregate, one row per
    bucket and task. A NULL counts as a value of its own.
    """
    cells = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashed = rows.select(bucket.alias("bucket"), F.xxhash64(*cells).alias("_hash"))
    n, total, mixed = F.count(F.lit(1)), F.sum(F.col("_hash").cast("decimal(38,0)")), F.bit_xor("_hash")
    return hashed.groupBy("bucket").agg(n.alias("n_rows"), F.concat_ws(":", n, total, mixed).alias("digest"))


def digest_diff(incoming: DataFrame, current: DataFrame, bucket: Column, columns: list[str]) -> DataFrame:
    """``bucket, state`` of every bucket of either side: new, gone, changed or same."""
    new, old = (bucket_digests(rows, bucket, columns).drop("n_rows") for rows in (incoming, current))
    both = new.join(old.toDF("_bucket", "_digest"), F.col("bucket").eqNullSafe(F.col("_bucket")), "full_outer")
    state = (
        F.when(F.col("_digest").isNull(), "new").when(F.col("digest").isNull(), "gone")
        .when(F.col("digest") == F.col("_digest"), "same").otherwise("changed")
    )
    return both.select(F.coalesce("bucket", "_bucket").alias("bucket"), state.alias("state"))


def run_summary(classified: DataFrame, spec: DeltaSpec, table: str) -> DataFrame:
    """Rows per operation of one table."""
    return classified.groupBy(spec.label).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table_name"), F.col(spec.label), "n_rows"
    )


OPS = ("insert", "update", "same", "stale")


def op_metrics(label: str) -> dict[str, Column]:
    """Rows per operation as aggregates that can be observed while the rows are written."""
    return {op: F.count_if(F.col(label) == op) for op in OPS}


def split_orphans(
    child: DataFrame, parent: DataFrame, links: dict[str, str], few_rows: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Child rows that may be merged, and those whose reference has no parent (see ``orphans``)."""
    names = list(links)
    lost = orphans(child, parent, links, few_rows)
    return anti(child, lost.select(*names).distinct(), names), lost


def orphans(child: DataFrame, parent: DataFrame, links: dict[str, str], few_rows: bool = False) -> DataFrame:
    """Child rows whose reference (child column to parent column) has no parent; NULL refers to none.

    Pass ``few_rows`` only after a check of the size of the child's references; they are then
    broadcast to the parent, whose other rows take no part.
    """
    names = list(links)
    referring = child.na.drop("any", subset=names)
    targets = parent.select(*[F.col(links[c]).alias(c) for c in names])
    if few_rows:
        targets = semi(targets, F.broadcast(referring.select(*names)), names)
    return anti(referring, targets, names)
