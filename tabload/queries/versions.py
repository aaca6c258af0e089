"""Versions of a published table, and digests of its buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.operators import delta
from tabload.queries import query, table
from tabload.session import shared_dir
from tabload.sinks.publish import SnapshotStore
from tabload.sinks.versions import read_as_of, version_intervals

_STATES = """
    select 1 as version, o_orderkey, o_totalprice as price, o_orderstatus as status from orders where o_orderkey % 3 <> 0
    union all
    select 2, o_orderkey, o_totalprice + case when o_orderkey % 5 = 0 then 1 else 0 end, o_orderstatus from orders
    union all
    select 3, o_orderkey, o_totalprice + case when o_orderkey % 15 = 0 then 1 else 0 end, case when o_orderkey % 7 = 0 then null else o_orderstatus end from orders"""


def _published(spark: SparkSession, folder: str) -> tuple[SnapshotStore, DataFrame]:
    """Orders published three times: a part of them, all with changes, changes back and others; each run writes the buckets it touches."""
    orders, key, price, status = table(spark, folder, "orders"), F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    store = SnapshotStore(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")
    states = [
        orders.filter(key % 3 != 0).select(key, price.alias("price"), status.alias("status")),
        orders.select(key, (price + F.when(key % 5 == 0, 1).otherwise(0)).alias("price"), status.alias("status")),
        orders.select(
            key, (price + F.when(key % 15 == 0, 1).otherwise(0)).alias("price"), F.when(key % 7 != 0, status).alias("status")
        ),
    ]
    for at, rows in enumerate(states):
        written = store.stage_buckets(rows, f"run-{at}", "Purchase", ["o_orderkey"])
        store.publish(f"run-{at}", {"Purchase": dict.fromkeys(written, 0)})
    return store, states[0]


@query("versions_as_of", f"select o_orderkey, price, status from ({_STATES}) where version = 2")
def versions_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The table as it was after the second of three runs."""
    store, rows = _published(spark, folder)
    return read_as_of(store, "Purchase", rows.schema, 2)


@query("version_intervals", f"""
    with states as ({_STATES}),
    marked as (select *, case when lag(version) over w = version - 1 and lag(price) over w is not distinct from price
                                   and lag(status) over w is not distinct from status then 0 else 1 end as fresh
               from states window w as (partition by o_orderkey order by version)),
    numbered as (select *, sum(fresh) over (partition by o_orderkey order by version) as island from marked)
    select o_orderkey, any_value(price) as price, any_value(status) as status, cast(min(version) as bigint) as valid_from,
           case when max(version) < 3 then cast(max(version) + 1 as bigint) end as valid_to
    from numbered group by o_orderkey, island""")
def intervals(spark: SparkSession, folder: str) -> DataFrame:
    """From which version to which each order had which values."""
    store, rows = _published(spark, folder)
    return version_intervals(store, "Purchase", rows.schema, ["o_orderkey"])


@query("bucket_digest_diff", """
    with current as (select o_orderkey % 64 as bucket, o_orderkey, o_totalprice as price, o_orderpriority as priority from orders where o_orderkey % 64 <> 9),
    incoming as (select o_orderkey % 64 as bucket, o_orderkey, case when o_orderkey % 640 = 3 then o_totalprice + 1 else o_totalprice end as price,
                        case when o_orderkey % 64 = 5 and o_custkey % 100 = 7 then null else o_orderpriority end as priority
                 from orders where o_orderkey % 64 <> 11 and o_orderkey % 1280 <> 12),
    changed as (select bucket from (select * from current except all select * from incoming)
                union select bucket from (select * from incoming except all select * from current))
    select bucket, case when bucket not in (select bucket from current) then 'new' when bucket not in (select bucket from incoming) then 'gone'
                        when bucket in (select bucket from changed) then 'changed' else 'same' end as state
    from (select bucket from current union select bucket from incoming)""")
def bucket_digest_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Which buckets of a table differ between two states, told by counts, sums and exclusive ors of row hashes."""
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    current = orders.filter(key % 64 != 9).select(key, F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    incoming = orders.filter((key % 64 != 11) & (key % 1280 != 12)).select(
        key, (F.col("o_totalprice") + F.when(key % 640 == 3, 1).otherwise(0)).alias("price"),
        F.when(~F.coalesce((key % 64 == 5) & (F.col("o_custkey") % 100 == 7), F.lit(False)), F.col("o_orderpriority")).alias("priority"),
    )
    return delta.digest_diff(incoming, current, key % 64, ["o_orderkey", "price", "priority"])
