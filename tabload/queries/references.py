"""References of loaded tables, checked by the load plan itself in a run over a store of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.operators.joins import lookup
from tabload.plans import tables
from tabload.plans.tables import LoadJob, Run
from tabload.queries import query, table
from tabload.session import shared_dir
from tabload.sinks.publish import SnapshotStore
from tabload.sources.catalog import Catalog, Entry, ForeignKey


def new_run(spark: SparkSession, catalog: Catalog, stored: dict[str, DataFrame], mapping: dict[str, list[str]] | None = None) -> Run:
    """A run on a store in the shared folder that holds the given tables."""
    store = SnapshotStore(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")
    counts = {name: store.stage(rows, "base", f"tables/{name}").count() for name, rows in stored.items()}
    if counts:
        store.publish("base", counts)
    sites = spark.createDataFrame([], "site_folder string, site_code string")
    return Run(LoadJob(store, catalog, mapping or {}, sites), "next")


_NODES = """
    select o_orderkey as id, case when o_orderkey % 8 = 0 then null when o_orderkey % 8 = 1 and (o_orderkey // 8) % 5 = 0 then -o_orderkey
                                  else o_orderkey - 1 end as parent,
           case when o_orderkey % 8 = 7 then o_orderkey - 4 when o_orderkey % 8 = 2 and o_custkey % 3 = 0 then o_orderkey - 2 end as other
    from orders where o_orderkey is not null"""

_NODE_CATALOG = Catalog(
    (Entry("Node", "id", "INTEGER", primary=True), Entry("Node", "parent", "INTEGER"), Entry("Node", "other", "INTEGER")),
    (ForeignKey("up", "Node", ("parent",), "Node", ("id",)), ForeignKey("side", "Node", ("other",), "Node", ("id",))),
)


@query("orphan_cascade", f"""
    with recursive nodes as ({_NODES}),
    held as (select o_orderkey as id from orders where o_orderkey % 8 = 4 and o_custkey % 2 = 0),
    lost(id) as (
        select id from nodes where (parent is not null and parent not in (select id from nodes) and parent not in (select id from held))
                                or (other is not null and other not in (select id from nodes) and other not in (select id from held))
        union
        select n.id from nodes n join lost l on n.parent = l.id or n.other = l.id where l.id not in (select id from held))
    select id, parent, other, id in (select id from lost) as dropped from nodes""")
def orphan_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Chains of rows of a table that refers to itself twice: what hangs on a missing row is dropped, however far down it is."""
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    nodes = orders.filter(key.isNotNull()).select(
        key.alias("id"),
        F.when(key % 8 == 0, None).when((key % 8 == 1) & (F.floor(key / 8) % 5 == 0), -key).otherwise(key - 1).alias("parent"),
        F.when(key % 8 == 7, key - 4).when((key % 8 == 2) & (F.col("o_custkey") % 3 == 0), key - 2).alias("other"),
    )
    held = orders.filter("o_orderkey % 8 = 4 and o_custkey % 2 = 0").select(
        key.alias("id"), F.lit(None).cast("bigint").alias("parent"), F.lit(None).cast("bigint").alias("other")
    )
    run = new_run(spark, _NODE_CATALOG, {"Node": held})
    incoming = run.stage(nodes, "incoming/Node")
    kept = tables.drop_orphans(run, "Node", incoming)
    return lookup(incoming, kept.select("id"), ["id"], "kept").select("id", "parent", "other", (~F.col("kept")).alias("dropped"))


_ORDER_CATALOG = Catalog(
    (
        Entry("Purchase", "o_orderkey", "INTEGER", primary=True), Entry("Purchase", "buyer", "INTEGER"), Entry("Purchase", "payer", "VARCHAR(20)"),
        Entry("Purchase", "code", "VARCHAR(20)"), Entry("Client", "c_custkey", "INTEGER", primary=True),
        Entry("Account", "owner", "INTEGER", primary=True), Entry("Account", "code", "VARCHAR(20)", primary=True),
    ),
    (
        ForeignKey("bought by", "Purchase", ("buyer",), "Client", ("c_custkey",)),
        ForeignKey("charged to", "Purchase", ("buyer", "code"), "Account", ("owner", "code")),
        ForeignKey("paid by", "Purchase", ("payer",), "Client", ("c_custkey",)),
    ),
)


@query("orphan_constraints", """
    with purchase as (
        select o_orderkey, o_custkey as buyer, case when o_orderkey % 9 = 0 then 'x' || o_custkey when o_orderkey % 9 < 5 then cast(o_custkey + 1 as varchar) end as payer,
               case when o_orderkey % 4 <> 0 then o_orderstatus end as code
        from orders where o_orderkey is not null),
    client as (select c_custkey from customer where c_custkey % 11 <> 3),
    account as (select distinct o_custkey as owner, o_orderstatus as code from orders where o_totalprice > 150000 and o_custkey is not null and o_orderstatus is not null),
    marks as (
        select o_orderkey, 'bought by' as mark from purchase where buyer is not null and buyer not in (select c_custkey from client)
        union all
        select o_orderkey, 'charged to' from purchase p where buyer is not null and code is not null
            and not exists (select 1 from account a where a.owner = p.buyer and a.code = p.code)
        union all
        select o_orderkey, 'paid by' from purchase where payer is not null and payer not in (select cast(c_custkey as varchar) from client))
    select o_orderkey, string_agg(mark, ', ' order by mark) as broken from marks group by o_orderkey""")
def orphan_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """Two references to one parent and one of two columns: each is checked for itself, a NULL in one does not excuse the others."""
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    owner = F.col("o_custkey")
    purchases = orders.filter(key.isNotNull()).select(
        key, owner.alias("buyer"),
        F.when(key % 9 == 0, F.concat(F.lit("x"), owner.cast("string"))).when(key % 9 < 5, (owner + 1).cast("string")).alias("payer"),
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("code"),
    )
    clients = table(spark, folder, "customer").filter("c_custkey % 11 <> 3").select("c_custkey")
    accounts = orders.filter("o_totalprice > 150000").select(owner.alias("owner"), F.col("o_orderstatus").alias("code")).na.drop("any").distinct()
    run = new_run(spark, _ORDER_CATALOG, {"Client": clients, "Account": accounts})
    lost = tables.find_orphans(run, "Purchase", run.stage(purchases, "incoming/Purchase"))
    return lost.select("o_orderkey", F.array_join("broken", ", ").alias("broken"))
