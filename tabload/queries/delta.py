"""Change detection, merge and run summary.

The snapshot holds the orders whose priority is known, so all orders without a specified priority
come in new; orders of status F come in with a changed price.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.config import CastSpec, DeltaSpec
from tabload.operators import cast, clean, dedup, delta, links
from tabload.queries import query, table
from tabload.session import shared_dir
from tabload.sinks.publish import SnapshotStore

SPEC = DeltaSpec(keys=("o_orderkey",))

_INPUT_SQL = """
    current_rows as (select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders
                     where o_orderpriority <> '4-NOT SPECIFIED'),
    incoming as (select o_orderkey, o_custkey, case when o_orderstatus = 'F' then o_totalprice + 1 else o_totalprice end
                        as o_totalprice from orders),
    classified as (
        select i.*, case when c.o_orderkey is null then 'insert'
                         when i.o_custkey is distinct from c.o_custkey
                              or round(cast(i.o_totalprice as decimal(30,10)), 4)
                                 is distinct from round(cast(c.o_totalprice as decimal(30,10)), 4) then 'update'
                         else 'same' end as op
        from incoming i left join current_rows c on i.o_orderkey = c.o_orderkey)"""


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").filter(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", price.alias("o_totalprice"))


def classified(spark: SparkSession, folder: str) -> DataFrame:
    return delta.classify(arrivals(spark, folder), snapshot(spark, folder), SPEC)


@query("delta_classify", f"with {_INPUT_SQL} select * from classified")
def delta_classify(spark: SparkSession, folder: str) -> DataFrame:
    return classified(spark, folder)


@query("delta_insert", f"with {_INPUT_SQL} select o_orderkey, o_custkey, o_totalprice from classified where op = 'insert'")
def delta_insert(spark: SparkSession, folder: str) -> DataFrame:
    return delta.inserts(classified(spark, folder), SPEC)


@query("delta_update", f"with {_INPUT_SQL} select o_orderkey, o_custkey, o_totalprice from classified where op = 'update'")
def delta_update(spark: SparkSession, folder: str) -> DataFrame:
    return delta.updates(classified(spark, folder), SPEC)


@query("delta_diff_outer", """
    select coalesce(i.o_orderkey, c.o_orderkey) as o_orderkey,
           case when i.o_orderkey is null then 'right_only'
                when c.o_orderkey is null or i.o_totalprice <> c.o_totalprice then 'left_only' else 'both' end as side
    from (select o_orderkey, case when o_orderstatus = 'F' then o_totalprice + 1 else o_totalprice end as o_totalprice
          from orders where o_orderpriority <> '5-LOW') i
    full join (select o_orderkey, o_totalprice from orders where o_orderpriority <> '4-NOT SPECIFIED') c
        on i.o_orderkey = c.o_orderkey""")
def delta_diff_outer(spark: SparkSession, folder: str) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    incoming = table(spark, folder, "orders").filter(F.col("o_orderpriority") != "5-LOW").select(
        "o_orderkey", price.alias("o_totalprice")
    )
    return delta.diff_report(incoming, snapshot(spark, folder), SPEC)


@query("merge_snapshot", f"""
    with {_INPUT_SQL}
    select coalesce(i.o_orderkey, c.o_orderkey) as o_orderkey, coalesce(i.o_custkey, c.o_custkey) as o_custkey,
           coalesce(i.o_totalprice, c.o_totalprice) as o_totalprice, c.o_orderpriority
    from incoming i full join current_rows c on i.o_orderkey = c.o_orderkey""")
def merge_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return delta.upsert(snapshot(spark, folder), arrivals(spark, folder), SPEC)


@query("merge_classified", f"""
    with {_INPUT_SQL}
    select c.o_orderkey, coalesce(i.o_custkey, c.o_custkey) as o_custkey,
           coalesce(i.o_totalprice, c.o_totalprice) as o_totalprice, c.o_orderpriority
    from current_rows c left join incoming i on i.o_orderkey = c.o_orderkey
    union all
    select o_orderkey, o_custkey, o_totalprice, null from classified where op = 'insert'""")
def merge_classified(spark: SparkSession, folder: str) -> DataFrame:
    return delta.merge_snapshot(snapshot(spark, folder), classified(spark, folder), SPEC)


@query("merge_snapshot_null_absent", f"""
    with {_INPUT_SQL}
    select i.o_orderkey, i.o_custkey, i.o_totalprice, case when op = 'same' then c.o_orderpriority end as o_orderpriority
    from classified i left join current_rows c on i.o_orderkey = c.o_orderkey""")
def merge_snapshot_null_absent(spark: SparkSession, folder: str) -> DataFrame:
    spec = DeltaSpec(keys=("o_orderkey",), absent_columns="null")
    return delta.upsert(snapshot(spark, folder), arrivals(spark, folder), spec)


@query("run_summary", f"""
    with {_INPUT_SQL}
    select 'orders' as table_name, op, count(*) as n_rows from classified group by op""")
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return delta.run_summary(classified(spark, folder), SPEC, "orders")


@query("run_summary_observed", f"""
    with {_INPUT_SQL}
    select 'orders' as table_name, op, count(*) as n_rows, (select count(*) from classified) as written from classified group by op""")
def run_summary_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts, gathered while the classified rows are written to a run's folder."""
    store = SnapshotStore(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")
    staged, counts = store.stage_counted(classified(spark, folder), "run", "changes/orders", **delta.op_metrics(SPEC.label))
    rows = [("orders", op, n) for op, n in counts.items() if n]
    summary = spark.createDataFrame(rows, "table_name string, op string, n_rows bigint")
    return summary.withColumn("written", staged.agg(F.count(F.lit(1)).alias("written")).scalar())


@query("orphan_check", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
    where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderpriority <> '4-NOT SPECIFIED')""")
def orphan_check(spark: SparkSession, folder: str) -> DataFrame:
    child = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return delta.orphans(child, snapshot(spark, folder), {"l_orderkey": "o_orderkey"})


@query("publish_validate", f"""
    with {_INPUT_SQL}
    select 'orders' as table_name, count(*) as n_rows, count(*) - count(distinct o_orderkey) as repeated_keys,
           count(*) filter (o_orderkey is null) as missing_keys
    from (select o_orderkey from current_rows union select o_orderkey from incoming)""")
def publish_validate(spark: SparkSession, folder: str) -> DataFrame:
    from tabload.sinks.publish import validate

    return validate(merge_snapshot(spark, folder), SPEC, "orders")


@query("link_table", """
    select distinct l_orderkey, item_id from lineitem join (
        select p_partkey, p_partkey + 1000 as item_id from part) on l_partkey = p_partkey
    where l_orderkey in (select o_orderkey from orders where o_orderpriority <> '4-NOT SPECIFIED')
      and not exists (select 1 from lineitem s where s.l_orderkey = lineitem.l_orderkey
                      and s.l_partkey = lineitem.l_partkey and s.l_returnflag = 'A')""")
def link_table(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    base = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), (F.col("p_partkey") + 1000).alias("item_id")
    )
    stored = lines.filter("l_returnflag = 'A'").select("l_orderkey", (F.col("l_partkey") + 1000).alias("item_id"))
    known = snapshot(spark, folder).select(F.col("o_orderkey").alias("l_orderkey"))
    return links.link_table(
        lines.select("l_orderkey", "l_partkey"), base, ["l_partkey"], ["l_orderkey", "item_id"], stored, known, "l_orderkey"
    )


@query("assign_surrogates", """
    select brand, type, (select coalesce(max(length(p_brand) * 7 + try_cast(p_brand[-1:] as integer)), 0) from part where p_type = 'PROMO')
                        + row_number() over (order by brand, type) as container_id
    from (select distinct p_brand as brand, p_type as type from part)
    where type <> 'PROMO'""")
def assign_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    containers = table(spark, folder, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    numbered = containers.filter("type = 'PROMO'").distinct()
    existing = numbered.withColumn("container_id", (F.length("brand") * 7 + F.substring("brand", -1, 1).try_cast("int")).cast("bigint"))
    return links.assign_surrogates(containers, existing, ["brand", "type"], "container_id")


@query("load_slice", f"""
    with landed as (
        select o_orderkey, o_custkey, version,
               case o_orderstatus when 'P' then null when 'F' then o_totalprice + version else o_totalprice end as price
        from orders, (values (1), (2)) v(version) where version = 1 or o_orderpriority = '1-URGENT'),
    latest as (select * from landed qualify row_number() over (partition by o_orderkey order by version desc) = 1),
    current_rows as (select o_orderkey, o_custkey, o_totalprice as price from orders
                     where o_orderpriority <> '4-NOT SPECIFIED')
    select 'orders' as table_name, op, count(*) as n_rows
    from (select case when c.o_orderkey is null then 'insert'
                      when l.o_custkey is distinct from c.o_custkey
                           or round(cast(l.price as decimal(30,10)), 4)
                              is distinct from round(cast(c.price as decimal(30,10)), 4) then 'update'
                      else 'same' end as op
          from latest l left join current_rows c on l.o_orderkey = c.o_orderkey)
    group by op""")
def load_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way of a table: null markers, typing, last version, classification, summary."""
    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")

    def landed(version: int) -> DataFrame:
        price = (
            F.when(status == "P", F.lit(" N/A")).when(status == "F", (F.col("o_totalprice") + version).cast("string"))
            .otherwise(F.col("o_totalprice").cast("string"))
        )
        return orders.select(
            F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
            price.alias("price"), F.lit(version).alias("version"), "o_orderpriority",
        )

    both = landed(1).unionByName(landed(2).filter("o_orderpriority = '1-URGENT'")).drop("o_orderpriority")
    spec = CastSpec({"o_orderkey": "INTEGER", "o_custkey": "INTEGER", "price": "DOUBLE", "version": "INTEGER"})
    typed = cast.schema_cast(clean.normalise_nulls(both), spec).drop(spec.reject_column)
    latest = dedup.last_value_first_version(typed, ["o_orderkey"], "version", [])
    current = snapshot(spark, folder).select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    return delta.run_summary(delta.classify(latest, current, SPEC), SPEC, "orders")


@query("orphan_split", f"""
    with {_INPUT_SQL}
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           case when l_orderkey % 7 = 0 or l_orderkey in (select o_orderkey from current_rows) then 'merged' else 'rejected' end as status
    from lineitem""")
def orphan_split(spark: SparkSession, folder: str) -> DataFrame:
    """Lines whose order is not in the snapshot are rejected; a line that names no order refers to none."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = lines.withColumn("order", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")))
    kept, lost = delta.split_orphans(rows, snapshot(spark, folder), {"order": "o_orderkey"})
    both = kept.withColumn("status", F.lit("merged")).unionByName(lost.withColumn("status", F.lit("rejected")))
    return both.drop("order")
