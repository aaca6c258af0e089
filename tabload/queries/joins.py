"""Enrichment, lookups, set operations and reshaping."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.operators import joins, reshape
from tabload.queries import query, table


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment"
    )


@query("inner_enrich", """
    select o_orderkey, o_custkey, o_totalprice, o_orderstatus, c_name, c_nationkey, c_mktsegment
    from orders join customer on o_custkey = c_custkey where c_mktsegment <> 'BUILDING'""")
def inner_enrich(spark: SparkSession, folder: str) -> DataFrame:
    visits = _customers(spark, folder).filter(F.col("c_mktsegment") != "BUILDING")
    return joins.resolve_or_reject(_orders(spark, folder), visits, ["o_custkey"])[0]


@query("inner_enrich_rejects", """
    select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders
    where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')""")
def inner_enrich_rejects(spark: SparkSession, folder: str) -> DataFrame:
    visits = _customers(spark, folder).filter(F.col("c_mktsegment") != "BUILDING")
    return joins.resolve_or_reject(_orders(spark, folder), visits, ["o_custkey"])[1]


@query("left_enrich", """
    select distinct o_custkey, o_orderstatus, segment
    from orders left join (select c_custkey, c_mktsegment as segment from customer where c_acctbal > 0)
         on o_custkey = c_custkey""")
def left_enrich(spark: SparkSession, folder: str) -> DataFrame:
    base = _orders(spark, folder).select("o_custkey", "o_orderstatus")
    provenance = table(spark, folder, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
    )
    return joins.enrich_distinct(base, provenance)


@query("lookup_surrogate", """
    with container as (select brand, type, md5(coalesce(length(brand) || ':' || brand, '~')
                                               || length(type) || ':' || type) as container_id
                       from (select nullif(p_brand, 'Brand#1') as brand, p_type as type
                             from part group by all having max(p_size) > 5))
    select p_partkey, p.brand, p.type, container_id, container_id is not null as found
    from (select p_partkey, nullif(p_brand, 'Brand#1') as brand, p_type as type from part) p
    left join container c on p.brand is not distinct from c.brand and p.type = c.type""")
def lookup_surrogate(spark: SparkSession, folder: str) -> DataFrame:
    from tabload.functions.keys import hash_key

    parts = table(spark, folder, "part").select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("brand"), F.col("p_type").alias("type"), "p_size"
    )
    containers = parts.groupBy("brand", "type").agg(F.max("p_size").alias("largest")).filter("largest > 5").drop("largest")
    keyed = containers.withColumn("container_id", hash_key(F.col("brand"), F.col("type")))
    return joins.lookup(parts.drop("p_size"), keyed, ["brand", "type"], "found")


@query("split_route_join", """
    select o_orderkey, o_orderstatus, c_name as name from orders join customer on o_custkey = c_custkey
    where o_orderstatus = 'F'
    union all
    select o_orderkey, o_orderstatus, n_name as name from orders join nation on o_custkey % 25 = n_nationkey
    where o_orderstatus <> 'F'""")
def split_route_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderstatus").withColumn(
        "nation", (F.col("o_custkey") % 25).cast("int")
    )
    customers = _customers(spark, folder).select("o_custkey", F.col("c_name").alias("name"))
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))
    routed = joins.split_route(rows, F.col("o_orderstatus") == "F", customers, ["o_custkey"], nations, ["nation"])
    return routed.select("o_orderkey", "o_orderstatus", "name")


@query("found_indicator", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_size > 25, false) as found,
           case when p_size > 25 then p_brand end as p_brand
    from lineitem left join part on l_partkey = p_partkey""")
def found_indicator(spark: SparkSession, folder: str) -> DataFrame:
    dictionary = table(spark, folder, "part").filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.lookup(rows, dictionary, ["l_partkey"], "found")


@query("compare_stored", """
    select o_orderkey, o_orderstatus as status_code, stored as stored_status_code,
           case when held is null then 'missing' else 'different' end as status
    from (select o.o_orderkey, o.o_orderstatus, s.stored, s.held from orders o
          left join (select o_orderkey, case when o_totalprice > 250000 then 'F' else o_orderstatus end as stored, 1 as held
                     from orders where o_orderpriority <> '5-LOW') s on o.o_orderkey = s.o_orderkey)
    where held is null or o_orderstatus <> stored""")
def compare_stored(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    computed = orders.select("o_orderkey", F.col("o_orderstatus").alias("status_code"))
    held = F.when(F.col("o_totalprice") > 250000, "F").otherwise(F.col("o_orderstatus"))
    stored = orders.filter(F.col("o_orderpriority") != "5-LOW").select("o_orderkey", held.alias("status_code"))
    return joins.compare_stored(computed, stored, ["o_orderkey"], "status_code")


@query("semi_known", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
    where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P')""")
def semi_known(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.semi(rows, known, ["l_orderkey"])


@query("anti_done", """
    select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')""")
def anti_done(spark: SparkSession, folder: str) -> DataFrame:
    done = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(table(spark, folder, "customer").select("c_custkey", "c_name"), done, ["c_custkey"])


@query("union_by_name", """
    select c_custkey as key, c_name as name, c_acctbal as balance, null as kind from customer
    union all select s_suppkey, s_name, s_acctbal, null from supplier
    union all select p_partkey, p_name, null, p_type from part""")
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    parts = table(spark, folder, "part").select(
        F.col("p_type").alias("kind"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    return reshape.union_all([customers, suppliers, parts])


@query("except_rows", """
    select * from (select o_orderkey, case when o_orderpriority = '5-LOW' then null else o_custkey end as who,
                          o_orderstatus from orders)
    except
    select * from (select o_orderkey, case when o_orderpriority = '5-LOW' then null else o_custkey end as who,
                          case when o_totalprice > 400000 then 'X' else o_orderstatus end from orders)""")
def except_rows(spark: SparkSession, folder: str) -> DataFrame:
    who = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("who")
    orders = table(spark, folder, "orders")
    left = orders.select("o_orderkey", who, "o_orderstatus")
    changed = F.when(F.col("o_totalprice") > 400000, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    return reshape.except_rows(left, orders.select("o_orderkey", who, changed))


@query("combine_intents", """
    select c_custkey, c_name, c_acctbal, null as c_mktsegment, 'Create' as intent from customer
    union all select c_custkey, c_name, null, c_mktsegment, 'Update' from customer""")
def combine_intents(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return reshape.combine_intents(
        customers.select("c_custkey", "c_name", "c_acctbal"), customers.select("c_custkey", "c_mktsegment", "c_name")
    )


@query("unpivot_flags", """
    with flags as (
        select p_partkey, p_type, case when p_size < 10 then 'Yes' else 'No' end as serum,
               case when p_size between 20 and 30 then 'Yes' when p_size <= 40 then 'No' end as plasma,
               case when p_retailprice > 950 then 'Yes' end as "Lavage_Fluid" from part)
    select p_partkey, p_type, "Target_Biospecimen_Type", "Is_Present"
    from (unpivot flags on serum, plasma, "Lavage_Fluid" into name "Target_Biospecimen_Type" value "Is_Present")
    where "Is_Present" = 'Yes'""")
def unpivot_flags(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    flags = table(spark, folder, "part").select(
        "p_partkey", "p_type",
        F.when(size < 10, "Yes").otherwise("No").alias("Target_biospecimen_is_serum"),
        F.when(size.between(20, 30), "Yes").when(size <= 40, "No").alias("Target_biospecimen_is_plasma"),
        F.when(F.col("p_retailprice") > 950, "Yes").alias("Target_biospecimen_is_Lavage/Fluid"),
    )
    return reshape.assay_targets(flags, ["serum", "plasma", "Lavage_Fluid"])


@query("crosstab", """
    select o_orderpriority, count(*) filter (o_orderstatus = 'F') as "F", count(*) filter (o_orderstatus = 'O') as "O",
           count(*) filter (o_orderstatus = 'P') as "P" from orders group by o_orderpriority""")
def crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.crosstab(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("tagged_union_latest", """
    select event_type as antibody, 'P' || user_id as patient, event_id, value from events where event_type is not null
    qualify row_number() over (partition by event_type, user_id order by ts desc, event_id desc) = 1""")
def tagged_union_latest(spark: SparkSession, folder: str) -> DataFrame:
    patient = F.concat(F.lit("P"), "user_id", F.when(F.col("value") > 10, " 9002").otherwise("")).alias("patient")
    events = table(spark, folder, "events").select("event_type", "ts", "event_id", "value", patient)
    kinds = sorted(row[0] for row in events.select("event_type").distinct().collect() if row[0] is not None)  # one sheet for each type
    sheets = {kind: events.filter(F.col("event_type") == kind).drop("event_type") for kind in kinds}
    tagged = reshape.tagged_union_latest(sheets, "antibody", "patient", " 9002", ["ts", "event_id"])
    return tagged.select("antibody", "patient", "event_id", "value")
