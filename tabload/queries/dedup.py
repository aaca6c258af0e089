"""Keep first or last, versions, latest values."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.operators import dedup, reshape
from tabload.queries import query, table

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]
LINE_COLUMNS = ["l_orderkey", *LINE_ORDER]
_LINE_ORDER_SQL = ", ".join(LINE_ORDER)
_LINE_ORDER_DESC_SQL = ", ".join(f"{name} desc" for name in LINE_ORDER)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*LINE_COLUMNS)


@query("keep_last", f"""
    select {", ".join(LINE_COLUMNS)} from lineitem
    qualify row_number() over (partition by l_orderkey order by {_LINE_ORDER_DESC_SQL}) = 1""")
def keep_last(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_last(_lines(spark, folder), ["l_orderkey"], LINE_ORDER)


@query("keep_first", f"""
    select {", ".join(LINE_COLUMNS)} from lineitem
    qualify row_number() over (partition by l_orderkey order by {_LINE_ORDER_SQL}) = 1""")
def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_first(_lines(spark, folder), ["l_orderkey"], LINE_ORDER)


@query("last_value_first_version", f"""
    with last as (
        select * from lineitem
        qualify row_number() over (partition by l_orderkey order by {_LINE_ORDER_DESC_SQL}) = 1)
    select last.l_orderkey, (select min(l_linenumber) from lineitem f where f.l_orderkey = last.l_orderkey) as l_linenumber,
           l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag
    from last""")
def last_value_first_version(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.last_value_first_version(
        _lines(spark, folder), ["l_orderkey"], "l_linenumber", LINE_ORDER[1:]
    )


@query("latest_value_broadcast", """
    select event_id, user_id,
           case when props like '%7%' then event_type
                else last_value(event_type) over (
                    partition by user_id, props like '%7%' order by ts, event_id
                    rows between unbounded preceding and unbounded following) end as event_type
    from events""")
def latest_value_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose properties hold a 7 stand for the exempt site: they neither count nor change."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "props")
    exempt = F.col("props").contains("7")
    harmonised = dedup.harmonise_latest(events, "user_id", "event_type", ["ts", "event_id"], exempt)
    return harmonised.select("event_id", "user_id", "event_type")


_UPPER_SQL = "case when value > 10 then upper(event_type) else event_type end"


def _mixed_case(spark: SparkSession, folder: str) -> DataFrame:
    shout = F.when(F.col("value") > 10, F.upper("event_type")).otherwise(F.col("event_type"))
    return table(spark, folder, "events").select("event_id", "ts", "user_id", shout.alias("event_type"))


@query("flag_superseded", f"""
    select event_id, user_id, event_type, cast(row_number() over (
               partition by user_id, lower(event_type) order by ts desc, event_id desc) > 1 as integer) as superseded
    from (select event_id, user_id, ts, {_UPPER_SQL} as event_type from events)""")
def flag_superseded(spark: SparkSession, folder: str) -> DataFrame:
    rows = _mixed_case(spark, folder).withColumn("status", F.lower("event_type"))
    flagged = dedup.flag_superseded(rows, ["user_id", "status"], ["ts", "event_id"], "superseded")
    return flagged.select("event_id", "user_id", "event_type", "superseded")


@query("duplicate_marker", """
    select conv_id, turn, role, cast(row_number() over (partition by conv_id, role order by turn desc) > 1 as integer)
           as duplicated
    from conversations""")
def duplicate_marker(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return dedup.flag_superseded(turns, ["conv_id", "role"], ["turn"], "duplicated")


@query("ci_dedup", f"""
    select event_id, user_id, event_type
    from (select event_id, user_id, ts, {_UPPER_SQL} as event_type from events)
    qualify row_number() over (partition by user_id, lower(event_type) order by ts, event_id) = 1""")
def ci_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup.keep_first_ignoring_case(_mixed_case(spark, folder), ["user_id"], "event_type", ["ts", "event_id"])
    return kept.select("event_id", "user_id", "event_type")


@query("latest_per_group", """
    select user_id, event_type, event_id, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""")
def latest_per_group(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return dedup.latest_per_group(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("max_per_group", """
    select l_partkey, max(l_orderkey) as last_order from lineitem group by l_partkey""")
def max_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.max_per_group(table(spark, folder, "lineitem"), ["l_partkey"], "l_orderkey", "last_order")


@query("distinct_values", "select distinct l_suppkey, l_returnflag from lineitem")
def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.distinct_rows(table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag"))


@query("distinct_rows", """
    select distinct o_orderkey, o_custkey, o_totalprice from (
        select o_orderkey, o_custkey, o_totalprice from orders
        union all select o_orderkey, o_custkey, o_totalprice from orders)""")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return dedup.distinct_rows(reshape.union_all([rows, rows]))
