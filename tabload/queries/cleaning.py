"""Null markers, text clean-up and row filters."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload import config
from tabload.functions import nulls, text
from tabload.operators import clean
from tabload.plans import tables
from tabload.queries import query, table

# Dirt is derived from the values of the whole tables, so the oracle can rebuild it.
MARKED_SEGMENT = {
    "BUILDING": "N/A", "MACHINERY": " nan ", "FURNITURE": "", "HOUSEHOLD": "Not Reported",
}

_SEGMENT_SQL = """case c_mktsegment when 'BUILDING' then 'N/A' when 'MACHINERY' then ' nan '
    when 'FURNITURE' then '' when 'HOUSEHOLD' then 'Not Reported' else c_mktsegment end"""

_TOKENS_SQL = ", ".join(f"'{token}'" for token in config.NULL_TOKENS)


@query("null_tokens", f"""
    select c_custkey, case when trim(s) in ({_TOKENS_SQL}) then null else s end as segment,
           case when trim(c_name) in ({_TOKENS_SQL}) then null else c_name end as c_name
    from (select c_custkey, c_name, {_SEGMENT_SQL} as s from customer)""")
def null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    dirty = table(spark, folder, "customer").select(
        "c_custkey", "c_name", text.recode(F.col("c_mktsegment"), MARKED_SEGMENT).alias("segment")
    )
    return clean.normalise_nulls(dirty)


@query("sentinel_to_null", """
    select o_orderkey,
           case when price in (-1e9, -10000) then null else price end as price,
           case when day in ('2000-01-01', '0000-00-00') then null else day end as day,
           case when note in ('No Data', 'NAN') then null else note end as note
    from (select o_orderkey,
                 case o_orderstatus when 'P' then -1e9 when 'F' then -10000 else o_totalprice end as price,
                 strftime(o_orderdate, '%Y-%m-%d') as day,
                 case o_orderpriority when '5-LOW' then 'No Data' when '3-MEDIUM' then 'NAN'
                      else o_orderpriority end as note
          from orders)""")
def sentinel_to_null(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    price = F.when(status == "P", F.lit(-1e9)).when(status == "F", F.lit(-10000.0)).otherwise(F.col("o_totalprice"))
    note = text.recode(F.col("o_orderpriority"), {"5-LOW": "No Data", "3-MEDIUM": "NAN"})
    return orders.select(
        "o_orderkey",
        nulls.number_sentinel_to_null(price).alias("price"),
        nulls.date_text_to_null(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        nulls.text_sentinel_to_null(note).alias("note"),
    )


@query("fill_labels", """
    select o_orderkey, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'No Data Provided') as priority,
           coalesce(nullif(o_orderstatus, 'P'), 'N/A') as status
    from orders""")
def fill_labels(spark: SparkSession, folder: str) -> DataFrame:
    holes = table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    )
    return clean.fill_labels(holes, {"priority": config.NO_DATA_PROVIDED, "status": "N/A"})


@query("trim_all", r"""
    select doc_id, regexp_replace(chr(9) || '  ' || text || ' ' || chr(10), '^\s+|\s+$', '', 'g') as text,
           regexp_replace(' ' || source || chr(9), '^\s+|\s+$', '', 'g') as source
    from documents""")
def trim_all(spark: SparkSession, folder: str) -> DataFrame:
    padded = table(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lit("\t  "), "text", F.lit(" \n")).alias("text"),
        F.concat(F.lit(" "), "source", F.lit("\t")).alias("source"),
    )
    return clean.trim_all(padded)


@query("canonical_text", r"""
    select conv_id, turn, nullif(replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '''', ''), '') as text,
           nullif(replace(regexp_replace(case role when 'system' then ' '' ' else ' ' || role end,
                                         '^\s+|\s+$', '', 'g'), '''', ''), '') as role
    from conversations""")
def canonical_text(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    role = F.when(F.col("role") == "system", F.lit(" ' ")).otherwise(F.concat(F.lit(" "), "role"))
    return clean.canonical_text(turns.select("conv_id", "turn", "text", role.alias("role")))


@query("strip_trailing_zero", r"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           regexp_replace(printf('%.1f', l_quantity), '\.0$', '') as quantity,
           regexp_replace(printf('%.2f', l_extendedprice), '\.0$', '') as price
    from lineitem""")
def strip_trailing_zero(spark: SparkSession, folder: str) -> DataFrame:
    shown = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.format_string("%.1f", "l_quantity").alias("quantity"),
        F.format_string("%.2f", "l_extendedprice").alias("price"),
    )
    return clean.strip_trailing_zeros(shown)


@query("recode_values", """
    select p_partkey, case p_type when 'PROMO' then 'Promotion' when 'ECONOMY' then 'Low Cost' else p_type end as p_type,
           case p_brand when 'Brand#1' then 'House' else p_brand end as p_brand
    from part""")
def recode_values(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_brand")
    return clean.recode_columns(
        parts, {"p_type": {"PROMO": "Promotion", "ECONOMY": "Low Cost"}, "p_brand": {"Brand#1": "House"}}
    )


@query("regex_strip", r"""
    select page_id, regexp_replace(url, '[?#].*$', '') as bare_url,
           replace(regexp_replace(url, '^https?://', ''), '/', '_') as flat_url
    from pages""")
def regex_strip(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id",
        text.remove(F.col("url"), "[?#].*$").alias("bare_url"),
        F.translate(text.remove(F.col("url"), "^https?://"), "/", "_").alias("flat_url"),
    )


@query("dash_normalise", """
    select doc_id, replace(replace(text, ',', '–'), '–', '-') as text, lang from documents""")
def dash_normalise(spark: SparkSession, folder: str) -> DataFrame:
    dashed = table(spark, folder, "documents").select("doc_id", F.replace(F.col("text"), F.lit(","), F.lit("–")).alias("text"), "lang")
    return clean.normalise_dashes(dashed)


@query("drop_blank_rows", """
    select * from (
        select o_orderkey, case when o_orderstatus <> 'P' then o_orderpriority else '' end as priority,
               case when o_orderpriority <> '5-LOW' then o_totalprice end as price from orders)
    where nullif(priority, '') is not null or price is not null""")
def drop_blank_rows(spark: SparkSession, folder: str) -> DataFrame:
    holes = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise("").alias("priority"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
    )
    return clean.drop_blank_rows(holes, ignore=("o_orderkey",))


@query("drop_constant_rows", """
    select p_partkey, first_word, second_word, type_word from (
        select p_partkey, case when p_size > 25 then p_type else lower(p_type) end as first_word,
               p_type as second_word, nullif(p_type, 'SMALL') as type_word from part)
    where not coalesce(first_word = second_word and first_word = type_word, false)""")
def drop_constant_rows(spark: SparkSession, folder: str) -> DataFrame:
    words = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lower("p_type")).alias("first_word"),
        F.col("p_type").alias("second_word"),
        F.nullif("p_type", F.lit("SMALL")).alias("type_word"),
    )
    return clean.drop_constant_rows(words, ("first_word", "second_word", "type_word"))


@query("exclude_marked", """
    select event_id, event_type, "comment" from (
        select event_id, event_type, case event_type when 'error' then 'Invalid data entry; do not include'
               when 'view' then null else 'ok' end as "comment" from events)
    where coalesce("comment" <> 'Invalid data entry; do not include', true)""")
def exclude_marked(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    comment = F.when(kind == "error", config.EXCLUDED_COMMENTS[0]).when(kind != "view", "ok")
    return clean.exclude_marked(
        table(spark, folder, "events").select("event_id", "event_type", comment.alias("comment")), "comment"
    )


@query("require_not_null", """
    select * from (select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment,
                          case when c_acctbal >= 0 then c_acctbal end as balance from customer)
    where segment is not null and balance is not null""")
def require_not_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    return clean.require(rows, "segment", "balance")


@query("id_pattern_filter", """
    select * from (select p_partkey, replace(p_brand, 'Brand#', '') || '_' || (p_size + 95) as assay_id from part)
    where regexp_matches(assay_id, '^[0-9]{2}_[0-9]{3}$')""")
def id_pattern_filter(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(text.remove(F.col("p_brand"), "Brand#"), F.lit("_"), F.col("p_size") + 95).alias("assay_id"),
    )
    return clean.keep_matching_ids(ids, "assay_id", config.ASSAY_ID_PATTERN)


@query("exclude_ids_substring", """
    select c_custkey, c_name from customer c
    where not exists (select 1 from nation n where contains(c.c_name, '0' || n.n_nationkey || '9'))""")
def exclude_ids_substring(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "nation").select(F.concat(F.lit("0"), "n_nationkey", F.lit("9")).alias("piece"))
    names = table(spark, folder, "customer").select("c_custkey", "c_name")
    return clean.exclude_containing(names, ["c_name"], listed, "piece")


@query("exclude_ids_grams", """
    with ids as (select c_custkey, 'id-' || md5(cast(c_custkey as varchar)) as id from customer),
    listed as (select distinct substr(md5(cast(o_orderkey as varchar)), 1, cast(2 + o_orderkey % 20 as int)) as piece from orders where o_orderkey % 20 > 2 or o_orderkey % 1000 = 0)
    select c_custkey, id from ids where id is not null and not exists (select 1 from listed where contains(id, piece))""")
def exclude_ids_grams(spark: SparkSession, folder: str) -> DataFrame:
    """Thousands of listed pieces of twenty lengths against all ids."""
    order = F.col("o_orderkey")
    text = F.md5(order.cast("string").cast("binary"))
    listed = table(spark, folder, "orders").filter((order % 20 > 2) | (order % 1000 == 0)).select(
        F.substring(text, F.lit(1), (2 + order % 20).cast("int")).alias("piece")
    )
    ids = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("id-"), F.md5(F.col("c_custkey").cast("string").cast("binary"))).alias("id")
    )
    return clean.exclude_by_grams(ids, ["id"], listed, "piece")


@query("exclude_keys", """
    select o_orderkey, o_custkey, o_totalprice from orders
    where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal < 0)""")
def exclude_keys(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return clean.exclude_keys(rows, listed, ["o_custkey"])


@query("exclude_pairs", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint) as quantity
    from lineitem where not exists (
        select 1 from part where p_partkey = l_partkey and p_size = cast(l_quantity as bigint))""")
def exclude_pairs(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("bigint").alias("quantity")
    )
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return clean.exclude_keys(rows, listed, ["l_partkey", "quantity"])


@query("require_label", """
    select * from (select o_orderkey, case o_orderpriority when '5-LOW' then '0' when '3-MEDIUM' then null
                          else o_orderpriority end as label from orders)
    where label is not null and label <> '0'""")
def require_label(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    label = F.when(priority == "5-LOW", "0").when(priority != "3-MEDIUM", priority)
    return clean.require_label(table(spark, folder, "orders").select("o_orderkey", label.alias("label")), "label")


@query("blank_comment", """
    select event_id, case when event_type in ('view', 'click') then null else event_type end as "Event_Comments"
    from events""")
def blank_comment(spark: SparkSession, folder: str) -> DataFrame:
    note = text.recode(F.col("event_type"), {"view": "N/A", "click": "No Data"})
    return clean.blank_comment(table(spark, folder, "events").select("event_id", note.alias("Event_Comments")))


@query("rename_columns", """
    select l_orderkey as "Order", l_linenumber as "Tube_Lot", l_partkey as "Tube_Type", l_suppkey as "Company"
    from lineitem""")
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("Order"), F.col("l_linenumber").alias("Collection_Tube_Lot"),
        F.col("l_partkey").alias("Aliquot_Tube_Type"), F.col("l_suppkey").alias("Unnamed_Company"),
    )
    parts = {"Collection_Tube": "Tube", "Aliquot_Tube": "Tube", "Unnamed_Company": "Company"}
    return clean.rename_by_part(rows, parts)


@query("derived_columns", """
    select event_id, event_type, '2.0.0' as "Data_Release_Version",
           case when contains(event_type, 'signup') then 'Baseline' else 'Follow_up' end as "Type_Of_Visit"
    from events""")
def derived_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "event_type", F.col("event_type").alias("Research_Participant_ID"), F.lit("2").alias("Visit_Number"),
        F.when(F.col("event_type").contains("signup"), "Yes").otherwise("No").alias("Baseline_Visit"),
    )
    visits = tables.add_visit(events, "follow_up.csv").withColumn("Data_Release_Version", F.lit(config.DATA_RELEASE))
    return visits.select("event_id", "event_type", "Data_Release_Version", "Type_Of_Visit")


@query("drop_unnamed_columns", "select p_partkey, p_name from part")
def drop_unnamed_columns(spark: SparkSession, folder: str) -> DataFrame:
    named = table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").alias("Unnamed: 1"), "p_name", F.col("p_type").alias("Unnamed: 3")
    )
    return clean.drop_unnamed_columns(named)
