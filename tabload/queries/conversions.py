"""Scalar conversions, casts and keys."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload import config
from tabload.config import CastSpec
from tabload.functions import dates, keys, numbers, text
from tabload.operators import cast, clean
from tabload.plans import tables
from tabload.queries import query, table

_EXACT = "decimal(30,10)"


@query("lenient_cast", f"""
    select o_orderkey, cast(round(try_cast(case said when 'Baseline(1)' then '1' when 'Not Reported' then null
                                           else said end as {_EXACT}), 5) as double) as number,
           said is not null and said <> 'Not Reported' and said <> 'Baseline(1)'
               and try_cast(said as {_EXACT}) is null as rejected
    from (select o_orderkey, case o_orderpriority when '5-LOW' then 'Baseline(1)' when '3-MEDIUM' then 'Not Reported'
                 when '2-HIGH' then o_orderpriority when '1-URGENT' then cast(o_custkey as varchar)
                 else printf('%.2f', o_totalprice) end as said
          from orders)""")
def lenient_cast(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    said = (
        F.when(priority == "5-LOW", "Baseline(1)").when(priority == "3-MEDIUM", "Not Reported")
        .when(priority == "2-HIGH", priority).when(priority == "1-URGENT", F.col("o_custkey").cast("string"))
        .otherwise(F.format_string("%.2f", "o_totalprice"))
    )
    rows = table(spark, folder, "orders").select("o_orderkey", said.alias("said"))
    typed = cast.schema_cast(rows.withColumnRenamed("said", "number"), CastSpec({"o_orderkey": "BIGINT", "number": "DOUBLE"}))
    return typed.select("o_orderkey", "number", F.array_contains("_bad", "number").alias("rejected"))


@query("mixed_cells", f"""
    select o_orderkey, case when price = 'Not Reported' then null else cast(round(try_cast(price as {_EXACT}), 5) as double) end as price,
           try_cast(custkey as bigint) as custkey,
           case when price <> 'Not Reported' and try_cast(price as {_EXACT}) is null then price end as price_told,
           case when try_cast(custkey as bigint) is null then custkey end as custkey_told
    from (select o_orderkey, case o_orderstatus when 'F' then 'C-' || o_custkey when 'P' then null else cast(o_custkey as varchar) end as custkey,
                 case o_orderpriority when '5-LOW' then 'Not Reported' when '2-HIGH' then 'about "' || o_custkey || '"' else printf('%.2f', o_totalprice) end as price
          from orders)""")
def mixed_cells(spark: SparkSession, folder: str) -> DataFrame:
    """What does not fit the type of its column is kept beside it."""
    status, priority, customer = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_custkey").cast("string")
    landed = table(spark, folder, "orders").select(
        "o_orderkey", F.when(status == "F", F.concat(F.lit("C-"), customer)).when(status != "P", customer).alias("custkey"),
        F.when(priority == "5-LOW", "Not Reported").when(priority == "2-HIGH", F.concat(F.lit('about "'), customer, F.lit('"')))
        .otherwise(F.format_string("%.2f", "o_totalprice")).alias("price"),
    )
    typed = cast.schema_cast(landed, CastSpec({"o_orderkey": "BIGINT", "custkey": "INTEGER", "price": "DOUBLE"}), "mixed")
    told = lambda name: F.try_variant_get("mixed", f"$.{name}", "string").alias(f"{name}_told")
    return typed.select("o_orderkey", "price", "custkey", told("price"), told("custkey"))


@query("schema_cast", f"""
    select o_orderkey, case when custkey in ('N/A') then null else try_cast(custkey as bigint) end as custkey,
           cast(round(try_cast(price as {_EXACT}), 5) as double) as price,
           day, status,
           concat_ws(',', case when custkey <> 'N/A' and try_cast(custkey as bigint) is null then 'custkey' end,
                          case when price <> 'Not Reported' and try_cast(price as {_EXACT}) is null then 'price' end)
               as bad
    from (select cast(o_orderkey as varchar) as o_orderkey,
                 case o_orderstatus when 'P' then 'N/A' when 'F' then 'C-' || o_custkey
                      else cast(o_custkey as varchar) end as custkey,
                 case o_orderpriority when '5-LOW' then 'Not Reported' when '2-HIGH' then 'high'
                      else printf('%.2f', o_totalprice) end as price,
                 strftime(o_orderdate, '%Y-%m-%d') as day, o_orderstatus as status
          from orders)""")
def schema_cast(spark: SparkSession, folder: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    customer = F.col("o_custkey").cast("string")
    landed = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(status == "P", "N/A").when(status == "F", F.concat(F.lit("C-"), customer)).otherwise(customer).alias("custkey"),
        F.when(priority == "5-LOW", "Not Reported").when(priority == "2-HIGH", "high")
        .otherwise(F.format_string("%.2f", "o_totalprice")).alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        status.alias("status"),
    )
    spec = CastSpec({"custkey": "INTEGER", "price": "DOUBLE", "status": "VARCHAR(255)"})
    typed = cast.schema_cast(landed, spec)
    return typed.withColumn("bad", F.array_join("_bad", ",")).drop("_bad")


@query("round_measure", f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           cast(round(cast(l_extendedprice / 7 as {_EXACT}), 1) as double) as one_decimal,
           cast(round(cast(l_extendedprice as {_EXACT}), 0) as double) as whole
    from lineitem""")
def round_measure(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.round_half_up(F.col("l_extendedprice") / 7, 1).alias("one_decimal"),
        numbers.round_measure(F.format_string("%.2f", "l_extendedprice"), 0).alias("whole"),
    )


@query("top_coded", """
    select p_partkey, cast(p_size as double) as size, p_size >= 45 as top_coded from part""")
def top_coded(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    said = F.when(F.col("p_size") >= 45, F.concat(size, F.lit("+"))).otherwise(size)
    rows = table(spark, folder, "part").select("p_partkey", said.alias("said"))
    return rows.select(
        "p_partkey", numbers.round_measure(F.col("said")).alias("size"), numbers.is_top_coded(F.col("said")).alias("top_coded")
    )


@query("numeric_canonical", f"""
    select event_id, cast(round(try_cast(case said when 'Not Reported' then null else said end as {_EXACT}), 4) as double)
           as value
    from (select event_id, case event_type when 'error' then 'Not Reported' when 'signup' then 'none'
                 else cast(value as varchar) end as said from events)""")
def numeric_canonical(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    said = F.when(kind == "error", "Not Reported").when(kind == "signup", "none").otherwise(F.col("value").cast("string"))
    rows = table(spark, folder, "events").select("event_id", said.alias("value"))
    return rows.withColumn("value", numbers.compare_form(F.col("value")))


@query("sci_format", r"""
    select p_partkey, regexp_replace(printf('%.2E', p_retailprice), 'E([+-])0', 'E\1') as price,
           case p_type when 'PROMO' then '1.00E+0'
                else regexp_replace(printf('%.2E', cast(p_size as double)), 'E([+-])0', 'E\1') end as dilution
    from part""")
def sci_format(spark: SparkSession, folder: str) -> DataFrame:
    said = F.when(F.col("p_type") == "PROMO", "none").otherwise(F.col("p_size").cast("string"))
    return table(spark, folder, "part").select(
        "p_partkey", numbers.scientific(F.col("p_retailprice")).alias("price"), numbers.dilution(said).alias("dilution")
    )


@query("censored_value", """
    select event_id, case when event_type in ('error', 'signup') then null else round(value, 2) end as value,
           case event_type when 'view' then 'below' when 'purchase' then 'above' when 'error' then 'qualitative'
                when 'signup' then 'qualitative' end as censor
    from events""")
def censored_value(spark: SparkSession, folder: str) -> DataFrame:
    kind, shown = F.col("event_type"), F.col("value").cast("string")
    said = (
        F.when(kind == "view", F.concat(F.lit("<"), shown)).when(kind == "purchase", F.concat(F.lit(">"), shown))
        .when(kind == "error", "Nonreactive").when(kind == "signup", "Reactive").otherwise(shown)
    )
    rows = table(spark, folder, "events").select("event_id", said.alias("said"))
    return rows.select(
        "event_id",
        numbers.round_half_up(numbers.uncensor(F.col("said")), 2).alias("value"),
        numbers.censor_flag(F.col("said")).alias("censor"),
    )


@query("band_values", """
    select p_partkey, case when p_size < 18.5 then 'Underweight' when p_size < 25 then 'Normal Weight'
           when p_size < 30 then 'Overweight' when p_size < 35 then 'Class 1 Obesity'
           when p_size < 40 then 'Class 2 Obesity' else 'Class 3 Obesity' end as band
    from part""")
def band_values(spark: SparkSession, folder: str) -> DataFrame:
    size = numbers.round_measure(F.col("p_size"), 1)
    return table(spark, folder, "part").select(
        "p_partkey", numbers.band(size, config.BMI_BANDS, F.lit("none")).alias("band")
    )


@query("row_mean", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0))
                 / nullif((a is not null)::int + (b is not null)::int + (c is not null)::int, 0), 6) as mean
    from (select *, case when l_returnflag = 'A' then l_quantity end as a,
                 case when l_linestatus = 'F' then cast(l_partkey as double) end as b,
                 case when l_discount > 0.05 then cast(l_suppkey as double) end as c from lineitem)""")
def row_mean(spark: SparkSession, folder: str) -> DataFrame:
    first = F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))
    second = F.when(F.col("l_linestatus") == "F", F.col("l_partkey"))
    third = F.when(F.col("l_discount") > 0.05, F.col("l_suppkey"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(numbers.row_mean(first, second, third), 6).alias("mean"),
    )


@query("seconds_to_time", """
    select event_id, strftime(make_timestamp((user_id * 997 % 86400) * 1000000), '%H:%M:%S') as clock from events""")
def seconds_to_time(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", dates.seconds_to_time(F.col("user_id") * 997).alias("clock")
    )


@query("parse_dates", """
    select o_orderkey, case when o_orderpriority = '3-MEDIUM' or strftime(o_orderdate, '%Y-%m-%d') = '2000-01-01'
                                 and o_orderstatus = 'O' then null
                            else strftime(o_orderdate, '%Y-%m-%d') end as day
    from orders""")
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    said = (
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "not a date")
        .when((status == "F") & (F.col("o_orderpriority") == "1-URGENT"), F.date_format(day, "M/d/yy"))
        .when(status == "F", F.date_format(day, "M/d/yyyy")).when(status == "P", F.date_format(day, "yyyy-MM-dd 13:05:09"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    rows = table(spark, folder, "orders").select("o_orderkey", said.alias("said"))
    return rows.select("o_orderkey", F.date_format(dates.parse_date(F.col("said")), "yyyy-MM-dd").alias("day"))


@query("whole_number_exact", """
    select o_orderkey, 9007199254740992 + o_orderkey as big, o_custkey % 3 = 0 as rejected,
           case when o_custkey % 3 <> 0 then cast(o_custkey as bigint) end as whole
    from orders""")
def whole_number_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Keys beyond 2^53, whole numbers with a zero fraction, and fractions, which are rejected."""
    customer = F.col("o_custkey")
    landed = table(spark, folder, "orders").select(
        "o_orderkey", (F.lit(2**53) + F.col("o_orderkey")).cast("string").alias("big"),
        F.concat(customer.cast("string"), F.when(customer % 3 == 0, ".25").otherwise(".0")).alias("whole"),
    )
    typed = cast.schema_cast(landed, CastSpec({"o_orderkey": "BIGINT", "big": "BIGINT", "whole": "INTEGER"}))
    return typed.select("o_orderkey", "big", "whole", F.array_contains("_bad", "whole").alias("rejected"))


@query("decimal_exact", """
    select o_orderkey, cast(cast(9007199254740993 + o_orderkey as varchar) || '.125' as varchar) as price
    from orders""")
def decimal_exact(spark: SparkSession, folder: str) -> DataFrame:
    said = F.concat((F.lit(2**53 + 1) + F.col("o_orderkey")).cast("string"), F.lit(".1250"))
    landed = table(spark, folder, "orders").select("o_orderkey", said.alias("price"))
    typed = cast.schema_cast(landed, CastSpec({"o_orderkey": "BIGINT", "price": "DECIMAL(25, 3)"}))
    return typed.select("o_orderkey", F.col("price").cast("string").alias("price"))


@query("parse_two_formats", """
    select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as submitted_at from events""")
def parse_two_formats(spark: SparkSession, folder: str) -> DataFrame:
    part = F.when(F.col("event_type").isin("view", "click"), F.date_format("ts", "HH-mm-ss-MM-dd-yyyy")).otherwise(
        F.date_format("ts", "yyyy-MM-dd-HH-mm-ss")
    )
    parsed = dates.submission_time(F.col("part"))
    rows = table(spark, folder, "events").select("event_id", part.alias("part"))
    return rows.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("submitted_at"))


@query("zero_pad_suffix", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           printf('%02d_%06d_%03d_', l_suppkey % 100, l_orderkey % 1000000, l_partkey % 1000)
           || case when l_returnflag = 'R' and l_quantity < 5 then cast(100 + l_linenumber as varchar)
                   when l_returnflag = 'R' then cast(10 + l_linenumber as varchar) else printf('%02d', l_linenumber) end as aliquot_id,
           l_returnflag = 'R' and l_quantity < 5 as rejected
    from lineitem""")
def zero_pad_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of one, two and three digits, some with text after them."""
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    three = (flag == "R") & (F.col("l_quantity") < 5)
    digits = lambda value, size: F.lpad(value.cast("string"), size, "0")
    number = F.when(three, line + 100).when(flag == "R", line + 10).otherwise(line).cast("string")
    tail = F.when((flag == "A") | three, "").when(flag == "N", " ml").otherwise("x")
    said = F.concat(
        digits(F.col("l_suppkey") % 100, 2), F.lit("_"), digits(F.col("l_orderkey") % 1000000, 6), F.lit("_"),
        digits(F.col("l_partkey") % 1000, 3), F.lit("_"), number, tail,
    )
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", said.alias("said"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.pad_aliquot_id(F.col("said")).alias("aliquot_id"),
        text.has_third_digit(F.col("said")).alias("rejected"),
    )


@query("composite_key", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           'P' || l_orderkey || ' : ' || case when l_returnflag = 'A' then 'B' else 'F' end
           || case when l_quantity < 10 then '0' || cast(l_quantity as bigint) else cast(cast(l_quantity as bigint) as varchar) end
               as visit_id
    from lineitem""")
def composite_key(spark: SparkSession, folder: str) -> DataFrame:
    visit_type = F.when(F.col("l_returnflag") == "A", "Baseline").otherwise("Follow_up")
    said = F.col("l_quantity").cast("string")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        keys.visit_key(F.concat(F.lit("P"), "l_orderkey"), visit_type, said).alias("visit_id"),
    )


@query("id_prefix", """
    select c_custkey, substr(c_name, 1, 2) as site, substr(c_name, 1, 7) || ' 0001' as parent_id from customer""")
def id_prefix(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, folder, "customer").select(
        "c_custkey", text.site_prefix(name).alias("site"), text.parent_id(name).alias("parent_id")
    )


@query("visit_number", r"""
    select conv_id, turn, case when role = 'system' then '1' when role = 'user' then cast(turn as varchar)
           else 'Unscheduled' end as visit from conversations""")
def visit_number(spark: SparkSession, folder: str) -> DataFrame:
    role = F.col("role")
    said = F.when(role == "system", "Baseline(1)").when(role == "user", F.format_string("%02d", "turn")).otherwise("Unscheduled")
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", keys.visit_number(said).alias("visit")
    )


@query("surrogate_key", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           md5(length(cast(l_orderkey as varchar)) || ':' || l_orderkey
               || length(cast(l_linenumber as varchar)) || ':' || l_linenumber
               || length(cast(l_partkey as varchar)) || ':' || l_partkey
               || length(cast(l_suppkey as varchar)) || ':' || l_suppkey) as row_key
    from lineitem""")
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, folder, "lineitem").select(*names, keys.hash_key(*[F.col(c) for c in names]).alias("row_key"))


@query("conform_to_schema", """
    select c_custkey, c_name, c_mktsegment, substr(c_name, 1, 2) as "Submission_CBC" from customer""")
def conform_to_schema(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    coded = customers.withColumn("Submission_CBC", text.site_prefix(F.col("c_name")))
    return clean.conform(coded, ["c_custkey", "c_name", "c_mktsegment", "c_comment", "Submission_CBC"])


@query("volume_cleanup", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           case when l_returnflag = 'N' then 0 else l_quantity end as volume
    from lineitem""")
def volume_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    said = F.when(F.col("l_returnflag") == "N", "N/A").otherwise(F.col("l_quantity").cast("string"))
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", said.alias("Aliquot_Volume")
    )
    cleaned = tables.prepare_kind("aliquot.csv", rows.withColumn("Aliquot_ID", F.lit(None).cast("string"))).drop("Aliquot_ID")
    return cleaned.withColumn("Aliquot_Volume", numbers.lenient_number(F.col("Aliquot_Volume"))).withColumnRenamed("Aliquot_Volume", "volume")
