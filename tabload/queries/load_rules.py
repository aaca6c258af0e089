"""Rules of the load plans, run over columns derived from the driver tables."""

import uuid
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload import config
from tabload.config import DeltaSpec
from tabload.operators import delta
from tabload.plans import load, tables
from tabload.queries import query, table
from tabload.session import shared_dir
from tabload.sources.catalog import Catalog, Entry
from tabload.sources.delimited import MALFORMED_COLUMN, SHORT_COLUMN, read_delimited

_CATALOG = Catalog((
    Entry("Participant_Visit_Info", "Visit_Info_ID", "VARCHAR(50)", primary=True),
    Entry("Participant_Visit_Info", "Research_Participant_ID", "VARCHAR(9)"),
    Entry("Participant_Visit_Info", "Visit_Number", "VARCHAR(15)"),
    Entry("Participant_Visit_Info", "BMI", "FLOAT"),
    Entry("CBC", "CBC_ID", "INTEGER", primary=True),
    Entry("CBC", "CBC_Name", "VARCHAR(50)"),
))


def _run(current=None) -> SimpleNamespace:
    """What the rules need of a run: the catalog, current tables, and a place for rejects."""
    job = SimpleNamespace(catalog=_CATALOG, mapping={"follow_up.csv": ["Participant_Visit_Info"]}, excluded_keys={})
    rejected: list[tuple[DataFrame, str, str]] = []
    return SimpleNamespace(
        job=job, current=(current or {}).__getitem__, stage=lambda rows, part: rows, rejected=rejected,
        reject=lambda rows, source, reason: rejected.append((rows, source, reason)),
    )


_SPECIMEN_SQL = """
    select 'V' || (l_orderkey % 500) as "Visit_Info_ID", 'S' || (l_partkey % 40) as "Biospecimen_ID",
           l_quantity as "Biospecimen_Collection_Date_Duration_From_Index", l_orderkey as a, l_linenumber as b, l_suppkey as c,
           l_extendedprice as d, l_partkey as e
    from lineitem"""


def _specimens(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("V"), (F.col("l_orderkey") % 500).cast("string")).alias("Visit_Info_ID"),
        F.concat(F.lit("S"), (F.col("l_partkey") % 40).cast("string")).alias("Biospecimen_ID"),
        F.col("l_quantity").alias("Biospecimen_Collection_Date_Duration_From_Index"), F.col("l_orderkey").alias("a"),
        F.col("l_linenumber").alias("b"), F.col("l_suppkey").alias("c"), F.col("l_extendedprice").alias("d"), F.col("l_partkey").alias("e"),
    )


@query("specimen_rules", f"""
    select * from ({_SPECIMEN_SQL})
    qualify row_number() over (partition by "Visit_Info_ID", "Biospecimen_ID"
        order by "Biospecimen_Collection_Date_Duration_From_Index" desc, a desc, b desc, c desc, d desc, e desc) = 1""")
def specimen_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Before the comparison: one specimen per visit, the latest."""
    return tables.apply_table_rules("Biospecimen", _specimens(spark, folder))


@query("specimen_inserts", f"""
    select * from ({_SPECIMEN_SQL})
    qualify row_number() over (partition by "Biospecimen_ID" order by "Visit_Info_ID" desc,
        "Biospecimen_Collection_Date_Duration_From_Index" desc, a desc, b desc, c desc, d desc, e desc) = 1""")
def specimen_inserts(spark: SparkSession, folder: str) -> DataFrame:
    """New specimens: one per id."""
    return tables.insert_rules(_run().job, "Biospecimen", _specimens(spark, folder))


_TREATMENT_SQL = """
    select 'V' || (l_orderkey % 200) as "Visit_Info_ID", l_shipmode as "Health_Condition_Or_Disease",
           case when l_linenumber % 2 = 0 then upper(l_returnflag) else lower(l_returnflag) end as "Treatment",
           cast(l_linenumber % 3 as varchar) as "Dosage", 'mg' as "Dosage_Units", l_orderkey as a, l_linenumber as b, l_partkey as c, l_suppkey as d
    from (select *, 'C' || (l_suppkey % 5) as l_shipmode from lineitem)"""


def _treatments(spark: SparkSession, folder: str) -> DataFrame:
    even = F.col("l_linenumber") % 2 == 0
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("V"), (F.col("l_orderkey") % 200).cast("string")).alias("Visit_Info_ID"),
        F.concat(F.lit("C"), (F.col("l_suppkey") % 5).cast("string")).alias("Health_Condition_Or_Disease"),
        F.when(even, F.upper("l_returnflag")).otherwise(F.lower("l_returnflag")).alias("Treatment"),
        (F.col("l_linenumber") % 3).cast("string").alias("Dosage"), F.lit("mg").alias("Dosage_Units"),
        F.col("l_orderkey").alias("a"), F.col("l_linenumber").alias("b"), F.col("l_partkey").alias("c"), F.col("l_suppkey").alias("d"),
    )


@query("treatment_rules", f"""
    select * from ({_TREATMENT_SQL})
    qualify row_number() over (partition by "Visit_Info_ID", "Health_Condition_Or_Disease", lower("Treatment")
        order by "Treatment", "Dosage", "Dosage_Units", a, b, c, d) = 1""")
def treatment_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Before the comparison: a treatment once per visit and condition, whatever its case."""
    return tables.apply_table_rules("Treatment_History", _treatments(spark, folder))


@query("treatment_inserts", f"""
    select * from ({_TREATMENT_SQL})
    qualify row_number() over (partition by "Visit_Info_ID", "Health_Condition_Or_Disease", "Treatment", "Dosage", "Dosage_Units"
        order by a, b, c, d) = 1""")
def treatment_inserts(spark: SparkSession, folder: str) -> DataFrame:
    """New treatments: one per dosage."""
    return tables.insert_rules(_run().job, "Treatment_History", _treatments(spark, folder))


@query("secondary_confirmation", """
    select substr('00_' || c_custkey || '_x', 1, 7) || ' 0001' as "BSI_Parent_ID", '00_' || c_custkey || '_x' as "Subaliquot_ID",
           c_comment as "Confirmatory_Clinical_Test_Comments"
    from (select *, c_mktsegment as c_comment from customer)""")
def secondary_confirmation(spark: SparkSession, folder: str) -> DataFrame:
    """Parent id from the subaliquot, comments under the name of their table."""
    rows = table(spark, folder, "customer").select(
        F.concat(F.lit("00_"), F.col("c_custkey").cast("string"), F.lit("_x")).alias("Subaliquot_ID"), F.col("c_mktsegment").alias("Comments"),
    )
    kind = config.SECONDARY_CONFIRMATION_KIND
    return tables.apply_kind_rules(_run(), {kind: rows})[kind]


@query("submission_site_ids", """
    select event_id as "Submission_Index", strftime(ts, '%Y-%m-%d %H:%M:%S') as "Submission_Time", n_name as "Submission_CBC_Name",
           event_type as "Submission_File_Name", 'path/' || event_id as "Submission_S3_Path",
           strftime(ts, '%Y-%m-%d %H:%M:%S') as "Date_Submission_Validated", 'Create' as "Submission_Intent", cbc as "Submission_CBC_ID"
    from (select *, user_id % 30 as nation from events) left join nation on nation = n_nationkey
    left join (select n_name as known, n_nationkey + 100 as cbc from nation where n_regionkey <> 2) on known = n_name""")
def submission_site_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the Submission table, each with the id of its centre where the centre is known."""
    nations = table(spark, folder, "nation")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    named = events.withColumn("n_nationkey", F.col("user_id") % 30).join(nations.select("n_nationkey", "n_name"), "n_nationkey", "left")
    pending = named.select(
        F.col("event_id").alias("Submission_Index"), F.date_trunc("second", "ts").alias("submitted_at"), F.col("n_name").alias("site_name"),
        F.col("event_type").alias("file_name"), F.concat(F.lit("path/"), F.col("event_id").cast("string")).alias("submission"),
        F.col("ts").alias("validated_at"), F.lit("Create").alias("intent"),
    )
    centres = nations.filter("n_regionkey <> 2").select((F.col("n_nationkey") + 100).alias("CBC_ID"), F.col("n_name").alias("CBC_Name"))
    return load.submission_rows(_run({"CBC": centres}), pending)


@query("version_visits", """
    with landed as (
        select 'P' || (l_orderkey % 300) as who, case l_returnflag when 'A' then null when 'N' then 'HIV' else 'Cancer' end as cohort,
               cast(1 + l_linenumber % 4 as varchar) as visit, l_orderkey * 8 + l_linenumber as version, l_quantity as bmi
        from lineitem where l_orderkey * 8 + l_linenumber is not null
        qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey) = 1),
    kept as (select * from landed where cohort is not null),
    same as (select who, last_value(cohort) over (partition by who order by version rows between unbounded preceding and unbounded following) as cohort,
                    visit, version, bmi from kept)
    select who || ' : F0' || visit as "Visit_Info_ID", who as "Research_Participant_ID", any_value(cohort) as "Cohort", visit as "Visit_Number",
           min(version) as "Submission_Index", cast(round(arg_max(bmi, version), 1) as double) as "BMI"
    from same group by who, visit""")
def version_visits(spark: SparkSession, folder: str) -> DataFrame:
    """A file kind from texts to one row per key: no cohort, no row; the key of the kind's table; one cohort per participant."""
    lines = table(spark, folder, "lineitem")
    one = lines.groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.struct("l_partkey", "l_suppkey", "l_returnflag", "l_quantity")).alias("line")
    )
    cohort = F.when(F.col("line.l_returnflag") == "N", "HIV").when(F.col("line.l_returnflag") != "A", "Cancer")
    rows = one.select(
        F.concat(F.lit("P"), (F.col("l_orderkey") % 300).cast("string")).alias("Research_Participant_ID"), cohort.alias("Cohort"),
        (1 + F.col("l_linenumber") % 4).cast("string").alias("Visit_Number"), F.col("line.l_quantity").cast("string").alias("BMI"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("Submission_Index"),
    )
    found = tables.version_kind(_run(), "follow_up.csv", rows)
    return found.select("Visit_Info_ID", "Research_Participant_ID", "Cohort", "Visit_Number", "Submission_Index", "BMI")


@query("resolve_visits", """
    select conv_id, turn, case when known is null then 'rejected' else 'resolved' end as status, known as "Visit_Info_ID"
    from (select conv_id, turn, 'P' || (conv_id % 50) as who, cast(turn as varchar) as visit from conversations)
    left join (select distinct 'P' || (conv_id % 50) as p, cast(turn as varchar) as v, 'P' || (conv_id % 50) || ' : ' || turn as known
               from conversations where turn % 3 <> 0) on p = who and v = visit""")
def resolve_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Rows take the key of their visit by participant and number; rows without a visit are rejected."""
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("P"), (F.col("conv_id") % 50).cast("string")).alias("Research_Participant_ID"),
        F.lpad(F.col("turn").cast("string"), 3, "0").alias("Visit_Number"),
    )
    number = F.col("turn").cast("string")
    visits = turns.filter("turn % 3 <> 0").select(
        F.concat("Research_Participant_ID", F.lit(" : "), number).alias("Visit_Info_ID"), "Research_Participant_ID", number.alias("Visit_Number"),
    ).distinct()
    run = _run({tables.VISIT_TABLE: visits})
    found = tables.resolve_visits(run, "Biospecimen", "biospecimen.csv", turns)
    lost = run.rejected[0][0].withColumn("Visit_Info_ID", F.lit(None).cast("string"))
    return found.withColumn("status", F.lit("resolved")).unionByName(lost.withColumn("status", F.lit("rejected"))).select(
        "conv_id", "turn", "status", "Visit_Info_ID"
    )


_VERSIONS_SQL = """
    select i.o_orderkey, case when c.o_orderkey is null then 'insert' when i.version < c.version then 'stale'
                              when i.version > c.version then 'update'
                              when i.price is distinct from c.price then 'update' else 'same' end as op
    from (select o_orderkey, o_totalprice + case when o_orderstatus = 'F' then 1 else 0 end as price, o_custkey % 3 as version,
                 'new' as "Data_Release_Version" from orders) i
    left join (select o_orderkey, o_totalprice as price, 1 as version, 'old' as "Data_Release_Version" from orders
               where o_orderpriority is distinct from '4-NOT SPECIFIED') c on i.o_orderkey = c.o_orderkey"""


def _versions(spark: SparkSession, folder: str, few_keys: bool) -> DataFrame:
    """Versions lower than the current one are stale; the release of the data is never compared."""
    orders = table(spark, folder, "orders")
    current = orders.filter(~F.col("o_orderpriority").eqNullSafe("4-NOT SPECIFIED")).select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.lit(1).cast("bigint").alias("version"), F.lit("old").alias("Data_Release_Version")
    )
    incoming = orders.select(
        "o_orderkey", (F.col("o_totalprice") + F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("price"),
        (F.col("o_custkey") % 3).cast("bigint").alias("version"), F.lit("new").alias("Data_Release_Version"),
    )
    spec = DeltaSpec(keys=("o_orderkey",), version="version")
    return delta.classify(incoming, current, spec, few_keys).select("o_orderkey", "op")


@query("delta_versions", _VERSIONS_SQL)
def delta_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _versions(spark, folder, few_keys=False)


@query("delta_versions_few", _VERSIONS_SQL)
def delta_versions_few(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the incoming keys broadcast; they are one per order, checked before they are."""
    from tabload.operators.joins import fits_broadcast

    return _versions(spark, folder, fits_broadcast(table(spark, folder, "orders").select("o_orderkey")))


@query("malformed_split", """
    select c_custkey, case when c_custkey % 5 = 0 then 'rejected' when c_custkey % 7 = 0 then 'short' else 'loaded' end as status,
           case when c_custkey % 5 <> 0 then c_name end as name, case when c_custkey % 5 <> 0 and c_custkey % 7 <> 0 then c_mktsegment end as segment
    from customer""")
def malformed_split(spark: SparkSession, folder: str) -> DataFrame:
    """Landed lines with a cell too many are rejected, lines with one too few lack their last cell."""
    key = F.col("c_custkey")
    last = F.when(key % 5 == 0, F.concat(F.lit(","), "c_mktsegment", F.lit(",x"))).when(key % 7 == 0, "").otherwise(
        F.concat(F.lit(","), "c_mktsegment")
    )
    lines = table(spark, folder, "customer").select(
        F.concat(key.cast("string"), F.lit(',"'), "c_name", F.lit('"'), last).alias("line"), F.floor(key / 1000).alias("file")
    )
    files = lines.groupBy("file").agg(F.concat(F.lit("c_custkey,name,segment\n"), F.array_join(F.collect_list("line"), "\n")).alias("value"))
    root = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    files.repartition("file").write.partitionBy("file").text(root)  # a file holds a thousand keys
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(root)
    rows = read_delimited(listed.select("path"))
    bad, short = F.col(MALFORMED_COLUMN), F.col(SHORT_COLUMN)
    kept = bad.isNull()
    return rows.select(
        F.when(kept, F.col("c_custkey")).otherwise(F.substring_index(bad, ",", 1)).cast("bigint").alias("c_custkey"),
        F.when(~kept, "rejected").when(short.isNotNull(), "short").otherwise("loaded").alias("status"),
        F.when(kept, F.col("name")).alias("name"), F.when(kept, F.col("segment")).alias("segment"),
    )
