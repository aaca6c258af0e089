"""Reference bundles and lab items, from files that Spark lands from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabload import config
from tabload.operators.reshape import union_all
from tabload.plans import tables
from tabload.plans.jobs import bundle_of
from tabload.queries import query, table
from tabload.queries.references import new_run
from tabload.session import shared_dir
from tabload.sources.catalog import Catalog, Entry
from tabload.sources.lines import read_lines
from tabload.sources.listing import list_files
from tabload.sources.tables import kinds_of, read_mapping


def land(lines: DataFrame, line: Column, header: str, path: str) -> None:
    """Write lines as delimited files just as they are, each below the header line."""
    raw = lines.select(line.alias(header))
    raw.write.mode("append").option("header", "true").option("sep", "\u0001").option("quote", "\u0002").csv(path)


def new_landing(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"


def text_of(name: str) -> Column:
    return F.col(name).cast("string")


@query("bundle_malformed_split", """
    select 'C' || c_custkey as cohort, case when c_custkey % 7 <> 0 then c_mktsegment end as index_date,
           case when c_custkey % 7 <> 0 then 'Site_' || (c_custkey % 3) end as site,
           case when c_custkey % 7 = 0 then 'line has too many cells' else 'loaded' end as status
    from customer""")
def bundle_malformed_split(spark: SparkSession, folder: str) -> DataFrame:
    """Study designs of three sites: the site is part of the path, lines with a cell too many are rejected."""
    root, customers = new_landing(spark), table(spark, folder, "customer")
    extra = F.when(F.col("c_custkey") % 7 == 0, ",x").otherwise("")
    line = F.concat(F.lit("C"), text_of("c_custkey"), F.lit(","), "c_mktsegment", extra)
    for site in range(3):
        land(customers.filter(F.col("c_custkey") % 3 == site), line, "Cohort_Name,Index_Date",
             f"{root}/Study/Site_{site}/{config.JOB_FOLDERS['study_design']}design")
    rejects: list[DataFrame] = []
    (rows,) = bundle_of("study_design", list_files(spark, root, "*.csv"), config.JOB_FOLDERS["study_design"], "", None, rejects).values()
    loaded = rows.select(F.col("Cohort_Name").alias("cohort"), F.col("Index_Date").alias("index_date"), F.col("CBC_Name").alias("site"), F.lit("loaded").alias("status"))
    none = F.lit(None).cast("string")
    lost = union_all(rejects).select(
        F.get_json_object("record", "$.Cohort_Name").alias("cohort"), none.alias("index_date"), none.alias("site"), F.col("reason").alias("status")
    )
    return loaded.unionByName(lost)


@query("panel_results_landed", """
    with children as (
        select 'B' || c_custkey as "Biorepository_ID", 'S' || c_custkey as sub, case when c_custkey % 2 = 0 then 'FD' || c_custkey end as cgr
        from customer where c_custkey % 5 <> 0),
    results as (select case when o_custkey % 4 = 0 then 'FD' || o_custkey else 'S' || o_custkey end as id, cast(o_orderkey as varchar) as result from orders)
    select id, result, "Biorepository_ID" as repository, case when "Biorepository_ID" is null then 'no such aliquot in the repository' else 'loaded' end as status
    from results left join children on case when id like '%FD%' or id like '%FS%' then cgr else sub end = id""")
def panel_results_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Panel results below the job's folder meet the repository's ids by either of two columns; files elsewhere are not read."""
    root, orders = new_landing(spark), table(spark, folder, "orders")
    ident = F.concat(F.when(F.col("o_custkey") % 4 == 0, "FD").otherwise("S"), text_of("o_custkey"))
    land(orders, F.concat(ident, F.lit(","), text_of("o_orderkey")), "Subaliquot_ID,Result", f"{root}/{config.JOB_FOLDERS['panel_results']}one")
    land(orders.limit(5), text_of("o_orderkey"), "Cohort_Name", f"{root}/Study/Site_1/elsewhere")
    customer = F.col("c_custkey").cast("string")
    children = table(spark, folder, "customer").filter("c_custkey % 5 <> 0").select(
        F.concat(F.lit("B"), customer).alias("Biorepository_ID"), F.concat(F.lit("S"), customer).alias("Subaliquot_ID"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("FD"), customer)).alias("CGR_Aliquot_ID"),
    )
    rejects: list[DataFrame] = []
    (rows,) = bundle_of("panel_results", list_files(spark, root, "*.csv"), config.JOB_FOLDERS["panel_results"], "", children, rejects).values()
    told = orders.select(ident.alias("id"), text_of("o_orderkey").alias("Result"))
    loaded = rows.join(told, "Result").filter((F.col("id") == F.col("CGR_Aliquot_ID")) | (F.col("id") == F.col("Subaliquot_ID"))).select(
        "id", F.col("Result").alias("result"), F.col("Biorepository_ID").alias("repository"), F.lit("loaded").alias("status")
    )
    lost = union_all(rejects).select(
        F.get_json_object("record", "$.Subaliquot_ID").alias("id"), F.get_json_object("record", "$.Result").alias("result"),
        F.lit(None).cast("string").alias("repository"), F.col("reason").alias("status"),
    )
    return loaded.unionByName(lost)


@query("repository_maps_landed", """
    select 'parent' as sheet, 'B' || c_custkey as id, c_name as told from customer
    union all
    select 'child', 'B' || o_custkey, case when o_orderkey % 3 = 0 then 'N/A' else cast(o_orderkey as varchar) end from orders where o_orderkey % 11 <> 0""")
def repository_maps_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Two sheets of one workbook, each landed as a folder of part files; their texts stay as they are, lines that do not fit are left out."""
    root = f"{new_landing(spark)}"
    book = f"{root}/{config.JOB_FOLDERS['biorepository_map']}map.xlsx"
    land(table(spark, folder, "customer"), F.concat(F.lit("B"), text_of("c_custkey"), F.lit(","), "c_name"), "Biorepository_ID,Name", f"{book}/BSI_Parent_Aliquots.csv")
    order = F.col("o_orderkey")
    cells = F.when(order % 3 == 0, "N/A").otherwise(text_of("o_orderkey"))
    line = F.concat(F.lit("B"), text_of("o_custkey"), F.lit(","), cells, F.when(order % 11 == 0, ",x").otherwise(""))
    land(table(spark, folder, "orders"), line, "Biorepository_ID,Number", f"{book}/BSI_Child_Aliquots.csv")
    found = bundle_of("biorepository_map", list_files(spark, root, "*.csv"), config.JOB_FOLDERS["biorepository_map"], "map.xlsx", None)
    parts = [
        found[f"bsi_{sheet}.csv"].select(F.lit(sheet).alias("sheet"), F.col("Biorepository_ID").alias("id"), F.col(told).alias("told"))
        for sheet, told in (("parent", "Name"), ("child", "Number"))
    ]
    return parts[0].unionByName(parts[1])


_LAB_CATALOG = Catalog((
    Entry("Equipment", "Equipment_Index", "INTEGER", primary=True, auto=True), Entry("Equipment", "Equipment_ID", "VARCHAR(20)"),
    Entry("Equipment", "Equipment_Type", "VARCHAR(50)"), Entry("Biospecimen", "Biospecimen_ID", "VARCHAR(20)", primary=True),
    Entry("Biospecimen_Equipment", "Biospecimen_ID", "VARCHAR(20)", primary=True), Entry("Biospecimen_Equipment", "Equipment_Index", "INTEGER", primary=True),
))


@query("lab_items", """
    with items as (select 'S' || l_orderkey as spec, 'E' || (l_suppkey % 20) as eid, trim(l_returnflag) as kind from lineitem),
    base as (select 'E' || s_suppkey as eid, flag as kind, min(s_suppkey * 3 + pos) as idx
             from supplier, (values ('A', 0), ('N', 1)) f(flag, pos) where s_suppkey < 20 group by all),
    held as (select 'S' || o_orderkey as spec, 3 * (o_custkey % 20) as idx from orders where o_orderkey % 4 = 0 and o_custkey is not null)
    select distinct spec as "Biospecimen_ID", idx as "Equipment_Index" from items join base using (eid, kind)
    where spec in (select 'S' || o_orderkey from orders where o_orderkey % 2 = 0)
    union
    select spec, idx from held""")
def lab_items(spark: SparkSession, folder: str) -> DataFrame:
    """Links of specimens to lab items by the items' attributes: new pairs of known specimens are added to the stored ones."""
    orders, suppliers = table(spark, folder, "orders"), table(spark, folder, "supplier").filter("s_suppkey < 20")
    base = union_all([
        suppliers.select((F.col("s_suppkey") * 3 + at).alias("Equipment_Index"), F.concat(F.lit("E"), text_of("s_suppkey")).alias("Equipment_ID"),
                         F.lit(kind).alias("Equipment_Type")) for at, kind in enumerate("AN")
    ])
    specimen = F.concat(F.lit("S"), text_of("o_orderkey")).alias("Biospecimen_ID")
    known = orders.filter("o_orderkey % 2 = 0").select(specimen).distinct()
    held = orders.filter("o_orderkey % 4 = 0 and o_custkey is not null").select(specimen, (3 * (F.col("o_custkey") % 20)).alias("Equipment_Index")).distinct()
    run = new_run(spark, _LAB_CATALOG, {"Equipment": base, "Biospecimen": known, "Biospecimen_Equipment": held}, {"equipment.csv": ["Equipment"]})
    items = table(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), text_of("l_orderkey")).alias("Biospecimen_ID"),
        F.concat(F.lit("E"), (F.col("l_suppkey") % 20).cast("string")).alias("Equipment_ID"),
        F.concat(F.lit(" "), "l_returnflag", F.lit(" ")).alias("Equipment_Type"), F.lit("x").alias("Comments"),
    )
    tables.load_links(run, "Equipment", {"equipment.csv": items})
    return run.current("Biospecimen_Equipment")


@query("landed_shapes", """
    select cast(o_orderkey as varchar) as "key", case when o_orderkey % 3 <> 1 then cast(o_custkey as varchar) end as "cust",
           case when o_orderkey % 3 <> 2 then o_orderstatus end as "status",
           case when o_orderkey % 3 = 2 and o_orderkey % 5 <> 0 then o_orderpriority end as "priority",
           case when o_orderkey % 3 = 2 and o_orderkey % 5 = 0 then 'short' else 'whole' end as line
    from orders""")
def landed_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Files of three header shapes in one scan; every fifth order has a line without its last cell."""
    root, orders = new_landing(spark), table(spark, folder, "orders")
    key, cust, status = text_of("o_orderkey"), F.coalesce(text_of("o_custkey"), F.lit("")), F.coalesce("o_orderstatus", F.lit(""))
    last = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit(","), F.coalesce("o_orderpriority", F.lit(""))))
    shapes = {
        "key,cust,status": F.concat_ws(",", key, cust, status), "status,key": F.concat_ws(",", status, key),
        "cust,key,priority": F.concat(cust, F.lit(","), key, last),
    }
    for at, (header, line) in enumerate(shapes.items()):
        land(orders.filter(F.col("o_orderkey") % 3 == at), line, header, f"{root}/part {at}")
    files = list_files(spark, root, "*.csv").withColumn("kind", F.lit("orders.csv"))
    rows = read_lines(spark, root, files)["orders.csv"]
    return rows.select("key", "cust", "status", "priority", F.when(F.col("_short").isNull(), "whole").otherwise("short").alias("line"))


@query("kind_mapping_landed", """
    with mapping as (
        select n_nationkey as kind, r_name as target_table from nation join region on n_regionkey = r_regionkey
        union all select n_nationkey, 'From_' || left(n_name, 1) from nation)
    select target_table, count(*) as n_rows from mapping join customer on kind = c_nationkey group by target_table""")
def kind_mapping_landed(spark: SparkSession, folder: str) -> DataFrame:
    """A mapping landed as JSON rows sends the customers of a nation to two tables each."""
    path, nation = f"{new_landing(spark)}/mapping.json", table(spark, folder, "nation")
    kind = F.concat(text_of("n_nationkey"), F.lit(".csv")).alias("file_kind")
    placed = nation.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = placed.select(kind, F.col("r_name").alias("target_table"))
    rows.unionByName(nation.select(kind, F.concat(F.lit("From_"), F.left("n_name", F.lit(1))).alias("target_table"))).write.json(path)
    mapping = read_mapping(spark, path)
    targets = sorted({target for found in mapping.values() for target in found})
    pairs = [(target, fed) for target in targets for fed in kinds_of(mapping, target)]
    fed = spark.createDataFrame(pairs, "target_table string, file_kind string")
    customers = table(spark, folder, "customer").select(F.concat(text_of("c_nationkey"), F.lit(".csv")).alias("file_kind"))
    return customers.groupBy("file_kind").count().join(fed, "file_kind").groupBy("target_table").agg(F.sum("count").alias("n_rows"))


@query("assay_bundle_landed", f"""
    with assays as (
        select c_custkey as k, lpad(cast(c_custkey % 100 as varchar), 2, '0') || '_' || lpad(cast(c_custkey % 1000 as varchar), 3, '0') as id
        from customer where c_custkey % 7 <> 0)
    select 'assay_data.csv' as kind, id, case when k % 4 = 0 then '{config.NO_DATA_PROVIDED}' else 'N' || k end as told, 'O' || (k % 5) as more from assays
    union all
    select 'assay_qc.csv', id, case when k % 3 = 0 then '{config.NO_DATA_PROVIDED}' else 'Q' || k end, case when k % 2 = 0 then '' else 'c' || k end from assays""")
def assay_bundle_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Assays of three sites from the newer of two workbooks each, and their quality control; ids that do not fit are left out.

    A sheet of a workbook is one file.
    """
    root, customers = new_landing(spark), table(spark, folder, "customer")
    key = F.col("c_custkey")
    fits = F.concat_ws("_", F.lpad((key % 100).cast("string"), 2, "0"), F.lpad((key % 1000).cast("string"), 3, "0"))
    name = F.when(key % 7 == 0, "Template").otherwise(fits)

    def cell(blank: Column, mark: str) -> Column:
        return F.when(blank, "").otherwise(F.concat(F.lit(mark), text_of("c_custkey")))

    organism = F.concat(F.lit("O"), (key % 5).cast("string"))
    for site in range(3):
        own, place = customers.filter(key % 3 == site).coalesce(1), f"{root}/{config.JOB_FOLDERS['assay_data']}Site_{site}"
        header = "Assay_ID,Calibration_Type,Target_Organism"
        land(own, F.concat_ws(",", name, F.lit("older"), organism), header, f"{place}/assay_1.xlsx")
        land(own, F.concat_ws(",", name, cell(key % 4 == 0, "N"), organism), header, f"{place}/assay_2.xlsx")
        land(own, F.concat_ws(",", name, cell(key % 3 == 0, "Q"), cell(key % 2 == 0, "c")), "Assay_ID,QC,Comments", f"{place}/assay_qc.xlsx")
    found = bundle_of("assay_data", list_files(spark, root, "*.csv"), config.JOB_FOLDERS["assay_data"], "", None)
    columns = {"assay_data.csv": ("Calibration_Type", "Assay_Target_Organism"), "assay_qc.csv": ("QC", "Comments")}
    parts = [
        found[kind].select(F.lit(kind).alias("kind"), F.col("Assay_ID").alias("id"), F.col(told).alias("told"), F.col(more).alias("more"))
        for kind, (told, more) in columns.items()
    ]
    return parts[0].unionByName(parts[1])
