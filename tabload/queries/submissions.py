"""Listing, routing and numbering of submissions; catalog; streaming."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload import config
from tabload.functions import text
from tabload.operators import clean, submissions
from tabload.queries import query, table
from tabload.sources import catalog as catalog_source

ROUTES = (("/en/", "english"), ("example.org", "org"), ("https://", "secure"))


@query("route_by_path", """
    select page_id, concat_ws(',', case when contains(url, '/en/') then 'english' end,
                              case when contains(url, 'example.org') then 'org' end,
                              case when contains(url, 'https://') then 'secure' end) as routes
    from pages""")
def route_by_path(spark: SparkSession, folder: str) -> DataFrame:
    routes = submissions.route_by_path(F.col("url"), ROUTES)
    return table(spark, folder, "pages").select("page_id", F.array_join(routes, ",").alias("routes"))


_INTENT_SQL = "case event_type when 'signup' then 'Create' when 'purchase' then 'Update' else event_type end"


def _intents(spark: SparkSession, folder: str) -> DataFrame:
    intent = text.recode(F.col("event_type"), {"signup": "Create", "purchase": "Update"})
    return table(spark, folder, "events").select("event_id", intent.alias("intent"))


@query("route_by_intent", f"""
    select * from (select event_id, {_INTENT_SQL} as intent from events) where intent in ('Create', 'Update')""")
def route_by_intent(spark: SparkSession, folder: str) -> DataFrame:
    return submissions.split_by_intent(_intents(spark, folder))[0]


@query("route_by_intent_rejects", f"""
    select * from (select event_id, {_INTENT_SQL} as intent from events) where intent not in ('Create', 'Update')""")
def route_by_intent_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return submissions.split_by_intent(_intents(spark, folder))[1]


@query("url_path_filter", """
    select page_id, url as path from pages where contains(url, '.example.com/en')""")
def url_path_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("path"))
    return submissions.select_paths(pages, "%2Eexample.com%2Fen")


@query("submission_listing", """
    select distinct regexp_replace(url, '/[^/]*$', '') as submission from pages
    where contains(url, 'example') and not starts_with(regexp_replace(url, '/[^/]*$', ''), 'http://blog')
      and not contains(regexp_replace(url, '/[^/]*$', ''), 'spam-farm')""")
def submission_listing(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("url")
    return submissions.list_submissions(pages, "url", "example", ("spam-farm",), "http://blog")


@query("submission_sequence", """
    with done as (select url, 7 as "Submission_Index" from pages where contains(url, '/fr/'))
    select url as submission, 7 + row_number() over (order by length(html), url) as "Submission_Index"
    from (select url, min(html) as html from pages group by url) p
    where url not in (select url from done)""")
def submission_sequence(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    listed = pages.groupBy(F.col("url").alias("submission")).agg(F.length(F.min("html")).alias("submitted_at"))
    done = pages.filter(F.col("url").contains("/fr/")).select(
        F.col("url").alias("submission"), F.lit(7).alias("Submission_Index")
    )
    return submissions.number_submissions(submissions.pending(listed, done), done).drop("submitted_at")


@query("catalog_fk_summary", """
    select table_name as "Table_Name", ordinal as "Column_Name", count(distinct target) as "Foreign_Key_Count",
           case when count(distinct target) = 1 then max(target) else 'None' end as "Foreign_Key_Table"
    from (select l_returnflag as table_name, 'column_' || l_linenumber as ordinal,
                 case when l_quantity >= 25 and l_linenumber < 6 then 'target_' || l_linestatus end as target
          from lineitem)
    group by table_name, ordinal""")
def catalog_fk_summary(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    name = F.concat(F.lit("column_"), "l_linenumber").alias("Column_Name")
    columns = lines.select(F.col("l_returnflag").alias("Table_Name"), name).distinct()
    referring = (F.col("l_quantity") >= 25) & (F.col("l_linenumber") < 6)
    usage = lines.select(
        F.col("l_returnflag").alias("Table_Name"), name,
        F.when(referring, F.concat(F.lit("target_"), "l_linestatus")).alias("Foreign_Key_Table"), F.lit("id").alias("Foreign_Key_Column"),
    ).filter(F.col("Foreign_Key_Table").isNotNull())
    summary = catalog_source.foreign_key_summary(columns, usage)
    return summary.select("Table_Name", "Column_Name", "Foreign_Key_Count", "Foreign_Key_Table")


@query("file_kind_alias", """
    select event_id, case event_type when 'click' then 'follow_up.csv' when 'view' then 'consumable.csv'
           when 'error' then 'secondary_confirmation_test_result.csv' else event_type || '.csv' end as kind
    from events""")
def file_kind_alias(spark: SparkSession, folder: str) -> DataFrame:
    name = text.recode(
        F.concat("event_type", F.lit(".csv")),
        {"click.csv": "followup.csv", "view.csv": "consumables.csv", "error.csv": "x_secondary_confirmation_2.csv"},
    )
    return table(spark, folder, "events").select("event_id", clean.kind_alias(name).alias("kind"))


@query("clean_chain", """
    select "Research_Participant_ID", "Cohort", "Comments" from (
        select c_name as "Research_Participant_ID",
               case c_mktsegment when 'BUILDING' then 'Transplant' when 'MACHINERY' then 'Healthy Control'
                    else c_mktsegment end as "Cohort",
               case when c_acctbal < 0 then 'Invalid data entry; do not include' when c_mktsegment = 'FURNITURE' then null
                    else 'a-b' end as "Comments"
        from customer where not exists (select 1 from nation where contains(c_name, '0' || n_nationkey || '9')))
    where "Comments" is distinct from 'Invalid data entry; do not include'""")
def clean_chain(spark: SparkSession, folder: str) -> DataFrame:
    from tabload.plans.clean import clean_landed

    segment = F.col("c_mktsegment")
    comment = (
        F.when(F.col("c_acctbal") < 0, config.EXCLUDED_COMMENTS[0]).when(segment == "FURNITURE", "N/A").otherwise("a–b")
    )
    landed = table(spark, folder, "customer").select(
        F.col("c_name").alias("Research_Participant_ID"),
        text.recode(segment, {"BUILDING": "Organ_Transplant", "MACHINERY": "Healthy_Control"}).alias("Cohort"),
        comment.alias("Comments"), F.lit(None).cast("string").alias("Unnamed: 3"),
    )
    listed = table(spark, folder, "nation").select(F.concat(F.lit("0"), "n_nationkey", F.lit("9")).alias("id"))
    return clean_landed(landed, config.CleanSpec(), listed)


@query("stream_ingest_equals_batch", "select event_id, user_id, event_type, value from events")
def stream_ingest_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Events landed as files in two column orders and ingested as a stream: the rows of the table."""
    from tabload.streaming.check import landed_and_streamed

    return landed_and_streamed(spark, table(spark, folder, "events"))
