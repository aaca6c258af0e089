"""Decision trees, conditional recodes and code lists."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.operators import rules
from tabload.queries import query, table

_STATUS_SQL = """case o_orderstatus when 'F' then 'Positive by PCR, Negative by Antigen'
    when 'O' then case when o_orderpriority = '1-URGENT' then 'No COVID event reported' else 'Negative by PCR' end
    else case when o_orderpriority = '5-LOW' then 'Pending' else 'Positive by PCR' end end"""
_SYMPTOM_SQL = """case o_orderpriority when '1-URGENT' then 'Yes' when '2-HIGH' then 'No'
    when '3-MEDIUM' then 'Unknown' when '5-LOW' then 'Yes' else 'Maybe' end"""


def _history(spark: SparkSession, folder: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    covid = (
        F.when(status == "F", "Positive by PCR, Negative by Antigen")
        .when((status == "O") & (priority == "1-URGENT"), "No COVID Event Reported")
        .when(status == "O", "Negative by PCR")
        .when(priority == "5-LOW", "Pending").otherwise("Positive by PCR")
    )
    symptomatic = (
        F.when(priority.isin("1-URGENT", "5-LOW"), "Yes").when(priority == "2-HIGH", "No")
        .when(priority == "3-MEDIUM", "Unknown").otherwise("Maybe")
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", covid.alias("COVID_Status"), symptomatic.alias("Symptomatic_COVID"),
        F.when(priority == "1-URGENT", "Unavailable").otherwise(F.format_string("V%d", F.col("o_custkey"))).alias("SARS-CoV-2_Variant"),
        F.when(status == "F", "Yes").otherwise("No").alias("Breakthrough_COVID"),
        F.lit("3").alias("Disease_Severity"), F.concat(F.lit("cough "), priority).alias("Symptoms"),
    )


_TREE_SQL = f"""
    select *, case when status in ('No COVID event reported', 'No COVID data collected') then 'none'
                   when contains(status, 'Negative') and not contains(status, 'Positive') then 'negative'
                   when contains(status, 'Positive') and symptomatic = 'Yes' then 'yes'
                   when contains(status, 'Positive') and symptomatic = 'No' then 'no'
                   when contains(status, 'Positive') and symptomatic = 'Unknown' then 'unknown' end as branch
    from (select *, {_STATUS_SQL} as status, {_SYMPTOM_SQL} as symptomatic,
                 case when o_orderpriority = '1-URGENT' then 'Unavailable' else 'V' || o_custkey end as variant,
                 case when o_orderstatus = 'F' then 'Yes' else 'No' end as breakthrough,
                 'cough ' || o_orderpriority as symptoms from orders)"""


@query("decision_tree", f"""
    select o_orderkey, status as "COVID_Status",
           case when branch in ('none', 'negative') then 'N/A' else symptomatic end as "Symptomatic_COVID",
           case when branch in ('none', 'negative') then 'N/A' when variant = 'Unavailable' then 'Unknown'
                else variant end as "SARS-CoV-2_Variant",
           case when branch in ('none', 'negative') then 'N/A' else breakthrough end as "Breakthrough_COVID",
           case branch when 'none' then 'Not Reported' when 'negative' then '0' when 'no' then '1' else '3' end
               as "Disease_Severity",
           case when branch in ('none', 'negative', 'no') then 'N/A' when branch = 'unknown' then 'No symptoms reported'
                else symptoms end as "Symptoms"
    from ({_TREE_SQL}) where branch is not null""")
def decision_tree(spark: SparkSession, folder: str) -> DataFrame:
    return rules.apply_covid_tree(_history(spark, folder))[0]


@query("decision_tree_rejects", f"""
    select o_orderkey, status as "COVID_Status", symptomatic as "Symptomatic_COVID" from ({_TREE_SQL}) where branch is null""")
def decision_tree_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejected = rules.apply_covid_tree(_history(spark, folder))[1]
    return rejected.select("o_orderkey", "COVID_Status", "Symptomatic_COVID")


@query("conditional_recode", """
    select o_orderkey, use as "Drug_Use",
           case when use = 'Not Reported' then 'Drug Type Not Reported'
                when use not in ('Never user', 'Current non-user') and (kind is null or kind = 'Unknown')
                then 'Drug Type Not Reported' else kind end as "Drug_Type"
    from (select o_orderkey, case o_orderstatus when 'F' then 'Not Reported' when 'O' then 'Never user'
                                  else 'Current user' end as use,
                 case o_orderpriority when '5-LOW' then 'Unknown' when '3-MEDIUM' then null else o_orderpriority end as kind
          from orders)""")
def conditional_recode(spark: SparkSession, folder: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(status == "F", "Not Reported").when(status == "O", "Never user").otherwise("Current user").alias("Drug_Use"),
        F.when(priority == "5-LOW", "Unknown").when(priority != "3-MEDIUM", priority).alias("Drug_Type"),
    )
    return rules.recode_drugs(rows)


@query("obesity_bands", """
    select c_custkey, case when said = 'Not Reported' then null when bmi >= 0 then bmi end as "BMI",
           case when said = 'Not Reported' or bmi < 0 then 'Not Reported'
                when bmi = 0 then 'as told' when bmi < 18.5 then 'Underweight' when bmi < 25 then 'Normal Weight'
                when bmi < 30 then 'Overweight' when bmi < 35 then 'Class 1 Obesity'
                when bmi < 40 then 'Class 2 Obesity' else 'Class 3 Obesity' end as "Obesity"
    from (select c_custkey, case when c_mktsegment = 'BUILDING' then 'Not Reported' end as said,
                 cast(round(cast(c_acctbal / 200 as decimal(30,10)), 1) as double) as bmi from customer)""")
def obesity_bands(spark: SparkSession, folder: str) -> DataFrame:
    bmi = F.when(F.col("c_mktsegment") == "BUILDING", "Not Reported").otherwise((F.col("c_acctbal") / 200).cast("string"))
    rows = table(spark, folder, "customer").select("c_custkey", bmi.alias("BMI"), F.lit("as told").alias("Obesity"))
    return rules.obesity_bands(rows)


@query("vaccination_flags", """
    select event_id, "Research_Participant_ID", "Vaccination_Status",
           case when event_type not in ('signup', 'error') and row_number() over (
                    partition by user_id, event_type in ('signup', 'error'),
                                 case when event_type = 'view' then 'click' else event_type end
                    order by "Vaccination_Status" desc, event_id desc) > 1
                then 'Record previously submitted: Duplicated.'
                else comment end as "Covid_Vaccination_Status_Comments"
    from (select event_id, user_id, event_type, 'P' || user_id as "Research_Participant_ID",
                 case event_type when 'signup' then 'Unvaccinated' when 'click' then 'Dose 1'
                      when 'view' then 'Dose 1:Bivalent' else 'Dose ' || event_type end as "Vaccination_Status",
                 case when event_type = 'error' then 'Record previously submitted in error.' end as comment
          from events)""")
def vaccination_flags(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "signup", "Unvaccinated").when(kind == "click", "Dose 1").when(kind == "view", "Dose 1:Bivalent")
        .otherwise(F.concat(F.lit("Dose "), kind))
    )
    rows = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("P"), "user_id").alias("Research_Participant_ID"), status.alias("Vaccination_Status"),
        F.when(kind == "error", "Record previously submitted in error.").alias("Covid_Vaccination_Status_Comments"),
    )
    return rules.flag_repeated_vaccinations(rows, ["Vaccination_Status", "event_id"])


@query("split_explode_lookup", """
    with term as (
        select distinct p_partkey, trim(unnest(string_split(replace(p_name, ' ', '|'), '|'))) as word from part),
    dictionary as (select distinct lower(p_type) as word, 'type word' as class from part
                   union select 'red', 'colour' union select 'blue', 'colour' union select 'small', 'size')
    select p_partkey, t.word, d.class, d.word is not null as found
    from term t left join (select word, min(class) as class from dictionary group by word) d on t.word = d.word""")
def split_explode_lookup(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    listed = parts.select("p_partkey", F.translate("p_name", " ", "|").alias("names"))
    own = spark.createDataFrame([("red", "colour"), ("blue", "colour"), ("small", "size")], "word string, class string")
    entries = parts.select(F.lower("p_type").alias("word"), F.lit("type word").alias("class")).unionByName(own)
    dictionary = entries.groupBy("word").agg(F.min("class").alias("class"))
    return rules.normalise_codes(listed, dictionary, "p_partkey", "names", "word", "found")


@query("assay_fill", """
    select p_partkey, case when p_type = 'PROMO' then 'No Data Provided' else p_type end as "Calibration_Type",
           case when p_brand = 'Brand#1' then 'No Data Provided' else p_brand end as brand,
           case when p_size > 25 then '' else p_name end as "Comments"
    from part""")
def assay_fill(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(
        F.col("p_partkey"),
        F.when(F.col("p_type") == "PROMO", "N/A").otherwise(F.col("p_type")).alias("Calibration_Type"),
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_size") <= 25, F.col("p_name")).alias("Comments"),
    )
    filled = rules.fill_assay_quality(rules.fill_calibration(rows))
    return filled.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))
