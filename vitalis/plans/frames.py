"""Stand-in frames over the given tables, as Spark plans and as the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.plans.registry import table
from vitalis.session import spread

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def visits(spark: SparkSession, d: str) -> DataFrame:
    """One row per order with the person's region, balance and market segment."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    people = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, d, "region")
    return (
        orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "o_orderkey",
            F.col("r_name").alias("region"),
            F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no").alias("smoker"),
            F.col("c_acctbal").alias("bmi"),
            F.col("o_totalprice").alias("charges"),
        )
    )


VISITS_SQL = """
select o_orderkey, r_name as region, case when c_mktsegment = 'BUILDING' then 'yes' else 'no' end as smoker,
       c_acctbal as bmi, o_totalprice as charges
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
"""


def line_key() -> F.Column:
    return F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("bigint"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        F.unix_date(F.col("l_shipdate").cast("date")),
    )


LINE_KEY_SQL = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint), "
    "cast(round(l_extendedprice*100) as bigint), date_diff('day', date '1970-01-01', cast(l_shipdate as date)))"
)


def keyed_lines(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "lineitem")).withColumn("row_key", line_key())


def survey_rows(spark: SparkSession, d: str) -> DataFrame:
    """Persons with stratum, primary unit, weight, outcome (some missing), domain and factors."""
    people = table(spark, d, "customer")
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    key = F.col("c_custkey")
    return people.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.col("n_regionkey").alias("stratum"),
        F.col("n_nationkey").alias("psu"),
        (1 + key % 7).cast("double").alias("weight2"),
        F.when(key % 11 != 0, F.col("c_acctbal")).alias("y"),
        (F.col("c_acctbal") >= 0).alias("adult"),
        F.when(key % 2 == 0, "No").otherwise("Yes").alias("active"),
        F.when(key % 5 == 0, None).when(key % 3 == 0, "Yes").otherwise("No").alias("smoker"),
        F.col("c_mktsegment").alias("race"),
    )


SURVEY_SQL = """
select c_custkey, n_regionkey as stratum, n_nationkey as psu, cast(1 + c_custkey % 7 as double) as weight2,
       case when c_custkey % 11 <> 0 then c_acctbal end as y, c_acctbal >= 0 as adult,
       case when c_custkey % 2 = 0 then 'No' else 'Yes' end as active,
       case when c_custkey % 5 = 0 then null when c_custkey % 3 = 0 then 'Yes' else 'No' end as smoker,
       c_mktsegment as race, cast(1 + c_custkey % 7 as double) / 2 as w
from customer join nation on c_nationkey = n_nationkey
"""


def sensor_samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples of three channels per wearer in time order (``seq`` from 0), with the activity."""
    from vitalis.plans.ranks import ordered_rank

    events = table(spark, d, "events").select("event_id", "ts", "user_id", "value")
    ranked = ordered_rank(events, ["user_id"], "ts", "event_id", "seq")
    return ranked.select(
        "user_id",
        (F.col("user_id") % 10).alias("subject"),
        activity().alias("activity"),
        "seq",
        F.col("group_total").alias("n_samples"),
        "ts",
        "event_id",
        F.col("value").alias("accx"),
        (F.hour("ts") + F.minute("ts") / 60.0).alias("accy"),
        F.second("ts").cast("double").alias("accz"),
    )


def activity() -> F.Column:
    return F.element_at(F.array(F.lit("bike"), F.lit("run"), F.lit("walk")), (F.col("user_id") % 3 + 1).cast("int"))


SENSOR_SQL = """
select user_id, user_id % 10 as subject,
       case user_id % 3 when 0 then 'bike' when 1 then 'run' else 'walk' end as activity,
       row_number() over (partition by user_id order by ts, event_id) - 1 as seq,
       count(*) over (partition by user_id) as n_samples, ts, event_id, value as accx,
       hour(ts) + minute(ts) / 60.0::double as accy, cast(second(ts) as double) as accz
from events
"""


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Truth, a threshold prediction and a fold per line."""
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("truth"),
        F.when(F.col("l_quantity") <= 17, "A").when(F.col("l_quantity") <= 34, "N").otherwise("R").alias("pred"),
        (F.col("l_suppkey") % 5).alias("fold"),
    )


PREDICTIONS_SQL = """
select l_returnflag as truth, case when l_quantity <= 17 then 'A' when l_quantity <= 34 then 'N' else 'R' end as pred,
       l_suppkey % 5 as fold from lineitem
"""


def labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return docs.join(table(spark, d, "labels"), "doc_id").withColumn(
        "label", (F.col("quality") + 2 * F.col("toxic")).cast("int")
    )


LABELLED_SQL = """
select doc_id, text, lang, source, quality, toxic, cast(quality + 2 * toxic as integer) as label
from documents join labels using (doc_id)
"""
