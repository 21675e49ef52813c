"""Selection, encoding, profiling, plot data, joins and set operations over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.operators import joins, profile, project
from vitalis.plans.frames import FEATURES, LABELLED_SQL, LINE_KEY_SQL, VISITS_SQL, keyed_lines, labelled_documents, visits
from vitalis.plans.frames import SURVEY_SQL, survey_rows
from vitalis.plans.registry import query, table


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


@query(
    "group_mean",
    f"""
    select region, round(avg(bmi), 4) + 0.0 as bmi, round(avg(charges), 4) + 0.0 as charges
    from ({VISITS_SQL}) group by region
    """,
)
def group_mean(spark, d):
    means = profile.group_mean(visits(spark, d), ["region"], exclude=["o_orderkey"])
    return rounded(means, 4, "bmi", "charges")


@query(
    "project_rename",
    "select o_orderkey as id, o_orderpriority as document, o_orderstatus as class from orders",
)
def project_rename(spark, d):
    return project.project_rename(
        table(spark, d, "orders"), {"o_orderkey": "id", "o_orderpriority": "document", "o_orderstatus": "class"}
    )


@query(
    "drop_target",
    "select l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag from lineitem",
)
def drop_target(spark, d):
    lines = table(spark, d, "lineitem")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_shipdate"]
    return project.split_target(lines, "l_returnflag", drop=keys)[1]


@query(
    "derive_arith",
    "select p_partkey, p_size / 365.0::double as years, p_retailprice / 2 as half_price from part",
)
def derive_arith(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        (F.col("p_size") / F.lit(365.0)).alias("years"),
        (F.col("p_retailprice") / 2).alias("half_price"),
    )


@query(
    "filter_compare",
    """
    select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem
    where l_quantity > 30 and l_discount >= 0.05 and l_tax > 0 and l_returnflag = 'R'
    """,
)
def filter_compare(spark, d):
    return (
        table(spark, d, "lineitem")
        .filter("l_quantity > 30 and l_discount >= 0.05 and l_tax > 0 and l_returnflag = 'R'")
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    )


@query(
    "filter_isin",
    "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH', ' 5-LOW')",
)
def filter_isin(spark, d):
    # the last name carries a blank the data does not have: membership is exact, it matches nothing
    return (
        table(spark, d, "orders")
        .filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", " 5-LOW"))
        .select("o_orderkey", "o_orderpriority")
    )


@query(
    "filter_notnull",
    """
    select l_orderkey, l_linenumber, nullif(l_discount, 0) as discount, nullif(l_tax, 0) as tax from lineitem
    where nullif(l_discount, 0) is not null and nullif(l_tax, 0) is not null
    """,
)
def filter_notnull(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
    )
    return project.not_missing(lines, ["discount", "tax"])


@query(
    "filter_group_size",
    """
    select doc_id, lang, source from documents
    where source || lang in (select source || lang from documents group by source || lang having count(*) > 7)
    """,
)
def filter_group_size(spark, d):
    docs = table(spark, d, "documents").withColumn("category", F.concat("source", "lang"))
    return project.filter_group_size(docs, "category", 7).select("doc_id", "lang", "source")


@query("head_by_key", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def head_by_key(spark, d):
    return project.head_by(table(spark, d, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 20).select(
        "o_orderkey", "o_totalprice"
    )


@query("row_at", "select c_custkey, c_acctbal from customer order by c_acctbal, c_custkey limit 1 offset 14")
def row_at(spark, d):
    return project.row_at(table(spark, d, "customer"), ["c_acctbal", "c_custkey"], 14).select("c_custkey", "c_acctbal")


@query(
    "sample_where",
    """
    select p_partkey, p_brand, p_size from part where p_size % 2 > 0
    order by md5(concat_ws('|', p_partkey, 'draw')), p_partkey limit 10
    """,
)
def sample_where(spark, d):
    drawn = project.sample_where(table(spark, d, "part"), F.col("p_size") % 2 > 0, 10, ["p_partkey"], "draw")
    return drawn.select("p_partkey", "p_brand", "p_size")


@query(
    "encode_binary",
    f"""
    select o_orderkey, case when smoker = 'no' then 0 else 1 end as smoker,
           case when nullif(region, 'ASIA') = 'AFRICA' then 0 else 1 end as region from ({VISITS_SQL})
    """,
)
def encode_binary(spark, d):
    return visits(spark, d).select(
        "o_orderkey",
        project.encode_binary("smoker", "no").alias("smoker"),
        project.encode_binary(F.nullif("region", F.lit("ASIA")), "AFRICA").alias("region"),
    )


# fixed class names of the labelled transcription table
CLASS_NAMES = {0: "Medical Records", 1: "Other", 2: "Internal Medicine", 3: "Surgery"}


@query(
    "map_labels",
    f"""
    select doc_id, case label when 0 then 'Medical Records' when 1 then 'Other' when 2 then 'Internal Medicine'
           when 3 then 'Surgery' end as class, case label when 0 then 'low' when 3 then 'high' end as partial
    from ({LABELLED_SQL})
    """,
)
def map_labels(spark, d):
    return labelled_documents(spark, d).select(
        "doc_id",
        project.map_labels("label", CLASS_NAMES, missing="error").alias("class"),
        project.map_labels("label", {0: "low", 3: "high"}).alias("partial"),
    )


@query(
    "collapse_labels",
    """
    select label, two_way, count(*) as n from (select l_returnflag as label, case l_returnflag when 'A' then 1
      when 'N' then 0 when 'R' then 0 end as two_way from lineitem) group by all
    """,
)
def collapse_labels(spark, d):
    return (
        table(spark, d, "lineitem")
        .select(F.col("l_returnflag").alias("label"), project.map_labels("l_returnflag", {"A": 1, "N": 0, "R": 0}).alias("two_way"))
        .groupBy("label", "two_way")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "one_hot_drop_first",
    """
    select c_custkey, cast(c_mktsegment = 'BUILDING' as integer) as "BUILDING",
           cast(c_mktsegment = 'FURNITURE' as integer) as "FURNITURE",
           cast(c_mktsegment = 'HOUSEHOLD' as integer) as "HOUSEHOLD",
           cast(c_mktsegment = 'MACHINERY' as integer) as "MACHINERY" from customer
    """,
)
def one_hot_drop_first(spark, d):
    return project.one_hot(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query(
    "label_vector",
    """
    select o_orderkey, concat_ws(',', cast(o_orderstatus = 'F' as integer), cast(o_orderstatus = 'O' as integer),
           cast(o_orderstatus = 'P' as integer)) as vector from orders
    """,
)
def label_vector(spark, d):
    orders = table(spark, d, "orders")
    levels = project.sorted_levels(orders, "o_orderstatus")
    vector = project.label_vector("o_orderstatus", levels)
    return orders.select("o_orderkey", F.array_join(vector.cast("array<int>"), ",").alias("vector"))


@query(
    "argmax_label",
    "select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as integer) as best from embeddings",
)
def argmax_label(spark, d):
    return table(spark, d, "embeddings").select("vec_id", project.argmax("embedding").alias("best"))


@query(
    "cast_types",
    """
    select o_orderkey, cast(o_totalprice as float) as price32, cast(trunc(o_totalprice) as integer) as whole,
           cast(o_custkey as varchar) as custkey_text from orders
    """,
)
def cast_types(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("float").alias("price32"),
        F.col("o_totalprice").cast("int").alias("whole"),
        F.col("o_custkey").cast("string").alias("custkey_text"),
    )


@query(
    "with_row_id",
    "select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as row_id from orders",
)
def with_row_id(spark, d):
    return project.with_row_id(
        table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey"
    ).select("o_orderkey", "row_id")


@query(
    "null_counts",
    """
    select 'discount' as column_name, count(*) filter (nullif(l_discount, 0) is null) as n_missing from lineitem
    union all select 'tax', count(*) filter (nullif(l_tax, 0) is null) from lineitem
    union all select 'l_returnflag', 0 from lineitem having count(*) > 0
    """,
)
def null_counts(spark, d):
    return profile.null_counts(
        table(spark, d, "lineitem").select(
            F.nullif("l_discount", F.lit(0.0)).alias("discount"),
            F.nullif("l_tax", F.lit(0.0)).alias("tax"),
            "l_returnflag",
        )
    )


def _describe_sql(column: str) -> str:
    return f"""
    select '{column}' as column_name, count({column}) as n, round(avg({column}), 6) as mean,
           round(stddev_samp({column}), 6) as std, cast(min({column}) as double) as min,
           round(quantile_cont({column}, 0.25), 6) as q25, round(quantile_cont({column}, 0.5), 6) as q50,
           round(quantile_cont({column}, 0.75), 6) as q75, cast(max({column}) as double) as max
    from lineitem"""


@query("describe_numeric", " union all ".join(_describe_sql(c) for c in FEATURES))
def describe_numeric(spark, d):
    return rounded(profile.describe(table(spark, d, "lineitem").select(*FEATURES)), 6, "mean", "std", "q25", "q50", "q75")


@query(
    "profile",
    """
    select 'c_custkey' as column_name, count(*) as n_rows, count(c_custkey) as n_present, 'bigint' as column_type from customer
    union all select 'c_name', count(*), count(c_name), 'string' from customer
    union all select 'c_nationkey', count(*), count(c_nationkey), 'int' from customer
    union all select 'c_acctbal', count(*), count(c_acctbal), 'double' from customer
    union all select 'c_mktsegment', count(*), count(c_mktsegment), 'string' from customer
    """,
)
def profile_table(spark, d):
    return profile.profile(table(spark, d, "customer"))


@query("distinct_values", "select distinct p_type from part")
def distinct_values(spark, d):
    return profile.distinct_values(table(spark, d, "part"), "p_type")


@query("distinct_first_seen", "select p_brand, min(p_partkey) as first_seen from part group by p_brand")
def distinct_first_seen(spark, d):
    return profile.distinct_first_seen(table(spark, d, "part"), "p_brand", "p_partkey")


@query(
    "attach_by_key",
    """
    select o_orderkey, o_totalprice, n_lines, round(value, 2) as value from orders left join
      (select l_orderkey, count(*) as n_lines, sum(l_extendedprice) as value from lineitem group by l_orderkey)
      on o_orderkey = l_orderkey
    """,
)
def attach_by_key(spark, d):
    outputs = (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("value"))
    )
    return joins.attach(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), outputs, "o_orderkey")


@query(
    "lookup_ranked",
    """
    with hits as (select c_custkey as id, c_acctbal as score from customer order by c_acctbal desc, c_custkey limit 100),
    ranked as (select id, score, row_number() over (order by score desc, id) as rank from hits)
    select cast(rank as integer) as rank, id as c_custkey, c_name, score from ranked join customer on id = c_custkey
    """,
)
def lookup_ranked(spark, d):
    people = table(spark, d, "customer")
    hits = joins.top_k_per(
        people.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("score")), [], [F.desc("score"), "id"], 100
    )
    return joins.lookup_ranked(hits, people.select("c_custkey", "c_name"), "id", "c_custkey")


@query("value_counts", "select c_mktsegment, count(*) as n from customer group by 1")
def value_counts(spark, d):
    return profile.value_counts(table(spark, d, "customer"), "c_mktsegment")


@query(
    "value_counts_numbered",
    "select p_brand, count(*) as n, row_number() over (order by p_brand) as position from part group by p_brand",
)
def value_counts_numbered(spark, d):
    return profile.value_counts_numbered(table(spark, d, "part"), "p_brand")


@query(
    "count_where",
    "select count(*) filter (p_size % 2 = 0) as no_mask, count(*) filter (p_size % 2 <> 0) as mask from part",
)
def count_where(spark, d):
    mask = F.col("p_size") % 2
    return table(spark, d, "part").agg(F.count_if(mask == 0).alias("no_mask"), F.count_if(mask != 0).alias("mask"))


@query(
    "crosstab_pivot",
    """
    select p_brand, count(*) filter (p_size % 2 = 0) as mask_0, count(*) filter (p_size % 2 = 1) as mask_1
    from part group by p_brand
    """,
)
def crosstab_pivot(spark, d):
    return profile.crosstab_wide(
        table(spark, d, "part").select("p_brand", (F.col("p_size") % 2).alias("mask")), "p_brand", "mask", [0, 1]
    )


@query(
    "distinct_subjects_per_class",
    "select event_type, count(distinct user_id) as n_subjects from events group by event_type",
)
def distinct_subjects_per_class(spark, d):
    pairs = table(spark, d, "events").select("event_type", "user_id").distinct()
    return pairs.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_subjects"))


@query(
    "samples_per_class",
    "select case user_id % 3 when 0 then 'bike' when 1 then 'run' else 'walk' end as activity, count(*) as n from events group by 1",
)
def samples_per_class(spark, d):
    from vitalis.plans.frames import activity

    return table(spark, d, "events").groupBy(activity().alias("activity")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "global_sum_mean",
    f"select sum(w) as total, round(avg(y) filter (adult), 6) as mean from ({SURVEY_SQL})",
)
def global_sum_mean(spark, d):
    rows = survey_rows(spark, d).withColumn("w", F.col("weight2") / 2)
    return rounded(profile.weighted_sum_mean(rows, "w", "y", F.col("adult")), 6, "mean")


def _corr_sql() -> str:
    cells = [
        f"select '{a}' as x, '{b}' as y, round(corr({a}, {b}), 6) + 0.0 as r from lineitem" for a in FEATURES for b in FEATURES
    ]
    return " union all ".join(cells)


@query("corr_matrix", _corr_sql())
def corr_matrix(spark, d):
    return rounded(profile.corr_matrix(table(spark, d, "lineitem"), FEATURES), 6, "r")


def _hist_sql(source: str, column: str, bins: int, measure: str) -> str:
    return f"""
    select '{column}' as column_name, cast(b as integer) as bin, round(lo + b * w, 6) as left_edge,
           round(lo + (b + 1) * w, 6) as right_edge, coalesce(n, 0) as n
    from (select min({column}) as lo, (max({column}) - min({column})) / {bins} as w from {source}) e
    join (select unnest(range({bins})) as b) g on true
    left join (select least(floor(({column} - (select min({column}) from {source}))
                 / (select (max({column}) - min({column})) / {bins} from {source})), {bins - 1}) as hb,
                 {measure} as n from {source} where {column} is not null group by 1) h on h.hb = g.b"""


@query(
    "histogram",
    _hist_sql("lineitem", "l_quantity", 30, "count(*)") + " union all " + _hist_sql("lineitem", "l_extendedprice", 30, "count(*)"),
)
def histogram(spark, d):
    counted = profile.histogram(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], 30)
    return rounded(counted, 6, "left_edge", "right_edge")


@query(
    "histogram_weighted",
    f"with s as (select * from ({SURVEY_SQL}) where adult) " + _hist_sql("s", "y", 30, "sum(w)"),
)
def histogram_weighted(spark, d):
    adults = survey_rows(spark, d).filter("adult").withColumn("w", F.col("weight2") / 2)
    return rounded(profile.histogram(adults, ["y"], 30, weight=F.col("w")), 6, "left_edge", "right_edge")


def _box_sql(source: str, groups: str, y: str, quartiles: str) -> str:
    on = " and ".join(f"a.{g} is not distinct from b.{g}" for g in groups.split(", "))
    cols = ", ".join(f"a.{g}" for g in groups.split(", "))
    inside = f"a.{y} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"
    return f"""
    select {cols}, count(*) as n, round(max(q1), 4) as q1, round(max(median), 4) as median, round(max(q3), 4) as q3,
           min(a.{y}) filter ({inside}) as whisker_low, max(a.{y}) filter ({inside}) as whisker_high,
           count(*) filter (not ({inside})) as n_outliers
    from {source} a join ({quartiles}) b on {on} where a.{y} is not null group by {cols}"""


@query(
    "box_stats",
    _box_sql(
        "orders",
        "o_orderpriority",
        "o_totalprice",
        """select o_orderpriority, quantile_cont(o_totalprice, 0.25) as q1, quantile_cont(o_totalprice, 0.5) as median,
                  quantile_cont(o_totalprice, 0.75) as q3 from orders group by o_orderpriority""",
    ),
)
def box_stats(spark, d):
    return rounded(profile.box_stats(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice"), 4, "q1", "median", "q3")


def _weighted_quartiles_sql(groups: str) -> str:
    return f"""
    select {groups}, min(y) filter (cw >= 0.25 * tw) as q1, min(y) filter (cw >= 0.5 * tw) as median,
           min(y) filter (cw >= 0.75 * tw) as q3
    from (select {groups}, y, sum(w) over (partition by {groups} order by y) as cw, sum(w) over (partition by {groups}) as tw
          from s where y is not null) group by {groups}"""


@query(
    "box_stats_weighted",
    f"with s as (select * from ({SURVEY_SQL}) where adult) "
    + _box_sql("s", "smoker, active", "y", _weighted_quartiles_sql("smoker, active")),
)
def box_stats_weighted(spark, d):
    adults = survey_rows(spark, d).filter("adult").withColumn("w", F.col("weight2") / 2)
    boxes = profile.box_stats(adults, ["smoker", "active"], "y", weight=F.col("w"))
    return rounded(boxes, 4, "q1", "median", "q3")


@query(
    "box_stats_weighted_no_missing_group",
    f"with s as (select * from ({SURVEY_SQL}) where adult and smoker is not null) "
    + _box_sql("s", "smoker", "y", _weighted_quartiles_sql("smoker")),
)
def box_stats_weighted_no_missing_group(spark, d):
    adults = survey_rows(spark, d).filter("adult and smoker is not null").withColumn("w", F.col("weight2") / 2)
    return rounded(profile.box_stats(adults, ["smoker"], "y", weight=F.col("w")), 4, "q1", "median", "q3")


@query(
    "trend_line",
    """
    select n, round(slope, 6) as slope, round(intercept, 4) as intercept, round(r2, 8) as r2,
           round(sqrt((1 - r2) * syy / (n - 2) / sxx), 6) as slope_se,
           round(sqrt((1 - r2) * syy / (n - 2) * (1.0 / n + mx * mx / sxx)), 4) as intercept_se
    from (select cast(regr_count(l_extendedprice, l_quantity) as bigint) as n, regr_slope(l_extendedprice, l_quantity) as slope,
                 regr_intercept(l_extendedprice, l_quantity) as intercept, regr_r2(l_extendedprice, l_quantity) as r2,
                 regr_sxx(l_extendedprice, l_quantity) as sxx, regr_syy(l_extendedprice, l_quantity) as syy,
                 regr_avgx(l_extendedprice, l_quantity) as mx from lineitem)
    """,
)
def trend_line(spark, d):
    line = profile.trend_line(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(rounded(line, 6, "slope", "slope_se"), 4, "intercept", "intercept_se").withColumn("r2", F.round("r2", 8))


@query(
    "scatter_sample",
    f"""
    select l_quantity, l_extendedprice, l_tax, l_returnflag from lineitem
    order by md5(concat_ws('|', {LINE_KEY_SQL}, 'plot')), {LINE_KEY_SQL} limit 500
    """,
)
def scatter_sample(spark, d):
    return profile.scatter_sample(
        keyed_lines(spark, d), ["l_quantity", "l_extendedprice", "l_tax"], "l_returnflag", 500, ["row_key"], "plot"
    )


@query(
    "hist2d",
    """
    select l_returnflag, cast(least(floor((l_quantity - lx) / ((hx - lx) / 10)), 9) as integer) as bin_x,
           cast(least(floor((l_extendedprice - ly) / ((hy - ly) / 10)), 9) as integer) as bin_y, count(*) as n
    from lineitem, (select min(l_quantity) lx, max(l_quantity) hx, min(l_extendedprice) ly, max(l_extendedprice) hy from lineitem)
    group by 1, 2, 3
    """,
)
def hist2d(spark, d):
    return profile.hist2d(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag", 10)


@query(
    "hist2d_nulls",
    """
    with p as (select l_returnflag, nullif(l_quantity, 10) as x, nullif(l_extendedprice, 10 * l_quantity) as y from lineitem),
    k as (select * from p where x is not null and y is not null)
    select l_returnflag, cast(least(floor((x - lx) / ((hx - lx) / 10)), 9) as integer) as bin_x,
           cast(least(floor((y - ly) / ((hy - ly) / 10)), 9) as integer) as bin_y, count(*) as n
    from k, (select min(x) lx, max(x) hx, min(y) ly, max(y) hy from k) group by 1, 2, 3
    """,
)
def hist2d_nulls(spark, d):
    """A point without one of its coordinates is in no bin."""
    points = table(spark, d, "lineitem").select(
        "l_returnflag", F.expr("nullif(l_quantity, 10)").alias("x"), F.expr("nullif(l_extendedprice, 10 * l_quantity)").alias("y")
    )
    return profile.hist2d(points, "x", "y", "l_returnflag", 10)


@query(
    "arg_best",
    """
    select o_custkey, round(spent, 2) as spent from (select o_custkey, sum(o_totalprice) as spent from orders group by 1)
    order by round(spent, 2) desc, o_custkey limit 1
    """,
)
def arg_best(spark, d):
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return joins.arg_best(spent, "spent", ["o_custkey"])


@query(
    "top_features",
    """
    select feature, importance from (select generate_subscripts(centre, 1) - 1 as feature, round(unnest(centre), 2) as importance
      from (select list(m order by p) as centre from (select p, avg(abs(v)) as m from (select unnest(embedding) as v,
      generate_subscripts(embedding, 1) as p from embeddings) group by p)))
    order by importance desc, feature desc limit 10
    """,
)
def top_features(spark, d):
    scores = (
        table(spark, d, "embeddings")
        .select(F.posexplode("embedding").alias("feature", "v"))
        .groupBy(F.col("feature").cast("bigint").alias("feature"))
        .agg(F.round(F.avg(F.abs("v").cast("double")), 2).alias("importance"))
    )
    return joins.top_features(scores, "importance", "feature", 10)


@query(
    "order_by",
    "select s_suppkey, s_nationkey, s_acctbal, row_number() over (order by s_nationkey, s_acctbal, s_suppkey) as place from supplier order by all",
)
def order_by(spark, d):
    from vitalis.plans.ranks import ordered_rank

    ranked = ordered_rank(
        table(spark, d, "supplier").withColumn("rank_key", F.col("s_nationkey") * F.lit(1e9) + F.col("s_acctbal")),
        [], "rank_key", "s_suppkey", "place",
    )
    return ranked.select("s_suppkey", "s_nationkey", "s_acctbal", (F.col("place") + 1).alias("place")).orderBy("place")


@query(
    "union_splits",
    """
    select 'customer' as split, c_custkey as id, c_nationkey as nation, c_acctbal as balance from customer
    union all select 'supplier', s_suppkey, s_nationkey, s_acctbal from supplier
    """,
)
def union_splits(spark, d):
    people = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    )
    firms = table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")
    )
    return joins.union_splits({"customer": people, "supplier": firms})


@query(
    "partition_by_label",
    f"""
    select doc_id, label, split from ({LABELLED_SQL}) join (values (0, 'train'), (2, 'test'), (2, 'unsupervised'), (1, 'unknown'))
      r(l, split) on l = label
    """,
)
def partition_by_label(spark, d):
    label = F.col("label")
    rules = {"train": label == 0, "test": label == 2, "unsupervised": label == 2, "unknown": label == 1}
    return joins.partition_by_label(labelled_documents(spark, d), rules).select("doc_id", "label", "split")
