"""Design-based estimates over the person table."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis.operators import survey
from vitalis.plans.core_queries import rounded
from vitalis.plans.frames import SURVEY_SQL, survey_rows
from vitalis.plans.registry import query

RACES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _design(spark, d):
    rows = survey.rescale_weight(survey_rows(spark, d), "weight2", 2, "w")
    return survey.SurveyDesign(rows, "stratum", "psu", "w")


def _adults(spark, d):
    return _design(spark, d).domain(F.col("adult"))


def _se_sql(score_rows: str, by: str = "") -> str:
    """SE per group from rows (by..., stratum, psu, z) over the full PSU grid of the design."""
    keys = f"{by}, " if by else ""
    levels = f"(select distinct {by} from z) l, " if by else ""
    match = "".join(f" and z.{k.strip()} = l.{k.strip()}" for k in by.split(",") if k)
    select = "".join(f"l.{k.strip()}, " for k in by.split(",") if k)
    return f"""
    z as ({score_rows}),
    grid as (select {select}u.stratum, u.psu, coalesce(sum(z.z), 0) as t from {levels}(select distinct stratum, psu from s) u
             left join z on z.stratum = u.stratum and z.psu = u.psu{match} group by all),
    dev as (select {keys}stratum, t - avg(t) over (partition by {keys}stratum) as e,
            count(*) over (partition by {keys}stratum) as n from grid),
    v as (select {keys}sqrt(sum(e * e * n / (n - 1))) as se from dev {'group by ' + by if by else ''})"""


@query("svy_weight_total", f"select round(sum(w), 4) as total, count(*) as n from ({SURVEY_SQL})")
def svy_weight_total(spark, d):
    rows = survey.rescale_weight(survey_rows(spark, d), "weight2", 2, "w")
    return rows.agg(F.round(F.sum("w"), 4).alias("total"), F.count(F.lit(1)).alias("n"))


@query(
    "svy_design_summary",
    f"""
    select stratum, count(distinct psu) as n_psu, count(*) as n_rows, round(sum(w), 4) as weight from ({SURVEY_SQL}) group by stratum
    """,
)
def svy_design_summary(spark, d):
    return rounded(_design(spark, d).summary(), 4, "weight")


@query(
    "svy_domain_count",
    f"select count(*) as n_design, count(*) filter (adult) as n_domain from ({SURVEY_SQL})",
)
def svy_domain_count(spark, d):
    return _adults(spark, d).counts()


@query(
    "svy_mean",
    f"""
    with s as ({SURVEY_SQL}), m as (select sum(w * y) / sum(w) as est, sum(w) as sw from s where adult and y is not null),
    {_se_sql("select stratum, psu, w * (y - est) / sw as z from s, m where adult and y is not null")}
    select round(est, 6) as estimate, round(se, 6) as se from m, v
    """,
)
def svy_mean(spark, d):
    return rounded(survey.svy_mean(_adults(spark, d), "y"), 6, "estimate", "se")


@query(
    "svy_prop",
    f"""
    with s as ({SURVEY_SQL}), x as (select s.*, level, cast(race = level as double) as ind from s,
      (select distinct race as level from s) where adult),
    m as (select level, sum(w * ind) / sum(w) as est, sum(w) as sw from x group by level),
    {_se_sql("select level, stratum, psu, w * (ind - est) / sw as z from x join m using (level)", "level")}
    select level, round(est, 8) as estimate, round(se, 8) as se from m join v using (level)
    """,
)
def svy_prop(spark, d):
    return rounded(survey.svy_prop(_adults(spark, d), "race", RACES), 8, "estimate", "se")


_BY_SQL = f"""
with s as ({SURVEY_SQL}),
m as (select smoker, sum(w * y) / sum(w) as est, sum(w) as sw from s where adult and y is not null and smoker is not null group by 1),
{_se_sql("select s.smoker, stratum, psu, w * (y - est) / sw as z from s join m on s.smoker = m.smoker where adult and y is not null", "smoker")}
"""


@query("svy_by_mean", f"{_BY_SQL} select smoker, round(est, 6) as estimate, round(se, 6) as se from m join v using (smoker)")
def svy_by_mean(spark, d):
    return rounded(survey.svy_by(_adults(spark, d), "y", ["smoker"], na_rm=True), 6, "estimate", "se")


@query(
    "svy_by_mean_na_kept",
    f"""
    with s as ({SURVEY_SQL}) select smoker, case when bool_or(y is null) then null else round(sum(w * y) / sum(w), 6) end as estimate,
    cast(null as double) as se from s where adult and smoker is not null group by smoker having bool_or(y is null)
    """,
)
def svy_by_mean_na_kept(spark, d):
    # without removal of missing outcomes the groups that have any give no estimate
    return rounded(survey.svy_by(_adults(spark, d), "y", ["smoker"]), 6, "estimate", "se")


@query(
    "svy_by_prop",
    f"""
    with s as ({SURVEY_SQL}), x as (select s.*, level, cast(active = level as double) as ind from s, (select distinct active as level from s)
      where adult and smoker is not null),
    m as (select smoker, level, sum(w * ind) / sum(w) as est, sum(w) as sw from x group by all),
    {_se_sql("select smoker, level, stratum, psu, w * (ind - est) / sw as z from x join m using (smoker, level)", "smoker, level")}
    select smoker, level, round(est, 8) as estimate, round(se, 8) as se from m join v using (smoker, level)
    """,
)
def svy_by_prop(spark, d):
    return rounded(survey.svy_prop(_adults(spark, d), "active", ["No", "Yes"], by=["smoker"]), 8, "estimate", "se")


_DEGF_SQL = "(select count(distinct (stratum, psu)) - count(distinct stratum) as degf from {used})"


@query(
    "svy_ttest",
    f"""
    with s as ({SURVEY_SQL}), u as (select * from s where adult and y is not null),
    m as (select sum(w * y) filter (active = 'Yes') / sum(w) filter (active = 'Yes') as m1, sum(w) filter (active = 'Yes') as w1,
                 sum(w * y) filter (active = 'No') / sum(w) filter (active = 'No') as m0, sum(w) filter (active = 'No') as w0 from u),
    {_se_sql("select stratum, psu, case when active = 'Yes' then w * (y - m1) / w1 else - w * (y - m0) / w0 end as z from u, m")}
    select round(m1 - m0, 6) as estimate, round(se, 6) as se, round((m1 - m0) / se, 6) as statistic,
           cast((select degf from {_DEGF_SQL.format(used='u')}) - 1 as integer) as df from m, v
    """,
)
def svy_ttest(spark, d):
    test = survey.svy_ttest(_adults(spark, d), "y", "active", ["No", "Yes"])
    return rounded(test, 6, "estimate", "se", "statistic").select("estimate", "se", "statistic", "df")


@query("svy_ttest_tidy")
def svy_ttest_tidy(spark, d):
    """The full test line, with p value and confidence interval (checked in the tests)."""
    return survey.svy_ttest(_adults(spark, d), "y", "active", ["No", "Yes"])


def _main_model():
    active = survey.factor_terms("active", ["No", "Yes"])
    smoker = survey.factor_terms("smoker", ["No", "Yes"])
    return [*active, *smoker, *survey.interaction(active, smoker)]


_CELLS_SQL = f"""
with s as ({SURVEY_SQL}), u as (select * from s where adult and y is not null and smoker is not null),
c as (select active, smoker, sum(w * y) / sum(w) as cm, sum(w) as cw from u group by all),
k(term, active, smoker, f) as (values ('(Intercept)', 'No', 'No', 1), ('activeYes', 'Yes', 'No', 1), ('activeYes', 'No', 'No', -1),
  ('smokerYes', 'No', 'Yes', 1), ('smokerYes', 'No', 'No', -1), ('activeYes:smokerYes', 'Yes', 'Yes', 1),
  ('activeYes:smokerYes', 'Yes', 'No', -1), ('activeYes:smokerYes', 'No', 'Yes', -1), ('activeYes:smokerYes', 'No', 'No', 1)),
m as (select term, sum(f * cm) as est from k join c using (active, smoker) group by term),
"""


@query(
    "svy_glm",
    f"""
    {_CELLS_SQL}
    {_se_sql("select term, stratum, psu, f * w * (y - cm) / cw as z from u join c using (active, smoker) join k using (active, smoker)", "term")}
    select term, round(est, 5) as estimate, round(se, 5) as std_error, round(est / se, 5) as statistic from m join v using (term)
    """,
)
def svy_glm(spark, d):
    tidy = survey.svy_glm(_adults(spark, d), "y", _main_model())
    return rounded(tidy, 5, "estimate", "std_error", "statistic").drop("p_value")


@query("svy_glm_adjusted")
def svy_glm_adjusted(spark, d):
    """The interaction model with the race covariate; checked in the tests against least squares."""
    return survey.svy_glm(_adults(spark, d), "y", [*_main_model(), *survey.factor_terms("race", RACES)])


@query(
    "svy_contrast",
    f"""
    {_CELLS_SQL.rstrip().rstrip(',')}
    select round(sum(est), 5) as estimate from m where term in ('activeYes', 'activeYes:smokerYes')
    """,
)
def svy_contrast(spark, d):
    tidy = survey.svy_glm(_adults(spark, d), "y", _main_model())
    return rounded(survey.linear_combo(tidy, ["activeYes", "activeYes:smokerYes"]), 5, "estimate")
