"""Design-based estimates against direct formulas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalis.operators import survey


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame(
        {
            "h": rng.integers(0, 4, n), "c": rng.integers(0, 3, n), "w": rng.uniform(0.5, 3, n), "y": rng.normal(25, 4, n),
            "a": rng.choice(["No", "Yes"], n), "s": rng.choice(["No", "Yes"], n), "z": rng.normal(0, 1, n),
        }
    )
    pdf["adult"] = ~((pdf.h == 2) & (pdf.c == 1)) & (rng.random(n) < 0.8)  # one unit has no adult at all
    return pdf


@pytest.fixture(scope="module")
def design(spark, rows):
    return survey.SurveyDesign(spark.createDataFrame(rows), "h", "c", "w").domain(F.col("adult"))


def _sandwich(pdf, x, domain):
    """Coefficients and standard errors with every unit of the design counted."""
    w = pdf.w.to_numpy() * domain
    a = (x * w[:, None]).T @ x
    beta = np.linalg.solve(a, (x * w[:, None]).T @ pdf.y.to_numpy())
    scores = x * (w * (pdf.y.to_numpy() - x @ beta))[:, None]
    meat = np.zeros_like(a)
    for h in pdf.h.unique():
        units = pdf[pdf.h == h].c.unique()
        t = np.array([scores[((pdf.h == h) & (pdf.c == c)).to_numpy()].sum(axis=0) for c in units])
        t = t - t.mean(axis=0)
        meat += len(units) / (len(units) - 1) * t.T @ t
    inverse = np.linalg.inv(a)
    return beta, np.sqrt(np.diag(inverse @ meat @ inverse))


def test_mean_counts_units_without_domain_rows(design, rows):
    beta, se = _sandwich(rows, np.ones((len(rows), 1)), rows.adult.to_numpy())
    got = survey.svy_mean(design, "y").first()
    assert got["estimate"] == pytest.approx(beta[0]) and got["se"] == pytest.approx(se[0])


def test_ttest_equals_model_with_one_factor(design, rows):
    x = np.column_stack([np.ones(len(rows)), rows.a == "Yes"]).astype(float)
    beta, se = _sandwich(rows, x, rows.adult.to_numpy())
    got = survey.svy_ttest(design, "y", "a", ["No", "Yes"]).first()
    assert got["estimate"] == pytest.approx(beta[1]) and got["se"] == pytest.approx(se[1])
    assert got["df"] == 11 - 4 - 1  # the unit without adults does not count here
    assert 0 < got["p_value"] < 1 and got["conf_low"] < got["estimate"] < got["conf_high"]


def test_glm_with_interaction_and_covariate(design, rows):
    a, s = (rows.a == "Yes").to_numpy(float), (rows.s == "Yes").to_numpy(float)
    x = np.column_stack([np.ones(len(rows)), a, s, a * s, rows.z])
    beta, se = _sandwich(rows, x, rows.adult.to_numpy())
    fa, fs = survey.factor_terms("a", ["No", "Yes"]), survey.factor_terms("s", ["No", "Yes"])
    tidy = survey.svy_glm(design, "y", [*fa, *fs, *survey.interaction(fa, fs), survey.Term("z", F.col("z"))])
    got = {r["term"]: r for r in tidy.collect()}
    names = ["(Intercept)", "aYes", "sYes", "aYes:sYes", "z"]
    assert np.allclose([got[n]["estimate"] for n in names], beta)
    assert np.allclose([got[n]["std_error"] for n in names], se)
    effect = survey.linear_combo(tidy, ["aYes", "aYes:sYes"]).first()[0]
    assert effect == pytest.approx(beta[1] + beta[3])


def test_single_unit_stratum_is_an_error(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 2.0), (2, 1, 1.0, 3.0), (2, 2, 1.0, 4.0)], "h int, c int, w double, y double")
    with pytest.raises(Exception, match="single primary unit"):
        survey.svy_mean(survey.SurveyDesign(df, "h", "c", "w"), "y").collect()
