"""The registered model queries ask for the reference's rounds, epochs and grids."""

from unittest.mock import patch

import pytest

import __spark_entry__ as entry
from vitalis.operators import models, staged

D = "/root/testdata/sf0.001"


class Asked(Exception):
    pass


@pytest.mark.parametrize(
    ("name", "operator", "wanted"),
    [
        ("gbt_classifier", "fit_gbt", {"rounds": 150}), ("random_forest", "fit_forest", {"trees": 100}),
        ("feature_importance", "fit_forest", {"trees": 100}),
    ],
)
def test_settings(spark, name, operator, wanted):
    with patch.object(models, operator, side_effect=Asked) as fit, pytest.raises(Asked):
        entry.queries()[name](spark, D)
    assert {k: fit.call_args.kwargs[k] for k in wanted} == wanted


def test_loso_grid(spark):
    with patch.object(staged, "loso_tune", side_effect=Asked) as tune, pytest.raises(Asked):
        entry.queries()["loso_accuracy_table"](spark, D)
    assert tune.call_args.kwargs == {"trees": [2, 10, 20, 50, 100, 150, 300], "depths": range(2, 7)}


@pytest.mark.parametrize(
    ("name", "operator"),
    [("mlp_classifier", "fit_mlp"), ("lad_regression", "fit_lad"), ("linear_svc", "fit_linear_svc"), ("rbf_svc", "fit_rbf_svc"), ("logistic_elasticnet", "fit_logistic")],
)
def test_iterations_are_the_operators_own(spark, name, operator):
    with patch.object(models, operator, side_effect=Asked) as fit, pytest.raises(Asked):
        entry.queries()[name](spark, D)
    assert not {"iterations", "maxIter"} & set(fit.call_args.kwargs)
