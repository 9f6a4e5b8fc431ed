"""The model queries ask for every config and every point of the curves whole."""

import pytest

from tabprism.operators import models as M
from tabprism.plans import explain_plans, model_plans
from tabprism.plans.registry import entries


class Asked(Exception):
    pass


@pytest.fixture
def asked(monkeypatch):
    """Fits that are asked for, in place of being made."""
    found = []

    class Store:
        def split(self, *names):
            return None

        def fitted(self, configs, seeds=None):
            found.extend(configs)
            raise Asked

    for plans in (model_plans, explain_plans):
        monkeypatch.setattr(plans, "store", lambda spark, sf: Store())
    return found


@pytest.mark.parametrize("name, families", [
    ("random_forest_fit", ["RandomForest"]), ("gbt_fit_a", ["XGBoost"]), ("gbt_fit_b", ["CatBoost"]),
    ("config_sweep", ["LinearRegression", "RandomForest", "XGBoost", "CatBoost"]),
    ("config_sweep_val", ["LinearRegression", "RandomForest", "XGBoost", "CatBoost"])])
def test_sweeps_fit_the_whole_grid(asked, name, families):
    with pytest.raises(Asked):
        entries()[name].build(None, None)
    assert asked == [c for c in M.model_grid() if c.family in families] and len(asked) == 6 * len(families)
    assert not any("reduced" in c.label for c in asked)


@pytest.mark.parametrize("name", ["parameter_curve", "artefacts_roundtrip"])
def test_curves_are_fitted_with_all_trees_and_iterations(asked, name):
    with pytest.raises(Asked):
        entries()[name].build(None, None)
    of = lambda family, key: [c.params[key] for c in asked if c.family == family]
    assert sum(of("RandomForest", "n_estimators")) == 300 and of("CatBoost", "iterations") == [300]
    assert of("XGBoost", "n_estimators") == [200] * 6 and len(of("LinearRegression", "alpha")) == 5
