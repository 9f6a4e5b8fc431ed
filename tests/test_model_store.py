"""What the shared store reads, and what a query fits."""

import pytest
from pyspark.sql import functions as F

from tabprism.operators import models as M
from tabprism.plans import model_plans, model_store, prep_plans
from tests.conftest import SF_SMALL


@pytest.fixture
def fresh(monkeypatch):
    monkeypatch.setattr(model_store, "_stores", {})


def test_preprocessor_is_fitted_on_rows_joined_once(spark, fresh, monkeypatch):
    real, seen = prep_plans.FE.fit_preprocessor, []

    def watched(train, *args, **named):
        seen.append(train._jdf.queryExecution().optimizedPlan().toString())
        return real(train, *args, **named)

    monkeypatch.setattr(prep_plans.FE, "fit_preprocessor", watched)
    st = model_store.store(spark, SF_SMALL)
    assert len(seen) == 1 and "Join" not in seen[0]
    assert "Join" not in st.raw._jdf.queryExecution().optimizedPlan().toString()
    want = prep_plans.split_frame(spark, SF_SMALL, learnable=True)
    assert sorted(st.raw.select("listing_id", "split").collect()) == sorted(want.select("listing_id", "split").collect())
    labels = st.prep.select("listing_id", "label").join(want.select("listing_id", "y"), "listing_id")
    assert labels.count() == want.count() and labels.where(F.col("label") != F.col("y")).count() == 0


def test_saving_the_ridge_pipeline_fits_the_ridge_alone(spark, fresh, monkeypatch):
    real, families = M.fit_all, []

    def watched(train, configs, seeds=None):
        families.extend(c.family for c in configs)
        return real(train, configs, seeds)

    monkeypatch.setattr(M, "fit_all", watched)
    rows = model_plans.q_model_persist(spark, SF_SMALL).collect()
    assert families == ["LinearRegression"] and rows and all(r.before == r.after for r in rows)
