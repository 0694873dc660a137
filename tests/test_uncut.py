"""The registered searches and fits are the workloads' own, not smaller ones."""

import pytest

from conftest import SF_SMALL
from tabula.plans import jobs, models, registry


class _Stop(Exception):
    pass


@pytest.mark.parametrize("name, kind", [("l2_l11_claims_rf_cv", "rf_reg"), ("l4_linear_svc_churn", "svc"),
                                        ("l5_decision_tree_churn", "tree"), ("l6_rf_classifier_churn", "rf_cls")])
def test_searches_try_the_whole_grid(spark, monkeypatch, name, kind):
    seen = []

    def caught(pipeline, param_maps, *args, **kwargs):
        seen.extend({p.name: v for p, v in m.items()} for m in param_maps)
        raise _Stop

    monkeypatch.setattr(jobs, "tune", caught)
    with pytest.raises(_Stop):
        registry.QUERIES[name](spark, SF_SMALL)
    for param, values in models.WORKLOAD_GRIDS[kind].items():
        tried = {m[param] for m in seen}
        # bins may only be raised, to what the categories need
        assert set(values) <= tried if param != "maxBins" else max(values) in tried and len(tried) > 1
    n = 1
    for param in models.WORKLOAD_GRIDS[kind]:
        n *= len({m[param] for m in seen})
    assert len(seen) == n


def test_demand_forest_has_the_workloads_size(spark, monkeypatch):
    seen = []

    def caught(pipeline, *args, **kwargs):
        seen.append(pipeline.getStages()[-1])
        raise _Stop

    monkeypatch.setattr(jobs, "fit", caught)
    with pytest.raises(_Stop):
        registry.QUERIES["l2_rf_regressor_demand"](spark, SF_SMALL)
    assert (seen[0].getNumTrees(), seen[0].getMaxDepth()) == (100, 20)


def test_grid_table_importances_and_fits_use_the_workloads_settings(spark, monkeypatch):
    maps, stages = [], []

    def searched(pipeline, param_maps, *args, **kwargs):
        maps.extend({p.name: v for p, v in m.items()} for m in param_maps)
        raise _Stop

    def fitted(pipeline, *args, **kwargs):
        stages.append(pipeline.getStages()[-1])
        raise _Stop

    monkeypatch.setattr(models, "tune", searched)
    monkeypatch.setattr(models, "fit", fitted)
    for name in ("l10_l12_grid_search_table", "l13_feature_importances", "l7_l9_pipeline_fit_score"):
        with pytest.raises(_Stop):
            registry.QUERIES[name](spark, SF_SMALL)
    assert {m["maxDepth"] for m in maps} == set(models.WORKLOAD_GRIDS["tree"]["maxDepth"]) and 100 in {m["maxBins"] for m in maps}
    assert (stages[0].getNumTrees(), stages[0].getMaxDepth()) == (100, 20)
    assert stages[1].getMaxIter() == 100
