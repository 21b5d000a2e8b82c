"""Registered fits run the operators at their defaults, not at a smaller size."""

from types import SimpleNamespace

import pytest

from barlab.plans import registry, registry_models as R
from conftest import SF_SMALL


class Called(Exception):
    pass


FAMILIES = {"g04_random_forest": "rf", "g05_boosted_trees": "gbt", "g07_fixed_training": "rf", "g15_feature_importance": "rf", "g17_model_persist": "rf",
            "j02_batch_recommend": "rf", "k01_tree_shap": "rf", "k01_tree_shap_boosted": "gbt", "k07_narrative": "rf"}
CALLS = {q: ("fit", ("train", f), {}) for q, f in FAMILIES.items()} | {
    "g06_random_search": ("random_search", ("train", "rf"), {}), "g12_neural_net": ("neural_net", ("train", "test"), {}),
    "g13_second_boosted_family": ("fit", ("train", "leafwise"), {}),
    "g14_compare_models": ("compare_models", ("train", "test"), {}), "g16_standalone_importance": ("standalone_importance", ("full",), {}),
    "g18_retrain": ("retrain", ("full",), {})}


@pytest.mark.parametrize("query", sorted(CALLS))
def test_fits_take_no_smaller_size(spark, monkeypatch, query):
    def record(name):
        def fn(*args, **kw):
            raise Called(name, args, kw)
        return fn

    monkeypatch.setattr(R, "_CACHE", {})
    monkeypatch.setattr(R, "_split", lambda *_: ("train", "test"))
    monkeypatch.setattr(R, "_full", lambda *_: "full")
    monkeypatch.setattr(R, "_latest_full", lambda *_: SimpleNamespace(columns=[]))
    for name in ("fit", "random_search", "neural_net", "compare_models", "standalone_importance", "retrain"):
        monkeypatch.setattr(R.G, name, record(name))
    with pytest.raises(Called) as e:
        registry.queries()[query](spark, SF_SMALL)
    assert e.value.args == CALLS[query]


@pytest.mark.parametrize("query, tune", [("e1_daily_run", False), ("e1_daily_run_tuned", True)])
def test_daily_run_takes_no_smaller_size(spark, monkeypatch, query, tune):
    def run(*_, **kw):
        raise Called(kw)

    monkeypatch.setattr(R, "run_pipeline", run)
    with pytest.raises(Called) as e:
        registry.queries()[query](spark, SF_SMALL)
    assert e.value.args == ({"tune": tune},)
