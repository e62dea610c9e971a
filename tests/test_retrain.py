"""The retrain job: fits from one shared Gram against numpy, and a plan that doesn't grow with the configs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.operators import features as wn
from marketframe.plans import retrain, train
from tests.conftest import SMALL

CONFIGS = {"one": (["ret"], 0.0), "ridge": (["ret", "lag_1", "range_pct"], 2.0), "arma": retrain.Arma(2, 1, 4)}


@pytest.fixture(scope="module")
def frame(spark):
    return retrain.add_design(train.bar_training_frame(spark, SMALL), CONFIGS, "split", retrain.SeriesSpec()).persist()


def ols(x, y, alpha=0.0):
    xm, ym = x.mean(axis=0), y.mean()
    b = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(x.shape[1]), (x - xm).T @ (y - ym)) if x.shape[1] else np.zeros(0)
    return ym - xm @ b, b


def test_fits_and_scores_equal_numpy(frame):
    names = retrain.design_columns(CONFIGS)
    assert names == ["ret", "lag_1", "range_pct", "y_l1", "e"]
    fits = retrain.fit_all(frame, CONFIGS, ["symbol"])
    got = {(r.symbol, r.model_type, r.stage): r for r in fits.collect()}
    pdf = frame.toPandas().dropna(subset=[*names, "target"]).sort_values(["symbol", "ts"])
    preds = {(r.symbol, r.model_type, r.stage, r.ts): r.pred for r in retrain.score_all(frame.where("split = 'test'"), fits, names, "symbol").collect()}
    orders = set()
    for sym, g in pdf.groupby("symbol"):
        tr = g[g.split == "train"]
        grid = {}
        for p in range(3):
            for q in range(2):
                cols = ["ret", "y_l1"][:p] + ["e"][:q]
                b0, b = ols(tr[cols].to_numpy(), tr["target"].to_numpy())
                sse = float(np.sum((tr["target"] - b0 - tr[cols].to_numpy() @ b) ** 2))
                grid[p, q] = len(tr) * np.log(sse / len(tr)) + 2 * (p + q + 2), cols
        best = min(grid, key=lambda o: grid[o][0])
        orders.add(best)
        for name, cols, alpha in (("one", ["ret"], 0.0), ("ridge", ["ret", "lag_1", "range_pct"], 2.0), ("arma", grid[best][1], 0.0)):
            for stage, part in (("initial", tr), ("retrain", g)):
                b0, b = ols(part[cols].to_numpy(), part["target"].to_numpy(), alpha)
                r, full = got[sym, name, stage], dict.fromkeys(names, 0.0) | dict(zip(cols, b, strict=True))
                assert r.n == len(part) and np.isclose(r.intercept, b0, atol=1e-7) and np.allclose(r.coef, [full[c] for c in names], atol=1e-7), (sym, name, stage)
                for t in g[g.split == "test"].head(5).itertuples():
                    assert np.isclose(preds[sym, name, stage, t.ts.to_pydatetime()], b0 + sum(getattr(t, c) * full[c] for c in names), atol=1e-7)
    assert len(got) == 6 * pdf.symbol.nunique() and orders


def test_plan_does_not_grow_with_configs(frame):
    def size(n):
        configs = {f"m{i}": (wn.EXTENDED_FEATURES[: 1 + i % 5], float(i)) for i in range(n)}
        out = retrain.score_all(frame, retrain.fit_all(frame, configs, ["symbol"]), retrain.design_columns(configs), "symbol")
        plan = out._jdf.queryExecution().executedPlan().toString()
        return [plan.count(x) for x in ("Exchange", "InMemoryTableScan", "MapInPandas", "FlatMapGroupsInPandas", "Join")]

    assert size(1) == size(3) == size(12)


def test_summary_has_what_was_picked(spark):
    out = retrain.retrain(train.bar_training_frame(spark, SMALL), CONFIGS, top_n=2)
    picked = {(r.experiment, r.name) for r in out["picked"].collect()}
    rmse = {(r.experiment, r.run_id): r.metrics["rmse"] for r in out["runs"].collect()}
    rows = out["summary"].collect()
    assert {(r.experiment, r.name) for r in rows} == picked and len(rmse) == 3 * len({e for e, _ in picked})
    for r in rows:
        model = r.name.split("_")[-1]
        assert r.old_version == 1 and r.new_version == 2 and np.isclose(r.old_rmse, rmse[r.experiment, f"initial_{model}_{r.experiment}"]) and np.isclose(r.rmse_change, r.new_rmse - r.old_rmse)
