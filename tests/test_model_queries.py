"""The registered model queries run the whole job: every size, every fold."""

import inspect

import pytest

from lathe.plans import catalog_models as cm

SF = "/root/testdata/sf0.001"


def fit_sizes(monkeypatch):
    """Records, for every ridge fit, how many rows it has."""
    fits, solve = [], cm.gram.solve_ridge

    def recorded(blocks, block, *args, **kwargs):
        fits.append(int(block[0, 0]))
        return solve(blocks, block, *args, **kwargs)
    monkeypatch.setattr(cm.gram, "solve_ridge", recorded)
    return fits


def test_learning_curve_takes_every_size_and_fold(spark, monkeypatch):
    fits = fit_sizes(monkeypatch)
    got = {(r.size_index, r.part) for r in cm.m15(spark, SF).collect()}
    assert got == {(s, p) for s in range(8) for p in ("train", "validation")}
    tr = cm.split.assign_folds(cm._train(cm.model_frame(spark, SF)), "row_key", k=5)
    rows = cm.split.learning_sizes(tr, "row_key", n_sizes=8, lo=0.25, hi=1.0).select("size_index", "fold").collect()
    assert sorted(fits) == sorted(sum(r.size_index <= s and r.fold != f for r in rows) for s in range(8) for f in range(5))


def test_cross_validation_holds_every_fold_out_once(spark, monkeypatch):
    fits = fit_sizes(monkeypatch)
    assert cm.m12(spark, SF).count() == 6
    rows = cm.split.assign_folds(cm._train(cm.model_frame(spark, SF)), "row_key", k=5).select("fold").collect()
    assert sorted(fits) == sorted(sum(r.fold != f for r in rows) for f in range(5))


def small_frame(spark, monkeypatch):
    rows = [(i, str(i), "train", *[float(i * k % 7) for k in (1, 2, 3, 4, 5)], float(i % 9), i % 2) for i in range(60)]
    names = ["line_key", "row_key", "split", *cm.FEATS, "target", "y"]
    frame = spark.createDataFrame(rows, names)
    monkeypatch.setattr(cm, "model_frame", lambda *_: frame)
    return frame


def test_fits_use_the_operators_defaults(spark, monkeypatch):
    small_frame(spark, monkeypatch)

    class Stop(Exception):
        pass

    def settings(fit, run):
        own = inspect.signature(getattr(cm.models, fit))

        def recorded(*args, **kwargs):
            bound = own.bind(*args, **kwargs)
            bound.apply_defaults()
            raise Stop(bound.arguments)
        with monkeypatch.context() as m:
            m.setattr(cm.models, fit, recorded)
            with pytest.raises(Stop) as stop:
                run(spark, SF)
        return stop.value.args[0]
    for fit, run, want in [("fit_gbt_regressor", cm.m03, {"n_trees": 100, "depth": 6}),
                           ("fit_rf_regressor", cm.m04, {"n_trees": 100}),
                           ("fit_stacking", cm.m05, {"passthrough": True, "k": 5}),
                           ("fit_gbt_regressor", cm.m05, {"n_trees": 100, "depth": 6}),
                           ("fit_rf_classifier", cm.m08, {"n_trees": 200, "depth": 15}),
                           ("fit_gbt_classifier", cm.m09, {"n_trees": 100, "depth": 6}),
                           ("fit_mlp_classifier", cm.m10, {"max_iter": 100})]:
        got = settings(fit, run)
        assert {k: got[k] for k in want} == want, run.__name__


def test_search_and_grid(spark, monkeypatch):
    """30 draws of boosted trees; the grid stands around the best of them."""
    small_frame(spark, monkeypatch)
    calls = []

    def tune(est, maps, df, fold_col, parallelism=8):
        calls.append((type(est).__name__, maps, sorted(r[0] for r in df.select(fold_col).distinct().collect())))
        return len(maps), {p.name: v for p, v in maps[7].items()}
    monkeypatch.setattr(cm.models, "tune_boosted", tune)
    assert cm.m13(spark, SF) == 30 and len(calls[0][1][0]) == 7
    assert cm.m14(spark, SF) == 27
    assert all(c[0] == "GBTRegressor" and c[2] == list(range(5)) for c in calls)
    best = {p.name: v for p, v in calls[1][1][7].items()}
    assert best in [{p.name: v for p, v in m.items()} for m in calls[2][1]]


def test_shared_prefixes_score_like_separate_fits(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor
    tr = cm.models.assemble(cm.split.assign_folds(small_frame(spark, monkeypatch), "line_key", k=2), cm.FEATS).cache()
    est = GBTRegressor(featuresCol="features", labelCol="target", seed=1, maxDepth=2)
    maps = [{est.maxIter: 1}, {est.maxIter: 3}, {est.maxIter: 3, est.maxDepth: 1}]
    table, best = cm.models.tune_boosted(est, maps, tr, "fold")
    got = {r.draw: r.metric for r in table.collect()}
    ev = cm.models.rmse_evaluator("target")
    want = [sum(ev.evaluate(est.copy(m).fit(tr.where(f"fold <> {f}")).transform(tr.where(f"fold = {f}"))) for f in (0, 1)) / 2
            for m in maps]
    assert all(abs(got[i] - w) < 1e-9 for i, w in enumerate(want))
    assert best == {p.name: v for p, v in maps[want.index(min(want))].items()}


def test_tune_validates_every_fold(spark, monkeypatch):
    from pyspark.ml.regression import LinearRegression
    tr = cm.models.assemble(cm.split.assign_folds(small_frame(spark, monkeypatch), "line_key", k=5), cm.FEATS)
    est = LinearRegression(featuresCol="features", labelCol="target", solver="normal")
    model, table = cm.models.tune(est, [{est.regParam: 0.1}], cm.models.rmse_evaluator("target"), tr, "fold")
    assert model.getNumFolds() == 5 and table.count() == 1


def test_classifiers_are_scored_once(spark, monkeypatch):
    """The metrics read staged scores, the model's own of every row."""
    frame = small_frame(spark, monkeypatch)
    seen, fit, metrics = {}, cm.models.fit_mlp_classifier, cm.evaluate.classification_metrics

    def fitted(*args, **kwargs):
        seen["model"] = fit(*args, **kwargs)
        return seen["model"]

    def measured(df, *args, **kwargs):
        seen["scores"] = df
        return metrics(df, *args, **kwargs)
    monkeypatch.setattr(cm.models, "fit_mlp_classifier", fitted)
    monkeypatch.setattr(cm.evaluate, "classification_metrics", measured)
    assert [r.n for r in cm.m10(spark, SF).collect()] == [60]
    files = seen["scores"].inputFiles()
    assert files and all("scored-rows" in f for f in files)
    scaled = cm.scale.standard_scale(frame, frame, cm.FEATS)[0]
    own = seen["model"].transform(cm.models.assemble(scaled, cm.FEATS)).collect()
    want = sorted((r.split, r.y, int(r.prediction), r.probability[1]) for r in own)
    assert sorted((r.split, r.y, r.yhat, r.p1) for r in seen["scores"].collect()) == want
