"""Learning invariants: F1 equals the evaluator, thresholds, splits, save/load, search."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fundcast.operators import evaluate as E
from fundcast.operators import learn as L
from fundcast.plans import train as TR
from fundcast.plans.queries_campaign import prepared
from fundcast.sinks import save_model

from conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def tokens(spark):
    return TR.tokenised(prepared(spark, SF_CHECK))


def test_weighted_f1_equals_evaluator(spark):
    rows = [(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0), (2, 0.0), (2, 2.0), (1, 0.0), (0, 2.0)]
    df = spark.createDataFrame(rows, "final_status int, predictions double")
    ours = E.weighted_f1(df, digits=None).first()["f1"]
    ref = E.f1_evaluator().evaluate(df)
    assert abs(ours - ref) < 1e-12


def test_weighted_f1_on_labels_table(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    df = labels.select(F.col("quality").alias("final_status"), F.col("toxic").cast("double").alias("predictions"))
    assert abs(E.weighted_f1(df, digits=None).first()["f1"] - E.f1_evaluator().evaluate(df)) < 1e-12


def test_key_split_repeatable_disjoint_complete(spark, tokens):
    a_train, a_test = L.key_split(tokens, "project_id", 0.9)
    b_train, b_test = L.key_split(tokens.repartition(7), "project_id", 0.9)
    ids = lambda d: {r[0] for r in d.select("project_id").collect()}
    assert ids(a_train) == ids(b_train) and ids(a_test) == ids(b_test)
    assert not ids(a_train) & ids(a_test)
    assert ids(a_train) | ids(a_test) == ids(tokens)


def test_random_split_covers_all(spark, tokens):
    train, test = L.random_split(tokens)
    assert train.count() + test.count() == tokens.count()


def test_logreg_thresholds_and_save_load(spark, tokens, tmp_dir):
    train, test = L.key_split(tokens, "project_id", 0.9)
    model, scored = TR.fit_and_score(train, test, L.logistic_regression(max_iter=30), 0.01)
    rows = scored.select(L.PREDICTION, vector_to_array("probability")[1].alias("p1")).collect()
    assert rows and all((r["p1"] > 0.3) == (r[L.PREDICTION] == 1.0) for r in rows)
    loaded = TR.load_pipeline(save_model(model, tmp_dir))
    again = loaded.transform(test).select(L.PREDICTION).collect()
    assert [r[0] for r in again] == [r[L.PREDICTION] for r in rows]


def test_tuning_picks_argmax(spark, tokens):
    train, _ = L.key_split(tokens, "project_id", 0.9)

    def grid(lr, cv):
        return L.param_grid(lr, cv, (1e-7, 1e-1), (0.01,))

    model = TR.tune(train, L.logistic_regression(max_iter=10), grid, parallelism=2)
    metrics = model.validationMetrics
    best = max(range(len(metrics)), key=lambda i: metrics[i])
    best_reg = model.getEstimatorParamMaps()[best]
    reg = [v for p, v in best_reg.items() if p.name == "regParam"][0]
    assert model.bestModel.stages[-1].getRegParam() == reg
    table = L.explain_params(spark, model.bestModel)
    assert table.filter(F.col("param") == "thresholds").count() == 1


def test_full_grid_has_twelve_points(spark):
    from fundcast.operators import features as FT

    grid = L.param_grid(L.logistic_regression(), FT.count_vectorizer())
    assert len(grid) == 12
    df = L.grid_table(spark, grid)
    assert df.select("regParam", "minDF").distinct().count() == 12
    assert sorted(r["regParam"] for r in df.select("regParam").distinct().collect()) == [1e-7, 1e-5, 1e-3, 1e-1]
    lr, cv = L.logistic_regression(), FT.count_vectorizer()
    assert len(L.param_grid(lr, cv, (1e-7, 1e-5), None)) == 2
    assert len(L.param_grid(lr, cv, None, (55.0, 75.0, 95.0))) == 3
    assert len(L.param_grid(lr, cv, L.REG_PARAMS, L.MIN_DFS, L.ELASTIC_NETS)) == 60


def test_classifiers_fit_on_small(spark):
    toks = TR.tokenised(prepared(spark, SF_SMALL))
    train, test = L.key_split(toks, "project_id", 0.8)
    out = TR.compare_classifiers(train, test, {"tree": L.decision_tree(), "forest": L.random_forest()}, 0.05)
    for scored in out.values():
        assert scored.count() == test.count()


def test_tree_scale_settings_do_not_change_models(spark):
    toks = TR.tokenised(prepared(spark, SF_SMALL))
    train, test = L.key_split(toks, "project_id", 0.8)
    for make in (L.decision_tree, L.random_forest, L.gradient_boosted_trees):
        a = TR.fit_and_score(train, test, make(), 0.05)[1].select("project_id", L.PREDICTION).collect()
        b = TR.fit_and_score(train, test, make(**L.DEEP_TREE_SCALE), 0.05)[1].select("project_id", L.PREDICTION).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_shared_features_give_the_metrics_of_separate_fits(spark, tokens):
    train, _ = L.key_split(tokens, "project_id", 0.9)
    lr = L.logistic_regression(max_iter=10)
    _, grid, metrics, best = TR.search(train, lr, (1e-7, 1e-1), (0.05, 0.1), key="project_id")
    assert len(grid) == len(metrics) == 4 and metrics[best] == max(metrics)
    fit_rows, val_rows = L.key_split(train, "project_id", 0.7, L.SEED + 1)
    for point, metric in zip(grid, metrics, strict=True):
        at = {p.name: v for p, v in point.items()}
        own = L.logistic_regression(max_iter=10, reg_param=at["regParam"])
        scored = TR.fit_and_score(fit_rows, val_rows, own, at["minDF"])[1]
        assert abs(E.f1_evaluator().evaluate(scored) - metric) < 1e-9


def test_full_vocabulary_is_an_error(spark):
    from fundcast.operators import features as FT

    df = spark.createDataFrame([(["a", "b", "c"],)], "filtered array<string>")
    assert FT.whole_vocabulary(FT.count_vectorizer(1, vocab_size=4).fit(df)).vocabulary
    with pytest.raises(ValueError, match="limit of 3"):
        FT.whole_vocabulary(FT.count_vectorizer(1, vocab_size=3).fit(df))
