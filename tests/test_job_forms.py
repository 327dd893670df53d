"""Certificates, trees as tables, nested search, exact split, exploration, published tables."""

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fundcast.operators import evaluate as E
from fundcast.operators import learn as L
from fundcast.operators import trees as T
from fundcast.operators.certificate import certificate, gradient
from fundcast.operators.vectors import written_parts
from fundcast.plans import explore as X
from fundcast.plans import train as TR
from fundcast.plans.queries_campaign import prepared
from fundcast.session import scratch_path
from fundcast.sinks import publish_parquet, read_published, save_model, write_lines_with_header
from fundcast.sinks.publish import current_version
from fundcast.sources.csv import MALFORMED, read_csv_with_malformed, read_strict_csv

from conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def tokens(spark):
    return TR.tokenised(prepared(spark, SF_SMALL))


@pytest.fixture(scope="module")
def fitted(tokens):
    train, test = L.key_split(tokens, "project_id", 0.8)
    classifiers = {
        "logreg": L.logistic_regression(reg_param=0.05), "tree": L.decision_tree(),
        "forest": L.random_forest(num_trees=3), "gbt": L.gradient_boosted_trees(max_iter=3),
    }
    return TR.Fitted(train, test, classifiers, 0.05)


def test_certificate_holds_for_the_fit_and_not_for_another(spark, fitted):
    model = fitted.models["logreg"]
    row = certificate(model, fitted.train, 1e-3).first()
    assert row["optimal"] and row["n_rows"] == fitted.train.count()
    for spoilt in (L.logistic_regression(reg_param=0.5), L.logistic_regression(max_iter=2, reg_param=0.05)):
        other = spoilt.fit(fitted.train.select(L.LABEL, "features"))
        other.set(other.regParam, 0.05)
        assert not certificate(other, fitted.train, 1e-3).first()["optimal"]
    half = L.logistic_regression(reg_param=0.05).fit(fitted.train.where("project_id % 2 = 0").select(L.LABEL, "features"))
    assert not certificate(half, fitted.train, 1e-3).first()["optimal"]


def test_gradient_is_the_slope_of_the_loss(spark, fitted):
    import math

    model = fitted.models["logreg"]
    rows = fitted.train.select(L.LABEL, "features").collect()
    w, b = model.coefficients.toArray(), model.intercept
    n = len(rows)
    got = {r["index"]: r["gradient"] for r in gradient(model, fitted.train).collect()}
    j = max(range(len(w)), key=lambda k: abs(w[k]))
    x = [r["features"][j] for r in rows]
    mean = sum(x) / n
    sd = math.sqrt(sum((v - mean) ** 2 for v in x) / (n - 1))
    p = [1 / (1 + math.exp(-(r["features"].dot(w) + b))) for r in rows]
    g = sum((q - r[L.LABEL]) * v for q, r, v in zip(p, rows, x)) / n / sd + 0.05 * w[j] * sd
    assert abs(got[j] - g) < 1e-9
    assert abs(got[-1] - sum(q - r[L.LABEL] for q, r in zip(p, rows)) / n) < 1e-9


@pytest.mark.parametrize("name", ["tree", "forest", "gbt"])
def test_routed_scores_equal_the_models(spark, fitted, name):
    model = fitted.models[name]
    nodes = T.node_table(spark, save_model(model, scratch_path(spark, "trees")))
    trees = [model] if name == "tree" else model.trees
    depth = max(t.depth for t in trees)
    assert nodes.count() == sum(t.numNodes for t in trees)
    parts = written_parts(model.transform(fitted.test).select(
        "project_id", "features", vector_to_array("rawPrediction").alias("raw")))
    said = T.raw_scores(T.route(parts, nodes, len(trees), depth), nodes, "project_id", name == "gbt", name == "tree")
    both = said.join(parts, "project_id").collect()
    assert len(both) == fitted.test.count()
    assert all(abs(r["raw0"] - r["raw"][0]) < 1e-9 and abs(r["raw1"] - r["raw"][1]) < 1e-9 for r in both)
    if name == "tree":
        taught = T.route(written_parts(fitted.train.select(L.LABEL, "features")), nodes, 1, depth)
        assert T.differing_leaves(taught, nodes).count() == 0
        more = taught.unionAll(taught.limit(1))  # a row that was not there
        assert T.differing_leaves(more, nodes).count() == 1
        spoilt = nodes.withColumn("threshold", F.col("threshold") + 1e6)
        assert T.differing_leaves(T.route(written_parts(fitted.train.select(L.LABEL, "features")), spoilt, 1, depth), nodes).count() > 0


def test_nested_search_equals_separate_fits(spark):
    train, _ = L.key_split(TR.tokenised(prepared(spark, SF_CHECK)), "project_id", 0.9)
    lr = L.logistic_regression(max_iter=15)
    model, grid, metrics, best = TR.search(train, lr, (1e-5, 1e-1), (20.0, 60.0, 1e6), key="project_id")
    fit_rows, val_rows = L.key_split(train, "project_id", 0.7, L.SEED + 1)
    for point, metric in zip(grid, metrics, strict=True):
        at = {p.name: v for p, v in point.items()}
        if at["minDF"] < 1e6:
            own = L.logistic_regression(max_iter=15, reg_param=at["regParam"])
            scored = TR.fit_and_score(fit_rows, val_rows, own, at["minDF"])[1]
            assert abs(E.f1_evaluator().evaluate(scored) - metric) < 1e-9
    assert metrics[best] == max(metrics)
    # one pass counts the terms for all thresholds; slots are nested
    stages, slots = TR.nested_features(fit_rows, (20.0, 60.0, 1e6))
    assert set(slots[1e6]) < set(slots[60.0]) < set(slots[20.0]) and len(slots[1e6]) == 5
    assert len(stages[0].vocabulary) == len(slots[20.0]) - 5


def test_search_without_a_common_term_keeps_the_other_features(spark, tokens):
    train, test = L.key_split(tokens, "project_id", 0.8)
    model, _, metrics, _ = TR.search(train, L.logistic_regression(max_iter=5), (0.1,), (1e6,), key="project_id")
    assert len(metrics) == 1 and model.stages[-1].numFeatures == 5
    assert model.transform(prepared(spark, SF_SMALL)).count() == tokens.count()


@pytest.mark.parametrize("fraction", [0.0, 0.37, 0.9, 1.0])
def test_exact_split_has_its_quota_whatever_the_partitioning(spark, fraction):
    ids = list(range(97)) + [5, 5, 5, None, None]
    df = spark.createDataFrame([(i, "x" if i == 5 else str(k)) for k, i in enumerate(ids)], "id long, v string")
    a, b = L.exact_split(df, "id", fraction)
    quota = int(fraction * len(ids) + 0.5)
    assert (a.count(), b.count()) == (quota, len(ids) - quota)
    again = L.exact_split(df.repartition(7), "id", fraction)[0]
    assert sorted(map(repr, a.collect())) == sorted(map(repr, again.collect()))
    same = spark.createDataFrame([(1, "x")] * 10, "id long, v string")
    a, b = L.exact_split(same, "id", fraction)
    assert (a.count(), b.count()) == (int(fraction * 10 + 0.5), 10 - int(fraction * 10 + 0.5))


def test_exploration_reads_its_snapshot_once(spark, tmp_dir):
    from fundcast.fixtures import campaign_table

    snapshot = spark.read.parquet(publish_parquet(campaign_table(spark, SF_SMALL), tmp_dir))
    report = X.report(snapshot, "false")
    text = report._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "WindowGroupLimit" in text
    rows = report.where("report = 'country, currency'").collect()
    named = X.explore(snapshot, "false")["country_currency"].collect()
    assert [(r["key1"], r["key2"], r["n_rows"]) for r in sorted(rows, key=lambda r: r["place"])] == [
        (r["country"], r["currency"], r["count"]) for r in named
    ]
    assert report.where("report = 'deadline'").count() == X.TOP
    assert X.report(snapshot.limit(0), "false").count() == 0


def test_malformed_rows_stay_beside_the_others(spark, tmp_dir):
    lines = ["1,en,fine", "2,en", "3,en,a,b", "4,,false", "5,fr,x"]
    path = write_lines_with_header(spark.createDataFrame([(x,) for x in lines], "value string"), "id,lang,line", tmp_dir)
    rows = read_csv_with_malformed(spark, path)
    got = [tuple(r) for r in rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED).orderBy("id").collect()]
    assert got == [("1", "en", "fine"), ("4", None, None), ("5", "fr", "x")]
    strict = read_strict_csv(spark, path)
    assert got == [tuple(r) for r in strict.orderBy("id").collect()]
    assert sorted(r[0] for r in rows.select(MALFORMED, "id").where("malformed is not null").collect()) == ["2,en", "3,en,a,b"]


def test_a_write_that_ends_midway_leaves_the_old_version(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_published(spark, tmp_dir)
    first = publish_parquet(spark.range(10), tmp_dir)
    fails = spark.range(1000, numPartitions=4).select(
        F.when(F.col("id") == 900, F.raise_error(F.lit("ended midway")).cast("long")).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(PySparkException):
        publish_parquet(fails, tmp_dir)
    assert current_version(spark, tmp_dir) == first
    assert sorted(r[0] for r in read_published(spark, tmp_dir).collect()) == list(range(10))
    held = read_published(spark, tmp_dir)
    publish_parquet(read_published(spark, tmp_dir).where("id < 3"), tmp_dir)
    assert read_published(spark, tmp_dir).count() == 3
    assert held.count() == 10  # a reader of the version before still has it


def test_written_features_keep_categories_but_no_slot_names(spark, tokens):
    rows = tokens.filter("project_id % 10 <> 0")
    stages, slots = TR.nested_features(rows, (5.0, 20.0))
    named = TR.PipelineModel(stages=stages).transform(rows).select(L.LABEL, "all_features")
    bare = TR.written(named, "bare", rows.count())
    before, after = (d.schema["all_features"].metadata["ml_attr"] for d in (named, bare))
    assert len(before["attrs"]["numeric"]) > 100 and "numeric" not in after["attrs"]
    assert after["num_attrs"] == before["num_attrs"] and after["attrs"]["nominal"] == before["attrs"]["nominal"]
    tree = L.decision_tree().setFeaturesCol("all_features")
    assert tree.fit(bare).toDebugString.split("\n", 1)[1] == tree.fit(named.coalesce(1)).toDebugString.split("\n", 1)[1]


def test_rows_with_many_slots_are_fitted_in_more_parts(spark, tokens, monkeypatch):
    assert TR.fit_parts(25_000) == 1 and TR.fit_parts(0, 10) == 1
    # a task of the trees holds no more than about FIT_BYTES, whatever the number of rows
    assert TR.fit_parts(18_000, 12_600) == 9  # parts of LEAST_ROWS rows: more would send more sums than they hold
    for n in (25_000, 250_000, 1_500_000):
        assert 4_100 * TR.SLOT_BYTES * n / TR.fit_parts(n, 4_100) < 2 * TR.FIT_BYTES
    train, test = L.key_split(tokens, "project_id", 0.8)
    seen = {}

    def deal(df, parts):
        seen["parts"], seen["rows"] = parts, df.count()
        return real(df, parts)

    real = TR.in_parts
    monkeypatch.setattr(TR, "in_parts", deal)
    monkeypatch.setattr(TR, "FIT_BYTES", 1 << 14)
    monkeypatch.setattr(TR, "LEAST_ROWS", 5)
    fitted = TR.Fitted(train, test, {"tree": L.decision_tree()}, 0.05)
    assert seen["parts"] > 4 and seen["rows"] == train.count()
    assert real(fitted.train, seen["parts"]).rdd.getNumPartitions() >= seen["parts"]
    assert fitted.models["tree"].transform(fitted.test).count() == test.count()


def test_search_of_trees_deals_wide_rows_to_more_parts(spark, tokens, monkeypatch):
    dealt = []
    real = TR.in_parts
    monkeypatch.setattr(TR, "in_parts", lambda df, parts: dealt.append(parts) or real(df, parts))
    monkeypatch.setattr(TR, "FIT_BYTES", 1 << 12)
    monkeypatch.setattr(TR, "LEAST_ROWS", 5)
    TR.search(tokens, L.decision_tree(), None, (10.0, 20.0), key="project_id")
    assert len(dealt) == 3 and min(dealt) > 1  # both points and the best one's fit on all rows
    dealt.clear()
    TR.search(tokens, L.logistic_regression(max_iter=2), (0.1,), (10.0,), key="project_id")
    assert not dealt  # no slots are kept: parts go by rows


def test_routing_carries_only_the_entries_that_nodes_ask_for(spark):
    rows = spark.createDataFrame(
        [(1, (0, 9, [0, 4, 7], [1.0, 2.0, 3.0])), (2, (1, None, None, [5.0, 6.0])), (3, (0, 9, [], []))],
        "id INT, f STRUCT<type: TINYINT, size: INT, indices: ARRAY<INT>, values: ARRAY<DOUBLE>>",
    )
    e = T.asked_entries(F.col("f"), [4, 5])
    got = {r["id"]: r["a"] for r in rows.withColumn("e", e).select("id", T.asked(F.col("f"), F.col("e")).alias("a")).collect()}
    assert (got[1]["size"], got[1]["indices"], got[1]["values"]) == (9, [4], [2.0])
    assert got[2]["values"] == [5.0, 6.0] and got[3]["values"] == []
