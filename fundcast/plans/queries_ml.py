"""Registered learning queries: split, classifiers, F1, confusion, search,
save/load and the classifier comparison.

Campaign models use a key-hash split (repeatable whatever the partitioning)
and a fractional minDF so the vocabulary threshold scales with the data.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fundcast.catalog import register
from fundcast.operators import evaluate as E
from fundcast.operators import learn as L
from fundcast.operators import trees as T
from fundcast.operators.certificate import certificate
from fundcast.operators.vectors import written_parts
from fundcast.plans import sql
from fundcast.plans import train as TR
from fundcast.plans.featurise import materialise_features
from fundcast.plans.queries_campaign import prepared
from fundcast.plans.queries_text import MODEL_MIN_DF
from fundcast.session import cut_lineage, scratch_path
from fundcast.sinks import save_model
from fundcast.sources import table


def _split(spark, sf_dir):
    toks = TR.tokenised(prepared(spark, sf_dir))
    return L.key_split(toks, "project_id", 0.9)


@register("random_split_counts", sql.with_prep("SELECT count(*) AS n_rows FROM prep"))
def q_random_split_counts(spark, sf_dir):
    train, test = L.random_split(prepared(spark, sf_dir), (0.9, 0.1), L.SEED)
    return train.unionAll(test).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "exact_split",
    sql.with_prep(
        ", ranked AS (SELECT project_id, row_number() OVER (ORDER BY "
        f"md5(concat_ws('-', CAST(project_id AS VARCHAR), '{L.SEED}'))) AS r, count(*) OVER () AS n FROM prep) "
        "SELECT project_id, CASE WHEN r <= floor(0.9 * n + 0.5) THEN 'train' ELSE 'test' END AS side FROM ranked"
    ),
)
def q_exact_split(spark, sf_dir):
    """The 0.9 split with an exact quota, row by row."""
    prep = cut_lineage(prepared(spark, sf_dir).select("project_id"), "split-input")
    train, test = L.exact_split(prep, "project_id", 0.9)
    return train.withColumn("side", F.lit("train")).unionAll(test.withColumn("side", F.lit("test")))


_LABELS_F1 = f"""WITH pairs AS (SELECT CAST(quality AS DOUBLE) AS l, CAST(toxic AS DOUBLE) AS p FROM labels),
counts AS (SELECT l, p, count(*) AS n FROM pairs GROUP BY l, p),
per_class AS (SELECT l, sum(n) AS actual, sum(CASE WHEN l = p THEN n ELSE 0 END) AS tp FROM counts GROUP BY l),
predicted AS (SELECT p AS l, sum(n) AS predicted FROM counts GROUP BY p),
stats AS (
  SELECT s.actual, CASE WHEN pr.predicted > 0 THEN s.tp / pr.predicted ELSE 0.0 END AS prec,
         s.tp / s.actual AS rec
  FROM per_class s LEFT JOIN predicted pr ON s.l = pr.l)
SELECT round(sum(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2.0 * prec * rec / (prec + rec) END * actual) / sum(actual), 9) AS f1
FROM stats"""


@register("weighted_f1", _LABELS_F1)
def q_weighted_f1(spark, sf_dir):
    return E.weighted_f1(table(spark, sf_dir, "labels"), "quality", "toxic")


@register(
    "confusion_matrix",
    "SELECT quality AS label, toxic AS prediction, count(*) AS count FROM labels GROUP BY quality, toxic",
)
def q_confusion_matrix(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    return E.confusion(labels, "label", "prediction")


def _scores(spark, sf_dir, name):
    train, test = _split(spark, sf_dir)
    clf = L.logistic_regression(max_iter=100) if name == "logreg" else L.CLASSIFIERS[name]()
    _, scored = TR.fit_and_score(train, test, clf, MODEL_MIN_DF)
    return TR.scores_table(scored)


@register("logreg_scores")
def q_logreg_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "logreg")


@register("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "gbt")


@register("forest_scores")
def q_forest_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "forest")


@register("tree_scores")
def q_tree_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "tree")


def _score_check(name):
    """What must hold of a classifier's row: the class follows from p1 (the logistic
    regression's thresholds put the bound at 0.3), p1 from the raw scores."""
    p1 = vector_to_array(F.col("probability"))[1]
    raw = vector_to_array(F.col("rawPrediction"))
    if name == "logreg":
        expected = 1 / (1 + F.exp(-raw[1]))
    elif name == "gbt":
        expected = 1 / (1 + F.exp(-2 * raw[1]))
    else:
        expected = raw[1] / (raw[0] + raw[1])
    follows = (F.col(L.PREDICTION) == 1) == (p1 > (0.3 if name == "logreg" else 0.5))
    return F.coalesce(follows & (F.abs(p1 - expected) < 1e-9), F.lit(False))


def _classifiers():
    return {
        name: L.logistic_regression(max_iter=100) if name == "logreg" else L.CLASSIFIERS[name]()
        for name in ("logreg", "gbt", "forest", "tree")
    }


@register(
    "classifier_checks",
    sql.with_prep(
        "SELECT m.model, project_id, final_status, TRUE AS consistent FROM prep, "
        "(VALUES ('logreg'), ('gbt'), ('forest'), ('tree')) m(model) "
        f"WHERE NOT ({L.key_split_sql('project_id')})"
    ),
)
def q_classifier_checks(spark, sf_dir):
    """Every held-out row as each of the four classifiers scores it, with the check
    that its class, probability and raw scores agree."""
    train, test = _split(spark, sf_dir)
    out = None
    for name, scored in TR.compare_classifiers(train, test, _classifiers(), MODEL_MIN_DF).items():
        rows = scored.select(
            F.lit(name).alias("model"), "project_id", "final_status", _score_check(name).alias("consistent")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


#: Largest entry of the gradient that counts as zero.
OPTIMAL = 1e-3


@register(
    "logreg_certificate",
    sql.with_prep(
        "SELECT count(*) AS n_rows, count(*) FILTER (WHERE final_status = 1) AS n_positive, TRUE AS optimal "
        f"FROM prep WHERE {L.key_split_sql('project_id')}"
    ),
)
def q_logreg_certificate(spark, sf_dir):
    """Whether the fitted logistic regression (regParam 0.01) is optimal for its
    training rows: no entry of the loss's gradient at its coefficients is above 0.001."""
    train, test = _split(spark, sf_dir)
    fitted = TR.Fitted(train, test, {"logreg": L.logistic_regression(reg_param=0.01)}, MODEL_MIN_DF)
    out = certificate(fitted.models["logreg"], fitted.train, OPTIMAL)
    positive = fitted.train.where(F.col(L.LABEL) == 1).count()
    return out.select("n_rows", F.lit(positive).cast("long").alias("n_positive"), "optimal")


_TREES = {"tree": 1, "forest": 10, "gbt": 10}


@register(
    "tree_tables",
    sql.with_prep(
        f", sides AS (SELECT final_status, {L.key_split_sql('project_id')} AS train FROM prep), "
        "n AS (SELECT count(*) FILTER (WHERE NOT train) AS test, count(*) FILTER (WHERE train) AS train, "
        "count(*) FILTER (WHERE train AND final_status = 1) AS positive FROM sides) "
        "SELECT m.model, test AS n_test, test AS n_equal, train * m.trees AS n_in_leaves, "
        "positive * m.trees AS n_positive_in_leaves, "
        "CASE WHEN m.model = 'tree' THEN 0 END AS n_leaves_differing "
        f"FROM n, (VALUES {', '.join(f'({m!r}, {t})' for m, t in _TREES.items())}) m(model, trees)"
    ),
)
def q_tree_tables(spark, sf_dir):
    """The fitted trees as tables: held-out rows whose routed raw scores equal the
    model's, training rows found in the leaves, and (for the single tree, which sees
    every row once) leaves whose stored label counts are not those of the routed rows."""
    train, test = _split(spark, sf_dir)
    fitted = TR.Fitted(train, test, {name: L.CLASSIFIERS[name]() for name in _TREES}, MODEL_MIN_DF)
    parts = written_parts(fitted.train.select("project_id", L.LABEL, "features"), "routed-train")
    out = None
    for name, model in fitted.models.items():
        nodes = cut_lineage(T.node_table(spark, save_model(model, scratch_path(spark, "trees"))), "nodes")
        trees = [model] if name == "tree" else model.trees
        depth = max(t.depth for t in trees)
        scored = model.transform(fitted.test)
        raw = vector_to_array("rawPrediction")
        seen = written_parts(scored.select("project_id", "features", raw[0].alias("m0"), raw[1].alias("m1")), "routed-test")
        routed = T.route(seen, nodes, len(trees), depth)
        said = T.raw_scores(routed, nodes, "project_id", name == "gbt", name == "tree").join(seen, "project_id")
        equal = (F.abs(F.col("raw0") - F.col("m0")) < 1e-9) & (F.abs(F.col("raw1") - F.col("m1")) < 1e-9)
        held = said.agg(F.count(F.lit(1)).alias("n_test"), F.count(F.when(equal, 1)).alias("n_equal"))
        taught = cut_lineage(T.route(parts, nodes, len(trees), depth).drop("features"), "taught")
        leaves = T.leaf_counts(taught).agg(
            F.sum(F.col("negatives") + F.col("positives")).alias("all"), F.sum("positives").alias("positive")
        ).first()
        differing = T.differing_leaves(taught, nodes).count() if name == "tree" else None
        row = held.select(
            F.lit(name).alias("model"), "*", F.lit(int(leaves["all"])).cast("long").alias("n_in_leaves"),
            F.lit(int(leaves["positive"])).cast("long").alias("n_positive_in_leaves"),
            F.lit(differing).cast("int").alias("n_leaves_differing"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def _tuned(spark, sf_dir, model_path=None):
    """The tuned job on the repeatable split, with its original search."""
    return TR.tuned_logreg(prepared(spark, sf_dir), model_path, key="project_id", parallelism=6)


@register("grid_search_metrics")
def q_grid_search_metrics(spark, sf_dir):
    """Validation F1 of each of the 12 points of the tuned job (regParam × minDF)."""
    return _tuned(spark, sf_dir)["metrics"]


@register(
    "tuned_job_checks",
    sql.with_prep(
        f", test AS (SELECT final_status FROM prep WHERE NOT ({L.key_split_sql('project_id')})) "
        "SELECT r.reg AS \"regParam\", d.df AS \"minDF\", count(*) AS n_test, "
        "count(*) FILTER (WHERE final_status = 1) AS n_positive, TRUE AS f1_valid, TRUE AS best_is_largest "
        f"FROM test, (VALUES {', '.join(f'(CAST({r!r} AS DOUBLE))' for r in L.REG_PARAMS)}) r(reg), "
        f"(VALUES {', '.join(f'(CAST({m!r} AS DOUBLE))' for m in L.MIN_DFS)}) d(df) GROUP BY r.reg, d.df"
    ),
)
def q_tuned_job_checks(spark, sf_dir):
    """The tuned job per grid point: held-out rows of its confusion matrix, all and
    positive, whether the F1 lies in 0 to 1, and whether the fitted model has the
    parameters of the point with the largest F1."""
    out = _tuned(spark, sf_dir)
    held = out["confusion"].groupBy().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_test"),
        F.coalesce(F.sum(F.when(F.col(L.LABEL) == 1, F.col("count"))), F.lit(0)).alias("n_positive"),
    ).first()
    points = out["metrics"].collect()  # 12 rows
    top = max(points, key=lambda r: (r["f1"], -r["point"]))
    chosen = out["best"] == top["point"] and out["model"].stages[-1].getRegParam() == top["regParam"]
    return out["metrics"].select(
        "regParam", "minDF", F.lit(held["n_test"]).cast("long").alias("n_test"),
        F.lit(held["n_positive"]).cast("long").alias("n_positive"),
        F.col("f1").between(0, 1).alias("f1_valid"), F.lit(chosen).alias("best_is_largest"),
    )


@register("model_save_load", sql.with_prep("SELECT count(*) AS n_rows, 0 AS n_diff FROM prep"))
def q_model_save_load(spark, sf_dir):
    """Save and load the tuned job's model (all 8 stages) and score every prepared
    campaign; count rows whose prediction or class-1 probability changed after the
    reload. Both models score the same row in one pass (no join, no shuffle)."""
    prep = prepared(spark, sf_dir)
    path = scratch_path(spark, "model")
    model = _tuned(spark, sf_dir, path)["model"]
    loaded = TR.load_pipeline(path)
    first = model.transform(prep).select(
        *prep.columns,
        F.col(L.PREDICTION).alias("_pred0"),
        vector_to_array(F.col("probability"))[1].alias("_p0"),
    )
    both = loaded.transform(first)
    same = (F.col("_pred0") == F.col(L.PREDICTION)) & (F.col("_p0") == vector_to_array(F.col("probability"))[1])
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(~F.coalesce(same, F.lit(False)), 1)).cast("int").alias("n_diff"),
    )


@register("classifier_comparison")
def q_classifier_comparison(spark, sf_dir):
    """One row per classifier: held-out weighted F1 on the same split."""
    train, test = _split(spark, sf_dir)
    out = None
    for name, scored in TR.compare_classifiers(train, test, _classifiers(), MODEL_MIN_DF).items():
        row = E.weighted_f1(scored).select(F.lit(name).alias("model"), "f1")
        out = row if out is None else out.unionByName(row)
    return out


@register("best_model_params")
def q_best_model_params(spark, sf_dir):
    """Parameters of every stage of the tuned job's model."""
    return _tuned(spark, sf_dir)["params"]


@register("tuned_logreg_job")
def q_tuned_logreg_job(spark, sf_dir):
    """The tuned logistic-regression job with its original settings: 0.9/0.1 split
    (seed 12345), regParam {1e-7, 1e-5, 1e-3, 1e-1} × minDF {55, 75, 95} documents,
    trainRatio 0.7, maxIter 300, thresholds 0.7/0.3. One row per grid point with its validation F1, plus the
    best model's held-out F1."""
    out = _tuned(spark, sf_dir)
    test_f1 = out["f1"].first()["f1"]
    return out["metrics"].withColumn("test_f1", F.lit(test_f1))


@register(
    "forest_stored_features",
    sql.with_prep(
        f"SELECT project_id, final_status, TRUE AS consistent FROM prep WHERE NOT ({L.key_split_sql('project_id')})"
    ),
)
def q_forest_stored_features(spark, sf_dir):
    """The forest job on features that were written as Parquet: every held-out row, with
    the check that class, probability and raw scores agree."""
    path = materialise_features(
        prepared(spark, sf_dir), scratch_path(spark, "stored-features"), MODEL_MIN_DF, "keep",
        ("project_id", L.LABEL, "features"),
    )
    _, scored = TR.forest_on_stored(spark, path, "project_id")
    return scored.select("project_id", L.LABEL, _score_check("forest").alias("consistent"))


@register(
    "tuned_gbt",
    sql.with_prep(
        f", sides AS (SELECT final_status, {L.key_split_sql('project_id')} AS train FROM prep) "
        "SELECT d.df AS \"minDF\", count(*) AS n_test, count(*) FILTER (WHERE final_status = 1) AS n_positive, "
        "TRUE AS f1_valid FROM sides, "
        f"(VALUES {', '.join(f'(CAST({m!r} AS DOUBLE))' for m in L.MIN_DFS)}) d(df) WHERE NOT train GROUP BY d.df"
    ),
)
def q_tuned_gbt(spark, sf_dir):
    """Boosted trees tuned over minDF: per threshold the held-out rows of the best
    model's confusion matrix, and whether the validation F1 lies in 0 to 1."""
    out = TR.tuned_logreg(
        prepared(spark, sf_dir), reg_params=None, key="project_id", classifier=L.gradient_boosted_trees()
    )
    held = out["confusion"].groupBy().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col(L.LABEL) == 1, F.col("count"))), F.lit(0)).alias("p"),
    ).first()
    return out["metrics"].select(
        "minDF", F.lit(held["n"]).cast("long").alias("n_test"), F.lit(held["p"]).cast("long").alias("n_positive"),
        F.col("f1").between(0, 1).alias("f1_valid"),
    )
