"""Training jobs: featurise, split, fit, tune, score, compare, save.

Layout of the work:
* the stateless text stages (tokenizer, stop words) run once on the whole
  input, before any split or search, instead of once per grid point;
* the tokenised frame is checkpointed to the shared checkpoint folder, so
  iterative fitting reads a materialised table and a lost executor costs a
  re-read, not a recomputation from the raw sources;
* only the stages that learn (counts, IDF, indexers, assembler, classifier) are
  refitted; the search counts its terms once for all minDF, whose vocabularies are
  nested, and its best model gets the text stages back, so that it scores prepared rows;
* classifiers are fitted on written features, in as many parts as their rows are worth.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.operators import features as FT
from fundcast.operators import learn as L
from fundcast.operators import terms as TM
from fundcast.operators.evaluate import f1_evaluator
from fundcast.session import cut_lineage


# What the fitted stages and the scoring read; everything else stays behind.
MODEL_COLUMNS = ("project_id", "final_status", "filtered", "days_campaign", "hours_prepa", "goal", "country2", "currency2")


def tokenised(prep: DataFrame, checkpoint: bool = True, columns=MODEL_COLUMNS) -> DataFrame:
    """Prepared campaigns with ``filtered`` tokens added, run once and
    materialised; ``columns=None`` keeps every column (text and tokens too)."""
    out = Pipeline(stages=FT.text_stages()).fit(prep).transform(prep)
    if columns is not None:
        out = out.select(*[c for c in columns if c in out.columns])
    return cut_lineage(out, "tokenised") if checkpoint else out


def model_pipeline(classifier, min_df: float, handle_invalid: str = "keep") -> Pipeline:
    return Pipeline(stages=FT.fitted_stages(min_df, handle_invalid) + [classifier])


class Fitted:
    """Classifiers fitted on the same written features: ``features`` (the fitted feature
    stages), ``models`` by name, and the ``train`` and ``test`` rows as they see them."""

    def __init__(self, train: DataFrame, test: DataFrame, classifiers: dict, min_df: float,
                 handle_invalid: str = "keep", parallelism: int = 4):
        self.features = FT.whole_vocabulary(Pipeline(stages=FT.fitted_stages(min_df, handle_invalid)).fit(train))
        n = train.count()
        kept = [c for c in test.columns if c != "filtered"]
        rows = self.features.transform(train).select(*kept, "features")
        slots = vector_size(rows) if any(keeps_slots(c) for c in classifiers.values()) else 0
        self.train = written(rows, "train-features", n, slots)
        self.test = written(self.features.transform(test).select(*kept, "features"), "test-features", n, slots)
        fit_on = self.train.select(L.LABEL, "features")
        dealt = in_parts(fit_on, fit_parts(n, slots))
        names = list(classifiers)
        fitted = in_parallel(
            lambda name: classifiers[name].fit(dealt if keeps_slots(classifiers[name]) else fit_on),
            names, parallelism, train.sparkSession,
        )
        self.models = dict(zip(names, fitted, strict=True))


#: Rows of features that one task of an iterative fit takes, at least, unless they hold
#: more bytes than FIT_BYTES: trees keep four for every slot of a row, filled or not, and
#: boosting reads that much three times a pass. Every part sends its sums over the slots
#: of each node, which are a small share of it only if it has LEAST_ROWS rows.
FIT_ROWS = 20_000
FIT_BYTES = 64 << 20
SLOT_BYTES = 4
LEAST_ROWS = 2_000


def fit_parts(rows: int, slots: int = 0) -> int:
    """The parts in which ``rows`` rows are fitted; ``slots`` if a fit keeps all of them."""
    full = min(rows * slots * SLOT_BYTES // FIT_BYTES, rows // LEAST_ROWS)
    return max(1, rows // FIT_ROWS, full)


def in_parts(df: DataFrame, parts: int) -> DataFrame:
    """``df`` (a written table) dealt evenly to ``parts`` tasks, if its files give fewer:
    readers put many small files into one task, and several such parts are one again."""
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def keeps_slots(classifier) -> bool:
    """Whether a fit keeps every slot of a row, filled or not, as trees do."""
    return classifier.hasParam("maxBins")


def vector_size(df: DataFrame, column: str = "features") -> int:
    """Slots of the vectors in ``column``; 0 if no row says."""
    row = df.select(column).first()
    return row[0].size if row else 0


def written(df: DataFrame, name: str, rows: int, slots: int = 0) -> DataFrame:
    """``df`` (about ``rows`` rows) written in no more parts than its rows are worth: a
    fit passes over it many times, and each pass pays for its tasks. What a task carries
    is paid for as often, so the vectors' slots lose their names (their categories stay)."""
    return cut_lineage(FT.without_slot_names(df.coalesce(fit_parts(rows, slots))), name)


def in_parallel(work, items, parallelism: int, spark):
    """``work`` of every item, up to ``parallelism`` at a time: each is a sequence of
    Spark jobs, and concurrent jobs share the executors."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def fit_and_score(train: DataFrame, test: DataFrame, classifier, min_df: float, handle_invalid: str = "keep"):
    """(model that scores tokenised rows, scored test rows); the classifier is fitted on
    written features, not on stages that every pass computes again."""
    fitted = Fitted(train, test, {"model": classifier}, min_df, handle_invalid)
    model = fitted.models["model"]
    return PipelineModel(stages=fitted.features.stages + [model]), model.transform(fitted.test)


def compare_classifiers(
    train: DataFrame,
    test: DataFrame,
    classifiers: dict,
    min_df: float,
    handle_invalid: str = "keep",
    parallelism: int = 4,
):
    """Fit the shared feature stages once, then every classifier on the same
    materialised features; returns {name: scored test frame}."""
    fitted = Fitted(train, test, classifiers, min_df, handle_invalid, parallelism)
    return {name: model.transform(fitted.test) for name, model in fitted.models.items()}


def forest_on_stored(spark, path: str, key: str, classifier=None, train_fraction: float = 0.9):
    """The stored-feature job: features read back from Parquet, split by ``key``, a
    random forest fitted on the training side. Returns (model, scored test rows)."""
    train, test = L.key_split(spark.read.parquet(path), key, train_fraction)
    model = (classifier or L.random_forest()).fit(train)
    return model, model.transform(test)


def scores_table(scored: DataFrame, key: str = "project_id", digits: int = 6) -> DataFrame:
    """(key, label, prediction, p1, raw0, raw1): class-1 probability and raw
    scores as plain doubles."""
    prob = vector_to_array(F.col("probability"))
    raw = vector_to_array(F.col("rawPrediction"))
    return scored.select(
        key,
        L.LABEL,
        L.PREDICTION,
        F.round(prob[1], digits).alias("p1"),
        F.round(raw[0], digits).alias("raw0"),
        F.round(raw[1], digits).alias("raw1"),
    )


def tune(
    train: DataFrame,
    classifier,
    grid_builder,
    train_ratio: float = 0.7,
    seed: int = L.SEED,
    parallelism: int = 1,
    handle_invalid: str = "keep",
) -> TrainValidationSplitModel:
    """Single-split model selection: fit every grid point on ``train_ratio``
    of ``train``, keep the best validation F1, refit it on all of ``train``.
    ``grid_builder(classifier, count_vectorizer)`` returns the param maps."""
    stages = FT.fitted_stages(1.0, handle_invalid)
    pipeline = Pipeline(stages=stages + [classifier])
    tvs = TrainValidationSplit(
        estimator=pipeline,
        estimatorParamMaps=grid_builder(classifier, stages[0]),
        evaluator=f1_evaluator(),
        trainRatio=train_ratio,
        seed=seed,
        parallelism=parallelism,
    )
    model = tvs.fit(train)
    FT.whole_vocabulary(model.bestModel)
    return model


def load_tuned(path: str) -> TrainValidationSplitModel:
    return TrainValidationSplitModel.load(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _parts(df: DataFrame, fraction: float, seed: int, key: str | None):
    if key is None:
        return L.random_split(df, (fraction, 1.0 - fraction), seed, materialise=False)
    return L.key_split(df, key, fraction, seed)


def document_vocabulary(rows: DataFrame, min_df: float) -> list[tuple[str, int]]:
    """(term, df) by falling df, then by term, of the terms that at least ``min_df`` of
    ``rows`` hold (a share of them below 1). A model holds its vocabulary, so the driver
    may; more terms than it may hold are an error."""
    least = min_df if min_df >= 1 else min_df * rows.count()
    vocab = TM.document_frequencies(rows).where(F.col("df") >= least)
    found = vocab.orderBy(F.desc("df"), "term").limit(FT.MAX_VOCAB).collect()
    if len(found) >= FT.MAX_VOCAB:
        raise ValueError(f"the vocabulary reached its limit of {FT.MAX_VOCAB} terms; raise min_df")
    return [(r["term"], r["df"]) for r in found]


def _counting(terms: list[str], min_df: float) -> CountVectorizerModel:
    model = CountVectorizerModel.from_vocabulary(terms, inputCol="filtered", outputCol="vectorized", minTF=1.0)
    model.set(model.minDF, float(min_df))
    return model


def nested_features(rows: DataFrame, min_dfs, handle_invalid: str = "keep"):
    """The feature stages of the lowest of ``min_dfs``, from one count of the documents
    that hold each term, and the slots that every other one keeps. Terms are numbered by
    falling document frequency, so a higher threshold's vocabulary is a prefix of it and
    its features are a slice. Returns (stages, {min_df: slots})."""
    n = rows.count()
    least = {m: m if m >= 1 else m * n for m in min_dfs}
    low = min(min_dfs, key=least.get)
    vocab = document_vocabulary(rows, least[low] if least[low] >= 1 else 1)
    stages, inputs = [], list(FT.FEATURE_INPUTS)
    if vocab:
        weights = [math.log((n + 1.0) / (df + 1.0)) for _, df in vocab]
        stages = [
            _counting([t for t, _ in vocab], low),
            ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="vectorized", outputCol="tfidf"),
        ]
    else:  # no term is that common: the other features remain
        inputs.remove("tfidf")
    categories = FT.indexers([("country2", "country_indexed"), ("currency2", "currency_indexed")], handle_invalid)
    stages += [categories.fit(rows), FT.assembler(inputs, "all_features")]
    others = [len(vocab) + i for i in range(len(FT.FEATURE_INPUTS) - 1)]
    return stages, {m: [i for i, (_, df) in enumerate(vocab) if df >= least[m]] + others for m in min_dfs}


def final_stages(train: DataFrame, min_df: float, handle_invalid: str = "keep") -> list:
    """The fitted feature stages of one threshold, as the original pipeline has them;
    without the text stages' counts and weights if no term is common enough."""
    vocab = document_vocabulary(train, min_df)
    categories = FT.indexers([("country2", "country_indexed"), ("currency2", "currency_indexed")], handle_invalid)
    if not vocab:
        return [categories.fit(train), FT.assembler([c for c in FT.FEATURE_INPUTS if c != "tfidf"])]
    counts = _counting([t for t, _ in vocab], min_df)
    return [counts, FT.idf().fit(counts.transform(train)), categories.fit(train), FT.assembler()]


def search(
    train: DataFrame,
    classifier,
    reg_params=L.REG_PARAMS,
    min_dfs=L.MIN_DFS,
    train_ratio: float = 0.7,
    seed: int = L.SEED,
    parallelism: int = 4,
    handle_invalid: str = "keep",
    key: str | None = None,
):
    """regParam x minDF on one validation split of materialised tokens (``tokenised``);
    ``reg_params=None`` searches minDF alone, for any classifier.

    Only minDF changes the features, and its vocabularies are nested: terms are counted
    and features computed once, and each minDF's slice of them is written, so that the
    passes of a fit carry neither the slots nor their names. The best point by validation
    F1 (the first of equals) is fitted again on all of ``train``.
    Returns (model that scores prepared rows, grid, metrics, index of the best point).
    """
    spark = train.sparkSession
    fit_rows, val_rows = _parts(train, train_ratio, seed + 1, key)
    evaluator = f1_evaluator()
    stages, slots = nested_features(fit_rows, min_dfs, handle_invalid)
    wide = PipelineModel(stages=stages)
    n = fit_rows.count()
    widest = max(map(len, slots.values()))

    def kept(size):
        return size if keeps_slots(classifier) else 0

    fit_f = written(wide.transform(fit_rows).select(L.LABEL, "all_features"), "search-fit", n, kept(widest))
    val_f = written(wide.transform(val_rows).select(L.LABEL, "all_features"), "search-validation", n, kept(widest))

    def at(point):
        return classifier if point[0] is None else classifier.copy({classifier.regParam: point[0]})

    def sliced(df, min_df, name):
        part = VectorSlicer(inputCol="all_features", outputCol="features", indices=slots[min_df])
        return written(part.transform(df).select(L.LABEL, "features"), name, n, kept(len(slots[min_df])))

    parts = {m: (sliced(fit_f, m, "slice-fit"), sliced(val_f, m, "slice-validation")) for m in slots}

    def metric(point):
        fit_on, held = parts[point[1]]
        if keeps_slots(classifier):
            fit_on = in_parts(fit_on, fit_parts(n, len(slots[point[1]])))
        return evaluator.evaluate(at(point).fit(fit_on).transform(held))

    grid = L.param_grid(classifier, FT.count_vectorizer(), reg_params, min_dfs)
    points = [tuple({p.name: v for p, v in g.items()}.get(n) for n in ("regParam", "minDF")) for g in grid]
    metrics = in_parallel(metric, points, parallelism, spark)
    best = max(range(len(points)), key=lambda i: metrics[i])
    final = final_stages(train, points[best][1], handle_invalid)
    rows = PipelineModel(stages=final).transform(train).select(L.LABEL, "features")
    size = kept(vector_size(rows))
    rows = written(rows, "search-train", n, size)
    fitted = at(points[best]).fit(in_parts(rows, fit_parts(n, size)) if size else rows)
    return PipelineModel(stages=FT.text_stages() + final + [fitted]), grid, metrics, best


def tuned_logreg(
    prep: DataFrame,
    model_path: str | None = None,
    reg_params=L.REG_PARAMS,
    min_dfs=L.MIN_DFS,
    split=(0.9, 0.1),
    seed: int = L.SEED,
    max_iter: int = 300,
    parallelism: int = 4,
    key: str | None = None,
    classifier=None,
) -> dict:
    """The tuned logistic-regression job: split, search regParam × minDF on
    the training side, score the held-out side, F1 and confusion matrix,
    optionally save the best model with all its stages (it scores prepared
    rows). ``key`` switches both splits to the repeatable key-hash split.
    ``min_dfs`` from 1 on are document counts, below 1 shares of the documents. Another
    ``classifier`` is searched by ``min_dfs`` alone with ``reg_params=None``."""
    from fundcast.operators import evaluate as E
    from fundcast.sinks import save_model

    train, test = _parts(tokenised(prep), split[0], seed, key)
    if classifier is None:
        classifier = L.logistic_regression(max_iter=max_iter)
    model, grid, metrics, best = search(
        train, classifier, reg_params, min_dfs, seed=seed, parallelism=parallelism, key=key
    )
    scored = PipelineModel(stages=model.stages[2:]).transform(test)  # the tokens are there already
    if model_path is not None:
        save_model(model, model_path)
    spark = prep.sparkSession
    return {
        "model": model,
        "best": best,
        "scored": scored,
        "f1": E.weighted_f1(scored),
        "confusion": E.confusion(scored),
        "metrics": L.grid_table(spark, grid, metrics),
        "params": L.explain_params(spark, model),
    }
