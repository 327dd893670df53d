"""Feature materialisation, stage by stage or as one pipeline.

``featurise`` fits and applies each stage in turn and keeps every
intermediate frame inspectable (tokens, filtered, counts, TF-IDF, indices,
features). The stateless text stages run once and are materialised, because
each later ``fit`` and the final ``transform`` read them again.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from fundcast.operators import features as FT
from fundcast.session import cut_lineage
from fundcast.sinks import write_parquet

#: What the stages after the text read besides the tokens.
STRUCTURED = ("days_campaign", "hours_prepa", "goal", "country2", "currency2")
STAGE_ORDER = ("tokens", "filtered", "vectorized", "tfidf", "indexed", "features")


def featurise(
    prep: DataFrame,
    min_df: float = 1.0,
    handle_invalid: str = "error",
    upto: str = "features",
    keep: list[str] | None = None,
):
    """Returns ``(frames, models)``: the frame after each stage up to
    ``upto`` and the fitted models (``count_vectorizer``, ``idf``,
    ``indexer``). ``keep`` narrows the columns carried past the text stages
    (and materialised); by default every column is kept."""
    if upto not in STAGE_ORDER:
        raise ValueError(f"upto must be one of {STAGE_ORDER}")
    frames: dict[str, DataFrame] = {}
    models = {}
    frames["tokens"] = FT.tokenizer().transform(prep)
    filtered = FT.stop_words().transform(frames["tokens"])
    if keep is not None:
        filtered = filtered.select(*keep, "filtered")
    frames["filtered"] = cut_lineage(filtered, "filtered")
    if upto in ("tokens", "filtered"):
        return frames, models
    models["count_vectorizer"] = FT.whole_vocabulary(FT.count_vectorizer(min_df).fit(frames["filtered"]))
    frames["vectorized"] = models["count_vectorizer"].transform(frames["filtered"])
    if upto == "vectorized":
        return frames, models
    models["idf"] = FT.idf().fit(frames["vectorized"])
    frames["tfidf"] = models["idf"].transform(frames["vectorized"])
    if upto == "tfidf":
        return frames, models
    models["indexer"] = FT.indexers(
        [("country2", "country_indexed"), ("currency2", "currency_indexed")], handle_invalid
    ).fit(frames["tfidf"])
    frames["indexed"] = models["indexer"].transform(frames["tfidf"])
    if upto == "indexed":
        return frames, models
    frames["features"] = FT.assembler().transform(frames["indexed"])
    return frames, models


def materialise_features(
    prep: DataFrame, path: str, min_df: float = 1.0, handle_invalid: str = "error", columns=None
) -> str:
    """Write the fully featurised frame (vectors included) as Parquet; ``columns`` keeps
    those alone, and nothing else is carried past the text stages."""
    keep = None
    if columns is not None:
        keep = list(dict.fromkeys([*[c for c in prep.columns if c in columns], *STRUCTURED]))
    frames, _ = featurise(prep, min_df, handle_invalid, keep=keep)
    out = frames["features"]
    return write_parquet(out.select(*columns) if columns is not None else out, path)


def text_pipeline(min_df: float = 1.0) -> Pipeline:
    """Tokenizer, stop words, counts, IDF as one 4-stage pipeline."""
    return Pipeline(stages=[FT.tokenizer(), FT.stop_words(), FT.count_vectorizer(min_df), FT.idf()])


def fit_text_pipeline(df: DataFrame, min_df: float = 1.0) -> PipelineModel:
    """Fit the 4-stage text pipeline with the stateless stages run once:
    the result is the same ``PipelineModel`` (4 stages) ``text_pipeline``
    would give, without re-tokenising for every fit."""
    tok, sw = FT.tokenizer(), FT.stop_words()
    filtered = cut_lineage(sw.transform(tok.transform(df)), "text-tokens")
    counts = FT.whole_vocabulary(FT.count_vectorizer(min_df).fit(filtered))
    weights = FT.idf().fit(counts.transform(filtered))
    return PipelineModel(stages=[tok, sw, counts, weights])
