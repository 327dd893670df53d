"""Feature stages (``pyspark.ml``) with the original jobs' settings, and the
fitted state as tables.

Fitting is distributed (vocabulary and label counts are grouped counts over
the cluster); only the fitted state comes back to the driver, and its size
is bounded: a vocabulary by ``vocabSize``, an index by its distinct labels.
"""

from __future__ import annotations

from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from fundcast.operators.sizing import broadcast_if_within

# Fixed values of the original feature stages.
TOKEN_PATTERN = r"\W+"
MAX_VOCAB = 1 << 18  # 262144
FEATURE_INPUTS = ["tfidf", "days_campaign", "hours_prepa", "goal", "country_indexed", "currency_indexed"]


def tokenizer(input_col: str = "text", output_col: str = "tokens") -> RegexTokenizer:
    """Split on runs of non-word characters after lower-casing; tokens of
    length ≥ 1 (``\\W`` is ASCII-only: ``café`` → ``caf``)."""
    return RegexTokenizer(
        inputCol=input_col, outputCol=output_col, pattern=TOKEN_PATTERN, gaps=True,
        toLowercase=True, minTokenLength=1,
    )


def stop_words(input_col: str = "tokens", output_col: str = "filtered") -> StopWordsRemover:
    """Spark's default English list (181 words), case-insensitive."""
    return StopWordsRemover(inputCol=input_col, outputCol=output_col)


def count_vectorizer(
    min_df: float = 1.0, input_col: str = "filtered", output_col: str = "vectorized",
    vocab_size: int = MAX_VOCAB,
) -> CountVectorizer:
    """``min_df`` ≥ 1 is a document count, < 1 a fraction of documents. The fitted
    vocabulary lives on the driver and in every vector; ``vocab_size`` is its
    documented limit, and ``whole_vocabulary`` makes reaching it an error."""
    return CountVectorizer(
        inputCol=input_col, outputCol=output_col, minDF=min_df, vocabSize=vocab_size, minTF=1.0
    )


def idf(input_col: str = "vectorized", output_col: str = "tfidf") -> IDF:
    """Weights ln((N + 1) / (df + 1)); minDocFreq 0."""
    return IDF(inputCol=input_col, outputCol=output_col, minDocFreq=0)


def indexer(input_col: str, output_col: str, handle_invalid: str = "error") -> StringIndexer:
    """Index by descending frequency (ties by label). ``error`` (the original
    behaviour) fails on null or unseen values; ``keep`` maps them to the last
    index, ``skip`` drops their rows."""
    return StringIndexer(
        inputCol=input_col, outputCol=output_col, handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def indexers(pairs, handle_invalid: str = "error") -> StringIndexer:
    """Several columns indexed by one estimator: each column keeps its own
    labels, but all label counts come from a single aggregation pass."""
    return StringIndexer(
        inputCols=[i for i, _ in pairs], outputCols=[o for _, o in pairs],
        handleInvalid=handle_invalid, stringOrderType="frequencyDesc",
    )


def assembler(inputs=None, output_col: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs or FEATURE_INPUTS), outputCol=output_col)


def text_stages():
    """The stateless text stages: safe to run once, before any split or search."""
    return [tokenizer(), stop_words()]


def fitted_stages(min_df: float = 1.0, handle_invalid: str = "error"):
    """Stages that learn from data: counts, IDF, the category indexer, assembler."""
    return [
        count_vectorizer(min_df),
        idf(),
        indexers([("country2", "country_indexed"), ("currency2", "currency_indexed")], handle_invalid),
        assembler(),
    ]


def feature_stages(min_df: float = 1.0, handle_invalid: str = "error"):
    return text_stages() + fitted_stages(min_df, handle_invalid)


def whole_vocabulary(model):
    """``model`` (a fitted count stage or a pipeline with one), unless its vocabulary
    is full: then terms may have been dropped, which is a ``ValueError``."""
    for stage in getattr(model, "stages", [model]):
        if isinstance(stage, CountVectorizerModel) and len(stage.vocabulary) >= stage.getVocabSize():
            raise ValueError(
                f"the vocabulary reached its limit of {stage.getVocabSize()} terms and may lack others; "
                "raise min_df (a fraction of the documents bounds it at every size) or vocab_size"
            )
    return model


def without_slot_names(df: DataFrame) -> DataFrame:
    """``df`` whose vector columns no longer name their numeric slots. An assembled vector
    has a name for every term, and a fit sends them with every task of every pass; the
    number of slots and the categories of the nominal ones (trees split by them) stay."""
    bare = {}
    for field in df.schema.fields:
        group = field.metadata.get("ml_attr") if isinstance(field.dataType, VectorUDT) else None
        if group and "attrs" in group:
            kept = {kind: slots for kind, slots in group["attrs"].items() if kind != "numeric"}
            group = {k: v for k, v in group.items() if k != "attrs"} | ({"attrs": kept} if kept else {})
            bare[field.name] = F.col(field.name).alias(field.name, metadata=field.metadata | {"ml_attr": group})
    return df.select(*[bare.get(c, F.col(c)) for c in df.columns]) if bare else df


def vocabulary_bytes(cv_model) -> int:
    """Approximate in-memory size of the (idx, term) table of a vocabulary."""
    return sum(len(t.encode("utf-8")) + 32 for t in cv_model.vocabulary)


def vocabulary_table(spark: SparkSession, cv_model, idf_model=None) -> DataFrame:
    """(idx, term[, df]) of a fitted vocabulary; ``idx`` orders terms by
    corpus frequency. ``term_at`` answers single lookups. The table has at
    most ``vocabSize`` rows and is marked for broadcast when
    ``vocabulary_bytes`` is within the session's broadcast threshold."""
    vocab = cv_model.vocabulary
    if idf_model is None:
        schema = StructType([StructField("idx", LongType()), StructField("term", StringType())])
        table = spark.createDataFrame(list(enumerate(vocab)), schema)
        return broadcast_if_within(table, vocabulary_bytes(cv_model))
    dfs = idf_model.docFreq
    schema = StructType(
        [StructField("idx", LongType()), StructField("term", StringType()), StructField("df", LongType())]
    )
    return spark.createDataFrame([(i, t, int(dfs[i])) for i, t in enumerate(vocab)], schema)


def idf_table(spark: SparkSession, cv_model, idf_model) -> DataFrame:
    """(idx, term, idf) of a fitted IDF."""
    weights = idf_model.idf.toArray()
    schema = StructType(
        [StructField("idx", LongType()), StructField("term", StringType()), StructField("idf", DoubleType())]
    )
    return spark.createDataFrame(
        [(i, t, float(weights[i])) for i, t in enumerate(cv_model.vocabulary)], schema
    )


def term_at(cv_model, i: int) -> str:
    return cv_model.vocabulary[i]
