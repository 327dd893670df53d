"""Toxicity scores: gradient-boosted trees over dense features, calibrated by
isotonic regression.

Features of a whole text: densities of lexicon words and of lexicon words in
disguise (leet digits, stretched or spaced letters), their weights, hits close
to a second-person pronoun, and rates of capitals, punctuation and obfuscation.
The lexicon is a short list of insults plus words and word beginnings that the
training labels single out (likelihood-ratio test).

Fitting uses at most ``FIT_ROWS`` labelled rows, a sample by hash that is the
same on every run; everything else covers all rows. Three of every four training
rows fit lexicon and trees, the fourth calibrates.

Edge cases: null and empty texts have zero features and get a score like any
other; rows without a label, with a null label or a null id are not trained on;
without both classes among the training rows there is no model, and the score is
hits / (hits + 1); repeated rows score alike; very long texts are read whole;
an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.session import cut_lineage

#: Labelled rows that a fit looks at, at most (their ids are broadcast: 8 bytes each).
FIT_ROWS = 20_000
#: Likelihood-ratio statistic and share of toxic texts that admit a lexicon entry.
MIN_G2, MIN_SHARE = 30.0, 0.6
#: Word beginnings of these lengths may be lexicon entries.
STEMS = (5, 6, 7)
TREES, DEPTH, STEP = 20, 4, 0.2
NEAR = 5  # words between a hit and a second-person pronoun

# Insults, and second-person pronouns of the languages handled.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers trash scum clown clowns pathetic worthless "
    "disgusting imbecile dimwit halfwit jerk freak vermin filth lowlife scumbag bastard bitch asshole "
    "idiota estúpido imbécil basura crétin connard débile abruti idiotin trottel dummkopf abschaum"
).split()
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu toi ton ta tes vous votre du dich dir dein deine ihr euch tú ti usted vos".split()
)
LEET = str.maketrans("013457@$!|", "oieastasii")

FEATURES = (
    "hit_density", "hits", "weight_density", "max_weight", "stem_density", "stems", "disguised_density",
    "near_second", "second_density", "capitals", "shouted", "punctuation", "exclaimed", "obfuscated", "log_words",
)
_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<!\S)(?=\S*[0-9@$!|*])(?=\S*[^\W\d_])[\w@$!|*]{3,30}(?!\S)")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-*_]){3,20}[^\W\d_](?!\w)")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)  # entry -> log odds
    stems: dict[str, float] = field(default_factory=dict)


def plain_lexicon() -> Lexicon:
    return Lexicon({w: 4.0 for w in INSULTS})


def features(text: str, lexicon: Lexicon) -> list[float]:
    low = text.lower()
    words = _WORD.findall(low)
    n = len(words)
    present = set(words)
    known = lexicon.words.keys() & present
    hits = [(i, w) for i, w in enumerate(words) if w in known] if known else []
    stems = []
    if lexicon.stems:
        by_stem = {w: s for w in present for k in STEMS if (s := w[:k]) in lexicon.stems}
        if by_stem:
            stems = [by_stem[w] for w in words if w in by_stem]
    disguised = 0
    odd = 0
    for piece in _MIXED.findall(low):
        odd += 1
        if re.sub(r"\*", "", piece.strip("!*|")).translate(LEET) in lexicon.words:
            disguised += 1
    for piece in _SPACED.findall(low):
        odd += 1
        if re.sub(r"[ .\-*_]", "", piece) in lexicon.words:
            disguised += 1
    if _STRETCHED.search(low):
        for w in present:
            if _STRETCHED.search(w):
                odd += 1
                if _STRETCHED.sub(r"\1", w) in lexicon.words or _STRETCHED.sub(r"\1\1", w) in lexicon.words:
                    disguised += 1
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON] if SECOND_PERSON & present else []
    near = 0
    for i, _ in hits if second else ():
        at = bisect_left(second, i - NEAR)
        near += at < len(second) and second[at] <= i + NEAR
    weights = [lexicon.words[w] for _, w in hits]
    letters = max(1, sum(map(len, words)))
    total = len(hits) + disguised
    per = 100.0 / max(n, 1)
    capitals = sum(1 for c in text if c.isupper()) if not text.islower() else 0
    marks = len(text) - len(_PUNCTUATION.sub("", text))
    return [
        total * per, float(total), sum(weights) * per, max(weights, default=4.0 if disguised else 0.0),
        len(stems) * per, float(len(stems)), disguised * per, near * per, len(second) * per,
        capitals / letters, len(_SHOUTED.findall(text)) * per, marks / max(len(text), 1),
        text.count("!") * per, odd * per, math.log1p(n),
    ]


_PUNCTUATION = re.compile(r"[^\w\s]+")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that hold a word or a word beginning, within a task."""
    seen: dict[str, list[int]] = {}
    sizes = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
            t = int(toxic.as_py())
            sizes[t] += 1
            own = set(_WORD.findall((text.as_py() or "").lower()))
            for entry in own | {w[:k] + "*" for w in own for k in STEMS if len(w) >= k}:
                seen.setdefault(entry, [0, 0])[t] += 1
    entries = ["", *seen]
    counts = [sizes, *seen.values()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(entries, pa.string()), pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64())],
        names=["entry", "clean", "toxic"],
    )


def learn_lexicon(training: DataFrame) -> Lexicon:
    """Insults plus the entries that ``training`` (text, toxic) singles out. The
    training rows are bounded, so what comes to the driver is bounded as well."""
    counts = training.select("text", "toxic").mapInArrow(_count, "entry string, clean long, toxic long")
    counts = cut_lineage(counts.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "lexicon")
    totals = counts.where("entry = ''").first()
    lexicon = plain_lexicon()
    if totals is None or not totals.clean or not totals.toxic:
        return lexicon
    nc, nt = totals.clean, totals.toxic
    share = nt / (nc + nt)
    c, t = F.col("clean"), F.col("toxic")
    n = c + t

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    g2 = 2 * (part(t, n * share) + part(c, n * (1 - share)))
    found = counts.where((F.col("entry") != "") & (t / n >= MIN_SHARE) & (g2 >= MIN_G2)).select("entry", "clean", "toxic")
    for r in found.collect():
        odds = math.log((r.toxic + 0.5) / (nt + 1)) - math.log((r.clean + 0.5) / (nc + 1))
        if r.entry.endswith("*"):
            lexicon.stems[r.entry[:-1]] = odds
        else:
            lexicon.words[r.entry] = odds
    return lexicon


def with_features(
    docs: DataFrame, lexicon: Lexicon, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False
) -> DataFrame:
    """``keep`` columns (and the text, if wanted) and ``features`` (array) of every
    whole text; narrow."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(lexicon)
    kept = docs.select(*keep, "text")
    out = [*keep, "text"] if with_text else list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t.as_py() or "", held.value) for t in batch.column("text")], float)
            rows = rows.reshape(batch.num_rows, len(FEATURES))
            values = pa.array(rows.ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1) * len(FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in out] + [pa.ListArray.from_arrays(offsets, values)], names=[*out, "features"]
            )

    fields = ", ".join(f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in out)
    return kept.mapInArrow(run, f"{fields}, features array<double>")


@dataclass
class Model:
    lexicon: Lexicon
    trees: object | None = None
    calibration: object | None = None


def training_rows(docs: DataFrame, labels: DataFrame, usable, limit: int = FIT_ROWS) -> DataFrame:
    """doc_id, text, toxic, part (0-3) of at most about ``limit`` usable labelled rows."""
    ids = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)"
    ).where(usable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = min(1.0, limit / max(1, ids.count()))
    ids = ids.where(pick < int(share * (1 << 30))).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)))
    # at most about ``limit`` short rows, so their broadcast is bounded by the parameter
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, usable=lambda doc_id: F.lit(True), limit: int = FIT_ROWS) -> Model:
    rows = cut_lineage(training_rows(docs, labels, usable, limit), "toxic-train")
    lexicon = learn_lexicon(rows.where("part < 3"))
    ready = with_features(rows, lexicon, ("toxic", "part")).select(
        F.col("toxic").cast("double").alias("label"), "part", array_to_vector("features").alias("vector")
    )
    ready = cut_lineage(ready, "toxic-features")
    sizes = {(r.label, r.cal): r.n for r in ready.groupBy("label", (F.col("part") == 3).alias("cal")).agg(F.count("*").alias("n")).collect()}
    if not sizes.get((0.0, False)) or not sizes.get((1.0, False)):
        return Model(lexicon)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7,
    ).fit(ready.where("part < 3").repartition(4))
    calibrating = "part = 3" if sizes.get((0.0, True)) and sizes.get((1.0, True)) else "part < 3"
    judged = trees.transform(ready.where(calibrating)).select("label", vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="calibrated").fit(judged)
    return Model(lexicon, trees, calibration)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with all its columns, without the rows that are scored as toxic."""
    columns = docs.columns
    return score(docs, model, tuple(c for c in columns if c != "text"), with_text=True).where("predicted = 0").select(*columns)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """``keep``, score, predicted, hits for every row (and the text, if wanted). The calibrated probability is a
    step function; a thousandth of the raw one keeps the order within a step."""
    kept = [*keep, "text"] if with_text else list(keep)
    rows = with_features(docs, model.lexicon, keep, with_text)
    hits = F.col("features")[FEATURES.index("hits")]
    if model.trees is None:
        out = rows.select(*kept, (hits / (hits + 1)).alias("score"), hits.alias("hits"))
    else:
        judged = model.trees.transform(rows.withColumn("vector", array_to_vector("features")))
        judged = judged.select(*kept, hits.alias("hits"), vector_to_array("probability")[1].alias("p"))
        judged = model.calibration.transform(judged)
        mixed = 0.999 * F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)) + 0.001 * F.col("p")
        out = judged.select(*kept, mixed.alias("score"), "hits")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fold(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``; null ids stay null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n
