"""Quality rules judged per document and per host (native expressions only).

Every document is measured against a few text rules. Failures are aggregated
per host, each host's failure rate is shrunk towards the corpus with an
empirical beta prior, and hosts whose shrunk rate is too high take all their
documents with them.

Edge cases: a null or empty text has no words and fails the base rules; a null
host is a host of its own; repeated rows are judged like any others and count
once each; an empty table gives an empty result; extra columns are carried
along only through ``keep``. Windows are compared by 64-bit hash within one
document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundcast.llm.words import let, without_spaces, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected when its shrunk failure rate exceeds this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's strength (pseudo-documents), for corpora in which all
#: hosts fail alike (no variance: strong prior) or hosts fail all or nothing.
PRIOR_STRENGTH = (2.0, 1000.0)


def repeated_words(ws: Column, window: int = 3) -> Column:
    """Words covered by a ``window``-word run that occurs at least twice in ``ws``."""

    def runs(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - window)
        return F.transform(at, lambda i: F.xxhash64(*[h[i + k] for k in range(window)]))

    def covered(r: Column) -> Column:
        return let(
            F.sort_array(F.transform(r, lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
            lambda z: F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(
                                z,
                                lambda e, k: ((k > 0) & (F.get(z, k - 1)["x"] == e["x"]))
                                | F.coalesce(F.get(z, k + 1)["x"] == e["x"], F.lit(False)),
                            ),
                            lambda e: F.array(*[e["i"] + k for k in range(window)]),
                        )
                    )
                )
            ),
        )

    return F.when(F.size(ws) < window, F.lit(0)).otherwise(
        let(
            let(F.transform(ws, lambda w: F.xxhash64(w)), runs),
            lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0)).otherwise(covered(r)),
        )
    ).cast("long")


def duplicate_lines(text: Column) -> Column:
    """``\\n``-split lines that hold a word and equal an earlier line."""
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: without_spaces(line) != ""
    )
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words of each whole text; one narrow pass, no shuffle."""
    t = F.coalesce(F.col(text), F.lit(""))
    numbers = let(
        words(t),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"), repeated_words(ws).alias("n_repeat_words")
        ),
    )
    return docs.select(
        *keep,
        numbers.alias("_words"),
        F.char_length(without_spaces(t)).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(t).alias("n_dup_lines"),
    ).select(
        *keep, F.col("_words.n_words").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("_words.n_repeat_words").alias("n_repeat_words"),
    )


def rule_failures() -> dict[str, Column]:
    """Rule name -> whether the measured document fails it."""
    n = F.col("n_words")
    return {
        "few_words": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
    }


def host_rates(judged: DataFrame, host: str = "source", failed: str = "base_failed") -> DataFrame:
    """One row per host: n_docs, n_failed, rate and the beta-shrunk ``host_rate``.

    The prior Beta(m*s, (1-m)*s) has the corpus failure rate ``m`` as mean; its
    strength ``s`` comes from the spread of host rates (method of moments,
    between-host variance less binomial noise), kept within PRIOR_STRENGTH.
    Counting aggregates partially first, so a host with a third of all rows
    sends one row per task.
    """
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")
    )
    n, k = F.col("n_docs"), F.col("n_failed")
    p = k / n
    corpus = hosts.agg(
        F.sum(n).alias("n"), F.sum(k).alias("k"), F.count("*").alias("hosts"), F.sum(n * p * p).alias("np2")
    ).first()  # four numbers
    m, strength = prior(corpus.n or 0, corpus.k or 0, corpus.hosts, corpus.np2 or 0.0)
    return hosts.select("host", "n_docs", "n_failed", p.alias("rate"), ((k + m * strength) / (n + strength)).alias("host_rate"))


def prior(n: int, k: int, hosts: int, np2: float) -> tuple[float, float]:
    """Mean and strength of the beta prior from the documents, failures and hosts of
    the corpus and the sum of n * rate**2 over hosts."""
    if not n:
        return 0.0, PRIOR_STRENGTH[0]
    m = k / n
    spread = np2 / n - m * m  # size-weighted variance of host rates
    noise = m * (1 - m) * hosts / n  # what binomial noise alone would give
    low, high = PRIOR_STRENGTH
    return m, min(max(m * (1 - m) / max(spread - noise, 1e-12) - 1, low), high)


def judge(
    measured: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """``measured`` rows with base_failed, host_rate and kept."""
    failed = F.lit(False)
    for rule in rule_failures().values():
        failed = failed | rule
    judged = measured.withColumn("base_failed", failed)
    rates = host_rates(judged, host).select(F.col("host").alias("_host"), "host_rate")
    # per-host verdicts are small, but not provably so: the planner broadcasts
    # them by their measured size, and AQE splits a hot host otherwise
    return (
        judged.join(rates, F.col(host).eqNullSafe(F.col("_host")), "left")
        .drop("_host")
        .withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))
    )
