"""Quality rules whose failures are judged host by host.

Each document is measured in one pass. A host's rate of failing documents is shrunk towards
the rates of all hosts by a beta prior fitted to them (method of moments), so that a host of
few documents is not condemned by chance; a host whose shrunken rate is over the limit loses
all its documents. SQL functions only; texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triprollup.llm.tables import stored
from triprollup.llm.words import SPACE, bound, shingles_of, words_of

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host is rejected if over half of its documents are expected to fail.
HOST_LIMIT = 0.5
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

#: The prior where hosts don't differ, or there is one: as strong as so many documents.
PRIOR_DOCUMENTS = 100.0


def _repeated_words(hashes: Column) -> Column:
    """Number of words in a window whose hash occurs twice or more."""

    def places(sorted_: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            before, after = F.get(sorted_, j - 1), F.get(sorted_, j + 1)
            equal = (before["h"] == x["h"]) | (after["h"] == x["h"])
            return F.coalesce(equal, before["h"] == x["h"], after["h"] == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(sorted_, twin), lambda x: x["i"]))

    def covered(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
        total = F.aggregate(
            bound(F.array_sort(pairs), places),
            start,
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")
            ),
        )
        once = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(once, F.lit(0).cast("bigint")).otherwise(total["n"])

    return bound(hashes, covered)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null or empty text has no words and fails. Windows are compared by a 64-bit hash of
    their words within one text. Repeated rows are measured each; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def size_of(pattern: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("bigint")

    measured = docs.select(
        "doc_id",
        "source",
        bound(
            words_of(text),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                _repeated_words(shingles_of(w, WINDOW)).alias("n_repeat_words"),
            ),
        ).alias("_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        size_of(SYMBOLS).alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("bigint")
        .alias("n_dup_lines"),
    )
    n, repeated = F.col("_words.n_words"), F.col("_words.n_repeat_words")
    return measured.select(
        "doc_id",
        "source",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated.alias("n_repeat_words"),
        ((n < MIN_WORDS) | (repeated * 100 > n * MAX_REPEAT_PERCENT)).alias("base_failed"),
    )


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """source, n_docs, n_failed, failure_rate, shrunk_rate and rejected of each host.

    With m and v the mean and variance of the hosts' rates, the prior is
    beta(m s, (1 - m) s), s = m (1 - m) / v - 1. Where v is 0 or too large for a beta, s is
    100 or 0. Rows without a source belong to no host.
    """
    hosts = (
        measured.filter(F.col("source").isNotNull())
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.count_if("base_failed").alias("n_failed"),
        )
        .withColumn("failure_rate", F.col("n_failed") / F.col("n_docs"))
    )
    prior = hosts.agg(
        F.avg("failure_rate").alias("_m"), F.var_pop("failure_rate").alias("_v")
    ).select(
        "_m",
        F.when(F.col("_v") > 0, F.greatest(F.lit(0.0), F.expr("_m * (1 - _m) / _v - 1")))
        .otherwise(F.lit(PRIOR_DOCUMENTS))
        .alias("_s"),
    )
    # The prior is one row.
    shrunk = F.expr("(n_failed + _m * _s) / (n_docs + _s)")
    return (
        hosts.crossJoin(F.broadcast(prior))
        .withColumn("shrunk_rate", shrunk)
        .withColumn("rejected", F.col("shrunk_rate") > limit)
        .drop("_m", "_s")
    )


def judged(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The measures of each document, and `kept`: neither it nor its host has failed.

    Measures are written once to the shared folder; hosts are counted from there, with partial
    counts before the shuffle. The verdicts are joined back by host; a host that holds a third
    of all rows is split by adaptive execution. A document without a source stands by itself.
    """
    measured = stored(measures(docs), "measures")
    rejected = host_verdicts(measured, limit).filter("rejected").select("source", "rejected")
    kept = ~F.col("base_failed") & F.col("rejected").isNull()
    return measured.join(rejected, "source", "left").withColumn("kept", kept).drop("rejected")
