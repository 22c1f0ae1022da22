"""Benchmark items in documents: SimHash fingerprints of item-sized windows.

A window is a stretch of a document as many words long as an item. Only a window that shares
a word shingle with an item can be similar to one, so windows are laid where a shingle of a
document occurs in an item, at the same distance from the window's start as there. Each
window, and each item, gets a 64-bit SimHash, in which a shingle counts as often as it occurs.

Fingerprints are cut into radius + 1 blocks. Two that differ in at most `radius` bits agree on
a block, so a join on (length, block, bits) finds all pairs within the radius. Those are
verified by the exact similarity of weighted shingles: the sum over shingles of the smaller
count, divided by that of the larger one.

SQL functions only. The benchmark is broadcast in blocks of a checked size; documents' texts
are not shuffled, and a passage that a third of the documents hold costs one window in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triprollup.llm.tables import ceil_div, stored
from triprollup.llm.words import SHINGLE, bound, shingles_of, words_of

BITS = 64
#: Shingle sets with similarity 0.8 have fingerprints about 10 bits apart, with a standard
#: deviation of 3; at most 2 in 10,000 are more than 20 apart.
RADIUS = 20
MIN_SIMILARITY = 0.8
#: Shingles of the items broadcast at once, about 30 MB with the index; a larger benchmark is
#: taken in blocks.
BLOCK_SHINGLES = 100_000


def simhash(hashes: Column) -> Column:
    """The fingerprint of an array of shingle hashes: bit b is set if most have it set."""

    def votes(h: Column, b: Column) -> Column:
        def bit(x: Column) -> Column:
            return F.call_function("shiftright", x, b).bitwiseAND(F.lit(1).cast("bigint"))

        return F.aggregate(h, F.lit(0).cast("bigint"), lambda acc, x: acc + bit(x)) * 2

    def fingerprint(h: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(BITS - 1)),
            F.lit(0).cast("bigint"),
            lambda acc, b: F.when(
                votes(h, b) > F.size(h),
                acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)),
            ).otherwise(acc),
        )

    return bound(hashes, fingerprint)


def blocks_of(fingerprint: Column, radius: int) -> Column:
    """(block, bits) for each of radius + 1 blocks, whose sizes differ by one bit at most."""
    count, parts, first = radius + 1, [], 0
    for k in range(count):
        size = BITS // count + (k < BITS % count)
        bits = F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << size) - 1))
        parts.append(F.struct(F.lit(k).alias("block"), bits.cast("bigint").alias("bits")))
        first += size
    return F.array(*parts)


def weighted_similarity(a: Column, b: Column) -> Column:
    """Of two arrays of shingle hashes, each shingle weighing as much as its count."""

    def both(x: Column, y: Column) -> Column:
        def count(of: Column, value: Column) -> Column:
            return F.size(F.filter(of, lambda v: v == value))

        common = F.aggregate(
            F.array_intersect(x, y),
            F.lit(0),
            lambda acc, v: acc + F.least(count(x, v), count(y, v)),
        )
        return bound(common, lambda n: n / (F.size(x) + F.size(y) - n))

    return bound(a, lambda x: bound(b, lambda y: both(x, y)))


def item_fingerprints(items: DataFrame) -> DataFrame:
    """item_id, n_words, shingles and fingerprint; items under five words have no shingle.

    Repeated rows are one; rows that share an id and differ are all searched for.
    """
    cut = items.select("item_id", words_of(F.lower("text")).alias("words"))
    hashed = cut.filter(F.size("words") >= SHINGLE).select(
        "item_id", F.size("words").alias("n_words"), shingles_of(F.col("words")).alias("shingles")
    )
    return hashed.distinct().withColumn("fingerprint", simhash(F.col("shingles")))


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, start, n_words, shingles of the windows that share a shingle with an item.

    A window that would reach over an end of its document is cut there.
    """
    seeds = (
        items.select("n_words", F.posexplode("shingles").alias("at", "shingle"))
        .groupBy("shingle")
        .agg(F.collect_set(F.struct("at", "n_words")).alias("places"))
    )
    # Opened from an array, as the optimizer would repeat a column's expression for a filter.
    hashes = F.explode(F.array(shingles_of(words_of(F.lower("text")))))
    hashed = docs.select("doc_id", hashes.alias("all"))
    hits = hashed.select("doc_id", "all", F.posexplode("all").alias("pos", "shingle")).join(
        F.broadcast(seeds), "shingle"
    )
    laid = hits.select("doc_id", "all", "pos", F.explode("places").alias("place"))
    n_words, first = F.col("place.n_words"), F.col("pos") - F.col("place.at")
    start = F.greatest(first, F.lit(0))
    # Shingles of the window: from start to the last that lies within its words.
    last = F.least(first + n_words - (SHINGLE - 1), F.size("all"))
    return laid.select(
        "doc_id",
        start.alias("start"),
        n_words.alias("n_words"),
        F.slice("all", start + 1, last - start).alias("shingles"),
    ).distinct()


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    min_similarity: float = MIN_SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity, distance: an item in a document.

    One row for each pair, of its most similar window, the first of equals. start counts
    words; distance is that of the fingerprints. Case is ignored.

    A null or empty text holds nothing; a text or item under five words has no shingle. Rows
    that share a doc_id are searched each and reported as one; a null doc_id is reported as
    null. Other columns are not read. No items, or no documents, give no rows.
    """
    known = stored(item_fingerprints(items), "items")
    shingles = known.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    blocks = max(1, ceil_div(shingles, BLOCK_SHINGLES))
    found = None
    for k in range(blocks):
        some = known.filter(F.pmod(F.xxhash64("fingerprint", "item_id"), F.lit(blocks)) == k)
        pairs = _pairs(docs, some, min_similarity, radius)
        found = pairs if found is None else found.unionByName(pairs)
    first = F.struct(
        "similarity",
        (-F.col("start")).alias("back"),
        "n_words",
        (-F.col("distance")).alias("near"),
    )
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(first).alias("best"))
        .select(
            "doc_id",
            "item_id",
            (-F.col("best.back")).alias("start"),
            "best.n_words",
            "best.similarity",
            (-F.col("best.near")).alias("distance"),
        )
    )


def _pairs(docs: DataFrame, items: DataFrame, min_similarity: float, radius: int) -> DataFrame:
    """Windows and items within the radius whose similarity is enough."""
    windows = stored(
        _windows(docs, items).withColumn("fingerprint", simhash(F.col("shingles"))), "windows"
    )
    index = items.select(
        "item_id",
        "n_words",
        F.col("fingerprint").alias("item_fingerprint"),
        F.col("shingles").alias("item_shingles"),
        F.explode(blocks_of(F.col("fingerprint"), radius)).alias("key"),
    ).select("*", "key.*").drop("key")
    probe = windows.withColumn("key", F.explode(blocks_of(F.col("fingerprint"), radius)))
    probe = probe.select("*", "key.*").drop("key")
    near = probe.join(F.broadcast(index), ["n_words", "block", "bits"])
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    # Counted for the first block on which the two agree only, so that none is verified twice.
    differ = F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))
    first_block = F.array_position(
        F.transform(blocks_of(differ, radius), lambda x: x["bits"]), F.lit(0).cast("bigint")
    )
    similarity = weighted_similarity(F.col("shingles"), F.col("item_shingles"))
    return (
        near.withColumn("distance", distance.cast("int"))
        .filter((F.col("distance") <= radius) & (F.col("block") == first_block - 1))
        .withColumn("similarity", similarity)
        .filter(F.col("similarity") >= min_similarity)
        .select("doc_id", "item_id", "start", "n_words", "similarity", "distance")
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    min_similarity: float = MIN_SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """The documents, with all their columns, in which no item was found.

    A document without an id can't be told from others without one: all go if one goes.
    """
    leaks = contaminated(docs, items, min_similarity, radius)
    leaks = leaks.select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leak"]), "left_anti")
