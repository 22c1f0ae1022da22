"""Log-likelihood of whole documents by a gated recurrent language model.

Counts of all words are gathered from all training documents. The most frequent words are
types of the model, in classes of equal size by frequency; the others are told by how often
they occur: each range of counts is one type, and a word's share of its range is its share
of the range's occurrences. A word seen once is as likely as all unknown words together to
be the next new one (Good and Turing), so those two share the range of new words evenly.

The model learns from all training documents, each whole, in rounds. Each round has as many
documents as all before it, up to an eighth of all, so that most are learned in rounds of equal
size. A round's documents are dealt to shares; a task learns from one share at a time, and the
mean of the weights of all shares, by tokens, is what the next round begins with. How many
rounds and shares there are, how many words are types and how many ranges there are follows the
input.

Texts are split into words once. A block is some documents that one task has read, and its
words are numbered; documents are kept as these numbers. Each different word of a block is sent
once, and its count over all blocks comes back to the block, so that a task holds the counts of
its own words only. The types of words are sent once more in their round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triprollup.llm import recurrent
from triprollup.llm.batches import gathered, hashes_of, split
from triprollup.llm.tables import ceil_div, crc_of_id, stored
from triprollup.sources.scratch import scratch_path

FOLDS, HELD_OUT = 7, 2
#: Bytes of texts that make a block, about; a longer text is a block of its own.
BLOCK_BYTES = 10_000_000
#: Classes of frequent words, and words of each, at least and at most (types have 16 bits).
LEAST_HEADS, MOST_HEADS = 32, 250
#: The first round has about so many tokens, and one task that reads them so many times.
FIRST_TOKENS, FIRST_PASSES = 1_000_000, 4
#: Tokens of a share in later rounds.
TASK_TOKENS = 2_000_000
#: Tokens scored side by side, and by one task, about.
SCORE_TOKENS = 4_000_000
#: Weights that are added together by one task.
PIECE = 16_384
#: Rounds after the first ones are this part of all documents.
ROUND_PART = 1 / 8
#: Shares up to so many are given a partition each.
DEALT_SHARES = 4096
#: Rates of learning: at first, at the end of the first round, and in the last round.
RATES = (0.01, 0.003, 0.0005)

BLOCKS = (
    "block bigint, word bigint, n bigint, "
    "doc_id bigint, held_out boolean, learned boolean, numbers binary"
)
CODED = (
    "doc_id bigint, held_out boolean, learned boolean, n_tokens bigint, n_known bigint, "
    "base_score double, share double, types binary"
)
WEIGHTS = "piece int, tokens double, weights binary"
FIELDS = [("piece", pa.int32()), ("tokens", pa.float64()), ("weights", pa.binary())]
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "base_score double, score double"
)


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out, learned and place, a hash of the file and the row's number in it.

    So it is the same whichever task reads the row. A frame that isn't read from files is
    written to the shared folder first.
    """
    try:
        rows = docs.select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return placed(stored(docs.select("doc_id", "text"), "documents"))
    remainder = crc_of_id() % FOLDS
    return rows.select(
        F.col("doc_id").cast("bigint"),
        "text",
        F.coalesce(remainder == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(remainder != HELD_OUT, F.lit(False)).alias("learned"),
        F.xxhash64("file_path", "row_index").alias("place"),
    )


def bytes_of(words: int) -> int:
    """How many bytes tell so many words apart."""
    return max((words - 1).bit_length() + 7, 8) // 8


def packed(numbers: np.ndarray, width: int) -> np.ndarray:
    """Each number in so many bytes, a row each."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def unpacked(data: bytes, width: int) -> np.ndarray:
    whole = np.zeros((len(data) // width, 8), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return whole.reshape(-1).view("<i8")


def blocks(rows: DataFrame) -> DataFrame:
    """Each different word of a block, and how often its training documents have it.

    And in rows of their own all documents, by the numbers of their words: their places among
    those of the block in order. A block is called by the place of its first row.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "word", "n", "doc_id", "held_out", "learned", "numbers"]
        for batch in gathered(batches, "text", BLOCK_BYTES):
            found, texts, bounds = split(batch.column("text"))
            seen = np.zeros(len(texts), bool)
            seen[found] = True
            rank = np.zeros(len(texts), np.int64)
            words, rank[seen] = np.unique(hashes_of(texts)[seen], return_inverse=True)
            numbers = rank[found]
            learned = batch.column("learned").to_numpy(zero_copy_only=False)
            weight = np.repeat(learned, np.diff(bounds)).astype(float)
            n = np.bincount(numbers, weight, minlength=len(words)).astype(np.int64)
            own = packed(numbers, bytes_of(len(words)))
            block = batch.column("place")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(words), block)),
                    pa.array(words),
                    pa.array(n),
                    *(pa.nulls(len(words), t) for t in (pa.int64(), pa.bool_(), pa.bool_(), pa.binary())),
                ],
                names=names,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(batch), block)),
                    *(pa.nulls(len(batch), pa.int64()) for _ in range(2)),
                    *(batch.column(c) for c in ("doc_id", "held_out", "learned")),
                    pa.array([own[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                ],
                names=names,
            )

    return rows.select("place", "doc_id", "held_out", "learned", "text").mapInArrow(number, BLOCKS)


class Vocabulary:
    """What tasks need to know of all counts: bounded, whatever the number of words.

    tokens, types: N and V of the training documents, ends included. ends: how many ends.
    side: classes, and words of each: the fourth root of V, so that words with a type of their
    own are as many as its square root. heads: hashes of these words. ranges: of counts of the
    others, from 1 (and 0), 2, 3, 5, 9, ... upwards. mass: occurrences of those by range.
    """

    def __init__(self, words: DataFrame, ends: int):
        summed = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        self.ends = ends
        self.tokens = summed[0] + ends
        self.types = summed[1] + (ends > 0)
        self.side = min(max(math.ceil(self.types**0.25), LEAST_HEADS), MOST_HEADS)
        top = words.orderBy(F.desc("n"), "word").limit(self.side**2 - 1)
        frequent = [(r["word"], r["n"]) for r in top.collect()]
        self.frequent = np.array([n for _, n in frequent], np.int64)
        most = frequent[-1][1] if len(frequent) == self.side**2 - 1 else 1
        self.ranges = np.array([2, *(2**k + 1 for k in range(1, max(int(most - 1).bit_length(), 1)))])
        self.heads = np.array([w for w, _ in frequent], np.int64)
        self.order = np.argsort(self.heads)
        bin_ = F.lit(0)
        for k, least in enumerate(self.ranges.tolist(), 1):
            bin_ = F.when(F.col("n") >= least, k).otherwise(bin_)
        sums = words.groupBy(bin_.alias("k")).agg(F.sum("n").alias("n")).collect()
        self.mass = np.zeros(len(self.ranges) + 1)
        for row in sums:
            self.mass[row["k"]] = row["n"]
        for _, n in frequent:
            self.mass[self.range_of(np.array([n]))[0]] -= n

    def range_of(self, counts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ranges, counts, side="right")

    def frequencies(self) -> np.ndarray:
        """How often the training documents have each type."""
        heads = np.zeros(self.side**2)
        heads[0], heads[1 : len(self.frequent) + 1] = self.ends, self.frequent
        return np.concatenate([heads, self.mass])

    def types_of(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Type of each word, and the log of its share of the type."""
        if len(self.heads):
            at = np.searchsorted(self.heads, words, sorter=self.order)
            found = self.order[np.minimum(at, len(self.heads) - 1)]
            head = self.heads[found] == words
        else:
            found, head = np.zeros(len(words), int), np.zeros(len(words), bool)
        in_range = self.range_of(counts)
        # New words: half of the range for those seen once, half for the unknown.
        share = counts / np.maximum(self.mass[in_range], 1)
        new = np.where(counts > 0, 0.5 / max(self.mass[0], 1), 0.5 if self.mass[0] else 1.0)
        share = np.where(head, 1.0, np.where(in_range == 0, new, share))
        types = np.where(head, found + 1, self.side**2 + in_range)
        return types, np.log(share)

    def base_log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.types + 1))


def totals(words: DataFrame) -> DataFrame:
    """n of each word of each block over all blocks, and `once`, which one row of a word has."""
    same = Window.partitionBy("word")
    return words.select(
        "block",
        "word",
        F.sum("n").over(same).alias("n"),
        (F.col("block") == F.min("block").over(same)).alias("once"),
    )


def sequences(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(t, "<u2") for t in batch.column("types").to_pylist()]


def rounds_of(tokens: int) -> list[tuple[float, float]]:
    """Shares of the documents, from and to.

    Each round has as many as all before it, but no more than ROUND_PART of all.
    """
    last = min(1.0, FIRST_TOKENS / max(tokens, 1))
    found = [(0.0, last)]
    while last < 1:
        size = min(last, max(ROUND_PART, FIRST_TOKENS / tokens))
        # What would be left over for a round of less than half the size goes to this one.
        found.append((last, 1.0 if last + 1.5 * size > 1 else last + size))
        last = found[-1][1]
    return found


def dealt_keys(spark: SparkSession, count: int) -> list[int]:
    """A key for each share, no two of which fall into one of `count` partitions."""
    found: dict[int, int] = {}
    first, step = 0, 8 * count + 64
    while len(found) < count:
        keys = spark.range(first, first + step).select("id", F.pmod(F.hash("id"), F.lit(count)).alias("p"))
        for row in keys.groupBy("p").agg(F.min("id").alias("id")).collect():
            found.setdefault(row["p"], row["id"])
        first += step
    return [found[p] for p in range(count)]


def learned_in(documents: DataFrame, model: recurrent.GatedLM, shares: int, rates, passes: int):
    """The mean of the weights after learning from each share of these documents.

    Pieces of the weights are added in tasks of their own: the driver gets one sum of each,
    however many shares there are.
    """
    flat = model.flat()

    def summed(piece: int, n: float, weights: np.ndarray) -> pa.RecordBatch:
        row = {"piece": piece, "tokens": float(n), "weights": weights.astype(float).tobytes()}
        return pa.RecordBatch.from_pylist([row], pa.schema(FIELDS))

    def learned(texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own = model.filled(flat.copy())
        recurrent.teach(own, texts, rates, passes)
        n, after = sum(map(len, texts)), own.flat().astype(float)
        for piece, at in enumerate(range(0, len(after), PIECE)):
            yield summed(piece, n, after[at : at + PIECE] * n)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, texts = None, []
        for batch in batches:
            shares = batch.column("share").to_pylist()
            for key, text in zip(shares, sequences(batch)):
                if texts and key != share:
                    yield from learned(texts)
                    texts = []
                share = key
                texts.append(text)
        if texts:
            yield from learned(texts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[float, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                n, total = sums.get(row["piece"], (0.0, 0.0))
                sums[row["piece"]] = n + row["tokens"], total + np.frombuffer(row["weights"])
        for piece, (n, total) in sums.items():
            yield summed(piece, n, total)

    # In the same shares and order at every run, as far as ids differ.
    order = F.xxhash64(F.lit("order"), "doc_id")
    share = F.pmod("o", F.lit(shares))
    if shares <= DEALT_SHARES:
        keys = dealt_keys(documents.sparkSession, shares)
        share = F.element_at(F.array(*map(F.lit, keys)), share.cast("int") + 1)
    dealt = documents.select("types", order.alias("o")).withColumn("share", share.cast("bigint"))
    # A task may get several shares, but learns from each apart.
    dealt = dealt.repartition(shares, "share").sortWithinPartitions("share", "o", "types")
    taught = dealt.select("share", "types").mapInArrow(learn, WEIGHTS)
    pieces = taught.repartition(ceil_div(len(flat), PIECE), "piece").mapInArrow(add, WEIGHTS)
    found = sorted(pieces.collect(), key=lambda r: r["piece"])
    if not found:
        return model
    return model.filled(np.concatenate([np.frombuffer(r["weights"]) / r["tokens"] for r in found]))


def round_number(rounds: list[tuple[float, float]]) -> Column:
    """The round that a document is learned in, by a hash of its id; null if it isn't."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit("round"), "doc_id"), 11) / 2.0**53
    number = F.lit(len(rounds) - 1)
    for k in range(len(rounds) - 2, -1, -1):
        number = F.when(place < rounds[k][1], k).otherwise(number)
    return F.when(F.col("learned"), number)


def fit(coded: DataFrame, vocabulary: Vocabulary, rounds: list[tuple[float, float]]) -> recurrent.GatedLM:
    """A model of all training documents: each is learned from in its round, whole."""
    model = recurrent.started(vocabulary.frequencies(), vocabulary.side, vocabulary.side)
    for k, (first, last) in enumerate(rounds):
        some = coded.filter(F.col("round") == k)
        if k == 0:
            rates = (RATES[0], RATES[1] if len(rounds) > 1 else 0.0)
            model = learned_in(some, model, 1, rates, FIRST_PASSES)
        else:
            down = (RATES[1] - RATES[2]) / (len(rounds) - 1)
            rates = (RATES[1] - down * (k - 1), RATES[1] - down * k)
            shares = math.ceil((last - first) * vocabulary.tokens / TASK_TOKENS)
            model = learned_in(some, model, shares, rates, 1)
    return model


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    Scores are log10 of probabilities. A null or empty text is its end alone. A null doc_id
    is neither held out nor learned from. Repeated rows count and are scored each; other
    columns are not read. Without training documents the model is untrained and every word
    unknown. An empty table gives no rows.
    """
    found = stored(blocks(placed(docs)), "blocks")
    numbered = found.filter("numbers IS NOT NULL").drop("word", "n")
    counts = stored(totals(found.filter("numbers IS NULL")), "word-counts")
    # Of words that training documents have.
    known = counts.filter("once AND n > 0").select("word", "n")
    vocabulary = Vocabulary(known, numbered.filter("learned").count())
    ends = np.log10((vocabulary.ends + 1) / (vocabulary.tokens + vocabulary.types + 1))

    def code(texts: pa.Table, words: pa.Table) -> pa.Table:
        word, c = (words.column(name).to_numpy() for name in ("word", "n"))
        order = np.argsort(word)
        word, c = word[order], c[order]
        width = bytes_of(len(word))
        numbers = texts.column("numbers").to_pylist()
        number = unpacked(b"".join(numbers), width)
        bounds = np.cumsum([0, *map(len, numbers)]) // width
        types, share = vocabulary.types_of(word, c)
        owner = np.repeat(np.arange(texts.num_rows), np.diff(bounds))

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, values[number], minlength=texts.num_rows)

        sequence, end = types.astype("<u2")[number], np.array([recurrent.END], "<u2").tobytes()
        coded = [sequence[a:b].tobytes() + end for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "learned": texts.column("learned"),
                "n_tokens": np.diff(bounds) + 1,
                "n_known": summed((c > 0).astype(float)).astype(np.int64) + (vocabulary.ends > 0),
                "base_score": summed(vocabulary.base_log10(c)) + ends,
                "share": summed(share),
                "types": pa.array(coded, pa.binary()),
            }
        )

    coded = (
        numbered.groupBy("block")
        .cogroup(counts.select("block", "word", "n").groupBy("block"))
        .applyInArrow(code, CODED)
    )
    rounds = rounds_of(vocabulary.tokens)
    # By round, so that each reads only its own documents.
    coded = coded.withColumn("round", round_number(rounds)).drop("learned")
    path = scratch_path(docs.sparkSession, "coded-documents")
    coded.write.partitionBy("round").parquet(path)
    coded = docs.sparkSession.read.schema(coded.schema).parquet(path)
    model = fit(coded, vocabulary, rounds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
        for some in gathered(batches, "types", 2 * SCORE_TOKENS):
            logs = model.score(sequences(some)) + some.column("share").to_numpy()
            columns = [*(some.column(c) for c in names), pa.array(logs / np.log(10))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score"])

    # Files of rounds are small; documents are read side by side, so tasks should have many.
    tasks = max(math.ceil(vocabulary.tokens / SCORE_TOKENS), docs.sparkSession.sparkContext.defaultParallelism)
    scored = coded.drop("round").coalesce(tasks).mapInArrow(score, SCORES)
    return scored.withColumn("train_tokens", F.lit(vocabulary.tokens).cast("bigint"))
