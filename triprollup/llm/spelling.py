"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters are dealt to GROUPS groups of about equal weight. A word's vector counts its letters by
group; one inserted letter adds one to one count, a deleted one takes one away, and a replaced
one does both or nothing. So words one edit apart have vectors that differ by a surplus and a
deficit of one each at most. Words stand in a trie by their successive counts; a depth-first
search walks two tries side by side and spends that budget, and words of leaves that it meets
are verified letter by letter.

The trie is cut into cells by its upper levels. A word lives in its own cell and visits the
cells that its budget reaches; as the lesser of two vectors finds the greater, the first
difference it may spend is a surplus, so each pair is found once. A cell of too many words is
cut one level deeper. Cells that are too large even at the leaves, words of equal vectors, are
settled by joining words with one letter left out, of which few words share any one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triprollup.llm.batches import slices
from triprollup.llm.tables import stored

RUN = re.compile("[a-zÀ-ÿ]+")
#: One in so many words of a document loses a letter.
SLIP = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent.
FORM_RATIO = 2
GROUPS = 12
#: Rows of a cell, living there or visiting, at most; and different words kept while counting.
CELL = 40_000
KEPT = 200_000
#: Rows of leaves compared at a time, and an odd number that spreads their keys.
COMPARED = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)

WORDS = "word string, n bigint"
PLACED = "cell binary, state tinyint, word string, n bigint"
NEAR = "word string, n_near bigint, best_n bigint, best string"
#: What a row of a cell may still spend: one that lives there a surplus and then a deficit, a
#: visitor has spent its surplus and may still have its deficit.
LIVES, MAY_LOSE, SPENT = 0, 1, 2


def slipped(doc_id: int | None, run: str, seed: int) -> str:
    """The run as the document gives it, one letter less if its hash says so."""
    if doc_id is not None:
        h = zlib.crc32(run.encode(), seed)
        if h % SLIP == 0:
            at = h % len(run)
            return run[:at] + run[at + 1 :]
    return run


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: letter runs of all texts, in lower case, with slips, that are long enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                names=["word", "n"],
            )
            held.clear()
            return found

        for batch in batches:
            for some in slices(batch, "text", 2_000_000):
                texts = pc.ascii_lower(pc.fill_null(some.column("text"), "")).to_pylist()
                for doc_id, text in zip(some.column("doc_id").to_pylist(), texts):
                    seed = zlib.crc32(b"%d:" % doc_id) if doc_id is not None else 0
                    for run, n in Counter(RUN.findall(text)).items():
                        word = slipped(doc_id, run, seed)
                        if len(word) >= LEAST_LENGTH:
                            held[word] += n
                if len(held) > KEPT:
                    yield flushed()
        yield flushed()

    counted = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(count, WORDS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each code point up to 255: the most frequent ones first, to the least group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for some in slices(batch, "word"):
                total += np.bincount(code_points(some.column("word").to_pylist())[0], minlength=256)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["p", "n"])

    counted = words.select("word").mapInArrow(count, "p bigint, n bigint")
    found = counted.groupBy("p").agg(F.sum("n").alias("n")).collect()  # 256 rows at most
    weights, group = np.zeros(GROUPS, np.int64), np.arange(256) % GROUPS
    for row in sorted(found, key=lambda r: (-r["n"], r["p"])):
        group[row["p"]] = k = int(np.argmin(weights))
        weights[k] += row["n"]
    return group


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in one array, and the length of each word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat, np.fromiter(map(len, words), np.int64, len(words))


def vectors(words: list[str], group: np.ndarray) -> np.ndarray:
    """Letters of each word by group."""
    flat, lengths = code_points(words)
    at = np.repeat(np.arange(len(words)) * GROUPS, lengths) + group[flat]
    counts = np.bincount(at, minlength=len(words) * GROUPS)
    return counts.reshape(len(words), GROUPS).astype("<i4")


def reached(counts: tuple[int, ...], state: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Counts that the budget of a state reaches, with the state that is left."""
    yield counts, state
    for i, c in enumerate(counts):
        if state == LIVES:
            for later, left in reached(counts[i + 1 :], MAY_LOSE):
                yield (*counts[:i], c + 1, *later), left
        elif state == MAY_LOSE and c:
            yield (*counts[:i], c - 1, *counts[i + 1 :]), SPENT


def placed(rows: DataFrame, group: np.ndarray, first: int, last: int) -> DataFrame:
    """Rows of cells cut at level `first`, dealt to the cells below them at level `last`."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach: dict[tuple, list[tuple[bytes, int]]] = {}
        for batch in batches:
            for some in slices(batch, "word", 1_000_000):
                counts = vectors(some.column("word").to_pylist(), group)[:, first:last].tolist()
                cells, states = some.column("cell").to_pylist(), some.column("state").to_pylist()
                rows, keys, left = [], [], []
                for row, (own, cell, state) in enumerate(zip(counts, cells, states)):
                    asked = (*own, state)
                    if (found := reach.get(asked)) is None:
                        found = [
                            (np.array(to, "<i4").tobytes(), then)
                            for to, then in reached(tuple(own), state)
                        ]
                        if len(reach) < KEPT:
                            reach[asked] = found
                    for below, then in found:
                        rows.append(row)
                        keys.append(cell + below)
                        left.append(then)
                words = some.select(["word", "n"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(left, pa.int8()), *words.columns],
                    names=["cell", "state", "word", "n"],
                )

    return rows.mapInArrow(place, PLACED)


class Trie:
    """Vectors by their successive counts; leaf k lists `rows[bounds[k] : bounds[k + 1]]`."""

    def __init__(self, counts: np.ndarray, rows: np.ndarray):
        self.root: dict = {}
        counts = counts[rows]
        order = np.lexsort(counts.T[::-1]) if counts.shape[1] else np.arange(len(rows))
        counts, self.rows = counts[order], rows[order]
        new = (counts[1:] != counts[:-1]).any(axis=1)
        firsts = np.concatenate([[0], np.flatnonzero(new) + 1])[: len(rows)]
        self.bounds = np.append(firsts, len(rows))
        for leaf, path in enumerate(counts[firsts].tolist()):
            node = self.root
            for c in path[:-1]:
                node = node.setdefault(c, {})
            node[path[-1] if path else 0] = leaf

    def listed(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each of these leaves, and the place in `leaves` each comes from."""
        sizes = self.bounds[leaves + 1] - self.bounds[leaves]
        begins = np.repeat(self.bounds[leaves] - (np.cumsum(sizes) - sizes), sizes)
        return self.rows[begins + np.arange(len(begins))], np.repeat(np.arange(len(leaves)), sizes)


def leaf_pairs(one: Trie, other: Trie, depth: int, state: int) -> np.ndarray:
    """Leaves of `one` and those of `other` that its words reach, both tries walked at once."""
    found: list[tuple[int, int]] = []

    def walk(a: dict, b: dict, level: int, state: int) -> None:
        for c, below in a.items():
            steps = [(c, state)]
            if state == LIVES:
                steps.append((c + 1, MAY_LOSE))
            elif state == MAY_LOSE:
                steps.append((c - 1, SPENT))
            for to, left in steps:
                if (met := b.get(to)) is not None:
                    if level == depth:
                        found.append((below, met))
                    else:
                        walk(below, met, level + 1, left)

    walk(one.root, other.root, 1, state)
    return np.array(found, np.int64).reshape(-1, 2)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes the one of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _equal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all equal keys of the two arrays."""
    order_a, order_b = np.argsort(a), np.argsort(b)
    a, b = a[order_a], b[order_b]
    first, last = np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")
    each = last - first
    begins = np.repeat(first - (np.cumsum(each) - each), each)
    return np.repeat(order_a, each), order_b[begins + np.arange(len(begins))]


def near_in_cell(
    words: list[str], states: np.ndarray, counts: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Rows of words one edit apart, each pair once; counts are those below the cell.

    Of two words one edit apart, both begin or both end with the same half of the shorter.
    Words of two leaves are compared where they do; all words of a leaf are of one length.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    halves = [(lengths // 2).tolist(), ((lengths - 1) // 2).tolist()]
    heads = np.array([[hash(w[:h]) for w, h in zip(words, half)] for half in halves])
    tails = np.array([[hash(w[-h:]) for w, h in zip(words, half)] for half in halves])
    depth = max(counts.shape[1], 1)
    tries = [Trie(counts, np.flatnonzero(states == s)) for s in (LIVES, MAY_LOSE, SPENT)]
    homes = tries[LIVES]
    for state, trie in enumerate(tries):
        found = leaf_pairs(trie, homes, depth, state)
        sizes = np.diff(trie.bounds)[found[:, 0]] + np.diff(homes.bounds)[found[:, 1]]
        blocks = np.cumsum(sizes) // COMPARED
        for some in np.split(found, np.flatnonzero(np.diff(blocks)) + 1):
            left, pair_a = trie.listed(some[:, 0])
            right, pair_b = homes.listed(some[:, 1])
            of_a, of_b = (lengths[t.rows[t.bounds[k]]] for t, k in ((trie, some[:, 0]), (homes, some[:, 1])))
            half_a, half_b = (of_b < of_a).astype(int), (of_a < of_b).astype(int)
            # The same leaf on both sides: each pair from its first row.
            own = (some[:, 0] == some[:, 1]) & (state == LIVES)
            for ends in (heads, tails):
                mixed = [
                    (ends[half[p], rows].view(np.uint64) + p.astype(np.uint64)) * MIX
                    for half, p, rows in ((half_a, pair_a, left), (half_b, pair_b, right))
                ]
                at_a, at_b = _equal(*mixed)
                x, y, p = left[at_a], right[at_b], pair_a[at_a]
                real = (p == pair_b[at_b]) & ~(own[p] & (x >= y))
                if ends is tails:
                    real &= heads[half_a[p], x] != heads[half_b[p], y]
                for i, j in zip(x[real].tolist(), y[real].tolist()):
                    if one_edit(words[i], words[j]):
                        yield i, j


def _summary(words: list[str], n: list[int], pairs) -> pa.Table:
    """Of each word of a pair the number of near words and the best, most frequent and first."""
    near: Counter[int] = Counter()
    best: dict[int, int] = {}
    for pair in pairs:
        for x, y in (pair, pair[::-1]):
            near[x] += 1
            if x not in best or (-n[y], words[y]) < (-n[best[x]], words[best[x]]):
                best[x] = y
    return pa.table(
        {
            "word": pa.array([words[x] for x in near], pa.string()),
            "n_near": pa.array(near.values(), pa.int64()),
            "best_n": pa.array([n[best[x]] for x in near], pa.int64()),
            "best": pa.array([words[best[x]] for x in near], pa.string()),
        }
    )


def near_of_cells(rows: DataFrame, group: np.ndarray, level: int) -> DataFrame:
    """Near words found in each cell, for each of them its number and the best."""

    def search(cell: pa.Table) -> pa.Table:
        words = cell.column("word").to_pylist()
        counts = vectors(words, group)[:, level:]
        states = cell.column("state").to_numpy()
        pairs = near_in_cell(words, states, counts)
        return _summary(words, cell.column("n").to_pylist(), pairs)

    return rows.groupBy("cell").applyInArrow(search, NEAR)


def near_of_leaves(rows: DataFrame) -> DataFrame:
    """The same for cells that are leaves, by joining words with one letter left out.

    Words that share a place and all letters but that one are as many as there are letters at
    most, so no key is hot.
    """
    schema = "cell binary, key bigint, lives boolean, word string, n bigint"

    def leave_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                word, lives = row["word"], row["state"] == LIVES
                # Replaced letters share the place; a longer word without one is a whole word.
                shared = [f"{i}:{word[:i]}{word[i + 1 :]}" for i in range(len(word))]
                shared += [f"w:{word}", *{f"w:{word[:i]}{word[i + 1 :]}" for i in range(len(word))}]
                keys = np.array([xxhash.xxh3_64_intdigest(k) for k in shared], np.uint64)
                same = [[row[c]] * len(keys) for c in ("cell", "word", "n")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(same[0], pa.binary()),
                        pa.array(keys.view(np.int64)),
                        pa.array([lives] * len(keys)),
                        pa.array(same[1], pa.string()),
                        pa.array(same[2], pa.int64()),
                    ],
                    names=["cell", "key", "lives", "word", "n"],
                )

    left = stored(rows.mapInArrow(leave_out, schema), "left-out")
    homes = left.filter("lives").select("cell", "key", F.col("word").alias("b"), F.col("n").alias("bn"))
    met = left.join(homes, ["cell", "key"]).filter("word <> b and (not lives or word < b)")
    pairs = met.select("word", "n", "b", "bn").distinct()
    pairs = stored(pairs.filter(F.levenshtein("word", "b", 1) == 1), "near-pairs")
    back = pairs.select(F.col("b").alias("word"), F.col("bn").alias("n"), F.col("word").alias("b"), F.col("n").alias("bn"))
    best = F.min(F.struct((-F.col("bn")).alias("n"), F.col("b").alias("w")))
    found = pairs.union(back).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.w").alias("best"))


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n and best for each of `words` (word, n) with a word one edit away."""
    group = letter_groups(words)
    count = words.count()
    # A word is in 1 + d (d + 1) / 2 cells at level d; a level makes some three of one.
    level = next((d for d in range(GROUPS) if count * (1 + d * (d + 1) // 2) <= 2 * CELL * 3**d), GROUPS)
    whole = words.select(F.lit(b"").alias("cell"), F.lit(LIVES).cast("tinyint").alias("state"), "word", "n")
    rows, found = placed(whole, group, 0, level), []
    while True:
        rows = stored(rows, "cells")
        lived_in = F.max((F.col("state") == LIVES).cast("int")) == 1
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), lived_in.alias("lived_in"))
        sizes = stored(sizes.filter("lived_in").select("cell", "size"), "cell-sizes")
        large = sizes.filter(F.col("size") > CELL).select("cell")
        small = sizes.filter((F.col("size") > 1) & (F.col("size") <= CELL)).select("cell")
        found.append(near_of_cells(rows.join(small, "cell"), group, level))
        if large.isEmpty():
            break
        rows = rows.join(large, "cell").select("cell", "state", "word", "n")
        if level == GROUPS:
            found.append(near_of_leaves(rows))
            break
        rows = placed(rows, group, level, level + 1)
        level += 1
    parts = found[0]
    for more in found[1:]:
        parts = parts.union(more)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("b")
    summed = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


def rooted(forms: DataFrame) -> DataFrame:
    """word and root: forms followed from each word to the last, by doubling.

    A form is twice as frequent at least, so that chains are short and have no rings.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(roots.join(above, "root", "left").select("word", "root", "next"), "roots")
        if further.filter("next is not null").isEmpty():
            return further.select("word", "root")
        roots = further.select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each frequent word of the documents.

    Null and empty texts have no words. A null doc_id makes no slips. Repeated rows count each.
    Very long runs are words like others. Of near words equally frequent the first in code-point
    order is the form. Other columns are not read. An empty table gives no rows.
    """
    words = stored(word_counts(docs), "words")
    near = words.join(near_words(words), "word", "left")
    form = F.col("best_n") >= FORM_RATIO * F.col("n")
    near = stored(
        near.select(
            "word",
            F.when(form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(form, F.col("best_n")).alias("form_n"),
        ),
        "near-words",
    )
    roots = rooted(near.filter("form is not null"))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
