"""Stretches of words that repeat with a period, by an enhanced suffix array.

Words of a document are numbered; all suffixes are ordered by prefix doubling, and the common
prefix of neighbours is read off the ranks of the doublings. An interval of suffixes that share
`depth` words, and no more, has a child for each way to go on. A suffix i whose partner
i + depth or i - depth stands in the same interval, but in another child, begins a square that
the next word breaks (a branching tandem repeat). Of two partners in two children one is not in
the largest, so only suffixes of smaller children are asked. Each such square is the right end
of a run: it is rotated to the left as far as words agree. Intervals come from the next smaller
values of the common prefixes; no tree is built.

Documents of a batch are ordered together; their words are numbered apart, so that nothing is
shared between two of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triprollup.llm.batches import slices

#: Words a run has at least, and periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: One in so many documents has its end rewritten to repeat.
PLANTED = 10
#: Bytes of text ordered at a time; a longer document is alone.
BLOCK = 2_000_000

FOUND = (
    "doc_id bigint, n_words bigint, "
    "runs array<struct<start:bigint,length:bigint,period:bigint>>, text string"
)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and where in it those begin that are equal to each one before."""
    order = np.argsort(keys, kind="stable")
    new = np.flatnonzero(np.diff(keys[order], prepend=keys[order[:1]] - 1))
    return order, np.repeat(new, np.diff(new, append=len(keys)))


def suffix_order(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and their ranks by the first 1, 2, 4, ... words.

    ends: for each place where its document ends. A rank is the place in the order of the first
    suffix with the same words; places at the very end of all have one more entry, -1.
    """
    count = len(words)
    order, first = dense(words)
    rank = np.full(count + 1, -1, np.int64)
    rank[order] = first
    levels, width = [rank], 1
    # Places in the order of suffixes that are not yet told from a neighbour.
    tied = np.flatnonzero((np.bincount(first, minlength=count) > 1)[first]) if count else first
    while len(tied):
        some = order[tied]
        after = some + width
        follows = np.where(after < ends[some], rank[np.minimum(after, count)], -1)
        own = rank[some]
        sub = np.lexsort((follows, own))
        some, own, follows = some[sub], own[sub], follows[sub]
        order[tied] = some
        new = np.ones(len(some), bool)
        new[1:] = (own[1:] != own[:-1]) | (follows[1:] != follows[:-1])
        begins = np.flatnonzero(new)
        sizes = np.diff(begins, append=len(some))
        rank = rank.copy()
        rank[some] = np.repeat(tied[begins], sizes)
        levels.append(rank)
        tied = tied[np.repeat(sizes > 1, sizes)]
        width *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in order; 0 at both ends."""
    count = len(order)
    found = np.zeros(count + 1, np.int64)
    ranks = levels[0][order]
    at = np.flatnonzero(ranks[1:] == ranks[:-1]) + 1
    a, b, shared = order[at - 1], order[at], np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(a + shared, count)] == levels[k][np.minimum(b + shared, count)]
        shared += same << k
    found[at] = shared
    return found


def smaller(values: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each place the nearest one, that many steps on, with a smaller value.

    What stands between a place and the one it points to is not smaller, so pointers to values
    that are not smaller either may be followed, all at once.
    """
    to = np.arange(len(values)) + step
    active = at
    while len(active):
        active = active[values[to[active]] >= values[active]]
        to[active] = to[to[active]]
    return to[at]


def branching_squares(
    order: np.ndarray, shared: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where squares begin that the next word breaks, and half their lengths.

    Only intervals of `least` suffixes or more are asked.
    """
    count = len(order)
    inverse = np.full(count + 1, -1, np.int64)
    inverse[order] = np.arange(count)
    cut = np.flatnonzero(shared)
    low, high = smaller(shared, cut, -1), smaller(shared, cut, 1) - 1
    wide = high - low + 1 >= least
    cut, low, high = cut[wide], low[wide], high[wide]
    none = np.zeros(0, np.int64)
    if not len(cut):
        return none, none
    # Cuts of one interval together, in order: they are where its children begin.
    sub = np.lexsort((cut, high, low))
    cut, low, high = cut[sub], low[sub], high[sub]
    new = np.ones(len(cut), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    interval = np.cumsum(new) - 1
    of, heads = np.arange(len(cut)) + interval, np.flatnonzero(new)
    children = len(cut) + len(heads)
    begins, lasts = np.empty(children, np.int64), np.empty(children, np.int64)
    begins[of + 1], lasts[of] = cut, cut - 1
    firsts = of[heads]
    begins[firsts], lasts[np.append(firsts[1:], children) - 1] = low[heads], high[heads]
    owner = np.repeat(np.arange(len(heads)), np.diff(firsts, append=children))
    sizes = lasts - begins + 1
    largest = np.flatnonzero(sizes == np.maximum.reduceat(sizes, firsts)[owner])
    _, one = np.unique(owner[largest], return_index=True)
    asked = np.ones(children, bool)
    asked[largest[one]] = False
    begins, lasts, sizes, owner = begins[asked], lasts[asked], sizes[asked], owner[asked]
    each = np.repeat(np.arange(len(sizes)), sizes)
    place = begins[each] + np.arange(len(each)) - (np.cumsum(sizes) - sizes)[each]
    suffix, head = order[place], heads[owner[each]]
    depth = shared[cut[head]]
    starts, halves = [], []
    for begin, partner in ((suffix, suffix + depth), (suffix - depth, suffix - depth)):
        inside = (partner >= 0) & (partner <= count)
        other = np.where(inside, inverse[np.where(inside, partner, count)], -1)
        square = (other >= low[head]) & (other <= high[head])
        square &= (other < begins[each]) | (other > lasts[each])
        starts.append(begin[square])
        halves.append(depth[square])
    return np.concatenate(starts), np.concatenate(halves)


def maximal_runs(
    words: np.ndarray, ends: np.ndarray, least_words: int, least_periods: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and least period of each run, by start and period.

    words: numbers that no two documents share; ends: for each place where its document ends.
    """
    order, levels = suffix_order(words, ends)
    shared = common_prefixes(order, levels)
    start, period = branching_squares(order, shared, least_periods)
    end = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        at = np.maximum(back, 0)
        same = (back >= 0) & (levels[k][at] == levels[k][at + period])
        start = np.where(same, back, start)
    length = end - start
    kept = length >= np.maximum(least_words, least_periods * period)
    start, length, period = start[kept], length[kept], period[kept]
    # A multiple of a period gives the same run; the least counts.
    sub = np.lexsort((period, length, start))
    start, length, period = start[sub], length[sub], period[sub]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    sub = np.lexsort((period, start))
    return start[sub], length[sub], period[sub]


def planted(doc_id: int | None, count: int) -> tuple[int, int] | None:
    """From which word on a document repeats, and after how many; None if it stays as it is."""
    if doc_id is None or not count:
        return None
    hashed = zlib.crc32(b"%d" % doc_id)
    if hashed % PLANTED:
        return None
    g = hashed // PLANTED
    first = g % count
    return first, 1 + (count - first) // (3 + g % 8)


def _batch(batch: pa.RecordBatch, plant: bool) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), ""))
    flat = split.flatten()
    real = pc.not_equal(flat, "")  # white space at the ends gives empty words
    bounds = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    bounds = bounds[split.offsets.to_numpy()]
    flat = flat.filter(real)
    counts, doc_ids = np.diff(bounds), batch.column("doc_id")
    source = np.arange(len(flat))
    if plant:
        for k, doc_id in enumerate(doc_ids.to_pylist()):
            if found := planted(doc_id, int(counts[k])):
                first, period = found
                tail = np.arange(counts[k] - first) % period
                source[bounds[k] + first : bounds[k + 1]] = bounds[k] + first + tail
        flat = flat.take(pa.array(source))
    coded = flat.dictionary_encode()
    owner = np.repeat(np.arange(len(counts)), counts)
    words = owner * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
    start, length, period = maximal_runs(words, bounds[owner + 1], LEAST_WORDS, LEAST_PERIODS)
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds]
    texts = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept)))
    runs = pa.StructArray.from_arrays(
        [pa.array(start - bounds[owner[start]]), pa.array(length), pa.array(period)],
        fields=list(RUN),
    )
    cuts = np.searchsorted(start, bounds)
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.array(counts.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
            pc.binary_join(texts, " "),
        ],
        names=["doc_id", "n_words", "runs", "text"],
    )


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_words, its runs by start and period, and the text with each run's first period.

    With `plant` documents are rewritten first, as `planted` says. Null, empty and blank texts
    have no words, no runs and an empty text. A null doc_id is never rewritten. Repeated rows
    are answered each. A very long text is ordered alone, in memory of some 300 bytes a word.
    Other columns are not read. An empty table gives no rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", BLOCK):
                yield _batch(some, plant)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(find, FOUND)


def strongest(runs: Column) -> Column:
    """The run with the most periods; of equals the first, then the least period."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)


def listed(runs: Column) -> Column:
    """A line for each run: start, length and period."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
