"""Repeated byte strings, by longest-previous-factor arrays over suffix order.

The longest previous factor of a place is the longest string that starts there and also at an
earlier place; its counterpart looks for later places. Both are found for all places whose
factors have `least` bytes or more, as follows, up to `length` bytes.

1. Anchors. Each string of `least` bytes is assigned the place in it where a rolling hash of GRAM
   bytes is least. Equal strings have their anchor at the same distance, so they can only meet at
   anchors with equal grams. Some 10 in 1,000 places are anchors; only their hashes are shuffled.
2. An anchor's context is all that a string assigned to it can cover. Where two anchors have
   the same context, all of it repeats; one of them, the first, stands for it from here on.
3. Anchors that share a gram but differ in context send their contexts to a cell. Places at one
   distance before their anchors, whose contexts agree up to there, are in suffix order as their
   anchors are. So the anchors' suffixes are ordered once, and their common prefixes taken; and
   for each distance at which contexts part, previous and next smaller positions in that order
   give each place its longest previous factor, and larger positions its longest next one.
4. A gram in more contexts than a cell takes is split: each context is compared with one of
   the group. Strings that both hold are settled; the others must agree beyond what the two
   share before the anchor, or after it, and are regrouped by that. Groups small enough go to
   cells, larger ones are split again.

A string is removed if a factor has `length` bytes; shorter factors are told of, as `n_repeated`
and `longest_repeat`. Nothing is left out at any step, and a cell's memory is bounded. Documents
are ordered by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triprollup.llm.tables import ceil_div, stored

LENGTH = 400
#: Shortest repeats that are found; a passage of 50 words is rarely shorter.
LEAST = 256
GRAM = 64
#: Contexts of a group that go to one cell, at most; and of a cell of small groups, about.
CELL = 1_500
CELL_OF_SMALL = 2_000
#: Contexts whose suffixes are ordered at a time.
ORDERED = 6_000
#: Bytes hashed at a time.
STRETCH = 2_000_000

#: Fixed odd multipliers of the rolling hash, one for each doubling, and of its finish.
FACTORS = (
    0x9E3779B97F4A7C15,
    0xBF58476D1CE4E5B9,
    0x94D049BB133111EB,
    0xD6E8FEB86659FD93,
    0xA0761D6478BD642F,
    0xE7037ED1A0B428DB,
)
MIX = 0xFF51AFD7ED558CCD

ANCHORS = "doc_id bigint, version int, pos bigint, after int, gram bigint, context bigint"


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the `gram` bytes from each place; gram is a power of two up to 64."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX)
    width = 1
    for factor in FACTORS[: gram.bit_length() - 1]:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width *= 2
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


def _least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """Place of the least key, the first of equals, in each run of `width` keys."""
    n = len(keys)
    packed = (keys >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    padded = np.full(ceil_div(n, width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: n - width + 1], ahead[width - 1 : n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors_of(
    texts: list[bytes], length: int, gram: int, least: int | None = None, contexts: bool = True
) -> tuple[np.ndarray, ...]:
    """Text number, place, bytes from there on, gram hash and context hash of each anchor.

    The context hash is 0 without `contexts`.
    """
    least = least or length
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    if not len(data) or sizes.max() < least:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    hashes = _gram_hashes(data, gram)
    place = _least_places(hashes, least - gram + 1)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    inside = np.arange(len(place)) + least <= ends[owner]
    # The least place moves forward only, so its repeats are next to each other.
    at = place[inside]
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    owner = np.searchsorted(ends, at, side="right")
    pos = at - (ends - sizes)[owner]
    before = np.minimum(pos, least - gram)
    after = np.minimum(sizes[owner] - pos, length)
    if not contexts:
        return owner, pos, after, hashes[at].view(np.int64), np.zeros(len(at), np.int64)
    context = np.fromiter(
        (
            xxhash.xxh3_64_intdigest(texts[o][p - b : p + a], b * 65_536 + a)
            for o, p, b, a in zip(owner.tolist(), pos.tolist(), before.tolist(), after.tolist())
        ),
        np.uint64,
        len(at),
    )
    return owner, pos, after, hashes[at].view(np.int64), context.view(np.int64)


def _stretches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > STRETCH:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, version (which text, of rows that share an id) and data, the text's bytes."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("bigint"), F.hash(data).alias("version"), data.alias("data")
    )


def _anchors(keyed: DataFrame, length: int, gram: int, least: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("data").to_pylist()
            for first, last in _stretches([len(d) for d in data]):
                owner, pos, after, *hashes = anchors_of(data[first:last], length, gram, least)
                rows = batch.select(["doc_id", "version"]).slice(first, last - first)
                rows = rows.take(pa.array(owner))
                counts = [pa.array(pos), pa.array(after, pa.int32())]
                columns = [*rows.columns, *counts, *map(pa.array, hashes)]
                names = ["doc_id", "version", "pos", "after", "gram", "context"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return keyed.mapInArrow(scan, ANCHORS)


def _shared_grams(keyed: DataFrame, length: int, gram: int, least: int) -> DataFrame:
    """The grams of more than one anchor."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("data").to_pylist()
            for first, last in _stretches([len(d) for d in data]):
                grams = anchors_of(data[first:last], length, gram, least, contexts=False)[3]
                yield pa.RecordBatch.from_arrays([pa.array(grams)], names=["gram"])

    grams = keyed.select("data").mapInArrow(scan, "gram bigint")
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")


def _shared(parts: list[bytes], width: int) -> np.ndarray:
    """Leading bytes that each part, of up to `width`, shares with the one before it."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8)
    rows = flat.reshape(len(parts), width)
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.concatenate([[0], np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))])


class RangeMinimum:
    """The least of any stretch of some values."""

    def __init__(self, values: np.ndarray):
        self.levels, width = [values], 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """From `first` up to and with `last`; both in order."""
        level = np.frexp(last - first + 1)[1] - 1
        found = np.empty(len(first), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            some = self.levels[k]
            found[at] = np.minimum(some[first[at]], some[last[at] + 1 - (1 << k)])
        return found


def smaller_positions(values: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each of these places the nearest before it (step -1) or after it with a smaller value.

    What stands between a place and the one it points to is not smaller, so pointers are followed
    all at once. There must be a smaller value at either end.
    """
    to = np.arange(len(values)) + step
    active = at
    while len(active):
        active = active[values[to[active]] >= values[active]]
        to[active] = to[to[active]]
    return to[at]


def longest_factors(
    group: np.ndarray, left: list[bytes], right: list[bytes], length: int, keep_first: bool
) -> tuple[np.ndarray, ...]:
    """Longest factors of places before the anchors of some groups, as (row, near, far, bytes).

    Rows are in order of their positions, group by group. A place `d` bytes before the anchor of
    a row, with near <= d <= far, has a longest previous factor of d + bytes; with keep_first
    false, the longer of its longest previous and its longest next factor. left: what stands
    before the anchor, backwards; right: from it on. What no row says has no factor that holds
    the anchor's first byte.
    """
    count, rows = len(group), np.arange(len(group))
    by_right = np.array(sorted(rows.tolist(), key=lambda i: (group[i], right[i])), np.int64)
    by_left = np.array(sorted(rows.tolist(), key=lambda i: (group[i], left[i])), np.int64)
    first = np.concatenate([[True], group[1:] != group[:-1]])
    prefix = _shared([right[i] for i in by_right.tolist()], length)
    suffix = _shared([left[i] for i in by_left.tolist()], max(map(len, left), default=1) or 1)
    prefix[first], suffix[first] = 0, 0
    rank = np.empty(count, np.int64)
    rank[by_right] = rows
    shared = RangeMinimum(prefix)
    # The distances at which contexts of a group part, from the farthest on.
    parting = np.unique(np.stack([group[~first], -suffix[~first]]), axis=1)
    begins = np.searchsorted(parting[0], np.arange(group[-1] + 2) if count else np.zeros(1))
    levels = np.diff(begins)
    found = []
    for nth in range(int(levels.max(initial=0))):
        # Of each group that has so many levels, the next one.
        live = levels > nth
        place = begins[:-1] + nth
        far = np.where(live, -parting[1][np.minimum(place, parting.shape[1] - 1)], -1)
        more = levels > nth + 1
        near = np.where(more, 1 - parting[1][np.minimum(place + 1, parting.shape[1] - 1)], 0)
        # Rows that agree on `far` bytes before their anchors are of one class.
        own = np.empty(count, np.int64)
        own[by_left] = np.cumsum(first | (suffix < far[group[by_left]]))
        sizes = np.bincount(own)
        order = by_right[live[group[by_right]] & (sizes[own[by_right]] > 1)]
        order = order[np.argsort(own[order], kind="stable")]
        new = np.concatenate([[True], own[order][1:] != own[order][:-1]])[: len(order)]
        # Classes in suffix order, with a position before all others between them.
        at = np.arange(len(order)) + np.cumsum(new)
        size = len(order) + int(new.sum()) + 1
        holder = np.full(size, -1, np.int64)
        holder[at] = order
        best = np.zeros(len(order), np.int64)
        for position in (rows + 1,) if keep_first else (rows + 1, count - rows):
            values = np.zeros(size, np.int64)
            values[at] = position[order]
            for step in (-1, 1):
                other = holder[smaller_positions(values, at, step)]
                have = np.flatnonzero(other >= 0)
                ends = np.sort([rank[order[have]], rank[other[have]]], axis=0)
                best[have] = np.maximum(best[have], shared.between(ends[0] + 1, ends[1]))
        some = best > 0
        of = group[order[some]]
        found.append((order[some], near[of], far[of], best[some]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(map(np.concatenate, zip(*found)))


def _cell_factors(rows: pa.Table, length: int, least: int, keep_first: bool) -> pa.Table:
    """What repeats of each context of a cell, one row for those where something does."""
    rows = rows.combine_chunks()
    keys = [(c, "ascending") for c in ("group", "doc_id", "version", "pos")]
    rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start"))
    # Rows that share an id and a text are one here; both are told what is found.
    same = ~(_changes(rows, "doc_id") | _changes(rows, "pos"))
    same &= ~(_changes(rows, "version") | _changes(rows, "group"))
    rows = rows.take(pa.array(np.flatnonzero(~np.concatenate([[False], same]))))
    number = np.cumsum(np.concatenate([[0], _changes(rows, "group")]))
    before, low, high, pos = (rows.column(c).to_numpy() for c in ("before", "low", "high", "pos"))
    context = rows.column("bytes").to_pylist()
    left = [c[:b][::-1] for c, b in zip(context, before.tolist())]
    right = [c[b:] for c, b in zip(context, before.tolist())]
    none = -np.ones(len(pos), np.int64)
    far, seen_far, seen_right, longest = none.copy(), none.copy(), none.copy(), none.copy()
    near = np.full(len(pos), length, np.int64)
    # Whole groups, so many rows at a time.
    cuts = np.flatnonzero(np.diff(number, prepend=-1, append=len(number)))
    first = 0
    while first < len(pos):
        last = int(cuts[np.searchsorted(cuts, first + ORDERED, side="right") - 1])
        if last <= first:
            last = int(cuts[np.searchsorted(cuts, first, side="right")])
        part = slice(first, last)
        own = number[part] - number[first]
        at, d_near, d_far, n = longest_factors(own, left[part], right[part], length, keep_first)
        at = at + first
        d_near, d_far = np.maximum(d_near, low[at]), np.minimum(d_far, high[at])
        real = d_near <= d_far
        at, d_near, d_far, n = (x[real] for x in (at, d_near, d_far, n))
        # All of these hold their anchor, so that together they are one stretch.
        seen = d_far + n >= least
        np.maximum.at(seen_far, at[seen], d_far[seen])
        np.maximum.at(seen_right, at[seen], n[seen])
        np.maximum.at(longest, at[seen], (d_far + n)[seen])
        d_near = np.maximum(d_near, length - n)
        gone = d_near <= d_far
        np.maximum.at(far, at[gone], d_far[gone])
        np.minimum.at(near, at[gone], d_near[gone])
        first = last
    kept = np.flatnonzero(seen_far >= 0)
    far, near, pos = far[kept], near[kept], pos[kept]
    held = rows.select(["doc_id", "version"]).take(pa.array(kept))
    removed = far >= 0
    return pa.table(
        {
            "doc_id": held.column("doc_id"),
            "version": held.column("version"),
            "start": pa.array(pos - far, pa.int64(), mask=~removed),
            "end": pa.array(pos - near + length, pa.int64(), mask=~removed),
            "seen_start": pa.array(pos - seen_far[kept], pa.int64()),
            "seen_end": pa.array(pos + seen_right[kept], pa.int64()),
            "longest": pa.array(np.minimum(longest[kept], length), pa.int64()),
        }
    )


def _changes(rows: pa.Table, name: str) -> np.ndarray:
    """Whether each value but the first differs from the one before it."""
    values = rows.column(name)
    a, b = values.slice(1).to_pylist(), values.to_pylist()[:-1]
    return np.array([x != y for x, y in zip(a, b)], bool)


#: What is removed (null if nothing is), what repeats at all, and the longest that does.
SPANS = (
    "doc_id bigint, version int, start bigint, end bigint, "
    "seen_start bigint, seen_end bigint, longest bigint"
)


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    keep_first: bool = False,
    cell: int = CELL,
    least: int | None = None,
) -> DataFrame:
    """doc_id, version, start and end of bytes in strings of `length` that start elsewhere too.

    keep_first: only those that have an earlier copy. seen_start, seen_end and longest: the same
    of strings of `least` bytes or more, and the longest of them, up to `length`. Spans may
    overlap or touch. version tells apart texts of rows that share an id.
    """
    least = min(LEAST, length) if least is None else least
    if not 2 * gram <= least <= length <= 32_000:
        raise ValueError("lengths must be 2 grams at least, and 32,000 at most")
    reach = least - gram
    keyed = _keyed(docs)
    # Anchors are looked for twice: most share their gram with no other, and are not written.
    # Grams are written first, so that the join of one in every third document can be split.
    grams = stored(_shared_grams(keyed, length, gram, least), "shared-grams")
    anchors = _anchors(keyed, length, gram, least).join(grams, "gram")
    anchors = stored(anchors, "shared-anchors", "zstd")
    key = F.struct("doc_id", "version", "pos")
    contexts = stored(
        anchors.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")),
        "contexts",
    )
    whole = anchors.join(contexts.filter("n > 1").drop("n"), ["gram", "context"])
    if keep_first:
        whole = whole.filter(~key.eqNullSafe(F.col("first")))
    before = F.least(F.col("pos"), F.lit(reach))
    found = [_spans(whole, before, length - F.col("after"), F.col("after"), length, least)]
    many = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = contexts.join(many.select("gram"), "gram").select("gram", "first.*")
    data = F.substring(
        F.col("data"),
        (F.col("pos") - before + 1).cast("int"),
        (before + length).cast("int"),
    )
    same = members["doc_id"].eqNullSafe(keyed["doc_id"]) & (members["version"] == keyed["version"])
    groups = stored(
        members.join(keyed, same).select(
            members["doc_id"],
            members["version"],
            "pos",
            before.cast("int").alias("before"),
            data.alias("bytes"),
            F.col("gram").alias("group"),
            F.lit(0).alias("low"),
            before.cast("int").alias("high"),
        ),
        "context-bytes",
        "zstd",
    )
    small = []
    while True:
        sizes = stored(groups.groupBy("group").agg(F.count(F.lit(1)).alias("m")), "group-sizes")
        small.append(groups.join(sizes.filter((F.col("m") > 1) & (F.col("m") <= cell)), "group"))
        large = sizes.filter(F.col("m") > cell)
        if large.isEmpty():
            break
        settled, groups = _split(groups.join(large.drop("m"), "group"), length, least, keep_first)
        found.append(settled)
    parts = small[0]
    for more in small[1:]:
        parts = parts.unionByName(more)
    cells = max(1, ceil_div(parts.count(), CELL_OF_SMALL))
    dealt = parts.withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(cells)))
    found.append(
        dealt.groupBy("cell").applyInArrow(
            lambda rows: _cell_factors(rows, length, least, keep_first), SPANS
        )
    )
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def _spans(
    rows: DataFrame, far: Column, near: Column, right: Column, length: int, least: int
) -> DataFrame:
    """What repeats where places from `far` to 0 before an anchor share `right` bytes from it on.

    near: the least distance at which a string of `length` bytes does.
    """
    near = F.greatest(near, F.lit(0))
    pos, removed, seen = F.col("pos"), near <= far, far + right >= least
    return rows.select(
        "doc_id",
        "version",
        F.when(removed, pos - far).cast("bigint").alias("start"),
        F.when(removed, pos - near + length).cast("bigint").alias("end"),
        F.when(seen, pos - far).cast("bigint").alias("seen_start"),
        F.when(seen, pos + right).cast("bigint").alias("seen_end"),
        F.when(seen, F.least(far + right, F.lit(length))).cast("bigint").alias("longest"),
    ).filter("seen_start is not null")


MEMBERS = (
    "doc_id bigint, version int, pos bigint, before int, bytes binary, group bigint, "
    "low int, high int"
)


def _common(a: bytes, b: bytes) -> int:
    """Number of leading bytes that are the same."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax())


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`left` and `right`: bytes before and from the anchor that a member shares with its
    group's representative; and the byte beyond them, -1 if the context has none."""
    for batch in batches:
        lefts, rights, left_next, right_next = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("bytes", "before", "r_bytes", "r_before"))
        for data, before, r_data, r_before in zip(*columns):
            left = _common(data[:before][::-1], r_data[:r_before][::-1])
            right = _common(data[before:], r_data[r_before:])
            lefts.append(left)
            rights.append(right)
            left_next.append(data[before - left - 1] if left < before else -1)
            right_next.append(data[before + right] if before + right < len(data) else -1)
        counted = (pa.array(x, pa.int32()) for x in (lefts, rights, left_next, right_next))
        names = [f.name for f in batch.schema if f.name not in ("r_bytes", "r_before")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), *counted],
            names=[*names, "left", "right", "left_next", "right_next"],
        )


def _split(
    large: DataFrame, length: int, least: int, keep_first: bool
) -> tuple[DataFrame, DataFrame]:
    """Spans that are settled for groups too large, and their members in smaller groups.

    Members are compared with one of their group, the representative: a random one, or with
    keep_first the first. A member's distances low to high, that is the strings that begin so
    many bytes before the anchor, fall into three ranges. Those in which the two agree are
    settled. Farther ones need more bytes before the anchor than the two share, and nearer
    ones more bytes after it; either is regrouped by how many are shared and the next byte, on
    which equal strings agree. So a member gives two rows at most, whose distances are apart,
    and a new group is the branch of a tree of contexts off the path to a random leaf, which
    has half of the group's members or less at every second round, on average.
    """
    key = F.struct("doc_id", "version", "pos")
    large = stored(large, "large-groups", "zstd")
    order = key if keep_first else F.struct(F.xxhash64("doc_id", "version", "pos"), key)
    chosen = large.groupBy("group").agg(
        F.min_by(F.struct(key.alias("r_key"), "before", "bytes"), order).alias("r")
    )
    chosen = stored(
        chosen.select(
            "group",
            F.col("r.r_key").alias("r_key"),
            F.col("r.before").alias("r_before"),
            F.col("r.bytes").alias("r_bytes"),
        ),
        "representatives",
    )
    pairs = large.join(chosen, "group").filter(~key.eqNullSafe(F.col("r_key")))
    names = ["doc_id", "version", "pos", "before", "bytes", "group", "low", "high"]
    r_key = pairs.schema["r_key"].dataType.simpleString()
    compared = pairs.select(*names, "r_key", "r_before", "r_bytes").mapInArrow(
        _compared,
        f"{MEMBERS}, r_key {r_key}, left int, right int, left_next int, right_next int",
    )
    compared = stored(compared, "compared", "zstd")
    near = F.greatest("low", length - F.col("right")).alias("near")
    far = F.least("high", "left").alias("far")
    names_of = ("near", "far", "right")
    agreed = compared.filter(far >= F.col("low")).select(
        "group", "r_key", "doc_id", "version", "pos", near, far, "right"
    )

    def spans_of(rows: DataFrame) -> DataFrame:
        return _spans(rows, *(F.col(c) for c in ("far", "near", "right")), length, least)

    settled = spans_of(agreed)
    if not keep_first:
        own = agreed.select("group", "r_key", *names_of).distinct()
        settled = settled.unionByName(spans_of(own.select("r_key.*", *names_of)))
    # A context that ends where they part shares no more with any other.
    below = F.when(F.col("right_next") >= 0, F.least("high", "left", length - 1 - F.col("right")))
    below = F.coalesce(below, F.lit(-1))
    above = F.greatest("low", F.col("left") + 1)
    ranges = F.array(
        _branch("left", above, F.col("high")), _branch("right", F.col("low"), below)
    )
    ranges = F.filter(ranges, lambda x: x["low"] <= x["high"])
    parts = compared.select(*names[:5], F.explode(ranges).alias("range"))
    return settled, stored(parts.select(*names[:5], "range.*"), "split-groups", "zstd")


def _branch(side: str, low: Column, high: Column) -> Column:
    group = F.xxhash64("group", F.lit(side), side, f"{side}_next")
    return F.struct(group.alias("group"), low.alias("low"), high.alias("high"))


#: Columns of the result.
MADE = ("data", "n_bytes", "n_removed", "removed", "n_repeated", "longest_repeat")


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """All columns of docs, with `data` (bytes left), `n_bytes`, `n_removed` and `removed`.

    removed: the maximal removed runs, as start and end in bytes. n_repeated: bytes in repeats of
    any length that was looked for, and longest_repeat: the longest (0 if there is none).
    """
    removed = F.when(F.col("start").isNotNull(), F.struct("start", "end"))
    seen = F.struct(F.col("seen_start").alias("start"), F.col("seen_end").alias("end"))
    per_text = spans.groupBy("doc_id", "version").agg(
        F.collect_list(removed).alias("spans"),
        F.collect_list(seen).alias("seen"),
        F.max("longest").alias("longest"),
    )
    own = ["spans", "seen", "longest"]
    per_text = per_text.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), *own)
    names = [c for c in docs.columns if c not in MADE]
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*names).alias("row"),
        F.col("doc_id").cast("bigint").alias("_doc"),
        F.hash(data).alias("_hash"),
        data.alias("data"),
    )
    same = rows["_doc"].eqNullSafe(per_text["_id"]) & (rows["_hash"] == per_text["_version"])
    rows = rows.join(per_text, same, "left").select("row", "data", *own)

    def joined(spans: list[dict[str, int]] | None, size: int) -> list[dict[str, int]]:
        merged: list[dict[str, int]] = []
        for start, end in sorted((s["start"], min(s["end"], size)) for s in spans or ()):
            if merged and start <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], end)
            else:
                merged.append({"start": start, "end": end})
        return merged

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, sizes, gone, runs, repeated = [], [], [], [], []
            for text, spans, seen in zip(*(batch.column(c).to_pylist() for c in ("data", "spans", "seen"))):
                merged = joined(spans, len(text))
                at, parts = 0, []
                for run in merged:
                    parts.append(text[at : run["start"]])
                    at = run["end"]
                kept = b"".join([*parts, text[at:]]) if merged else text
                left.append(kept)
                sizes.append(len(text))
                gone.append(len(text) - len(kept))
                runs.append(merged)
                repeated.append(sum(s["end"] - s["start"] for s in joined(seen, len(text))))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [pa.array(left, pa.binary()), pa.array(sizes, pa.int64())]
            arrays += [pa.array(gone, pa.int64()), pa.array(runs, span)]
            arrays += [pa.array(repeated, pa.int64()), pc.fill_null(batch.column("longest"), 0)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], names=["row", *MADE])

    row = rows.schema["row"].dataType.simpleString()
    schema = (
        f"row {row}, data binary, n_bytes bigint, n_removed bigint, "
        "removed array<struct<start: bigint, end: bigint>>, n_repeated bigint, longest_repeat bigint"
    )
    return rows.mapInArrow(cut, schema).select("row.*", *MADE)


def dedup_strings(
    docs: DataFrame, length: int = LENGTH, keep_first: bool = True, **options
) -> DataFrame:
    """Documents without their repeated strings: all columns of docs, and those of
    `without_repeats`.

    With keep_first the first copy of a string stays; else all copies go. Strings are judged
    on the input. Matches lie within documents; one may match the same document.

    A null text is no bytes. A text shorter than `length` stays as it is. Repeated rows are
    documents of their own, each a copy of the other; the two can't be told apart, so with
    keep_first both stay. A null doc_id comes before all others. Columns of docs with the names
    of the result's are replaced. An empty table gives no rows.
    """
    return without_repeats(docs, repeated_spans(docs, length, keep_first=keep_first, **options))
