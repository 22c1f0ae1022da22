"""Near-duplicate texts by an LSH forest over MinHash signatures, verified exactly.

Texts are sets of word shingles. Equal sets are one vertex. Each tree of the forest takes its
own run of MinHash values as a vertex's path. Rows of a tree that share the shortest prefix asked
for meet in a task, sorted by path: a prefix trie. It is searched from the deepest prefixes up;
rows are compared by short sketches of their signatures, and what is alike enough joins a
candidate component. Rows already joined are not compared, so a prefix of many copies costs
little more than its rows. Then all pairs of a component are verified on whole texts, as products
of 0/1 matrices, and each text's links are counted; pairs are never written out. Prefixes and
components too large for a task are cut into blocks, of which each pair meets in a task of its
own: no pair is left out.

How long prefixes are is found out. The first search takes whole paths. Besides, a query set, the
sets whose first document's id is divisible by QUERIES, is searched for at prefixes of two values,
which miss a pair at similarity 0.8 once in 10^10 times, and verified with the rest. For each link
of a query it is then known at which prefixes the forest finds it by itself. Prefixes are shortened,
one tree after the other, until the share of links found reaches the target, with a margin for a
small number of links; without enough links to tell, down to the depth at which a pair at the
threshold is found with the target probability. The search is then made with these prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triprollup.llm.batches import hashes_of, released, slices, split
from triprollup.llm.components import connected
from triprollup.llm.tables import ceil_div, stored

SHINGLE = 5
MIN_SIMILARITY = 0.8
TREES = 24
MAX_DEPTH = 8
RECALL = 0.9999
#: One in so many documents asks for its links, at prefixes of so few values.
QUERIES, QUERY_DEPTH = 50, 2
#: Links that count as missed beyond those that are: of so many that none is missed, the share
#: missed of all is under 3 / n with a confidence of 0.95.
MARGIN = 3
#: Bytes of a sketch, one of each of so many MinHash values. At similarity 0.8 a share of
#: 0.8 agree, with a standard deviation of 0.04; pairs below the bound are not verified.
SKETCH = 96
SKETCH_BOUND = 0.6
#: Rows of a bucket (a prefix), and texts of a component, that one task takes.
BUCKET_ROWS = 20_000
CELL_TEXTS = 512
#: Columns of the 0/1 matrix at a time.
COLUMNS = 8192

#: Fixed odd multipliers: a polynomial hash of words, and its finish.
WORD_FACTOR = 0x9E3779B97F4A7C15
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _mixed(h: np.ndarray) -> np.ndarray:
    for factor in MIX:
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the different shingles of each text.

    A text of fewer words than a shingle has one shingle, all its words; one of none has none.
    """
    number, distinct, bounds = split(texts)
    words = hashes_of(distinct).view(np.uint64)[number]

    def combined(parts: list[np.ndarray]) -> np.ndarray:
        h = np.zeros_like(parts[0]) + np.uint64(len(parts))
        for part in parts:
            h = h * np.uint64(WORD_FACTOR) + part
        return _mixed(h)

    last = max(len(words) - width + 1, 0)
    whole = combined([words[k : k + last] for k in range(width)])
    sets = []
    for first, end in zip(bounds[:-1], bounds[1:]):
        if end - first >= width:
            sets.append(np.unique(whole[first : end - width + 1]))
        elif end > first:
            sets.append(combined([words[k : k + 1] for k in range(first, end)]))
        else:
            sets.append(words[:0])
    return sets


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set, signed; sets count as equal if it is."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The least value of each of many 32-bit hash functions over a set."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), 1024):
        part = values[at : at + 1024, None] * factors
        part += shifts
        np.minimum(least, part.min(axis=0), out=least)
    return least


def depth_for(recall: float, similarity: float, trees: int, most: int) -> int:
    """The greatest depth at which a pair so similar meets in a tree with that probability."""
    depth = most
    while depth > 1 and found_with(similarity, depth, trees) < recall:
        depth -= 1
    return depth


def found_with(similarity, depth: int, trees: int):
    """Probability that two sets share a prefix in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def stage_depths(stage: int, trees: int, most: int) -> np.ndarray:
    """Depth of each tree after so many were shortened by one, in turn, from `most` on."""
    rounds, shorter = divmod(stage, trees)
    return np.maximum(most - rounds - (np.arange(trees) < shorter), 1)


def stages_of(shared: np.ndarray, most: int) -> np.ndarray:
    """The first stage at which each pair shares a prefix, from what it shares in each tree.

    shared: pairs x trees. A pair that shares nothing is found by no stage, told as one too many.
    """
    trees = shared.shape[1]
    # A tree is at depth `shared` after it was shortened most - shared times.
    times = most - shared
    stage = np.where(times == 0, 0, (times - 1) * trees + np.arange(trees) + 1)
    return np.where(shared > 0, stage, (most - 1) * trees + 1).min(axis=1)


def chosen_stage(found: dict[int, int], recall: float, floor: int) -> int:
    """How far to shorten, by the number of query links first found at each stage.

    The first stage at which the links found, less a margin, are the share asked for. With too
    few links for that, `floor`, or later if the links themselves say so.
    """
    total, so_far, likely = sum(found.values()), 0, None
    for stage in sorted(found):
        so_far += found[stage]
        if likely is None and so_far >= recall * total:
            likely = stage
        if so_far >= recall * (total + MARGIN):
            return min(stage, max(floor, likely))
    return max(floor, likely or 0)


def _hash_functions(trees: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    count = max(trees * depth, SKETCH)
    rng = np.random.default_rng(5)
    factors = rng.integers(1 << 32, size=count, dtype=np.uint32) | np.uint32(1)
    return factors, rng.integers(1 << 32, size=count, dtype=np.uint32)


def _signed_rows(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """doc_id, set, path, sketch and row; rows without an id are left out.

    path: 16 bits of each value, those of a tree together.
    """
    factors, shifts = _hash_functions(trees, depth)
    step = len(factors) // SKETCH

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            ids, paths, sketches = [], [], []
            for shingles in shingle_sets(batch.column("text")):
                ids.append(set_id(shingles) if len(shingles) else None)
                least = signature(shingles, factors, shifts)
                paths.append(path_of(least, trees * depth).tobytes())
                sketches.append(least[::step][:SKETCH].astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.int64()),
                    pa.array(paths, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "set", "path", "sketch"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").filter("doc_id is not null")
    signed = rows.mapInArrow(lambda batches: released(sign(batches)), "doc_id bigint, set bigint, path binary, sketch binary")
    return signed.withColumn("row", F.monotonically_increasing_id())


def path_of(least: np.ndarray, count: int) -> np.ndarray:
    return (least[:count] >> np.uint32(8)).astype("<u2")


def _prefixes(sets: DataFrame, depths: np.ndarray, most: int) -> DataFrame:
    """set, key and branch for each tree: a hash of its prefix, and its whole path there."""
    trees = len(depths)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("path").to_pylist()), "<u2")
            paths = flat.reshape(-1, trees, most)
            h = np.broadcast_to(np.arange(trees, dtype=np.uint64), paths.shape[:2]).copy()
            for k in range(most):
                longer = h * np.uint64(WORD_FACTOR) + paths[:, :, k] + np.uint64(1)
                h = np.where(k < depths, longer, h)
            names = batch.column("set").to_numpy()
            branch = np.frombuffer(paths.tobytes(), f"V{2 * most}")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(names, trees)),
                    pa.array(_mixed(h).view(np.int64).ravel()),
                    pa.array([b.tobytes() for b in branch], pa.binary()),
                ],
                names=["set", "key", "branch"],
            )

    return sets.select("set", "path").mapInArrow(lambda batches: released(cut(batches)), "set bigint, key bigint, branch binary")


class _Forest:
    """Union-find over rows 0..n-1, for whole arrays of pairs."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            above = self.parent[self.parent]
            if np.array_equal(above, self.parent):
                return above
            self.parent = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            root = self.roots()
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _join_alike(
    forest: _Forest, group: np.ndarray, sketch: np.ndarray, bound: int, asks: np.ndarray | None
) -> None:
    """Join rows sorted by group where sketches agree in `bound` bytes at least.

    asks: if given, only pairs of which one asks are compared; those that do come first in a group.
    """
    last = np.searchsorted(group, group, side="right")
    start = np.searchsorted(group, group, side="left")
    at, step = np.arange(len(group)), 1
    if asks is not None:
        at = at[asks]
    firsts = np.unique(start)
    while True:
        at = at[at + step < last[at]]
        if not len(at):
            return
        root = forest.roots()
        if step & (step - 1) == 0:
            # A group that is one component already has no pair left to compare.
            lowest = np.minimum.reduceat(root, firsts)
            highest = np.maximum.reduceat(root, firsts)
            whole = np.zeros(len(group), bool)
            whole[firsts] = lowest == highest
            at = at[~whole[start[at]]]
        a, b = at, at + step
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
        for first in range(0, len(a), 100_000):
            x, y = a[first : first + 100_000], b[first : first + 100_000]
            alike = (sketch[x] == sketch[y]).sum(axis=1) >= bound
            forest.join(x[alike], y[alike])
        step += 1


def _trie_roots(
    bucket: np.ndarray, branch: np.ndarray, sketch: np.ndarray, bound: int, asks: np.ndarray | None
) -> np.ndarray:
    """Roots of rows sorted by bucket and branch (or by who asks), joined from the deepest
    prefixes that rows share up to the whole bucket."""
    forest, most = _Forest(len(bucket)), branch.shape[1]
    if asks is None:
        parts = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        shared = np.cumprod(branch[1:] == branch[:-1], axis=1).sum(axis=1)
        shared = np.where(parts, -1, np.concatenate([[0], shared]))
        for depth in range(most, 0, -1):
            # Rows of one group share this prefix; where that tells no more, it is done below.
            if (shared >= depth).any():
                _join_alike(forest, np.cumsum(shared < depth), sketch, bound, None)
    _join_alike(forest, bucket, sketch, bound, asks)
    return forest.roots()


def _blocks(groups: DataFrame, size: Column, member: str, most: int) -> DataFrame:
    """Adds i and j: each row goes to all pairs of blocks that its own block is in.

    A group of at most `most` rows is one block, pair (0, 0). Rows get `block`, too.
    """
    n = F.ceil(size / most).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), member), n).cast("int")
    return (
        groups.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other")
    )


def _candidates(
    sets: DataFrame, depths: np.ndarray, most: int, bucket_rows: int, queries: bool = False
) -> DataFrame:
    """Edges (a, b) between sets, enough to connect all that are alike under some prefix.

    queries: under prefixes that hold a query only, and only what is alike a query there.
    """
    paths = _prefixes(sets, depths, most)
    asks = F.lit(False)
    if queries:
        paths = paths.join(sets.select("set", "asks"), "set")
        asks = F.max("asks")
    sizes = paths.groupBy("key").agg(F.count(F.lit(1)).alias("n"), asks.alias("asked")).filter("n > 1")
    sizes = sizes.filter("asked") if queries else sizes
    shared = _blocks(paths.join(sizes.drop("asked"), "key"), F.col("n"), "set", bucket_rows)
    shared = shared.select("set", "branch", F.xxhash64("key", "i", "j").alias("bucket"))
    rows = shared.join(sets.select("set", "sketch", (~F.col("asks")).alias("rest")), "set")
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # Tries by branch; queries come first in their bucket.
    order = ["bucket", "rest", "set"] if queries else ["bucket", "branch", "set"]
    rows = rows.repartition(int(parts), "bucket").sortWithinPartitions(*order)
    bound = int(np.ceil(SKETCH * SKETCH_BOUND))

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            bucket, members = rows.column("bucket").to_numpy(), rows.column("set").to_numpy()
            data = b"".join(rows.column("sketch").to_pylist())
            sketch = np.frombuffer(data, np.uint8).reshape(-1, SKETCH)
            branch = np.frombuffer(b"".join(rows.column("branch").to_pylist()), "<u2").reshape(-1, most)
            first = ~rows.column("rest").to_numpy() if queries else None
            root = _trie_roots(bucket, branch, sketch, bound, first)
            far = root != np.arange(len(root))
            return pa.RecordBatch.from_arrays(
                [pa.array(members[far]), pa.array(members[root[far]])], names=["a", "b"]
            )

        # A bucket may go on in the next batch: its last rows are held back.
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            bucket = rows.column("bucket").to_numpy()
            first = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0
            if first:
                yield edges(rows.slice(0, first))
                held = rows.slice(first).to_batches()
        if held:
            yield edges(pa.Table.from_batches(held))

    rows = rows.select("bucket", "set", "branch", "sketch", "rest")
    return rows.mapInArrow(lambda batches: released(connect(batches)), "a bigint, b bigint").distinct()


def _verified(
    docs: DataFrame, members: DataFrame, similarity: float, trees: int, depth: int, cell_texts: int
) -> DataFrame:
    """set, links and near: links of each set in a cell, and a set it is linked to.

    members: set, root (of the candidate component) and rep, a document with that set. Rows
    without a set tell, by stage, how many links of queries the forest first finds there.
    """
    factors, shifts = _hash_functions(trees, depth)
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = members.join(sizes, "root")
    total = sized.count()
    cells = max(1, ceil_div(total, cell_texts // 2))
    blocks = _blocks(sized, F.col("n"), "set", cell_texts).select(
        "set",
        "rep",
        "block",
        "i",
        "j",
        "root",
        F.when(F.col("n") > cell_texts, F.xxhash64("root", "i", "j"))
        .otherwise(F.pmod(F.xxhash64("root"), F.lit(cells)))
        .alias("cell"),
    )
    # How many members there are has no bound, so texts meet them by a shuffle at any size.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text")
    placed = texts.join(blocks.hint("merge"), "rep")

    def verify(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        sets = shingle_sets(rows.column("text").combine_chunks())
        names = rows.column("set").to_numpy()
        # Rows that share an id with a set's document may have another text; then repeats.
        real = np.array([len(s) > 0 and set_id(s) == n for s, n in zip(sets, names)], bool)
        group = rows.column("root").to_numpy()
        own, i, j = (rows.column(c).to_numpy() for c in ("block", "i", "j"))
        asks = rows.column("rep").to_numpy() % QUERIES == 0
        stages = np.zeros((depth - 1) * trees + 2, np.int64)
        out: dict[str, list] = {"set": [], "links": [], "near": []}
        order = np.lexsort((names, j, i, group))
        order = order[real[order]]
        if len(order):
            keyed = np.stack([group[order], i[order], j[order], names[order]])
            order = order[np.concatenate([[True], (keyed[:, 1:] != keyed[:, :-1]).any(axis=0)])]
        cuts = np.flatnonzero((np.diff(np.stack([group[order], i[order], j[order]])) != 0).any(axis=0)) + 1
        for some in np.split(order, cuts):
            if len(some) < 2:
                continue
            side = own[some] if i[some[0]] != j[some[0]] else None
            linked = _linked([sets[k] for k in some], side, similarity)
            forest = _Forest(len(some))
            count = np.zeros(len(some), int)
            for a, b, _ in linked:
                for end in (a, b):
                    count += np.bincount(end, minlength=len(some))
                forest.join(a, b)
                asked = asks[some[a]].astype(int) + asks[some[b]]
                a, b, asked = a[asked > 0], b[asked > 0], asked[asked > 0]
                paths = {
                    k: path_of(signature(sets[some[k]], factors, shifts), trees * depth).reshape(trees, depth)
                    for k in np.unique([*a, *b]).tolist()
                }
                for first in range(0, len(a), 10_000):
                    x, y = ([paths[k] for k in end[first : first + 10_000].tolist()] for end in (a, b))
                    shared = np.cumprod(np.stack(x) == np.stack(y), axis=2).sum(axis=2)
                    np.add.at(stages, stages_of(shared, depth), asked[first : first + 10_000])
            root = forest.roots()
            out["set"].append(names[some])
            out["links"].append(count)
            out["near"].append(names[some][root])
        found = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in out.values()]
        at = np.flatnonzero(stages)
        none, empty = np.zeros(len(at), np.int64), np.zeros(len(found[0]), np.int64)
        is_told = np.repeat([False, True], [len(empty), len(at)])
        columns = {c: np.concatenate([v, none]) for c, v in zip(out, found)}
        columns |= {"stage": np.concatenate([empty, at]), "n": np.concatenate([empty, stages[at]])}
        return pa.table(
            {c: pa.array(v, mask=is_told == (c not in ("stage", "n"))) for c, v in columns.items()}
        )

    schema = "set bigint, links bigint, near bigint, stage bigint, n bigint"
    return placed.groupBy("cell").applyInArrow(verify, schema)


def _linked(
    sets: list[np.ndarray], side: np.ndarray | None, similarity: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs a < b of sets similar enough, and how similar; with sides, of different ones."""
    sizes = np.array([len(s) for s in sets])
    shingle, column, times = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    row = np.repeat(np.arange(len(sets)), sizes)
    # A shingle of one set alone adds nothing to any intersection.
    common = times > 1
    place = np.cumsum(common) - 1
    keep = common[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, int(common.sum()) - first)), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        both += part @ part.T
    jaccard = both / (sizes[:, None] + sizes[None, :] - both)
    a, b = np.nonzero(np.triu(jaccard >= similarity - 1e-6, 1))
    # Exactly: the products are whole numbers below 2^24.
    exact = both[a, b].astype(float) / (sizes[a] + sizes[b] - both[a, b].astype(float))
    right = exact >= similarity
    if side is not None:
        right &= side[a] != side[b]
    yield a[right], b[right], exact[right]


@dataclass(frozen=True)
class Found:
    """What the query set tells of a search: its links, the share of them that the forest finds
    by itself, and the depth of each tree."""

    links: int
    recall: float
    depths: tuple[int, ...]


def _searched(
    docs: DataFrame,
    similarity: float,
    trees: int,
    recall: float,
    max_depth: int,
    bucket_rows: int,
    cell_texts: int,
) -> tuple[DataFrame, DataFrame, DataFrame, Found]:
    """Signed rows, sets, verified links of the last search, and what its queries tell."""
    signed = stored(_signed_rows(docs, trees, max_depth), "signatures")
    classes = stored(
        signed.filter("set is not null")
        .groupBy("set")
        .agg(
            F.min(F.struct("doc_id", "row")).alias("first"),
            F.count(F.lit(1)).alias("n_copies"),
        )
        .select("set", F.col("first.doc_id").alias("rep"), "first.row", "n_copies"),
        "sets",
    )
    asks = (F.col("rep") % QUERIES == 0).alias("asks")
    vertices = signed.select("row", "path", "sketch").join(classes.select("set", "row", asks), "row")
    vertices = stored(vertices.drop("row"), "vertices")
    shallow = np.full(trees, min(QUERY_DEPTH, max_depth))
    of_queries = stored(_candidates(vertices, shallow, max_depth, bucket_rows, queries=True), "query-edges")
    floor = (max_depth - depth_for(recall, similarity, trees, max_depth)) * trees
    stage, wanted = 0, None
    while True:
        depths = stage_depths(stage, trees, max_depth)
        candidates = _candidates(vertices, depths, max_depth, bucket_rows).union(of_queries)
        groups = connected(candidates).withColumnRenamed("vertex", "set")
        members = stored(groups.join(classes.select("set", "rep"), "set"), "members")
        checked = stored(
            _verified(docs, members, similarity, trees, max_depth, cell_texts), "verified"
        )
        told = checked.filter("stage is not null").groupBy("stage").agg(F.sum("n").alias("n"))
        found = {r["stage"]: r["n"] for r in told.collect()}  # a row for each stage at most
        if wanted is not None or (wanted := chosen_stage(found, recall, floor)) <= stage:
            break
        stage = min(wanted, (max_depth - 1) * trees)
    total = sum(found.values())
    direct = sum(n for s, n in found.items() if s <= stage)
    share = direct / total if total else 1.0
    links = checked.filter("set is not null")
    return signed, classes, links, Found(total, share, tuple(depths.tolist()))


def measured_recall(
    docs: DataFrame,
    similarity: float = MIN_SIMILARITY,
    trees: int = TREES,
    recall: float = RECALL,
    max_depth: int = MAX_DEPTH,
    bucket_rows: int = BUCKET_ROWS,
    cell_texts: int = CELL_TEXTS,
) -> Found:
    """What the query set tells of `near_duplicates` over these documents."""
    return _searched(docs, similarity, trees, recall, max_depth, bucket_rows, cell_texts)[3]


def near_duplicates(
    docs: DataFrame,
    similarity: float = MIN_SIMILARITY,
    trees: int = TREES,
    recall: float = RECALL,
    max_depth: int = MAX_DEPTH,
    bucket_rows: int = BUCKET_ROWS,
    cell_texts: int = CELL_TEXTS,
) -> DataFrame:
    """doc_id, class_id, copy_id, n_copies and n_links of each row.

    copy_id is the least doc_id of a text with the same shingles, n_copies how many rows have
    them. n_links counts the other shingle sets that are similar enough. class_id is the least
    doc_id reached over copies and links.

    A null or empty text has no words and is like no other: it is its own class. Texts under
    five words are alike if all their words are equal. Rows that share an id and differ are
    compared each and keep their own answer. A row without an id gets null ids, no copies and
    no links. Case is ignored for A-Z; other columns are not read. An empty table gives no rows.
    """
    signed, classes, checked, _ = _searched(
        docs, similarity, trees, recall, max_depth, bucket_rows, cell_texts
    )
    links = checked.groupBy("set").agg(F.sum("links").alias("n_links"))
    linked = connected(checked.select(F.col("set").alias("a"), F.col("near").alias("b")))
    tops = linked.select(F.col("vertex").alias("set"), "root").join(classes, "set")
    tops = tops.groupBy("root").agg(F.min("rep").alias("class_id"))
    top = linked.join(tops, "root").select(F.col("vertex").alias("set"), "class_id")
    of_set = (
        classes.join(links, "set", "left").join(top, "set", "left").select(
            "set",
            F.col("rep").alias("copy_id"),
            F.coalesce("class_id", "rep").alias("class_id"),
            "n_copies",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
    # Written first, so that the join of a text that is copied very often can be split.
    of_set = stored(of_set, "answers")
    with_id = signed.select("doc_id", "set").join(of_set, "set", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    none = F.lit(None).cast("bigint")
    without = docs.filter("doc_id is null").select(
        none.alias("doc_id"),
        none.alias("class_id"),
        none.alias("copy_id"),
        F.lit(1).cast("bigint").alias("n_copies"),
        F.lit(0).cast("bigint").alias("n_links"),
    )
    return with_id.unionByName(without)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that are the first of their class.

    Rows that repeat an id and text are one document. Rows that share an id and differ go
    together, if each has a document before it. Rows without an id all stay.
    """
    ids = stored(near_duplicates(docs, **options), "classes").groupBy("doc_id").agg(
        F.every(F.col("doc_id") != F.col("class_id")).alias("later"),
        F.count(F.lit(1)).alias("n"),
    )
    ids = stored(ids.filter("doc_id is not null and (later or n > 1)"), "ids")

    def those(which: DataFrame, how: str) -> DataFrame:
        which = which.select(F.col("doc_id").alias("_id"))
        return docs.join(which, docs["doc_id"] == which["_id"], how)

    repeated = ids.filter("not later")
    if repeated.isEmpty():
        return those(ids, "left_anti")
    return those(ids, "left_anti").unionByName(
        those(repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    )
