"""Bounded-space online best-fit packing of token sequences.

A packer holds a fixed number of open bins, keyed by their free space: one bit of an integer
for each free space at which there is a bin. The best fit for a piece is the lowest set bit
at or above its length. If no open bin fits and all are in use, the fullest is closed.

Pieces are packed where they lie, a task for each share of them; what a task still has open
at its end is opened again and goes to fewer tasks in a next round, so that the space left
over does not grow with the number of tasks. The last remainder, which a fixed number of
bins holds, is packed once more, longest pieces first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triprollup.llm.batches import released
from triprollup.llm.tables import ceil_div, stored
from triprollup.llm.tokens import encoded, tokenizer_path

CAPACITY = 4096
OPEN_BINS = 512
END = 1
#: Tokens that one task packs in the first round: 4,096 full bins. Rounds shrink by eight.
TASK_TOKENS = 4096 * CAPACITY
SHRINK = 8

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class OpenBins:
    """The open bins of a packer, and the number of the next bin."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        found = held.pop()
        if not held:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece of 1 to `capacity` tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            if self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, found = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(found)
            self.bits |= 1 << left
            self.open += 1
        return found, self.capacity - free

    def still_open(self) -> set[int]:
        return {b for held in self.by_free for b in held}


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Each document's ids and the end id, cut after every `capacity` of them.

    A null text is an empty one; a repeated row is a document of its own, and a null doc_id
    stays null. Other columns are not read.
    """
    file = path or tokenizer_path()

    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, ids in encoded(batch, file):
                own = np.append(ids, END).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = zip(*rows) if rows else [[]] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(lambda batches: released(cut(batches)), PIECES)


def _packed(pieces: DataFrame, round_: int, capacity: int, open_bins: int, last: bool) -> DataFrame:
    """Bin, offset and whether the bin was still open at the end, for each piece."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tasks = [pa.Table.from_batches([b]) for b in batches]
        if not tasks:
            return
        rows = pa.concat_tables(tasks)
        bins = OpenBins(capacity, open_bins)
        placed = [bins.place(n) for n in rows.column("length").to_pylist()]
        base = (round_ << 56) + (TaskContext.get().partitionId() << 32)
        unfinished = set() if last else bins.still_open()
        rows = rows.append_column("sequence_id", pa.array([base + b for b, _ in placed], pa.int64()))
        rows = rows.append_column("offset", pa.array([o for _, o in placed], pa.int64()))
        rows = rows.append_column("open", pa.array([b in unfinished for b, _ in placed], pa.bool_()))
        yield from rows.combine_chunks().to_batches()

    schema = pieces.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    schema += ", sequence_id bigint, offset bigint, open boolean"
    return pieces.mapInArrow(pack, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of 1 to `capacity`.

    The pieces come in an order fixed by their columns, as good as random. An empty table
    gives no rows.
    """
    pieces = stored(pieces, "pieces")
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks, round_, done = max(1, ceil_div(total, TASK_TOKENS)), 0, []
    while True:
        dealt = pieces.withColumn("_deal", F.xxhash64(*pieces.columns))
        dealt = dealt.repartition(tasks, "_deal") if tasks > 1 else dealt.repartition(1)
        dealt = dealt.sortWithinPartitions("_deal").drop("_deal")
        packed = stored(_packed(dealt, round_, capacity, open_bins, last=False), "packed")
        done.append(packed.filter(~F.col("open")))
        pieces = packed.filter("open").drop("sequence_id", "offset", "open")
        if tasks == 1:
            break
        tasks, round_ = ceil_div(tasks, SHRINK), round_ + 1
    rest = pieces.repartition(1).sortWithinPartitions(
        F.col("length").desc(), *[c for c in pieces.columns if c != "length"]
    )
    done.append(stored(_packed(rest, round_ + 1, capacity, open_bins, last=True), "packed"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("open")


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    path: str | None = None,
) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces_of(docs, capacity, path), capacity, open_bins)
