"""Token ids as packed binary matrices, by best-fit-decreasing with a segment tree.

Documents are tokenized and packed where they are read: a task fills cells of a fixed number
of tokens, so its memory is bounded and no ids are shuffled. In a cell the pieces go longest
first to the fullest row that still has room; a segment tree over free space finds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triprollup.llm.tokens import encoded, tokenizer_at, tokenizer_path

ROW_TOKENS = 4096
END = 1
PAD = 0
#: Ids of a cell: 2,048 full rows of 4,096.
CELL_TOKENS = 2048 * ROW_TOKENS

SCHEMA = (
    "sequence_id bigint, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, "
    "positions binary, segments array<struct<doc_id: bigint, piece: int, start: bigint>>"
)
_SEGMENT = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64())])


class SpaceTree:
    """Numbers of rows by their free space; each node counts the rows below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, free: int, change: int) -> None:
        node = free + self.size
        while node:
            self.count[node] += change
            node >>= 1

    def least(self, free: int) -> int | None:
        """The least free space of at least so much that some row has."""
        node = free + self.size
        if self.count[node]:
            return free
        # Up to the first ancestor with rows to the right, then down its leftmost path.
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers, each row in the order it was filled."""
    tree, rows = SpaceTree(capacity), []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        free = tree.least(lengths[i])
        if free is None:
            free, row = capacity, len(rows)
            rows.append([])
        else:
            row = by_free[free].pop()
            tree.add(free, -1)
        rows[row].append(i)
        if left := free - lengths[i]:
            by_free[left].append(row)
            tree.add(left, 1)
    return rows


def pack_matrices(
    docs: DataFrame,
    capacity: int = ROW_TOKENS,
    path: str | None = None,
    cell_tokens: int = CELL_TOKENS,
) -> DataFrame:
    """A row for each packed sequence.

    ids: `capacity` little-endian unsigned 16-bit ids, padded with 0. cu_seqlens: where the
    segments begin, and the end of the last. positions: as many 16-bit numbers, counted anew
    from 0 in each segment, 0 on padding. segments: which piece of which document each is,
    and how many of the document's ids come before it. A document is its ids and the end id 1,
    cut after every `capacity` ids, so nothing of it is lost.

    A null text is an empty one, a repeated row a document of its own; a null doc_id stays
    null. Other columns are not read. An empty table gives no rows.
    """
    file = path or tokenizer_path()

    def rows_of(cell: list[tuple[int, int, int, np.ndarray]], base: int) -> pa.RecordBatch:
        packed = best_fit_decreasing([len(c[3]) for c in cell], capacity)
        out: dict[str, list] = {n: [] for n in ("id", "tokens", "n", "ids", "cu", "at", "seg")}
        for number, row in enumerate(packed):
            matrix, at = np.full(capacity, PAD, "<u2"), np.zeros(capacity, "<u2")
            ends = [0]
            for i in row:
                part, first = cell[i][3], ends[-1]
                matrix[first : first + len(part)] = part
                at[first : first + len(part)] = np.arange(len(part))
                ends.append(first + len(part))
            out["id"].append(base + number)
            out["tokens"].append(ends[-1])
            out["n"].append(len(row))
            out["ids"].append(matrix.tobytes())
            out["cu"].append(ends)
            out["at"].append(at.tobytes())
            out["seg"].append([dict(zip(("doc_id", "piece", "start"), cell[i])) for i in row])
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary())
        arrays = [pa.array(v, k) for v, k in zip(out.values(), (*kinds, pa.list_(_SEGMENT)))]
        names = ["sequence_id", "n_tokens", "n_segments", "ids", "cu_seqlens", "positions", "segments"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_at(file).whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer do not fit 16 bits")
        base = TaskContext.get().partitionId() << 32
        cell: list[tuple[int, int, int, np.ndarray]] = []
        held = 0
        for batch in batches:
            for doc_id, ids in encoded(batch, file):
                own = np.append(ids, END).astype("<u2")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    if held + len(part) > cell_tokens:
                        yield (made := rows_of(cell, base))
                        cell, held, base = [], 0, base + made.num_rows
                    cell.append((doc_id, piece, start, part))
                    held += len(part)
        if cell:
            yield rows_of(cell, base)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(fill, SCHEMA)


def write_matrices(docs: DataFrame, path: str, **options) -> DataFrame:
    """Writes the packed sequences as Parquet and returns them as read again."""
    pack_matrices(docs, **options).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def unpacked(matrices: DataFrame) -> DataFrame:
    """doc_id, piece, start and the ids (16-bit, little-endian) of each segment again."""
    cut = "substring(ids, 2 * cu_seqlens[at] + 1, 2 * (cu_seqlens[at + 1] - cu_seqlens[at]))"
    return matrices.selectExpr("*", "posexplode(segments) as (at, segment)").selectExpr(
        "segment.doc_id", "segment.piece", "segment.start", f"{cut} as ids"
    )
